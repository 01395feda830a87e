"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: a row holds the
measurements and, in ``fail_bits``, one bit per failed rule. Everything after that works on
the ledger alone: a policy is a versioned mask of the rules that count, and an ablation asks
which documents one rule alone keeps out. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import SPACES, SPACE_CLASS, let, without

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Rule -> condition of failure over the measurements. The place in the list is the bit; only append.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
]
BASE = ("few_words", "repeated_words")
# Version -> rules that reject.
POLICIES: dict[int, tuple[str, ...]] = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines", "word_length"),
}


def mask(names: tuple[str, ...], rules: list[tuple[str, str]] = RULES) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(rules)}
    return sum(bits[name] for name in names)


def _windows(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words."""
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
        ),
    )


def _covered(hashes: Column, size: int) -> Column:
    """Words inside the windows that occur twice or more."""

    def of_sorted(s: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            near = [F.coalesce(F.get(s, i + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
            return near[0] | near[1]

        starts = F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda at, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - at, F.lit(size)))),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
        let(pairs, of_sorted)
    )


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(
        let(_windows(words, size), lambda h: _covered(h, size))
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words. A null text counts as empty.

    Windows of eight words are compared by 64-bit hashes within one text.
    """
    content = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    trimmed = F.btrim("__text", F.lit(SPACES))
    parts = content.withColumns(
        {
            "__words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
                F.split(trimmed, f"{SPACE_CLASS}+", -1)
            ),
            "__lines": F.split("__text", "\n", -1),
        }
    )
    bare = without(F.col("__text"), SPACES)
    no_symbols = F.octet_length(without(F.col("__text"), SYMBOLS))
    with_word = F.filter("__lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return parts.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(bare).cast("long"),
            "n_symbols": (F.octet_length("__text") - no_symbols).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeat_words(F.col("__words")),
        }
    ).drop("__text", "__words", "__lines")


def ledger(docs: DataFrame, text: str = "text", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``fail_bits``. Columns of these names are replaced, others are kept.

    Rows are independent: ties and repeated rows get the same bits each.
    """
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, text).withColumn("fail_bits", bits)


def apply_policy(
    rows: DataFrame, version: int, policies: Mapping[int, tuple[str, ...]] = POLICIES, rules: list[tuple[str, str]] = RULES
) -> DataFrame:
    """The ledger with policy_version and kept: no bit of the policy's mask is set."""
    rejecting = F.lit(mask(policies[version], rules)).cast("long")
    return rows.withColumns(
        {"policy_version": F.lit(version), "kept": F.col("fail_bits").bitwiseAND(rejecting) == 0}
    )


def ablations(
    rows: DataFrame, version: int, policies: Mapping[int, tuple[str, ...]] = POLICIES, rules: list[tuple[str, str]] = RULES
) -> DataFrame:
    """A row per rule of the policy: documents it fails, documents that it alone rejects, documents kept without it.

    One aggregation over the ledger; the texts are not read again.
    """
    whole = mask(policies[version], rules)
    sums = []
    for name in policies[version]:
        bit = mask((name,), rules)
        held = F.col("fail_bits").bitwiseAND(F.lit(whole).cast("long"))
        sums += [
            F.count_if(F.col("fail_bits").bitwiseAND(F.lit(bit).cast("long")) != 0).alias(f"{name}_fails"),
            F.count_if(held == bit).alias(f"{name}_alone"),
            F.count_if(held.bitwiseAND(F.lit(~bit).cast("long")) == 0).alias(f"{name}_kept"),
        ]
    lines = ", ".join(f"'{n}', {n}_fails, {n}_alone, {n}_kept" for n in policies[version])
    return rows.agg(*sums).selectExpr(
        f"stack({len(policies[version])}, {lines}) as (rule, n_failed, n_only_by_rule, n_kept_without)"
    )
