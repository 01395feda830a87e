"""Personal data: fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. The field looks at the tokens around digits, "@" and the words that announce a secret;
it scores whole candidate segments of up to SPAN tokens by features of the span (its shape, digits, separators, checksum,
what stands before and after it), and a dynamic program over the bounded segments chooses boundaries and types at once.
Segments without a digit or "@" score minus infinity, so every token outside the neighbourhoods is a segment of its own
of type "none", and leaving these out changes nothing: the decoding is that of the whole text.

The weights are learnt here, on a sample of neighbourhoods from all texts, bounded for each type: base spans are the labels of the four base types,
assignments such as ``token = "..."`` those of "secret". Spans of the field that touch no base span are added.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contact_mart.llm.common import prepare

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
SPAN, CONTEXT = 5, 2
EPOCHS, RATE, DECAY = 6, 0.3, 0.001
# Neighbourhoods that the weights are learnt on, at most: those with an entity of each type, and those with none.
SAMPLE_PLACES = dict.fromkeys(KINDS, 100) | {"none": 300}
# Of one text, neighbourhoods of a type; tokens of a neighbourhood, a longer one is learnt on in parts.
TEXT_PLACES, PLACE_TOKENS = 3, 60
_NONE = -1

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*")
_EMAIL_BACK = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+@-")
# The look-behind and the possessive runs only spare the retries inside a run of digits, which cannot match.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_SECRET = re.compile(r"""(?i)\b(?:token|secret|password|passwd|api[_-]?key|key)\s*[=:]\s*["']?([A-Za-z0-9_+/=-]{16,})""")
_HEX = re.compile(r"[0-9a-fA-F]+")
_ANNOUNCES = re.compile(r"(?i)token|secret|passw|key|credential")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. A match lies inside one run of its characters, so only runs with an "@" are searched."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_BACK:
            start -= 1
        end = done = _EMAIL_RUN.match(text, at).end()
        yield from _email_matches(text, start, end)
        at = text.find("@", end)


def _email_matches(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Matches in a run, in time linear in it: the part before an "@" is all that stands since the last "@" or match."""
    low = start
    while (at := text.find("@", low, end)) >= 0:
        found = _EMAIL.match(text, low, end) if at > low else None
        if found:
            yield found.start(), found.end()
            low = found.end()
        else:
            low = at + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by kind as listed, then start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (g.lstrip("0") for g in m.group().split("."))):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def places(text: str) -> Iterator[list[tuple[int, int]]]:
    """Token bounds of each neighbourhood: the tokens with a digit or "@", CONTEXT tokens on both sides, joined where
    they meet, whatever their number: an entity is never cut."""
    held: list[tuple[int, int]] = []
    ahead, at = 0, 0
    for mark in _MARK.finditer(text):
        if mark.start() < at:
            continue
        start = mark.start()
        while start > 0 and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        before: list[tuple[int, int]] = []
        low = start
        for _ in range(CONTEXT):
            end = low
            while end > at and text[end - 1] in " \t\n\x0b\x0c\r":
                end -= 1
            low = end
            while low > at and text[low - 1] not in " \t\n\x0b\x0c\r":
                low -= 1
            if low == end:
                break
            before.append((low, end))
        token = _TOKEN.match(text, start)
        gap = not held or (before[-1][0] if before else start) > ahead
        if held and gap:
            held += _after(text, at)
            yield held
            held = []
        fresh = [b for b in reversed(before) if not held or b[0] >= held[-1][1]]
        held += [*fresh, token.span()]
        at = token.end()
        following = _after(text, at)
        ahead = following[-1][1] if following else at
    if held:
        yield held + _after(text, at)


def _after(text: str, at: int) -> list[tuple[int, int]]:
    out = []
    for _ in range(CONTEXT):
        m = _TOKEN.search(text, at)
        if not m:
            break
        out.append(m.span())
        at = m.end()
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without punctuation around it."""
    while start < end and text[start] in "\"'([{<,;:=.!?*%&$#|":
        start += 1
    while start < end and text[end - 1] in "\"')]}>,;:=.!?*%&$#|":
        end -= 1
    return start, end


def span_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str] | None:
    """Features of the segment of tokens i to j - 1 as a whole; None where it cannot be an entity."""
    start, end = trimmed(text, tokens[i][0], tokens[j - 1][1])
    span = text[start:end]
    digits = sum(map(str.isdigit, span))
    if not span or not (digits or "@" in span) or (j - i > 1 and not _edges(text, tokens, i, j)):
        return None
    letters = sum(map(str.isalpha, span))
    ascii_digits = "".join(c for c in span if "0" <= c <= "9")
    groups = span.split(".")
    before = text[slice(*tokens[i - 1])] if i else ""
    earlier = text[slice(*tokens[i - 2])] if i > 1 else ""
    out = [
        f"tokens={j - i}", f"digits={min(digits, 20)}", f"letters={'no' if not letters else 'few' if letters < digits else 'many'}",
        f"at={span.count('@')}", f"dots={min(span.count('.'), 4)}", f"first={_shape(span[0])}", f"last={_shape(span[-1])}",
        f"length={min(len(span).bit_length(), 8)}",
    ]
    if len(groups) == 4 and all(g.isdigit() for g in groups):
        out.append("four_groups")
    if 16 <= len(ascii_digits) <= 19 and len(ascii_digits) == digits and not letters:
        out.append("luhn" if luhn(ascii_digits) else "no_luhn")
    if len(span) >= 16 and _HEX.fullmatch(span) and letters:
        out.append("hex")
    if span[0] == "+" and not letters and 8 <= digits <= 15:
        out.append("plus_number")
    if _ANNOUNCES.search(before) or (before in ("=", ":") and _ANNOUNCES.search(earlier)):
        out.append("announced")
    if text[tokens[i][0]] in "\"'" and len(span) >= 16:
        out.append("quoted")
    return out


def _shape(c: str) -> str:
    return "d" if c.isdigit() else "a" if c.isalpha() else c if c in "+(@" else "p"


def _edges(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> bool:
    """Several tokens are one entity only if both ends have digits."""
    return all(any(c.isdigit() for c in text[slice(*tokens[k])]) for k in (i, j - 1))


class SemiMarkov:
    """Weights per (type, feature). A token of type "none" scores 0, so that entity scores are log odds against it."""

    def __init__(self, weights: dict[tuple[int, str], float] | None = None):
        self.weights = weights or {}

    def lattice(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
        out = []
        for i in range(len(tokens)):
            for j in range(i + 1, min(i + SPAN, len(tokens)) + 1):
                found = span_features(text, tokens, i, j)
                if found is not None:
                    out.append((i, j, found))
        return out

    def score(self, kind: int, found: list[str]) -> float:
        get = self.weights.get
        return sum(get((kind, f), 0.0) for f in found) + get((kind, "bias"), -2.0)

    def decode(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """Best segmentation: spans (kind, start, end). Segments are scored as they end, so that what is held is a pair of
        numbers a token, however long the neighbourhood."""
        best, back = [0.0], [(0, _NONE)]
        for j in range(1, len(tokens) + 1):
            top, where = best[j - 1], (j - 1, _NONE)
            for i in range(max(0, j - SPAN), j):
                found = span_features(text, tokens, i, j)
                if found is None:
                    continue
                scores = [self.score(k, found) for k in range(len(KINDS))]
                kind = int(np.argmax(scores))
                if best[i] + scores[kind] > top:
                    top, where = best[i] + scores[kind], (i, kind)
            best.append(top)
            back.append(where)
        spans, j = [], len(tokens)
        while j > 0:
            i, kind = back[j]
            if kind != _NONE:
                spans.append((KINDS[kind], *trimmed(text, tokens[i][0], tokens[j - 1][1])))
            j = i
        return spans[::-1]

    def learn(self, cases: list[tuple[str, list[tuple[int, int]], set[tuple[str, int, int]]]]) -> None:
        """Gradient ascent on the log likelihood of the labelled segmentations."""
        prepared = []
        for text, tokens, gold in cases:
            segments = self.lattice(text, tokens)
            bounds = [trimmed(text, tokens[i][0], tokens[j - 1][1]) for i, j, _ in segments]
            truth = [next((KINDS.index(k) for k, a, b in gold if (a, b) == at), _NONE) for at in bounds]
            prepared.append((len(tokens), segments, truth))
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch)
            for n, segments, truth in prepared:
                scores = np.array([[self.score(k, f) for k in range(len(KINDS))] for _, _, f in segments]).reshape(-1, len(KINDS))
                chances = _segment_chances(n, segments, scores)
                for (_, _, found), kind, chance in zip(segments, truth, chances):
                    for k in range(len(KINDS)):
                        move = rate * ((k == kind) - chance[k])
                        if abs(move) > 1e-4:
                            for f in (*found, "bias"):
                                old = self.weights.get((k, f), -2.0 if f == "bias" else 0.0)
                                self.weights[k, f] = old + move - rate * DECAY * old


def _segment_chances(n: int, segments: list, scores: np.ndarray) -> np.ndarray:
    """Marginal probability of every (segment, type) by the forward and backward sums."""
    if not len(segments):
        return scores
    total = np.logaddexp.reduce(scores, axis=1)
    ends, starts = defaultdict(list), defaultdict(list)
    for (i, j, _), s in zip(segments, total):
        ends[j].append((i, s))
        starts[i].append((j, s))
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + s for i, s in ends[j])])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + s for j, s in starts[i])])
    context = np.array([ahead[i] + behind[j] - ahead[n] for i, j, _ in segments])
    return np.exp(np.minimum(scores + context[:, None], 0.0))


Case = tuple[str, list[tuple[int, int]], set[tuple[str, int, int]]]


def labelled(text: str) -> Iterator[tuple[str, Case]]:
    """(type, case) of the first TEXT_PLACES neighbourhoods of every type in the text, "none" without an entity. A case
    has its own piece of the text. A long neighbourhood is split where no entity is cut."""
    spans = sorted({(a, b, k) for k, a, b in base_spans(text)} | {(m.start(1), m.end(1), "secret") for m in _SECRET.finditer(text)})
    taken: dict[str, int] = defaultdict(int)
    first = 0
    for tokens in places(text):
        at = 0
        while at < len(tokens):
            end = min(at + PLACE_TOKENS, len(tokens))
            low = tokens[at][0]
            while first < len(spans) and spans[first][1] <= low:
                first += 1
            inside = []
            for a, b, k in (spans[n] for n in range(first, len(spans))):
                if a >= tokens[end - 1][1]:
                    break
                inside.append((a, b, k))
            if end < len(tokens):
                cut = end
                while cut > at + 1 and any(a < tokens[cut][0] and b > tokens[cut - 1][1] for a, b, _ in inside):
                    cut -= 1
                end = cut if cut > at + 1 else end
            high = tokens[end - 1][1]
            gold = {(k, a - low, b - low) for a, b, k in inside if a >= low and b <= high}
            case = text[low:high], [(s - low, e - low) for s, e in tokens[at:end]], gold
            for kind in sorted({k for k, _, _ in gold}) or ["none"]:
                taken[kind] += 1
                if taken[kind] <= TEXT_PLACES:
                    yield kind, case
            at = end


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> list[Case]:
    """Cases from all texts: of each type at most SAMPLE_PLACES, dealt evenly over the sources where there is such a
    column, in the order of a hash of the id and the text."""
    columns = [F.xxhash64(doc_id, text).alias("h"), (F.col(source).cast("string") if source in docs.columns else F.lit(None).cast("string")).alias("source")]
    marked = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"), *columns)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (kind, source, h, place, json.dumps([piece, tokens, sorted(gold)]))
                for value, h, source in zip(batch["text"], batch["h"], batch["source"])
                for place, (kind, (piece, tokens, gold)) in enumerate(labelled(value))
            ]
            yield pd.DataFrame(rows, columns=["kind", "source", "h", "place", "case"])

    found = marked.mapInPandas(cut, "kind string, source string, h long, place int, case string")
    most = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for k, n in SAMPLE_PLACES.items()])
    # Each source's first ones, then by turns over the sources; both filters are group limits before the exchange.
    by_source = Window.partitionBy("kind", "source").orderBy("h", "place", "case")
    by_kind = Window.partitionBy("kind").orderBy("turn", "h", "place", "case")
    ranked = found.withColumn("turn", F.row_number().over(by_source)).where(F.col("turn") <= max(SAMPLE_PLACES.values()))
    ranked = ranked.withColumn("n", F.row_number().over(by_kind)).where(F.col("n") <= max(SAMPLE_PLACES.values())).where(F.col("n") <= most)
    cases: dict[str, int] = {}
    for r in sorted(ranked.select("h", "place", "case").collect()):
        cases.setdefault(r["case"], len(cases))
    read = (json.loads(c) for c in cases)
    return [(piece, [tuple(t) for t in tokens], {tuple(g) for g in gold}) for piece, tokens, gold in read]


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> SemiMarkov:
    """Weights from the ``sample``. The sample is for the weights alone; the search covers all texts."""
    model = SemiMarkov()
    model.learn(sample(docs, doc_id, text, source))
    return model


def find(text: str | None, model: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and all spans, each by kind as listed, then start."""
    if not text:
        return [], []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach, furthest = [], 0
    for _, b in taken:
        furthest = max(furthest, b)
        reach.append(furthest)
    added = []
    for tokens in places(text):
        for kind, a, b in model.decode(text, tokens):
            k = int(np.searchsorted(starts, b))
            if not (k and reach[k - 1] > a):
                added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, model: SemiMarkov | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: the id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, n_added,
    spans (all, as kind:start:end by kind and start; code points, end exclusive).

    A null or empty text has no spans. Rows are independent; other columns are not read, but for a "source", over which
    the sample for the weights is dealt.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast((model or train(docs, doc_id, text)).weights)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_added long, spans string")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        field = SemiMarkov(sent.value)
        for part in texts:
            rows = []
            for value in part:
                base, spans = find(value, field)
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in BASE), hashlib.sha256(_listed(base).encode()).hexdigest(), len(spans) - len(base), _listed(spans)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "n_added", "spans"])

    return docs.select(F.col(doc_id), search(F.col(text)).alias("s")).select(doc_id, "s.*")
