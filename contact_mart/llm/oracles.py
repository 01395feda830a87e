"""DuckDB texts of the queries that SQL can express, over the same tables.

Without one: op1 and op10 (learnt), op4 (its passages depend on min-hashes), op5 (a tokenizer's merges), op7 (rounds of
raking), op11 (expectation-maximisation) and op12 (edits chosen over whole paths); these have plain versions in tests/llm.
"""

from __future__ import annotations

SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(name: str, table: str, row: str, text: str, pattern: str) -> str:
    """CTEs: one row per text with its words w, and one per word with its place i (from 1) and the text's number n."""
    return f"""
{name} AS (SELECT {row}, coalesce(regexp_extract_all({text}, '{pattern}'), []) AS w FROM {table}),
{name}_words AS (SELECT {row}, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM {name})"""


def _run(row: str, size: str) -> str:
    """The words from a place on, joined; at the last places fewer than ``size``."""
    return f"string_agg(word, ' ') OVER (PARTITION BY {row} ORDER BY i ROWS BETWEEN CURRENT ROW AND {size} - 1 FOLLOWING)"


DECONTAMINATION = rf"""
WITH {_words("docs", "documents", "doc_id", _lower("text"), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")},
{_words("items", "benchmark", "item_id", _lower("text"), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")},
windows AS (SELECT DISTINCT item_id, least(n, 10) AS size, run FROM
    (SELECT item_id, i, n, {_run("item_id", "10")} AS run FROM items_words) WHERE i <= greatest(n - 9, 1)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT doc_id, i, size, string_agg(word, ' ') OVER (
    PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS run, n FROM docs_words, sizes),
found AS (SELECT doc_id, i, size, item_id FROM runs JOIN windows USING (size, run) WHERE i <= n - size + 1),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
    (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)"""

NEAR_DEDUP = rf"""
WITH RECURSIVE {_words("docs", "documents", "doc_id", _lower("text"), WORD)},
shingles AS (SELECT DISTINCT doc_id, run FROM
    (SELECT doc_id, i, n, {_run("doc_id", "5")} AS run FROM docs_words) WHERE i <= greatest(n - 4, 1)),
ranks AS (SELECT run, row_number() OVER (ORDER BY count(*), run) AS rank FROM shingles GROUP BY run),
sets AS (SELECT doc_id, list(rank ORDER BY rank) AS s FROM shingles JOIN ranks USING (run) GROUP BY doc_id),
classes AS (SELECT s, min(doc_id) AS head FROM sets GROUP BY s),
prefixes AS (SELECT head, unnest(s[1 : len(s) - (75 * len(s) + 99) // 100 + 1]) AS rank FROM classes),
candidates AS (SELECT DISTINCT a.head AS a, b.head AS b FROM prefixes a JOIN prefixes b ON a.rank = b.rank AND a.head < b.head),
pairs AS (SELECT a, b, len(x.s) + len(y.s) AS total, len(list_intersect(x.s, y.s)) AS common
    FROM candidates JOIN classes x ON x.head = a JOIN classes y ON y.head = b
    WHERE 100 * least(len(x.s), len(y.s)) >= 75 * greatest(len(x.s), len(y.s))),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 75 * (total - common)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT head, head FROM classes UNION SELECT reach.a, either.b FROM reach JOIN either ON either.a = reach.b),
least_of AS (SELECT a AS head, min(b) AS component FROM reach GROUP BY a)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id,
    coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sets USING (doc_id) LEFT JOIN classes USING (s) LEFT JOIN least_of USING (head)"""

# Base 32 from the hex digest: five hex digits are four letters.
_FIVE = "list_reduce([strpos('0123456789abcdef', hex[5 * g + k]) - 1 FOR k IN [1, 2, 3, 4, 5]], lambda v, d: 16 * v + d)"
WARC = f"""
WITH pages_ AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS hex FROM pages),
parts AS (SELECT page_id, size, hex, [{_FIVE} FOR g IN [0, 1, 2, 3, 4, 5, 6, 7]] AS parts FROM pages_),
named AS (SELECT page_id, size, array_to_string(flatten([['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (v // d) % 32]
    FOR d IN [32768, 1024, 32, 1]] FOR v IN parts]), '') AS digest FROM parts),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS newest FROM named)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM newest"""

_LEDGER = rf"""
{_words("docs", "documents", "doc_id", "text", WORD)},
runs AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times FROM
    (SELECT doc_id, i, n, {_run("doc_id", "8")} AS run FROM docs_words) WHERE i <= n - 7),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM
    (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM runs WHERE times > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
parts AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    list_filter(lines, lambda x: regexp_matches(x, '{WORD}')) AS with_word, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM documents JOIN docs USING (doc_id) JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
measured AS (SELECT *, len(with_word) - len(list_distinct(with_word)) AS n_dup_lines FROM parts),
ledger AS (SELECT *, (n_words < 20)::BIGINT AS few_words, (100 * n_repeat_words > 30 * n_words)::BIGINT AS repeated_words,
    (10 * n_symbols > word_chars)::BIGINT AS symbols, (100 * n_dup_lines > 30 * n_lines)::BIGINT AS repeated_lines,
    (word_chars < 2 * n_words OR word_chars > 16 * n_words)::BIGINT AS word_length FROM measured)"""

QUALITY_RULES = f"""
WITH {_LEDGER}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, few_words + repeated_words > 0 AS base_failed,
    few_words + repeated_words + symbols + repeated_lines + word_length = 0 AS kept,
    few_words + 2 * repeated_words + 4 * symbols + 8 * repeated_lines + 16 * word_length AS fail_bits
FROM ledger"""

_RULES = ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length")
QUALITY_ABLATIONS = f"WITH {_LEDGER}" + " UNION ALL ".join(
    f"""
SELECT '{rule}' AS rule, count(*) FILTER ({rule} = 1) AS n_failed,
    count(*) FILTER ({rule} = 1 AND {" + ".join(_RULES)} = 1) AS n_only_by_rule,
    count(*) FILTER ({" + ".join(r for r in _RULES if r != rule)} = 0) AS n_kept_without FROM ledger"""
    for rule in _RULES
)

LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM split),
keyed AS (SELECT *, {_lower(f"trim(line, {BLANKS})")} AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner, count(DISTINCT doc_id) AS n_docs FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT doc_id, i, line, coalesce(n_docs > 1 AND doc_id <> owner, false) AS gone FROM keyed LEFT JOIN owners USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

# CRC-32 of a string of digits, bit by bit with the reflected polynomial.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], [ascii(d)::BIGINT FOR d IN string_split(conv_id::VARCHAR, '')]),
    lambda crc, d: list_reduce(list_concat([xor(crc, d)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x // 2, 3988292384 * (x % 2)))))"""
PREFIX_TRIE = f"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))
    AS p, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
convs AS (SELECT c.conv_id, base, h, least(h, coalesce(b.n, 0)) AS head FROM
    (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM sizes) c LEFT JOIN sizes b ON b.conv_id = c.base),
rebuilt AS (SELECT c.conv_id, p AS place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND p <= h
    UNION ALL SELECT c.conv_id, p - h + head, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND p > h),
prefixes AS (SELECT conv_id, place AS depth, strlen(text) AS size, sha256(string_agg(
    strlen(role) || ':' || role || strlen(text) || ':' || text, '' ORDER BY place) OVER (
    PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS node FROM rebuilt),
paths AS (SELECT * FROM prefixes UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (SELECT depth, node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM lengths JOIN paths USING (conv_id, depth)
    GROUP BY depth, node),
nodes AS (SELECT depth, node, min(conv_id) AS owner, count(*) AS n, max(size) AS size FROM paths GROUP BY depth, node),
above AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN paths p ON p.conv_id = n.owner AND p.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM above WHERE depth > 0 GROUP BY ALL),
known AS (SELECT above.*, coalesce(n_children, 0) AS n_children FROM above LEFT JOIN children USING (depth, node)),
sums AS (SELECT p.depth, p.node, sum((k.n_children = 0)::INT) AS n_leaves, sum((k.n - 1) * k.size) AS saved
    FROM known k JOIN paths p ON p.conv_id = k.owner AND p.depth <= k.depth GROUP BY p.depth, p.node)
SELECT k.owner AS conv_id, k.depth::BIGINT AS depth, above.owner AS parent_conv_id, k.n AS n_convs, k.n_children AS n_children,
    n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM known k JOIN sums USING (depth, node) LEFT JOIN ends USING (depth, node)
LEFT JOIN nodes above ON above.depth = k.depth - 1 AND above.node = k.parent"""

ORACLES: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op3_near_dedup": NEAR_DEDUP,
    "op6_warc": WARC,
    "op8_quality_rules": QUALITY_RULES,
    "quality_ablations": QUALITY_ABLATIONS,
    "op9_line_dedup": LINE_DEDUP,
    "op13_prefix_trie": PREFIX_TRIE,
}
