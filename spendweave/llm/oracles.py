"""SQL for the results of those queries that SQL can express."""

from __future__ import annotations

OP5 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM r
"""

_WORD = r"[^\x20\x09-\x0D]"

OP8 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i : i + 7] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(n) AS n FROM (
    SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM again)
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS capitals, length(regexp_replace(t, '\P{{L}}', '', 'g')) AS letters
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 3 * n_dup_lines > n_lines
    OR 10 * capitals > 4 * word_chars OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 2 * letters < word_chars) AS kept
FROM m
"""


def _spans(kinds: list[tuple[str, str, str]], base: int) -> str:
    """Spans of (kind, pattern, condition on hit, before and after) per document; the first ``base`` kinds are counted."""
    found = "\nUNION ALL\n".join(
        f"SELECT doc_id, '{kind}' AS kind, {i} AS no, t, regexp_extract_all(t, '{pattern}') AS hits, "
        f"string_split_regex(t, '{pattern}') AS gaps FROM d"
        for i, (kind, pattern, _) in enumerate(kinds)
    )
    keep = " ".join(f"WHEN '{kind}' THEN {condition}" for kind, _, condition in kinds)
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{kind}') AS BIGINT) AS n_{kind}" for kind, _, _ in kinds[:base])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
s AS (
  SELECT doc_id, kind, no, t, unnest(hits) AS hit, unnest(gaps[1 : len(hits)]) AS gap, unnest(range(len(hits))) AS i
  FROM m WHERE len(hits) > 0),
p AS (
  SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop FROM s),
c AS (
  SELECT *, stop - length(hit) AS start, regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
    lower(t[greatest(stop - length(hit) - 39, 1) : stop - length(hit)] || ' ' || t[stop + 1 : stop + 40]) AS near FROM p),
f AS (SELECT doc_id, kind, no, start, stop FROM c WHERE CASE kind {keep} END)
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) FILTER (no < {base}), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no), '') AS spans
FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""


_ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)".replace('\\"', '"')
OP9 = _spans(
    [
        ("assign", _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6"),
        ("access", "AKIA[A-Z0-9]+", "length(hit) >= 20"),
        ("hex", "[0-9a-f]+", "length(hit) >= 24"),
        ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", "TRUE"),
        ("prefixed", "(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", "TRUE"),
    ],
    3,
)

_LUHN = """list_sum(list_transform(range(length(digits)), lambda k: CASE WHEN k % 2 = 0
  THEN CAST(digits[length(digits) - k] AS INT)
  ELSE 2 * CAST(digits[length(digits) - k] AS INT) - 9 * CAST(digits[length(digits) - k] > '4' AS INT) END)) % 10 = 0"""
_MOD_97 = """list_reduce(list_prepend(0, list_transform(string_split(hit[5:] || hit[1:4], ''),
  lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN CAST(x AS INT) ELSE ascii(x) - 55 END)),
  lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"""
OP10 = _spans(
    [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
        (
            "ip",
            r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
            "list_max(list_transform(string_split(hit, '.'), lambda x: coalesce(try_cast(x AS BIGINT), 256))) <= 255",
        ),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length(digits) BETWEEN 14 AND 19 AND {_LUHN}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 10 AND 15"),
        ("account", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", _MOD_97),
        (
            "national_id",
            r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
            r"regexp_matches(near, '\b(ssn|social|security|identity)\b')",
        ),
    ],
    4,
)

# Every string of 100 bytes by place, as hexadecimal; those not first in the order of places cover what goes.
OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, a, md5(h[2 * a + 1 : 2 * a + 200]) AS s
  FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS a FROM d)),
r AS (SELECT doc_id, a FROM (SELECT doc_id, a, row_number() OVER (PARTITION BY s ORDER BY doc_id, a) AS n FROM w) WHERE n > 1),
e AS (SELECT doc_id, a, lag(a) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
g AS (SELECT doc_id, a, sum(CASE WHEN a <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a) AS no FROM e),
spans AS (SELECT doc_id, no, min(a) AS lo, max(a) + 100 AS hi FROM g GROUP BY doc_id, no),
cut AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS from_,
    row_number() OVER (PARTITION BY doc_id ORDER BY lo DESC) = 1 AS last FROM spans),
kept AS (
  SELECT c.doc_id, string_agg(h[2 * from_ + 1 : 2 * lo], '' ORDER BY lo) || max(CASE WHEN last THEN h[2 * hi + 1 :] ELSE '' END) AS k,
    sum(hi - lo) AS n_removed, count(*) AS n_spans
  FROM cut c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; needs ``entries`` of the one-row table crc_table in scope."""
    octets = f"list_transform(range(length(hex(encode({text}))) // 2), lambda byte_no: ('0x' || substr(hex(encode({text})), 2 * byte_no + 1, 2))::BIGINT)"
    step = "xor(c >> 8, entries[CAST(xor(c, b) & 255 AS INT) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295)"


_BIT = "xor(c >> 1, 3988292384 * (c & 1))"
CRC_TABLE = f"""
crc_table AS (
  SELECT list(c ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: {_BIT}) AS c FROM range(256) AS r(i)))"""

# letters that are not a to z, as single bytes, so that byte edits are code point edits
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(c for c in map(chr, range(33, 127)) if c not in "abcdefghijklmnopqrstuvwxyz'")[:64]

OP11 = f"""
WITH RECURSIVE {CRC_TABLE.strip()},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS i,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents),
counted AS (SELECT i, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT *, {_crc32("i || ':' || run")} AS h FROM counted, crc_table),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{_WIDE}', '{_NARROW}') AS narrow
  FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
-- two words one edit apart are one word, or become one, where a letter of either is deleted
shorter AS (
  SELECT word, n, narrow, narrow AS rest FROM words UNION ALL
  SELECT DISTINCT word, n, narrow, substr(narrow, 1, k - 1) || substr(narrow, k + 1)
  FROM (SELECT *, unnest(range(1, length(narrow) + 1)) AS k FROM words)),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
  FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.word <> b.word WHERE levenshtein(a.narrow, b.narrow) = 1),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
formed AS (
  SELECT pairs.word, min(near ORDER BY encode(near)) AS form, any_value(top) AS form_n
  FROM pairs JOIN best ON best.word = pairs.word AND near_n = top WHERE top >= 10 * n GROUP BY pairs.word),
path AS (
  SELECT word, word AS reached, 0 AS steps FROM words UNION ALL
  SELECT path.word, form, steps + 1 FROM path JOIN formed ON formed.word = path.reached)
SELECT words.word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN best ON best.word = words.word LEFT JOIN formed ON formed.word = words.word
JOIN (SELECT word, arg_max(reached, steps) AS root FROM path GROUP BY word) AS roots ON roots.word = words.word
"""


OP12 = f"""
WITH RECURSIVE {CRC_TABLE.strip()},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      unhex(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, p, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1, p, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.p > c.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS size, list(struct_pack(role := role, text := text)) OVER w AS prefix
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
lengths AS (SELECT conv_id, max(depth) AS own FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (own = depth), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY prefix, depth),
-- a conversation's node at a depth is named by the first conversation that has it
named AS (
  SELECT p.conv_id AS member, n.depth, n.conv_id, n.n_convs, n.size, n.ends_sha256
  FROM prefixes AS p JOIN nodes AS n ON n.prefix = p.prefix),
parents AS (
  SELECT c.conv_id, c.depth, c.n_convs, c.size, c.ends_sha256, p.conv_id AS parent_conv_id
  FROM (SELECT * FROM named WHERE member = conv_id) AS c LEFT JOIN named AS p ON p.member = c.conv_id AND p.depth = c.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM parents WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
  SELECT parents.*, coalesce(n, 0) AS n_children FROM parents LEFT JOIN children USING (conv_id, depth)),
sums AS (
  SELECT above.conv_id, above.depth, count(*) FILTER (low.n_children = 0) AS n_leaves, sum((low.n_convs - 1) * low.size) AS saved
  FROM full_nodes AS low JOIN named AS above ON above.member = low.conv_id AND above.depth <= low.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM full_nodes JOIN sums USING (conv_id, depth)
"""


OP13 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op4_suffix": OP4,
    "op5_warc": OP5,
    "op8_quality": OP8,
    "op9_secrets": OP9,
    "op10_pii": OP10,
    "op11_spelling": OP11,
    "op12_prefixes": OP12,
    "op13_topk": OP13,
}
