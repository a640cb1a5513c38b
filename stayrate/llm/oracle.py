"""The queries that SQL can express, as SQL for another engine on the same tables."""

from __future__ import annotations

import re
import string

from stayrate.llm.chat import CLOSE, CONTROL, OPEN
from stayrate.llm.hard_negatives import LARGEST, Mining
from stayrate.llm.queries import PROBE
from stayrate.llm.secret_scan import ACCESS, ACCESS_LENGTH, ASSIGN, ASSIGN_LENGTH, CANDIDATE, HEX, HEX_LENGTH, KINDS, PATH, Entropy

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
SPACED = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str, pattern: str, source: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, regexp_extract_all({text}, {quoted(pattern)}) AS words FROM {source}"


# --- 3 ----------------------------------------------------------------------

_PROBE = " UNION ALL ".join(f"SELECT {c}, {t}, {quoted(r)}, {quoted(x)}" for c, t, r, x in PROBE)
_ANY_CONTROL = quoted("|".join(re.escape(x) for x in CONTROL))


def _escaped_length(column: str) -> str:
    return (
        f"length({column}) + len(regexp_extract_all({column}, '\\\\'))"
        f" + len(regexp_extract_all({column}, {_ANY_CONTROL}))"
    )


CHAT = f"""
WITH every AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL {_PROBE}),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
  count(*) OVER (PARTITION BY conv_id) AS n FROM every),
l AS (SELECT *, {len(OPEN) + 1 + len(CLOSE) + 1} + {_escaped_length("role")} + len(regexp_extract_all(role, chr(10)))
  + {_escaped_length("text")} AS size FROM t),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS prefix, role = 'assistant' AS reply FROM l)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (reply), '')) AS loss_sha256,
  CAST(sum(prefix) FILTER (reply OR place = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (reply OR place = n) AS n_examples
FROM p GROUP BY conv_id"""

# --- 5 ----------------------------------------------------------------------

NEAR = f"""
WITH RECURSIVE d AS ({words(LOWER, SPACED)}),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 2
    THEN list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) ELSE words END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * k >= 80 * (na.n + nb.n - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, a FROM both_ways UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON other = a),
found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN found ON d.doc_id = found.doc_id"""

# --- 6 ----------------------------------------------------------------------

REPEATS = f"""
WITH d AS ({words("coalesce(text, '')", SPACED)}),
w AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d),
o AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(words[i:i + 49], ' ')) AS first FROM w),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM o WHERE first < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d),
marked AS (SELECT each.*, hit.place IS NOT NULL AS gone FROM each
  LEFT JOIN hit ON each.doc_id = hit.doc_id AND each.place = hit.place),
kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

# --- 7 ----------------------------------------------------------------------

NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAKS = f"""
WITH d AS ({words(LOWER, NORMAL)}),
b AS ({words(LOWER, NORMAL, "benchmark", "item_id")}),
bw AS (SELECT item_id, words, least(10, len(words)) AS size, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM bw),
dw AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT size FROM windows)),
met AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN windows ON phrase = array_to_string(words[i:i + dw.size - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

# --- 10 ---------------------------------------------------------------------

_E = Entropy()


def _matches(name: str, pattern: str, keep: str) -> str:
    """Places of matches, from the lengths of the matches and of the gaps between them."""
    return f"""{name}_all AS (SELECT doc_id, unnest(regexp_extract_all(text, {quoted(pattern)})) AS m,
    unnest(list_slice(string_split_regex(text, {quoted(pattern)}), 1, len(regexp_extract_all(text, {quoted(pattern)})))) AS gap,
    unnest(range(1, len(regexp_extract_all(text, {quoted(pattern)})) + 1)) AS i FROM d),
{name} AS (SELECT * FROM (SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM {name}_all) WHERE {keep})"""


_ALLOWED = " OR ".join(f"regexp_matches(m, {quoted(p)})" for p in _E.allow)
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_matches("assign", ASSIGN, f"length(regexp_extract(m, {quoted(ASSIGN)}, 2)) >= {ASSIGN_LENGTH}")},
{_matches("access", ACCESS, f"length(m) >= {ACCESS_LENGTH}")},
{_matches("hex", HEX, f"length(m) >= {HEX_LENGTH}")},
{_matches("candidate", CANDIDATE, f"regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT ({_ALLOWED})")},
known AS (SELECT doc_id, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, 0 AS kind FROM assign
  UNION ALL SELECT doc_id, stop - length(m), stop, 1 FROM access UNION ALL SELECT doc_id, stop - length(m), stop, 2 FROM hex),
slid AS (SELECT doc_id, m, stop - length(m) AS start, unnest(range(1, length(m) - {_E.width} + 2)) AS i FROM candidate),
letters AS (SELECT doc_id, m, start, i, unnest(string_split(substring(m, i, {_E.width}), '')) AS c FROM slid),
counted AS (SELECT doc_id, m, start, i, c, count(*) AS n FROM letters GROUP BY ALL),
measured AS (SELECT doc_id, m, start, i, substring(m, i, {_E.width}) AS w, -sum(n / {_E.width}.0 * log2(n / {_E.width}.0)) AS bits
  FROM counted GROUP BY ALL),
hot AS (SELECT doc_id, CAST(start + min(i) - 1 AS BIGINT) AS start, CAST(start + max(i) - 1 + {_E.width} AS BIGINT) AS stop,
  CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN 3 ELSE 4 END AS kind FROM measured
  WHERE length(regexp_replace(w, '[^0-9]', '', 'g')) >= {_E.digits} AND regexp_matches(w, '[A-Za-z]')
    AND bits >= CASE WHEN regexp_full_match(w, '[0-9a-fA-F]+') THEN {_E.hex_bits}
      WHEN regexp_matches(w, '[A-Z]') AND regexp_matches(w, '[a-z]') THEN {_E.mixed_bits} ELSE {_E.one_case_bits} END
  GROUP BY doc_id, measured.start, m HAVING NOT regexp_matches(m, {quoted(PATH)}) OR count(*) FILTER (NOT contains(w, '/')) > 0),
new AS (SELECT * FROM hot WHERE NOT EXISTS (
  SELECT 1 FROM known k WHERE k.doc_id = hot.doc_id AND k.start <= hot.start AND hot.stop <= k.stop)),
listed AS (SELECT *, (['{"', '".join(KINDS)}'])[kind + 1] || ':' || start || ':' || stop AS span FROM (SELECT * FROM known UNION ALL SELECT * FROM new))
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind <= 2), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN listed ON d.doc_id = listed.doc_id GROUP BY d.doc_id"""

# --- 11 ---------------------------------------------------------------------

#: Levels written out: enough for 8 ** 9 documents of a language, and 8 ** 3 languages.
_LEVELS, _LANG_LEVELS = 9, 3
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(text: str) -> str:
    values = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


#: The CRC-32 of a doc_id's decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
    lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, byte)),
    CAST(4294967295 AS BIGINT)))"""


def _climb(name: str, levels: int) -> str:
    """Levels above {name}0 (tree, pos, digest, n), and for every node the digests beside it in its run."""
    beside = """coalesce(string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN {}), '')"""
    steps = []
    for k in range(levels):
        steps.append(f"""{name}{k}s AS (SELECT tree, pos, {beside.format("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS l,
    {beside.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS r FROM {name}{k} WHERE n > 1)""")
        steps.append(f"""{name}{k + 1} AS (SELECT tree, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest,
    (any_value(n) + 7) // 8 AS n FROM {name}{k} WHERE n > 1 GROUP BY tree, pos // 8)""")
    tops = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    return ",\n".join([*steps, f"{name}_tops AS ({tops})"])


def _fold(name: str, levels: int, before: str, tree: str, place: str) -> str:
    """{name}w: the rows of `before` with sibs and folded carried up through the levels."""
    steps, last = [], before
    for k in range(levels):
        at = f"{name}w" if k == levels - 1 else f"{name}w{k}"
        steps.append(f"""{at} AS (SELECT w.* REPLACE (sibs || coalesce(s.l || s.r, '') AS sibs,
    CASE WHEN s.tree IS NULL THEN folded ELSE sha256(s.l || folded || s.r) END AS folded)
  FROM {last} w LEFT JOIN {name}{k}s s ON s.tree = w.{tree} AND s.pos = w.{place} // {8**k})""")
        last = at
    return ",\n".join(steps)


MERKLE = f"""
WITH d AS (SELECT *, {_digest("text")} AS leaf, {_digest("translate(text, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "')")} AS lowered,
  {_CRC} % 3 = 0 AS tampered, coalesce('+' || lang, '') AS tree FROM documents),
placed AS (SELECT doc_id, leaf, tree, CASE WHEN tampered THEN lowered ELSE leaf END AS claimed,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
a0 AS (SELECT tree, pos, leaf AS digest, n FROM placed),
{_climb("a", _LEVELS)},
b0 AS (SELECT '' AS tree, tree AS lang_tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, count(*) OVER () AS n FROM a_tops),
{_climb("b", _LANG_LEVELS)},
start AS (SELECT p.doc_id, p.leaf, p.tree, p.pos, b0.digest AS subroot, '' AS whole, b0.pos AS lang_pos, '' AS sibs, claimed AS folded
  FROM placed p JOIN b0 ON b0.lang_tree = p.tree),
{_fold("a", _LEVELS, "start", "tree", "pos")},
{_fold("b", _LANG_LEVELS, "aw", "whole", "lang_pos")}
SELECT doc_id, leaf, subroot, digest AS root, sha256(sibs) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM bw JOIN b_tops ON b_tops.tree = bw.whole"""

# --- 12 ---------------------------------------------------------------------

_M = Mining()
NEGATIVES = f"""
WITH e AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) > {LARGEST // 256})) = 0),
scored AS (SELECT a.row, a.vec_id AS anchor_id, o.row AS other, o.vec_id, a.label = o.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.vector, o.vector), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM e a JOIN e o ON a.vec_id % 100 = 0 AND a.row <> o.row),
positives AS (SELECT row, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST, other) AS place
  FROM scored WHERE same QUALIFY place <= {_M.positives}),
negatives AS (SELECT p.row, p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.row, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.row = p.row AND NOT s.same
    AND {_M.least} * positive_score <= 100 * s.score AND 100 * s.score <= {_M.most} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {_M.negatives}"""

ORACLE = {
    "op3_prefix_target": CHAT,
    "op5_tensored_minhash": NEAR,
    "op6_phrase_automata": REPEATS,
    "op7_benchmark_windows": LEAKS,
    "op10_secret_entropy": SECRETS,
    "op11_merkle_descent": MERKLE,
    "op12_coordinate_pruning": NEGATIVES,
}
