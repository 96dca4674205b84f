"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .op03_secrets import BASE, RULES
from .op06_mixing import BITS, LEVELS
from .op07_licenses import COPYRIGHT, NOTICES, SPELLINGS, whole_texts
from .op08_sharding import SHARDS, TABLE_SIZE, fill_table

W = r"[^\x20\x09-\x0D]+"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for i, rule in enumerate(RULES):
        p = _quoted(rule.pattern)
        # capturing groups would be kept by the split, so positions come from the matches' own text
        parts.append(
            f"SELECT doc_id, {i} AS ord, '{rule.kind}' AS kind, unnest(range(len(m))) AS nth, m, g, t FROM "
            f"(SELECT doc_id, t, regexp_extract_all(t, {p}, 0) AS m, regexp_extract_all(t, {p}, {rule.group}) AS g FROM d WHERE regexp_matches(t, {_quoted(rule.hint)})) WHERE len(m) > 0"
        )
    least = " ".join(f"WHEN {i} THEN {rule.least}" for i, rule in enumerate(RULES))
    joined = "coalesce(string_agg({0}, ',' ORDER BY s, ord), '')".format("kind || ':' || s || ':' || (s + n)")
    base = "coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, ord) FILTER (kind IN ('assign', 'access', 'hex')), '')"
    gap = " ".join(f"WHEN {i} THEN len(string_split_regex(t, {_quoted(rule.pattern)})[nth + 1])" for i, rule in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(parts)}),
sized AS (SELECT doc_id, ord, kind, nth, len(m[nth + 1]) AS n, len(g[nth + 1]) AS tested, CASE ord {gap} END AS gap FROM raw),
placed AS (SELECT *, sum(gap + n) OVER (PARTITION BY doc_id, ord ORDER BY nth) - n AS s FROM sized),
hits AS (SELECT doc_id, ord, kind, CAST(s AS BIGINT) AS s, n FROM placed WHERE tested >= CASE ord {least} END),
found AS (SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {joined} AS spans FROM hits GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)"""


_MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{W}')), 0) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS * LEVELS // 4}) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
  row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s),
c AS (SELECT *, CAST(source_size * 2 AS DOUBLE) AS cap, CAST(source_size * 2 AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT *, (CAST((SELECT sum(source_size) FROM s) AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0.0::DOUBLE)) / ((SELECT sum(weight) FROM c) - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level
  FROM c WINDOW b AS (ORDER BY ratio, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM l WHERE ratio >= level) * weight, cap)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
x AS (SELECT d.*, r.source_size, r.target, r.copies, r.target - r.copies * r.source_size AS rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
  sum(size) OVER (PARTITION BY d.source, h) AS own FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
e AS (SELECT *, min(CASE WHEN upto > rest THEN h END) OVER (PARTITION BY source) AS edge FROM x)
SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE
  WHEN h < edge THEN 1 WHEN h = edge AND upto - rest < rest - (upto - own) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM e"""


def _form(x: str) -> str:
    spelt = f"lower({x})"
    for pattern, to in SPELLINGS:
        spelt = f"regexp_replace({spelt}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return f"CASE WHEN regexp_matches(lower({x}), {_quoted(COPYRIGHT)}) THEN '' ELSE trim(regexp_replace({spelt}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) END"


def _licenses() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(t)})" for name, ts in [*NOTICES.items(), *((k, [v]) for k, v in whole_texts())] for t in ts)
    lines = "list_filter(list_transform(string_split({0}, chr(10)), lambda x: {1}), lambda x: x <> '')"
    return f"""
WITH k AS (SELECT sha256(array_to_string({lines.format("t", _form("x"))}, ' ')) AS digest, min(id) AS license_id FROM (VALUES {known}) v(id, t) GROUP BY 1),
d AS (SELECT doc_id, {lines.format("coalesce(text, '')", _form("x"))} AS ls FROM documents),
n AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n_notices
  FROM (SELECT doc_id, sha256(unnest(ls)) AS digest FROM d) JOIN k USING (digest) GROUP BY doc_id),
w AS (SELECT doc_id, sha256(array_to_string(ls, ' ')) AS digest FROM d)
SELECT w.doc_id, w.digest, k.license_id, coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM w LEFT JOIN k USING (digest) LEFT JOIN n ON n.doc_id = w.doc_id"""



def _shards() -> str:
    owners = ",".join(map(str, fill_table(SHARDS)))
    return f"""
WITH o AS (SELECT string_split('{owners}', ',') AS owners), t AS (SELECT unnest(range({TABLE_SIZE})) AS slot, unnest(owners) AS owner FROM o),
d AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) % {TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, CAST(slot AS INT) AS slot, 'shard-' || lpad(owner, 4, '0') AS shard FROM d JOIN t USING (slot)"""


def _jaccard(k: int, percent: int, more: str = "") -> str:
    shingle = " || ' ' || ".join(["w[i]", *(f"w[i + {j}]" for j in range(1, k))])
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE
  list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: {shingle})) END AS s FROM d),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * common >= {percent} * (len(x.s) + len(y.s) - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id{more} FROM s JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY 1) c ON c.node = s.doc_id"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{W}') AS x FROM d)),
g AS (SELECT *, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1 AS twice FROM g),
k AS (SELECT *, twice OR coalesce(lag(twice) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
ws AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars, count(*) FILTER (hit) AS n_repeat_words FROM k GROUP BY doc_id),
l AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS nth FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '{W}') GROUP BY doc_id),
f AS (SELECT doc_id, source, line, nth, regexp_extract_all(regexp_replace(regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'), '[0-9]', '0', 'g'), '[!-/:-@\[-`{{-~]', ' ', 'g'), '{W}') AS x FROM l),
n AS (SELECT doc_id, source, array_to_string(x, ' ') AS form, sum(len(x)) AS n FROM f WHERE len(x) > 0 GROUP BY 1, 2, 3),
h AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
common AS (SELECT n.source, form FROM n JOIN h ON h.source IS NOT DISTINCT FROM n.source GROUP BY n.source, form, h.docs HAVING count(*) > 10 AND count(*) > h.docs * 0.02::DOUBLE),
gone AS (SELECT n.doc_id, CAST(sum(n.n) AS BIGINT) AS removed FROM n JOIN common c ON c.form = n.form AND c.source IS NOT DISTINCT FROM n.source GROUP BY 1),
total AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY 1),
less AS (SELECT f.doc_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (c.form IS NULL), '')) AS clean_sha256
  FROM f LEFT JOIN common c ON c.form = array_to_string(x, ' ') AND len(x) > 0 AND c.source IS NOT DISTINCT FROM f.source GROUP BY 1),
a AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
  CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed_words, coalesce(total, 0) AS total, clean_sha256
  FROM d LEFT JOIN less USING (doc_id) LEFT JOIN ws USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id) LEFT JOIN total USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, removed_words, clean_sha256,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (removed_words > 0 AND (total - removed_words < 50 OR total - removed_words < total * 0.5::DOUBLE)) AS kept FROM a"""

_ENOUGH = "a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50"
_LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS nth FROM documents),
c AS (SELECT doc_id, nth, line, len(regexp_extract_all(line, '{W}')) AS words, row_number() OVER o AS i, sum(len(regexp_extract_all(line, '{W}'))) OVER o AS upto
  FROM l WHERE regexp_matches(line, '{W}') WINDOW o AS (PARTITION BY doc_id ORDER BY nth)),
w AS (SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM c a JOIN c b ON {_ENOUGH} GROUP BY 1, 2 UNION SELECT b.doc_id, max(a.i), b.i FROM c a JOIN c b ON {_ENOUGH} GROUP BY 1, 3),
t AS (SELECT w.doc_id, w.a, min(c.nth) AS lo, max(c.nth) AS hi, string_agg(c.line, chr(10) ORDER BY c.i) AS run FROM w JOIN c ON c.doc_id = w.doc_id AND c.i BETWEEN w.a AND w.b GROUP BY w.doc_id, w.a, w.b),
h AS (SELECT *, min({{'d': doc_id, 'a': a, 'hi': hi}}) OVER (PARTITION BY run) AS head FROM t),
g AS (SELECT doc_id, CASE WHEN head.d = doc_id THEN greatest(lo, head.hi + 1) ELSE lo END AS lo, hi FROM h WHERE head.d <> doc_id OR head.a <> a),
k AS (SELECT l.*, EXISTS (SELECT 1 FROM g WHERE g.doc_id = l.doc_id AND l.nth BETWEEN g.lo AND g.hi) AS gone FROM l)
SELECT d.doc_id, coalesce(removed, 0) AS removed_lines, coalesce(sha, sha256('')) AS text_sha256 FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone AND regexp_matches(line, '{W}')) AS removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS sha FROM k GROUP BY 1) x USING (doc_id)"""


def _clusters(dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64) -> str:
    """Every vector against every centroid, in every round."""
    nearest = """a{n} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS best FROM (
  SELECT r, c, list_sum(list_transform(range(1, {past}), lambda i: (v.x[i] - m{n}.x[i]) * (v.x[i] - m{n}.x[i]))) AS d FROM v, m{n}) GROUP BY r)"""
    mean = """s{n} AS (SELECT best.c AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{n} JOIN v USING (r), range(1, {past}) t(i) GROUP BY 1, 2),
m{next} AS MATERIALIZED (SELECT c, coalesce((SELECT list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) FROM s{n} WHERE s{n}.c = m{n}.c), m{n}.x) AS x FROM m{n})"""
    steps = [t.format(n=n, next=n + 1, past=dims + 1) for n in range(rounds) for t in (nearest, mean)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k})),
{", ".join(steps)},
{nearest.format(n=rounds, past=dims + 1)}
SELECT vec_id, CAST(best.c AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN m{rounds} m ON m.c = best.c"""


#: CRC-32 of a text of ASCII characters; the polynomial, bits reversed.
_CRC = "xor(list_reduce(list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: list_reduce(range(8), lambda d, _: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END, xor(c, b)), 4294967295), 4294967295)"
_GO = "{{'c': {0}.c + {1}, 'e': {0}.e || '{2}'}}"
_FAR = "1000000000000"
_BLANKS = r"[\x20\x09-\x0D]"
#: The cheapest edits that lead to each of four states, turn by turn.
_REPAIR = rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
f AS (SELECT *, {_CRC.format("k")} % 20 AS fate FROM o),
g AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS ini FROM g),
t AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN right(regexp_replace(text, '{_BLANKS}+$', ''), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  coalesce(lag(ini) OVER w || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
z AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'e': ''}} AS n, {{'c': CAST({_FAR} AS BIGINT), 'e': ''}} AS s, {{'c': CAST(3 AS BIGINT), 'e': 'I'}} AS u, {{'c': CAST(6 AS BIGINT), 'e': 'IJ'}} AS a FROM z
  UNION ALL SELECT conv_id, i, n, s, u, least(a, {_GO.format("u", 3, "J")}) FROM (
    SELECT conv_id, i, n, s, least(u, {_GO.format("least(n, s, a)", 3, "I")}) AS u, a FROM (
      SELECT conv_id, i, {_GO.format("n", 4, "D")} AS n, least({_GO.format("s", 4, "D")}, {_GO.format("n", "keep_s", "K")}) AS s,
        least({_GO.format("u", 4, "D")}, {_GO.format("b", "keep_u", "K")}, {_GO.format("b", "more + 3", "R")}) AS u,
        least({_GO.format("a", 4, "D")}, {_GO.format("u", "keep_a", "K")}, {_GO.format("u", "more + 3", "S")}) AS a
      FROM (SELECT *, CASE WHEN ini = 's' THEN more ELSE {_FAR} END AS keep_s, CASE WHEN ini = 'u' THEN more ELSE {_FAR} END AS keep_u, CASE WHEN ini = 'a' THEN more ELSE {_FAR} END AS keep_a
        FROM (SELECT walk.conv_id, t.i, n, s, u, a, least(n, s, a) AS b, ini, CASE fault WHEN 'truncated' THEN 3 WHEN '' THEN 0 ELSE {_FAR} END AS more
          FROM walk JOIN t ON t.conv_id IS NOT DISTINCT FROM walk.conv_id AND t.i = walk.i + 1))))),
best AS (SELECT conv_id, least(n, a) AS b FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM walk) WHERE last = 1),
e AS (SELECT conv_id, unnest(string_split(b.e, '')) AS e, unnest(range(1, len(b.e) + 1)) AS place FROM best WHERE b.e <> ''),
p AS (SELECT *, count(*) FILTER (e IN ('D', 'K', 'R', 'S')) OVER (PARTITION BY conv_id ORDER BY place) AS i FROM e),
r AS (SELECT p.conv_id, place, CASE e WHEN 'I' THEN 'user:' WHEN 'J' THEN 'assistant:' WHEN 'R' THEN 'user:' || text WHEN 'S' THEN 'assistant:' || text ELSE role || ':' || text END AS line
  FROM p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = greatest(p.i, 1) WHERE e <> 'D'),
d AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS sha FROM r GROUP BY 1),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM t GROUP BY 1)
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  b.c AS cost, translate(b.e, 'JS', 'IR') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM z JOIN best ON best.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM z.conv_id LEFT JOIN d ON d.conv_id IS NOT DISTINCT FROM z.conv_id"""

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_join": _jaccard(3, 90),
    "op3_secret_scan": _secrets(),
    "op6_mixing": _MIX,
    "op7_license_scan": _licenses(),
    "op8_sharding": _shards(),
    "op9_quality_rules": _QUALITY,
    "op10_line_dedup": _LINES,
    "op11_centroid_clustering": _clusters(),
    "op12_conversation_repair": _REPAIR,
    "op13_minhash_dedup": _jaccard(4, 80, ", s.doc_id = c.component_id AS kept"),
}
