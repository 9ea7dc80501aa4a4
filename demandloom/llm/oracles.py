"""SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from .centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE
from .centroids import SEED as CLUSTER_SEED
from .hosts import BLOCK_ABOVE, REGISTRY, RHO, Z
from .mixing import MAX_COPIES, SEED, WEIGHTS
from .queries import URL_RULES

WORD = r"[^\x20\x09-\x0D]+"


def _rule(what: str) -> str:
    cases = []
    for r in sorted(URL_RULES, key=lambda r: (-len(r.text), r.text)):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        cases.append(f"WHEN {fits} THEN '{getattr(r, what)}'")
    return f"CASE {' '.join(cases)} END"


def _level(name: str, rows: str, prior: str, known: str, out: str) -> str:
    """One level of shrinkage: the weight from the members' spread, then each one's mean and pages."""
    return f"""
{name}_w AS (SELECT 1 / least(greatest(CASE WHEN most > 0 THEN over_ / most ELSE {RHO[0]} END, {RHO[0]}), {RHO[1]}) - 1 AS w
  FROM (SELECT sum((k - n * {prior}) ** 2 - n * {prior} * (1 - {prior})) AS over_,
    sum(n * (n - 1) * {prior} * (1 - {prior})) AS most FROM {rows})),
{name} AS (SELECT *, (k + w * {prior}) / (n + w) AS {out}, n + least(w, {known} - n) AS {out}_pages FROM {rows}, {name}_w)"""


OP5 = f"""
WITH parts AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
ruled AS (SELECT *, {_rule('text')} AS rule, {_rule('verdict')} AS rule_verdict FROM parts),
bare AS (SELECT *, regexp_replace(host, '\\.?(:\\d*)?$', '') AS name FROM ruled),
labels_ AS (SELECT *, string_split(name, '.') AS l,
    regexp_matches(name, '(^|\\.)({REGISTRY})\\.[a-z][a-z]$') AS third FROM bare),
levels AS (SELECT *, CASE WHEN third THEN l[-2] || '.' || l[-1] ELSE l[-1] END AS suffix,
    array_to_string(CASE WHEN third THEN l[-3:] ELSE l[-2:] END, '.') AS domain FROM labels_),
hosts AS (SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix,
    count(rule)::double AS n, (count(*) FILTER (rule_verdict = 'block'))::double AS k
  FROM levels GROUP BY host),
overall AS (SELECT (sum(k) + 0.5) / (sum(n) + 1) AS m, sum(n) + 1 AS m_pages FROM hosts),
suffix_rows AS (SELECT suffix, n, k, m, m_pages FROM (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix), overall),
{_level('suffixes', 'suffix_rows', 'm', 'm_pages', 'suffix_mean')},
domain_rows AS (SELECT d.*, suffix_mean, suffix_mean_pages FROM (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix) d
  JOIN suffixes USING (suffix)),
{_level('domains', 'domain_rows', 'suffix_mean', 'suffix_mean_pages', 'domain_mean')},
host_rows AS (SELECT h.*, domain_mean, domain_mean_pages FROM hosts h JOIN domains USING (domain)),
{_level('posterior', 'host_rows', 'domain_mean', 'domain_mean_pages', 'mean_')}
SELECT page_id, host, path, rule, coalesce(rule_verdict,
  CASE WHEN mean_ - {Z} * sqrt(mean_ * (1 - mean_) / (mean__pages + 1)) > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM levels JOIN posterior USING (host)"""

OP6 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM texts)),
sizes AS (SELECT doc_id, count(s) AS n FROM texts LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached AS (SELECT doc_id, doc_id AS r FROM texts UNION SELECT doc_id, b FROM reached JOIN links ON r = a)
SELECT doc_id, n AS n_shingles, component_id FROM sizes
JOIN (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)"""

OP4 = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
at_ AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM at_ WHERE i + 2 <= len(w)),
repeated AS (SELECT r, count(DISTINCT i + d) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '{WORD}') GROUP BY r),
pairs AS (SELECT r, max((length(a) + length(b)) * n) AS top
  FROM (SELECT r, w[i] AS a, w[i + 1] AS b, count(*) AS n FROM at_ WHERE i < len(w) GROUP BY ALL HAVING n > 1) GROUP BY r),
counts AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
    coalesce(p.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines, coalesce(top, 0) AS top,
    len([x for x in w if regexp_matches(x, '\\p{{L}}')]) AS lettered,
    length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) AS upper_, length(regexp_replace(t, '\\P{{Ll}}', '', 'g')) AS lower_
  FROM texts LEFT JOIN lines l USING (r) LEFT JOIN repeated p USING (r) LEFT JOIN pairs USING (r)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR NOT (word_chars BETWEEN 2.5 * n_words AND 12 * n_words) OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 4 * n_lines OR 10 * lettered < 7 * n_words OR 10 * top > 3 * word_chars
    OR (10 * upper_ > 6 * (upper_ + lower_) AND upper_ + lower_ > 0)) AS kept
FROM failed"""

OP3 = f"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    ('0x' || md5(concat('{SEED}:', coalesce(doc_id::varchar, ''), ':', coalesce(text, '')))[1:13])::bigint AS draw FROM documents),
classed AS (SELECT *, floor(log2(greatest(size, 1)))::int AS octave FROM docs),
sources AS (SELECT source, sum(size)::bigint AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, [{', '.join(f'{float(w)}::double' for w in WEIGHTS)}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight,
    source_size * {float(MAX_COPIES)}::double AS cap FROM sources),
shares AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source)),
share AS (SELECT max(c) FILTER (c * weight < cap) AS s FROM shares),
targets AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN least(cap, coalesce(s, 0) * weight) ELSE 0 END AS target
  FROM weighted, share),
classes AS (SELECT source, octave, sum(size)::bigint AS words, pow(2.0::double, octave / 2) AS pull FROM classed GROUP BY source, octave),
solved AS (SELECT k.*, target, (target - coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {float(MAX_COPIES)}::double)
    / nullif(sum(words * pull) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS c
  FROM classes k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source WINDOW o AS (PARTITION BY k.source ORDER BY octave DESC)),
copies AS (SELECT source, octave, words, target, least({float(MAX_COPIES)}::double, coalesce(
    max(c) FILTER (c >= 0 AND c * pull <= {float(MAX_COPIES)}) OVER (PARTITION BY source) * pull, {float(MAX_COPIES)}::double)) AS copies FROM solved),
needs AS (SELECT source, any_value(target) - sum(words * floor(copies)) AS need FROM copies GROUP BY source),
placed AS (SELECT d.*, floor(copies) AS whole, copies - floor(copies) AS p, (draw + 0.5) / 4503599627370496.0::double AS u
  FROM classed d JOIN copies c ON d.source IS NOT DISTINCT FROM c.source AND d.octave = c.octave),
ranked AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN u / (1 - u) / (p / (1 - p)) END AS q FROM placed),
running AS (SELECT *, CASE WHEN q IS NOT NULL THEN sum(CASE WHEN q IS NOT NULL THEN size END) OVER
    (PARTITION BY source ORDER BY q / (1 + q) NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto FROM ranked)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN whole + coalesce((upto - size / 2 <= need)::int, 0) ELSE 0 END)::bigint AS copies,
  (CASE WHEN size > 0 THEN whole + coalesce((upto - size / 2 <= need)::int, 0) ELSE 0 END)::bigint * size AS taken
FROM running r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source JOIN needs n ON r.source IS NOT DISTINCT FROM n.source"""


#: crc32 of a number's decimal digits: bytes are taken in, each followed by eight shifts.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
  string_split(CAST({} AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""

OP11 = f"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, {CRC32.format("conv_id")} % 9 AS h, conv_id - conv_id % 5 AS base FROM turns),
rebuilt AS (SELECT c.conv_id, 0 AS own, t.place, t.digest, strlen(t.text) AS size
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, t.place, t.digest, strlen(t.text)
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
steps AS (SELECT conv_id, size, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)),
prefixes AS (SELECT conv_id, depth, path, size FROM steps UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size
  FROM prefixes GROUP BY path, depth),
lengths AS (SELECT conv_id, max_by(path, depth) AS path FROM prefixes GROUP BY conv_id),
ended AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM lengths GROUP BY path),
children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes
  WHERE depth > 0 GROUP BY ALL),
valued AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)),
above AS (SELECT left(path, 32 * up) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT path, n_children, n_convs, size, unnest(range(0, depth + 1)) AS up FROM valued) GROUP BY ALL)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
  CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM valued v JOIN above a USING (path) LEFT JOIN ended e USING (path)
LEFT JOIN nodes p ON v.depth > 0 AND p.path = left(v.path, 32 * (v.depth - 1))
"""

#: Floor of a quotient of whole numbers, the divisor positive.
FLOOR_MEAN = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def _round(n: int) -> str:
    """Vectors to the centroids of the round before, then the means of those that have vectors."""
    return f"""
near{n} AS (SELECT row, distance, cluster FROM (
    SELECT v.row, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance,
      row_number() OVER (PARTITION BY v.row ORDER BY distance, c.cluster) AS place
    FROM numbers v JOIN centroids{n} c USING (k) GROUP BY v.row, c.cluster) WHERE place = 1),
means{n} AS (SELECT cluster, k, {FLOOR_MEAN} AS x FROM near{n} JOIN numbers USING (row) GROUP BY cluster, k),
centroids{n + 1} AS (SELECT c.cluster, c.k, coalesce(m.x, c.x) AS x
  FROM centroids{n} c LEFT JOIN means{n} m USING (cluster, k))"""


OP13 = f"""
WITH vectors AS (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}),
numbers AS (SELECT row, vec_id, unnest(range(0, {DIMENSIONS})) AS k,
  CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM vectors),
chosen AS (SELECT row, row_number() OVER (ORDER BY sha256('{CLUSTER_SEED}:' || vec_id)) - 1 AS cluster
  FROM vectors QUALIFY cluster < {CLUSTERS}),
centroids0 AS (SELECT cluster, k, x FROM chosen JOIN numbers USING (row)),
{",".join(_round(n) for n in range(ROUNDS + 1))},
named AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256
  FROM centroids{ROUNDS} GROUP BY cluster)
SELECT v.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance,
  CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, m.centroid_sha256
FROM near{ROUNDS} n JOIN vectors v USING (row) JOIN named m USING (cluster)
"""

ORACLES: dict[str, str] = {
    "op3_mixing": OP3,
    "op4_quality": OP4,
    "op5_hosts": OP5,
    "op6_jaccard": OP6,
    "op11_prefix_trie": OP11,
    "op13_centroids": OP13,
}
