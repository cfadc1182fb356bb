"""DuckDB SQL for the results that SQL can express, written on its own: row
by row, without the operators' filters and intermediate forms.

Fingerprints, tokenizers and learned scores are not SQL; nor, in bearable
time, is the edit distance of the decontamination.  Those are held against
brute-force versions in the tests.
"""

from __future__ import annotations

from riskloom.llm.licenses import TEMPLATES, spans, words

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

# Runs grow by one line at a time: two places with one run share its first place (cls).  A line goes if it
# stands at an earlier place too; the longest run with an earlier copy is known for each line.
LINE_DEDUP = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, UNNEST(string_split(text, chr(10))) AS s, UNNEST(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, i, s, ROW_NUMBER() OVER (ORDER BY doc_id, i) AS pos FROM l WHERE regexp_matches(s, '[^\\x20\\x09-\\x0D]')
), runs AS (
  SELECT doc_id, pos, 1 AS len, cls FROM (
    SELECT doc_id, pos, MIN(pos) OVER (PARTITION BY s) AS cls, COUNT(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1
  UNION ALL
  SELECT doc_id, pos, len, cls FROM (
    SELECT r.doc_id, r.pos, r.len + 1 AS len, MIN(r.pos) OVER (PARTITION BY r.cls, w.s) AS cls,
           COUNT(*) OVER (PARTITION BY r.cls, w.s) AS n
    FROM runs r JOIN w ON w.pos = r.pos + r.len AND w.doc_id = r.doc_id) WHERE n > 1
), longest AS (
  SELECT doc_id, pos, MAX(len) AS len, arg_max(cls, len) AS cls FROM runs WHERE cls < pos GROUP BY ALL
), maximal AS (
  SELECT a.* FROM longest a LEFT JOIN longest b ON b.pos = a.pos - 1 AND b.doc_id = a.doc_id AND b.len = a.len + 1
  WHERE b.pos IS NULL
), told AS (
  SELECT doc_id, COUNT(*) AS n_runs, MAX(len) AS longest_run, arg_max(cls, CAST(len AS BIGINT) * 1000000000000 - pos) AS cls FROM maximal GROUP BY doc_id
), r AS (
  SELECT l.doc_id, CAST(COUNT(*) AS INTEGER) AS n_lines, CAST(COUNT(g.pos) AS INTEGER) AS n_removed,
         COALESCE(string_agg(l.s, chr(10) ORDER BY l.i) FILTER (g.pos IS NULL), '') AS text
  FROM l LEFT JOIN w ON l.doc_id = w.doc_id AND l.i = w.i LEFT JOIN longest g ON g.pos = w.pos GROUP BY l.doc_id
)
SELECT r.*, CAST(COALESCE(n_runs, 0) AS INTEGER) AS n_runs, CAST(COALESCE(longest_run, 0) AS INTEGER) AS longest_run,
       w.doc_id AS first_doc, CAST(w.i AS INTEGER) AS first_line
FROM r LEFT JOIN told USING (doc_id) LEFT JOIN w ON w.pos = told.cls
UNION ALL SELECT doc_id, 0, 0, NULL, 0, 0, NULL, NULL FROM documents WHERE text IS NULL
"""


# The rest of a budget goes to the documents that fit, in key order; what is still missing then goes
# to the smaller ones left, and so on until none fits.
MIXING = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '{_WORD}')), 0) AS size,
         -ln((CAST('0x' || substr(md5('17:' || doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496)
         / ((len(translate(text, '#$%&*|!<>{{}}[]_=~^\\', '')) + 1) / (len(text) + 1)) AS key
  FROM documents
), sources AS (
  SELECT source, SUM(size) AS source_size, [5, 2, 1][1 + (ROW_NUMBER() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 3.0 * source_size AS cap,
         (SUM(source_size) OVER () - COALESCE(SUM(3.0 * source_size) OVER below, 0))
         / (SUM(w) OVER () - COALESCE(SUM(w) OVER below, 0)) AS level
  FROM sources
  WINDOW below AS (ORDER BY source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT *, first_value(CASE WHEN level * w <= cap THEN level END IGNORE NULLS) OVER (
    ORDER BY source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final
  FROM levels
), targets AS (
  SELECT source, source_size, CAST(COALESCE(LEAST(cap, final * w), cap) AS DOUBLE) AS target FROM water
), r0 AS (
  SELECT doc_id, sized.source, size, source_size, target, key,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
         target - whole * source_size AS missing
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), filled AS (
  SELECT doc_id, source, size, key, missing, FALSE AS fits FROM r0 WHERE size <= missing
  UNION ALL
  SELECT doc_id, source, size, key, CASE WHEN fits THEN missing ELSE left_ END, fits FROM (
    SELECT *, missing - COALESCE(SUM(size) FILTER (fits) OVER (PARTITION BY source), 0) AS left_ FROM (
      SELECT doc_id, source, size, key, missing,
             SUM(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) <= missing AS fits
      FROM filled WHERE NOT fits))
  WHERE fits OR size <= left_
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + (doc_id IN (SELECT doc_id FROM filled WHERE fits))::INT) AS BIGINT) AS taken
FROM r0
"""

WARC = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS payload FROM pages),
kept AS (SELECT payload, MAX(page_id) AS page FROM p WHERE strlen(payload) >= 1000 GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page <> page_id THEN page END AS refers_to
FROM p LEFT JOIN kept USING (payload)
"""

TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(ROW_NUMBER() OVER best AS INTEGER) AS rank, vec_id, score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY ROW_NUMBER() OVER best <= 5
"""


def _strength(level: str) -> str:
    """(p, strength) of the members (n, good) of a level."""
    return f"""(
  SELECT g / n AS p, CASE WHEN q - g * g / n > p * (1 - p) * k
                     THEN GREATEST(1.0, LEAST(1000.0, p * (1 - p) / ((q - g * g / n) / n - p * (1 - p) * k / n) - 1))
                     ELSE 1000.0 END AS strength
  FROM (SELECT CAST(SUM(n) AS DOUBLE) AS n, CAST(SUM(good) AS DOUBLE) AS g, SUM(good * good / n) AS q, COUNT(*) AS k
        FROM {level} WHERE n > 0))"""


URLS = f"""
WITH u AS (
  SELECT page_id, translate(COALESCE(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         COALESCE(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN dotted LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN dotted LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN dotted LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN dotted LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN dotted LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule,
    CAST(rule IN ('com/', 'www.example.com/en/') AS INT) AS good
  FROM u
), hosts AS (
  SELECT host, COUNT(good) AS n, COALESCE(SUM(good), 0) AS good, string_split(host, '.')[-1] AS suffix,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain
  FROM ruled GROUP BY host
), domains AS (SELECT domain, suffix, SUM(n) AS n, SUM(good) AS good FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, SUM(n) AS n, SUM(good) AS good FROM domains GROUP BY ALL),
s AS (SELECT suffix, (good + x.strength * x.p) / (n + x.strength) AS mean FROM suffixes, {_strength('suffixes')} x),
d AS (SELECT domain, (good + x.strength * mean) / (n + x.strength) AS mean FROM domains JOIN s USING (suffix), {_strength('domains')} x),
h AS (SELECT host, (good + x.strength * mean) / (n + x.strength) AS m, n + x.strength AS weight
      FROM hosts JOIN d USING (domain), {_strength('hosts')} x)
SELECT page_id, host, path, rule, CASE
    WHEN good = 1 THEN 'allow' WHEN good = 0 THEN 'block'
    WHEN m + 1.64 * sqrt(m * (1 - m) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN h USING (host)
"""


def _list(items) -> str:
    return "[" + ", ".join(f"'{w}'" for w in items) + "]"


def _licenses(threshold: float = 0.8) -> str:
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    places = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM (SELECT doc_id, w, UNNEST(range(1, len(w) + 1)) AS i FROM t) "
        f"WHERE w[i:i + {len(p.split()) - 1}] = {_list(p.split())}" for p, label in phrases.items())
    notices = ", ".join(f"({size}, '{label}', {_list(sorted({w.decode() for w in words(text)}))})"
                        for size, of in spans(TEMPLATES).items() for label in sorted(of) for text in of[label])
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, {size} AS span, w[i + 1:i + {2 * size}] AS b "
        f"FROM (SELECT doc_id, w, UNNEST(range(0, GREATEST(1, len(w) - {size}), {size})) AS i FROM t)" for size in spans(TEMPLATES))
    return f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), places AS ({places}),
base AS (
  SELECT doc_id, COUNT(*) AS n_base, MIN(place) AS first_word, MAX(place) AS last_word, list_sort(list(DISTINCT label)) AS bases
  FROM places GROUP BY doc_id
), blocks AS ({cuts}
), shares AS (
  SELECT doc_id, label, MAX(len(list_intersect(b, notice)) / len(notice)) AS share
  FROM blocks JOIN (VALUES {notices}) n(span, label, notice) USING (span) GROUP BY doc_id, label HAVING share >= {threshold}
), method AS (SELECT doc_id, list(label) AS found, MAX(share) AS best FROM shares GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word,
       COALESCE(array_to_string(bases, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(COALESCE(bases, []), COALESCE(found, [])))), ',') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE COALESCE(best, 0) END AS DOUBLE) AS score
FROM t LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""


LICENSES = _licenses()

RANKED = f"""
WITH d AS (
  SELECT doc_id, ROW_NUMBER() OVER () AS r,
         regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, UNNEST(regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'),
                                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), asked AS (SELECT item_id, term, COUNT(*) AS reps FROM b GROUP BY ALL),
total AS (SELECT COUNT(*) AS docs, SUM(len(w)) AS terms FROM d WHERE len(w) > 0),
each AS (SELECT doc_id, r, len(w) AS n, UNNEST(w) AS term FROM d),
counts AS (SELECT doc_id, r, n, term, COUNT(*) AS tf FROM each WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight
  FROM counts, total GROUP BY term, docs
), impacts AS (
  SELECT doc_id, r, term, weight * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * docs // terms))) AS impact
  FROM counts JOIN weights USING (term), total
), scored AS (
  SELECT item_id, doc_id, r, CAST(SUM(reps * impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, CAST(ROW_NUMBER() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY ROW_NUMBER() OVER best <= 10
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_mixing": MIXING,
    "op6_warc": WARC,
    "op7_topk": TOPK,
    "op8_url_filter": URLS,
    "op9_licenses": LICENSES,
    "op11_ranked_search": RANKED,
}
