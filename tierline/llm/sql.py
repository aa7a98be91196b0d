"""The registered queries as SQL for DuckDB, where SQL can express them."""

from tierline.llm.licences import FILE, HEADER, RARE, TEMPLATES, TEXTS, _template_words

LINE_DEDUP = """
WITH held AS (
  SELECT doc_id, coalesce(source, '') AS site, trim(unnest(string_split(text, chr(10)))) AS line FROM documents
), spread AS (
  SELECT line, min(doc_id) AS first FROM held WHERE line <> '' GROUP BY line
  HAVING count(DISTINCT site) >= 5
    OR (len(list_filter(string_split_regex(line, '[ \t]+'), lambda w: w <> '')) >= 50 AND (count(DISTINCT site) >= 2 OR count(DISTINCT doc_id) >= 5))
), hits AS (
  SELECT doc_id, list(DISTINCT line) AS found FROM held JOIN spread USING (line) WHERE doc_id > first GROUP BY doc_id
), split AS (
  SELECT d.doc_id, string_split(text, chr(10)) AS line, coalesce(found, []) AS found FROM documents d LEFT JOIN hits USING (doc_id)
), kept AS (
  SELECT doc_id, line, list_filter(line, lambda x: NOT list_contains(found, trim(x))) AS rest FROM split
)
SELECT doc_id, array_to_string(rest, chr(10)) AS text, CAST(coalesce(len(line), 0) AS INTEGER) AS lines,
       CAST(coalesce(len(line), 0) - coalesce(len(rest), 0) AS INTEGER) AS lines_removed
FROM kept
"""


def licence_scan() -> str:
    """Weighs every unit against every template and every whole text against every full text, without the bounds that spare Spark most of it."""
    templates = ", ".join(f"('notice', '{n}', {_template_words(t)})" for n, t in TEMPLATES.items())
    templates += "".join(f", ('text', '{n}', {_template_words(t)})" for n, t in TEXTS.items())
    split = "list_distinct(list_filter(string_split_regex(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
    return f"""
WITH files AS (
  SELECT doc_id, concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), coalesce(CAST(doc_id // 1000 AS VARCHAR), '_'), coalesce(CAST(doc_id AS VARCHAR), '_')) AS path,
         text FROM documents
), templates(made, name, ws) AS (VALUES {templates}
), tw AS (SELECT made, name, unnest(ws) AS w FROM templates
), df AS (
  SELECT w, count(*) AS df FROM (SELECT unnest({split.format("text")}) AS w FROM files) WHERE w IN (SELECT w FROM tw) GROUP BY w
), n AS (SELECT power(least(ln(count(*) + 1), ln({RARE})), 2) AS other, count(*) AS n FROM files
), weights AS (
  SELECT made, w, power(least(ln((n.n + 1) / (coalesce(df, 0) + 1)), ln({RARE})), 2) AS weight FROM (SELECT DISTINCT made, w FROM tw) LEFT JOIN df USING (w), n
), norms AS (SELECT made, name, sum(weight) AS norm FROM tw JOIN weights USING (made, w) GROUP BY made, name
), units AS (
  SELECT path, 0 AS place, 'file' AS kind, {FILE} AS least, {split.format("text")} AS ws FROM files WHERE text IS NOT NULL
  UNION ALL
  SELECT path, place, 'header', {HEADER}, {split.format("line")} FROM (
    SELECT path, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM files WHERE text IS NOT NULL)
), entries AS (SELECT path, place, kind, least, len(ws) AS size, unnest(ws) AS w FROM units
), weighed AS (SELECT * FROM entries JOIN weights USING (w) WHERE made = 'notice' OR kind = 'file'
), known AS (
  SELECT path, place, kind, least, size, made, count(*) AS inside, sum(weight) AS weight FROM weighed GROUP BY ALL
), dots AS (
  SELECT path, place, kind, made, name, sum(weight) AS dot FROM weighed JOIN tw USING (made, w) GROUP BY ALL
), scored AS (
  SELECT path, kind, name, least, round(dot / sqrt((k.weight + (size - inside) * n.other) * norm), 6) AS similarity
  FROM dots JOIN known k USING (path, place, kind, made) JOIN norms USING (made, name), n
), own AS (
  SELECT path, kind, name AS licence, similarity FROM scored WHERE similarity >= least
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY kind, similarity DESC, name) = 1
), stated AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS above, licence FROM own WHERE kind = 'file'
  QUALIFY row_number() OVER (PARTITION BY above ORDER BY similarity DESC, path) = 1
), dirs AS (
  SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS dir FROM files
), nearest AS (
  SELECT dir, above, licence FROM dirs JOIN stated ON dir = above OR starts_with(dir, above || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC) = 1
)
SELECT doc_id, path, coalesce(own.licence, nearest.licence) AS licence,
       CASE WHEN own.licence IS NULL AND nearest.licence IS NOT NULL THEN 'inherited' ELSE kind END AS kind,
       similarity, CASE WHEN own.licence IS NULL THEN above END AS licence_dir
FROM files LEFT JOIN own USING (path) LEFT JOIN nearest ON dir = regexp_replace(path, '/[^/]*$', '')
"""

#: Distance of sources from the plain counts of all terms.
SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
t AS (SELECT uid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT uid) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
z AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
e AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n::HUGEINT AS lang_n
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
),
p AS (
  SELECT e.lang, e.source, e.term, e.n,
    1 + (1000000000::HUGEINT * (e.n + 2)) // (sum(e.n) OVER (PARTITION BY e.lang, e.source) + 2 * z.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (e.lang_n + 2)) // (z.total + 2 * z.v)::HUGEINT AS q
  FROM e JOIN z USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
),
terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
) WHERE rank <= 10
"""
