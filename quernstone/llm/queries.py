"""The subpackage's registered queries: thin digests of each operator over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import chat, decontam, langid, licenses, linededup, packing, quality, resampling, sharding, simhash, spelling, topk, urls
from quernstone.llm.common import table


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", F.coalesce(~langid.learnable(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    put = sharding.feistel_shards(rows, 8)
    return put.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), uneven=True)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs.select("doc_id", "text"), quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(~quality.learnable(), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have neither fetch times nor lists: both come from the pages by a rule, as in the SQL."""
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("day"))
    hosts = pages.select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")).filter("host <> ''").distinct()
    number = lambda text: F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")
    hosts = hosts.withColumns({"x": number("host"), "y": number(F.concat("host", "path")), "parent": F.expr("substr(host, instr(host, '.') + 1)")})
    rule = "inline(array({}))".format(", ".join(f"struct('{name}' AS list, {key} AS key, '{action}' AS action, date_add(date'2024-01-01', {day}) AS day, {where} AS used)" for name, key, action, day, where in DATED))
    return urls.verdicts(captures, hosts.selectExpr(rule).filter("used").drop("used"))


#: Dated list entries by rule: list, key, action, day of the year 2024 and condition, of a host, its parent and hash x,
#: and a path on it and their hash y.
DATED = [
    ("spam", "host", "add", "x % 300", "x % 3 = 0"),
    ("spam", "host", "remove", "x % 300 + 20 + x % 50", "x % 3 = 0"),
    ("spam", "host", "add", "x % 300 + 100", "x % 6 = 0"),
    ("malware", "host || '/en'", "add", "x % 200", "x % 4 = 1"),
    ("malware", "host || '/en'", "remove", "x % 200 + 90", "x % 4 = 1"),
    ("allow", "parent", "add", "x % 365", "x % 5 = 2"),
    ("adult", "parent", "add", "x % 120", "x % 7 = 3"),
    ("adult", "parent", "remove", "x % 120 + 60", "x % 7 = 3"),
    ("phishing", "host || path", "add", "y % 200", "y % 3 = 0"),
    ("phishing", "host || path", "remove", "y % 200 + 100", "y % 6 = 0"),
    ("gambling", "parent || '/fr'", "add", "x % 150", "x % 9 = 4"),
]


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_chat": op1_chat,
    "pipeline": pipeline,
    "op2_topk": op2_topk,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_language": op5_language,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_quality": op9_quality,
    "op10_urls": op10_urls,
    "op11_resampling": op11_resampling,
    "op12_spelling": op12_spelling,
    "op13_lines": op13_lines,
}
#: One row with the table of CRC-32, by its rule, and the CRC-32 of what the column ``hx`` spells in hexadecimal.
CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c)) AS tab)"
CRC = "xor(list_reduce(list_transform(range(1, len(hx), 2), lambda i: CAST('0x' || substr(hx, i, 2) AS BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL: dict[str, str] = {
    "op1_chat": """
WITH said AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS message
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT said.*, perspective, speaker = perspective AS learn,
         CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS chat_role,
         CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>'
              ELSE '<|user name=' || speaker || '|>' END || chr(10) || message || '<|end|>' || chr(10) AS segment
  FROM said JOIN people ON said.conv_id IS NOT DISTINCT FROM people.conv_id),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
         CAST(sum(length(segment)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end"
  FROM seen WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, message))
SELECT conv_id, perspective, position, turn, speaker, chat_role, segment, "end" - length(segment) AS start, "end", learn,
       CASE WHEN learn THEN "end" - length(segment) + 14 END AS learn_start, CASE WHEN learn THEN "end" END AS learn_end
FROM placed""",
    "op2_topk": """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM codes q JOIN codes v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5""",
    "op8_decontamination": """
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'i', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM texts),
listed AS (
  SELECT side, id, len(w) AS n, list_transform(range(0, greatest(len(w) - 5, 0) + 1), lambda k: array_to_string(w[k + 1 : k + 5], ' ')) AS s
  FROM words WHERE len(w) > 0),
placed AS (SELECT side, id, n, len(s) AS span, unnest(s) AS shingle, unnest(range(len(s))) AS p FROM listed),
items AS (SELECT id AS item_id, n AS words, span, shingle, count(*) AS c FROM placed WHERE side = 'i' GROUP BY ALL),
docs AS (SELECT id AS doc_id, n, shingle, p FROM placed WHERE side = 'd'),
starts AS (
  SELECT DISTINCT doc_id, item_id, words, span, span AS own, unnest(range(greatest(p - span + 1, 0), least(p, n - words) + 1)) AS a
  FROM docs JOIN items USING (shingle) WHERE words <= n
  UNION ALL SELECT DISTINCT doc_id, item_id, n, span, n - 4, 0 FROM docs JOIN items USING (shingle) WHERE words > n AND n >= 5),
windows AS (
  SELECT t.doc_id, item_id, words, span, own, a, d.shingle, count(*) AS c
  FROM starts t JOIN docs d ON t.doc_id = d.doc_id AND d.p BETWEEN a AND a + own - 1 GROUP BY ALL),
short AS (SELECT DISTINCT words AS n_words FROM items WHERE words < 5),
runs AS (
  SELECT id AS doc_id, n_words, unnest(range(n - n_words + 1)) AS a, unnest(list_transform(range(n - n_words + 1), lambda k: array_to_string(w[k + 1 : k + n_words], ' '))) AS shingle
  FROM (SELECT id, len(w) AS n, w FROM words WHERE side = 'd'), short WHERE n > n_words),
alike AS (
  SELECT doc_id, w.item_id, w.words, a, CAST(sum(least(w.c, i.c)) AS DOUBLE) / (any_value(w.span) + any_value(w.own) - sum(least(w.c, i.c))) AS similarity
  FROM windows w JOIN items i ON w.item_id = i.item_id AND w.shingle = i.shingle GROUP BY ALL
  UNION ALL SELECT doc_id, item_id, words, a, CAST(1 AS DOUBLE) FROM runs JOIN items ON words = n_words AND items.shingle = runs.shingle)
SELECT doc_id, item_id, similarity, a AS first_word, CAST(words AS BIGINT) AS words
FROM alike WHERE similarity >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, a) = 1""",
    "op10_urls": """
WITH seen AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS day, count(*) AS copies,
         regexp_replace(lower(regexp_replace(regexp_extract(url, '^(?i:[a-z][a-z0-9+.-]*:)?//([^/?#\\\\]*)', 1), '^.*@', '')), '\\.?(:[0-9]*)?$', '') AS host,
         regexp_extract(url, '^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#\\\\]*([^?#]*)', 1) AS path
  FROM pages GROUP BY page_id, url),
hosts AS (
  SELECT DISTINCT host, path, CAST('0x' || substr(md5(host), 1, 4) AS INTEGER) AS x, CAST('0x' || substr(md5(host || path), 1, 4) AS INTEGER) AS y, substr(host, instr(host, '.') + 1) AS parent
  FROM seen WHERE host <> ''),
entries AS (
  """ + " UNION ALL ".join(f"SELECT '{name}' AS list, {key} AS key, '{action}' AS action, DATE '2024-01-01' + CAST({day} AS INTEGER) AS day FROM hosts WHERE {where}" for name, key, action, day, where in DATED) + """),
days AS (SELECT list, regexp_replace(key, '/+$', '') AS key, day, bool_or(action = 'add') AS valid FROM entries GROUP BY ALL),
domains AS (
  SELECT page_id, url, day, string_split(path, '/') AS parts,
         unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.'))) AS domain
  FROM seen WHERE host <> ''),
named AS (SELECT page_id, url, day, domain || unnest(list_transform(range(1, len(parts) + 1), lambda k: array_to_string(parts[1:k], '/'))) AS key FROM domains),
latest AS (
  SELECT n.page_id, n.url, n.day, d.list, n.key, arg_max(d.valid, d.day) AS valid
  FROM named n JOIN days d ON n.key = d.key AND d.day <= n.day GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url, day ORDER BY length(key) DESC, list = 'allow' DESC, list DESC) AS r,
         count(*) OVER (PARTITION BY page_id, url, day) AS n
  FROM latest WHERE valid)
SELECT s.page_id, s.url, s.day, s.copies, coalesce(r.n, 0) AS n_active, r.list AS matched_list, r.key AS matched_key,
       coalesce(r.list <> 'allow', false) AS blocked
FROM seen s LEFT JOIN ranked r ON r.r = 1 AND s.page_id = r.page_id AND s.url = r.url AND s.day = r.day""",
    "op11_resampling": f"""
WITH {CRC_TABLE},
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (SELECT side, r, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM texts),
runs AS (SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f FROM words),
counted AS (SELECT side, r, f, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT f, {CRC} % 10000 AS bucket FROM (SELECT DISTINCT f, hex(encode(f)) AS hx FROM counted), crc),
shares AS (
  SELECT bucket, CAST(coalesce(sum(c) FILTER (side = 'd'), 0) AS DOUBLE) AS of_docs, CAST(coalesce(sum(c) FILTER (side = 'b'), 0) AS DOUBLE) AS of_target
  FROM counted JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT sum(of_docs) + 10000 AS all_docs, sum(of_target) + 10000 AS all_target FROM shares),
gains AS (SELECT bucket, CAST(floor(1000 * ln((of_target + 1) * all_docs / ((of_docs + 1) * all_target))) AS BIGINT) AS gain FROM shares, totals),
weighed AS (
  SELECT r, sum(c) AS n_features, floor(CAST(sum(c * gain) AS DOUBLE) / sum(c)) AS weight
  FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(w) >= 20 AS fit, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weighed ON words.r = weighed.r WHERE side = 'd'),
placed AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY fit) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 25 * n // 100 THEN place END AS rank FROM placed""",
    "op12_spelling": f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, {LOWERED.format("run")} AS run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {CRC} AS h FROM (SELECT run, c, hex(encode(doc_id || ':' || run)) AS hx FROM counted), crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY word HAVING length(word) >= 5 AND sum(c) >= 3),
left_over AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS s
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM left_over a JOIN left_over b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, l.word, l.n FROM words w JOIN left_over l ON w.word = l.s
  UNION SELECT l.word, w.word, w.n FROM words w JOIN left_over l ON w.word = l.s),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN near ON words.word = near.word LEFT JOIN best ON words.word = best.word),
chain AS (
  SELECT word, form AS reached FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.reached = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, reached FROM chain c JOIN forms f ON reached = f.word WHERE f.form IS NULL)
SELECT forms.word, form, coalesce(reached, forms.word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots ON forms.word = roots.word""",
    "op13_lines": f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, unnest(range(len(l))) AS pos, unnest(l) AS line FROM texts),
keyed AS (SELECT *, {LOWERED.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text FROM keyed WHERE key NOT IN (SELECT key FROM frequent) GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, len(l) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)""",
}
