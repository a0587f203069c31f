"""Registered queries of the training-data operators: thin digests of what the
operators return, with DuckDB twins where SQL can express them."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import ann, bpe, licenses, lines, lm, mixing, pii, quality, runs, simhash, toxicity, variants, warc
from cadenza.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_FORMS)
OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), p AS (
  SELECT rid, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), r AS (
  SELECT rid, i FROM p QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), c AS (
  SELECT rid, sum(least(8, nxt - i)) AS n FROM (
    SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 8) AS nxt FROM r) GROUP BY rid
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: x IN ({_STOPS}))) AS n_stop
  FROM w LEFT JOIN c USING (rid)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS bad FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, bad AS base_failed,
       NOT bad AND NOT (n_symbols / greatest(n_words, 1) > 0.1) AND NOT (n_words >= 50 AND n_stop / n_words < 0.05)
       AND NOT (n_dup_lines / greatest(n_lines, 1) > 0.5)
       AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 14.0 AS kept
FROM b
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every whole text, whether a base rule fails, and the verdict."""
    judged = quality.judge(table(spark, sf_dir, "documents"), out="q")
    m = F.col("q.measures")
    return judged.select(
        "doc_id",
        *(m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("q.base_failed").alias("base_failed"),
        F.col("q.kept").alias("kept"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents
), l AS (
  SELECT rid, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM d
), c AS (
  SELECT source, trim(line, E' \t\n\x0b\f\r') AS t, count(DISTINCT rid) AS n FROM l GROUP BY ALL
), h AS (
  SELECT source, count(*) AS total FROM d GROUP BY source
), b AS (
  SELECT c.source, t FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source WHERE t <> '' AND n >= 5 AND n > 0.002 * total
), m AS (
  SELECT rid, i, line, trim(line, E' \t\n\x0b\f\r') <> '' AS shown, b.t IS NOT NULL AS cut
  FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND trim(line, E' \t\n\x0b\f\r') = b.t
), s AS (
  SELECT rid, count(*) FILTER (shown) AS n_lines, count(*) FILTER (shown AND cut) AS n_cut,
         string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut) AS kept FROM m GROUP BY rid
)
SELECT doc_id, source AS host, n_lines::BIGINT AS n_lines,
       (CASE WHEN n_cut < n_lines THEN n_cut ELSE 0 END)::BIGINT AS n_dropped,
       CASE WHEN n_cut > 0 AND n_cut < n_lines THEN kept ELSE text END AS text
FROM d JOIN s USING (rid)
"""


@query("op7_line_dedup", OP7_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate of its source."""
    cut = lines.cut_lines(table(spark, sf_dir, "documents"), "source", out="cut")
    return cut.select("doc_id", F.col("source").alias("host"), F.col("cut.n_lines").alias("n_lines"), F.col("cut.n_dropped").alias("n_dropped"), "text")


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrase places and license labels of every whole text."""
    found = licenses.scan(table(spark, sf_dir, "documents"), out="lic").select("doc_id", "lic.*")
    starts = F.transform("base", lambda x: x["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        licenses.labels(F.col("base")).alias("base_labels"),
        licenses.labels(F.concat("base", "spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform(F.concat("base", "spans"), lambda x: x["weight"])), F.lit(0.0)).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_source_mixing")
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of the documents: sources stand at most 2 to 1 apart in how
    often they repeat, and each document is drawn at least once."""
    drawn, _ = mixing.mix(table(spark, sf_dir, "documents"), out="mix")
    return drawn.select("doc_id", "source", F.col("mix.epoch").alias("epoch"), F.col("mix.block").alias("block"), F.col("mix.key").alias("key"))


@query("op10_bpe_chunk_reuse")
def op10_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every whole text's token ids and of their decoding."""
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


OP2_SQL = """
WITH r AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM r
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY h, n) AS top FROM d
)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM m
"""


@query("op2_warc_bundles", OP2_SQL)
def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to seekable bundles and read the archives back."""
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), u AS (
  SELECT * FROM e WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))) AS score
  FROM u q JOIN u c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op3_block_matrix_neighbours", OP3_SQL)
def op3_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every 100th one among all."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op8_pii_weak_supervision")
def op8_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: base spans, counted and digested,
    and all spans."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def counted(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        F.col("id").alias("doc_id"),
        *(counted(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op9_attention_scores")
def op9_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every whole text."""
    return lm.score(table(spark, sf_dir, "documents"))


def planted_period(ident: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the texts, by id, made periodic from some place on."""
    h, n = zlib.crc32(str(ident).encode()), len(words)
    if ident is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query("op11_lyndon_runs")
def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every whole text's words: the longest one, and digests
    of all runs and of the text with each run cut to one period."""
    found = runs.find(table(spark, sf_dir, "documents"), altered=planted_period)
    # the longest first, then the smallest start and period
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.n")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(1000 * -best.n) div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_deletion(ident: Column, run: Column) -> Column:
    """One run in 31, by the id and the run, loses a code point."""
    h = F.crc32(F.concat(ident.cast("string"), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


OP13_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), o AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS r FROM documents)
), x AS (
  SELECT doc_id, r, hex(encode(doc_id::VARCHAR || ':' || r)) AS x FROM o
), h AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INT, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t.t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM x, t
), v AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), d AS (
  SELECT word, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), p AS (
  SELECT a.word AS w, b.word AS near FROM d a JOIN d b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.d = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.d = v.word
), b AS (
  SELECT w, near, n, count(*) OVER (PARTITION BY w) AS n_near FROM p JOIN v ON p.near = v.word
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY n DESC, near) = 1
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN near END AS form, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n
  FROM v LEFT JOIN b ON v.word = b.w
), l AS (
  SELECT word, word AS root FROM f UNION ALL SELECT l.word, f.form FROM l JOIN f ON l.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, l.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM f JOIN l ON f.word = l.word JOIN f g ON l.root = g.word WHERE g.form IS NULL
"""


@query("op13_spelling_variants", OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its near words, form and root."""
    found = variants.group(table(spark, sf_dir, "documents"), altered=planted_deletion)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_toxicity_kernel")
def op12_toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.detect(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score", "predicted", F.col("unit").alias("marked_by"))
