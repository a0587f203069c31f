"""Registered queries: serving joins and playlist operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import vectors as VX
from cadenza.operators import recommend as RC
from cadenza.operators import stats as S
from cadenza.plans import serving as SV
from cadenza.plans.q_catalog import CAMELOT_SQL
from cadenza.plans.registry import register
from cadenza.session import checkpoint_dir
from cadenza.sources import catalog as V
from cadenza.sources import io as IO


def prepared_requests(spark, sf):
    """Requests after the serving filters with their cluster id."""
    return RC.with_fixed_cluster(RC.clean_requests(V.requests(spark, sf)))


RQ_SQL = {
    **CAMELOT_SQL,
    "rq": """
SELECT r.recommendation_id, r.tempo, r.key, r.mode,
       CAST((CAST(trunc(r.key) AS INT) * 7 + CAST(trunc(r.time_signature) AS INT)) % 11 AS INT) AS cluster_id
FROM requests r WHERE r.tempo BETWEEN 40 AND 250 AND r.time_signature BETWEEN 1 AND 5""",
    "rq_nb": """
SELECT recommendation_id, tempo, cluster_id, unnest([
   CAST(num AS VARCHAR) || letter,
   CAST(CASE WHEN num > 1 THEN num - 1 ELSE 12 END AS VARCHAR) || letter,
   CAST(CASE WHEN num < 12 THEN num + 1 ELSE 1 END AS VARCHAR) || letter,
   CAST(num AS VARCHAR) || CASE WHEN letter = 'A' THEN 'B' ELSE 'A' END]) AS camelot
FROM (SELECT q.*, CASE WHEN q.mode = 1 THEN c.major_num ELSE c.minor_num END AS num,
             CASE WHEN q.mode = 1 THEN 'B' ELSE 'A' END AS letter
      FROM rq q JOIN camelot_tbl c ON c.k = CAST(trunc(q.key) AS INT) WHERE q.mode IS NOT NULL)""",
    "cat_cam": """
SELECT s.*, CAST(CASE WHEN s.mode = 1 THEN c.major_num ELSE c.minor_num END AS VARCHAR)
            || CASE WHEN s.mode = 1 THEN 'B' ELSE 'A' END AS camelot
FROM clustered_catalog s JOIN camelot_tbl c ON c.k = s.key""",
    "j2": """
SELECT recommendation_id, song_id, title, artist, tempo, key, round(d, 6) AS tempo_diff FROM (
  SELECT n.recommendation_id, c.song_id, c.title, c.artist, c.tempo, c.key, abs(c.tempo - n.tempo) AS d,
         row_number() OVER (PARTITION BY n.recommendation_id ORDER BY abs(c.tempo - n.tempo), c.song_id) AS rn
  FROM rq_nb n JOIN cat_cam c ON c.cluster_id = n.cluster_id AND c.camelot = n.camelot) WHERE rn = 1""",
    "w2": """
SELECT recommendation_id, cluster_id, song_id, title, artist, CAST(rank AS INT) AS rank FROM (
  SELECT q.recommendation_id, q.cluster_id, c.song_id, c.title, c.artist,
         row_number() OVER (PARTITION BY q.recommendation_id ORDER BY c.song_id) AS rank
  FROM rq q JOIN clustered_catalog c ON c.cluster_id = q.cluster_id) WHERE rank <= 3""",
}


@register("join_harmonic_nearest_tempo", "SELECT * FROM j2", RQ_SQL, headline=True)
def q_j2(spark, sf):
    return RC.join_harmonic_nearest_tempo(prepared_requests(spark, sf), V.clustered_catalog(spark, sf))


@register("nearest_tempo_per_request", """
SELECT recommendation_id, song_id, round(d, 6) AS tempo_diff FROM (
  SELECT q.recommendation_id, c.song_id, abs(c.tempo - q.tempo) AS d,
         row_number() OVER (PARTITION BY q.recommendation_id ORDER BY abs(c.tempo - q.tempo), c.song_id) AS rn
  FROM rq q JOIN clustered_catalog c ON c.cluster_id = q.cluster_id) WHERE rn = 1""", RQ_SQL, headline=True)
def q_w1(spark, sf):
    return RC.nearest_tempo_per_request(prepared_requests(spark, sf), V.clustered_catalog(spark, sf))


@register("top3_per_request", "SELECT * FROM w2", RQ_SQL)
def q_w2(spark, sf):
    return RC.top3_per_request(prepared_requests(spark, sf), V.clustered_catalog(spark, sf).select("cluster_id", "song_id", "title", "artist"))


@register("join_request_cluster", """
SELECT q.recommendation_id, q.cluster_id, p.n_candidates, p.min_tempo, p.max_tempo
FROM rq q JOIN (SELECT cluster_id, count(*) AS n_candidates, min(tempo) AS min_tempo, max(tempo) AS max_tempo
                FROM clustered_catalog GROUP BY cluster_id) p ON p.cluster_id = q.cluster_id""", RQ_SQL)
def q_j1(spark, sf):
    return RC.join_request_cluster(prepared_requests(spark, sf), V.clustered_catalog(spark, sf))


@register("lookup_metadata", """
SELECT w.recommendation_id, w.song_id, c.title, c.artist FROM (
  SELECT recommendation_id, song_id FROM (
    SELECT q.recommendation_id, c.song_id,
           row_number() OVER (PARTITION BY q.recommendation_id ORDER BY abs(c.tempo - q.tempo), c.song_id) AS rn
    FROM rq q JOIN clustered_catalog c ON c.cluster_id = q.cluster_id) WHERE rn = 1) w
JOIN catalog c ON c.song_id = w.song_id""", RQ_SQL)
def q_j9(spark, sf):
    ids = RC.nearest_tempo_per_request(prepared_requests(spark, sf), V.clustered_catalog(spark, sf))
    return RC.lookup_metadata(ids.select("recommendation_id", "song_id"), V.catalog(spark, sf))


REPLY_SQL = {
    **RQ_SQL,
    "replies": """
SELECT recommendation_id AS key, CAST(json_object('artist', artist, 'title', title, 'tempo', tempo, 'key', key) AS VARCHAR) AS value, 0 AS seq FROM j2
UNION ALL
SELECT w.recommendation_id, CAST(json_object('artist', c.artist, 'title', c.title, 'tempo', c.tempo, 'key', c.key) AS VARCHAR), w.rank
FROM w2 w JOIN clustered_catalog c ON c.song_id = w.song_id""",
}


def _replies(spark, sf):
    req = prepared_requests(spark, sf)
    cat = V.clustered_catalog(spark, sf)
    j2 = RC.format_replies(RC.join_harmonic_nearest_tempo(req, cat), F.lit(0))
    return j2.unionByName(RC.format_replies(RC.top3_per_request(req, cat), F.col("rank")))


@register("fetch_reply", """
SELECT key, value, CAST(n AS INT) AS n FROM (
  SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY seq, value) AS n FROM replies
  WHERE key IN (SELECT recommendation_id FROM requests)) WHERE n <= 3""", REPLY_SQL)
def q_j13(spark, sf):
    path = checkpoint_dir(spark, "replies")
    IO.write_reply_store(_replies(spark, sf), path)
    return RC.fetch_reply(V.requests(spark, sf), spark.read.parquet(path), buckets=IO.REPLY_BUCKETS)


# The same matches behind the stored model instead of the fixed rule.
MODEL = SV.demo_model()
MODEL_SQL = {
    **{k: v.replace("clustered_catalog", "model_catalog") for k, v in RQ_SQL.items()},
    "model_catalog": "SELECT song_id, title, artist, tempo, key, mode, cluster_id FROM (" + SV.cluster_sql("songs", MODEL) + ")",
    "rq": "SELECT recommendation_id, tempo, key, mode, cluster_id FROM (" + SV.cluster_sql("requests", MODEL) + ")",
}


def model_catalog(spark, sf):
    """Cleaned songs with the stored model's cluster ids."""
    songs = V.songs(spark, sf).where(F.col("tempo").between(40, 250) & F.col("time_signature").between(1, 5)).select(
        "song_id", "title", "artist", "tempo", "loudness", "key", "mode", "time_signature")
    return SV.assigner(MODEL)(songs).select("song_id", "title", "artist", "tempo", "key", "mode", "cluster_id")


@register("recommend_batch", """
SELECT recommendation_id AS key, CAST(json_object('artist', artist, 'title', title, 'tempo', tempo, 'key', key) AS VARCHAR) AS value
FROM j2""", MODEL_SQL)
def q_m18(spark, sf):
    return RC.recommend_batch(V.requests(spark, sf), model_catalog(spark, sf), assign=SV.assigner(MODEL))


# --- vector operators (embeddings: label plays the cluster id) -------------------

def label_centers(spark, sf):
    """k per-label mean vectors (A16) — model parameters, k × d doubles."""
    rows = S.centroid_arrays(V.vectors(spark, sf)).orderBy("label").collect()
    return [r["centroid"] for r in rows], [r["label"] for r in rows]


CENTER_SQL = {
    "centers": """
SELECT label AS c, list(m ORDER BY d) AS centroid FROM (
  SELECT label, d, avg(x) AS m FROM (
    SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM vectors) GROUP BY label, d) GROUP BY label""",
    "dists": """
SELECT v.vec_id, v.label, c.c,
       list_reduce(list_transform(list_zip(v.embedding, c.centroid), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                   lambda a, b: a + b) AS d
FROM vectors v, centers c""",
}


@register("assign_nearest_centroid", """
SELECT vec_id, CAST(arg_min(c, (d, c)) AS INT) AS cluster, round(min(d), 6) AS sqdist FROM dists GROUP BY vec_id""",
          CENTER_SQL)
def q_j10(spark, sf):
    centers, labels = label_centers(spark, sf)
    out = RC.assign_nearest_centroid(V.vectors(spark, sf), centers)
    lab = F.array(*[F.lit(int(x)) for x in labels])
    return out.select("vec_id", F.get(lab, F.col("cluster")).alias("cluster"), F.round("sqdist", 6).alias("sqdist"))


@register("topc_clusters", """
SELECT vec_id, list(c ORDER BY d, c)[1:2] AS top_clusters FROM dists GROUP BY vec_id""", CENTER_SQL)
def q_w6(spark, sf):
    centers, _ = label_centers(spark, sf)
    p = RC.centroid_probabilities(V.vectors(spark, sf), centers)
    return RC.topc_clusters(p, 2).select("vec_id", "top_clusters")


def seeds_with_clusters(spark, sf):
    centers, _ = label_centers(spark, sf)
    p = RC.centroid_probabilities(V.vectors(spark, sf), centers)
    return RC.topc_clusters(p, 2).select(F.col("vec_id").alias("seed_id"), "embedding", "top_clusters")


def search_seeds(spark, sf):
    """Seeds of the vector searches: every 20th vector, searched among all."""
    return seeds_with_clusters(spark, sf).where(F.col("seed_id") % 20 == 0)


@register("join_topc_clusters", """
SELECT vec_id AS seed_id, CAST(r - 1 AS INT) AS rank, top_clusters[r] AS label
FROM (SELECT vec_id, list(c ORDER BY d, c)[1:2] AS top_clusters FROM dists GROUP BY vec_id), range(1, 3) t(r)""",
          CENTER_SQL)
def q_j14(spark, sf):
    return RC.join_topc_clusters(seeds_with_clusters(spark, sf))


@register("cosine_topn", """
WITH seeds AS (SELECT vec_id AS seed_id, embedding AS e, list(c ORDER BY d, c)[1:2] AS top_clusters
               FROM dists JOIN vectors USING (vec_id) WHERE vec_id % 20 = 0 GROUP BY vec_id, embedding),
cand AS (SELECT s.seed_id, v.vec_id, v.label,
                list_dot_product(s.e, v.embedding) / (sqrt(list_dot_product(s.e, s.e)) * sqrt(list_dot_product(v.embedding, v.embedding))) AS cosine
         FROM seeds s JOIN vectors v ON list_contains(s.top_clusters, v.label) AND v.vec_id <> s.seed_id)
SELECT seed_id, vec_id, label, round(cosine, 6) AS cosine, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY cosine DESC, vec_id) AS rank FROM cand) WHERE rank <= 200""",
          CENTER_SQL)
def q_w7(spark, sf):
    out = RC.cosine_topn(search_seeds(spark, sf), V.vectors(spark, sf), n=200)
    return out.select("seed_id", "vec_id", "label", F.round("cosine", 6).alias("cosine"), "rank")


@register("cosine_similarity", """
SELECT a.vec_id AS vec_a, b.vec_id AS vec_b,
       round(list_dot_product(a.embedding, b.embedding) / (sqrt(list_dot_product(a.embedding, a.embedding))
             * sqrt(list_dot_product(b.embedding, b.embedding))), 6) AS cosine
FROM vectors a JOIN vectors b ON b.vec_id = a.vec_id + 1""")
def q_h17(spark, sf):
    v = V.vectors(spark, sf)
    a = v.select(F.col("vec_id").alias("vec_a"), F.col("embedding").alias("ea"))
    b = v.select(F.col("vec_id").alias("vec_b"), F.col("embedding").alias("eb"))
    j = a.join(b, F.col("vec_b") == F.col("vec_a") + 1)
    return j.select("vec_a", "vec_b", F.round(VX.cosine_similarity("ea", "eb"), 6).alias("cosine"))
