"""Registered queries: streaming service and I/O round trips.

Each stream query stages the request messages derived from ``events`` as
JSON files in a fresh folder under the shared checkpoint folder, runs the
Structured Streaming query with ``availableNow`` and returns what it wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import clean as C
from cadenza.plans.q_catalog import PARSED
from cadenza.plans import serving as SV
from cadenza.plans.q_recommend import MODEL, MODEL_SQL, RQ_SQL, model_catalog
from cadenza.plans.registry import register
from cadenza.session import checkpoint_dir
from cadenza.sources import catalog as V
from cadenza.sources import io as IO
from cadenza.streaming import stream as ST

VALID = {**PARSED, "parsed_valid": """
SELECT * FROM parsed_requests
WHERE abs(tempo) < 2147483648 AND abs(loudness) < 2147483648 AND abs(key) < 2147483648 AND abs(mode) < 2147483648 AND abs(time_signature) < 2147483648"""}
STREAM_RQ = {**VALID, **{k: v.replace("FROM requests r", "FROM parsed_valid r") for k, v in RQ_SQL.items()}}
STREAM_MODEL = {**VALID, **{k: v.replace("FROM requests x", "FROM parsed_valid x") for k, v in MODEL_SQL.items()}}


def _staged(spark, sf, name, files=None):
    base = checkpoint_dir(spark, name)
    src = f"{base}/in"
    ST.stage_messages(V.request_messages(spark, sf), src, files)
    return base, src


@register("stream_parse_requests", """
SELECT recommendation_id, track_name, artist_name, tempo, loudness, key, mode, time_signature FROM parsed_valid""", VALID)
def q_t1(spark, sf):
    base, src = _staged(spark, sf, "t1")
    good, _ = ST.stream_parse_requests(ST.read_requests_stream(spark, "files", src, max_files_per_trigger=1))
    q = good.writeStream.format("parquet").option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "recommendation_id", "track_name", "artist_name", "tempo", "loudness", "key", "mode", "time_signature")


@register("stream_recommend", """
SELECT recommendation_id AS key, CAST(json_object('artist', artist, 'title', title, 'tempo', tempo, 'key', key) AS VARCHAR) AS value
FROM j2""", STREAM_MODEL)
def q_t2(spark, sf):
    base, src = _staged(spark, sf, "t2")
    ST.stream_recommend(spark, model_catalog(spark, sf), src, f"{base}/out", f"{base}/ckpt", f"{base}/dead", assign=SV.assigner(MODEL))
    return ST.read_output(spark, f"{base}/out").select("key", "value")


@register("stream_checkpoint_restart", """
SELECT count(*) AS rows_after_recovery, count(*) AS rows_after_restart, CAST(0 AS BIGINT) AS files_without_a_batch FROM j2""", STREAM_RQ)
def q_t5(spark, sf):
    """The stream dies between a batch's write and its commit, starts again and
    repeats that batch under its id; a further start finds nothing new."""
    messages = V.request_messages(spark, sf)
    parts = messages.select(F.spark_partition_id()).distinct().count()   # a file each, and some batches on small tables too
    base, src = _staged(spark, sf, "t5", files=max(4, parts))
    cat = V.clustered_catalog(spark, sf)
    files = spark.read.json(src).select(F.input_file_name()).distinct().count()
    ST.run_until_failure(spark, cat, src, f"{base}/out", f"{base}/ckpt", after_batch=1)
    ST.stream_recommend(spark, cat, src, f"{base}/out", f"{base}/ckpt")
    first = spark.read.parquet(f"{base}/out").count()
    ST.stream_recommend(spark, cat, src, f"{base}/out", f"{base}/ckpt")   # restart: nothing new to read
    second = spark.read.parquet(f"{base}/out").count()
    batches = spark.read.parquet(f"{base}/out").select("batch_id").distinct().count()
    return spark.createDataFrame([(first, second, files - batches)], "rows_after_recovery long, rows_after_restart long, files_without_a_batch long")


@register("stream_error_isolation", """
SELECT recommendation_id, json_str,
       CASE WHEN track_name IS NULL AND artist_name IS NULL AND tempo IS NULL THEN 'unreadable'
            ELSE concat_ws(',', CASE WHEN tempo IS NULL THEN 'tempo' END, CASE WHEN loudness IS NULL THEN 'loudness' END,
                 CASE WHEN key IS NULL THEN 'key' END, CASE WHEN mode IS NULL THEN 'mode' END,
                 CASE WHEN time_signature IS NULL THEN 'time_signature' END, CASE WHEN abs(tempo) >= 2147483648 THEN 'range:tempo' END, CASE WHEN abs(loudness) >= 2147483648 THEN 'range:loudness' END, CASE WHEN abs(key) >= 2147483648 THEN 'range:key' END, CASE WHEN abs(mode) >= 2147483648 THEN 'range:mode' END, CASE WHEN abs(time_signature) >= 2147483648 THEN 'range:time_signature' END) END AS reason
FROM parsed_requests
WHERE NOT coalesce(abs(tempo) < 2147483648 AND abs(loudness) < 2147483648 AND abs(key) < 2147483648 AND abs(mode) < 2147483648 AND abs(time_signature) < 2147483648, false)""", PARSED)
def q_t6(spark, sf):
    base, src = _staged(spark, sf, "t6")
    ST.stream_recommend(spark, V.clustered_catalog(spark, sf), src, f"{base}/out", f"{base}/ckpt", f"{base}/dead")
    return ST.read_output(spark, f"{base}/dead").select("recommendation_id", "json_str", "reason")


# --- sources and sinks: write, read back ----------------------------------------------

@register("scan_clustered_csv", "SELECT title, artist, tempo, key, mode, cluster_id FROM clustered_catalog")
def q_s2(spark, sf):
    path = checkpoint_dir(spark, "csv")
    IO.export_clustered_catalog(V.clustered_catalog(spark, sf), path)
    return IO.scan_clustered_csv(spark, path)


@register("export_clustered_catalog", "SELECT count(*) AS n_rows, count(DISTINCT cluster_id) AS n_clusters FROM clustered_catalog")
def q_s10(spark, sf):
    path = checkpoint_dir(spark, "export")
    IO.export_clustered_catalog(V.clustered_catalog(spark, sf), path)
    back = IO.scan_clustered_csv(spark, path)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster_id").alias("n_clusters"))


@register("scan_union_parts", """
SELECT song_id, tempo, danceability FROM songs WHERE mode = 0 UNION ALL
SELECT song_id, tempo, NULL FROM songs WHERE mode = 1""")
def q_s3(spark, sf):
    base = checkpoint_dir(spark, "parts")
    s = V.songs(spark, sf)
    s.where(F.col("mode") == 0).select("song_id", "tempo", "danceability").write.parquet(f"{base}/a")
    s.where(F.col("mode") == 1).select("song_id", "tempo").write.parquet(f"{base}/b")
    return IO.scan_union_parts(spark, [f"{base}/a", f"{base}/b"])


@register("write_batches", "SELECT * EXCLUDE (added_at) FROM catalog")
def q_s8(spark, sf):
    path = checkpoint_dir(spark, "batches")
    IO.write_batches(V.catalog(spark, sf).drop("added_at"), path)
    return spark.read.parquet(path)


@register("write_single_file", "SELECT song_id, tempo, key, mode FROM clean_songs")
def q_s9(spark, sf):
    path = checkpoint_dir(spark, "single")
    IO.write_single_file(C.clean_catalog(V.songs(spark, sf)).select("song_id", "tempo", "key", "mode"), path)
    return spark.read.parquet(path)


@register("write_sharded_by_id", """
SELECT song_id, substr(song_id, 3, 1) AS s1, substr(song_id, 4, 1) AS s2, substr(song_id, 5, 1) AS s3 FROM catalog""")
def q_s11(spark, sf):
    path = checkpoint_dir(spark, "shards")
    IO.write_sharded_by_id(V.catalog(spark, sf).select("song_id"), path)
    letters = "s1 string, s2 string, s3 string"   # folder names that look like numbers stay letters
    return spark.read.schema(f"song_id string, {letters}").parquet(path).select("song_id", "s1", "s2", "s3")


@register("songs_metadata_table", """
SELECT song_id, arg_min(title, (title, artist)) AS title, arg_min(artist, (title, artist)) AS artist
FROM songs GROUP BY song_id""")
def q_s14(spark, sf):
    return IO.songs_metadata_table(V.songs(spark, sf))


@register("read_requests_stream", "SELECT key, value FROM request_messages")
def q_s6(spark, sf):
    base, src = _staged(spark, sf, "s6")
    raw = ST.read_requests_stream(spark, "files", src, max_files_per_trigger=2)
    q = raw.writeStream.format("parquet").option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("key", "value")


@register("write_replies", """
SELECT recommendation_id AS key, CAST(json_object('artist', artist, 'title', title, 'tempo', tempo, 'key', key) AS VARCHAR) AS value,
       0 AS batch_id FROM j2""", RQ_SQL)
def q_s7(spark, sf):
    from cadenza.operators import recommend as RC
    path = checkpoint_dir(spark, "replies")
    replies = RC.recommend_batch(V.requests(spark, sf), V.clustered_catalog(spark, sf))
    IO.write_replies(replies, "parquet", path, batch_id=0)
    IO.write_replies(replies, "parquet", path, batch_id=0)   # replay of the same batch: overwritten, not duplicated
    return spark.read.parquet(path).select("key", "value", "batch_id")


@register("scan_relational", """
SELECT 'artist' AS "table", count(*) AS n_rows FROM mb_artist UNION ALL
SELECT 'track', count(*) FROM mb_track UNION ALL
SELECT 'album', count(*) FROM mb_album UNION ALL
SELECT 'release', count(*) FROM mb_release UNION ALL
SELECT 'artist_tag', count(*) FROM mb_artist_tag""")
def q_s5(spark, sf):
    """The music-DB tables as DataFrames.  Production reads them with
    ``io.scan_relational`` (JDBC, partitioned); no database is reachable
    here, so the same tables come from the parquet adapter views."""
    from cadenza.operators.stats import count_rows
    parts = [("artist", V.mb_artist), ("track", V.mb_track), ("album", V.mb_album), ("release", V.mb_release),
             ("artist_tag", V.mb_artist_tag)]
    out = None
    for name, fn in parts:
        c = count_rows(fn(spark, sf), name)
        out = c if out is None else out.unionByName(c)
    return out
