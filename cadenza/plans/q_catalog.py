"""Registered queries: sources, cleaning, encodings and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import harmony as H
from cadenza.operators import clean as C
from cadenza.operators import stats as S
from cadenza.plans.registry import register
from cadenza.sources import catalog as V

R6 = S.r6


def clustered_songs(spark, sf):
    s = C.clean_catalog(V.songs(spark, sf))
    return s.withColumn("cluster_id", V.fixed_cluster(F.col("key"), F.col("time_signature")))


# --- sources -----------------------------------------------------------------

@register("scan_catalog", "SELECT * FROM catalog")
def q_scan_catalog(spark, sf):
    return V.check_schema(V.catalog(spark, sf), V.CATALOG_TYPES)


# --- projections and filters -------------------------------------------------

@register("drop_unused", "SELECT * EXCLUDE (danceability) FROM songs")
def q_drop_unused(spark, sf):
    return C.drop_unused(V.songs(spark, sf))


@register("filter_tempo_range", "SELECT song_id, tempo FROM songs WHERE tempo BETWEEN 40 AND 250")
def q_filter_tempo(spark, sf):
    return C.filter_tempo_range(V.songs(spark, sf)).select("song_id", "tempo")


@register("filter_time_signature",
          "SELECT song_id, time_signature FROM songs WHERE time_signature BETWEEN 1 AND 5")
def q_filter_ts(spark, sf):
    return C.filter_time_signature(V.songs(spark, sf)).select("song_id", "time_signature")


@register("clean_catalog", "SELECT * FROM clean_songs")
def q_clean(spark, sf):
    return C.clean_catalog(V.songs(spark, sf))


@register("filter_cluster", "SELECT * FROM clustered_catalog WHERE cluster_id = 3")
def q_filter_cluster(spark, sf):
    return C.filter_cluster(V.clustered_catalog(spark, sf), 3)


@register("filter_isin", """
SELECT song_id, artist_id FROM songs WHERE artist_id IN (SELECT artist_id FROM artists WHERE gid = '')""")
def q_filter_isin(spark, sf):
    keys = V.artists(spark, sf).where(F.col("gid") == "").select("artist_id")
    return C.filter_isin(V.songs(spark, sf).select("song_id", "artist_id"), "artist_id", keys)


PARSED_SQL = """
SELECT key AS recommendation_id,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.track_name') END AS track_name,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.artist_name') END AS artist_name,
       CASE WHEN json_valid(value) THEN TRY_CAST(json_extract(value, '$.tempo') AS DOUBLE) END AS tempo,
       CASE WHEN json_valid(value) THEN TRY_CAST(json_extract(value, '$.loudness') AS DOUBLE) END AS loudness,
       CASE WHEN json_valid(value) THEN TRY_CAST(json_extract(value, '$.key') AS DOUBLE) END AS key,
       CASE WHEN json_valid(value) THEN TRY_CAST(json_extract(value, '$.mode') AS DOUBLE) END AS mode,
       CASE WHEN json_valid(value) THEN TRY_CAST(json_extract(value, '$.time_signature') AS DOUBLE) END AS time_signature,
       value AS json_str
FROM request_messages"""
PARSED = {"parsed_requests": PARSED_SQL}


@register("flatten_request", "SELECT * EXCLUDE (json_str) FROM parsed_requests", PARSED)
def q_flatten(spark, sf):
    return C.flatten_request(V.request_messages(spark, sf))


@register("tag_with_literal", "SELECT *, 'batch' AS source FROM requests")
def q_tag(spark, sf):
    return C.tag_with_literal(V.requests(spark, sf), "source", "batch")


@register("validate_required", """
SELECT recommendation_id,
       concat_ws(',', CASE WHEN tempo IS NULL THEN 'tempo' END, CASE WHEN loudness IS NULL THEN 'loudness' END,
                 CASE WHEN key IS NULL THEN 'key' END, CASE WHEN mode IS NULL THEN 'mode' END,
                 CASE WHEN time_signature IS NULL THEN 'time_signature' END) AS missing
FROM parsed_requests
WHERE tempo IS NULL OR loudness IS NULL OR key IS NULL OR mode IS NULL OR time_signature IS NULL""", PARSED)
def q_validate(spark, sf):
    _, bad = C.validate_required(C.flatten_request(V.request_messages(spark, sf)))
    return bad.select("recommendation_id", F.concat_ws(",", "missing").alias("missing"))


@register("coerce_types_with_defaults", """
SELECT recommendation_id, track_name, artist_name,
       coalesce(tempo, 0.0) AS tempo, coalesce(loudness, -60.0) AS loudness,
       coalesce(TRY_CAST(trunc(key) AS INT), 0) AS key, coalesce(TRY_CAST(trunc(mode) AS INT), 1) AS mode,
       coalesce(TRY_CAST(trunc(time_signature) AS INT), 4) AS time_signature
FROM parsed_requests""", PARSED)
def q_coerce(spark, sf):
    return C.coerce_types_with_defaults(C.flatten_request(V.request_messages(spark, sf)))


@register("narrow_types", """
SELECT song_id, CAST(tempo AS FLOAT) AS tempo, CAST(loudness AS FLOAT) AS loudness,
       CAST(danceability AS FLOAT) AS danceability, CAST(key AS TINYINT) AS key,
       CAST(mode AS TINYINT) AS mode, CAST(time_signature AS TINYINT) AS time_signature FROM songs""")
def q_narrow(spark, sf):
    s = V.songs(spark, sf).select("song_id", "tempo", "loudness", "danceability", "key", "mode", "time_signature")
    return C.narrow_types(s)


@register("drop_bad_rows", """
SELECT recommendation_id, json_str,
       CASE WHEN track_name IS NULL AND artist_name IS NULL AND tempo IS NULL THEN 'unreadable'
            ELSE concat_ws(',', CASE WHEN tempo IS NULL THEN 'tempo' END, CASE WHEN loudness IS NULL THEN 'loudness' END,
                 CASE WHEN key IS NULL THEN 'key' END, CASE WHEN mode IS NULL THEN 'mode' END,
                 CASE WHEN time_signature IS NULL THEN 'time_signature' END, CASE WHEN abs(tempo) >= 2147483648 THEN 'range:tempo' END, CASE WHEN abs(loudness) >= 2147483648 THEN 'range:loudness' END, CASE WHEN abs(key) >= 2147483648 THEN 'range:key' END, CASE WHEN abs(mode) >= 2147483648 THEN 'range:mode' END, CASE WHEN abs(time_signature) >= 2147483648 THEN 'range:time_signature' END) END AS reason
FROM parsed_requests
WHERE NOT coalesce(abs(tempo) < 2147483648 AND abs(loudness) < 2147483648 AND abs(key) < 2147483648 AND abs(mode) < 2147483648 AND abs(time_signature) < 2147483648, false)""", PARSED)
def q_drop_bad(spark, sf):
    _, bad = C.drop_bad_rows(V.request_messages(spark, sf))
    return bad


@register("sample_songs", """
SELECT song_id, tempo FROM catalog
WHERE CAST(('0x' || substr(md5(song_id || ':42'), 1, 8)) AS BIGINT) / 4294967296.0 < 0.05""")
def q_sample(spark, sf):
    return C.sample_songs(V.catalog(spark, sf), 0.05, 42).select("song_id", "tempo")


@register("song_summary", "SELECT vec_id, label FROM vectors")
def q_summary(spark, sf):
    return C.song_summary(V.vectors(spark, sf))


# --- fixed values (must equal the reference) --------------------------------
EXPECTED_CATALOG_ROWS = 1_000_000   # the integrity scan expects exactly this many songs
# ---------------------------------------------------------------------------


SONG_FIELDS = ("song_id", "title", "artist", "artist_id", "album_id", "tempo", "loudness", "key", "mode", "time_signature",
               "danceability", "year", "added_at")
FRACTIONS = ("tempo", "loudness", "danceability")
DOMAINS = {"tempo": (40, 250), "key": (0, 11), "mode": (0, 1), "time_signature": (1, 5)}


def _quality_sql(c):
    nan = f"count_if(isnan({c}))" if c in FRACTIONS else "0"
    out = f"count_if({c} IS NOT NULL AND NOT {c} BETWEEN {DOMAINS[c][0]} AND {DOMAINS[c][1]})" if c in DOMAINS else "0"
    return (f"SELECT '{c}' AS \"column\", count(*) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
            f"CAST({nan} AS BIGINT) AS n_nan, CAST({out} AS BIGINT) AS n_out_of_domain, "
            f"count(*) = {EXPECTED_CATALOG_ROWS} AS rows_as_expected FROM songs")


@register("data_quality_scan", " UNION ALL ".join(map(_quality_sql, SONG_FIELDS)))
def q_quality(spark, sf):
    return C.data_quality_scan(V.songs(spark, sf).select(*SONG_FIELDS), DOMAINS, expected_rows=EXPECTED_CATALOG_ROWS)


# --- scalar encodings ----------------------------------------------------------

@register("key_circular", """
SELECT song_id, round(sin(2 * pi() * key / 12), 6) AS key_sin, round(cos(2 * pi() * key / 12), 6) AS key_cos
FROM clean_songs""")
def q_key_circular(spark, sf):
    s = C.clean_catalog(V.songs(spark, sf))
    return s.select("song_id", R6(H.key_sin(F.col("key"))).alias("key_sin"), R6(H.key_cos(F.col("key"))).alias("key_cos"))


@register("loudness_positive", """
SELECT song_id, round(loudness + abs((SELECT min(loudness) FROM clean_songs)) + 1, 6) AS loudness_pos
FROM clean_songs""")
def q_loudness_pos(spark, sf):
    s = C.clean_catalog(V.songs(spark, sf))
    # the offset is a scalar subquery over the same frame (no driver collect)
    off = S.min_loudness(s).scalar()
    return s.select("song_id", R6(F.col("loudness") + F.abs(off) + 1).alias("loudness_pos"))


@register("mode_major", "SELECT song_id, CASE WHEN mode = 1 THEN 1 ELSE 0 END AS mode_major FROM clean_songs")
def q_mode_major(spark, sf):
    s = C.clean_catalog(V.songs(spark, sf))
    return s.select("song_id", H.mode_major(F.col("mode")).alias("mode_major"))


CAMELOT_SQL = {"camelot_tbl": """
SELECT * FROM (VALUES (0, 8, 5), (1, 3, 12), (2, 10, 7), (3, 5, 2), (4, 12, 9), (5, 7, 4),
                      (6, 2, 11), (7, 9, 6), (8, 4, 1), (9, 11, 8), (10, 6, 3), (11, 1, 10)) t(k, major_num, minor_num)"""}

REQ_CAMELOT_SQL = """
SELECT r.recommendation_id, r.key, r.mode,
       CASE WHEN r.key IS NULL OR r.mode IS NULL THEN NULL WHEN r.mode = 1 THEN c.major_num ELSE c.minor_num END AS camelot_num,
       CASE WHEN r.mode = 1 THEN 'B' ELSE 'A' END AS camelot_letter
FROM requests r LEFT JOIN camelot_tbl c ON c.k = CAST(trunc(r.key) AS INT)"""


@register("camelot_number", "SELECT recommendation_id, camelot_num FROM req_camelot",
          {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_number(spark, sf):
    r = V.requests(spark, sf)
    return r.select("recommendation_id", H.camelot_number(F.col("key"), F.col("mode")).alias("camelot_num"))


@register("camelot_letter", "SELECT recommendation_id, camelot_letter FROM req_camelot",
          {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_letter(spark, sf):
    r = V.requests(spark, sf)
    return r.select("recommendation_id", H.camelot_letter(F.col("mode")).alias("camelot_letter"))


@register("camelot_code", "SELECT recommendation_id, CAST(camelot_num AS VARCHAR) || camelot_letter AS camelot FROM req_camelot",
          {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_code(spark, sf):
    r = V.requests(spark, sf)
    return r.select("recommendation_id", H.camelot_code(F.col("key"), F.col("mode")).alias("camelot"))


@register("camelot_neighbors", """
SELECT DISTINCT camelot_num, camelot_letter,
  [CAST(camelot_num AS VARCHAR) || camelot_letter,
   CAST(CASE WHEN camelot_num > 1 THEN camelot_num - 1 ELSE 12 END AS VARCHAR) || camelot_letter,
   CAST(CASE WHEN camelot_num < 12 THEN camelot_num + 1 ELSE 1 END AS VARCHAR) || camelot_letter,
   CAST(camelot_num AS VARCHAR) || CASE WHEN camelot_letter = 'A' THEN 'B' ELSE 'A' END] AS neighbors
FROM req_camelot""", {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_neighbors(spark, sf):
    r = H.with_camelot(V.requests(spark, sf))
    return r.select("camelot_num", "camelot_letter",
                    H.camelot_neighbors(F.col("camelot_num"), F.col("camelot_letter")).alias("neighbors")).distinct()


@register("camelot_circular", """
SELECT recommendation_id, round(cos(2 * pi() * (camelot_num - 1) / 12), 6) AS camelot_cos,
       round(sin(2 * pi() * (camelot_num - 1) / 12), 6) AS camelot_sin FROM req_camelot""",
          {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_circular(spark, sf):
    r = H.with_camelot(V.requests(spark, sf))
    return r.select("recommendation_id", R6(H.camelot_cos(F.col("camelot_num"))).alias("camelot_cos"),
                    R6(H.camelot_sin(F.col("camelot_num"))).alias("camelot_sin"))


@register("camelot_mode_small", """
SELECT recommendation_id, CAST(CASE WHEN camelot_letter = 'B' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS camelot_mode_small FROM req_camelot""",
          {**CAMELOT_SQL, "req_camelot": REQ_CAMELOT_SQL})
def q_camelot_mode_small(spark, sf):
    r = H.with_camelot(V.requests(spark, sf))
    return r.select("recommendation_id", H.camelot_mode_small(F.col("camelot_letter")).alias("camelot_mode_small"))


@register("tempo_bin", "SELECT song_id, CAST(floor(tempo / 5) * 5 AS INT) AS tempo_bin FROM clean_songs")
def q_tempo_bin(spark, sf):
    s = C.clean_catalog(V.songs(spark, sf))
    return s.select("song_id", H.tempo_bin(F.col("tempo")).alias("tempo_bin"))


# --- statistics -----------------------------------------------------------------

@register("min_loudness", "SELECT min(loudness) AS min_loudness FROM clean_songs")
def q_min_loudness(spark, sf):
    return S.min_loudness(C.clean_catalog(V.songs(spark, sf)))


@register("cluster_sizes", "SELECT cluster_id, count(*) AS n_songs FROM clustered_catalog GROUP BY cluster_id")
def q_cluster_sizes(spark, sf):
    return S.cluster_sizes(V.clustered_catalog(spark, sf))


FEATS = ("tempo", "loudness", "key", "mode", "time_signature")


@register("cluster_means", "SELECT cluster_id, " + ", ".join(
    f"round(avg({f}), 6) AS avg_{f}" for f in FEATS) + " FROM clustered_songs GROUP BY cluster_id")
def q_cluster_means(spark, sf):
    return S.cluster_means(clustered_songs(spark, sf))


@register("cluster_stats", "SELECT cluster_id, " + ", ".join(
    f"round(avg({f}), 6) AS avg_{f}, CAST(min({f}) AS DOUBLE) AS min_{f}, CAST(max({f}) AS DOUBLE) AS max_{f}"
    for f in FEATS) + " FROM clustered_songs GROUP BY cluster_id")
def q_cluster_stats(spark, sf):
    return S.cluster_stats(clustered_songs(spark, sf))


@register("tempo_key_histogram", """
SELECT CAST(floor(tempo / 5) * 5 AS INT) AS tempo_bin, key, count(*) AS n_songs
FROM clean_songs GROUP BY 1, 2""", headline=True)
def q_histogram(spark, sf):
    return S.tempo_key_histogram(C.clean_catalog(V.songs(spark, sf)))


@register("tempo_key_pivot", "SELECT key, " + ", ".join(
    f"CAST(count_if(CAST(floor(tempo / 5) * 5 AS INT) = {b}) AS BIGINT) AS bin_{b}" for b in S.tempo_bins())
    + " FROM clean_songs GROUP BY key")
def q_pivot(spark, sf):
    return S.tempo_key_pivot(C.clean_catalog(V.songs(spark, sf)))


CLEAN_COLUMNS = {  # of clean_songs: every column, and how its values are written
    "song_id": "VARCHAR", "title": "VARCHAR", "artist": "VARCHAR", "artist_id": "VARCHAR", "album_id": "VARCHAR",
    "tempo": "DECIMAL(30,6)", "loudness": "DECIMAL(30,6)", "key": "VARCHAR", "mode": "VARCHAR", "time_signature": "VARCHAR",
    "year": "VARCHAR", "added_at": "VARCHAR",
}


@register("value_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(CAST({c} AS {t}) AS VARCHAR) AS value, count(*) AS n FROM clean_songs GROUP BY 2"
    for c, t in CLEAN_COLUMNS.items()))
def q_value_counts(spark, sf):
    df = C.clean_catalog(V.songs(spark, sf))
    return S.value_counts(df, df.columns)


def _profile_sql(cols, qs=(0.25, 0.5, 0.75)):
    parts = []
    for c in cols:
        qsql = ", ".join(
            f"list_sort(list(CAST({c} AS DOUBLE)))[CAST(greatest(ceil({q} * count({c})), 1) AS BIGINT)] AS q{int(q * 100)}"
            for q in qs)
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
            f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, {qsql} FROM clean_songs")
    return " UNION ALL ".join(parts)


NUMERIC = ("artist_id", "album_id", "tempo", "loudness", "key", "mode", "time_signature", "year")


@register("profile_columns", _profile_sql(NUMERIC))
def q_profile(spark, sf):
    return S.profile_columns(C.clean_catalog(V.songs(spark, sf)), NUMERIC)


TEXT = ("song_id", "title", "artist", "added_at")


@register("profile_text_columns", " UNION ALL ".join(f"""
SELECT count(*) AS n_rows, '{c}' AS "column", count(*) - count(v) AS n_null, count(DISTINCT v) AS n_distinct,
       min(v) AS smallest, quantile_disc(v, 0.5) AS median, max(v) AS largest, CAST(min(length(v)) AS INT) AS min_length,
       CAST(max(length(v)) AS INT) AS max_length, round(avg(length(v)), 6) AS mean_length,
       (SELECT arg_min(x, (-n, x)) FROM (SELECT CAST({c} AS VARCHAR) AS x, count(*) AS n FROM clean_songs WHERE {c} IS NOT NULL GROUP BY 1)) AS most_frequent,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM clean_songs WHERE {c} IS NOT NULL GROUP BY {c})) AS n_most_frequent
FROM (SELECT CAST({c} AS VARCHAR) AS v FROM clean_songs)""" for c in TEXT))
def q_profile_text(spark, sf):
    return S.profile_text_columns(C.clean_catalog(V.songs(spark, sf)), TEXT)


CORR_COLS = NUMERIC


@register("feature_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM clean_songs"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def q_corr(spark, sf):
    return S.feature_correlation(C.clean_catalog(V.songs(spark, sf)), CORR_COLS)


@register("count_songs", """
SELECT 'songs' AS "table", count(*) AS n_rows FROM songs UNION ALL
SELECT 'catalog', count(*) FROM catalog UNION ALL
SELECT 'clean', count(*) FROM clean_songs""")
def q_count(spark, sf):
    s = V.songs(spark, sf)
    return S.count_rows(s, "songs").unionByName(S.count_rows(V.catalog(spark, sf), "catalog")).unionByName(
        S.count_rows(C.clean_catalog(s), "clean"))


@register("shard_balance", """
WITH per AS (SELECT substr(song_id, 3, 3) AS shard, count(*) AS n FROM catalog GROUP BY 1)
SELECT min(n) AS min_rows, max(n) AS max_rows, round(avg(n), 6) AS avg_rows, count(*) AS n_shards,
       CAST(4096 AS BIGINT) AS possible_shards, arg_min(shard, (n, shard)) AS emptiest,
       arg_min(shard, (-n, shard)) AS fullest FROM per""")
def q_shard_balance(spark, sf):
    return S.shard_balance(V.catalog(spark, sf))


@register("distinct_clusters", """
SELECT cluster_id, (SELECT count(DISTINCT cluster_id) FROM clustered_catalog) AS n_clusters
FROM (SELECT DISTINCT cluster_id FROM clustered_catalog)""")
def q_distinct_clusters(spark, sf):
    return S.distinct_clusters(V.clustered_catalog(spark, sf))


@register("cluster_centroids", """
SELECT label, CAST(d - 1 AS INT) AS dim, round(avg(x), 6) AS mean
FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM vectors) GROUP BY label, d""")
def q_centroids(spark, sf):
    return S.cluster_centroids(V.vectors(spark, sf))


@register("rows_to_frame", """
SELECT CAST(c.num AS VARCHAR) || c.letter AS camelot, count(*) AS n_songs
FROM clean_songs s JOIN (SELECT k, major_num AS num, 'B' AS letter, 1 AS mode FROM camelot_tbl UNION ALL
                         SELECT k, minor_num, 'A', 0 FROM camelot_tbl) c ON c.k = s.key AND c.mode = s.mode
GROUP BY 1""", CAMELOT_SQL)
def q_s12(spark, sf):
    """The Camelot wheel (fixed values, 24 rows) as a frame, joined to the
    catalog: songs per wheel position."""
    from cadenza.sources.io import rows_to_frame
    rows = [(k, H.CAMELOT_MAJOR[k], "B", 1) for k in range(12)] + [(k, H.CAMELOT_MINOR[k], "A", 0) for k in range(12)]
    wheel = rows_to_frame(spark, rows, "k int, num int, letter string, mode int")
    s = C.clean_catalog(V.songs(spark, sf))
    j = s.join(F.broadcast(wheel), (s.key == wheel.k) & (s.mode == wheel.mode))   # 24 rows: fixed size
    return j.groupBy(F.concat(F.col("num").cast("string"), F.col("letter")).alias("camelot")).agg(
        F.count(F.lit(1)).alias("n_songs"))


@register("tempo_diff", """
SELECT s.song_id, round(abs(s.tempo - c.avg_tempo), 6) AS tempo_diff
FROM clustered_catalog s JOIN (SELECT cluster_id, avg(tempo) AS avg_tempo FROM clustered_catalog GROUP BY 1) c
  ON c.cluster_id = s.cluster_id""")
def q_h15(spark, sf):
    cat = V.clustered_catalog(spark, sf)
    centre = cat.groupBy("cluster_id").agg(F.avg("tempo").alias("avg_tempo"))   # one row per cluster
    return cat.join(F.broadcast(centre), "cluster_id").select(
        "song_id", R6(H.tempo_diff(F.col("tempo"), F.col("avg_tempo"))).alias("tempo_diff"))
