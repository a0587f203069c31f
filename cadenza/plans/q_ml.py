"""Registered queries: features, K-Means, PCA, classifier, MMR."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.functions import vectors as VX
from cadenza.operators import clean as C
from cadenza.operators import mmr as MM
from cadenza.operators import recommend as RC
from cadenza.operators import stats as S
from cadenza.plans import classify as CL
from cadenza.plans import model as MD
from cadenza.plans import serving as SV
from cadenza.plans.q_catalog import CAMELOT_SQL
from cadenza.plans.q_discover import song_timbre
from cadenza.plans.q_recommend import CENTER_SQL, label_centers, search_seeds
from cadenza.plans.registry import register
from cadenza.session import checkpoint_dir, cut_lineage
from cadenza.sources import catalog as V
from cadenza.streaming import stream as ST


def training_songs(spark, sf):
    """Cleaned catalog songs (P4) — the training input."""
    return C.clean_catalog(V.catalog(spark, sf))


def fitted_spec(spark, sf):
    spec = MD.FeatureSpec()
    spec.loudness_offset = MD.fit_loudness_offset(training_songs(spark, sf))
    return spec


FEAT_SQL = {
    **CAMELOT_SQL,
    "feat": """
SELECT s.song_id, s.tempo,
       s.loudness + abs((SELECT min(loudness) FROM catalog WHERE tempo BETWEEN 40 AND 250 AND time_signature BETWEEN 1 AND 5)) + 1 AS loudness_pos,
       cos(2 * pi() * (CASE WHEN s.mode = 1 THEN c.major_num ELSE c.minor_num END - 1) / 12) AS camelot_cos,
       sin(2 * pi() * (CASE WHEN s.mode = 1 THEN c.major_num ELSE c.minor_num END - 1) / 12) AS camelot_sin,
       CAST(CASE WHEN s.mode = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS camelot_mode_small,
       CAST(s.time_signature AS DOUBLE) AS time_signature
FROM catalog s JOIN camelot_tbl c ON c.k = s.key
WHERE s.tempo BETWEEN 40 AND 250 AND s.time_signature BETWEEN 1 AND 5""",
    "scaled": """
SELECT song_id, """ + ", ".join(
        f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE {c} / stddev_samp({c}) OVER () END AS s{i}"
        for i, c in enumerate(MD.V8_COLUMNS)) + " FROM feat",
}


def _features(spark, sf):
    spec = fitted_spec(spark, sf)
    return MD.prepare(training_songs(spark, sf), spec), spec


@register("assemble_features", "SELECT song_id, " + ", ".join(
    f"round({c}, 6) AS f_{i}" for i, c in enumerate(MD.V8_COLUMNS)) + " FROM feat", FEAT_SQL)
def q_m1(spark, sf):
    df, spec = _features(spark, sf)
    a = MD.assembler(spec).transform(df).withColumn("_a", vector_to_array("features_vec"))
    return a.select("song_id", *[F.round(F.col("_a")[i], 6).alias(f"f_{i}") for i in range(len(spec.columns))])


@register("scale_features", "SELECT song_id, " + ", ".join(
    f"round(s{i}, 6) AS f_{i}" for i in range(6)) + " FROM scaled", FEAT_SQL)
def q_m2(spark, sf):
    df, spec = _features(spark, sf)
    a = MD.assembler(spec).transform(df)
    s = MD.scaler().fit(a).transform(a).withColumn("_a", vector_to_array("scaled_features"))
    return s.select("song_id", *[F.round(F.col("_a")[i], 6).alias(f"f_{i}") for i in range(6)])


@register("weight_features", "SELECT song_id, " + ", ".join(
    f"round(s{i} * {w}, 6) AS f_{i}" for i, w in enumerate(MD.V8_WEIGHTS)) + " FROM scaled", FEAT_SQL)
def q_h10(spark, sf):
    df, spec = _features(spark, sf)
    a = MD.assembler(spec).transform(df)
    s = MD.scaler().fit(a).transform(a).withColumn("_a", vector_to_array("scaled_features"))
    w = s.withColumn("_w", VX.weight_features("_a", spec.weights))
    return w.select("song_id", *[F.round(F.col("_w")[i], 6).alias(f"f_{i}") for i in range(6)])


@register("flatten_vector", "SELECT song_id, " + ", ".join(
    f"round(s{i} * {w}, 6) AS f_{i}" for i, w in enumerate(MD.V8_WEIGHTS))
          + ", CAST((key * 7 + time_signature) % 11 AS INT) AS label FROM scaled JOIN catalog USING (song_id)", FEAT_SQL)
def q_h12(spark, sf):
    df, spec = _features(spark, sf)
    feats = MD.Pipeline(stages=[MD.assembler(spec), MD.scaler(), MD.weighting(spec)]).fit(df).transform(df)
    arr = feats.withColumn("_w", vector_to_array("weighted_scaled_features")).withColumn(
        "label", V.fixed_cluster(F.col("key"), F.col("time_signature").cast("int")))
    flat = VX.flatten_vector(arr, "_w", len(spec.columns), keep=("song_id", "label"))
    return flat.select("song_id", "label", *[F.round(f"f_{i}", 6).alias(f"f_{i}") for i in range(6)])


@register("vector_array_roundtrip", "SELECT vec_id, true AS same FROM vectors")
def q_h11(spark, sf):
    v = V.vectors(spark, sf)
    back = v.withColumn("_v", array_to_vector("embedding")).withColumn("_a", vector_to_array("_v"))
    return back.select("vec_id", (F.col("_a") == F.col("embedding")).alias("same"))


@register("parse_vector_literal", "SELECT vec_id, embedding AS vec FROM vectors")
def q_h13(spark, sf):
    v = V.vectors(spark, sf).select("vec_id", F.to_json("embedding").alias("txt"))
    return v.select("vec_id", VX.parse_vector_literal("txt").alias("vec"))


def training_features(spark, sf):
    """What the feature spec takes of the training songs, stored: the offset,
    the scaler, the fit and the prediction read it."""
    return cut_lineage(training_songs(spark, sf).select("song_id", "tempo", "loudness", "key", "mode", "time_signature"))


def _fit(spark, sf, k=None):
    songs = training_features(spark, sf)
    spec = MD.FeatureSpec(loudness_offset=MD.fit_loudness_offset(songs))
    return MD.fit_pipeline(songs, spec, k), spec, songs


def lloyd_sql(models: list[tuple[int, int, tuple]], body: str, source: str = "scaled", dims: int = 6) -> str:
    """DuckDB twin of the K-Means fits of ``models`` (number, k, weights) on the
    scaled features of ``source``: ``fin`` holds their centres, ``asg`` every
    song's cluster with its squared distance, for ``body`` to use."""
    d = range(dims)
    xs, ys = ", ".join(f"x{i}" for i in d), ", ".join(f"y{i}" for i in d)
    rows = ", ".join(f"({m}, {k}, " + ", ".join(f"CAST({float(w)!r} AS DOUBLE)" for w in ws) + ")" for m, k, ws in models)
    near = " + ".join(f"(p.s{i} * o.w{i} - k.x{i}) * (p.s{i} * o.w{i} - k.x{i})" for i in d)
    new = ", ".join(f"coalesce(a.y{i}, k.x{i}) AS x{i}" for i in d)
    step = " + ".join(f"(coalesce(a.y{i}, k.x{i}) - k.x{i}) * (coalesce(a.y{i}, k.x{i}) - k.x{i})" for i in d)

    def nearest(centers: str) -> str:
        weighted = ", ".join(f"any_value(p.s{i} * o.w{i}) AS y{i}" for i in d)
        return f"""SELECT k.m, p.song_id, arg_min(k.c, ({near}, k.c)) AS c, min({near}) AS d, {weighted}
        FROM p, {centers} k JOIN models o ON o.m = k.m GROUP BY k.m, p.song_id"""

    return f"""
WITH RECURSIVE models(m, k, {", ".join(f"w{i}" for i in d)}) AS (VALUES {rows}),
p AS MATERIALIZED (SELECT song_id, {", ".join(f"s{i}" for i in d)} FROM {source}),
st AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(song_id), song_id) - 1 AS c, * FROM p QUALIFY c < {max(k for _, k, _ in models)}),
km AS (
  SELECT 0 AS it, m, c, {", ".join(f"s{i} * w{i} AS x{i}" for i in d)}, CAST(1e9 AS DOUBLE) AS moved FROM st JOIN models ON c < k
  UNION ALL
  SELECT it + 1, m, c, {xs}, max(sqrt(step)) OVER (PARTITION BY m) FROM (
    SELECT k.it, k.m, k.c, {new}, {step} AS step
    FROM km k LEFT JOIN (SELECT m, c, {", ".join(f"avg(y{i}) AS y{i}" for i in d)} FROM (
        {nearest("(SELECT * FROM km WHERE it < " + str(MD.KMEANS_MAX_ITER) + f" AND moved > {MD.KMEANS_TOL})")}) GROUP BY m, c) a ON a.m = k.m AND a.c = k.c
    WHERE k.it < {MD.KMEANS_MAX_ITER} AND k.moved > {MD.KMEANS_TOL})
),
fin AS MATERIALIZED (SELECT * FROM km QUALIFY it = max(it) OVER (PARTITION BY m)),
asg AS MATERIALIZED ({nearest("fin")}),
per AS MATERIALIZED (
  SELECT m, c, count(*) AS n, sum({" + ".join(f"y{i} * y{i}" for i in d)}) AS psi, {", ".join(f"sum(y{i}) AS t{i}" for i in d)} FROM asg GROUP BY m, c),
away AS (
  SELECT a.m, a.song_id, a.c AS own, p.c, p.n,
         {" + ".join(f"y{i} * y{i}" for i in d)} + p.psi / p.n - 2 * ({" + ".join(f"y{i} * t{i}" for i in d)}) / p.n AS far
  FROM asg a JOIN per p ON p.m = a.m),
sil AS (
  SELECT m, avg(CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END) AS s FROM (
    SELECT m, song_id, max(CASE WHEN c = own THEN far * n / (n - 1) END) AS a, min(CASE WHEN c <> own THEN far END) AS b,
           max(CASE WHEN c = own THEN n END) AS own_n FROM away GROUP BY m, song_id) GROUP BY m)
{body}"""


DEPLOYED = [(0, MD.DEPLOYED_K, MD.V8_WEIGHTS)]


@register("fit_kmeans", lloyd_sql(DEPLOYED, """
SELECT CAST(f.c AS INT) AS cluster_id, CAST(coalesce(n, 0) AS BIGINT) AS n_songs, """ + ", ".join(f"round(x{i}, 6) AS x{i}" for i in range(6)) + """,
       (SELECT round(sum(d), 3) FROM asg) AS cost, (SELECT round(s, 6) FROM sil) AS silhouette
FROM fin f LEFT JOIN per p ON p.c = f.c"""), FEAT_SQL)
def q_m3(spark, sf):
    """The centres with their songs, the cost and the silhouette."""
    rows = MD.scaled_rows(training_features(spark, sf), MD.FeatureSpec())
    (fit,), _ = MD.KM.fit_many(rows, "s", [(list(MD.V8_WEIGHTS), MD.DEPLOYED_K)], "song_id", MD.KMEANS_MAX_ITER, MD.KMEANS_TOL)
    out = [(i, n, *[round(float(x), 6) for x in c], round(fit.cost, 3), round(fit.silhouette, 6)) for i, (c, n) in enumerate(zip(fit.centers, fit.sizes))]
    return spark.createDataFrame(out, "cluster_id int, n_songs long, " + ", ".join(f"x{i} double" for i in range(6)) + ", cost double, silhouette double")


@register("predict_cluster", lloyd_sql(DEPLOYED, "SELECT song_id, CAST(c AS INT) AS cluster_id, round(d, 6) AS sqdist FROM asg"), FEAT_SQL)
def q_m4(spark, sf):
    """Every song's cluster under the fitted pipeline, and its distance to the centre."""
    model, spec, songs = _fit(spark, sf)
    centers = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    pred = MD.predict_cluster(model, songs, spec).select("song_id", "cluster_id", vector_to_array("weighted_scaled_features").alias("w"))
    own = F.get(F.array(*[F.array(*[F.lit(x) for x in c]) for c in centers]), F.col("cluster_id"))
    return pred.select("song_id", "cluster_id", F.round(VX.squared_distance(F.col("w"), own), 6).alias("sqdist"))


SIL_SQL = {
    "pts": "SELECT vec_id, label, embedding AS e, list_dot_product(embedding, embedding) AS nn FROM vectors",
    "cly": """
SELECT label AS c, list(s ORDER BY d) AS y FROM (
  SELECT label, d, sum(e[d]) AS s FROM pts, range(1, 65) t(d) GROUP BY label, d) GROUP BY label""",
    "cl2": """
SELECT c.c, c.n, c.psi, y.y FROM (SELECT label AS c, count(*) AS n, sum(nn) AS psi FROM pts GROUP BY label) c
JOIN cly y ON y.c = c.c""",
    "dist": """
SELECT p.vec_id, p.label, c.c, c.n, p.nn + c.psi / c.n - 2 * list_dot_product(p.e, c.y) / c.n AS d FROM pts p, cl2 c""",
    "coef": """
SELECT vec_id, CASE WHEN own_n = 1 THEN 0.0
                    WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM (
  SELECT vec_id, max(CASE WHEN c = label THEN d * n / (n - 1) END) AS a,
         min(CASE WHEN c <> label THEN d END) AS b, max(CASE WHEN c = label THEN n END) AS own_n
  FROM dist GROUP BY vec_id)""",
}


@register("silhouette", "SELECT round(avg(s), 6) AS silhouette FROM coef", SIL_SQL)
def q_m5(spark, sf):
    v = V.vectors(spark, sf).withColumn("features", array_to_vector("embedding")) \
        .withColumn("label", F.col("label").cast("double"))
    s = MD.silhouette(v, "features", "label")
    return spark.createDataFrame([(round(s, 6),)], "silhouette double")


@register("sweep_k", lloyd_sql([(k, k, MD.V8_WEIGHTS) for k in MD.SWEEP_V8], """
SELECT CAST(m AS INT) AS k, round(cost, 3) AS cost, round(s, 6) AS silhouette FROM (SELECT m, sum(d) AS cost FROM asg GROUP BY m) JOIN sil USING (m)"""), FEAT_SQL)
def q_m6(spark, sf):
    """Cost and silhouette of each k of the sweep."""
    out = MD.sweep_k(training_features(spark, sf), MD.FeatureSpec(), MD.SWEEP_V8)
    return out.select("k", F.round("cost", 3).alias("cost"), F.round("silhouette", 6).alias("silhouette"))


V7_SQL = {
    **FEAT_SQL,
    "feat7": """
SELECT song_id, f.tempo, loudness_pos, sin(2 * pi() * key / 12) AS key_sin, cos(2 * pi() * key / 12) AS key_cos,
       CAST(mode AS DOUBLE) AS mode_major, f.time_signature FROM feat f JOIN (SELECT song_id, key, mode FROM catalog) USING (song_id)""",
    "scaled7": """
SELECT song_id, """ + ", ".join(
        f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN 0.0 ELSE {c} / stddev_samp({c}) OVER () END AS s{i}"
        for i, c in enumerate(MD.V7_COLUMNS)) + " FROM feat7",
}
WEIGHT_NAMES = ("tempo", "loudness", "key_a", "key_b", "mode", "time_signature")
GRID = MD.weight_grid()


@register("search_weights", lloyd_sql([(m, MD.SEARCH_K, w) for m, w in enumerate(GRID)], """
SELECT """ + ", ".join(f"w{i} AS {n}" for i, n in enumerate(WEIGHT_NAMES)) + """, round(s, 6) AS silhouette, s = max(s) OVER () AS is_best
FROM models JOIN sil USING (m)""", "scaled7"), V7_SQL)
def q_m7(spark, sf):
    """The silhouette of each weight vector of the grid, the best one flagged."""
    songs = training_features(spark, sf)
    spec = MD.FeatureSpec(columns=MD.V7_COLUMNS, loudness_offset=MD.fit_loudness_offset(songs))
    out = MD.search_weights(songs, spec)
    return out.select(*[F.col("weights")[i].alias(n) for i, n in enumerate(WEIGHT_NAMES)], F.round("silhouette", 6).alias("silhouette"), "is_best")


# --- the older model: 30 features -------------------------------------------------

V3_SQL = {
    "feat30": "SELECT c.song_id, c.title, c.artist, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MD.V3_COLUMNS) + """
FROM catalog c JOIN song_attributes a USING (song_id) JOIN timbre_stats t USING (song_id)
WHERE c.tempo BETWEEN 40 AND 250 AND c.time_signature BETWEEN 1 AND 5""",
    "sd30": "SELECT " + ", ".join(f"stddev_samp({c}) AS d{i}" for i, c in enumerate(MD.V3_COLUMNS)) + " FROM feat30",
    "scaled30": "SELECT song_id, title, artist, " + ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE {c} / d{i} END AS s{i}" for i, c in enumerate(MD.V3_COLUMNS)) + " FROM feat30, sd30",
    "asked30": """
SELECT upper(substr(sha1(concat_ws('-', event_type, event_id)),1,16)) AS recommendation_id, 30 + event_id % 240 AS tempo, -(event_id % 60) AS loudness,
       60 + event_id % 300 AS duration, user_id % 12 AS key, event_id % 2 AS mode, event_id % 7 AS time_signature, """
    + ", ".join(f"0 AS timbre_mean_{i}" for i in range(12)) + ", " + ", ".join(f"1 AS timbre_std_{i}" for i in range(12)) + """
FROM events WHERE event_type NOT IN ('error', 'signup')""",
}


def features_v3(spark, sf):
    """Cleaned songs with the 30 features of the older model."""
    names = ("song_id", "title", "artist", "tempo", "loudness", "key", "mode", "time_signature")
    songs = C.clean_catalog(V.catalog_with_attributes(spark, sf, *names)).select(*names, "duration")   # the line items are sent once
    return songs.join(song_timbre(spark, sf, None), "song_id")


@register("stream_recommend_v3", lloyd_sql([(0, MD.V3_K, (1.0,) * len(MD.V3_COLUMNS))], """
SELECT q.recommendation_id AS key, CAST(json_object('artist', artist, 'title', title) AS VARCHAR) AS value
FROM (SELECT recommendation_id, arg_min(f.c, (""" + " + ".join(f"(y{i} - f.x{i}) * (y{i} - f.x{i})" for i in range(30)) + """, f.c)) AS c
      FROM (SELECT recommendation_id, """ + ", ".join(f"CASE WHEN d{i} = 0 THEN 0.0 ELSE {c} / d{i} END AS y{i}" for i, c in enumerate(MD.V3_COLUMNS)) + """
            FROM asked30, sd30), fin f GROUP BY recommendation_id) q
JOIN (SELECT c, song_id FROM asg QUALIFY row_number() OVER (PARTITION BY c ORDER BY song_id) <= 3) t ON t.c = q.c
JOIN feat30 s ON s.song_id = t.song_id""", "scaled30", 30), V3_SQL)
def q_t3(spark, sf):
    """The older stream behind a fitted, stored and loaded 30-feature pipeline."""
    base = checkpoint_dir(spark, "t3")
    songs = cut_lineage(features_v3(spark, sf))
    MD.pipeline_v3().fit(songs).write().overwrite().save(f"{base}/model")
    model = MD.PipelineModel.load(f"{base}/model")
    ST.stage_messages(V.feature_messages(spark, sf), f"{base}/in")
    ST.stream_recommend_v3(spark, songs, model, f"{base}/in", f"{base}/out", f"{base}/ckpt", f"{base}/dead", MD.V3_COLUMNS)
    return ST.read_output(spark, f"{base}/out").select("key", "value")


def _pca(spark, sf, k):
    model, spec, songs = _fit(spark, sf)
    pred = MD.predict_cluster(model, songs, spec)
    return MD.pca_fit(pred, k), model, pred


@register("pca_explained", """
SELECT CAST(range AS INT) AS component, true AS in_range, true AS not_above_the_one_before FROM range(5)""")
def q_m8(spark, sf):
    spec = fitted_spec(spark, sf)
    df = MD.prepare(training_songs(spark, sf), spec)
    a = MD.assembler(spec).transform(df)
    scaled = MD.scaler().fit(a).transform(a)
    out = MD.pca_explained(MD.pca_fit(scaled, 5, "scaled_features"), spark)
    before = F.lag("explained_variance").over(Window.partitionBy(F.lit(1)).orderBy("component"))   # 5 rows
    return out.select("component", F.col("explained_variance").between(0.0, 1.0).alias("in_range"),
                      F.coalesce(F.col("explained_variance") <= before + 1e-12, F.lit(True)).alias("not_above_the_one_before"))


@register("pca_project_2d", """
SELECT count(*) AS n_songs, true AS uncorrelated, true AS first_spreads_more FROM feat""", FEAT_SQL)
def q_m9(spark, sf):
    """Over all songs: the two coordinates are uncorrelated, the first has the larger variance."""
    pca, _, pred = _pca(spark, sf, 2)
    return MD.pca_project_2d(pca, pred).agg(
        F.count(F.lit(1)).alias("n_songs"), (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
        (F.var_samp("x") >= F.var_samp("y")).alias("first_spreads_more"))


@register("project_centroids", "SELECT CAST(range AS INT) AS cluster_id, true AS is_the_product FROM range(11)")
def q_m10(spark, sf):
    """Each projected centre is the centre times the principal components."""
    pca, model, _ = _pca(spark, sf, 2)
    centers = model.stages[-1].clusterCenters()
    want = [(i, *map(float, pca.pc.toArray().T @ c)) for i, c in enumerate(centers)]
    expected = spark.createDataFrame(want, "cluster_id int, px double, py double")
    return MD.project_centroids(pca, centers, spark).join(expected, "cluster_id").select(
        F.col("cluster_id").cast("int").alias("cluster_id"),
        ((F.abs(F.col("x") - F.col("px")) < 1e-9) & (F.abs(F.col("y") - F.col("py")) < 1e-9)).alias("is_the_product"))


@register("projected_centroids", "SELECT CAST(range AS INT) AS cluster_id, true AS is_the_mean FROM range(11)")
def q_a17(spark, sf):
    """Each mean plot coordinate is the projection of the songs' mean vector."""
    pca, _, pred = _pca(spark, sf, 2)
    mean = S.centroid_arrays(pred.select("cluster_id", vector_to_array("weighted_scaled_features").alias("w")), "w", "cluster_id")
    px, py = (F.aggregate(F.zip_with("centroid", F.array(*[F.lit(float(x)) for x in pca.pc.toArray()[:, j]]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) for j in (0, 1))
    return MD.projected_centroids(MD.pca_project_2d(pca, pred)).join(mean, "cluster_id").select(
        "cluster_id", ((F.abs(F.col("x") - px) < 1e-6) & (F.abs(F.col("y") - py) < 1e-6)).alias("is_the_mean"))


@register("pipeline_fit", lloyd_sql(DEPLOYED, "SELECT CAST(c AS INT) AS cluster_id, CAST(n AS BIGINT) AS n_songs FROM per"), FEAT_SQL)
def q_m11(spark, sf):
    """The songs of each cluster under the fitted pipeline."""
    model, spec, songs = _fit(spark, sf)
    return model.transform(MD.prepare(songs, spec)).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_songs"))


@register("save_model", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed FROM feat", FEAT_SQL)
def q_s13(spark, sf):
    model, spec, songs = _fit(spark, sf)
    path = checkpoint_dir(spark, "model")
    MD.save_model(model, spec, path)
    loaded, spec2 = MD.load_model(path)
    a = MD.predict_cluster(model, songs, spec).select("song_id", F.col("cluster_id").alias("before"))
    b = MD.predict_cluster(loaded, songs, spec2).select("song_id", F.col("cluster_id").alias("after"))
    return a.join(b, "song_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") != F.col("after")).alias("changed"))


# --- classifier --------------------------------------------------------------------

SPLIT_SQL = """
SELECT vec_id, label, rn - 1 AS class_rank, n FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM vectors)"""


@register("stratified_split", "SELECT vec_id, label, class_rank < round(n * 0.2) AS is_test FROM sp", {"sp": SPLIT_SQL})
def q_w8(spark, sf):
    return CL.stratified_split(V.vectors(spark, sf).select("vec_id", "label"), "label", "vec_id")


@register("stratified_kfold", "SELECT vec_id, label, CAST(class_rank % 5 AS INT) AS fold FROM sp", {"sp": SPLIT_SQL})
def q_w9(spark, sf):
    return CL.stratified_kfold(V.vectors(spark, sf).select("vec_id", "label"), "label", "vec_id")


def _classifier_data(spark, sf):
    """Weighted feature vectors labelled with the K-Means cluster ids (the
    classifier learns the clustering, as in the reference)."""
    model, spec, songs = _fit(spark, sf)
    pred = MD.predict_cluster(model, songs, spec)
    return pred.select("song_id", F.col("weighted_scaled_features").alias("features"), F.col("cluster_id").alias("label"))


def _split_classifier(spark, sf):
    """(model, training rows, test rows): fitted once, on labels stored once."""
    labelled = cut_lineage(_classifier_data(spark, sf))   # the split samples it, then deals it
    data = cut_lineage(CL.stratified_split(labelled, "label", "song_id"))
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    return CL.train_cluster_classifier(train, len(MD.V8_COLUMNS), MD.DEPLOYED_K), train, test


@register("train_cluster_classifier", "SELECT true AS better_than_the_largest_class, true AS f1_in_range")
def q_m12(spark, sf):
    """On held-out songs the classifier beats guessing the largest class."""
    model, _, test = _split_classifier(spark, sf)
    r = CL.evaluate_classifier(CL.predict_proba(model, test))
    largest = test.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    return spark.createDataFrame([(r["accuracy"] > largest, 0.0 <= r["f1_weighted"] <= 1.0)], "better_than_the_largest_class boolean, f1_in_range boolean")


@register("predict_cluster_proba", """
SELECT count(*) AS n_songs, true AS a_fifth_is_test, true AS sums_to_one, true AS largest_is_predicted FROM feat""", FEAT_SQL)
def q_m13(spark, sf):
    """Of all songs a fifth of each class is test; their probabilities sum to
    one and the prediction is the most probable class."""
    model, train, test = _split_classifier(spark, sf)
    p = CL.predict_proba(model, test)
    sums = F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1.0) < 1e-9
    largest = F.col("probability")[F.col("prediction")] >= F.array_max("probability")
    told = p.agg(F.struct(F.min(sums).alias("sums"), F.min(largest).alias("largest")).alias("t")).scalar()
    per = train.groupBy("label").count().withColumnRenamed("count", "n").join(test.groupBy("label").count(), "label", "left")
    fair = per.agg(F.sum(F.col("n") + F.coalesce("count", F.lit(0))).alias("n_songs"),
                   F.min(F.abs(F.coalesce("count", F.lit(0)) - 0.2 * (F.col("n") + F.coalesce("count", F.lit(0)))) <= 0.5).alias("a_fifth_is_test"))
    return fair.select("n_songs", "a_fifth_is_test", told["sums"].alias("sums_to_one"), told["largest"].alias("largest_is_predicted"))


@register("cross_validate", "SELECT CAST(range AS INT) AS fold, true AS accuracy_in_range, true AS f1_in_range FROM range(5)")
def q_m15(spark, sf):
    """Five folds, each with its accuracy and F1."""
    out = CL.cross_validate(cut_lineage(_classifier_data(spark, sf)), len(MD.V8_COLUMNS), MD.DEPLOYED_K, id_col="song_id")
    return out.select("fold", F.col("accuracy").between(0.0, 1.0).alias("accuracy_in_range"),
                      F.col("f1_weighted").between(0.0, 1.0).alias("f1_in_range"))


def nearest_centroid_predictions(spark, sf):
    centers, labels = label_centers(spark, sf)
    out = RC.assign_nearest_centroid(V.vectors(spark, sf), centers)
    lab = F.array(*[F.lit(int(x)) for x in labels])
    return out.select("vec_id", "label", F.get(lab, F.col("cluster")).alias("prediction"))


PRED_SQL = {**CENTER_SQL, "pred": """
SELECT d.vec_id, v.label, CAST(arg_min(d.c, (d.d, d.c)) AS INT) AS prediction
FROM dists d JOIN vectors v USING (vec_id) GROUP BY d.vec_id, v.label"""}

LABELS = list(range(10))   # the classes of the given tables, for the fixed columns of the SQL only


@register("confusion_matrix", "SELECT label, " + ", ".join(
    f"CAST(count_if(prediction = {c}) AS BIGINT) AS pred_{c}" for c in LABELS) + " FROM pred GROUP BY label", PRED_SQL)
def q_a18(spark, sf):
    return CL.confusion_matrix(nearest_centroid_predictions(spark, sf))


REPORT_SQL = {**PRED_SQL, "per": """
SELECT CAST(c AS VARCHAR) AS class, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support,
       CASE WHEN coalesce(n_pred, 0) > 0 THEN coalesce(tp, 0) / n_pred ELSE 0.0 END AS precision,
       CASE WHEN coalesce(support, 0) > 0 THEN coalesce(tp, 0) / support ELSE 0.0 END AS recall
FROM (SELECT label AS c, count(*) AS support FROM pred GROUP BY 1) s
FULL JOIN (SELECT prediction AS c, count(*) AS n_pred FROM pred GROUP BY 1) p USING (c)
LEFT JOIN (SELECT label AS c, count(*) AS tp FROM pred WHERE label = prediction GROUP BY 1) t USING (c)""",
    "per2": """
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per"""}


@register("classification_report", """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
  SELECT class, precision, recall, f1, support FROM per2
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM per2
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per2
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM per2)""", REPORT_SQL)
def q_a19(spark, sf):
    return CL.classification_report(nearest_centroid_predictions(spark, sf))


@register("evaluate_classifier", """
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM per2""",
          REPORT_SQL)
def q_m14(spark, sf):
    r = CL.evaluate_classifier(nearest_centroid_predictions(spark, sf))
    return spark.createDataFrame([(round(r["accuracy"], 6), round(r["f1_weighted"], 6))], "accuracy double, f1_weighted double")


# --- playlist ------------------------------------------------------------------------

# Greedy MMR in SQL: one recursive step per pick; the state per seed holds the
# candidate lists (rank order), the running max similarity to the picks and
# the taken flags; ties go to the earlier candidate (list_position of the max).
MMR_SQL = {**CENTER_SQL,
 "seeds": """SELECT vec_id AS seed_id, embedding AS e, list(c ORDER BY d, c)[1:2] AS top_clusters
               FROM dists JOIN vectors USING (vec_id) WHERE vec_id % 20 = 0 GROUP BY vec_id, embedding""",
 "cand": """SELECT seed_id, vec_id, embedding, cosine, row_number() OVER (PARTITION BY seed_id ORDER BY cosine DESC, vec_id) AS rank FROM (
   SELECT s.seed_id, v.vec_id, v.embedding,
          list_dot_product(s.e, v.embedding) / (sqrt(list_dot_product(s.e, s.e)) * sqrt(list_dot_product(v.embedding, v.embedding))) AS cosine
   FROM seeds s JOIN vectors v ON list_contains(s.top_clusters, v.label) AND v.vec_id <> s.seed_id) QUALIFY rank <= 200""",
 "packed": """SELECT seed_id, list(vec_id ORDER BY rank) AS ids, list(cosine ORDER BY rank) AS rel,
                     list(embedding ORDER BY rank) AS emb FROM cand GROUP BY seed_id""",
}
MMR_BODY = """
WITH RECURSIVE mmr(seed_id, step, ids, rel, emb, ms, taken, picks) AS (
  SELECT seed_id, 1, ids, rel, emb, list_transform(ids, lambda x: CAST(0.0 AS DOUBLE)),
         list_transform(range(1, len(ids) + 1), lambda i: i = 1), [1] FROM packed
  UNION ALL
  SELECT seed_id, step + 1, ids, rel, emb, ms2, list_transform(range(1, len(ids) + 1), lambda i: taken[i] OR i = nxt),
         list_append(picks, nxt) FROM (
    SELECT *, list_position(sc, list_max(sc)) AS nxt FROM (
      SELECT *, list_transform(range(1, len(ids) + 1),
                  lambda i: CASE WHEN taken[i] THEN CAST(-1e308 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) * rel[i] - CAST(0.3 AS DOUBLE) * ms2[i] END) AS sc FROM (
        SELECT *, list_transform(range(1, len(ids) + 1),
                    lambda i: greatest(ms[i], list_dot_product(emb[i], emb[picks[len(picks)]]) /
                                              (sqrt(list_dot_product(emb[i], emb[i])) * sqrt(list_dot_product(emb[picks[len(picks)]], emb[picks[len(picks)]]))))) AS ms2
        FROM mmr WHERE step < least(50, len(ids)))))
)
SELECT seed_id, ids[p] AS vec_id, CAST(r AS INT) AS mmr_rank FROM (
  SELECT seed_id, ids, unnest(picks) AS p, generate_subscripts(picks, 1) AS r FROM mmr
  WHERE step = least(50, len(ids)))"""

@register("mmr_rerank", MMR_BODY, MMR_SQL)
def q_m16(spark, sf):
    seeds = search_seeds(spark, sf)
    cands = RC.cosine_topn(seeds, V.vectors(spark, sf), n=MM.TOP_N, with_embedding=True)
    return MM.mmr_rerank(cands, MM.K_FINAL, MM.LAMBDA_REL).select("seed_id", "vec_id", "mmr_rank")


@register("build_playlist", MMR_BODY.replace(
    "SELECT seed_id, ids[p] AS vec_id, CAST(r AS INT) AS mmr_rank FROM (",
    "SELECT m.seed_id, m.vec_id, m.mmr_rank, v.label FROM (SELECT seed_id, ids[p] AS vec_id, CAST(r AS INT) AS mmr_rank FROM (")
    + ") m JOIN vectors v ON v.vec_id = m.vec_id", MMR_SQL)
def q_m17(spark, sf):
    meta = V.vectors(spark, sf).select("vec_id", "label")
    return MM.build_playlist(search_seeds(spark, sf), V.vectors(spark, sf), meta).select(
        "seed_id", "vec_id", "mmr_rank", "label")


def stored_classifier(spark, sf):
    """The classifier of the vectors' clusters (M12), trained, written and loaded."""
    data = V.vectors(spark, sf).select(array_to_vector("embedding").alias("features"), "label")
    n_classes = int(data.agg(F.max("label")).first()[0]) + 1
    dim = V.vectors(spark, sf).select(F.size("embedding")).first()[0]
    path = checkpoint_dir(spark, "classifier")
    CL.train_cluster_classifier(data, dim, n_classes).write().overwrite().save(path)
    return CL.load_classifier(path)


@register("build_playlist_classifier", None)
def q_m17_classifier(spark, sf):
    """Playlists of every 20th vector: the two clusters that the stored
    classifier finds most probable, cosine top-N in them, MMR, title and artist."""
    vectors = V.vectors(spark, sf)
    seeds = SV.classified_seeds(stored_classifier(spark, sf), vectors.where(F.col("vec_id") % 20 == 0), MM.TOP_C)
    meta = V.vector_songs(spark, sf).join(vectors.select("vec_id", "label"), "vec_id")
    return MM.build_playlist(seeds, vectors, meta).select("seed_id", "vec_id", "mmr_rank", "title", "artist", "label")
