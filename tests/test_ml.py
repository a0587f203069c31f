"""Model operators: K-Means on any layout, many models at once; J10 = M4, cost below a trivial assignment, PCA variance,
probabilities, save/load."""

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cadenza.operators import clean as C
from cadenza.operators import kmeans as KM
from cadenza.operators import recommend as RC
from cadenza.plans import classify as CL
from cadenza.plans import model as MD
from cadenza.session import checkpoint_dir
from cadenza.sources import catalog as V

SF = "/root/testdata/sf0.001"


def _songs(spark):
    return C.clean_catalog(V.catalog(spark, SF))


def test_kmeans_assignment_equals_nearest_centre(spark):
    spec = MD.FeatureSpec()
    model = MD.fit_pipeline(_songs(spark), spec)
    pred = MD.predict_cluster(model, _songs(spark), spec)
    centers = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
    arr = pred.withColumn("v", vector_to_array("weighted_scaled_features"))
    mine = RC.assign_nearest_centroid(arr, centers, vec_col="v")
    bad = mine.where(F.col("cluster") != F.col("cluster_id")).count()
    assert bad == 0


def test_kmeans_cost_below_single_cluster_cost(spark):
    spec = MD.FeatureSpec()
    model = MD.fit_pipeline(_songs(spark), spec)
    cost = model.stages[-1].getOrDefault(model.stages[-1].trainingCost)
    pred = MD.predict_cluster(model, _songs(spark), spec)
    x = np.array([r[0] for r in pred.select(vector_to_array("weighted_scaled_features")).collect()])
    single = float(((x - x.mean(axis=0)) ** 2).sum())
    assert cost < single


def _points(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(c, 1.0, 3)]) for i, c in enumerate(rng.choice([0.0, 4.0, 9.0], 500))] + [(500, [0.0] * 3), (501, [0.0] * 3)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(parts, "id")


def test_kmeans_does_not_depend_on_the_layout(spark):
    fits = [KM.fit_many(_points(spark, n), "v", [([1.0, 1.0, 2.0], 5)], "id")[0][0] for n in (1, 4, 64)]
    for f in fits[1:]:
        assert np.allclose(f.centers, fits[0].centers, rtol=0, atol=1e-9) and f.sizes == fits[0].sizes
        assert abs(f.cost - fits[0].cost) < 1e-6 and abs(f.silhouette - fits[0].silhouette) < 1e-9


def test_models_fitted_together_equal_single_fits_in_as_many_passes(spark):
    df = _points(spark, 3)
    models = [([1.0, 1.0, 1.0], 2), ([3.0, 0.5, 1.0], 6), ([1.0, 2.0, 0.0], 4), ([1.0, 1.0, 1.0], 1)]
    single = [KM.fit_many(df, "v", [m], "id") for m in models]
    fits, passes = KM.fit_many(df, "v", models, "id")
    assert passes == max(p for _, p in single) == max(f.iterations for f in fits) + 2
    for f, ((s,), _) in zip(fits, single):
        assert np.allclose(f.centers, s.centers, rtol=0, atol=1e-9)
        assert (f.sizes, f.iterations) == (s.sizes, s.iterations) and abs(f.silhouette - s.silhouette) < 1e-9


def test_silhouette_equals_the_evaluator(spark):
    df = _points(spark, 3)
    (f,), _ = KM.fit_many(df, "v", [([1.0, 1.0, 1.0], 4)], "id")
    out = RC.assign_nearest_centroid(df, f.centers.tolist(), "v", "c").withColumn("features", array_to_vector("v")).withColumn("c", F.col("c").cast("double"))
    assert abs(MD.silhouette(out, "features", "c") - f.silhouette) < 1e-9
    assert abs(out.agg(F.sum("sqdist")).first()[0] - f.cost) < 1e-6


def test_kmeans_with_fewer_rows_than_centres(spark):
    df = _points(spark, 2).where("id < 3")
    (f,), _ = KM.fit_many(df, "v", [([1.0, 1.0, 1.0], 5)], "id")
    assert f.centers.shape == (3, 3) and f.cost < 1e-12 and f.sizes == (1, 1, 1)


def test_offset_is_fitted_and_saved(spark):
    spec = MD.FeatureSpec()
    model = MD.fit_pipeline(_songs(spark), spec)
    exp = abs(_songs(spark).agg(F.min("loudness")).first()[0]) + 1
    assert spec.loudness_offset == exp
    path = checkpoint_dir(spark, "test-model")
    MD.save_model(model, spec, path)
    _, back = MD.load_model(path)
    assert back.loudness_offset == exp and back.weights == spec.weights


def test_pca_explained_variance(spark):
    spec = MD.FeatureSpec()
    spec.loudness_offset = 61.0
    df = MD.prepare(_songs(spark), spec)
    a = MD.assembler(spec).transform(df)
    ev = [r.explained_variance for r in
          MD.pca_explained(MD.pca_fit(MD.scaler().fit(a).transform(a), 5, "scaled_features"), spark).orderBy("component").collect()]
    assert all(x >= y - 1e-12 for x, y in zip(ev, ev[1:])) and sum(ev) <= 1 + 1e-9


def test_softmax_probabilities_sum_to_one(spark):
    v = V.vectors(spark, SF)
    centers = [[0.0] * 64, [0.1] * 64, [-0.1] * 64]
    p = RC.centroid_probabilities(v, centers)
    sums = [sum(r[0]) for r in p.select("probability").collect()]
    assert all(abs(s - 1) < 1e-9 for s in sums)
    top = RC.topc_clusters(p, 2).select("top_clusters").first()[0]
    assert len(top) == 2 and top[0] != top[1]


def test_weight_grid_has_48_vectors():
    g = MD.weight_grid()
    assert len(g) == 48 and len(set(g)) == 48


def test_confusion_matrix_counts(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "label int, prediction int")
    got = {r.label: (r.pred_0, r.pred_1, r.pred_2) for r in CL.confusion_matrix(pred, [0, 1, 2]).collect()}
    assert got == {0: (1, 1, 0), 1: (0, 1, 0), 2: (1, 0, 0)}


def test_fitted_kmeans_serves_through_assign(spark):
    """The numbers read off a fitted pipeline give its own cluster ids, and requests are answered through them."""
    from cadenza.operators import clean as C
    from cadenza.operators import recommend as RC
    from cadenza.plans import model as MD
    from cadenza.plans import serving as SV
    from cadenza.sources import catalog as V

    sf = "/root/testdata/sf0.001"
    songs = C.clean_catalog(V.catalog(spark, sf))
    spec = MD.FeatureSpec(loudness_offset=60.0, k=4)
    model = MD.fit_pipeline(songs, spec, 4)
    assign = SV.assigner(SV.from_pipeline(model, spec))
    mine = {r.song_id: r.cluster_id for r in assign(songs).select("song_id", "cluster_id").collect()}
    fitted = {r.song_id: r.cluster_id for r in MD.predict_cluster(model, songs, spec).select("song_id", "cluster_id").collect()}
    assert mine == fitted and len(set(mine.values())) == 4
    catalog = assign(songs).select("song_id", "title", "artist", "tempo", "key", "mode", "cluster_id")
    replies = RC.recommend_batch(V.requests(spark, sf), catalog, assign=assign).collect()
    assert replies and len({r.key for r in replies}) == len(replies)


def test_playlists_follow_the_stored_classifier(spark):
    """The clusters of each seed are the top two of predict_proba, worked out
    from the stored weights; the picks come from them and carry title and artist."""
    from cadenza.plans import q_ml
    from cadenza.plans import serving as SV

    vectors = V.vectors(spark, SF)
    model = q_ml.stored_classifier(spark, SF)
    seeds = {r["seed_id"]: r for r in SV.classified_seeds(model, vectors.where("vec_id % 20 = 0"), 2).collect()}
    layers, flat = model.getLayers(), model.weights.toArray()
    x = np.array([seeds[i]["embedding"] for i in sorted(seeds)])
    at = 0
    for k, (a, b) in enumerate(zip(layers, layers[1:])):
        w = flat[at : at + a * b].reshape(b, a, order="F").T
        x = x @ w + flat[at + a * b : at + a * b + b]
        at += a * b + b
        if k < len(layers) - 2:
            x = 1 / (1 + np.exp(-x))
    want = np.argsort(-x, axis=1, kind="stable")[:, :2]
    assert [list(seeds[i]["top_clusters"]) for i in sorted(seeds)] == want.tolist()
    rows = q_ml.q_m17_classifier(spark, SF).collect()
    label = {r["vec_id"]: r["label"] for r in vectors.select("vec_id", "label").collect()}
    assert {r["seed_id"] for r in rows} <= set(seeds)
    for r in rows:
        assert label[r["vec_id"]] == r["label"] and r["label"] in seeds[r["seed_id"]]["top_clusters"]
        assert r["vec_id"] != r["seed_id"] and r["title"] and r["artist"]
    assert len({(r["seed_id"], r["mmr_rank"]) for r in rows}) == len(rows)


def test_packed_blocks_hold_every_vector_and_the_first_ids(spark, monkeypatch):
    """Blocks of 12 numbers over several batches; passes read blocks and no rows."""
    monkeypatch.setattr(KM, "_BLOCK", 12)
    df = _points(spark, 3)
    packed = KM.pack(df, "v", "id", 4).collect()
    got = sorted(tuple(v) for r in packed if r["x"] for v in np.frombuffer(bytes(r["x"])).reshape(r["n"], -1).tolist())
    rows = df.collect()
    assert got == sorted(tuple(r["v"]) for r in rows) and max(r["n"] for r in packed if r["x"]) <= 4
    import hashlib

    want = [r["v"] for r in sorted(rows, key=lambda r: (hashlib.md5(str(r["id"]).encode()).hexdigest(), str(r["id"])))[:4]]
    assert KM.hash_start(KM.pack(df, "v", "id", 4), 4).tolist() == want


def test_mlp_gradient_equals_numeric_differences():
    from cadenza.operators import mlp as M

    rng, layers = np.random.default_rng(0), [3, 5, 4, 3]
    w, x, y = M.start_weights(layers, 1), rng.normal(size=(1500, 3)), rng.integers(0, 3, 1500)
    _, g = M.loss_and_gradient(x, y, w, layers)
    for j in range(0, len(w), 7):
        e = np.eye(len(w))[j] * 1e-5
        assert abs((M.loss_and_gradient(x, y, w + e, layers)[0] - M.loss_and_gradient(x, y, w - e, layers)[0]) / 2e-5 - g[j]) < 1e-4


def test_lbfgs_finds_the_minimum():
    from cadenza.operators import mlp as M

    scale = np.array([1.0, 30.0, 0.1])
    w, n = M.lbfgs(lambda v: (float(scale @ (v - 2) ** 2), 2 * scale * (v - 2)), np.zeros(3), 100, 1e-12)
    assert np.allclose(w, 2, atol=1e-3) and 0 < n < 100


def test_classifier_is_fitted_in_passes_over_blocks(spark, monkeypatch):
    """As good as Spark's trainer on the same rows, its weights are those of the model that is stored and loaded."""
    from cadenza.operators import mlp as M

    monkeypatch.setattr(M, "_BLOCK", 300)
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    x = rng.normal(size=(3, 4))[y] * 3 + rng.normal(size=(600, 4))
    rows = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "v array<double>, label int").repartition(3)
    data = rows.select(array_to_vector("v").alias("features"), "label")
    assert sum(r["n"] for r in M.pack(data, "features", "label").collect()) == 600 and M.pack(data, "features", "label").count() > 6
    model = CL.train_cluster_classifier(data, 4, 3, max_iter=15)
    loss, _ = M.loss_and_gradient(x, y, model.weights.toArray(), model.getLayers())
    theirs = CL.mlp(4, 3, max_iter=15).fit(data.withColumn("label", F.col("label").cast("double")))
    other, _ = M.loss_and_gradient(x, y, theirs.weights.toArray(), model.getLayers())
    assert model.getMaxIter() == 15 and loss / 600 < other / 600 + 0.02   # both near 0
    path = checkpoint_dir(spark, "test-classifier")
    model.write().overwrite().save(path)
    again = CL.load_classifier(path)
    assert np.array_equal(again.weights.toArray(), model.weights.toArray())
    r = CL.evaluate_classifier(CL.predict_proba(again, data))
    assert r["accuracy"] > 0.8


def test_settled_classes_make_a_pass_no_slower():
    """Shares of e^-95 are below the normal single numbers; products of them cost many times as much."""
    import time

    from cadenza.operators import mlp as M

    layers, rng = [6, 128, 64, 11], np.random.default_rng(0)
    x, y = rng.normal(size=(16384, 6)).astype(np.float32), np.zeros(16384, np.int32)
    plain = M.start_weights(layers, 42)
    settled = plain.copy()
    settled[-11:] = [0.0] + [-95.0] * 10

    def seconds(w):
        best = np.inf
        for _ in range(4):
            t = time.process_time()
            M.loss_and_gradient(x, y, w, layers)
            best = min(best, time.process_time() - t)
        return best

    assert seconds(settled) < 3 * seconds(plain)
    one, g = M.loss_and_gradient(x, y, settled, layers)
    exact, h = M.loss_and_gradient(x.astype(np.float64), y, settled, layers)
    assert np.allclose(one, exact, atol=1e-3) and np.allclose(g, h, atol=1e-2)


def test_a_model_behind_the_scaler_is_compiled(spark):
    """No method of its generated code is so long (8,000 bytes) that the JVM only interprets it."""
    from cadenza.plans import model as MD
    from cadenza.plans import serving as SV
    from cadenza.plans.q_recommend import MODEL

    path = checkpoint_dir(spark, "test-compiled")
    spark.range(200).selectExpr("id", "40 + id % 200.0D AS tempo", "-id % 60.0D AS loudness", "int(id % 12) AS key", "int(id % 2) AS mode", "int(1 + id % 5) AS time_signature").write.parquet(path)
    rows = spark.read.parquet(path)
    pipe = MD.Pipeline(stages=[MD.assembler(MODEL.spec), MD.scaler(), MD.weighting(MODEL.spec)])
    nearest = MD.KM.NearestCenter(featuresCol="weighted_scaled_features", predictionCol="cluster_id", centers=[list(c) for c in MODEL.centers])
    songs = MD.prepare(rows, MODEL.spec)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    for df in (nearest.transform(pipe.fit(songs).transform(songs)).select("id", "weighted_scaled_features", "cluster_id"), SV.assigner(MODEL)(rows)):
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
