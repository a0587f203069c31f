"""Feature spec and Spark ML model operators.

The reference's training/serving skews (loudness offset abs(min)+1 vs +60,
different weights, weighting left out of the pipeline) disappear because
one :class:`FeatureSpec` — columns, weights, fitted loudness offset — is
used by both paths and the weighting is a pipeline stage.

Fits persist their input once (``MEMORY_AND_DISK``) and release it after;
iterative estimators (K-Means, PCA, MLP) would otherwise recompute the
feature plan every pass.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import harmony as H
from cadenza.operators import kmeans as KM
from cadenza.session import cut_lineage

# --- fixed values (must equal the reference) --------------------------------
V7_COLUMNS = ("tempo", "loudness_pos", "key_sin", "key_cos", "mode_major", "time_signature")
V7_WEIGHTS = (4.5, 1.0, 5.0, 5.0, 0.5, 0.5)
V8_COLUMNS = ("tempo", "loudness_pos", "camelot_cos", "camelot_sin", "camelot_mode_small", "time_signature")
V8_WEIGHTS = (3.0, 1.0, 5.0, 5.0, 0.2, 0.5)
KMEANS_MAX_ITER, KMEANS_TOL = 20, 1e-4
DEPLOYED_K = 11
V3_COLUMNS = ("tempo", "loudness", "duration", "key", "mode", "time_signature",
              *[f"timbre_mean_{i}" for i in range(12)], *[f"timbre_std_{i}" for i in range(12)])
V3_K = 20
SWEEP_V8 = range(4, 20)
WEIGHT_GRID = {  # 3·2·2·2·2·1 = 48 weight vectors searched at k = 6
    "tempo": (1.0, 2.0, 3.0), "loudness": (0.5, 1.0), "key": (1.0, 2.0), "mode": (0.5, 1.0), "time_signature": (0.5,),
}
SEARCH_K = 6
# ---------------------------------------------------------------------------


@dataclass
class FeatureSpec:
    columns: tuple = V8_COLUMNS
    weights: tuple = V8_WEIGHTS
    loudness_offset: float | None = None   # fitted: abs(min loudness) + 1
    k: int = DEPLOYED_K
    extra: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "FeatureSpec":
        d = json.loads(s)
        d["columns"], d["weights"] = tuple(d["columns"]), tuple(d["weights"])
        return FeatureSpec(**d)


def fit_loudness_offset(df: DataFrame) -> float:
    """H2 training rule — abs(min loudness) + 1 (one scalar aggregate)."""
    return abs(df.agg(F.min("loudness")).first()[0]) + 1.0


def encode(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """H1–H9 — every derived feature column both model versions use."""
    off = spec.loudness_offset if spec.loudness_offset is not None else 60.0
    df = H.with_camelot(df)
    return (df.withColumn("loudness_pos", F.col("loudness") + F.lit(off))
              .withColumn("key_sin", H.key_sin(F.col("key"))).withColumn("key_cos", H.key_cos(F.col("key")))
              .withColumn("mode_major", H.mode_major(F.col("mode")).cast("double"))
              .withColumn("camelot_cos", H.camelot_cos(F.col("camelot_num")))
              .withColumn("camelot_sin", H.camelot_sin(F.col("camelot_num")))
              .withColumn("camelot_mode_small", H.camelot_mode_small(F.col("camelot_letter")))
              .withColumn("time_signature", F.col("time_signature").cast("double")))


def assembler(spec: FeatureSpec) -> VectorAssembler:
    """M1 — ordered feature list → vector; a null feature is an error."""
    return VectorAssembler(inputCols=list(spec.columns), outputCol="features_vec", handleInvalid="error")


def scaler() -> StandardScaler:
    """M2 — divide by the sample std, no centring (std 0 → 0)."""
    return StandardScaler(inputCol="features_vec", outputCol="scaled_features", withMean=False, withStd=True)


def weighting(spec: FeatureSpec) -> ElementwiseProduct:
    """H10 as a pipeline stage."""
    return ElementwiseProduct(scalingVec=Vectors.dense(list(spec.weights)), inputCol="scaled_features",
                              outputCol="weighted_scaled_features")


def kmeans(spec: FeatureSpec, k: int | None = None) -> KM.HashKMeans:
    """M3 — K-Means from hash-ordered start centres: the same songs give the
    same centres whatever their layout."""
    return KM.HashKMeans(featuresCol="weighted_scaled_features", predictionCol="cluster_id", k=k or spec.k,
                         maxIter=KMEANS_MAX_ITER, tol=KMEANS_TOL)


def pipeline(spec: FeatureSpec, k: int | None = None) -> Pipeline:
    """M11 — assembler + scaler + weighting + K-Means as one Pipeline."""
    return Pipeline(stages=[assembler(spec), scaler(), weighting(spec), kmeans(spec, k)])


def pipeline_v3(k: int = V3_K) -> Pipeline:
    """The older model: 30 song and timbre features, scaled, unweighted → K-Means."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(V3_COLUMNS), outputCol="features_vec", handleInvalid="error"), scaler(),
        KM.HashKMeans(featuresCol="scaled_features", predictionCol="cluster_id", k=k, maxIter=KMEANS_MAX_ITER, tol=KMEANS_TOL)])


def prepare(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Serving/training features; songs without a Camelot code (key outside
    0..11 or null mode) cannot be assembled and are left out."""
    return encode(df, spec).where(F.col("camelot_num").isNotNull())


def fit_pipeline(df: DataFrame, spec: FeatureSpec, k: int | None = None) -> PipelineModel:
    """M3/M11 — fit on a persisted input (fitted offset stored in the spec)."""
    if spec.loudness_offset is None:
        spec.loudness_offset = fit_loudness_offset(df)
    data = prepare(df, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline(spec, k).fit(data)
    finally:
        data.unpersist()


def predict_cluster(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """M4 — cluster ids for new songs with the same features and offset."""
    return model.transform(prepare(df, spec))


def silhouette(df: DataFrame, features: str = "weighted_scaled_features", prediction: str = "cluster_id") -> float:
    """M5 — squared-Euclidean silhouette (distributed evaluator)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=prediction, metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return ev.evaluate(df)


def scaled_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(song_id, s): the scaled, unweighted features as an array."""
    if spec.loudness_offset is None:
        spec.loudness_offset = fit_loudness_offset(df)
    rows = cut_lineage(prepare(df, spec).select("song_id", *spec.columns))   # the scaler and the fits read it
    scaled = Pipeline(stages=[assembler(spec), scaler()]).fit(rows).transform(rows)
    return scaled.select("song_id", vector_to_array("scaled_features").alias("s"))


def sweep_k(df: DataFrame, spec: FeatureSpec, ks=SWEEP_V8) -> DataFrame:
    """M6 — (k, cost, silhouette) for each k.  All models share every pass over
    the stored features."""
    ks = list(ks)
    fits, _ = KM.fit_many(scaled_rows(df, spec), "s", [(list(spec.weights), k) for k in ks], "song_id", KMEANS_MAX_ITER, KMEANS_TOL)
    return df.sparkSession.createDataFrame([(int(k), f.cost, f.silhouette) for k, f in zip(ks, fits)], "k int, cost double, silhouette double")


def weight_grid() -> list[tuple]:
    """(tempo, loudness, key_a, key_b, mode, time_signature) — the two key
    components take their weights independently."""
    g = WEIGHT_GRID
    return [(t, l, a, b, m, ts) for t in g["tempo"] for l in g["loudness"] for a in g["key"]
            for b in g["key"] for m in g["mode"] for ts in g["time_signature"]]


def search_weights(df: DataFrame, spec: FeatureSpec, k: int = SEARCH_K, grid: list[tuple] | None = None) -> DataFrame:
    """M7 — cost and silhouette of K-Means(k) for every weight vector of the
    grid, on all songs, with the best silhouette flagged.  All models share
    every pass over the stored features."""
    grid = [list(map(float, w)) for w in (grid or weight_grid())]
    fits, _ = KM.fit_many(scaled_rows(df, spec), "s", [(w, k) for w in grid], "song_id", KMEANS_MAX_ITER, KMEANS_TOL)
    best = max(f.silhouette for f in fits)
    rows = [(w, f.cost, f.silhouette, f.silhouette == best) for w, f in zip(grid, fits)]
    return df.sparkSession.createDataFrame(rows, "weights array<double>, cost double, silhouette double, is_best boolean")


def pca_fit(df: DataFrame, k: int, features: str = "weighted_scaled_features"):
    """M8/M9 — PCA on the feature vectors."""
    return PCA(k=k, inputCol=features, outputCol="pca_features").fit(df)


def pca_explained(model, spark: SparkSession) -> DataFrame:
    """M8 — explained variance per component."""
    ev = list(map(float, model.explainedVariance))
    return spark.createDataFrame(list(enumerate(ev)), "component int, explained_variance double")


def pca_project_2d(model, df: DataFrame, keep=("song_id", "cluster_id")) -> DataFrame:
    """M9 — 2-D coordinates per song."""
    p = model.transform(df).withColumn("_a", vector_to_array("pca_features"))
    return p.select(*keep, F.col("_a")[0].alias("x"), F.col("_a")[1].alias("y"))


def project_centroids(model, centers, spark: SparkSession) -> DataFrame:
    """M10 — cluster centres through the same PCA (k rows)."""
    rows = [(i, Vectors.dense(list(map(float, c)))) for i, c in enumerate(centers)]
    cdf = spark.createDataFrame(rows, ["cluster_id", "weighted_scaled_features"])
    return pca_project_2d(model, cdf, keep=("cluster_id",))


def projected_centroids(points: DataFrame) -> DataFrame:
    """A17 — mean plot coordinate per cluster."""
    return points.groupBy("cluster_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def save_model(model: PipelineModel, spec: FeatureSpec, path: str) -> None:
    """S13 — PipelineModel plus its FeatureSpec, side by side."""
    model.write().overwrite().save(path + "/pipeline")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(spec.to_json(),)], "spec string").coalesce(1).write.mode("overwrite").text(path + "/spec")


def load_model(path: str) -> tuple[PipelineModel, FeatureSpec]:
    spark = SparkSession.getActiveSession()
    spec = FeatureSpec.from_json(spark.read.text(path + "/spec").first()[0])
    return PipelineModel.load(path + "/pipeline"), spec
