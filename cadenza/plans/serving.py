"""The serving model (M18, T2, T3): features → scaler → weights → nearest
stored centre, as column expressions, so batch and stream share one plan.

A stored model is a :class:`FeatureSpec`, the scaler's standard deviations and
the centres in weighted feature space (bounded by k × 6 numbers).  Nothing is
fitted here; :func:`from_pipeline` reads them off a fitted ``PipelineModel``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators import recommend as RC
from cadenza.plans import classify as CL
from cadenza.plans import model as MD


@dataclass(frozen=True)
class StoredModel:
    spec: MD.FeatureSpec
    stds: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    def factors(self) -> list[float]:
        """Weight over standard deviation per feature (0 where the deviation is 0, as the scaler has it)."""
        return [w / s if s else 0.0 for w, s in zip(self.spec.weights, self.stds)]


def from_pipeline(model: PipelineModel, spec: MD.FeatureSpec) -> StoredModel:
    """The numbers of a fitted pipeline (assembler, scaler, weighting, K-Means)."""
    return StoredModel(spec, tuple(map(float, model.stages[1].std)), tuple(tuple(map(float, c)) for c in model.stages[-1].clusterCenters()))


def demo_model(k: int = MD.DEPLOYED_K) -> StoredModel:
    """A fixed model for the registered queries, so that their answers have an
    exact twin in SQL: centres at k made-up songs spread over the features."""
    spec = MD.FeatureSpec(loudness_offset=60.0, k=k)
    stds = (58.0, 14.0, 0.7, 0.7, 0.5, 1.4)
    songs = [(50.0 + 18 * i, 4.0 + 5 * (i * 3 % k), i * 12 / k, float(i % 2), 1.0 + i % 5) for i in range(k)]
    raw = [(t, ld, math.cos(2 * math.pi * a / 12), math.sin(2 * math.pi * a / 12), m, ts) for t, ld, a, m, ts in songs]
    factors = [w / s for w, s in zip(spec.weights, stds)]
    return StoredModel(spec, stds, tuple(tuple(x * f for x, f in zip(r, factors)) for r in raw))


def assigner(model: StoredModel) -> Callable[[DataFrame], DataFrame]:
    """``assign(df)``: the rows with a Camelot code, with ``cluster_id`` added.
    One projection: no join, no user function."""

    def assign(df: DataFrame) -> DataFrame:
        feats = MD.prepare(df, model.spec).select(
            *[F.col(c) if c != "time_signature" else F.col(c).cast(dict(df.dtypes)[c]) for c in df.columns],
            F.array(*[F.col(c) * F.lit(f) for c, f in zip(model.spec.columns, model.factors())]).alias("_weighted"))
        return RC.assign_nearest_centroid(feats, [list(c) for c in model.centers], "_weighted", "cluster_id").drop("_weighted", "sqdist")

    return assign


def classified_seeds(classifier, vectors: DataFrame, c: int) -> DataFrame:
    """Seeds of a playlist (M13 → W6): vec_id as ``seed_id``, the embedding and
    the ``c`` clusters that the stored classifier finds most probable.  The
    model transforms the rows where they are; nothing is shuffled."""
    proba = CL.predict_proba(classifier, vectors.withColumn("features", array_to_vector("embedding")))
    return RC.topc_clusters(proba, c).select(F.col("vec_id").alias("seed_id"), "embedding", "top_clusters")


def cluster_sql(source: str, model: StoredModel) -> str:
    """DuckDB twin of :func:`assigner` over a table with the song features."""
    raw = ("s.tempo", f"(s.loudness + {model.spec.loudness_offset!r})", "cos(2 * pi() * (s.num - 1) / 12)", "sin(2 * pi() * (s.num - 1) / 12)",
           "(CASE WHEN s.mode = 1 THEN 1.0 ELSE 0.0 END)", "s.time_signature")
    weighted = ", ".join(f"CAST({x} AS DOUBLE) * CAST({f!r} AS DOUBLE)" for x, f in zip(raw, model.factors()))
    centers = ", ".join("[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in c) + "]" for c in model.centers)
    return f"""
SELECT *, CAST(list_position(ds, list_min(ds)) - 1 AS INT) AS cluster_id FROM (
  SELECT *, list_transform([{centers}],
                           lambda c: list_sum(list_transform(range(1, {len(raw) + 1}), lambda i: (w[i] - c[i]) * (w[i] - c[i])))) AS ds FROM (
    SELECT s.*, [{weighted}] AS w FROM (
      SELECT x.*, CASE WHEN x.mode = 1 THEN t.major_num ELSE t.minor_num END AS num
      FROM {source} x JOIN camelot_tbl t ON t.k = CAST(trunc(x.key) AS INT)
      WHERE x.mode IS NOT NULL AND x.tempo BETWEEN 40 AND 250 AND x.time_signature BETWEEN 1 AND 5) s))"""
