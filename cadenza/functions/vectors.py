"""Vector helpers on array<double> columns (H10–H13, H17) — higher-order
built-in functions, evaluated JVM-side inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _arr(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Σ a_i·b_i, summed left to right."""
    return F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def squared_distance(a, b) -> Column:
    """Σ (a_i − b_i)², summed left to right."""
    return F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def cosine_similarity(a, b, eps: float = 1e-12) -> Column:
    """H17 — dot / (‖a‖·‖b‖); a zero denominator becomes ``eps``."""
    den = norm(a) * norm(b)
    return dot(a, b) / F.when(den == 0, F.lit(eps)).otherwise(den)


def weight_features(arr, weights: Sequence[float]) -> Column:
    """H10 — elementwise product with DOUBLE weights (an ``array(3.0, …)``
    SQL literal would be DECIMAL; these are typed doubles)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return F.transform(_arr(arr), lambda x, i: x * F.get(w, i))


def flatten_vector(df: DataFrame, arr: str, dim: int, prefix: str = "f_", keep: Sequence[str] = ()) -> DataFrame:
    """H12 — array column → f_0 … f_{d−1}; d comes from the feature spec."""
    return df.select(*keep, *[F.col(arr)[i].alias(f"{prefix}{i}") for i in range(dim)])


def parse_vector_literal(text) -> Column:
    """H13 — "[1.0, 2.5, …]" text → array<double>."""
    return F.from_json(_arr(text), "array<double>")
