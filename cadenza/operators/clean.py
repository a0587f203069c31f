"""Projections, filters, validation and data-quality operators.

All are narrow transformations (no shuffle) except where noted; the range
filters are plain comparisons so Catalyst pushes them into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED_FIELDS = ("tempo", "loudness", "key", "mode", "time_signature")
INT_LIMIT = 2147483648.0   # numbers of this size or more, NaN and infinities are out of range

# --- fixed values (must equal the reference) --------------------------------
TEMPO_MIN, TEMPO_MAX = 40, 250          # inclusive tempo range kept
TS_MIN, TS_MAX = 1, 5                   # inclusive time-signature range kept
# defaults applied when a request field is missing or not a number
FIELD_DEFAULTS = {"tempo": 0.0, "loudness": -60.0, "key": 0, "mode": 1, "time_signature": 4}
# ---------------------------------------------------------------------------

REQUEST_SCHEMA = T.StructType([
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("key", T.DoubleType()),
    T.StructField("mode", T.DoubleType()),
    T.StructField("time_signature", T.DoubleType()),
])


def drop_unused(df: DataFrame, cols: Iterable[str] = ("danceability",)) -> DataFrame:
    """P1 — drop columns if present (no-op otherwise)."""
    return df.drop(*cols)


def filter_tempo_range(df: DataFrame, col: str = "tempo") -> DataFrame:
    """P2 — TEMPO_MIN ≤ tempo ≤ TEMPO_MAX; null tempo is dropped."""
    return df.where(F.col(col).between(TEMPO_MIN, TEMPO_MAX))


def filter_time_signature(df: DataFrame, col: str = "time_signature") -> DataFrame:
    """P3 — TS_MIN ≤ time_signature ≤ TS_MAX."""
    return df.where(F.col(col).between(TS_MIN, TS_MAX))


def clean_catalog(df: DataFrame) -> DataFrame:
    """P4 — P1 + P2 + P3: the training and serving entry."""
    return filter_time_signature(filter_tempo_range(drop_unused(df)))


def filter_cluster(df: DataFrame, cluster_id: int, col: str = "cluster_id") -> DataFrame:
    """P5 — songs of one cluster (a partition filter when the table is
    written partitioned by cluster_id)."""
    return df.where(F.col(col) == F.lit(cluster_id))


def filter_isin(df: DataFrame, col: str, values) -> DataFrame:
    """P6 — membership: a literal list becomes ``isin``; a DataFrame of keys
    becomes a left-semi join (no driver round trip, any size)."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(keys, on=col, how="left_semi")
    return df.where(F.col(col).isin(list(values)))


def parse_request(messages: DataFrame, key_col: str = "key", value_col: str = "value",
                  schema: T.StructType = REQUEST_SCHEMA) -> DataFrame:
    """H16 + P7 — JSON value → struct → flat columns plus recommendation_id.

    A malformed value parses to an all-null struct (the raw text is kept in
    ``json_str`` for the dead-letter output).
    """
    parsed = messages.select(
        F.col(key_col).cast("string").alias("recommendation_id"),
        F.col(value_col).cast("string").alias("json_str"),
        F.from_json(F.col(value_col).cast("string"), schema).alias("data"))
    return parsed.select("data.*", "recommendation_id", "json_str")


def flatten_request(messages: DataFrame) -> DataFrame:
    """P7 — ``select('data.*', id)`` after parsing."""
    return parse_request(messages).drop("json_str")


def tag_with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P8 — constant column."""
    return df.withColumn(name, F.lit(value))


def missing_fields(fields: Iterable[str] = REQUIRED_FIELDS) -> Column:
    """Array of the names of required fields that are null in the row."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))


def in_range(value: Column) -> Column:
    """True for a number that an int can hold (false for NaN and infinities)."""
    return F.coalesce((value > -INT_LIMIT) & (value < INT_LIMIT), F.lit(False))


def out_of_range(fields: Iterable[str] = REQUIRED_FIELDS) -> Column:
    """Array of 'range:<field>' for required fields present but not in range."""
    return F.array_compact(F.array(*[
        F.when(F.col(f).isNotNull() & ~in_range(F.col(f)), F.lit(f"range:{f}")) for f in fields]))


def validate_required(df: DataFrame, fields: Iterable[str] = REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    """P9 — split rows into (good, bad); bad rows carry ``missing`` (names)."""
    tagged = df.withColumn("missing", missing_fields(fields))
    good = tagged.where(F.size("missing") == 0).drop("missing")
    bad = tagged.where(F.size("missing") > 0)
    return good, bad


def coerce_types_with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """P10 — float fields → double, int fields → int (truncation toward zero),
    unreadable, missing or (ints) beyond the int range → the default."""
    defaults = defaults or FIELD_DEFAULTS
    out = df
    for name, default in defaults.items():
        if isinstance(default, float):
            val = F.col(name).cast("string").try_cast(T.DoubleType())
            out = out.withColumn(name, F.coalesce(val, F.lit(default)))
        else:
            as_double = F.col(name).cast("string").try_cast(T.DoubleType())
            val = F.when(in_range(as_double), as_double.cast("int"))
            out = out.withColumn(name, F.coalesce(val, F.lit(default)))
    return out


def narrow_types(df: DataFrame) -> DataFrame:
    """P11 — float32 features and int8 codes (storage types)."""
    casts = {"tempo": "float", "loudness": "float", "danceability": "float",
             "key": "tinyint", "mode": "tinyint", "time_signature": "tinyint"}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def tag_bad_rows(messages: DataFrame) -> DataFrame:
    """The parsed rows with their raw message and a reason, null for good rows.
    A row is bad when its JSON cannot be read or any required field is missing
    or out of range (so that no later cast can fail on it)."""
    parsed = parse_request(messages)
    wrong = F.concat(missing_fields(), out_of_range())
    reason = F.when(F.col("track_name").isNull() & F.col("artist_name").isNull() & F.col("tempo").isNull(),
                    F.lit("unreadable")).otherwise(F.concat_ws(",", wrong))
    return parsed.withColumn("reason", F.when(F.size(wrong) > 0, reason))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected raw rows) of :func:`tag_bad_rows`."""
    good = tagged.where(F.col("reason").isNull()).drop("reason", "json_str")
    bad = tagged.where(F.col("reason").isNotNull()).select("recommendation_id", "json_str", "reason")
    return good, bad


def drop_bad_rows(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P12 — (parsed rows, rejected raw rows); rejected rows keep the raw
    message and the reason, nothing is silently lost."""
    return split_tagged(tag_bad_rows(messages))


def exclude_seed(candidates: DataFrame, seeds: DataFrame, on: str = "song_id") -> DataFrame:
    """P13 — never recommend the seed itself (left anti join)."""
    return candidates.join(seeds.select(on).distinct(), on=on, how="left_anti")


def hash_fraction(id_col: Column, seed: int) -> Column:
    """Deterministic uniform value in [0, 1) from md5(id || ':' || seed).

    Layout-independent (unlike ``DataFrame.sample``), so the same rows are
    kept however the input is partitioned; identical in DuckDB.
    """
    h = F.conv(F.substring(F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10)
    return h.cast("long") / F.lit(float(1 << 32))


def sample_songs(df: DataFrame, fraction: float, seed: int = 42, id_col: str = "song_id",
                 method: str = "hash") -> DataFrame:
    """P14 — Bernoulli sample of ``fraction`` of the rows.  ``method='hash'``
    keys the draw on the id (reproducible); ``'spark'`` uses ``df.sample``."""
    if method == "spark":
        return df.sample(fraction=fraction, seed=seed)
    return df.where(hash_fraction(F.col(id_col), seed) < F.lit(fraction))


def song_summary(df: DataFrame) -> DataFrame:
    """P15 — one row per song with every array/map/struct column removed."""
    keep = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.select(*keep)


def data_quality_scan(df: DataFrame, domains: dict | None = None, expected_rows: int | None = None) -> DataFrame:
    """A14 — one pass over every field: nulls, NaNs, out-of-domain values per
    column, plus the row count and whether it equals the expectation.

    Output: one row per column (column, n_rows, n_null, n_nan, n_out_of_domain,
    rows_as_expected).  One aggregate job; the unpivot runs on one row.
    """
    domains = domains or {}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    names = []
    for f in df.schema.fields:
        c = F.col(f.name)
        names.append(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"{f.name}__null"))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            aggs.append(F.count_if(F.isnan(c)).alias(f"{f.name}__nan"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"{f.name}__nan"))
        if f.name in domains:
            lo, hi = domains[f.name]
            aggs.append(F.count_if(c.isNotNull() & ~c.between(lo, hi)).alias(f"{f.name}__ood"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"{f.name}__ood"))
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(f"{n}__null").alias("n_null"),
                 F.col(f"{n}__nan").alias("n_nan"), F.col(f"{n}__ood").alias("n_out_of_domain"))
        for n in names]))
    expect = F.lit(True) if expected_rows is None else (F.col("n_rows") == F.lit(expected_rows))
    return one.select("n_rows", expect.alias("rows_as_expected"), rows.alias("r")).select(
        "r.column", "n_rows", "r.n_null", "r.n_nan", "r.n_out_of_domain", "rows_as_expected")
