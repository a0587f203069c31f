"""Cluster and column statistics.

Every operator is a grouped or global aggregate with map-side partial
aggregation, so a hot group is reduced on each executor before the shuffle;
no operator collects values to the driver.  Doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.harmony import tempo_bin
from cadenza.session import cut_lineage

FEATURES = ("tempo", "loudness", "key", "mode", "time_signature")
R = 6


def r6(c):
    return F.round(c, R)


def min_loudness(df: DataFrame, col: str = "loudness") -> DataFrame:
    """A1 — global minimum kept as a one-row frame (join it, never collect)."""
    return df.agg(F.min(col).alias("min_loudness"))


def cluster_sizes(df: DataFrame, col: str = "cluster_id") -> DataFrame:
    """A2 — songs per cluster."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_songs"))


def cluster_means(df: DataFrame, features: Sequence[str] = FEATURES, col: str = "cluster_id") -> DataFrame:
    """A3 — mean of each feature per cluster."""
    return df.groupBy(col).agg(*[r6(F.avg(f)).alias(f"avg_{f}") for f in features])


def cluster_stats(df: DataFrame, features: Sequence[str] = FEATURES, col: str = "cluster_id") -> DataFrame:
    """A4 — avg / min / max of each feature per cluster, generated from the list."""
    aggs = []
    for f in features:
        aggs += [r6(F.avg(f)).alias(f"avg_{f}"),
                 F.min(f).cast("double").alias(f"min_{f}"),
                 F.max(f).cast("double").alias(f"max_{f}")]
    return df.groupBy(col).agg(*aggs)


def tempo_key_histogram(df: DataFrame, width: int = 5) -> DataFrame:
    """A5 — songs by (tempo bin, key)."""
    return df.groupBy(tempo_bin(F.col("tempo"), width).alias("tempo_bin"), F.col("key")).agg(
        F.count(F.lit(1)).alias("n_songs"))


def tempo_bins(lo: int = 40, hi: int = 250, width: int = 5) -> list[int]:
    return list(range(lo - lo % width, hi + 1, width))


def tempo_key_pivot(df: DataFrame, bins: Sequence[int] | None = None, width: int = 5) -> DataFrame:
    """A6 — key rows × tempo-bin columns (``bin_<lo>``), missing cells 0.

    The bin list is fixed (from the tempo range), so the pivot needs no
    extra job to discover its values.
    """
    bins = list(bins or tempo_bins(width=width))
    hist = tempo_key_histogram(df, width)
    wide = hist.groupBy("key").pivot("tempo_bin", bins).agg(F.sum("n_songs"))
    return wide.select("key", *[F.coalesce(F.col(str(b)), F.lit(0)).cast("long").alias(f"bin_{b}") for b in bins])


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A7 — (column, value, n) for every listed column; values as strings
    (fractions with 6 places).

    Unpivot, then a single grouped count — one shuffle for all columns,
    partially aggregated per executor.
    """
    kinds = dict(df.dtypes)

    def text(c):
        x = F.col(c).cast("decimal(30,6)") if kinds[c] in ("double", "float") else F.col(c)
        return x.cast("string")

    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols])).alias("kv"))
    return long.groupBy("kv.column", "kv.value").agg(F.count(F.lit(1)).alias("n"))


def _value_ranks(df: DataFrame, cols: Sequence[str], kind: str = "double") -> DataFrame:
    """(column, value, n, upto): how often each distinct value of a column
    stands, and how many values stand up to it.

    Counted with map-side sums, range-partitioned by (column, value) and
    prefix-summed in two levels, so a hot value is one row and no column is
    sorted in one task; the range partitions are checkpointed before their
    totals are taken, so a task that runs again sees the same ones."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in cols])).alias("kv")).select("kv.*")
    counted = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = cut_lineage(counted.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("column", "part").agg(F.sum("n").alias("t"))   # columns × partitions rows
    before = totals.select("column", "part", (F.sum("t").over(Window.partitionBy("column").orderBy("part")) - F.col("t")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("column", "part").orderBy("value"))
    return placed.withColumn("inside", inside).join(before, ["column", "part"]).select(
        "column", "value", "n", (F.col("before") + F.col("inside")).alias("upto"))


def profile_columns(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A8 — per-column profile: rows, nulls, distinct, min, max, mean, sample
    std and quantiles (the smallest value with at least q of the values up to
    it), all exact at any size: distinct counts and quantiles come from the
    ranks of the distinct values, the rest from one aggregate job."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(F.col(c)).alias(f"{c}__n"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
            r6(F.avg(x)).alias(f"{c}__mean"), r6(F.stddev_samp(x)).alias(f"{c}__std"),
        ]
    one = df.agg(*aggs)
    basics = one.select(F.col("_rows").alias("n_rows"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std")) for c in cols])).alias("p")).select("n_rows", "p.*")
    ranks = _value_ranks(df, cols).join(basics.select("column", F.col("n").alias("total")), "column")   # a row per column: broadcast by size
    picked = ranks.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"), *[
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("total")), F.col("value"))).alias(f"q{int(q * 100)}") for q in quantiles])
    return basics.join(picked, "column", "left").select(
        "n_rows", "column", (F.col("n_rows") - F.col("n")).alias("n_null"), F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"),
        "min", "max", "mean", "std", *[f"q{int(q * 100)}" for q in quantiles])


def profile_text_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A8 for text and date columns (dates as ISO text): rows, nulls, distinct
    values, smallest, median and largest in code-point order, lengths, and the
    most frequent value (ties: the smallest) with its count.  All from the
    ranks of the distinct values: one count of (column, value) with map-side
    sums, range partitions over the collation order, prefix sums over them."""
    ranks = _value_ranks(df, cols, "string")
    size = F.char_length("value")
    total = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    counts = total.select(F.col("_rows").alias("n_rows"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("total")) for c in cols])).alias("t")).select("n_rows", "t.*")
    picked = ranks.join(counts, "column").groupBy("column").agg(   # counts: a row per column
        F.count(F.lit(1)).alias("n_distinct"), F.min("value").alias("smallest"), F.max("value").alias("largest"),
        F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("value"))).alias("median"),
        F.min(size).alias("min_length"), F.max(size).alias("max_length"), (F.sum(size * F.col("n")) / F.sum("n")).alias("mean_length"),
        F.min(F.struct((-F.col("n")).alias("less"), "value")).alias("top"))
    return counts.join(picked, "column", "left").select(
        "n_rows", "column", (F.col("n_rows") - F.col("total")).alias("n_null"), F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"),
        "smallest", "median", "largest", "min_length", "max_length", r6(F.col("mean_length")).alias("mean_length"),
        F.col("top.value").alias("most_frequent"), (-F.col("top.less")).alias("n_most_frequent"))


def feature_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A9 — Pearson correlation for every unordered pair, one aggregate job."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r6(F.col(f"{a}__{b}")).alias("corr"))
        for a, b in pairs])).alias("c")).select("c.*")


def count_rows(df: DataFrame, label: str) -> DataFrame:
    """A11 — row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("table"), "n_rows")


def shard_of(id_col, start: int = 3, length: int = 3):
    """S11/A12 — shard name: characters 3..5 (1-based) of the id."""
    return F.substring(id_col, start, length)


def shard_balance(df: DataFrame, id_col: str = "song_id", alphabet: int = 16, depth: int = 3) -> DataFrame:
    """A12 — rows per shard → min, max, avg, shards used of alphabet^depth,
    emptiest and fullest shard (ties → smallest name)."""
    per = df.groupBy(shard_of(F.col(id_col), 3, depth).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.min("n").alias("min_rows"), F.max("n").alias("max_rows"), r6(F.avg("n")).alias("avg_rows"),
        F.count(F.lit(1)).alias("n_shards"), F.lit(alphabet ** depth).cast("long").alias("possible_shards"),
        F.min_by("shard", F.struct("n", "shard")).alias("emptiest"),
        F.min_by("shard", F.struct(-F.col("n"), F.col("shard"))).alias("fullest"))


def distinct_clusters(df: DataFrame, col: str = "cluster_id") -> DataFrame:
    """A15 — distinct ids with their count attached to every row."""
    ids = df.select(col).distinct()
    return ids.withColumn("n_clusters", ids.agg(F.count(F.lit(1))).scalar())


def vector_dim(vectors: DataFrame, vec_col: str = "embedding") -> int:
    """Length of the vectors (0 if there are none); vectors of mixed lengths are an error."""
    r = vectors.agg(F.min(F.size(vec_col)).alias("lo"), F.max(F.size(vec_col)).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"vectors of mixed lengths, {r['lo']} to {r['hi']}")
    return r["hi"] or 0


def cluster_centroids(vectors: DataFrame, vec_col: str = "embedding", col: str = "label") -> DataFrame:
    """A16 — mean vector per cluster, long form (cluster, dim, mean).

    One average per array element and group (no explode before the aggregate,
    partial aggregation intact); the unpivot runs on k rows.
    """
    wide = centroid_arrays(vectors, vec_col, col).withColumnRenamed("centroid", "_m")
    return wide.select(col, F.posexplode("_m").alias("dim", "mean")).select(
        col, F.col("dim").cast("int").alias("dim"), r6(F.col("mean")).alias("mean"))


def centroid_arrays(vectors: DataFrame, vec_col: str = "embedding", col: str = "label") -> DataFrame:
    """Centroids as (cluster, array<double>) — k rows."""
    dim = vector_dim(vectors, vec_col)
    return vectors.groupBy(col).agg(F.array(*[F.avg(F.col(vec_col)[i]) for i in range(dim)]).alias("centroid"))
