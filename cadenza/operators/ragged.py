"""Ragged arrays ↔ flat arrays with offsets (W4, W5) and per-song segment
statistics (A10).

A prefix sum over a global order has no partition key, and a plain
``Window.orderBy`` would pull every row into one task.  W4 uses a two-level
scan instead: range-partition by the order key, sort inside each partition and
add up there as the rows pass, take one total per partition (a table of
#partitions rows — bounded by configuration, so broadcast is safe) and prefix
those totals.  The partitioned frame is stored with its sums first, so the
partition ids seen by both levels are the same even if a task is re-run after
an executor loss.  W5 has positions to go by: its partitions are intervals of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import cut_lineage


def _range_split(df: DataFrame, order: Sequence[str], parts: int | None) -> DataFrame:
    """The rows in ``order``, cut into ranges; ``_pid`` numbers them."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())


def _running(split: DataFrame, size_col: str) -> DataFrame:
    """``split`` with ``_local``, the sum of the sizes before a row in its range.
    The rows stand in order already; a window would deal and sort them again."""
    schema = T.StructType([*split.schema.fields, T.StructField("_size", T.LongType()), T.StructField("_local", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = batch.column("_size")
            upto = before + np.cumsum(sizes.to_numpy(zero_copy_only=False))
            if len(upto):
                before = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - sizes.to_numpy(zero_copy_only=False), pa.int64())], names=[*batch.schema.names, "_local"])

    return split.withColumn("_size", F.coalesce(F.col(size_col), F.lit(0)).cast("long")).mapInArrow(add, schema).drop("_size")


def _carried(split: DataFrame, total: Column) -> DataFrame:
    """``offset`` of each row of a stored split: ``_local`` and the totals of the ranges before."""
    totals = split.groupBy("_pid").agg(total.alias("_t"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("_pid", F.coalesce(F.sum("_t").over(wp), F.lit(0)).alias("_carry"))  # ≤ #partitions rows
    out = split.join(F.broadcast(carry), "_pid")
    return out.withColumn("offset", (F.col("_carry") + F.col("_local")).cast("long")).drop("_pid", "_carry", "_local")


def ragged_offsets(df: DataFrame, order, size_col: str, parts: int | None = None) -> DataFrame:
    """W4 — start index of each row's slice when the arrays are concatenated
    in ``order`` (a column name or list): offset = Σ sizes of all earlier
    rows (0 for the first).  With sizes of 1 this is a global 0-based rank."""
    order = [order] if isinstance(order, str) else list(order)
    return _carried(cut_lineage(_running(_range_split(df, order, parts), size_col)), F.sum(size_col))


def global_rank(df: DataFrame, order, parts: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (must be a total order),
    computed without a single-task window (two-level count)."""
    order = [order] if isinstance(order, str) else list(order)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)   # the row's number in its task
    split = cut_lineage(_range_split(df, order, parts).withColumn("_local", at))
    return _carried(split, F.count(F.lit(1))).withColumnRenamed("offset", "rank0")


#: An element's bucket is its position without these low bits (65,536 positions).
_BUCKET_BITS = 16


def _owned(flat: DataFrame, starts: DataFrame, pos: str, parts: int | None) -> DataFrame:
    """Starts (``_k`` 0) and elements (1) with bucket ``_b``, place ``_p``, value
    ``_v``, the ``_owner`` of that place and whether the owner's slice may reach
    out of its bucket (``_spans``).  ``starts``: (_p, _o).

    Buckets are intervals of positions, so they are the same in every run: one
    shuffle and no sampling or checkpoint.  What a bucket takes over from those
    before it follows from the starts alone (a row a bucket)."""
    kind, own = flat.schema["value"].dataType, starts.schema["_o"].dataType
    bucket = F.shiftright("_p", _BUCKET_BITS).alias("_b")
    both = starts.select("_p", F.lit(0).alias("_k"), "_o", F.lit(None).cast(kind).alias("_v")).unionByName(
        flat.select(F.col(pos).cast("long").alias("_p"), F.lit(1).alias("_k"), F.lit(None).cast(own).alias("_o"), F.col("value").alias("_v")))
    both = both.select(bucket, "*")
    if parts:
        both = both.repartition(parts, "_b")
    per = starts.groupBy(bucket).agg(F.max(F.struct("_p", "_o"))["_o"].alias("_last"))
    following = F.lead("_b").over(Window.orderBy("_b"))   # over #buckets rows
    carry = per.withColumn("_n", following).where(F.col("_n").isNotNull()).select(
        F.explode(F.sequence(F.col("_b") + 1, F.col("_n"))).alias("_b"), F.col("_last").alias("_carry"))
    end = per.agg(F.max("_b").alias("_end"), F.max_by("_last", "_b").alias("_final"))
    edges = per.join(carry, "_b", "full")
    wl = Window.partitionBy("_b").orderBy("_p", "_k", "_o").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_own", F.last("_o", ignorenulls=True).over(wl)) \
        .join(F.broadcast(edges), "_b", "left").crossJoin(F.broadcast(end))
    before = F.when(F.col("_b") > F.col("_end"), F.col("_final")).otherwise(F.col("_carry"))
    return out.select("_b", "_k", "_p", "_v", F.coalesce("_own", before).alias("_owner"),
                      F.coalesce(F.col("_own") == F.col("_last"), F.lit(True)).alias("_spans"))


def ragged_owner(flat: DataFrame, offsets: DataFrame, pos: str = "pos", order: str = "ord",
                 start: str = "offset", parts: int | None = None) -> DataFrame:
    """(order, pos, value): each flat element with the row whose slice
    [start_i, start_{i+1}) contains its position (the last row runs to the
    end).  ``value`` may be of any type, a vector of a two-dimensional array
    as well as a number.

    Elements and slice starts are merged in ``pos`` order; the owner of an
    element is the last start at or before it (a two-level running 'last').
    Of several rows that start at one place the last one owns it: the others
    are empty slices."""
    starts = offsets.groupBy(F.col(start).cast("long").alias("_p")).agg(F.max(order).alias("_o"))
    owned = _owned(flat, starts, pos, parts).where(F.col("_k") == 1)
    return owned.select(F.col("_owner").alias(order), F.col("_p").alias(pos), F.col("_v").alias("value"))


def ragged_slice(flat: DataFrame, offsets: DataFrame, pos: str = "pos", order: str = "ord",
                 start: str = "offset", parts: int | None = None) -> DataFrame:
    """W5 — each row's array, rebuilt from the flat elements of its slice in
    position order.  Returns (order, values array).  Rows with empty slices
    keep an empty array."""
    owned = ragged_owner(flat.select(pos, F.col("value").cast("double").alias("value")), offsets, pos, order, start, parts)
    arrays = owned.groupBy(order).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos, "value"))), lambda s: s["value"]).alias("values"))
    return offsets.select(order).join(arrays, order, "left").select(
        order, F.coalesce("values", F.array().cast("array<double>")).alias("values"))


def explode_offsets(off: DataFrame, arr: str) -> DataFrame:
    """(pos, value) of the arrays of a frame that has its offsets."""
    return off.select("offset", F.posexplode(arr).alias("_i", "value")).select((F.col("offset") + F.col("_i")).alias("pos"), "value")


def explode_with_offsets(df: DataFrame, order: str, arr: str) -> DataFrame:
    """Flatten per-row arrays into (pos, value) using W4 offsets."""
    return explode_offsets(ragged_offsets(df.withColumn("_n", F.size(arr)), order, "_n"), arr)


def _moments(vec_col: str, dim: int) -> list:
    aggs = [F.avg(F.col(vec_col)[i]).alias(f"timbre_mean_{i}") for i in range(dim)]
    return aggs + [F.stddev_pop(F.col(vec_col)[i]).alias(f"timbre_std_{i}") for i in range(dim)]


def _known(dim: int, digits: int | None) -> list:
    """The statistics, 0 where there is none, rounded."""
    cols = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in [f"timbre_{m}_{i}" for m in ("mean", "std") for i in range(dim)]}
    return [(x if digits is None else F.round(x, digits)).alias(c) for c, x in cols.items()]


def timbre_mean_std(segments: DataFrame, songs: DataFrame, song_col: str, vec_col: str, dim: int = 12, digits: int | None = 6) -> DataFrame:
    """A10 — per song and dimension, mean and population std over its
    segments; a song without segments gets zeros.  ``2·dim`` algebraic
    aggregates of array elements (partial aggregation, no explode)."""
    per = segments.groupBy(song_col).agg(*_moments(vec_col, dim))
    return songs.select(song_col).distinct().join(per, song_col, "left").select(song_col, *_known(dim, digits))


def ragged_timbre(flat: DataFrame, offsets: DataFrame, song_col: str = "song_id", dim: int = 12, digits: int | None = 6,
                  size_col: str | None = None) -> DataFrame:
    """A10 over a two-dimensional ragged array: ``flat`` (pos, value) holds the
    segments' vectors of all songs one after the other, ``offsets`` where each
    song's slice starts (W4; a row a song, ``size_col``: its length, if known).
    A segment goes to its song by position.

    A song's start and segments lie in one bucket of positions, where they are
    added up without another shuffle; only the last song of each bucket may
    reach into the next ones, and those few are added up by song.  Songs known
    to be empty take no part."""
    filled = offsets if size_col is None else offsets.where(F.col(size_col) > 0)
    starts = filled.select(F.col("offset").cast("long").alias("_p"), F.col(song_col).alias("_o"))
    owned = _owned(flat, starts, "pos", None).where(F.col("_owner").isNotNull()).withColumnRenamed("_owner", song_col)
    inside = owned.where(~F.col("_spans")).groupBy("_b", song_col).agg(*_moments("_v", dim)).drop("_b")
    across = owned.where("_spans").groupBy(song_col).agg(*_moments("_v", dim))
    out = inside.unionByName(across)
    if size_col is not None:
        out = out.unionByName(offsets.where(F.col(size_col) == 0).select(song_col), allowMissingColumns=True)
    return out.select(song_col, *_known(dim, digits))
