"""Recommendation joins.

Design for skew: a cluster, a Camelot code or a tempo may hold a third of the
catalog.  Nothing here joins a request to every song of its cluster:

* nearest tempo (W1/J2) is an as-of search.  Both sides are first reduced to
  distinct (keys, tempo) points by partial aggregation; the search runs as a
  running window inside (keys, tempo bucket) partitions, whose buckets get
  narrower with the catalog, and a request whose bucket has no neighbour on
  one side falls back to a per-bucket summary grid.
* top-k per cluster (W2) is computed once per cluster with a group limit
  (partial limit before the shuffle), then joined to requests.
* cosine top-N (W7) deals seeds and candidates of a cluster into tiles whose
  number follows the counts and keeps only N per seed per tile.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import harmony as H
from cadenza.functions.vectors import cosine_similarity, squared_distance
from cadenza.session import checkpoint_dir

TEMPO_LO, TEMPO_HI = 40, 250
POINTS_PER_BUCKET = 10_000            # distinct tempos of one key that an as-of bucket holds, about
BLOCK_POINTS = 100                    # points of a block that a probe looks through
BLOCKS_PER_TASK = 20_000              # blocks of a stored index that a task holds, about
TILE_SEEDS, TILE_ROWS = 1024, 16384   # vectors of a tile of the cosine product, about
SEED_BLOCK = 64                       # seeds multiplied at a time inside a tile
PLAIN_NUMBERS = 128                   # numbers of the centres that a projection spells out


# --- nearest tempo (as-of search) -------------------------------------------------

def _bucket(tempo: Column, per_bpm: int) -> Column:
    """Bucket of 1/per_bpm BPM, clamped to the grid so any tempo (even outside
    the serving range) has a grid row: results stay exact for every input."""
    lo, hi = F.lit((TEMPO_LO - 1) * per_bpm), F.lit((TEMPO_HI + 1) * per_bpm)
    return F.least(F.greatest(F.floor(tempo * per_bpm), lo), hi).cast("int")


def _points(catalog: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Distinct catalog points: one row per (keys, tempo) holding the song with
    the smallest song_id at that tempo (partial aggregation absorbs hot keys)."""
    best = F.min(F.struct(*[F.col(c) for c in payload])).alias("song")
    return catalog.groupBy(*keys, "tempo").agg(best)


def build_tempo_index(catalog: DataFrame, keys: list[str],
                      payload: list[str] = ("song_id", "title", "artist", "tempo", "key"),
                      points_per_bucket: int = POINTS_PER_BUCKET) -> tuple[DataFrame, DataFrame, int]:
    """Catalog side of the as-of search: (points, grid, buckets per BPM).

    ``points``: one row per distinct (keys, tempo) with the smallest song_id
    there, tagged with its tempo bucket, stored once.  Buckets get narrower as
    the fullest key gets more points, so that each holds about
    ``points_per_bucket`` and none is a task of its own at any size.
    ``grid``: for every (keys, bucket) the nearest catalog point in a lower and
    in a higher bucket; Spark broadcasts it if it is small.  A serving job
    builds this once and persists it; every request batch only probes it.
    """
    payload = list(payload)
    if payload[0] != "song_id" or "tempo" not in payload:
        raise ValueError("payload must start with song_id and contain tempo")
    spark, path = catalog.sparkSession, checkpoint_dir(catalog.sparkSession, "tempo-index")
    found = _points(catalog, keys, payload)
    found.write.parquet(path)   # a table in the shared folder: read twice, and by every batch
    pts = spark.read.schema(found.schema).parquet(path)
    fullest = pts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    per_bpm = max(1, -(-fullest // (points_per_bucket * (TEMPO_HI - TEMPO_LO))))
    pts = pts.withColumn("bucket", _bucket(F.col("tempo"), per_bpm))
    summary = pts.groupBy(*keys, "bucket").agg(
        F.max(F.struct(F.col("tempo").alias("t"), F.col("song").alias("s"))).alias("hi"),
        F.min(F.struct(F.col("tempo").alias("t"), F.col("song").alias("s"))).alias("lo"))
    # dense (keys, bucket) grid: every bucket of the tempo domain for each key
    dense = summary.select(*keys).distinct().select(
        *keys, F.explode(F.sequence(F.lit((TEMPO_LO - 1) * per_bpm), F.lit((TEMPO_HI + 1) * per_bpm))).alias("bucket"))
    grid = dense.join(summary, [*keys, "bucket"], "left")
    # both as growing frames (one ascending, one descending): O(buckets) per key
    up = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select(
        *keys, "bucket",
        F.max("hi").over(up).getField("s").alias("below"),
        F.min("lo").over(down).getField("s").alias("above"))
    return pts, grid, per_bpm


@dataclass
class BlockIndex:
    """A tempo index that many batches probe.

    ``directory``: per (keys, bucket) the first tempo of each of its blocks
    (null without points) and the songs below and above the bucket.
    ``blocks``: per (keys, bucket, block) its points in order and the first
    song of the bucket's next block; dealt by these columns and stored so."""

    keys: list[str]
    per_bpm: int
    directory: DataFrame
    blocks: DataFrame

    def persist(self) -> BlockIndex:
        self.directory = self.directory.persist(StorageLevel.MEMORY_AND_DISK)
        self.blocks = self.blocks.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        self.directory.unpersist()
        self.blocks.unpersist()


def block_index(index: tuple[DataFrame, DataFrame, int], keys: list[str], size: int = BLOCK_POINTS) -> BlockIndex:
    """The :func:`build_tempo_index` tables cut into blocks of ``size`` points.
    A bucket is sorted here, once, and not by every batch."""
    pts, grid, per_bpm = index
    w = Window.partitionBy(*keys, "bucket").orderBy("tempo")
    cut = pts.select(*keys, "bucket", "tempo", "song", ((F.row_number().over(w) - 1) / size).cast("long").alias("block"))
    held = cut.groupBy(*keys, "bucket", "block").agg(F.array_sort(F.collect_list(F.struct("tempo", "song"))).alias("points"))   # ``size`` points
    wb = Window.partitionBy(*keys, "bucket").orderBy("block")
    held = held.withColumn("next", F.lead(F.col("points")[0]["song"]).over(wb))
    on = [*keys, "bucket", "block"]
    spark, path = pts.sparkSession, checkpoint_dir(pts.sparkSession, "tempo-blocks")
    held.write.parquet(path)   # read by the directory and by the dealt blocks
    stored = spark.read.schema(held.schema).parquet(path)
    starts = stored.groupBy(*keys, "bucket").agg(F.array_sort(F.collect_list(F.col("points")[0]["tempo"])).alias("starts"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // BLOCKS_PER_TASK))
    return BlockIndex(list(keys), per_bpm, grid.join(starts, [*keys, "bucket"], "left"), stored.repartition(parts, *on).sortWithinPartitions(*on))


def _nearest_in_blocks(probes: DataFrame, index: BlockIndex) -> DataFrame:
    """:func:`nearest_by_tempo` on blocks: a probe finds its bucket in the
    directory, its block among the bucket's first tempos, and looks through
    that block's points."""
    keys, on = index.keys, [*index.keys, "bucket", "block"]
    asked = probes.select(*keys, "tempo").distinct().withColumn("bucket", _bucket(F.col("tempo"), index.per_bpm))
    before = F.size(F.filter("starts", lambda s: s <= F.col("tempo")))
    located = asked.join(index.directory, [*keys, "bucket"]).select(
        *keys, "bucket", "tempo", "below", "above", F.when(F.col("starts").isNotNull(), F.greatest(before - 1, F.lit(0)).cast("long")).alias("block"))
    up = F.filter("points", lambda p: p["tempo"] <= F.col("tempo"))
    down = F.filter("points", lambda p: p["tempo"] >= F.col("tempo"))
    inside = index.blocks.join(located.where("block IS NOT NULL"), on).select(
        *keys, "tempo", F.coalesce(F.get(up, F.size(up) - 1)["song"], "below").alias("pred"), F.coalesce(F.get(down, F.lit(0))["song"], "next", "above").alias("succ"))
    outside = located.where("block IS NULL").select(*keys, "tempo", F.col("below").alias("pred"), F.col("above").alias("succ"))
    return _nearer(inside.unionByName(outside), keys)


def nearest_by_tempo(probes: DataFrame, catalog: DataFrame | None, keys: list[str],
                     payload: list[str] = ("song_id", "title", "artist", "tempo", "key"),
                     index: tuple[DataFrame, DataFrame, int] | BlockIndex | None = None) -> DataFrame:
    """For each distinct probe point (keys, tempo) the catalog song minimising
    (|Δtempo|, song_id) among songs with equal ``keys``.

    ``probes`` has columns keys + ['tempo']; returns keys + ['tempo', 'song']
    where ``song`` is a struct of ``payload`` (null when no song matches).
    Exact; no request × song pairs are formed.
    """
    if isinstance(index, BlockIndex):
        return _nearest_in_blocks(probes, index)
    pts, grid, per_bpm = index if index is not None else build_tempo_index(catalog, keys, payload)
    probe_pts = probes.select(*keys, "tempo").distinct()
    bucket = _bucket(F.col("tempo"), per_bpm)
    both = (pts.select(*keys, "tempo", "bucket", F.lit(0).alias("kind"), "song")
            .unionByName(probe_pts.select(*keys, "tempo", bucket.alias("bucket"), F.lit(1).alias("kind"),
                                          F.lit(None).cast(pts.schema["song"].dataType).alias("song"))))
    part = [*keys, "bucket"]
    before = Window.partitionBy(*part).orderBy("tempo", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # successor as a running frame over the reversed order: O(n) per partition
    # (an unbounded-following frame would be re-evaluated row by row)
    after = Window.partitionBy(*part).orderBy(F.desc("tempo"), F.desc("kind")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.select(
        *keys, "tempo", "bucket", "kind",
        F.last("song", ignorenulls=True).over(before).alias("pred"),
        F.last("song", ignorenulls=True).over(after).alias("succ"),
    ).where(F.col("kind") == 1).drop("kind")
    resolved = local.join(grid, [*keys, "bucket"], "left").select(
        *keys, "tempo",
        F.coalesce("pred", "below").alias("pred"), F.coalesce("succ", "above").alias("succ"))
    return _nearer(resolved, keys)


def _nearer(resolved: DataFrame, keys: list[str]) -> DataFrame:
    """The nearer of the songs ``pred`` and ``succ`` (ties → song_id)."""
    d_pred = F.abs(F.col("tempo") - F.col("pred.tempo"))
    d_succ = F.abs(F.col("succ.tempo") - F.col("tempo"))
    cand_p = F.when(F.col("pred").isNotNull(), F.struct(d_pred.alias("d"), F.col("pred.song_id").alias("id"), F.col("pred").alias("s")))
    cand_s = F.when(F.col("succ").isNotNull(), F.struct(d_succ.alias("d"), F.col("succ.song_id").alias("id"), F.col("succ").alias("s")))
    best = F.least(cand_p, cand_s)
    return resolved.select(*keys, "tempo", best.getField("s").alias("song"))


def with_fixed_cluster(df: DataFrame, key: str = "key", ts: str = "time_signature") -> DataFrame:
    """Cluster id by the fixed rule (stand-in for a model; see catalog.fixed_cluster)."""
    from cadenza.sources.catalog import fixed_cluster
    return df.withColumn("cluster_id", fixed_cluster(F.col(key).try_cast("int"), F.col(ts).try_cast("int")))


def clean_requests(requests: DataFrame) -> DataFrame:
    """The serving filters (P2, P3) applied to requests."""
    return requests.where(F.col("tempo").between(40, 250) & F.col("time_signature").between(1, 5))


def nearest_tempo_per_request(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """W1 — per request, the song of its cluster with the nearest tempo
    (ties → smaller song_id)."""
    probes = requests.select("recommendation_id", "cluster_id", "tempo")
    ans = nearest_by_tempo(probes, catalog, ["cluster_id"])
    out = probes.join(ans, ["cluster_id", "tempo"]).where(F.col("song").isNotNull())
    return out.select("recommendation_id", F.col("song.song_id").alias("song_id"),
                      F.round(F.abs(F.col("song.tempo") - F.col("tempo")), 6).alias("tempo_diff"))


def harmonic_catalog(catalog: DataFrame) -> DataFrame:
    """Catalog songs with their Camelot code (songs without one are dropped)."""
    return H.with_camelot(catalog).where(F.col("camelot_num").isNotNull()).select(
        "song_id", "title", "artist", "tempo", "key", "cluster_id", "camelot")


def harmonic_index(catalog: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The J2 catalog index keyed by (cluster_id, camelot)."""
    return build_tempo_index(harmonic_catalog(catalog), ["cluster_id", "camelot"])


def join_harmonic_nearest_tempo(requests: DataFrame, catalog: DataFrame | None,
                                index: tuple[DataFrame, DataFrame, int] | BlockIndex | None = None) -> DataFrame:
    """J2 — per request: among songs of its cluster whose Camelot code is one
    of the request's 4 neighbours, the nearest tempo (ties → song_id).

    ``requests``: recommendation_id, cluster_id, tempo, key, mode.
    ``catalog``: song_id, title, artist, tempo, key, mode, cluster_id — or a
    prebuilt ``index`` (:func:`harmonic_index`).
    Requests without a Camelot code or without any match get no row.
    """
    req = H.with_camelot(requests).where(F.col("camelot_num").isNotNull())
    probes = req.select("recommendation_id", "cluster_id", F.col("tempo"),
                        F.explode(H.camelot_neighbors(F.col("camelot_num"), F.col("camelot_letter"))).alias("camelot"))
    index = index if index is not None else harmonic_index(catalog)
    ans = nearest_by_tempo(probes, None, ["cluster_id", "camelot"], index=index)
    cand = probes.join(ans, ["cluster_id", "camelot", "tempo"]).where(F.col("song").isNotNull())
    diff = F.abs(F.col("song.tempo") - F.col("tempo"))
    best = cand.groupBy("recommendation_id").agg(
        F.min(F.struct(diff.alias("d"), F.col("song.song_id").alias("id"), F.col("song").alias("s"))).alias("b"))
    return best.select("recommendation_id", "b.s.song_id", "b.s.title", "b.s.artist", "b.s.tempo", "b.s.key",
                       F.round(F.col("b.d"), 6).alias("tempo_diff"))


def top_k_per_cluster(catalog: DataFrame, k: int = 3, col: str = "cluster_id") -> DataFrame:
    """First k songs of each cluster by song_id (group limit before the
    shuffle).  A song id stored several times is one song: its smallest row."""
    w = Window.partitionBy(col).orderBy("song_id")
    ranked = catalog.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= k)
    others = [c for c in catalog.columns if c not in (col, "song_id")]
    one = ranked.groupBy(col, "song_id", "rank").agg(F.min(F.struct(*others)).alias("_row"))   # k rows a cluster
    return one.select(col, "song_id", "_row.*", "rank")


def top3_per_request(requests: DataFrame, catalog: DataFrame, k: int = 3) -> DataFrame:
    """W2 — k songs of the request's cluster (by song_id).  The per-cluster
    table has ≤ k × #clusters rows; other columns of the catalog come along."""
    return requests.select("recommendation_id", "cluster_id").join(top_k_per_cluster(catalog, k), "cluster_id")


def join_request_cluster(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """J1 — each request with its predicted cluster's candidate set, summarised
    (size and tempo range).  The full request × song product is never formed;
    W1/W2/J2 pick songs from it."""
    per = catalog.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.min("tempo").alias("min_tempo"), F.max("tempo").alias("max_tempo"))
    return requests.select("recommendation_id", "cluster_id").join(per, "cluster_id")


def lookup_metadata(ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """J9 — song ids → title, artist (planner broadcasts the smaller side
    when its estimated size is under the threshold)."""
    return ids.join(metadata.select("song_id", "title", "artist"), "song_id")


def format_replies(recs: DataFrame, seq: Column | None = None) -> DataFrame:
    """H16 — (key, value) reply rows: value = JSON {artist, title, tempo, key}."""
    value = F.to_json(F.struct("artist", "title", "tempo", "key"))
    cols = [F.col("recommendation_id").alias("key"), value.alias("value")]
    if seq is not None:
        cols.append(seq.alias("seq"))
    return recs.select(*cols)


def fetch_reply(request_ids: DataFrame, replies: DataFrame, limit: int = 3, buckets: int | None = None) -> DataFrame:
    """J13 — for each requested id, at most ``limit`` replies in arrival order.
    ``buckets``: ``replies`` is a store (:func:`write_reply_store`) of so many
    buckets, of which only those of the ids are read (partition pruning, at
    run time from the requests)."""
    from cadenza.sources.io import reply_bucket

    w = Window.partitionBy("key").orderBy("seq", "value")
    ids = request_ids.select(F.col("recommendation_id").alias("key")).distinct()
    on = ["key"]
    if buckets:
        ids, on = ids.withColumn("bucket", reply_bucket(F.col("key"), buckets)), ["bucket", "key"]
    r = replies.join(ids, on, "left_semi").select("key", "value", "seq")
    return r.withColumn("n", F.row_number().over(w)).where(F.col("n") <= limit).drop("seq")


def fetch_one(store: DataFrame, recommendation_id: str, buckets: int, limit: int = 3) -> DataFrame:
    """J13 for a single id: its bucket is a constant of the plan."""
    from cadenza.sources.io import reply_bucket

    own = store.where((F.col("bucket") == reply_bucket(F.lit(recommendation_id), buckets)) & (F.col("key") == recommendation_id))
    return own.select("key", "value", "seq").orderBy("seq", "value").limit(limit)


# --- vectors: centroids, probabilities, cosine top-N --------------------------------

def _centers_literal(centers: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])


def _nearest_of(centers: list[list[float]]):
    """Arrow function: (distance, index) of the nearest centre of whole vectors
    (ties: the smaller index), null for null."""
    at = np.array(centers, np.float64)

    @F.pandas_udf("d double, i int")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        some = vectors.notna().to_numpy()
        x = np.stack(vectors[some].to_numpy()).astype(np.float64) if some.any() else np.zeros((0, at.shape[1]))
        d = np.zeros((len(x), len(at)))
        for j in range(at.shape[1]):
            d += (x[:, j, None] - at[None, :, j]) ** 2
        i = d.argmin(axis=1)
        out = pd.DataFrame({"d": np.full(len(vectors), np.nan), "i": np.zeros(len(vectors), np.int32)})
        out.loc[some, "d"], out.loc[some, "i"] = d[np.arange(len(x)), i], i.astype(np.int32)
        return out

    return nearest


def assign_nearest_centroid(vectors: DataFrame, centers: list[list[float]], vec_col: str = "embedding",
                            out: str = "cluster") -> DataFrame:
    """J10 — argmin squared distance to k fixed centres (ties → lower id).

    The k centres are model parameters (bounded by k × d) and enter
    the plan, so the assignment is one projection — no join: as plain
    arithmetic if they are few numbers (compiled code), else over Arrow
    batches, which add up in the same order.

    A row always has a cluster and the column says so: else a join on it asks
    for "not null", and that filter takes the whole arithmetic down to the scan
    with each use of a feature spelled out."""
    own, dim = F.col(vec_col), len(centers[0])
    if sum(map(len, centers)) <= PLAIN_NUMBERS:
        # numbers that are never null, each worked out once.  A function with a lambda stands among the
        # distances, so Spark compiles them apart and in pieces: fused with the steps around them they
        # are one method of over 8,000 bytes, which the JVM only interprets
        x, d = [f"_x{j}" for j in range(dim)], [f"_d{i}" for i in range(len(centers))]
        told = vectors.withColumns({c: F.coalesce(F.get(own, F.lit(j)).cast("double"), F.lit(0.0)) for j, c in enumerate(x)})
        off = [[F.col(c) - F.lit(float(v)) for c, v in zip(x, center)] for center in centers]
        whole = F.coalesce((F.size(own) == dim) & ~F.exists(own, lambda v: v.isNull()), F.lit(False))
        told = told.withColumns({"_whole": whole, **{c: reduce(add, [o * o for o in row], F.lit(0.0)) for c, row in zip(d, off)}}).drop(*x)
        told = told.withColumn("_least", F.least(*d) if len(d) > 1 else F.col(d[0]))
        first = reduce(lambda rest, i: F.when(F.col(d[i]) == F.col("_least"), F.lit(i)).otherwise(rest), range(len(d) - 2, -1, -1), F.lit(len(d) - 1))
        best = told.withColumns({out: F.when(F.col("_whole"), first).otherwise(F.lit(0)), "sqdist": F.when(F.col("_whole"), F.col("_least"))})
        return best.drop("_whole", "_least", *d)   # null distance for another length or a null inside, as below
    whole = (F.size(own) == dim) & ~F.exists(own, lambda x: x.isNull())
    told = vectors.withColumn("_whole", F.when(whole, own.cast("array<double>")))
    best = told.withColumn("_best", _nearest_of(centers)("_whole")).drop("_whole")
    return best.withColumn(out, F.coalesce(F.col("_best.i"), F.lit(0)).cast("int")).withColumn("sqdist", F.col("_best.d")).drop("_best")


def centroid_probabilities(vectors: DataFrame, centers: list[list[float]], vec_col: str = "embedding",
                           out: str = "probability") -> DataFrame:
    """Class probabilities softmax(−squared distance) over the k centres."""
    neg = F.transform(_centers_literal(centers), lambda c: -squared_distance(F.col(vec_col), c))
    df = vectors.withColumn("_neg", neg).withColumn("_mx", F.array_max("_neg"))
    df = df.withColumn("_ex", F.transform("_neg", lambda v: F.exp(v - F.col("_mx"))))
    df = df.withColumn("_tot", F.aggregate("_ex", F.lit(0.0), lambda a, v: a + v))
    return df.withColumn(out, F.transform("_ex", lambda v: v / F.col("_tot"))).drop("_neg", "_mx", "_ex", "_tot")


def topc_clusters(df: DataFrame, c: int = 2, prob_col: str = "probability") -> DataFrame:
    """W6 — the C most probable classes per row (prob desc, ties → lower id),
    as an array column ``top_clusters`` (no shuffle: array sort per row)."""
    pairs = F.transform(F.col(prob_col), lambda p, i: F.struct((-p).alias("np"), i.alias("id")))
    ranked = F.slice(F.array_sort(pairs), 1, c)
    return df.withColumn("top_clusters", F.transform(ranked, lambda s: s.getField("id").cast("int")))


def join_topc_clusters(seeds: DataFrame, label: str = "label") -> DataFrame:
    """J14 — seed × its C clusters: (seed_id, cluster, rank).  The candidates
    of those clusters are scored by W7, tile by tile, and never listed."""
    return seeds.select("seed_id", F.posexplode("top_clusters").alias("rank", label))


def _exact_cosines(seed: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one seed with the rows of ``x``, summed component by
    component: a pair's value never depends on which rows stand beside it."""
    dot, own, other = np.zeros(len(x)), 0.0, np.zeros(len(x))
    for j in range(x.shape[1]):
        dot += seed[j] * x[:, j]
        own += seed[j] * seed[j]
        other += x[:, j] * x[:, j]
    norms = np.sqrt(own) * np.sqrt(other)
    return dot / np.where(norms == 0, 1e-12, norms)


def _tile_topn(n: int, exclude_self: bool, label: str):
    """applyInPandas body: the top n (score desc, id asc) of each seed in one
    tile.  A block product finds the rows that may be among them (its n-th
    best less a margin far above rounding); those are scored exactly.  The
    answers leave block by block, so a task holds those of ``SEED_BLOCK``
    seeds and not of the tile."""

    def best(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        seeds, cands = pdf[pdf["is_seed"]], pdf[~pdf["is_seed"]]
        if not len(seeds) or not len(cands):
            return
        x = np.stack(cands["embedding"].to_numpy()).astype(np.float64)
        ids = cands["vec_id"].to_numpy(dtype=np.int64)
        m = np.stack(seeds["embedding"].to_numpy()).astype(np.float64)
        sid = seeds["vec_id"].to_numpy(dtype=np.int64)
        del pdf, seeds, cands
        unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        xu, mu = unit(x), unit(m)
        for lo in range(0, len(m), SEED_BLOCK):
            out = []
            sims = mu[lo:lo + SEED_BLOCK] @ xu.T
            if exclude_self:
                sims[sid[lo:lo + SEED_BLOCK, None] == ids[None, :]] = -np.inf
            for i in range(len(sims)):
                kth = np.partition(sims[i], max(0, sims.shape[1] - n))[max(0, sims.shape[1] - n)]
                near = np.flatnonzero((sims[i] >= kth - 1e-9) & (sims[i] > -np.inf))
                score = _exact_cosines(m[lo + i], x[near])
                order = np.lexsort((ids[near], -score))[:n]
                out.append(pd.DataFrame({"seed_id": sid[lo + i], "vec_id": ids[near][order], "cosine": score[order], "pos": near[order]}))
            found = pd.concat(out, ignore_index=True)
            found[label] = np.int32(key[0])
            found["embedding"] = list(x[found.pop("pos").to_numpy()])
            yield found[["seed_id", "vec_id", "cosine", label, "embedding"]]

    return best


def cosine_topn(seeds: DataFrame, candidates: DataFrame, n: int = 200, label: str = "label",
                exclude_self: bool = True, with_embedding: bool = False,
                tile_seeds: int = TILE_SEEDS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """W7 — for every seed the N candidates of its top clusters with the
    highest cosine similarity (ties → smaller id).

    ``seeds``: seed_id, embedding, top_clusters.  ``candidates``: vec_id,
    embedding, label.  Both stay distributed: each cluster is a grid of tiles
    of about ``tile_seeds`` × ``tile_rows`` vectors (its size follows the
    counts, so a hot cluster is many tiles), a seed goes to the tiles of one
    grid row of each of its clusters, a candidate to those of one column.  A
    tile keeps N rows a seed; the final group limit merges the tiles.  Scores
    do not depend on the tiling, so neither does the result."""
    cands = candidates.select(F.col(label).cast("int").alias(label), "vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    probes = seeds.select(F.explode(F.col("top_clusters").cast("array<int>")).alias(label), F.col("seed_id").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    size = lambda df, per: df.groupBy(label).agg(F.ceil(F.count(F.lit(1)) / F.lit(per)).cast("int").alias("t"))
    grid = size(cands, tile_rows).withColumnRenamed("t", "cols").join(size(probes, tile_seeds).withColumnRenamed("t", "rows"), label)
    spread = lambda n_tiles: F.explode(F.sequence(F.lit(0), F.col(n_tiles) - 1))
    place = lambda n_tiles: F.pmod(F.xxhash64("vec_id"), F.col(n_tiles)).cast("int")
    left = probes.join(grid, label).select(label, place("rows").alias("row"), spread("cols").alias("col"), F.lit(True).alias("is_seed"), "vec_id", "embedding")
    right = cands.join(grid, label).select(label, spread("rows").alias("row"), place("cols").alias("col"), F.lit(False).alias("is_seed"), "vec_id", "embedding")
    tiles = left.unionByName(right).groupBy(label, "row", "col").applyInPandas(
        _tile_topn(n, exclude_self, label), f"seed_id long, vec_id long, cosine double, {label} int, embedding array<double>")
    if not with_embedding:
        tiles = tiles.drop("embedding")
    w = Window.partitionBy("seed_id").orderBy(F.desc("cosine"), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def cosine_col(a: Column, b: Column) -> Column:
    """H17 — cosine similarity of two array columns."""
    return cosine_similarity(a, b)


def recommend_batch(requests: DataFrame, catalog: DataFrame | None, assign=None,
                    index: tuple[DataFrame, DataFrame, int] | BlockIndex | None = None) -> DataFrame:
    """M18 — request rows → serving filters → cluster → J2 → (key, value)
    replies, for every request of the batch in one plan.

    ``assign(df) -> df`` adds ``cluster_id`` (a fitted model's transform); the
    default is the fixed rule used for oracle checks."""
    req = clean_requests(requests)
    req = assign(req) if assign is not None else with_fixed_cluster(req)
    return format_replies(join_harmonic_nearest_tempo(req, catalog, index))
