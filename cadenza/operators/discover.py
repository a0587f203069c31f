"""Catalog discovery and assembly.

Top-k per group is always ``row_number() ≤ k`` over a window: Spark plans
it with a partial ``WindowGroupLimit`` before the shuffle, so a hot group
ships only k rows per map task.  Global caps use the two-level rank from
:mod:`cadenza.operators.ragged` instead of a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.operators.ragged import global_rank
from cadenza.session import cut_lineage


def top_k_by_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_familiar_artists(artists: DataFrame, n: int = 100) -> DataFrame:
    """K1 — n artists by familiarity desc (ties → artist_id); TakeOrdered."""
    return artists.orderBy(F.desc("familiarity"), "artist_id").limit(n)


def top_terms(artist_terms: DataFrame, n: int = 200) -> DataFrame:
    """K2 — most used terms: Σ freq per term, desc (ties → term), first n."""
    tot = artist_terms.groupBy("term").agg(F.sum("freq").alias("total_freq"))
    return tot.orderBy(F.desc("total_freq"), "term").limit(n)


def extremes_by_attribute(songs: DataFrame, attributes: Sequence[str], n: int = 100) -> DataFrame:
    """K3 — for every (attribute, asc|desc) the first n songs (ties →
    song_id), in ONE pass: each task keeps its n first per attribute and
    direction, batch by batch (no sort of all rows; once it has n, only rows
    before its n-th are looked at), and a group-limited row_number merges
    2 × attributes × n rows a task."""
    attributes = list(attributes)
    schema = "song_id string, attribute string, direction string, k double"

    def first(batches):
        kept = {(a, d): [] for a in attributes for d in ("asc", "desc")}   # (k, has id, id) in order
        for b in batches:
            ids = b.column(0)
            for (a, direction), best in kept.items():
                v = b.column(b.schema.get_field_index(a)).to_numpy(zero_copy_only=False).astype("float64", copy=False)
                k = (v if direction == "asc" else -v) + 0.0
                full = len(best) >= n
                at = np.flatnonzero(k < best[-1][0] if full else ~np.isnan(k))
                if full:   # ties of the n-th count only with an id before its id
                    same = np.flatnonzero(k == best[-1][0])
                    if len(same):
                        before = pc.less(ids.take(pa.array(same)), pa.scalar(best[-1][2], ids.type)).fill_null(True)
                        at = np.concatenate([at, same[before.to_numpy(zero_copy_only=False)]])
                if len(at) > n:
                    at = at[k[at] <= np.partition(k[at], n - 1)[n - 1]]   # ties of the n-th stay
                if len(at):
                    new = ((x, i is not None, i) for x, i in zip(k[at].tolist(), ids.take(pa.array(at)).to_pylist()))
                    best[:] = sorted([*best, *new])[:n]
        for (a, direction), best in kept.items():
            if best:
                yield pa.RecordBatch.from_pydict({"song_id": pa.array([r[2] for r in best], pa.string()), "attribute": [a] * len(best),
                                                  "direction": [direction] * len(best), "k": pa.array([r[0] for r in best], pa.float64())})

    narrow = songs.select(F.col("song_id").cast("string"), *[F.col(a).cast("double").alias(a) for a in attributes])
    top = top_k_by_group(narrow.mapInArrow(first, schema), ["attribute", "direction"], [F.col("k").asc(), "song_id"], n)
    return top.select("song_id", "attribute", "direction", "rank")


def most_recent(songs: DataFrame, n: int, ts: str = "added_at") -> DataFrame:
    """K4 — newest n rows (ties → song_id); TakeOrdered (per-task top n)."""
    return songs.orderBy(F.desc(ts), "song_id").limit(n)


def trim_to_target(songs: DataFrame, target: int, ts: str = "added_at", dry_run: bool = False) -> DataFrame:
    """K5 — keep the ``target`` oldest rows (drop the newest surplus); with
    ``dry_run`` return the surplus instead.  Exact global rank without a
    single-task window."""
    ranked = global_rank(songs, [ts, "song_id"])
    cond = F.col("rank0") >= target if dry_run else F.col("rank0") < target
    return ranked.where(cond).drop("rank0")


def random_subset(df: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """K6 — n rows in a seeded pseudo-random order (md5 of id and seed)."""
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("_h", key).orderBy("_h", id_col).limit(n).drop("_h")


def cap_songs_per_artist(songs: DataFrame, max_songs: int, order: Sequence = ("song_id",)) -> DataFrame:
    """W3 — at most ``max_songs`` songs per artist."""
    return top_k_by_group(songs, ["artist_id"], list(order), max_songs, "artist_rank")


def artists_by_term(artist_terms: DataFrame, artists: DataFrame, terms: DataFrame, per_term: int = 100) -> DataFrame:
    """J11 — for each selected term (in ``term_rank`` order) the artists that
    carry it, familiarity desc, ≤ per_term each; an artist is taken once, by
    its first (term_rank, fam_rank)."""
    t = artist_terms.join(terms.select("term", "term_rank"), "term") \
        .join(artists.select("artist_id", "familiarity"), "artist_id")
    top = top_k_by_group(t, ["term"], [F.desc("familiarity"), "artist_id"], per_term, "fam_rank")
    first = top.groupBy("artist_id").agg(F.min(F.struct("term_rank", "fam_rank", "term")).alias("f"))
    return first.select("artist_id", "f.term", "f.term_rank", "f.fam_rank")


def strongest_edges(edges: DataFrame, k: int = 10, parts: int | None = None) -> DataFrame:
    """The k heaviest neighbours of each artist (ties → dst).  ``parts``: the
    artists are dealt into so many tasks, for edges that are many."""
    dealt = edges.repartition(parts, "src") if parts else edges
    return top_k_by_group(dealt, ["src"], [F.desc("weight"), "dst"], k, "nb_rank").select("src", "dst")


def expand_similar_artists(roots: DataFrame, edges: DataFrame, neighbours: int = 10,
                           max_depth: int | None = None, max_size: int | None = None, parts: int | None = None) -> DataFrame:
    """J12 — breadth-first expansion: (artist_id, depth) for every artist
    reachable from ``roots`` through each artist's ``neighbours`` strongest
    edges; depth = shortest hop count.

    One join per level: frontier ⋈ edges → minus visited → new frontier.
    ``visited`` is cut with a reliable checkpoint each level (lineage stays
    short and survives executor loss).  The loop ends when the frontier is
    empty, at ``max_depth``, or once ``max_size`` artists are visited (the
    last level is then kept whole — no arbitrary subset of it is dropped).
    """
    nb = cut_lineage(strongest_edges(edges, neighbours, parts))   # read by every level
    visited = cut_lineage(roots.select("artist_id").distinct().withColumn("depth", F.lit(0)))
    frontier = visited
    depth = 0
    size = visited.count()
    while True:
        if max_depth is not None and depth >= max_depth:
            break
        if max_size is not None and size >= max_size:
            break
        nxt = frontier.join(nb, frontier.artist_id == nb.src).select(F.col("dst").alias("artist_id")).distinct() \
            .join(visited.select("artist_id"), "artist_id", "left_anti").withColumn("depth", F.lit(depth + 1))
        nxt = cut_lineage(nxt)          # each level is materialised once, reliably
        added = nxt.count()
        if added == 0:
            break
        depth += 1
        size += added
        visited = visited.unionByName(nxt)  # a union of checkpointed levels: short lineage
        frontier = nxt
    return visited


def union_features(frames: Sequence[DataFrame]) -> DataFrame:
    """U1 — concatenate frames by column name (missing columns → null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def visited_distinct(lists: Sequence[DataFrame], col: str = "artist_id") -> DataFrame:
    """U3 — distinct ids over several lists."""
    return union_features([f.select(col) for f in lists]).distinct()


def assemble_catalog(steps: Sequence[DataFrame], target: int, buffer: int = 0) -> DataFrame:
    """U4 — discovery steps (each a frame of song_id) unioned in order; a song
    counts for its first step; the result is capped at target − buffer by
    (step, song_id) with an exact global rank."""
    return assemble_tagged(union_features([s.select("song_id").withColumn("step", F.lit(i + 1)) for i, s in enumerate(steps)]), target, buffer)


def assemble_tagged(tagged: DataFrame, target: int, buffer: int = 0) -> DataFrame:
    """U4 over (song_id, step) rows of all steps."""
    first = tagged.groupBy("song_id").agg(F.min("step").alias("step"))
    ranked = global_rank(first, ["step", "song_id"])
    return ranked.where(F.col("rank0") < target - buffer).drop("rank0")


def songs_by_artist_steps(catalog: DataFrame, steps: list[tuple[int, DataFrame, int]]) -> DataFrame:
    """(song_id, step): for each (step, artists, cap) the artists' first ``cap``
    songs by song_id.  One pass over the catalog for all steps: an artist
    carries its steps, and its songs are ranked once up to the largest cap."""
    tagged = None
    for step, artists, cap in steps:
        one = artists.select("artist_id").distinct().withColumn("_s", F.struct(F.lit(step).alias("step"), F.lit(cap).alias("cap")))
        tagged = one if tagged is None else tagged.unionByName(one)
    per = tagged.groupBy("artist_id").agg(F.collect_list("_s").alias("_steps"))   # at most a row per step
    w = Window.partitionBy("artist_id").orderBy("song_id")
    most = max(cap for _, _, cap in steps)
    ranked = catalog.select("song_id", "artist_id").join(per.select("artist_id"), "artist_id", "left_semi") \
        .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    picked = ranked.join(per, "artist_id").select("song_id", "_r", F.explode("_steps").alias("s"))
    return picked.where(F.col("_r") <= F.col("s.cap")).select("song_id", F.col("s.step").alias("step"))


#: Rows of a task of the pair join and of its sums, about.
PAIR_ROWS = 200_000


def pair_parts(spark: SparkSession, rows: int) -> int:
    """Tasks for the pairs of ``rows`` members: more with the rows, so that a
    task's share stays what it is."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PAIR_ROWS))


def co_occurrence(per: DataFrame, group: str, member: str, n: str = "n", block: int = 1000, parts: int | None = None) -> DataFrame:
    """(src, dst, weight): members that share a group, weighted by the product
    of their counts ``n``, summed over groups.

    A pair is made and added up once, from its smaller member, and turned both
    ways at the end.  A group is joined with itself on its key.  A group of more
    than ``block`` members is dealt into blocks of about that many by a hash of
    the member; each pair of blocks is a join key of its own,
    so a group of a million members is a thousand times a thousand keys that
    many tasks share, and no key holds more than about ``block``² pairs.
    ``parts`` (:func:`pair_parts`): the members of large groups are dealt to so
    many tasks, and the pairs of two artists again before they are added up."""
    rows = per.select(F.col(group).alias("_g"), F.col(member).alias("_m"), F.col(n).alias("_n"))
    large = cut_lineage(rows.groupBy("_g").agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks")).where(F.col("_blocks") > 1))

    def side(df: DataFrame, name: str, weight: str, *keys) -> DataFrame:
        return df.select("_g", *keys, F.col("_m").alias(name), F.col("_n").alias(weight))

    def paired(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        return a.join(b, keys).where("src < dst").select("src", "dst", (F.col("_na") * F.col("_nb")).alias("_w"))

    some = not large.isEmpty()
    small = rows.join(large, "_g", "left_anti") if some else rows
    pairs = paired(side(small, "src", "_na"), side(small, "dst", "_nb"), ["_g"])
    if some:
        dealt = rows.join(large, "_g").withColumn("_own", F.pmod(F.xxhash64("_m"), "_blocks"))
        other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        a = side(dealt, "src", "_na", F.col("_own").alias("_i"), other.alias("_j"))
        b = side(dealt, "dst", "_nb", other.alias("_i"), F.col("_own").alias("_j"))
        if parts:
            a, b = (s.repartition(parts, "_g", "_i", "_j") for s in (a, b))
        pairs = pairs.unionByName(paired(a, b, ["_g", "_i", "_j"]))
    if parts:
        pairs = pairs.repartition(parts, "src", "dst")
    once = pairs.groupBy("src", "dst").agg(F.sum("_w").alias("weight"))
    ways = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    return once.select(ways.alias("_p"), "weight").select("_p.src", "_p.dst", "weight")
