"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint stands for its copies.  Two fingerprints at most
``2 r`` bits apart share a variant: some string within ``r`` flipped bits of
both.  So each fingerprint gives all its variants within ``r`` flips, equal
variants meet, and those that share one are linked.  As ``d(x, z) <= r`` and
``d(y, z) <= r`` give ``d(x, y) <= 2 r``, all members of a variant are links of
each other: a variant needs a star (smallest member to the others), not its
pairs.  Each star link is still checked by its bit distance.

How variants travel.  The bucket of a variant is a linear code of its bits
(xor of random words at set bits), so ``bucket(x ^ flips) = bucket(x) ^
bucket(flips)``: a fingerprint is sent once to each bucket that some of its
variants fall in, and the variants themselves are made in that bucket, from
the flips with the fitting code.  All occurrences of a variant meet in one
bucket, as if the variants had been shuffled, with 8 bytes sent for all the
variants of a fingerprint in a bucket.  The code's length follows the number of
fingerprints, so a bucket holds at most about ``BUCKET_ROWS`` at any size.
Fingerprints are distinct, so no group of copies makes a bucket large; near
copies add their variants only, as any fingerprint does.

Links of a bucket leave it as a forest (a link for each fingerprint at most);
components are found by alternating large-star and small-star rounds on
DataFrames, each written to the shared folder.

Defined results: a null or empty text has no words and fingerprint zero,
linked like any other; fewer words than ``shingle`` make one shingle of the
whole sequence; repeated rows each get their row; a null id never becomes a
component id unless all ids of the component are null; an empty table gives an
empty one; very long texts are hashed whole, in pieces; only id and text are
read, so other columns' names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

SHINGLE = 4
MAX_BITS = 4
#: Fingerprints that one bucket holds, at most about (8 bytes each).
BUCKET_ROWS = 16_000_000
#: Variants that a bucket makes at a time, about (8 bytes each, sorted in memory).
PASS_VARIANTS = 2_000_000
#: Fingerprints of a task that are dealt out together.
BLOCK = 8192
_BITS = 6
_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: a bit is 1 if set in over half the shingles' XXH64 hashes."""
    joined = b" ".join((text or "").encode().lower().split())  # bytes: only A-Z, and only the six blanks
    if not joined:
        return 0
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(joined)]
    if len(starts) <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], _SEED) for a, b in zip(starts, ends[shingle - 1 :])], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 255 * 256):  # in pieces, so that a long text needs little memory
        part = hashes[i : i + 255 * 256]
        rows = np.zeros((-(-len(part) // 255), 255, 64), np.uint8)
        rows.reshape(-1, 64)[: len(part)] = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # at most 255 rows a sum, so byte counters can be added eight at a time
        ones += rows.view(np.uint64).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row; fp as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["id", "fp"])

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return picked.mapInArrow(run, "id long, fp long")


def _masks(radius: int) -> np.ndarray:
    """All words of at most ``radius`` set bits."""
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(64), k)], np.uint64)


def _codes(x: np.ndarray, bits: int) -> np.ndarray:
    """Linear code of each word: xor of one random ``bits``-bit word per set bit."""
    words = np.random.default_rng(64).integers(0, 1 << 62, 64, dtype=np.uint64) & np.uint64((1 << bits) - 1)
    out = np.zeros(len(x), np.uint64)
    for b in range(64):
        out ^= np.where((x >> np.uint64(b)) & np.uint64(1), words[b], np.uint64(0))
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(root, member) for each member of the links' components but the roots."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(names)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    half = len(a)
    for i, j in zip(flat[:half].tolist(), flat[half:].tolist()):
        i, j = root(i), root(j)
        if i != j:
            up[max(i, j)] = min(i, j)
    return [(int(names[root(i)]), int(names[i])) for i in range(len(names)) if root(i) != i]


def _star(z: np.ndarray, owner: np.ndarray, radius: int) -> np.ndarray:
    """Links between the owners of equal variants: the smallest to the others."""
    ranked = np.sort(z)
    shared = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(shared):
        return np.zeros((0, 2), np.uint64)
    at = np.minimum(np.searchsorted(shared, z), len(shared) - 1)
    hit = shared[at] == z
    at, members = at[hit], owner[hit]
    order = np.lexsort((members, at))
    at, members = at[order], members[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    centre = np.repeat(members[first], np.diff(np.r_[first, len(at)]))
    found = np.unique(np.stack([centre, members], axis=1)[centre != members], axis=0)
    return found[np.bitwise_count(found[:, 0] ^ found[:, 1]) <= 2 * radius]


def _bucket_links(fps: np.ndarray, bucket: int, bits: int, radius: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of a bucket that share one of its
    variants.  The bucket's variants are made in passes by further code bits,
    so memory follows the fingerprints and not their variants."""
    masks = _masks(radius)
    further = max(0, int(np.ceil(np.log2(max(1, len(fps) * len(masks) / (1 << bits) / PASS_VARIANTS)))))
    codes, mask_codes = _codes(fps, bits + further), _codes(masks, bits + further)
    order = np.argsort(codes, kind="stable")
    fps, codes = fps[order], codes[order]
    order = np.argsort(mask_codes, kind="stable")
    masks, mask_codes = masks[order], mask_codes[order]
    kinds, first = np.unique(mask_codes, return_index=True)
    groups = np.split(masks, first[1:])
    found = []
    for p in range(1 << further):
        wanted = kinds ^ np.uint64(bucket | p << bits)
        lo, hi = np.searchsorted(codes, wanted), np.searchsorted(codes, wanted + np.uint64(1))
        picked = [(groups[k], fps[lo[k] : hi[k]]) for k in np.flatnonzero(hi > lo)]
        if picked:
            z = np.concatenate([(x[:, None] ^ g[None, :]).ravel() for g, x in picked])
            owner = np.concatenate([np.repeat(x, len(g)) for g, x in picked])
            found.append(_star(z, owner, radius))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    return _forest(pairs[:, 0], pairs[:, 1]) if len(pairs) else []


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` exactly as
    all pairs at most ``max_bits`` (even) apart do."""
    if max_bits % 2:
        raise ValueError("meet in the middle takes an even number of bits")
    radius = max_bits // 2
    n = distinct.count()
    # few code bits send a fingerprint to every bucket; with many, to one bucket for each of its variants
    bits = _BITS if n <= BUCKET_ROWS else int(np.ceil(np.log2(n * len(_masks(radius)) / BUCKET_ROWS)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        deltas = np.unique(_codes(_masks(radius), bits))
        step = max(256, min(BLOCK, 2_000_000 // len(deltas)))
        for batch in batches:
            whole = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for k in range(0, len(whole), step):
                x = whole[k : k + step]
                to = (_codes(x, bits)[:, None] ^ deltas[None, :]).ravel()
                own = np.repeat(x, len(deltas))
                order = np.argsort(to, kind="stable")
                to, own = to[order], own[order]
                first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                ends = np.r_[first[1:], len(to)]
                for i in range(0, len(first), 16):
                    yield pd.DataFrame({
                        "bucket": to[first[i : i + 16]].astype(np.int64),
                        "fps": [own[a:b].tobytes() for a, b in zip(first[i : i + 16], ends[i : i + 16])],
                    })

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        fps = np.concatenate([np.frombuffer(x, np.uint64) for x in group["fps"]])
        found = np.array(_bucket_links(fps, int(key[0]), bits, radius), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    dealt = distinct.select("fp").mapInPandas(deal, "bucket long, fps binary")
    return dealt.groupBy("bucket").applyInPandas(meet, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the links (a, b) with the smallest node of
    its component (as signed numbers).  Alternating stars until nothing moves;
    each round ends in a table in the shared folder."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while True:
        # large star: each larger neighbour of a node goes to the node's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each smaller neighbour of a node, and the node, go to its smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = stored(star.where("u <> v").distinct(), "links")
        same = new.join(e, ["u", "v"], "left_anti").isEmpty() and e.join(new, ["u", "v"], "left_anti").isEmpty()
        e = new
        if same:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The (id, fp) rows, and (fp, low, root, component_id) of each distinct fingerprint."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(links(distinct, max_bits))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows, stored(named.join(least, "root").select("fp", "low", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id that links reach."""
    rows, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    return rows.join(classes.select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each class: that of its smallest id (null after
    all others).  Where that id stands in several rows, those of other classes
    are told apart by their fingerprint, and of the rest one stays."""
    rows, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    best = (
        classes.groupBy("root")
        .agg(F.min(F.struct(F.col("low").isNull().alias("last"), F.col("low"), F.col("fp"))).alias("k"))
        .select(F.col("k.low").alias("__id"), F.col("k.fp").alias("__fp"))
    )
    several = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("__several"))
    marked = best.join(several, best["__id"].eqNullSafe(several["__several"]), "left")
    marked = stored(marked.withColumn("__alone", F.col("__several").isNull() & F.col("__id").isNotNull()).select("__id", "__fp", "__alone"), "kept")
    own = F.col(f"`{id_col}`").cast("long")
    alone = docs.join(marked.where("__alone").select("__id"), own == F.col("__id"), "left_semi")
    shared = marked.where("NOT __alone")

    @F.pandas_udf("long")
    def fp_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    again = docs.join(shared.select("__id").distinct(), own.eqNullSafe(F.col("__id")), "left_semi")
    again = again.withColumn("__of", fp_of(F.col(f"`{text_col}`").cast("string"))).withColumn("__as", own)
    again = again.join(shared, F.col("__as").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__fp")), "left_semi")
    return alone.unionByName(again.dropDuplicates(["__as", "__of"]).select(*(f"`{c}`" for c in docs.columns)))
