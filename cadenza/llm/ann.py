"""Nearest neighbours by a block matrix join.

Queries and candidates are dealt into a grid of tiles: a query goes to one row
of the grid and so to each of its tiles, a candidate to one column.  A tile is
a matrix product of int8 codes: each vector is its scale times whole numbers in
[-127, 127], plus an error whose length is known exactly, so the product gives
a distance with a bound on either side:

    | ||x - y|| - ||x' - y'|| | <= ||x - x'|| + ||y - y'||

A pair survives if its lower bound is not above the k-th smallest upper bound
of its query in the tile; survivors are computed anew from the original
vectors in double precision.  Each tile keeps the k nearest of a query, and
heaps of k merge the tiles' answers as they stream by.

The grid follows the counts, so a tile holds about ``TILE_QUERIES`` times
``TILE_ROWS`` vectors at any size, and the product is worked off in strips.
The result is exact for the stated queries; equal vectors are kept as one in a
tile (with their 2 k smallest ids, of one id at most k, so that k are left
without the query's own), so a hot vector costs one survivor.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, on either side; vectors of another length
than the query's are no candidates of it; a query's own row is no candidate
(rows are told apart by id, so rows of one id never meet each other); fewer
candidates than k give fewer rows; ties go to the smaller id; rows without an
id take no part; repeated rows are rows of their own, as in the SQL: a candidate
stored three times takes three places, and all rows of a query id share its k;
an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

K = 10
TILE_QUERIES = 1024
TILE_ROWS = 16384
_STRIP = 4096
#: Products of int8 codes are whole numbers, exact in float32 up to so many components.
_EXACT = 1024


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part, ``v`` in double precision."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0)
    )


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Scales, codes (int8), squared lengths of the coded vectors, error lengths."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0  # so small that the scale underflows: codes 0, error the whole vector
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    whole = codes.astype(np.float64)
    error = np.sqrt(np.square(x - whole * scale[:, None]).sum(axis=1))
    return scale, codes, scale * scale * np.square(whole).sum(axis=1), error


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes, exactly: float32 sums of at most 1024 terms."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], _EXACT):
        out += a[:, k : k + _EXACT].astype(np.float32) @ b[:, k : k + _EXACT].astype(np.float32).T
    return out


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed component by component."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += np.square(q[j] - x[:, j])
    return np.sqrt(total)


def nearest_in_tile(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """(query id, its k nearest (distance, id) of the tile)."""
    keys = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * 8))).ravel()  # + 0.0: no negative zero
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((ids, group))
    begins = np.flatnonzero(np.r_[True, (np.diff(group[order]) != 0) | (np.diff(ids[order]) != 0)])
    copy = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    order = order[copy < k]
    starts = np.searchsorted(group[order], np.arange(len(first) + 1))
    same = [ids[order[starts[g] : min(starts[g + 1], starts[g] + 2 * k)]].tolist() for g in range(len(first))]
    # vectors of one id alone: no candidates of that id's queries, and so not in their bounds
    smallest = ids[order[starts[:-1]]]
    alone = smallest == ids[order[starts[1:] - 1]]
    x = x[first]
    need = min(k, len(x))
    qs, qc, qn, qe = quantised(q)
    parts = [quantised(x[s : s + _STRIP]) for s in range(0, len(x), _STRIP)]
    for r in range(0, len(q), 64):
        rows = slice(r, r + 64)
        low, bound = [], None
        for s, (xs, xc, xn, xe) in zip(range(0, len(x), _STRIP), parts):
            d2 = qn[rows, None] + xn[None, :] - 2.0 * (qs[rows, None] * xs[None, :]) * products(qc[rows], xc)
            d, slack = np.sqrt(np.maximum(d2, 0.0)), qe[rows, None] + xe[None, :]
            # what rounding may add, far above its true size
            slack += 1e-6 * (np.sqrt(qn[rows])[:, None] + np.sqrt(xn)[None, :]) + 1e-300
            upper = d + slack
            upper[alone[None, s : s + _STRIP] & (smallest[None, s : s + _STRIP] == qids[rows, None])] = np.inf
            bound = np.partition(upper if bound is None else np.concatenate([bound, upper], axis=1), min(need, upper.shape[1] if bound is None else need) - 1, axis=1)[:, :need]
            low.append(d - slack)
        limit = bound.max(axis=1)
        lower = np.concatenate(low, axis=1)
        for i in range(len(lower)):
            near = np.flatnonzero(lower[i] <= limit[i])
            exact = distances(q[r + i], x[near])
            own = int(qids[r + i])
            found = ((d, c) for d, g in zip(exact.tolist(), near.tolist()) for c in same[g] if c != own)
            yield own, heapq.nsmallest(k, found)


def search(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
           tile_queries: int = TILE_QUERIES, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that
    ``queries`` (a condition on ``id``) holds for, among all other rows."""
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    asked = rows.where(queries)
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(queries, 1)).alias("q")).first()
    n_rows, n_cols = max(1, -(-n["q"] // tile_queries)), max(1, -(-n["n"] // tile_rows))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int, side: int) -> DataFrame:
        # xxhash64 of the id: equal rows of one id go together, ids are spread evenly
        return df.select(
            "id", "v", F.lit(side).alias("side"),
            F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
        ).select("row", "col", "side", "id", "v")

    grid = dealt(asked, "row", n_rows, "col", n_cols, 0).unionByName(dealt(rows, "col", n_cols, "row", n_rows, 1))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        widths = pdf["v"].map(len).to_numpy()
        for width in np.unique(widths[pdf["side"].to_numpy() == 0]):
            part = pdf[widths == width]
            q, c = part[part["side"] == 0], part[part["side"] == 1]
            if len(q) and len(c):
                for own, best in nearest_in_tile(q["id"].to_numpy(), np.stack(q["v"].to_numpy()), c["id"].to_numpy(), np.stack(c["v"].to_numpy()), k):
                    out += [(own, i, d) for d, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    near = grid.groupBy("row", "col").applyInPandas(tile, "query_id long, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for b in batches:
            for own, i, d in zip(*(b.column(c).to_pylist() for c in range(3))):
                heap, item = heaps.setdefault(own, []), (-d, -i)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                else:
                    heapq.heappushpop(heap, item)
        out = [(own, rank, -i, -d) for own, heap in heaps.items() for rank, (d, i) in enumerate(sorted(heap, reverse=True), 1)]
        for s in range(0, len(out), 10_000):
            columns = list(zip(*out[s : s + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))], ["query_id", "rank", "vec_id", "score"])

    # a partition merges about 50,000 queries, k (distance, id) each
    parts = max(8, -(-n["q"] // 50_000))
    return near.repartition(parts, "query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")
