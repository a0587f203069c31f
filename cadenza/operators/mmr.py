"""Maximal-marginal-relevance re-ranking (M16) and the playlist plan.

MMR is sequential per seed, so parallelism comes from many seeds: one
``groupBy(seed).applyInPandas`` call whose groups hold at most N candidate
rows (the W7 output is already capped at N per seed by its definition), so
group memory is bounded by N × d regardless of data size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# --- fixed values (must equal the reference) --------------------------------
TOP_C = 2          # clusters expanded per seed
TOP_N = 200        # candidates kept after cosine ranking
K_FINAL = 50       # playlist length after MMR
LAMBDA_REL = 0.7   # relevance / diversity trade-off
# ---------------------------------------------------------------------------

MMR_SCHEMA = "seed_id long, vec_id long, mmr_rank int, relevance double"


def mmr_select(rel: np.ndarray, mat: np.ndarray, k: int, lam: float) -> list[int]:
    """Greedy MMR over candidates in their given order; returns positions.

    First pick: highest relevance (first on ties).  Then score = λ·rel −
    (1−λ)·max(0, max cosine to the picked); strictly greater wins, so ties
    go to the earlier candidate.
    """
    n = len(rel)
    if n == 0:
        return []
    norms = np.linalg.norm(mat, axis=1)
    picked = [int(np.argmax(rel))]
    max_sim = np.zeros(n)
    taken = np.zeros(n, dtype=bool)
    taken[picked[0]] = True
    while len(picked) < min(k, n):
        last = picked[-1]
        den = norms * norms[last]
        sim = np.where(den == 0, 0.0, (mat @ mat[last]) / np.where(den == 0, 1.0, den))
        max_sim = np.maximum(max_sim, sim)
        score = lam * rel - (1 - lam) * max_sim
        score[taken] = -np.inf
        best = int(np.argmax(score))
        picked.append(best)
        taken[best] = True
    return picked


def mmr_rerank(cands: DataFrame, k: int = K_FINAL, lam: float = LAMBDA_REL) -> DataFrame:
    """M16 — ``cands``: seed_id, vec_id, cosine (relevance), rank (cosine
    order), embedding.  Returns the k MMR picks per seed in pick order."""

    def per_seed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        rel = pdf["cosine"].to_numpy(dtype=np.float64)
        mat = np.stack(pdf["embedding"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 0))
        pos = mmr_select(rel, mat, k, lam)
        return pd.DataFrame({
            "seed_id": pdf["seed_id"].to_numpy()[pos].astype("int64"),
            "vec_id": pdf["vec_id"].to_numpy()[pos].astype("int64"),
            "mmr_rank": np.arange(1, len(pos) + 1, dtype="int32"),
            "relevance": rel[pos],
        })

    return cands.select("seed_id", "vec_id", "cosine", "rank", "embedding") \
        .groupBy("seed_id").applyInPandas(per_seed, MMR_SCHEMA)


def build_playlist(seeds: DataFrame, catalog: DataFrame, metadata: DataFrame | None = None,
                   top_n: int = TOP_N, k: int = K_FINAL, lam: float = LAMBDA_REL) -> DataFrame:
    """M17 — seeds (seed_id, embedding, top_clusters) → cosine top-N inside
    the seeds' top clusters (seed itself excluded) → MMR k → metadata."""
    from cadenza.operators.recommend import cosine_topn
    picks = mmr_rerank(cosine_topn(seeds, catalog, n=top_n, with_embedding=True), k, lam)
    if metadata is not None:
        picks = picks.join(metadata, "vec_id", "left")
    return picks
