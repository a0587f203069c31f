"""Periodic runs of a text's words, by Baier grouping and Lyndon roots.

A run is a maximal stretch of words with smallest period ``q`` and at least
``max(min_length, 2 q)`` words.  Each run contains a Lyndon word of length
``q`` that is the longest Lyndon word at its start under one of the two orders
of the alphabet (the runs theorem), so the runs follow from the two Lyndon
arrays:

1. The first phase of Baier's suffix sorter groups the places by their longest
   Lyndon word; run once per order, it gives both Lyndon arrays directly.
2. A place whose longest Lyndon word has length ``q`` is a candidate root.  The
   longest common extension of the place and the place ``q`` on, to the right
   and to the left, is the stretch with period ``q`` around it.
3. Stretches long enough are runs; each root of a run gives the same one.

Extensions compare prefix hashes by binary search, for all roots at once; every
run is then compared word by word, and hashes of another base are taken if one
does not hold (equal words have equal hashes, so only too long stretches can
come up).

Only parts of a text that can hold runs are grouped: in a run every word lies
in a window of ``min_length // 2`` words that stands again ``q`` words on or
before in the same text.  Words outside all windows found twice (equal hashes,
so at least all of them) are in no run, and a stretch of covered words holds
each of its runs whole.

Plan: one pass over the texts in Arrow tasks, no shuffle.  A text is worked on
as a whole in one task, in memory linear in its words; the number of steps is
linear in its words but for sorting and binary searches.

Defined results: a null, empty or blank text has no words, no runs and an
empty collapsed text; repeated rows are texts of their own; an empty table
gives an empty one; the id may be null; other columns are not read, so their
names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Words of texts that a task works on together, about; a longer text is worked on alone.
BATCH_WORDS = 1 << 18
_PRIME = np.uint64((1 << 31) - 1)


def lyndon_lengths(t: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place of ``t``, the end being
    smaller than all: the first phase of Baier's suffix sorter.

    Groups of places stand in ascending order, at first one per symbol.  From
    the highest group down, each member points to the nearest place before it
    that lies in a lower group; the places pointed to by ``l`` members leave
    their group for a new one right above it, as their Lyndon word goes on with
    ``l`` copies of the member's."""
    n = len(t)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(t):
        by_symbol.setdefault(c, []).append(i)
    members = [by_symbol[c] for c in sorted(by_symbol)]
    size = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    group = [0] * n
    for g, places in enumerate(members):
        for i in places:
            group[i] = g
    done = [False] * (n + 1)  # the last one answers for place -1
    jump = list(range(-1, n - 1))
    out = [0] * n
    at = len(members) - 1
    while at >= 0:
        length = size[at]
        mine = [s for s in members[at] if group[s] == at]
        for s in mine:
            done[s] = True
            out[s] = length
        pointed: dict[int, int] = {}
        for s in mine:
            j = jump[s]
            while done[j]:
                j = jump[j]
            k = s
            while k != j:  # later walks go straight there
                jump[k], k = j, jump[k]
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, many in pointed.items():
            moved.setdefault((many, group[j]), []).append(j)
        for many, old in sorted(moved, reverse=True):  # more copies first: fewer then go in below them
            new, up = len(members), above[old]
            members.append(moved[many, old])
            size.append(size[old] + many * length)
            below.append(old)
            above.append(up)
            above[old] = below[up] = new
            for j in moved[many, old]:
                group[j] = new
        at = below[at]
    return out


def _extend(hashes: np.ndarray, powers: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
    """How far the words from places ``i`` and ``j`` (``i < j``) on agree, at
    most ``limit``; ``back``: the words that end before them."""
    lo, hi = np.zeros_like(i), limit.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_] + 1) // 2
        a, b = (i[open_] - mid, j[open_] - mid) if back else (i[open_], j[open_])
        left = (hashes[a + mid] + _PRIME - hashes[a]) % _PRIME * powers[b - a] % _PRIME
        same = left == (hashes[b + mid] + _PRIME - hashes[b]) % _PRIME
        lo[open_] = np.where(same, mid, lo[open_])
        hi[open_] = np.where(same, hi[open_], mid - 1)


def _prefix_hashes(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes of ``x`` (sums of word times power) and the powers."""
    r = np.random.default_rng(seed)
    base = r.integers(1 << 20, int(_PRIME), dtype=np.uint64)
    powers = np.ones(len(x) + 1, np.uint64)
    n = 1
    while n < len(powers):  # powers n .. 2n are the first n times base^n
        step = powers[n - 1] * base % _PRIME
        powers[n : 2 * n] = powers[: min(n, len(powers) - n)] * step % _PRIME
        n *= 2
    words = (x.astype(np.uint64) + np.uint64(1)) * r.integers(1 << 20, int(_PRIME), dtype=np.uint64) % _PRIME
    return np.r_[np.uint64(0), np.cumsum(words * powers[:-1] % _PRIME) % _PRIME], powers


def stretch_runs(x: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs of the stretches of words
    ``x[bounds[k]:bounds[k + 1]]``, by start, then period."""
    first = np.repeat(bounds[:-1], np.diff(bounds))
    last = np.repeat(bounds[1:], np.diff(bounds))
    roots = [np.zeros((0, 2), np.int64)]
    for down in (False, True):
        lengths = np.concatenate([lyndon_lengths((-x[a:b] if down else x[a:b]).tolist()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
        i = np.arange(len(x))
        j = i + lengths
        # the first root of a run is followed by at least one more word of the period
        held = np.flatnonzero((j < last) & (x[np.minimum(j, len(x) - 1)] == x))
        roots.append(np.stack([held, lengths[held]], axis=1))
    roots = np.unique(np.concatenate(roots), axis=0)
    i, q = roots[:, 0], roots[:, 1]
    for seed in range(64):
        hashes, powers = _prefix_hashes(x, seed)
        right = _extend(hashes, powers, i, i + q, last[i] - i - q, False)
        left = _extend(hashes, powers, i, i + q, i - first[i], True)
        n = left + q + right
        enough = n >= np.maximum(min_length, 2 * q)
        found = np.unique(np.stack([i - left, n, q], axis=1)[enough], axis=0)
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        if all(np.array_equal(x[s : s + m - p], x[s + p : s + m]) for s, m, p in found.tolist()):
            return found
    raise ArithmeticError("prefix hashes of 64 bases gave unequal words as equal")


def text_runs(words: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each text, given its words."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for ws in words for w in ws]
    x = pd.factorize(flat)[0].astype(np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    width = max(1, min_length // 2)
    n = max(0, len(x) - width + 1)
    none = [np.zeros((0, 3), np.int64) for _ in words]
    if not n:
        return none
    whole = np.flatnonzero(owner[:n] == owner[width - 1 :])
    with np.errstate(over="ignore"):
        h = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(width):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + x[k : n + k].astype(np.uint64)
    twice = whole[pd.Series(h[whole]).duplicated(keep=False).to_numpy()]
    if not len(twice):
        return none
    steps = np.zeros(len(x) + 1, np.int64)
    steps[twice] += 1
    steps[twice + width] -= 1
    covered = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    parts = np.flatnonzero(np.r_[True, (np.diff(covered) > 1) | (np.diff(owner[covered]) > 0)])
    length = np.diff(np.r_[parts, len(covered)])
    kept = length >= min_length
    if not kept.any():
        return none
    covered = covered[np.repeat(kept, length)]
    bounds = np.r_[0, np.cumsum(length[kept])]
    found = stretch_runs(x[covered], bounds, min_length)
    place = covered[found[:, 0]]
    text = owner[place]
    rows = np.stack([place - (np.cumsum(sizes) - sizes)[text], found[:, 1], found[:, 2]], axis=1)
    return np.split(rows, np.searchsorted(text, np.arange(1, len(words))))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()])


RESULT = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    altered: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """A row per text: its id, number of words, runs by start and period, and
    the text with each run cut to one period, words joined by a blank.
    ``altered(id, words)`` may give other words to search in a text's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0

        def done() -> pa.RecordBatch:
            runs = text_runs(words, min_length)
            table = np.concatenate(runs)
            rows = pa.StructArray.from_arrays([pa.array(c) for c in table.T.copy()], fields=list(_RUN))
            offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in runs])], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(offsets, rows),
                    pa.array([collapsed(w, r).decode() for w, r in zip(words, runs)], pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

        for b in batches:
            for ident, text in zip(b.column(0).to_pylist(), b.column(1)):
                ws = (text.as_py() or "").encode().split()  # bytes: parted at the six blanks only
                ids.append(ident)
                words.append(altered(ident, ws) if altered else ws)
                size += len(ws)
                if size >= BATCH_WORDS:
                    yield done()
                    ids, words, size = [], [], 0
        if ids:
            yield done()

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return picked.mapInArrow(run, RESULT)
