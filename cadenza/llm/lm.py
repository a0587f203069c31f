"""Language-model scores from causal self-attention on subword ids.

Words are lower-cased (A-Z) and each is encoded, with a blank before it, by a
public byte-level BPE; a text is the ids of its words and one end.  The model
gives the next id as

    P(class of id | ids before) * P(id | class)

with classes by frequency (the most frequent ids are classes of their own).
The class logits are a table of smoothed log frequencies by the last id's slot
plus the output of one causal attention layer over the ids before, with a bias
by distance.  Texts are scored in windows that overlap: each window carries
``CONTEXT`` ids before the ``STRIDE`` ids that it scores, so each id is scored
once, and windows of many texts go through one batched, masked product.

What it learns from, all of it from training texts (crc32 of the id's text
modulo 7 is not 2): id counts, class counts after each slot and word counts
cover every text; the attention weights take gradient steps over every window,
once, chunk by chunk in the tasks, and are averaged over the tasks by their
windows.

Plan.  One pass packs the texts into chunks of about a million words (ids in
16 bits, compressed), written once.  Word counts have no bounded size, so they
are never broadcast: each chunk sends its distinct words' 64-bit hashes and
counts in one block to each part of the hash space, parts add up and answer
each chunk with its words' counts in the same order, and chunks meet their
answers by a co-grouped join.  A word, however frequent, is one entry a chunk.
Chunks are bounded, so is a part's share, and the tables that go to every task
(slots, classes, weights) have sizes fixed by the parameters.

Defined results: a null text counts as empty (one token, the end); a null id
counts as training; repeated rows are texts of their own; a text longer than a
chunk is a chunk of its own; no training text at all gives the uniform
distribution of ids, and counts of zero; an empty table gives an empty one; only
id and text are read, so other columns' names cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.bpe import encoder, tokenizer_path
from cadenza.llm.common import stored

CHUNK_WORDS = 1_000_000
#: Words of all chunks that one part of the hash space answers for, about.
PART_WORDS = 4_000_000
SLOTS, SLOTS_OWN = 512, 448
CLASSES, CLASSES_OWN = 128, 96
WIDTH = 16
STRIDE, CONTEXT = 32, 16
HELD_OUT = (7, 2)
_IDS = 1 << 16
_END = 50256
_RANDOM = np.random.default_rng(9).integers(0, 1 << 64, _IDS, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15


def held_out(ident) -> bool:
    return ident is not None and zlib.crc32(str(ident).encode()) % HELD_OUT[0] == HELD_OUT[1]


# --- packing -----------------------------------------------------------------

_APART = 2000  # a word of more characters is encoded on its own
_BLANK = re.compile("[^\\S ]")


def subwords(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with a blank before it, and their number a word.

    Many words are encoded as one text: the pattern that splits a text parts
    it before each blank, so a word's ids are what it has alone.  Words with
    blanks of other kinds in them (U+00A0 and the like) are not parted there
    from their neighbours, and are encoded on their own."""
    e = encoder(path)
    texts = [" " + w for w in words]
    ids, sizes = [], np.ones(len(words), np.int64)
    for s in range(0, len(texts), 4096):
        some = texts[s : s + 4096]
        joined = "".join(some)
        if max(map(len, some)) <= _APART and not e.is_new(joined) and not _BLANK.search(joined):
            flat = np.array(e.fast.encode_ordinary(joined), np.uint16)
            sizes[s : s + len(some)] = np.diff(np.r_[np.flatnonzero(_starts(flat, path)), len(flat)])
            ids.append(flat)
        else:
            for k, t in enumerate(some, s):
                ids.append(np.array(e.window(t), np.uint16))
                sizes[k] = len(ids[-1])
    return np.concatenate(ids) if ids else np.zeros(0, np.uint16), sizes


def packed_ids(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts in one array, each closed by the end, and their number per text."""
    lowered = pc.ascii_lower(pa.array(["" if t is None else t for t in texts], pa.large_string()))  # only A-Z
    split = pc.ascii_split_whitespace(lowered)  # only the six blanks; those at a text's ends leave empty words
    parts = split.flatten()
    full = np.asarray(pc.binary_length(parts)) > 0
    counts = np.add.reduceat(np.r_[full, False].astype(np.int64), np.asarray(split.offsets)[:-1]) + 1 if len(texts) else np.zeros(0, np.int64)
    coded = parts.filter(pa.array(full)).dictionary_encode()
    word_ends = np.cumsum(counts)
    order = np.zeros(word_ends[-1] if len(texts) else 0, np.int64)  # zero: the end
    is_word = np.ones(len(order), bool)
    is_word[word_ends - 1] = False
    order[is_word] = np.asarray(coded.indices) + 1
    pieces, sizes = subwords(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), path)
    pieces, sizes = np.r_[np.array([_END], np.uint16), pieces], np.r_[1, sizes]
    starts = np.cumsum(sizes) - sizes
    n = sizes[order]
    ends = np.cumsum(n)
    at = np.repeat(starts[order] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    lengths = np.diff(np.r_[0, ends[word_ends - 1]]) if len(texts) else np.zeros(0, np.int64)
    return pieces[at], lengths


CHUNK = "chunk long, ids array<long>, lengths array<int>, n_words long, packed binary, counts binary"


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """A row per chunk: ids and lengths of its texts, their packed subword ids,
    counts of the ids of its training texts."""
    place = path or tokenizer_path()

    def pack(number: int, rows: list) -> tuple:
        flat, lengths = packed_ids([t for _, t in rows], place)
        training = np.repeat([not held_out(i) for i, _ in rows], lengths)
        counts = np.bincount(flat[training], minlength=_IDS).astype("<u4")
        shrink = zstandard.ZstdCompressor(level=1).compress
        n_words = int(np.count_nonzero(_starts(flat, place)))
        return number, [i for i, _ in rows], lengths.tolist(), n_words, shrink(flat.astype("<u2").tobytes()), shrink(counts.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def done() -> pa.RecordBatch:
            columns = list(zip(pack(task << 32 | k, rows)))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in CHUNK.split(", ")])

        for b in batches:
            for ident, text in zip(b.column(0), b.column(1)):
                rows.append((ident.as_py(), text.as_py()))
                size += len(rows[-1][1] or "") // 6 + 1  # about the words
                if size >= CHUNK_WORDS:
                    yield done()
                    k, rows, size = k + 1, [], 0
        if rows:
            yield done()

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, CHUNK)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u2")


_BEGINS: dict[str, np.ndarray] = {}


def _starts(flat: np.ndarray, path: str) -> np.ndarray:
    """Where a word starts: at ids whose bytes start with a blank, and at the
    end (words hold no blanks, and each was encoded with one before it)."""
    if path not in _BEGINS:
        begins = np.zeros(_IDS, bool)
        for i, t in encoder(path).tokens.items():
            begins[i] = t.startswith(b" ")
        begins[_END] = True
        _BEGINS[path] = begins
    return _BEGINS[path][flat]


def word_hashes(flat: np.ndarray, path: str) -> np.ndarray:
    """A 64-bit hash of each word, from its ids."""
    first = np.flatnonzero(_starts(flat, path))
    if not len(first):
        return np.zeros(0, np.uint64)
    n = np.diff(np.r_[first, len(flat)])
    k = np.arange(len(flat)) - np.repeat(first, n)
    powers = np.ones(int(n.max()), np.uint64)
    with np.errstate(over="ignore"):
        powers[1:] = np.multiply.accumulate(np.full(len(powers) - 1, _STEP, np.uint64))
        h = np.add.reduceat(_RANDOM[flat] * powers[k], first)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


# --- word counts -------------------------------------------------------------


def _distinct(flat: np.ndarray, lengths, ids, path: str, parts: int):
    """Distinct words of a chunk by part, then hash: (hashes, parts, training
    counts, which of them each word is)."""
    h = word_hashes(flat, path)
    word_at = np.flatnonzero(_starts(flat, path))
    training = np.repeat([not held_out(i) for i in ids], lengths)[word_at]
    which, names = pd.factorize(h)
    part = (names % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((names, part))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    counts = np.bincount(which, training, len(names)).astype("<u4")[order]
    return names[order], part[order], counts, rank[which], word_at


def word_counts(packed: DataFrame, parts: int, path: str) -> DataFrame:
    """(chunk, part, counts, n, v): for each chunk and part the counts over all
    training texts of the chunk's distinct words, in hash order; ``n`` and
    ``v`` (tokens, distinct tokens) add up to the corpus totals."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                names, part, counts, _, _ = _distinct(_unpacked(r.packed), r.lengths, [None if i is None or i != i else int(i) for i in r.ids], path, parts)
                first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
                ends = np.r_[first[1:], len(part)].astype(int) if len(part) else []
                yield pd.DataFrame({
                    "chunk": [r.chunk] * len(first), "part": part[first] if len(part) else [],
                    "names": [names[a:b].astype("<u8").tobytes() for a, b in zip(first, ends)],
                    "own": [counts[a:b].tobytes() for a, b in zip(first, ends)],
                })

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [np.frombuffer(x, "<u8") for x in pdf["names"]]
        flat, own = np.concatenate(names), np.concatenate([np.frombuffer(x, "<u4") for x in pdf["own"]])
        distinct, which = np.unique(flat, return_inverse=True)
        total = np.bincount(which, own, len(distinct)).astype("<u8")
        answers = np.split(total[which], np.cumsum([len(x) for x in names])[:-1])
        n, v = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        n[0], v[0] = int(total.sum()), int(np.count_nonzero(total))
        shrink = zstandard.ZstdCompressor(level=1).compress
        return pd.DataFrame({"chunk": pdf["chunk"], "part": pdf["part"], "counts": [shrink(a.tobytes()) for a in answers], "n": n, "v": v})

    sent = packed.select("chunk", "ids", "lengths", "packed").mapInPandas(send, "chunk long, part int, names binary, own binary")
    return sent.groupBy("part").applyInPandas(add, "chunk long, part int, counts binary, n long, v long")


# --- the model ---------------------------------------------------------------

_ONES = np.ones(max(CLASSES, STRIDE + CONTEXT), np.float32)
_FAR = CONTEXT + np.arange(STRIDE)[:, None] - np.arange(STRIDE + CONTEXT)[None, :]
_DISTANCE, _BEFORE = np.abs(_FAR).ravel(), _FAR >= 0
_CELLS = {n: np.arange(SLOTS * n).reshape(SLOTS, n) for n in (WIDTH, 2 * WIDTH)}
_SPACE: dict[tuple, np.ndarray] = {}


def _space(name: str, *shape: int, kind=np.float32) -> np.ndarray:
    """An array of this process, used again by each call: large arrays made
    anew cost as much in fresh pages as the work on them."""
    size = math.prod(shape)
    key = name, np.dtype(kind)
    if key not in _SPACE or _SPACE[key].size < size:
        _SPACE[key] = np.empty(size, kind)
    return _SPACE[key][:size].reshape(shape)


def _rows(name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.take(table, at, axis=0, out=_space(name, *at.shape, table.shape[1], kind=table.dtype), mode="clip")


def _by_slot(slots: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows of each slot."""
    width = rows.shape[2]
    cells = np.take(_CELLS[width], slots.reshape(-1), axis=0, out=_space("cells", slots.size, width, kind=np.int64), mode="clip")
    return np.bincount(cells.reshape(-1), rows.reshape(-1), SLOTS * width).reshape(SLOTS, width)


class Model:
    """Slots, classes and their tables, and the attention weights."""

    def __init__(self, id_counts: np.ndarray, seed: int = 5):
        """``id_counts``: how often each id stands in the training texts."""
        n_ids = _END + 1
        counts = id_counts[:n_ids].astype(np.float64)
        ranked = np.lexsort((np.arange(n_ids), -counts))
        self.slot = (np.arange(_IDS) % (SLOTS - SLOTS_OWN) + SLOTS_OWN).astype(np.int32)
        self.slot[ranked[:SLOTS_OWN]] = np.arange(SLOTS_OWN)
        # the rest in classes of about equal mass, smoothed so that unseen ids have some
        mass = counts + 1.0
        rest = ranked[CLASSES_OWN:]
        group = np.minimum((np.cumsum(mass[rest]) / mass[rest].sum() * (CLASSES - CLASSES_OWN)).astype(int), CLASSES - CLASSES_OWN - 1)
        self.klass = np.zeros(_IDS, np.int32)
        self.klass[ranked[:CLASSES_OWN]] = np.arange(CLASSES_OWN)
        self.klass[rest] = CLASSES_OWN + group
        total = np.bincount(self.klass[:n_ids], mass, CLASSES)
        self.inside = np.zeros(_IDS)
        self.inside[:n_ids] = np.log(mass / total[self.klass[:n_ids]])
        self.after = np.tile(np.log(np.maximum(total, 1e-9) / total.sum()), (SLOTS, 1)).astype(np.float32)
        r = np.random.default_rng(seed)
        self.weights = {
            "q": r.normal(0, 0.3, (SLOTS, WIDTH)).astype(np.float32),
            "k": r.normal(0, 0.3, (SLOTS, WIDTH)).astype(np.float32),
            "v": r.normal(0, 0.3, (SLOTS, WIDTH)).astype(np.float32),
            "o": np.zeros((WIDTH, CLASSES), np.float32),
            "distance": (-0.1 * np.arange(STRIDE + CONTEXT)).astype(np.float32),
        }

    def follow(self, cells: np.ndarray, counts: np.ndarray) -> None:
        """Set the table of class logits by slot from counts of (slot, class)
        cells, smoothed towards the class frequencies."""
        prior = np.exp(self.after[0].astype(np.float64))
        table = np.zeros(SLOTS * CLASSES)
        table[cells] = counts
        table = table.reshape(SLOTS, CLASSES) + 20.0 * prior
        self.after = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)

    def bias(self) -> np.ndarray:
        """Added to the scores of a window: by distance, and minus a large number where a key is not before the query."""
        return np.where(_BEFORE, self.weights["distance"][_DISTANCE].reshape(_FAR.shape), np.float32(-1e9)).astype(np.float32)

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """What all windows of a batch share: scaled queries by slot and the bias."""
        return self.weights["q"] * np.float32(WIDTH**-0.5), self.bias()

    def forward(self, slots: np.ndarray, stable: bool = True, shared: tuple | None = None) -> tuple[np.ndarray, ...]:
        """Class logits of the scored places of windows, slots (n, CONTEXT +
        STRIDE); what it returns holds until the next call.  Not ``stable``:
        without a guard against overflow, which the caller sees as a value that
        is not finite.  The attention comes as it is before the division by its
        sums, with one over these: narrower arrays are divided instead."""
        w, n, asking = self.weights, len(slots), slots[:, CONTEXT:]
        kind = w["o"].dtype
        scaled, bias = shared or self.shared()
        q, k, v = _rows("q", scaled, asking), _rows("k", w["k"], slots), _rows("v", w["v"], slots)
        a = np.matmul(q, k.transpose(0, 2, 1), out=_space("a", n, STRIDE, STRIDE + CONTEXT, kind=kind))
        a += bias
        if stable:
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        over = (1 / (a.reshape(-1, STRIDE + CONTEXT) @ _ONES[: STRIDE + CONTEXT])).reshape(n, STRIDE, 1)
        out = np.matmul(a, v, out=_space("out", n, STRIDE, WIDTH, kind=kind))
        out *= over
        logits = np.matmul(out.reshape(-1, WIDTH), w["o"], out=_space("logits", n * STRIDE, CLASSES, kind=kind)).reshape(n, STRIDE, CLASSES)
        logits += _rows("after", self.after, asking)
        return logits, a, over, out, q, k, v

    def gradients(self, slots: np.ndarray, target: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the places where ``real``."""
        share = (real / np.float32(max(1, real.sum()))).astype(np.float32)
        with np.errstate(all="ignore"):
            g = self._gradients(slots, target, share, False)
        return self._gradients(slots, target, share, True) if g is None else g

    def _gradients(self, slots: np.ndarray, target: np.ndarray, share: np.ndarray, stable: bool) -> dict[str, np.ndarray] | None:
        """Of the sum of cross-entropies weighted by ``share``; None where a
        product without a guard left the range of numbers."""
        logits, a, over, out, q, k, v = self.forward(slots, stable)
        w, g, kind = self.weights, {}, logits.dtype
        p = logits.reshape(-1, CLASSES)
        if stable:
            p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        total = p @ _ONES[:CLASSES]
        if not stable and not ((np.isfinite(total) & (total > 0)).all() and 1e-15 < over.min() and over.max() < 1e15):
            return None
        p.reshape(-1)[np.arange(len(p)) * CLASSES + target.ravel()] -= total
        scale = (share.ravel() / total).reshape(share.shape)[:, :, None]  # of the rows of p, put on the narrow side of the products
        scaled = np.multiply(out, scale, out=_space("scaled", *out.shape, kind=kind))
        g["o"] = np.ascontiguousarray((p.T @ scaled.reshape(-1, WIDTH)).T)  # faster than the transposed product
        d_out = np.matmul(p, w["o"].T, out=_space("d_out", *p.shape[:1], WIDTH, kind=kind)).reshape(out.shape)
        d_out *= scale * over
        d_a = np.matmul(d_out, v.transpose(0, 2, 1), out=_space("d_a", *a.shape, kind=kind))
        d_a -= np.multiply(d_out, out, out=scaled).reshape(-1, WIDTH).dot(_ONES[:WIDTH]).reshape(scale.shape)  # the mean of d_a under a
        d_a *= a
        g["distance"] = np.bincount(_DISTANCE, (d_a.sum(axis=0) * _BEFORE).ravel(), STRIDE + CONTEXT)
        d_k, d_q = _space("d_k", *k.shape, kind=kind), _space("d_q", *q.shape, kind=kind)
        both, asked = _space("both", *slots.shape, 2 * WIDTH, kind=np.float64), _space("asked", *q.shape, kind=np.float64)
        both[:, :, :WIDTH] = np.matmul(d_a.transpose(0, 2, 1), q, out=d_k)
        both[:, :, WIDTH:] = np.matmul(a.transpose(0, 2, 1), d_out, out=d_k)
        asked[:] = np.matmul(d_a, k, out=d_q)
        d_kv = _by_slot(slots, both)
        g["q"] = _by_slot(slots[:, CONTEXT:], asked) * WIDTH**-0.5
        g["k"], g["v"] = d_kv[:, :WIDTH], d_kv[:, WIDTH:]
        return g

    def steps(self, slots: np.ndarray, target: np.ndarray, real: np.ndarray, batch: int = 64, rate: float = 0.05, seen: dict | None = None) -> dict:
        """One pass of adaptive gradient steps over the windows.  Returns the
        sums of squares so far; as ``seen`` they let a later pass go on."""
        seen = seen or {n: np.full_like(x, 1e-6) for n, x in self.weights.items()}
        for s in range(0, len(slots), batch):
            for n, g in self.gradients(slots[s : s + batch], target[s : s + batch], real[s : s + batch]).items():
                g = g.astype(self.weights[n].dtype)
                move = np.multiply(g, g, out=_space("move", *g.shape, kind=g.dtype))
                seen[n] += move
                np.divide(g, np.sqrt(seen[n], out=move), out=move)
                move *= rate
                self.weights[n] -= move
        return seen

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in sorted(self.weights)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in sorted(self.weights):
            x = self.weights[n]
            self.weights[n] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size

    def _picked(self, slots: np.ndarray, target: np.ndarray, stable: bool, shared: tuple) -> np.ndarray:
        """Log probability of the target classes."""
        logits = self.forward(slots, stable, shared)[0]
        if stable:
            logits -= logits.max(axis=2, keepdims=True)
        picked = logits.reshape(-1)[np.arange(target.size) * CLASSES + target.ravel()].reshape(target.shape)
        np.exp(logits, out=logits)
        return picked - np.log(logits.reshape(-1, CLASSES) @ _ONES[:CLASSES]).reshape(target.shape)

    def score(self, flat: np.ndarray, lengths, batch: int = 64) -> np.ndarray:
        """log10 probability of each text."""
        slots, target, real, owner = windows(flat, np.asarray(lengths), self)
        shared, each = self.shared(), np.zeros(len(slots))
        for s in range(0, len(slots), batch):
            with np.errstate(all="ignore"):
                lp = self._picked(slots[s : s + batch], target[s : s + batch], False, shared)
            if not np.isfinite(lp).all():
                lp = self._picked(slots[s : s + batch], target[s : s + batch], True, shared)
            lp *= real[s : s + batch]
            each[s : s + batch] = lp @ _ONES[:STRIDE]
        total = np.bincount(owner, each, len(lengths))
        inside = self.inside[flat]
        if len(lengths):
            first = np.cumsum(lengths) - lengths
            total += np.add.reduceat(inside, first)
        return total / np.log(10.0)


def windows(flat: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """Slots (n, CONTEXT + STRIDE) of the ids before each scored id, classes of
    the scored ids, which of them are real, and the text of each window.  The
    end stands before a text's first id and as often before that as needed."""
    lengths = np.asarray(lengths, np.int64)
    n = -(-lengths // STRIDE)
    owner = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(lengths) - lengths)[owner] + number * STRIDE  # scored id of a window
    left = (lengths[owner] - number * STRIDE)[:, None]  # ids from there to the text's end
    place, before = np.arange(STRIDE)[None, :], np.arange(STRIDE + CONTEXT)[None, :] - CONTEXT - 1
    slots = np.take(model.slot[flat], first[:, None] + before, mode="clip")
    target = np.take(model.klass[flat], first[:, None] + place, mode="clip")
    early = np.flatnonzero(number * STRIDE <= CONTEXT)
    slots[early] = np.where(before >= -number[early, None] * STRIDE, slots[early], model.slot[_END])
    late = np.flatnonzero(left[:, 0] < STRIDE)  # what stands behind a text's last id counts as that id
    last = flat[first[late] + left[late, 0] - 1][:, None]
    slots[late] = np.where(before < left[late], slots[late], model.slot[last])
    target[late] = np.where(place < left[late], target[late], model.klass[last])
    return slots, target, place < left, owner


def _ids_of(row) -> list:
    return [None if i is None or i != i else int(i) for i in row.ids]


def fit(packed: DataFrame) -> Model:
    """The model of the chunks' training texts."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_IDS, np.int64)
        for batch in batches:
            for x in batch["counts"]:
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u4")
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    def added(df: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
        rows = df.groupBy(key).agg(F.sum("n").alias("n")).collect()  # as many as there are ids, or cells, at most
        return np.array([r[key] for r in rows], np.int64), np.array([r["n"] for r in rows], np.float64)

    ids, n = added(packed.select("counts").mapInPandas(tally, "id int, n long"), "id")
    counts = np.zeros(_IDS)
    counts[ids] = n
    model = Model(counts)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS * CLASSES, np.int64)
        for batch in batches:
            for r in batch.itertuples():
                flat = _unpacked(r.packed)
                before = np.r_[model.slot[_END], model.slot[flat[:-1]]]  # the id before a text's first one is an end
                training = np.repeat([not held_out(i) for i in _ids_of(r)], r.lengths)
                total += np.bincount((before * CLASSES + model.klass[flat])[training], minlength=SLOTS * CLASSES)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"cell": seen, "n": total[seen]})

    cells, n = added(packed.select("ids", "lengths", "packed").mapInPandas(pairs, "cell int, n long"), "cell")
    model.follow(cells, n)

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Model.__new__(Model)
        mine.__dict__ = dict(model.__dict__, weights={n: x.copy() for n, x in model.weights.items()})
        size, seen = 0, None
        for batch in batches:
            for r in batch.itertuples():
                flat, lengths = _unpacked(r.packed), np.asarray(r.lengths, np.int64)
                training = np.array([not held_out(i) for i in _ids_of(r)], bool)
                flat, lengths = flat[np.repeat(training, lengths)], lengths[training]
                if len(lengths):
                    slots, target, real, _ = windows(flat, lengths, mine)
                    seen = mine.steps(slots, target, real, seen=seen)
                    size += len(slots)
        if size:
            yield pd.DataFrame({"at": np.arange(mine.flat().size), "x": mine.flat().astype(np.float64) * size, "n": float(size)})

    mean = (
        packed.select("ids", "lengths", "packed")
        .mapInPandas(steps, "at int, x double, n double")
        .groupBy("at")
        .agg((F.sum("x") / F.sum("n")).alias("x"))
        .collect()  # one number per weight
    )
    if mean:
        new = np.zeros(len(mean))
        new[[r["at"] for r in mean]] = [r["x"] for r in mean]
        fresh = Model.__new__(Model)
        fresh.__dict__ = dict(model.__dict__, weights=dict(model.weights))
        fresh.load(new)
        model = fresh
    return model


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Every text's token counts, base score (add-one word frequencies) and
    log10 probability under the model."""
    place = path or tokenizer_path()
    packed = stored(chunks(docs, id_col, text_col, place), "chunks")
    total = packed.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    parts = max(16, -(-total // PART_WORDS))
    counts = stored(word_counts(packed, parts, place), "word-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    model = fit(packed)

    def judge(key: tuple, mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in mine.itertuples():
            ids, lengths, flat = _ids_of(r), np.asarray(r.lengths, np.int64), _unpacked(r.packed)
            _, _, _, which, word_at = _distinct(flat, lengths, ids, place, parts)
            shrunk = answers.sort_values("part")["counts"]
            c = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u8") for x in shrunk])[which].astype(np.float64)
            text_ends = np.cumsum(lengths)
            first = np.searchsorted(word_at, text_ends - lengths)
            n_tokens = np.diff(np.r_[first, len(word_at)])
            base = np.add.reduceat(np.log10((c + 1.0) / (n + (v + 1.0))), first)
            known = np.add.reduceat((c > 0).astype(np.int64), first)
            out.append(pd.DataFrame({
                "doc_id": pd.array(ids, "Int64"), "held_out": [held_out(i) for i in ids], "n_tokens": n_tokens, "n_known": known,
                "train_tokens": n, "base_score": base, "score": model.score(flat, lengths),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in RESULT.split(", ")])

    left = packed.select("chunk", "ids", "lengths", "packed").groupBy("chunk")
    return left.cogroup(counts.select("chunk", "part", "counts").groupBy("chunk")).applyInPandas(judge, RESULT)
