"""Toxicity of texts by a subsequence string kernel and a linear SVM on
Nyström landmarks.

Units of a text are its words, lower-cased (A-Z), and besides them runs of
three or more one-letter words joined to one (an insult spelled out).  The
kernel of two units compares their subsequences of three letters (or marks of
the unit's first and last letter) within ``WINDOW`` code points; a subsequence counts
``DECAY`` for each code point between its letters, letters or not, so
letters put in or left out and signs between letters weaken a match and do not
undo it.  It is normalised to 1 for equal units.

Landmarks are units of the labelled sample: those by which toxic and clean
texts differ most, and the most frequent ones of clean texts.  The kernel with
the landmarks, times the inverse root of the landmarks' own kernel matrix, are
a unit's coordinates (Nyström); a linear SVM with squared hinge loss parts them.

Labels are on texts, so a text's sentences are bags: of a clean text no unit is
an insult; of a toxic text one unit at least is, the witness, first the one
that most marks toxic texts and then, in rounds, the one of greatest margin;
units that stand in toxic texts far more often than chance has it (``SIGNS``
standard deviations) are witnesses in all of them.  Witnesses also train in
forms with a sign between their letters, a letter doubled and a letter put in.
Clean units with margins that are too large join the training set in each
round.  A sentence's margin is that of its greatest unit, a text's that of its
greatest sentence, at least -1; a logistic curve fitted on a fifth of the
sample that is kept back, weighted to the labels' frequencies, makes it a score.

The SVM's margin is linear in a unit's subsequences, so weights and landmarks
fold into one table of subsequences, which goes to the tasks (1 MB, fixed
size).  Scoring is one pass over the texts in Arrow tasks without a shuffle;
margins of units are kept in a worker while they fit.

Bounds of the fit: at most about ``SAMPLE`` labelled texts of each label, by a
hash of the id, of ``SAMPLE_CHARS`` code points at most.  Scoring has none.

Defined results: a null, empty or blank text has the score of margin -1; a
text with repeated rows is scored in each; rows without a label, with a null
label or of held-out ids never train, nor do null ids; an id labelled twice
is toxic if one label is; without training texts of both labels every score
is 0; an empty table gives an empty one; only id and text are read, so other
columns' names cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

SAMPLE = 2500
SAMPLE_CHARS = 20_000
LANDMARKS = 256
WINDOW = 8
DECAY = 0.6
ROUNDS = 3
SIGNS = 5.0
#: Texts of each label that the logistic curve needs to be fitted on texts kept back.
KEPT_BACK = 40
THRESHOLD = 0.7
HELD_OUT = (3, 1)
#: Clean units of a training round: so many by frequency, and so many more by margin each round.
FREQUENT, HARD = 12_000, 4_000
#: Margins that a worker keeps; words that it works on together.
_KEPT, _WORDS = 1_000_000, 1 << 18
#: Symbols; the last two stand before the first and after the last letter of a unit.
_LETTERS, _BEGIN, _END = 64, 62, 63
_SPELLED = re.compile(rb"[\x01\x02]{3,}")


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))


# --- units and kernel --------------------------------------------------------


def _one_letter(word: bytes) -> bool:
    return len(word) == 1 or (len(word) == 2 and word[0] > 0xBF)


def units(text: str | None) -> set[bytes]:
    """Distinct units of a text."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, and only the six blanks
    found = set(words)
    for m in _SPELLED.finditer(bytes([len(w) if len(w) < 3 else 3 for w in words])):
        run: list[bytes] = []
        for w in [*words[m.start() : m.end()], b"  "]:
            if _one_letter(w):
                run.append(w)
            else:
                if len(run) > 2:
                    found.add(b"".join(run))
                run = []
    return found


_SYMBOLS: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """Symbol of each code point: a to z have their own, other letters share the rest, all others have -1."""
    if not _SYMBOLS:
        table = np.full(0x110000, -1, np.int64)
        for c in range(0x110000):
            if chr(c).isalpha():
                table[c] = 26 + c * 7 % (_BEGIN - 26)
        table[97:123] = np.arange(26)
        _SYMBOLS.append(table)
    return _SYMBOLS[0]


def subsequences(strings: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(string, subsequence, weight) of all three letters within the window, in several parts."""
    decoded = [f" {s.decode()} " for s in strings]  # room for the marks of both ends
    sizes = np.array([len(s) for s in decoded], np.int64)
    symbol = _symbols()[np.frombuffer("".join(decoded).encode("utf-32-le"), np.uint32)]
    owner = np.repeat(np.arange(len(strings)), sizes)
    place = np.flatnonzero(symbol >= 0)
    first = np.flatnonzero(np.diff(owner[place], prepend=-1))
    last = np.r_[first[1:], len(place)] - 1 if len(place) else first
    symbol[place[first] - 1], symbol[place[last] + 1] = _BEGIN, _END
    place = np.flatnonzero(symbol >= 0)
    owner, symbol = owner[place], symbol[place]
    decay = DECAY ** np.arange(WINDOW)
    for a in range(1, WINDOW - 1):
        for b in range(1, WINDOW - a):
            n = len(place) - a - b
            if n <= 0:
                continue
            far = place[a + b :] - place[:n]
            at = np.flatnonzero((far < WINDOW) & (owner[a + b :] == owner[:n]))
            yield owner[at], (symbol[at] * _LETTERS + symbol[at + a]) * _LETTERS + symbol[at + a + b], decay[far[at] - 2]


_CODES = _LETTERS**3


def features(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, subsequence, weight) with equal subsequences added up and each string's weights normalised."""
    parts = [*zip(*subsequences(strings))] or [[np.zeros(0, np.int64)]] * 2 + [[np.zeros(0)]]
    owner, code, weight = (np.concatenate(p) for p in parts)
    key, which = np.unique(owner * _CODES + code, return_inverse=True)
    total = np.bincount(which, weight, len(key))
    owner = key // _CODES
    norm = np.sqrt(np.bincount(owner, total * total, len(strings)))
    return owner, key % _CODES, total / norm[owner] if len(key) else total


class Table:
    """Weights of the subsequences and an offset: the margin of any unit."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights, offset

    def margins(self, strings: list[bytes]) -> np.ndarray:
        """At least -1.  The norm, for which equal subsequences have to be
        found, is worked out only where the sum of the squares, a lower bound,
        leaves a greater margin possible."""
        out = np.full(len(strings), -1.0)
        for s in range(0, len(strings), 8192):
            some = strings[s : s + 8192]
            total, squares = np.zeros(len(some)), np.zeros(len(some))
            for owner, code, weight in subsequences(some):
                total += np.bincount(owner, weight * self.weights[code], len(some))
                squares += np.bincount(owner, weight * weight, len(some))
            # a unit without subsequences has no direction: the least margin
            able = np.flatnonzero((squares > 0) & (np.maximum(total, 0) / np.sqrt(np.maximum(squares, 1e-300)) + self.offset > -1))
            if len(able):
                owner, code, weight = features([some[i] for i in able.tolist()])
                exact = np.bincount(owner, weight * self.weights[code], len(able)) + self.offset
                out[s + able] = np.maximum(exact, -1.0)
        return out


# --- training ----------------------------------------------------------------


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4) -> np.ndarray:
    """Weights and, last, offset of the least squared hinge loss, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-8

    def loss(w: np.ndarray) -> float:
        return float((ridge * w * w).sum() / 2 + (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum() / 2)

    now = loss(w)
    for _ in range(50):
        short = 1 - y * (x @ w)
        on = short > 0
        gradient = ridge * w - x[on].T @ (weight[on] * y[on] * short[on])
        step = np.linalg.solve(x[on].T @ (x[on] * weight[on, None]) + np.diag(ridge), gradient)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-4:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(1.0, before):
            break
    return w


def variants(unit: bytes) -> list[bytes]:
    """Forms of a unit as they are written to pass a word list."""
    s = unit.decode()
    inner = range(1, len(s))
    forms = {"-".join(s), ".".join(s), *(s[:i] + "*" + s[i:] for i in inner), *(s[:i] + s[i - 1] + s[i:] for i in inner), *(s[:i] + "x" + s[i:] for i in inner)}
    return [f.encode() for f in sorted(forms - {s})]


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance of label 1, with targets drawn in a little from 0 and 1."""
    ones, zeros = float((weight * y).sum()), float((weight * (1 - y)).sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.c_[margin, np.ones(len(margin))]
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - target)) + 1e-6 * w
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


class Model:
    def __init__(self, table: Table, slope: float, offset: float):
        self.table, self.slope, self.offset = table, slope, offset

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -700, 700)))


def train(bags: list[set[bytes]], toxic: np.ndarray, prior: tuple[float, float], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model:
    """The model of labelled texts, given as their units; ``prior``: how many
    texts of label 0 and of label 1 a text of the sample stands for.  Every
    fifth text is kept back for the logistic curve, if that gives enough."""
    back = np.arange(len(bags)) % 5 == 4
    if min(int((toxic[back] == t).sum()) for t in (0, 1)) < KEPT_BACK:
        back = use = np.ones(len(bags), bool)  # too few for a curve: all texts serve both ends
    else:
        use = ~back
    apart, apart_toxic = [b for b, k in zip(bags, back) if k], toxic[back]
    bags, toxic = [b for b, k in zip(bags, use) if k], toxic[use]
    seen = [Counter(), Counter()]
    for b, t in zip(bags, toxic.tolist()):
        seen[t].update(b)
    texts = [max(1, int((toxic == t).sum())) for t in (0, 1)]
    share = {u: float(np.log((seen[1][u] + 1) / (texts[1] + 2) * (texts[0] + 2) / (seen[0][u] + 1))) for u in seen[0].keys() | seen[1].keys()}
    marking = sorted(seen[1], key=lambda u: (-share[u], u))
    common = sorted(seen[0], key=lambda u: (-seen[0][u], u))

    def some(ranked: list[bytes], n: int) -> list[bytes]:
        out = []
        for s in range(0, len(ranked), 4 * n):  # only units with a subsequence
            part = ranked[s : s + 4 * n]
            out += [part[i] for i in np.unique(features(part)[0]).tolist()]
            if len(out) >= n:
                break
        return out[:n]

    chosen = some(marking, landmarks // 2)
    chosen += [u for u in some(common, landmarks) if u not in set(chosen)][: landmarks - len(chosen)]
    owner, code, weight = features(chosen)
    columns, column = np.unique(code, return_inverse=True)
    own = np.zeros((len(chosen), len(columns)))
    own[owner, column] = weight
    values, vectors = np.linalg.eigh(own @ own.T)
    kept = values > 1e-6
    root = vectors[:, kept] / np.sqrt(values[kept])

    def coordinates(strings: list[bytes]) -> np.ndarray:
        out = np.zeros((len(strings), len(chosen)))
        for s in range(0, len(strings), 2048):
            owner, code, weight = features(strings[s : s + 2048])
            at = np.minimum(np.searchsorted(columns, code), len(columns) - 1)
            hit = columns[at] == code
            owner, at, weight = owner[hit], at[hit], weight[hit]
            if len(owner):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                for k in range(0, len(first), 256):
                    a, b = first[k], first[k + 256] if k + 256 < len(first) else len(owner)
                    out[s + owner[first[k : k + 256]]] = np.add.reduceat(own[:, at[a:b]] * weight[a:b], first[k : k + 256] - a, axis=1).T
        return out @ root

    names = marking + [u for u in common if u not in seen[1]]
    place = {u: i for i, u in enumerate(names)}
    inside = [np.array(sorted(place[u] for u in b), np.int64) for b in bags]
    clean = np.array([place[u] for u in common], np.int64)
    even = texts[1] / texts[0]  # as many clean texts as there are toxic ones
    sure = Counter({u: n for u, n in seen[1].items() if n - even * seen[0][u] > SIGNS * (n + even * even * seen[0][u]) ** 0.5})
    margin = np.array([share[u] for u in names])
    often = np.sqrt([seen[0][u] for u in names])
    training = clean[:FREQUENT]
    cached = coordinates([names[i] for i in training.tolist()])
    table = Table(np.zeros(_CODES), -1.0)
    for _ in range(rounds):
        witness = Counter(names[b[np.argmax(margin[b])]] for b, t in zip(inside, toxic.tolist()) if t and len(b)) | sure
        positive, amount = [], []
        for u, n in sorted(witness.items()):
            forms = [u, *variants(u)] if len(u) <= 64 else [u]
            positive += forms
            amount += [n**0.5] + [n**0.5 / len(forms)] * (len(forms) - 1)
        x = np.r_[coordinates(positive), cached]
        y = np.r_[np.ones(len(positive)), -np.ones(len(training))]
        part = np.r_[np.array(amount) / max(1e-9, sum(amount)), often[training] / max(1e-9, often[training].sum())]
        w = svm(x, y, part * 0.5)
        weights = np.zeros(_CODES)
        weights[columns] = (root @ w[:-1]) @ own
        table = Table(weights, float(w[-1]))
        margin = table.margins(names)
        further = np.setdiff1d(clean, training)
        further = further[np.argsort(-margin[further], kind="stable")][:HARD]
        further = further[margin[further] > -1]
        cached = np.r_[cached, coordinates([names[i] for i in further.tolist()])]
        training = np.r_[training, further]
    known = sorted(set().union(*apart))
    margins = dict(zip(known, table.margins(known).tolist()))
    tops = np.array([max((margins[u] for u in b), default=-1.0) for b in apart])
    slope, offset = logistic(tops, apart_toxic, np.where(apart_toxic == 1, prior[1], prior[0]))
    return Model(table, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model | None:
    """The model of a bounded sample of the labelled texts that are not held
    out; none without texts of both labels."""
    ident = F.col(f"`{id_col}`").cast("long")
    marked = labels.select(ident.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    # all, or by a hash of the id a tenth fewer than the bound, so that chance does not pass it
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    share = {t: 1.0 if n <= sample else 0.9 * sample / n for t, n in counts.items()}
    ids = stored(marked.where(part < F.when(F.col("label") == 1, share[1]).otherwise(share[0])), "toxic-sample")
    texts = docs.select(ident.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where(F.char_length("text") <= SAMPLE_CHARS)
    # a broadcast of at most about 2 * sample ids; repeated rows of an id train once
    rows = texts.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text")).orderBy("id").collect()
    toxic = np.array([r["label"] for r in rows], np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    prior = tuple(counts[t] / max(1, int((toxic == t).sum())) for t in (0, 1))
    return train([units(r["text"]) for r in rows], toxic, prior)


RESULT = "id long, margin double, unit string, score double, predicted int"


def detect(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per text: its margin, the unit that has it (null at -1), score and prediction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, float] = {}

        def done(ids: list, bags: list[set[bytes]]) -> pa.RecordBatch:
            nonlocal kept
            margins, tops = np.full(len(ids), -1.0), [None] * len(ids)
            if model:
                new = sorted(set().union(*bags).difference(kept))
                if len(kept) + len(new) > _KEPT:
                    kept = {}
                    new = sorted(set().union(*bags))
                kept.update(zip(new, model.table.margins(new).tolist()))
                for k, b in enumerate(bags):
                    top = max((kept[u] for u in b), default=-1.0)
                    if top > -1.0:
                        margins[k], tops[k] = top, min(u for u in b if kept[u] == top).decode()
            score = model.score(margins) if model else np.zeros(len(ids))
            columns = [pa.array(ids, pa.int64()), pa.array(margins), pa.array(tops, pa.string()), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

        ids, bags, size = [], [], 0
        for b in batches:
            for ident, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(ident)
                bags.append(units(text.as_py()) if model else set())
                size += len(bags[-1]) + 1
                if size >= _WORDS:
                    yield done(ids, bags)
                    ids, bags, size = [], [], 0
        if ids:
            yield done(ids, bags)

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, RESULT)
