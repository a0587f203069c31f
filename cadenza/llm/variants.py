"""Spelling variants of a vocabulary by FM-index search schemes.

Words of at least ``min_chars`` code points and ``min_count`` occurrences are
near if they differ by exactly one inserted, deleted or replaced code point.
The one error lies in one half of a word, so the other half stands in its near
words as it is: the search scheme matches the left half exactly and extends to
the right allowing one error, and matches the right half exactly and extends to
the left allowing one error.  A step of either is an interval of suffix ranks
in an FM-index over the delimited vocabulary; the interval closed by the
delimiter at both ends is a word.

The vocabulary is dealt out by the exact half: a word is sent, as text, once
for each length that a word near it may have and each direction, and once of
these it also asks.  All words that share the half with the asking word meet in
one part, whose words are indexed in the direction of the extension (the right
half's words are turned round, so that both directions extend to the right).
Each error place belongs to one half, and of equivalent places (one letter of
several equal ones) only the last counts, so each near word of a word is found
once and no pairs are shuffled: a part answers with the number of near words
and the best one.

A half that very many words share would make a part large.  Its error range is
then halved again: with the error in the second part of the range the exact
part grows at the front, with the error in the first one it grows at the back.
This goes on until the words that share a key are few or the range is one code
point, which bounds them by the alphabet; nothing is left out.

A word's form is its near word of largest count (ties: the smallest in
code-point order) if that count is at least ``factor`` times its own.  Forms
are followed to the last by pointer doubling; counts grow along them, so they
end.

Defined results: null and empty texts have no words; a null id is an id of its
own for ``altered``; repeated rows are counted each; an empty table gives an
empty one; very long words are words like others; only the id and the text are
read, so other columns' names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_CHARS = 7
MIN_COUNT = 2
FACTOR = 10
#: Rows (texts and questions) that one part holds, about.
PART_ROWS = 150_000
#: Rows of a key's bucket from which on its keys are refined.
HOT_ROWS = 50_000
_BUCKETS = 1 << 20
#: Questions that a part answers at a time.
_BLOCK = 16384
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    altered: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased.  ``altered(id,
    run)`` may give another word in a run's place, not longer than it."""
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if altered:
        found = found.select(altered(F.col("id"), F.col("word")).alias("word")).where(F.char_length("word") >= min_chars)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# --- index and search --------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``, symbols >= 0, the last one unique and smallest."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= bits
        key[: max(0, n - k)] |= text[k:]
    while True:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        steps = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
        if steps[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = steps + 1
        key = rank * (n + 1)
        key[: max(0, n - width)] += rank[width:]
        width *= 2


class Index:
    """FM-index over words, each between delimiters.  The text holds the words
    turned round, so a step of the backward search appends to a pattern."""

    END, DELIMITER = 0, 1

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\x01" + "\x01".join(w[::-1] for w in words) + "\x01").encode("utf-32-le"), np.uint32)
        self.points, codes = np.unique(points, return_inverse=True)
        text = np.r_[codes + 1, self.END].astype(np.int64)
        self.symbols = len(self.points) + 1
        self.suffixes = suffix_array(text)
        self.before = text[self.suffixes - 1]
        self.rows = len(text)
        # by symbol, then rank: the place of (symbol, rank) is where the backward step leads
        order = np.argsort(self.before, kind="stable")
        self.places = self.before[order] * (self.rows + 1) + order
        self.word_at = np.cumsum(text == self.DELIMITER) - 1

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words one after the other (all known), and where each begins."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, words)])
        return np.searchsorted(self.points, points) + 1, starts[:-1]

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` appended."""
        at = symbol * (self.rows + 1)
        return np.searchsorted(self.places, at + lo), np.searchsorted(self.places, at + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, symbol, lo, hi) of all letters that follow the intervals' patterns."""
        size = hi - lo
        few = np.flatnonzero(size <= 2 * self.symbols)
        many = np.flatnonzero(size > 2 * self.symbols)
        n = size[few]
        rank = np.repeat(lo[few] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs = np.unique(np.repeat(few, n) * self.symbols + self.before[rank])
        which = np.r_[pairs // self.symbols, np.repeat(many, self.symbols)]
        symbol = np.r_[pairs % self.symbols, np.tile(np.arange(self.symbols), len(many))]
        keep = symbol > self.DELIMITER
        which, symbol = which[keep], symbol[keep]
        a, b = self.step(symbol, lo[which], hi[which])
        keep = a < b
        return which[keep], symbol[keep], a[keep], b[keep]


def one_error(index: Index, words: list[str], start: np.ndarray, end: np.ndarray, turned: bool) -> tuple[np.ndarray, np.ndarray]:
    """(question, word) for all indexed words that differ from the question's
    word (indexed itself) by one error at a place from ``start`` to ``end``,
    not included; at its end too if ``end`` is the word's length.  The word
    before ``start`` is matched exactly, then extended.  ``turned``: the words
    are turned round, so of equivalent places the first one counts."""
    w, at = index.codes(words)
    length = np.array([len(x) for x in words], np.int64)
    w = np.r_[w, -1]  # no symbol: what stands after the last word

    def symbol(q: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.where((j >= 0) & (j < length[q]), w[at[q] + np.clip(j, -1, length[q])], -1)

    q = np.arange(len(words))
    lo, hi = index.step(np.full(len(q), index.DELIMITER), np.zeros(len(q), np.int64), np.full(len(q), index.rows))
    lo, hi = np.asarray(lo), np.asarray(hi)
    for j in range(int(start.max(initial=0))):
        on = np.flatnonzero(start[q] > j)
        lo[on], hi[on] = index.step(symbol(q[on], np.full(len(on), j)), lo[on], hi[on])
        alone = hi - lo <= 1  # the word itself and no other
        if alone.any():
            q, lo, hi = q[~alone], lo[~alone], hi[~alone]
    j = start[q].copy()
    wrong = []
    while len(q):
        inside = j < end[q]
        here = symbol(q, j)
        # one letter left out
        last = symbol(q, j - 1 if turned else j + 1) != here
        d = np.flatnonzero(inside & last)
        wrong.append((q[d], j[d] + 1, lo[d], hi[d]))
        s, c, a, b = index.branches(lo, hi)
        # one letter replaced
        r = inside[s] & (c != here[s])
        wrong.append((q[s[r]], j[s[r]] + 1, a[r], b[r]))
        # one letter put in before place j
        if turned:
            r = (j[s] > start[q[s]]) & (c != symbol(q, j - 1)[s])
        else:
            r = np.where(inside, True, j == length[q])[s] & (c != here[s])
        wrong.append((q[s[r]], j[s[r]], a[r], b[r]))
        # no error yet
        q, j, here, lo, hi = q[inside], j[inside], here[inside], lo[inside], hi[inside]
        lo, hi = index.step(here, lo, hi)
        more = hi - lo > 1
        q, j, lo, hi = q[more], j[more] + 1, lo[more], hi[more]
    q, j, lo, hi = (np.concatenate(x) for x in zip(*wrong)) if wrong else (np.zeros(0, np.int64),) * 4
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while len(q):
        closing = j == length[q]
        lo, hi = index.step(np.where(closing, index.DELIMITER, symbol(q, j)), lo, hi)
        some = lo < hi
        found.append((q[some & closing], index.word_at[index.suffixes[lo[some & closing]]]))
        on = some & ~closing
        q, j, lo, hi = q[on], j[on] + 1, lo[on], hi[on]
    return tuple(np.concatenate(x) for x in zip(*found))


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a part's rows (side, text, n, asks, start, end): a row per question
    with near words, their number and the best of them."""
    turned = bool(rows["side"].iloc[0])
    which, words = pd.factorize(rows["text"])
    words = words.tolist()
    n = np.zeros(len(words), np.int64)
    n[which] = rows["n"]
    asks = rows["asks"].to_numpy()
    asked, near, best_n, best = [], [], [], []
    if len(words) > 1 and asks.any():
        index = Index(words)
        own, start, end = which[asks], rows["start"].to_numpy(np.int64)[asks], rows["end"].to_numpy(np.int64)[asks]
        plain = [w[::-1] for w in words] if turned else words
        place = np.empty(len(words), np.int64)
        place[sorted(range(len(words)), key=plain.__getitem__)] = np.arange(len(words))
        for s in range(0, len(own), _BLOCK):
            o = own[s : s + _BLOCK]
            q, v = one_error(index, [words[i] for i in o.tolist()], start[s : s + _BLOCK], end[s : s + _BLOCK], turned)
            if len(q):
                order = np.lexsort((place[v], -n[v], q))
                q, v = q[order], v[order]
                first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
                asked += [plain[i] for i in o[q[first]].tolist()]
                near += np.diff(np.r_[first, len(q)]).tolist()
                best_n += n[v[first]].tolist()
                best += [plain[i] for i in v[first].tolist()]
    return pd.DataFrame({"word": pd.Series(asked, dtype=object), "n_near": near, "best_n": best_n, "best": pd.Series(best, dtype=object)})


# --- dealing out -------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """With the bucket of the key: what a text shares with the asking word."""
    before, after = F.expr("substring(text, 1, start)"), F.expr("right(text, length - end)")
    return rows.withColumn("bucket", F.pmod(F.xxhash64("side", "length", "start", "end", before, after), F.lit(_BUCKETS)))


def _dealt(vocab: DataFrame, min_chars: int, hot_rows: int) -> DataFrame:
    """A row per word, direction and length of the asking word, keyed so that
    few rows share a key."""
    own = F.char_length("word")

    def ways(delta: int) -> list[Column]:
        length = own + delta
        half = F.floor(length / 2).cast("int")
        return [
            F.struct(F.lit(side).alias("side"), length.alias("length"), (half if side == 0 else length - half).alias("start"), length.alias("end"), F.lit(delta == 0).alias("asks"))
            for side in (0, 1)
        ]

    rows = vocab.select("word", "n", F.explode(F.array(*ways(-1), *ways(0), *ways(1))).alias("way")).select("word", "n", "way.*")
    rows = rows.where(F.col("length") >= min_chars).withColumn("text", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))).drop("word")
    rows, settled = _keyed(rows), None
    while True:
        hot = rows.where(F.col("end") - F.col("start") > 1).groupBy("bucket").count().where(F.col("count") > hot_rows).select("bucket")
        if hot.isEmpty():
            return rows if settled is None else settled.unionByName(rows)
        hot = stored(hot, "hot-halves")
        narrow = F.col("end") - F.col("start") <= 1
        cool = rows.where(narrow).unionByName(rows.where(~narrow).join(hot, "bucket", "left_anti").select(*rows.columns))
        settled = cool if settled is None else settled.unionByName(cool)
        middle = F.expr("start + (end - start) div 2").cast("int")
        halves = F.explode(F.array(F.struct(middle.alias("a"), F.col("end").alias("b")), F.struct(F.col("start").alias("a"), middle.alias("b"))))
        again = rows.where(~narrow).join(hot, "bucket", "left_semi").withColumn("half", halves)
        rows = stored(_keyed(again.withColumn("start", F.col("half.a")).withColumn("end", F.col("half.b")).select(*rows.columns)), "refined-halves")


def near_words(vocab: DataFrame, min_chars: int = MIN_CHARS, part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``vocab`` (word, n) that
    have near words; ``vocab`` is read several times."""
    parts = max(16, -(-6 * vocab.count() // part_rows))
    rows = _dealt(vocab, min_chars, hot_rows).withColumn("part", F.pmod("bucket", F.lit(parts)) * 2 + F.col("side"))
    rows = rows.select("part", "side", "text", "n", "asks", "start", "end")
    answers = rows.groupBy("part").applyInPandas(_answers, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return answers.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to."""
    found = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        found = step.select("word", "root")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, factor: int = FACTOR, altered=None) -> DataFrame:
    """A row per word of the vocabulary: word, n, n_near, form, form_n, root."""
    vocab = stored(vocabulary(docs, id_col, text_col, min_chars, min_count, altered), "vocabulary")
    near = near_words(vocab, min_chars)
    is_form = F.col("best_n") >= factor * F.col("n")
    joined = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    joined = stored(joined, "near-words")
    last = roots(joined.where("form IS NOT NULL"))
    return joined.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
