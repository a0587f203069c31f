"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the text (lengths, symbols, stop
words, lines, repeated windows); the table of limits becomes one array of the
names of the rules that a text breaks.  No shuffle, no user function: a row is
judged where it is read, so the cost follows the bytes of text and one long
text stays one row.

Defined results: a null text counts as empty (no words); an empty text breaks
the length rule; equal rows are judged alike and all stay; columns of the
input pass through, except that a column named like ``out`` is replaced; an
empty table gives an empty one; very long texts are judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import SPACES, let, words

#: Words of a window that counts as repeated when found twice.
WINDOW = 8

#: Frequent function words of the languages that the rules are set for.
STOP_WORDS = (
    "the of and to in a is that it for on was with be as this by are at from or "
    "der die und das den von zu mit ist des sich im dem ein eine auf für "
    "le la les de et un une en que qui pour dans est au avec sur "
    "el los las y por con del se una"
).split()

#: A stop word in lower case or capitalised, with at most one mark after it.
STOP_FORMS = sorted({form + mark for w in STOP_WORDS for form in (w, w.capitalize()) for mark in ("", ".", ",", ";", ":")})


@dataclass(frozen=True)
class Rule:
    """A text breaks the rule if ``low > measure`` or ``measure > high``;
    texts under ``min_words`` words are not judged by it."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The first two are the base rules; ratios are per word or per line.
RULES = (
    Rule("too_few_words", "n_words", low=20),
    Rule("repeated_windows", "repeat_ratio", high=0.30),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("stop_words", "stop_ratio", low=0.05, min_words=50),
    Rule("duplicate_lines", "dup_line_ratio", high=0.50),
    Rule("word_length", "mean_word_chars", low=2.0, high=14.0),
)
BASE = ("too_few_words", "repeated_windows")


def _repeat_words(ws: Column) -> Column:
    """Words standing in 8-word windows found twice or more in the text.

    Window hashes are built by doubling (1, 2, 4, 8 words), the last step only
    where four words repeat.  Only if some window repeats are they sorted by (hash, start); neighbours of equal hash
    are the repeated ones, and each adds the words up to the next start."""

    def doubled(h: Column, step: int) -> Column:
        n = F.size(h) - step
        return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(
            F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))
        )

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
                    ),
                    lambda e: e["i"],
                )
            ),
        )
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    def repeats(h: Column) -> Column:
        return F.size(F.array_distinct(h)) != F.size(h)

    def from_fours(four: Column) -> Column:
        # an 8-word window can only repeat if its first four words do
        return F.when(
            repeats(four),
            let(doubled(four, 4), lambda eight: F.when(repeats(eight), covered(eight)).otherwise(zero)),
        ).otherwise(zero)

    zero = F.lit(0).cast("long")
    return let(
        F.transform(ws, lambda w: F.xxhash64(w)),
        lambda one: let(doubled(one, 1), lambda two: let(doubled(two, 2), from_fours)),
    )


def measures(text: Column) -> Column:
    """One struct of counts and ratios of a text."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def per(x: Column, n: Column) -> Column:
        return F.when(n == 0, F.lit(0.0)).otherwise(x.cast("double") / n)

    def build(ws: Column, ls: Column) -> Column:
        n = F.size(ws).cast("long")
        counts = F.struct(
            n.alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.when(full.rlike("[#*$%&|<>]"), F.char_length(full) - F.char_length(F.translate(full, "#*$%&|<>", "")))
            .otherwise(0).cast("long").alias("n_symbols"),
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
        )
        return let(
            counts,
            lambda c: F.struct(
                *(c[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")),
                per(c["n_symbols"], c["n_words"]).alias("symbol_ratio"),
                per(c["n_stop_words"], c["n_words"]).alias("stop_ratio"),
                per(c["n_dup_lines"], c["n_lines"]).alias("dup_line_ratio"),
                per(c["n_repeat_words"], c["n_words"]).alias("repeat_ratio"),
                per(c["word_chars"], c["n_words"]).alias("mean_word_chars"),
            ),
        )

    return let(words(text), lambda ws: let(lines, lambda ls: build(ws, ls)))


def broken(m: Column, rules=RULES) -> Column:
    """Names of the rules that the measures ``m`` break, in table order."""

    def one(r: Rule) -> Column:
        if r.measure == "repeat_ratio":  # in whole numbers, as the base rule says it
            bad = 100 * m["n_repeat_words"] > round(100 * r.high) * m["n_words"]
        else:
            x = m[r.measure]
            bad = (x < F.lit(r.low) if r.low is not None else F.lit(False)) | (x > F.lit(r.high) if r.high is not None else F.lit(False))
        if r.min_words:
            bad = bad & (m["n_words"] >= r.min_words)
        return F.when(bad, F.lit(r.name))

    return F.array_compact(F.array(*(one(r) for r in rules)))


def judge(docs: DataFrame, text_col: str = "text", out: str = "quality", rules=RULES) -> DataFrame:
    """``docs`` with a struct ``out``: the measures, ``broken`` (rule names),
    ``base_failed`` and ``kept`` (no rule broken)."""
    m = measures(F.col(f"`{text_col}`"))
    judged = let(
        m,
        lambda s: let(
            broken(s, rules),
            lambda b: F.struct(
                s.alias("measures"),
                b.alias("broken"),
                F.arrays_overlap(b, F.array(*map(F.lit, BASE))).alias("base_failed"),
                (F.size(b) == 0).alias("kept"),
            ),
        ),
    )
    return docs.withColumn(out, judged)


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns of ``docs``."""
    kept = let(let(measures(F.col(f"`{text_col}`")), lambda s: broken(s, rules)), lambda b: F.size(b) == 0)
    return docs.where(kept)
