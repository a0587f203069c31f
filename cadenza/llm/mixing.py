"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised.
The exponent is found by bisection (15 inner points a round, each round one
aggregation over the table of sources): either the largest one whose weights
reach a target entropy, or the smallest one that repeats no source more than a
limit.  The weights are then realised as budgeted block permutations: in each
epoch a source's documents are dealt into blocks by a hash, blocks and the
documents in them stand in hash order, and the last epoch stops where the
source's token budget is used up.

Plan: sources are counted with map-side sums.  The cut of the last epoch is
found from token sums per (source, block), a running sum over those, and the
documents of the one block per source where the budget ends; so a source that
holds a third of all rows is never sorted in one task, and the text is not
shuffled.  Choosing and repeating documents is then a projection over the
documents joined with the table of sources (one row each; Spark broadcasts it
below its threshold and splits skewed sources beyond).

Defined results: a null source is a source of its own; a null text has no
tokens; a source without tokens is shown once (its documents cost no budget);
rows of one source with equal ids stand or fall together at the budget's end;
a document that crosses the budget is still taken; columns of the input pass
through, with ``out`` (epoch, block, key) added or replaced; an empty table gives
an empty one; a text counts by its length, however long.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import SPACES, let, stored

#: Documents of a block, about.
BLOCK_DOCS = 1000
#: A source is repeated at most so often relative to the least repeated one.
MAX_REPEAT = 2.0
_POINTS = 15
_ROUNDS = 12


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.lit(0)).otherwise(F.regexp_count(t, F.lit(r"\s+")) + 1).cast("long")


def sources(docs: DataFrame, source: Column, size: Column) -> DataFrame:
    """(source, docs, tokens) of each source."""
    return docs.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("docs"), F.sum(size).alias("tokens"))


def _measures(table: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy (nats) of the weights, and the largest repetition relative to the
    least, at each exponent: one pass over the sources.  Shares are taken
    relative to the largest source, so no power overflows."""
    top = table.agg(F.max("tokens").alias("t")).first()["t"]
    share = F.col("tokens") / F.lit(float(top))
    sums = []
    for k, a in enumerate(exponents):
        p = F.pow(share, F.lit(a))
        sums += [F.sum(p).alias(f"z{k}"), F.sum(p * F.log(p)).alias(f"e{k}"), F.max(p / share).alias(f"hi{k}"), F.min(p / share).alias(f"lo{k}")]
    row = table.agg(*sums).first()
    return [(math.log(row[f"z{k}"]) - row[f"e{k}"] / row[f"z{k}"], row[f"hi{k}"] / row[f"lo{k}"]) for k in range(len(exponents))]


def exponent(table: DataFrame, entropy: float | None = None, max_repeat: float | None = None) -> float:
    """The exponent in [0, 1] closest to 1 (the natural mix) with an entropy of
    at least ``entropy`` nats, or closest to 0 (all sources alike) that repeats
    no source over ``max_repeat`` times as often as another.  Entropy and
    repetition both fall with the exponent, so the limit is bracketed by
    bisection.  A target that no exponent reaches gives 0, or 1."""
    if (entropy is None) == (max_repeat is None):
        raise ValueError("give a target entropy or a repetition limit")
    table = table.where("tokens > 0")
    if table.isEmpty():
        return 1.0

    def high(m: tuple[float, float]) -> bool:  # true below the wanted exponent
        return m[0] >= entropy if entropy is not None else m[1] > max_repeat

    ends = _measures(table, [0.0, 1.0])
    if not high(ends[0]):
        return 0.0
    if high(ends[1]):
        return 1.0
    low, up = 0.0, 1.0
    for _ in range(_ROUNDS):
        inner = [low + (up - low) * (k + 1) / (_POINTS + 1) for k in range(_POINTS)]
        n = sum(high(m) for m in _measures(table, inner))
        low, up = ([low, *inner, up][n], [low, *inner, up][n + 1])
    return low if entropy is not None else up


def weights(table: DataFrame, alpha: float, budget: float | None = None) -> DataFrame:
    """``table`` with ``weight`` (normalised), ``budget`` (tokens) and
    ``repeats`` (budget over tokens).  Without a total ``budget``, the least
    that shows every document at least once."""
    seen = table.where("tokens > 0")
    if seen.isEmpty():
        return table.select("*", F.lit(0.0).alias("weight"), F.lit(0.0).alias("budget"), F.lit(1.0).alias("repeats"))
    top = seen.agg(F.max("tokens").alias("t")).first()["t"]
    power = F.pow(F.col("tokens") / F.lit(float(top)), F.lit(alpha))
    z = seen.agg(F.sum(power).alias("z"), F.max(F.col("tokens") / power).alias("need")).first()
    total = budget if budget is not None else z["need"] * z["z"]
    weight = F.when(F.col("tokens") > 0, power / F.lit(z["z"])).otherwise(0.0)
    # rounded, so that a repetition that is whole but for the last digits is whole
    repeats = F.when(F.col("tokens") > 0, F.round(weight * F.lit(float(total)) / F.col("tokens"), 9)).otherwise(1.0)
    return table.select("*", weight.alias("weight"), (weight * F.lit(float(total))).alias("budget"), repeats.alias("repeats"))


def _order(ident: Column, source: Column, epoch: Column, n_blocks: Column, seed: int) -> Column:
    """Block and key of a document in an epoch's permutation."""
    key = F.xxhash64(ident, source, epoch, F.lit(seed))
    return F.struct(F.pmod(F.xxhash64(key, F.lit("block")), n_blocks).alias("block"), key.alias("key"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", out: str = "mix",
    entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None,
    block_docs: int = BLOCK_DOCS, seed: int = 0, size: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The drawn documents, a row for each time one is drawn, with struct
    ``out`` (epoch, block, key: the order to read a source in), and the table
    of sources (source, docs, tokens, weight, budget, repeats)."""
    if entropy is None and max_repeat is None:
        max_repeat = MAX_REPEAT
    size = n_words(F.col(f"`{text_col}`")) if size is None else size
    ident, source = F.col(f"`{id_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    narrow = stored(docs.select(ident.alias("id"), source.alias("source"), size.alias("n")), "sizes")
    counted = stored(sources(narrow, F.col("source"), F.col("n")), "sources")
    alpha = exponent(counted, entropy, max_repeat)
    table = stored(
        weights(counted, alpha, budget)
        .withColumn("whole", F.floor("repeats"))
        .withColumn("n_blocks", F.ceil(F.col("docs") / F.lit(block_docs)))
        .withColumn("left", (F.col("repeats") - F.col("whole")) * F.col("tokens")),
        "weights",
    )

    # the last epoch: the block where the budget ends, then the key in it
    part = table.where("left > 0").select(F.col("source").alias("of"), F.col("whole").alias("epoch"), "n_blocks", "left")
    placed = narrow.join(part, F.col("source").eqNullSafe(F.col("of"))).select(
        "of", "left", "n", F.col("id"), _order(F.col("id"), F.col("of"), F.col("epoch"), F.col("n_blocks"), seed).alias("at")
    )
    blocks = placed.groupBy("of", "left", F.col("at.block").alias("block")).agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("of").orderBy("block")) - F.col("n")
    ends = (
        blocks.withColumn("before", before)
        .where((F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left")))
        .select(F.col("of").alias("in"), F.col("block").alias("end_block"), "before")
    )
    inside = placed.join(ends, F.col("of").eqNullSafe(F.col("in")) & (F.col("at.block") == F.col("end_block")))
    upto = F.sum("n").over(Window.partitionBy("of", "end_block").orderBy("at.key").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("n").over(Window.partitionBy("of", "end_block", "at.key"))
    cut = (
        inside.withColumn("prior", upto - same)
        .where(F.col("before") + F.col("prior") < F.col("left"))
        .groupBy("in", "end_block")
        .agg(F.max("at.key").alias("end_key"))
    )
    plan = stored(
        table.join(cut, F.col("source").eqNullSafe(F.col("in")), "left").select(
            F.col("source").alias("__mix_source"), F.col("whole").cast("int").alias("__mix_whole"), F.col("n_blocks").alias("__mix_blocks"),
            F.col("end_block").alias("__mix_end"), F.col("end_key").alias("__mix_key"),
        ),
        "mix",
    )

    joined = docs.join(plan, source.eqNullSafe(F.col("__mix_source")))

    def drawn(epoch: Column) -> Column:
        o = _order(ident, source, epoch.cast("long"), F.col("__mix_blocks"), seed)
        last = epoch == F.col("__mix_whole")
        return let(
            o,
            lambda x: F.when(
                ~last | (x["block"] < F.col("__mix_end")) | ((x["block"] == F.col("__mix_end")) & (x["key"] <= F.col("__mix_key"))),
                F.struct(epoch.alias("epoch"), x["block"].alias("block"), x["key"].alias("key")),
            ),
        )

    draws = F.filter(F.transform(F.sequence(F.lit(0), F.col("__mix_whole")), drawn), lambda x: x.isNotNull())
    kept = [f"`{c}`" for c in docs.columns if c != out]
    return joined.select(*kept, F.explode(draws).alias(out)), table.select("source", "docs", "tokens", "weight", "budget", "repeats")
