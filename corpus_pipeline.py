"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing to
target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept, written as a table in between.  All but the last return the columns of
``documents``:

* quality rules: rows that break no rule stay;
* line dedup: lines on over a five-hundredth of their source's documents, and
  on five at least, are cut;
* near-dedup: one document of each SimHash class stays;
* mixing: documents are repeated until the sources' weights stand at most 2 to
  1 apart from the natural mix; the budget is the least that shows every
  document at least once, so none is dropped;
* BPE: a row for each drawn document with its token ids and their digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import bpe, lines, mixing, quality, simhash
from cadenza.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = lines.cut_lines(docs, "source")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.select(*(f"`{c}`" for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn, _ = mixing.mix(docs, out="__mix")
    return drawn.select(*(f"`{c}`" for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.round_trip(docs.select("doc_id", "source", "text"))
    return encoded.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Fingerprints, hash permutations and BPE have no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
