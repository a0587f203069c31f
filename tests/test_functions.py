"""Scalar functions on hand-made rows (FIXTURES §2) and properties."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.functions import harmony as H
from cadenza.functions import payload as PL
from cadenza.functions import vectors as VX


def test_camelot_codes(spark):
    rows = [(0, 1), (9, 0), (11, 1), (8, 0), (12, 1), (None, 1)]
    df = spark.createDataFrame(rows, "key int, mode int")
    got = [r[0] for r in df.select(H.camelot_code(F.col("key"), F.col("mode"))).collect()]
    assert got == ["8B", "8A", "1B", "1A", None, None]


def test_camelot_truncates_fractional_key(spark):
    df = spark.createDataFrame([(3.7, 1.0)], "key double, mode double")
    assert df.select(H.camelot_code(F.col("key"), F.col("mode"))).first()[0] == "5B"


def test_camelot_neighbours(spark):
    df = spark.createDataFrame([(1, "A"), (12, "B")], "n int, l string")
    got = [r[0] for r in df.select(H.camelot_neighbors(F.col("n"), F.col("l"))).collect()]
    assert got == [["1A", "12A", "2A", "1B"], ["12B", "11B", "1B", "12A"]]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 12), st.sampled_from(["A", "B"]))
def test_neighbours_symmetric(spark, n, letter):
    nb = spark.range(1).select(H.camelot_neighbors(F.lit(n), F.lit(letter)).alias("a")).first()[0]
    for code in nb[1:]:
        back = spark.range(1).select(H.camelot_neighbors(F.lit(int(code[:-1])), F.lit(code[-1])).alias("a")).first()[0]
        assert f"{n}{letter}" in back


def test_key_parser(spark):
    rows = [("F♯m",), ("Bb",), ("AM",), ("c",), ("E#",), ("",), (None,)]
    df = spark.createDataFrame(rows, "k string")
    got = [(r["key"], r["mode"]) for r in df.select(PL.parse_musical_key(F.col("k")).alias("s")).select("s.*").collect()]
    assert got == [(6, 0), (10, 1), (9, 0), (None, 1), (None, 1), (None, None), (None, None)]


def test_time_signature_and_loudness(spark):
    df = spark.createDataFrame([("4/4", 0.0), ("6/8", 50.0), ("x", 100.0), (None, None)], "ts string, a double")
    got = df.select(PL.parse_time_signature(F.col("ts")).alias("t"), PL.acousticness_to_loudness(F.col("a")).alias("l")).collect()
    assert [r["t"] for r in got] == [4, 6, None, None]
    assert [r["l"] for r in got][:3] == [0.0, -30.0, -60.0]


def test_recommendation_id(spark):
    df = spark.createDataFrame([("Blinding Lights", "The Weeknd")], "t string, a string")
    assert df.select(PL.recommendation_id(F.col("t"), F.col("a"))).first()[0] == "9F2EEF5B2D9BB3AB"


def test_foreign_id(spark):
    df = spark.createDataFrame([("musicbrainz:artist:abc",), ("7digital:artist:12",), ("",), (None,)], "f string")
    got = df.select(PL.parse_foreign_id(F.col("f"), "musicbrainz").alias("m"),
                    PL.parse_foreign_id(F.col("f"), "7digital", as_int=True).alias("d")).collect()
    assert [(r.m, r.d) for r in got] == [("abc", -1), ("", 12), ("", -1), ("", -1)]


def test_artist_name_shapes(spark):
    rows = [('{"artist":{"name":"x"}}',), ('{"artist":[{"name":"y"}]}',), ('{"title":"t"}',)]
    df = spark.createDataFrame(rows, "p string")
    assert [r[0] for r in df.select(PL.extract_artist_name(F.col("p"))).collect()] == ["x", "y", ""]


def test_cosine_zero_denominator(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(VX.cosine_similarity("a", "b")).collect()]
    assert got == [0.0, 1.0]


def test_weights_are_double(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    out = df.select(VX.weight_features("a", [3, 0.5]).alias("w"))
    assert out.schema["w"].dataType.simpleString() == "array<double>"
    assert out.first()[0] == [3.0, 1.0]
