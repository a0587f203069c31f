"""Plan-shape guards for the scale properties the design relies on."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["join_harmonic_nearest_tempo", "nearest_tempo_per_request", "top3_per_request",
                                  "recommend_batch", "find_release_year", "assign_nearest_centroid",
                                  "loudness_positive", "distinct_clusters"])
def test_no_pair_products(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["top3_per_request", "cap_songs_per_artist", "extremes_by_attribute", "artist_tags"])
def test_top_k_uses_group_limit(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filters_reach_the_scan(spark):
    df = E.queries()["clean_catalog"](spark, SF)
    text = formatted(df)
    assert "GreaterThanOrEqual(l_linenumber,1)" in text and "LessThanOrEqual(l_linenumber,5)" in text


def test_projection_prunes_columns(spark):
    df = E.queries()["filter_cluster"](spark, SF)
    text = formatted(df)
    assert "l_discount" not in text and "l_shipdate" not in text


def test_year_cascade_is_one_lookup_join(spark):
    """The song side meets one lookup; the match tables are no joins of its own."""
    from cadenza.operators import enrich as EN

    df = spark.createDataFrame([("s", "t", "r", "a", "m")], "song_id string, title string, release string, artist_name string, artist_mbid string")
    artist = spark.createDataFrame([(1, "m", "a")], "id long, gid string, name string")
    track = spark.createDataFrame([(1, "t", 1, 1)], "id long, name string, artist long, album long")
    album = spark.createDataFrame([(1, "r", 1)], "id long, name string, artist long")
    release = spark.createDataFrame([(1, "1999-01-01")], "album long, releasedate string")
    out = EN.find_release_year(df, artist, track, album, release)
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert len(joins) == 1
    assert [tuple(r) for r in out.collect()] == [("s", 1999)]


def test_cosine_topn_broadcasts_no_vectors(spark):
    text = plan(spark, "cosine_topn")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "FlatMapGroupsInPandas" in text
