"""Registered queries vs their DuckDB oracle at sf0.001 (the driver runs the
full set at sf0.01), plus the entry() smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from cadenza.plans.registry import load_all
from cadenza.sources.catalog import TABLES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
# Every library query with a twin but the slow ones: many fits, and streams that test_streaming.py
# runs as well (tools/check_oracle.py and the driver run them all).
SLOW = {"search_weights", "sweep_k", "cross_validate", "train_cluster_classifier", "predict_cluster_proba",
        "stream_checkpoint_restart", "stream_recommend", "stream_recommend_v3", "stream_error_isolation"}
NAMES = sorted(n for n, e in load_all().items() if e.sql and n not in SLOW)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["recommendation_id", "song_id", "title", "artist", "tempo", "key", "tempo_diff"]


def test_every_query_has_a_twin():
    """But for the playlists of a classifier fitted on the spot (test_ml.py works them out from its weights)."""
    assert {n for n, e in load_all().items() if not e.sql} == {"build_playlist_classifier"}
