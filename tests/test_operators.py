"""Operators on hand-made rows (FIXTURES §2), brute-force and property checks."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cadenza.operators import clean as C
from cadenza.operators import discover as D
from cadenza.operators import enrich as EN
from cadenza.operators import mmr as MM
from cadenza.operators import ragged as RG
from cadenza.operators import recommend as RC
from cadenza.plans import classify as CL


def test_tempo_range_filter(spark):
    df = spark.createDataFrame([(39.99,), (40.0,), (250.0,), (250.01,), (None,)], "tempo double")
    assert sorted(r[0] for r in C.filter_tempo_range(df).collect()) == [40.0, 250.0]


def test_malformed_json_goes_to_dead_letter(spark):
    msgs = spark.createDataFrame([("k1", "{bad"), ("k2", '{"track_name":"t","artist_name":"a"}'),
                                  ("k3", '{"track_name":"t","artist_name":"a","tempo":100,"loudness":-5,'
                                         '"key":1,"mode":1,"time_signature":4}')], "key string, value string")
    good, bad = C.drop_bad_rows(msgs)
    assert [r.recommendation_id for r in good.collect()] == ["k3"]
    reasons = {r.recommendation_id: r.reason for r in bad.collect()}
    assert reasons["k1"] == "unreadable"
    assert reasons["k2"] == "tempo,loudness,key,mode,time_signature"


def test_coerce_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (1.5, -3.0, 3.9, 0.0, 7.0)],
                               "tempo double, loudness double, key double, mode double, time_signature double")
    got = [tuple(r) for r in C.coerce_types_with_defaults(df).collect()]
    assert got == [(0.0, -60.0, 0, 1, 4), (1.5, -3.0, 3, 0, 7)]


def test_timbre_no_segments_gives_zeros(spark):
    songs = spark.createDataFrame([(1,), (2,)], "song long")
    segs = spark.createDataFrame([(1, [1.0] * 12), (1, [3.0] * 12)], "song long, timbre array<double>")
    out = {r.song: r for r in RG.timbre_mean_std(segs, songs, "song", "timbre").collect()}
    assert out[1]["timbre_mean_0"] == 2.0 and out[1]["timbre_std_0"] == 1.0
    assert all(out[2][f"timbre_mean_{i}"] == 0.0 and out[2][f"timbre_std_{i}"] == 0.0 for i in range(12))


def test_ragged_offsets_and_slices(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, []), (3, [4.0, 5.0])], "ord long, values array<double>")
    off = RG.ragged_offsets(df.select("ord", F.size("values").alias("n")), "ord", "n", parts=2)
    assert [r.offset for r in off.orderBy("ord").collect()] == [0, 3, 3]
    flat = RG.explode_with_offsets(df, "ord", "values")
    back = RG.ragged_slice(flat, off, parts=3).orderBy("ord").collect()
    assert [r["values"] for r in back] == [[1.0, 2.0, 3.0], [], [4.0, 5.0]]


def test_global_rank_is_a_permutation(spark):
    rows = [(random.Random(7).randint(0, 50), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int")
    r = D.global_rank(df, ["a", "b"], parts=5).collect() if hasattr(D, "global_rank") else \
        RG.global_rank(df, ["a", "b"], parts=5).collect()
    got = sorted((x.a, x.b, x.rank0) for x in r)
    exp = [(a, b, i) for i, (a, b) in enumerate(sorted(rows))]
    assert got == exp


def _brute_nearest(reqs, cat):
    out = {}
    for rid, cl, t in reqs:
        best = None
        for sid, c2, t2 in cat:
            if c2 != cl:
                continue
            key = (abs(t2 - t), sid)
            best = key if best is None or key < best else best
        if best:
            out[rid] = best[1]
    return out


def test_nearest_tempo_matches_brute_force(spark):
    rnd = random.Random(3)
    cat = [(f"s{i:04d}", rnd.randint(0, 2), round(rnd.uniform(40, 250), 1)) for i in range(400)]
    cat += [(f"t{i:04d}", 0, 120.0) for i in range(30)]          # hot tempo in one cluster
    reqs = [(f"r{i}", rnd.randint(0, 3), round(rnd.uniform(40, 250), 2)) for i in range(200)]
    cdf = spark.createDataFrame([(s, c, t, "x", "y", 0) for s, c, t in cat],
                                "song_id string, cluster_id int, tempo double, title string, artist string, key int")
    rdf = spark.createDataFrame(reqs, "recommendation_id string, cluster_id int, tempo double")
    got = {r.recommendation_id: r.song_id for r in RC.nearest_tempo_per_request(rdf, cdf).collect()}
    assert got == _brute_nearest(reqs, cat)


def test_year_known_mbid_never_falls_back_to_names(spark):
    artist = spark.createDataFrame([(1, "g1", "Art")], "id long, gid string, name string")
    track = spark.createDataFrame([(10, "Other", 1, 100)], "id long, name string, artist long, album long")
    album = spark.createDataFrame([(100, "Alb", 1)], "id long, name string, artist long")
    release = spark.createDataFrame([(100, "1999-01-01")], "album long, releasedate string")
    songs = spark.createDataFrame([("s1", "Song", "Nope", "Art", "g1"), ("s2", "Other", "", "art", ""),
                                   ("s3", "x", "alb", "ART", None)],
                                  "song_id string, title string, release string, artist_name string, artist_mbid string")
    got = {r.song_id: r.year for r in EN.find_release_year(songs, artist, track, album, release).collect()}
    assert got == {"s1": 0, "s2": 1999, "s3": 1999}


def test_mmr_lambda_one_is_cosine_order():
    rng = np.random.default_rng(1)
    mat = rng.normal(size=(30, 5))
    rel = np.sort(rng.uniform(size=30))[::-1]
    assert MM.mmr_select(rel, mat, 10, 1.0) == list(range(10))


def test_mmr_floor_when_all_similarities_negative():
    mat = np.array([[1.0, 0.0], [-1.0, 0.0], [-1.0, 0.1]])
    rel = np.array([0.9, 0.5, 0.4])
    # every pair with the first pick has negative cosine → diversity term 0
    assert MM.mmr_select(rel, mat, 2, 0.7) == [0, 1]


def test_bfs_depths(spark):
    edges = spark.createDataFrame([(1, 2, 5), (2, 3, 5), (3, 4, 5), (1, 5, 1), (5, 6, 1)], "src long, dst long, weight long")
    roots = spark.createDataFrame([(1,)], "artist_id long")
    got = {r.artist_id: r.depth for r in D.expand_similar_artists(roots, edges, neighbours=1).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3}


def test_trim_to_target_and_surplus_partition_input(spark):
    df = spark.createDataFrame([(f"s{i:03d}", i % 17) for i in range(100)], "song_id string, added_at int")
    keep = D.trim_to_target(df, 60)
    surplus = D.trim_to_target(df, 60, dry_run=True)
    assert keep.count() == 60 and surplus.count() == 40
    assert keep.join(surplus, "song_id").count() == 0


def test_stratified_split_is_exact_per_class(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(103)], "id long, label int")
    sp = CL.stratified_split(df, "label", "id")
    per = {r.label: r.n for r in sp.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 7, 1: 7, 2: 7}
    folds = CL.stratified_kfold(df, "label", "id").groupBy("label", "fold").count().collect()
    assert max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 1


def test_classification_report_matches_spark_evaluator(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 3)) for _ in range(200)]
    pred = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r["class"]: r for r in CL.classification_report(pred).collect()}
    ev = CL.evaluate_classifier(pred)
    assert abs(rep["accuracy"].precision - ev["accuracy"]) < 1e-6
    assert abs(rep["weighted avg"].f1 - ev["f1_weighted"]) < 1e-6


def test_dedupe_keeps_first_added(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), ("b", 5, 3.0)], "song_id string, added_at int, tempo double")
    from cadenza.sources.catalog import dedupe_by
    got = {r.song_id: r.tempo for r in dedupe_by(df, "song_id", ("added_at", "tempo")).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_nearest_tempo_outside_serving_range(spark):
    cat = [("a", 0, 10.0), ("b", 0, 300.0), ("c", 0, 120.0)]
    reqs = [("r1", 0, 5.0), ("r2", 0, 400.0), ("r3", 0, 200.0), ("r4", 0, 65.0)]
    cdf = spark.createDataFrame([(s, c, t, "x", "y", 0) for s, c, t in cat],
                                "song_id string, cluster_id int, tempo double, title string, artist string, key int")
    rdf = spark.createDataFrame(reqs, "recommendation_id string, cluster_id int, tempo double")
    got = {r.recommendation_id: r.song_id for r in RC.nearest_tempo_per_request(rdf, cdf).collect()}
    assert got == _brute_nearest(reqs, cat)


def test_cosine_topn_is_exact_for_any_tiling(spark):
    """Same rows and scores for 1, 64 and 200 candidate partitions and any tile size, with duplicated vectors."""
    rng = np.random.default_rng(11)
    vecs = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3)) for i in range(500)]
    vecs += [(500 + i, vecs[i % 7][1], int(i % 3)) for i in range(90)] + [(600, [0.0] * 8, 0)]
    cands = spark.createDataFrame(vecs, "vec_id long, embedding array<double>, label int")
    seeds = spark.createDataFrame([(i, vecs[i][1], [i % 3, (i + 1) % 3]) for i in range(0, 590, 37)],
                                  "seed_id long, embedding array<double>, top_clusters array<int>")
    want = {}
    for s in range(0, 590, 37):
        near = []
        for i, x, c in vecs:
            if i != s and c in (s % 3, (s + 1) % 3):
                dot = own = other = 0.0
                for a, b in zip(vecs[s][1], x):
                    dot, own, other = dot + a * b, own + a * a, other + b * b
                near.append((-(dot / ((np.sqrt(own) * np.sqrt(other)) or 1e-12)), i))
        want[s] = [i for _, i in sorted(near)[:20]]
    for parts, tiles in ((1, (1024, 16384)), (64, (4, 50)), (200, (1024, 30))):
        got = {}
        out = RC.cosine_topn(seeds, cands.repartition(parts), n=20, tile_seeds=tiles[0], tile_rows=tiles[1])
        for r in out.orderBy("seed_id", "rank").collect():
            got.setdefault(r["seed_id"], []).append(r["vec_id"])
        assert got == want


def test_nearest_tempo_buckets_follow_the_catalog(spark):
    """One cluster with 10^5 distinct tempos: narrow, even buckets and exact answers."""
    rng = np.random.default_rng(7)
    tempos = np.unique(np.round(rng.uniform(40, 250, 100_000), 6))
    songs = pd.DataFrame({"song_id": [f"s{i:06d}" for i in range(len(tempos))], "title": "t", "artist": "a", "tempo": tempos, "key": 1, "cluster_id": 3})
    index = RC.build_tempo_index(spark.createDataFrame(songs), ["cluster_id"], points_per_bucket=50)
    sizes = [r["count"] for r in index[0].groupBy("bucket").count().collect()]
    assert index[2] > 1 and max(sizes) < 150 and len(sizes) > 1000
    asked = np.round(rng.uniform(30, 260, 500), 6)
    probes = spark.createDataFrame(pd.DataFrame({"cluster_id": 3, "tempo": asked}))
    got = {r["tempo"]: r["song"]["song_id"] for r in RC.nearest_by_tempo(probes, None, ["cluster_id"], index=index).collect()}
    for t in asked.tolist():
        gaps = np.abs(tempos - t)
        assert got[t] == f"s{int(np.flatnonzero(gaps == gaps.min())[0]):06d}"


def test_co_occurrence_of_a_hot_group_does_not_depend_on_the_blocks(spark):
    rows = [(0, m, 1 + m % 3) for m in range(150)] + [(g, (g * 7 + j) % 40, 1) for g in range(1, 30) for j in range(g % 5)]
    per = spark.createDataFrame(rows, "album long, artist long, n long").groupBy("album", "artist").agg(F.sum("n").alias("n"))
    whole = {tuple(r) for r in D.co_occurrence(per, "album", "artist", block=10**6).collect()}
    blocks = D.co_occurrence(per, "album", "artist", block=16)
    assert {tuple(r) for r in blocks.collect()} == whole
    counts = {}
    for g, m, n in per.collect():
        counts.setdefault(g, {})[m] = n
    want = {}
    for members in counts.values():
        for a, na in members.items():
            for b, nb in members.items():
                if a != b:
                    want[a, b] = want.get((a, b), 0) + na * nb
    assert {(a, b): w for a, b, w in whole} == want


def test_ragged_timbre_over_bucket_borders(spark, monkeypatch):
    """Buckets of four places: slices that cross several of them, empty ones,
    segments before the first start and after the last one."""
    monkeypatch.setattr(RG, "_BUCKET_BITS", 2)
    rng = random.Random(5)
    sizes = [0, 3, 0, 0, 11, 1, 4, 0, 1, 1, 9, 0]
    arrays = [[[float(rng.randint(-9, 9)) for _ in range(12)] for _ in range(n)] for n in sizes]
    df = spark.createDataFrame([(f"s{i:02d}", a) for i, a in enumerate(arrays)], "song_id string, segments array<array<double>>")
    off = RG.ragged_offsets(df.withColumn("n", F.size("segments")), "song_id", "n", parts=3)
    flat = RG.explode_offsets(off, "segments")
    offsets = off.select("song_id", "offset", "n")
    want = {}
    for i, a in enumerate(arrays):
        cols = list(zip(*a)) or [(0.0,)] * 12
        means = [sum(c) / len(c) for c in cols]
        want[f"s{i:02d}"] = [round(x, 6) for x in means] + [round((sum((v - m) ** 2 for v in c) / len(c)) ** 0.5, 6) for c, m in zip(cols, means)]
    told = RG.ragged_timbre(flat, offsets, size_col="n")
    got = {r[0]: [round(x, 6) for x in r[1:]] for r in told.collect()}
    assert got == want and told.count() == len(sizes)
    full = offsets.where("n > 0")
    assert {r[0]: [round(x, 6) for x in r[1:]] for r in RG.ragged_timbre(flat, full).collect()} == {k: v for k, v in want.items() if sizes[int(k[1:])]}
    assert RG.ragged_timbre(flat, offsets).select("song_id").distinct().count() == len(sizes)
    late = RG.ragged_owner(flat, offsets.where("song_id >= 's02'"), order="song_id")
    assert late.where("song_id IS NULL").count() == 3 and late.where("song_id = 's04'").count() == 11


def test_owners_of_segments_need_one_shuffle_of_them(spark):
    """The vectors of a ragged array are dealt once by position: no checkpoint, no sampling, no shuffle of sums per song."""
    flat = spark.range(100).select(F.col("id").alias("pos"), F.array(*[F.col("id").cast("double")] * 12).alias("value"))
    offsets = spark.range(10).select(F.col("id").alias("song_id"), (F.col("id") * 10).alias("offset"), F.lit(10).alias("n"))
    plan = RG.ragged_timbre(flat, offsets, size_col="n")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "rangepartitioning" not in plan
    grouped = [line for line in plan.splitlines() if "Exchange hashpartitioning(song_id" in line]
    assert len(grouped) == 1   # of the few songs that cross a border


def test_a_tile_answers_block_by_block(monkeypatch):
    """No answer of a tile holds more than a block of seeds; together they are the brute-force top n."""
    monkeypatch.setattr(RC, "SEED_BLOCK", 4)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 5))
    rows = pd.DataFrame({"is_seed": [i < 10 for i in range(40)], "vec_id": range(40), "embedding": list(x)})
    parts = list(RC._tile_topn(3, True, "label")((7,), iter([rows[:15], rows[15:]])))
    assert len(parts) == 3 and max(p["seed_id"].nunique() for p in parts) == 4
    got = pd.concat(parts)
    for s in range(10):
        cos = {i: x[s] @ x[i] / np.linalg.norm(x[s]) / np.linalg.norm(x[i]) for i in range(10, 40)}
        mine = got[got["seed_id"] == s]
        assert mine["vec_id"].tolist() == sorted(cos, key=lambda i: -cos[i])[:3] and set(mine["label"]) == {7}
        assert all(np.array_equal(e, x[i]) for i, e in zip(mine["vec_id"], mine["embedding"]))
