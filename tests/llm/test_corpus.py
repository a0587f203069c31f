"""Operators over whole tables against brute force: SimHash, mixing, WARC,
nearest neighbours, language model, pipeline; and the registered SQL twins."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import ann, lm, mixing, queries, simhash, warc
from cadenza.llm.bpe import tokenizer_path
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, res.fetchall())[0]


# --- SimHash -----------------------------------------------------------------


def brute_fingerprint(t, k=4):
    ws = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", ws)
    if not ws:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(nodes, near):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {x: root(x) for x in nodes}


def near_texts():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 60, 400]))) for _ in range(40)]
    out = [None, "", "  ", "Ä É", "\x0b"]
    for t in base:
        out += [t] * rng.choice([1, 1, 3])
        for _ in range(rng.randint(0, 4)):
            ws = t.split(" ")
            ws[rng.randrange(len(ws))] = rng.choice(words)
            t = " ".join(ws)
            out.append(t.upper() if rng.random() < 0.2 else t)
    return out


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    docs = spark.createDataFrame([(i * 3, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    fps = [brute_fingerprint(t) for t in texts]
    classes = brute_classes(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for i, f in enumerate(fps):
        low[classes[f]] = min(low.get(classes[f], 1 << 60), i * 3)
    rows = simhash.near_duplicates(docs).collect()
    assert {r["id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in rows} == {i * 3: (f, low[classes[f]]) for i, f in enumerate(fps)}
    assert len(set(low.values())) < len(set(fps))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(low.values())


def test_links_equal_all_pairs_for_any_code_length():
    rng = np.random.default_rng(1)
    fps = set()
    for x in rng.integers(0, 1 << 63, 120, dtype=np.uint64).tolist():
        fps.add(x)
        for _ in range(rng.integers(0, 5)):
            for b in rng.choice(64, rng.integers(1, 7), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    nodes = sorted(fps)
    want = brute_classes(nodes, lambda a, b: (a ^ b).bit_count() <= 4)
    held = simhash.PASS_VARIANTS
    try:
        for bits, size in ((4, held), (4, 3000), (12, held)):
            simhash.PASS_VARIANTS = size
            found = [p for b in range(1 << bits) for p in simhash._bucket_links(np.array(nodes, np.uint64), b, bits, 2)] if bits == 4 else []
            if bits == 12:  # buckets that hold only some fingerprints
                codes, deltas = simhash._codes(np.array(nodes, np.uint64), bits), np.unique(simhash._codes(simhash._masks(2), bits))
                reached = {}
                for x, c in zip(nodes, codes.tolist()):
                    for d in deltas.tolist():
                        reached.setdefault(c ^ d, []).append(x)
                found = [p for b, xs in reached.items() if len(xs) > 1 for p in simhash._bucket_links(np.array(xs, np.uint64), b, bits, 2)]
            pairs = {frozenset(p) for p in found}
            assert brute_classes(nodes, lambda a, b: frozenset((a, b)) in pairs) == want
    finally:
        simhash.PASS_VARIANTS = held


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (300, 200)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {200: 100, 300: 100}
    assert simhash.components(edges.limit(0)).count() == 0


def test_simhash_takes_null_and_repeated_ids_and_empty_tables(spark):
    other = " ".join(f"q{i}" for i in range(80))
    docs = spark.createDataFrame([(None, "x y z"), (5, other), (5, "a b c d"), (5, "a b c d"), (9, other + " ")], "doc_id long, text string")
    kept = simhash.keep_one(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(None, "x y z"), (5, other), (5, "a b c d")])
    assert simhash.near_duplicates(docs).count() == 5
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------


def mixed_docs(spark, n=3000):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        s = rng.choices(["hot", "b", "c", None, "tiny"], [60, 20, 10, 8, 2])[0]
        rows.append((i, s, " ".join(["w"] * rng.randint(0, 30)), 1))
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string, mix int")


def brute_weights(tokens, alpha):
    p = {s: t**alpha for s, t in tokens.items() if t}
    return {s: x / sum(p.values()) for s, x in p.items()}


def test_exponent_meets_entropy_and_repetition(spark):
    tokens = {"a": 100_000, "b": 5_000, "c": 300, "z": 0}
    table = spark.createDataFrame([(s, 1, t) for s, t in tokens.items()], "source string, docs long, tokens long")
    for target in (0.3, 0.8, 1.05):
        a = mixing.exponent(table, entropy=target)
        w = brute_weights(tokens, a)
        assert abs(-sum(x * math.log(x) for x in w.values()) - target) < 1e-6
    for limit in (1.5, 4.0, 100.0):
        a = mixing.exponent(table, max_repeat=limit)
        w = brute_weights(tokens, a)
        r = [w[s] / tokens[s] for s in w]
        assert abs(max(r) / min(r) - limit) < 1e-6 * limit
    assert mixing.exponent(table, entropy=9.0) == 0.0
    assert mixing.exponent(table, max_repeat=1e9) == 0.0
    assert mixing.exponent(table, max_repeat=1.0) == 1.0


def test_mix_realises_the_budget(spark):
    rows, docs = mixed_docs(spark)
    drawn, table = mixing.mix(docs, block_docs=50)
    plan = {r["source"]: r for r in table.collect()}
    got = drawn.select("doc_id", "source", "text", "mix.*").collect()
    size = {i: len(t.split()) for i, _, t, _ in rows}
    times = Counter(r["doc_id"] for r in got)
    assert set(times) == {i for i, *_ in rows}  # none is dropped
    tokens = Counter()
    for i, s, _, _ in rows:
        tokens[s] += size[i]
    for s, r in plan.items():
        assert r["tokens"] == tokens[s]
        mine = [x for x in got if x["source"] == s]
        total, wanted = sum(size[x["doc_id"]] for x in mine), r["repeats"] * tokens[s]
        assert wanted - 1e-3 <= total <= wanted + 31
        assert max(times[x["doc_id"]] for x in mine) - min(times[x["doc_id"]] for x in mine) <= 1
        # the last epoch is a beginning of its block permutation
        last = max(x["epoch"] for x in mine)
        taken = {x["doc_id"] for x in mine if x["epoch"] == last}
        if 0 < len(taken) < r["docs"]:
            top = max((x["block"], x["key"]) for x in mine if x["epoch"] == last)
            assert sum(size[x["doc_id"]] for x in mine if x["epoch"] == last and (x["block"], x["key"]) != top) < wanted - math.floor(r["repeats"]) * tokens[s] + 1e-3
    reps = [r["repeats"] for r in plan.values() if r["tokens"]]
    assert abs(max(reps) / min(reps) - 2.0) < 1e-6 and abs(min(reps) - 1.0) < 1e-6


def test_mix_below_one_epoch_and_odd_tables(spark):
    rows, docs = mixed_docs(spark, 800)
    total = sum(len(t.split()) for _, _, t, _ in rows)
    drawn, table = mixing.mix(docs, entropy=1.0, budget=total * 0.3, block_docs=20)
    got = drawn.select("doc_id", "source", "text").collect()
    size = Counter()
    for r in got:
        size[r["source"]] += len(r["text"].split())
    for r in table.collect():
        if r["tokens"]:
            assert abs(size[r["source"]] - r["repeats"] * r["tokens"]) <= 31
    assert mixing.mix(docs.limit(0))[0].count() == 0
    bare = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (2, "x", "", 1)], docs.schema)
    assert mixing.mix(bare)[0].count() == 3


# --- WARC --------------------------------------------------------------------


def test_warc_round_trip_and_lookup(spark, tmp_path):
    big = "x" * 1500
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate([big, "small", big, "small", None, "", "é" * 600, big, "\r\n\r\nWARC/1.1\r\n" * 90])]
    rows += [(None, None, big), (7, "http://again", big), (50, "line\nbreak", "y" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    index = warc.write(pages, f"file://{tmp_path}/archive", frame_bytes=2000, bundle_bytes=9000)
    got = warc.read(index).collect()
    assert len(got) == len(rows) == index.count()
    for r in got:
        if r["page_id"] is not None and r["page_id"] != 7:
            data = (rows[r["page_id"]][2] if r["page_id"] < 9 else "y" * 5000) or ""
            assert r["payload_bytes"] == len(data.encode()) and r["payload_digest"] == hashlib.sha1(data.encode()).hexdigest()
            assert (r["record_type"], r["refers_to"]) == (("revisit", 7) if data == big else ("response", None))
            if r["record_type"] == "response":
                assert r["payload"] == data.encode()
    assert sum(r["record_type"] == "response" and r["payload_bytes"] == 1500 for r in got) == 3  # both rows of id 7, and the row without id
    picked = {r["page_id"]: r["payload"] for r in warc.lookup(index.where("page_id IN (8, 50)")).collect()}
    assert picked == {8: rows[8][2].encode(), 50: b"y" * 5000}
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_archives_are_read_in_many_tasks(spark, tmp_path):
    rows = [(i, "u", random.Random(i).randbytes(300).hex()) for i in range(400)]
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), f"file://{tmp_path}/archive", frame_bytes=1200, bundle_bytes=6000)
    assert index.select("bundle").distinct().count() >= 40
    read = warc.read(index, payloads=False)
    tasks = [r for r in read.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    assert len(tasks) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["page_id"] for r in read.collect()) == list(range(400))


def test_bundles_are_plain_zstandard_with_a_seek_table(tmp_path):
    import io

    import zstandard

    index = []
    b = warc._Bundle(f"file://{tmp_path}/b.warc.zst", index)
    for i in range(5):
        b.add(i, "d", bytes([65 + i]) * 1000)
        b.flush()
    b.close()
    raw = (tmp_path / "b.warc.zst").read_bytes()
    assert int.from_bytes(raw[-4:], "little") == 0x8F92EAB1
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(bytes([65 + i]) * 1000 for i in range(5))
    assert [(r[3], r[4]) for r in index] == [(i, 0) for i in range(5)]


# --- nearest neighbours ------------------------------------------------------


def brute_nearest(rows, asked, k):
    out = {}
    for q, v in rows:
        if asked(q):
            near = []
            for i, x in rows:
                if i != q and len(x) == len(v):
                    total = 0.0
                    for a, b in zip(v, x):
                        total += (a - b) * (a - b)
                    near.append((math.sqrt(total), i))
            out[q] = sorted(near)[:k]
    return out


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # a hot vector
    rows += [(600 + i, (np.array(rows[i][1]) * (1 + 1e-6)).astype(np.float32).tolist()) for i in range(50)]
    rows += [(700, [1e30, 0.0, 1e-30] + [0.0] * 9), (710, [1.0, 2.0])]
    bad = [(801, None), (802, []), (803, [0.0] * 12), (804, [float("nan")] * 12), (810, [float("inf")] * 12), (806, [None] * 12), (None, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    want = brute_nearest([(i, [float(np.float32(x)) for x in v]) for i, v in rows], lambda q: q % 10 == 0, 10)
    for tiles in ((1024, 16384), (9, 60)):
        got = {}
        for r in ann.search(df, F.col("id") % 10 == 0, tile_queries=tiles[0], tile_rows=tiles[1]).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert got == {q: n for q, n in want.items() if n}
    assert ann.search(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_neighbours_of_repeated_rows_equal_sql(spark, tmp_path):
    """Ids stored 3 and 15 times, as candidates and as queries, with equal and with other vectors."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    near = lambda v: (np.array(v) + rng.normal(0, 1e-3, 6)).tolist()
    rows += [(7, near(rows[0][1]))] * 3 + [(8, near(rows[0][1]))] * 15 + [(5, rows[0][1])] * 15 + [(9, rows[0][1])]
    rows += [(100, rows[1][1])] * 15 + [(200, rows[2][1])] * 3 + [(300, near(rows[3][1])) for _ in range(15)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = sorted((q, r, i, round(s, 9)) for q, r, i, s in con.execute(queries.OP3_SQL).fetchall())
    df = spark.read.parquet(path)
    for tiles in ((1024, 16384), (2, 20)):
        got = ann.search(df, F.col("id") % 100 == 0, tile_queries=tiles[0], tile_rows=tiles[1]).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == want


def test_int8_products_and_bounds():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(30, 2500)), rng.normal(size=(40, 2500)) * 100
    sa, ca, na, ea = ann.quantised(a)
    sb, cb, nb, eb = ann.quantised(b)
    assert (ann.products(ca, cb) == ca.astype(np.int64) @ cb.astype(np.int64).T).all()
    d = np.sqrt(na[:, None] + nb[None] - 2 * sa[:, None] * sb[None] * ann.products(ca, cb))
    true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (np.abs(true - d) <= ea[:, None] + eb[None] + 1e-9).all()


# --- language model ----------------------------------------------------------


def test_lm_counts_and_base_scores_equal_brute_force(spark):
    docs = [r[:2] for r in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' LIMIT 120").fetchall()]
    docs += [(1001, None), (1002, ""), (1003, " \n"), (1004, "Aa aA AA é É"), (1004, "Aa aA AA é É"), (None, "void"), (1005, "x y  z  "), (1006, "q" * 3000), (1007, "<|endoftext|> <|endoftext|>")]
    docs += [(1008, "un prix : \u00a0 \u00a0\u00a0\u00a0 euros"), (1009, "a\u00a0 \u00a0x \u2003\u3000 \x85 b\x1c \x1d\u2028"), (1010, "\u00a0 " * 50)]
    words = [["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in (t or "").encode().split()] if False else
             [w.decode() for w in (t or "").encode().lower().split()] + ["\n"] for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    old = lm.CHUNK_WORDS
    lm.CHUNK_WORDS = 5000
    try:
        rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    finally:
        lm.CHUNK_WORDS = old
    assert len(rows) == len(docs)
    key = lambda r: (r[0] is None, r[0], *r[1:])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=key)
    want = sorted(((i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for (i, _), ws, h in zip(docs, words, held)), key=key)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] == 1004]
    assert abs(same[0] - same[1]) < 1e-6
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1 << 16)
    counts[rng.choice(50257, 900, replace=False)] = rng.integers(1, 1000, 900)
    m = lm.Model(counts)
    m.weights["o"] = rng.normal(0, 0.5, m.weights["o"].shape).astype(np.float32)
    return m, rng


def test_lm_windows_score_each_id_once_and_sum_to_one():
    m, rng = small_model()
    lengths = np.array([1, 31, 32, 33, 100, 7])
    flat = rng.integers(0, 50257, lengths.sum()).astype(np.uint16)
    slots, target, real, owner = lm.windows(flat, lengths, m)
    assert np.bincount(owner, real.sum(axis=1), len(lengths)).tolist() == lengths.tolist()
    got = m.score(flat, lengths, batch=3)
    # id by id, with the window's own context and no batches
    at = 0
    for text, n in enumerate(lengths):
        ids, total = flat[at : at + n].astype(int), 0.0
        for i in range(n):
            begin = i // lm.STRIDE * lm.STRIDE - lm.CONTEXT
            seen = [m.slot[ids[j - 1]] if j >= 1 else m.slot[50256] for j in range(begin, i + 1)]
            w = m.weights
            q = w["q"][seen[-1]].astype(float)
            a = np.array([q @ w["k"][s] / lm.WIDTH**0.5 + w["distance"][len(seen) - 1 - j] for j, s in enumerate(seen)])
            a = np.exp(a - a.max())
            logits = m.after[seen[-1]].astype(float) + (a / a.sum()) @ w["v"][seen] @ w["o"]
            lp = logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
            total += lp[m.klass[ids[i]]] + m.inside[ids[i]]
        assert abs(total / math.log(10) - got[text]) < 1e-3 * n
        at += n
    # the distribution of the next id sums to one
    logits = m.forward(slots[:1])[0][0, 0].astype(float)
    p = np.exp(logits) / np.exp(logits).sum()
    assert abs((p[m.klass[:50257]] * np.exp(m.inside[:50257])).sum() - 1) < 1e-6


def test_lm_gradients_are_right():
    m, rng = small_model(2)
    slots, target = rng.integers(0, lm.SLOTS, (2, lm.CONTEXT + lm.STRIDE)), rng.integers(0, lm.CLASSES, (2, lm.STRIDE))
    real = rng.random((2, lm.STRIDE)) < 0.8
    m.weights = {n: x.astype(np.float64) for n, x in m.weights.items()}
    m.after = m.after.astype(np.float64)

    def loss():
        logits = m.forward(slots)[0]
        lp = logits - logits.max(axis=2, keepdims=True)
        lp = lp - np.log(np.exp(lp).sum(axis=2, keepdims=True))
        return -(np.take_along_axis(lp, target[:, :, None], 2)[:, :, 0] * real).sum() / real.sum()

    g = m.gradients(slots, target, real)
    for name in ("q", "k", "v", "o", "distance"):
        x = m.weights[name]
        for at in sorted(np.ndindex(*x.shape), key=lambda i: -abs(g[name][i]))[:4]:
            old = x[at]
            x[at] = old + 1e-5
            up = loss()
            x[at] = old - 1e-5
            down = loss()
            x[at] = old
            assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4 + 1e-2 * abs(g[name][at])


def test_lm_works_in_the_same_arrays_and_with_large_weights():
    """A step allocates little beyond its gradients; weights that overflow without a guard take the guarded way."""
    import tracemalloc

    m, rng = small_model(3)
    slots, target = rng.integers(0, lm.SLOTS, (64, lm.CONTEXT + lm.STRIDE)), rng.integers(0, lm.CLASSES, (64, lm.STRIDE))
    real = rng.random((64, lm.STRIDE)) < 0.8
    one = {n: x.copy() for n, x in m.gradients(slots, target, real).items()}
    m.gradients(slots[:5], target[:5], real[:5])  # a shorter block in the same arrays
    tracemalloc.start()
    two = m.gradients(slots, target, real)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * lm.STRIDE * lm.CLASSES * 4  # less than the logits alone
    assert all((one[n] == two[n]).all() for n in one)
    m.weights["q"] = (m.weights["q"] * 1e4).astype(np.float32)
    m.weights["k"] = (m.weights["k"] * 1e4).astype(np.float32)
    large = m.gradients(slots, target, real)
    assert all(np.isfinite(x).all() for x in large.values())


def test_lm_words_and_windows_are_worked_out_in_whole_arrays():
    """Ids are those of the words one by one; Python handles the distinct words only, and windows need few wide arrays."""
    import tracemalloc

    path, rng = tokenizer_path(), np.random.default_rng(1)
    odd = [None, "", " \n", "\t Aa\x0b aA\x0c\rAA é É İ ", "a\x1cb \x1d \x85", "\u00a0 \u00a0\u00a0 x", "q" * 3000, "<|endoftext|>"]
    flat, lengths = lm.packed_ids(odd, path)
    want = [np.concatenate([lm.subwords([w.decode()], path)[0] for w in (t or "").encode().lower().split()] + [[50256]]) for t in odd]
    assert lengths.tolist() == [len(w) for w in want] and flat.tolist() == np.concatenate(want).tolist()
    assert [len(x) for x in lm.packed_ids([], path)] == [0, 0]

    flat, lengths = lm.packed_ids([" ".join(rng.choice([f"w{i}" for i in range(500)], 1000)) for _ in range(200)], path)
    m = lm.Model(np.bincount(flat, minlength=1 << 16))
    tracemalloc.start()
    slots, _, real, _ = lm.windows(flat, lengths, m)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert real.sum() == len(flat) and peak < 32 * len(flat)


def test_lm_far_attention_takes_the_guarded_way():
    """Sums of the attention too small for the narrow division give the guarded gradients."""
    m, rng = small_model(4)
    slots, target = rng.integers(0, lm.SLOTS, (8, lm.CONTEXT + lm.STRIDE)), rng.integers(0, lm.CLASSES, (8, lm.STRIDE))
    real = np.ones((8, lm.STRIDE), bool)
    for far in (-80, 80):
        m.weights["distance"] = np.full(lm.STRIDE + lm.CONTEXT, far, np.float32)
        got = {n: x.copy() for n, x in m.gradients(slots, target, real).items()}
        m.weights["distance"] = np.zeros(lm.STRIDE + lm.CONTEXT, np.float32)  # the same for all: takes no part in the shares
        want = m.gradients(slots, target, real)
        assert all(np.allclose(got[n], want[n], rtol=1e-3, atol=1e-6) for n in got)


def test_lm_learns_held_out_text():
    """Attention beats the table by last id alone on held-out text, which beats frequencies."""
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()
    flat, lengths = lm.packed_ids([t for _, t in rows], tokenizer_path())
    held = np.array([lm.held_out(i) for i, _ in rows])
    train = np.repeat(~held, lengths)
    m = lm.Model(np.bincount(flat[train], minlength=1 << 16))
    first = np.cumsum(lengths) - lengths
    test = np.concatenate([flat[a : a + n] for a, n in zip(first[held], lengths[held])])
    scores = [m.score(test, lengths[held]).sum()]
    before = np.r_[m.slot[50256], m.slot[flat[:-1]]]
    cells = np.bincount((before * lm.CLASSES + m.klass[flat])[train], minlength=lm.SLOTS * lm.CLASSES)
    m.follow(np.arange(len(cells)), cells)
    scores.append(m.score(test, lengths[held]).sum())
    slots, target, real, _ = lm.windows(flat[train], lengths[~held], m)
    order = np.random.default_rng(0).permutation(len(slots))[:8000]
    m.steps(slots[order], target[order], real[order])
    scores.append(m.score(test, lengths[held]).sum())
    assert scores[0] < scores[1] < scores[2]


def test_lm_trains_on_every_window(spark):
    """The slot of a word that stands in one training window only has taken a step."""
    rng = np.random.default_rng(6)
    common, rare = [f"w{i}" for i in range(20)], [str(i) for i in range(100, 160)]
    docs = [[i, " ".join(rng.choice(common, 40))] for i in range(400)]
    train = [d for d in docs if not lm.held_out(d[0])]
    for d, w in zip(train[-len(rare) :], rare):
        d[1] = f"{w} {d[1]}"
    packed = lm.chunks(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).cache()
    m = lm.fit(packed)
    flat, lengths = lm.packed_ids([t for _, t in train], tokenizer_path())
    start = lm.Model(np.bincount(flat, minlength=1 << 16)).weights["v"]
    slots = [m.slot[lm.packed_ids([w], tokenizer_path())[0][0]] for w in rare]
    assert len(set(slots)) == len(rare) and max(slots) < lm.SLOTS_OWN
    assert (m.weights["v"][slots] != start[slots]).any(axis=1).all()


# --- pipeline ----------------------------------------------------------------


def test_pipeline_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "encode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        if name == "mix_sources":
            assert out.select("doc_id").distinct().count() == docs.count()
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    from .test_rows import brute_lines, brute_quality

    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    judged = {r["doc_id"]: r["kept"] for r in queries.QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert not any(judged[i] and brute_quality(t)[5] for i, t, _ in rows)
    rows = [r for r in rows if judged[r[0]]]
    cut = brute_lines([t for _, t, _ in rows], [s for *_, s in rows], 0.002, 5)
    fps = [brute_fingerprint(t) for t in cut]
    classes = brute_classes(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for (i, _, _), f in zip(rows, fps):
        low.setdefault(classes[f], i)
    kept = {i: t for (i, _, _), t in zip(rows, cut) if i in low.values()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(kept)
    whole = Tokenizer.from_file(tokenizer_path())
    for r in got:
        ids = whole.encode(kept[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(kept[r["doc_id"]].encode()).hexdigest()
