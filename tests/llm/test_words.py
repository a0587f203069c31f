"""Periodic runs, toxicity and spelling variants against brute force and on
held-out labels."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import queries, runs, toxicity, variants

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


# --- periodic runs -----------------------------------------------------------


def brute_lyndon(t):
    n = len(t)
    return [max(m for m in range(1, n - i + 1) if all(t[i : i + m] < t[i + k : i + m] for k in range(1, m))) for i in range(n)]


def brute_runs(t, least):
    n, found = len(t), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s < n - q:
            if t[s] != t[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and t[e] == t[e + q]:
                e += 1
            u = t[s : e + q]
            if len(u) >= max(least, 2 * q) and not any(u[r:] == u[: len(u) - r] for r in range(1, q)):
                found.append((s, len(u), q))
            s = e + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rng, n):
    t = [rng.randrange(rng.choice([1, 2, 3, 8, 50])) for _ in range(rng.randrange(n))]
    for _ in range(rng.randrange(3)):
        if t:
            i = rng.randrange(len(t))
            t[i:i] = t[i : i + rng.randrange(1, 12)] * rng.randrange(2, 6)
    return t


def test_baier_grouping_gives_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(300):
        t = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(24))]
        assert runs.lyndon_lengths(t) == brute_lyndon(t)


@pytest.mark.parametrize("least", [2, 3, 4, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(40):
        texts = [periodic(rng, 90) for _ in range(rng.randrange(1, 6))]
        got = runs.text_runs([[b"%d" % x for x in t] for t in texts], least)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(t, least) for t in texts]


def test_wrong_hashes_are_found_out(monkeypatch):
    real = runs._prefix_hashes
    seeds = []

    def poor(x, seed):
        seeds.append(seed)
        h, p = real(x, seed)
        return (h * np.uint64(0), p) if seed == 0 else (h, p)

    monkeypatch.setattr(runs, "_prefix_hashes", poor)
    t = [1, 2, 3, 4] * 5 + [5, 6] * 9
    assert [tuple(r) for r in runs.text_runs([t])[0].tolist()] == brute_runs(t, 12)
    assert seeds[:2] == [0, 1]


def collapse(ws, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def test_run_rows_of_odd_texts(spark):
    texts = [None, "", " \n\t", "one", "a " * 30, "a " * 30, "\xa0 " * 12 + "\x1f", "x y z " * 4 + "w", " ".join(f"w{i % 5000}" for i in range(30_000)), "語 é " * 8]
    rows = [(None if i == 3 else i, t, i) for i, t in enumerate(texts)] + [(4, texts[4], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.find(df).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ws = WORD.findall(t or "")
        found = brute_runs(ws, 12) if len(ws) < 1000 else [(0, 30_000, 5000)]
        want.append((i, len(ws), found, collapse(ws, found)))
    assert got == sorted(want, key=str)
    assert runs.find(df.limit(0)).count() == 0


def test_op11_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_lyndon_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ws = WORD.findall(d["text"] or "")
        n, h = len(ws), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
        if n > 1500:
            continue  # slow by brute force
        found = brute_runs(ws, 12)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        r = got[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert r["collapsed_sha256"] == sha(collapse(ws, found))


# --- spelling variants -------------------------------------------------------


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def made_words(rng, letters, n, longest):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)})


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(60):
        t = np.array([rng.randrange(1, rng.choice([2, 3, 60])) for _ in range(rng.randrange(80))] + [0])
        assert variants.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_schemes_find_each_near_word_once():
    rng = random.Random(3)
    for _ in range(60):
        words = made_words(rng, rng.choice(["ab", "abc", "abcdé"]), rng.randint(2, 120), 8)
        found = []
        for turned in (False, True):
            texts = [w[::-1] for w in words] if turned else words
            index = variants.Index(texts)
            length = np.array([len(w) for w in words])
            half = length - length // 2 if turned else length // 2
            middle = half + (length - half) // 2
            for start, end in ((half, middle), (middle, length)):
                q, v = variants.one_error(index, texts, start, end, turned)
                found += [(words[a], words[b]) for a, b in zip(q.tolist(), v.tolist())]
        assert len(found) == len(set(found))
        assert set(found) == {(a, b) for a in words for b in words if one_apart(a, b)}


@pytest.mark.parametrize("hot", [50_000, 30, 3])
def test_near_words_equal_brute_force_whatever_is_refined(spark, hot):
    rng = random.Random(5)
    words = made_words(rng, "abcé", 500, 6) + ["abcabc" * 50, "abcabc" * 50 + "a"]
    n = {w: rng.choice([2, 3, 30, 400]) for w in words}
    vocab = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in variants.near_words(vocab, 1, part_rows=400, hot_rows=hot).collect()}
    want = {}
    for w in words:
        near = [x for x in words if one_apart(w, x)]
        if near:
            top = max(n[x] for x in near)
            want[w] = (len(near), top, min(x for x in near if n[x] == top))
    assert got == want


def test_forms_are_followed_to_their_roots(spark):
    chain = [("abcdefgh", 100_000), ("abcdefgx", 10_000), ("abcdefxx", 1000), ("abcdexxx", 100), ("abcdxxxx", 10), ("zzzzzzzz", 10)]
    texts = [(i, " ".join([w] * n), "x") for i, (w, n) in enumerate(chain)] + [(None, None, "x"), (9, "", "x"), (10, "Ab1 short +-", "x")]
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in variants.group(spark.createDataFrame(texts, "doc_id long, text string, word string")).collect()}
    want = {}
    for k, (w, n) in enumerate(chain[:5]):
        form = chain[k - 1] if k else (None, None)
        want[w] = (n, 1 + (0 < k < 4), *form, "abcdefgh")
    want["zzzzzzzz"] = (10, 0, None, None, "zzzzzzzz")
    assert got == want


def test_empty_vocabulary(spark):
    assert variants.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- toxicity ----------------------------------------------------------------


def brute_kernel(a, b):
    def weights(s):
        points = [(-1, "^")] if s else []
        letters = [(i, c) for i, c in enumerate(s) if c.isalpha()]
        if not letters:
            return {}
        points = [(letters[0][0] - 1, "^"), *letters, (letters[-1][0] + 1, "$")]
        out = {}
        for i in range(len(points)):
            for j in range(i + 1, len(points)):
                for k in range(j + 1, len(points)):
                    far = points[k][0] - points[i][0]
                    if far < toxicity.WINDOW:
                        key = points[i][1] + points[j][1] + points[k][1]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (far - 2)
        return out

    x, y = weights(a), weights(b)
    size = lambda v: sum(z * z for z in v.values()) ** 0.5
    return sum(x[k] * y.get(k, 0) for k in x) / (size(x) * size(y)) if x and y else 0.0


def test_kernel_equals_brute_force():
    words = ["idiot", "i-d-i-o-t", "idioot", "(scum)", "a", "--", "banana", "worthlessness", "12ab34"]
    owner, code, weight = toxicity.features([w.encode() for w in words])
    table = np.zeros((len(words), toxicity._CODES))
    table[owner, code] = weight
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(table @ table.T, want)
    margins = toxicity.Table(table[0] * 3, -1.0).margins([w.encode() for w in words])
    assert np.allclose(margins, np.maximum(-1, [3 * brute_kernel("idiot", w) - 1 for w in words]))


def test_spelled_out_words_are_units():
    assert toxicity.units("You I d\ti o t, é") == {b"you", b"i", b"d", b"o", b"t,", "é".encode(), b"idio"}
    assert toxicity.units(None) == toxicity.units(" \n") == set()


def toxic_rows(n=900):
    rng = random.Random(8)
    part = ["an", "the", "er", "ing", "st", "re", "on", "ou", "ea", "nd", "ble", "tion"]
    word = lambda: "".join(rng.choice(part) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(n):
        ws = [word() for _ in range(rng.randint(5, 60))]
        toxic = int(i % 4 == 0)
        if toxic:
            ws.insert(rng.randrange(len(ws)), rng.choice(["moron", "Idiot,", "scum", "scumbags"]))
        rows.append((i, " ".join(ws), toxic))
    return rows


def test_toxicity_on_held_out_texts_and_odd_rows(spark):
    rows = toxic_rows()
    odd = [(None, "you idiot", None), (2000, None, None), (2001, "", None), (2002, "i d i o t", None), (2003, "the i.d.i.o.t thing", None), (2004, "an idi*ot", None), (2005, "the stre " * 20_000 + "moron", None)]
    docs = spark.createDataFrame([(i, t, 0.5, "u") for i, t, _ in rows + odd + odd[:1]], "doc_id long, text string, score double, unit string")
    labels = spark.createDataFrame([(i, y, None) for i, _, y in rows] + [(None, 1, None), (7, None, None)], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    got = toxicity.detect(docs, model).collect()
    assert len(got) == len(rows) + len(odd) + 1
    by_id = {r["id"]: r for r in got}
    for i, _, y in rows:
        if zlib.crc32(str(i).encode()) % 3 == 1:
            assert by_id[i]["predicted"] == y, by_id[i]
    assert [by_id[i]["predicted"] for i in (None, 2000, 2001, 2002, 2003, 2004, 2005)] == [1, 0, 0, 1, 1, 1, 1]
    assert by_id[2000]["margin"] == by_id[2001]["margin"] == -1.0 and 0 < by_id[2000]["score"] < 0.1
    assert by_id[2004]["unit"] == "idi*ot"


def test_toxicity_never_learns_from_held_out_labels(spark):
    rows = toxic_rows(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    out = lambda turned: {
        r["id"]: r["score"]
        for r in toxicity.detect(docs, toxicity.fit(docs, spark.createDataFrame([(i, 1 - y if turned and zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows], "doc_id long, toxic int"))).collect()
    }
    assert out(False) == out(True)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you moron"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert [(r["score"], r["predicted"]) for r in toxicity.detect(docs, None).collect()] == [(0.0, 0)] * 2
    assert toxicity.detect(docs.limit(0), None).count() == 0


def test_toxicity_on_held_out_documents(spark):
    at = "/root/testdata/sf0.1"
    scored = queries.QUERIES["op12_toxicity_kernel"](spark, at)
    labels = spark.read.parquet(f"{at}/labels.parquet").select("doc_id", "toxic")
    conditions = ("toxic = 1 AND predicted = 1", "toxic = 1", "toxic = 0 AND predicted = 1", "toxic = 0")
    n = scored.join(labels, "doc_id").where("held_out").agg(*(F.count_if(F.expr(c)) for c in conditions)).first()
    assert n[0] >= 0.65 * n[1] and n[2] <= 0.01 * n[3], tuple(n)
