"""Row-wise operators against brute force on small texts: quality rules,
license scans, line dedup, personal data, BPE."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import bpe, licenses, lines, pii, quality

SCHEMA = "doc_id long, text string, source string, n_words int, quality int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, sources=None):
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, s, 7, 1) for i, (t, s) in enumerate(zip(texts, sources))], SCHEMA)


def odd_texts():
    rng = random.Random(4)
    words = ["the", "of", "a", "und", "Der.", "x#", "<b>", "|", "naïve", "語", "%%%", "GNU", "Apache", "license"]
    blanks = [" ", "  ", "\n", "\t", "\x0b", "\n\n", "\r\n", " \n "]
    out = [None, "", " ", "\n\t\x0b\x0c\r", "one", "a b c d e f g h", "\n".join(["same line"] * 40), "a " * 30]
    for n in (10, 30, 80, 200):
        for _ in range(6):
            out.append("".join(rng.choice(words) + rng.choice(blanks) for _ in range(n)))
            part = " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
            out.append(part + " " + part[: len(part) // 2] + " and " + part)
    out.append(" ".join(f"w{i % 4999}" for i in range(40_000)))  # long, with repeats far apart
    return out


def brute_quality(t):
    t = t or ""
    ws = WORD.findall(t)
    ls = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = set()
    for i in range(len(ws) - 7):
        if grams[tuple(ws[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    n = len(ws)
    bad = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls)), len(covered), bad


def test_quality_measures_equal_brute_force(spark):
    texts = odd_texts()
    rows = quality.judge(frame(spark, texts)).select("doc_id", "quality.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        m = r["measures"]
        got = tuple(m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) + (r["base_failed"],)
        assert got == brute_quality(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert r["kept"] == (not r["broken"])


def test_quality_keeps_columns_rows_and_empty_tables(spark):
    good = "The cat sat with the dog and it was a fine day for all of them, " + " ".join(f"as told by one{i}" for i in range(9))
    docs = frame(spark, [good, good, None, "### " * 50])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1]
    assert quality.keep_good(docs.limit(0)).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


LICENSE_TEXTS = [
    None, "", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License. mit license",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0. cc_by cc  by CC-BY",
    "gnu general public license gnu general public license", "cc é by", "écc by", "nothing here", "The Apache\nLicense; apache-license",
    "SPDX-License-Identifier: GPL-3.0-only", "http://www.apache.org/licenses/LICENSE-2.0", "All rights reserved. Copyright (c) 2020 X",
    "Permission is hereby granted, free of charge", "under the terms of the Mozilla Public License 2.0 or later", "mit " * 50 + "license",
    "BSD-3-Clause license", "cc by " * 700 + "mit license",
]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_spans(ws):
    """All rules at all places, leftmost and not overlapping per rule, then containment."""
    norm = " " + " ".join(ws) + " "
    found = []
    for i, r in enumerate(licenses.RULES):
        if r.keyword in norm:
            for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm):
                start = norm[: m.start()].count(" ") - 1
                found.append((start, -(start + len(m.group().split(" "))), -r.priority, i))
    found.sort()
    kept, top = [], -1
    for start, end, _, i in found:
        if -end > top:
            kept.append((start, -end, licenses.RULES[i].label))
            top = -end
    return kept


def test_license_scan_equals_brute_force(spark):
    rows = licenses.scan(frame(spark, LICENSE_TEXTS), out="quality").select("doc_id", "quality.*").collect()
    assert len(rows) == len(LICENSE_TEXTS)
    for r in rows:
        ws = words_of(LICENSE_TEXTS[r["doc_id"]])
        assert r["n_words"] == len(ws)
        base = sorted((i, label) for p, label in licenses.BASE for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split())
        assert sorted((x["start"], x["label"]) for x in r["base"]) == base
        assert [(x["start"], x["end"], x["label"]) for x in r["spans"]] == brute_spans(ws), LICENSE_TEXTS[r["doc_id"]]


def test_license_rules_number_hundreds_and_pass_the_keyword_gate():
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    assert len(licenses.RULES) > 200
    for r in licenses.RULES:

        @settings(max_examples=8, database=None, deadline=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(r.pattern, fullmatch=True))
        def gated(s):
            s = s.strip()
            cc = re.search("cc[^0-9a-z]+(?:by|zero)|cc0", s)
            assert cc or any(k in s for k in licenses.KEYWORDS), (r, s)
            assert r.keyword in s, (r, s)

        gated()


def test_license_scan_is_native_and_takes_empty_tables(spark):
    found = licenses.scan(frame(spark, LICENSE_TEXTS).limit(0))
    assert found.count() == 0
    plan = licenses.scan(frame(spark, LICENSE_TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def brute_lines(texts, hosts, ratio, least):
    strip = " \t\n\x0b\x0c\r"
    pages, per = Counter(hosts), Counter()
    for t, h in zip(texts, hosts):
        per.update({(h, x.strip(strip)) for x in (t or "").split("\n")})
    out = []
    for t, h in zip(texts, hosts):
        ls = (t or "").split("\n")
        bad = {x for x in ls if x.strip(strip) and per[(h, x.strip(strip))] >= least and per[(h, x.strip(strip))] > ratio * pages[h]}
        kept = [x for x in ls if x not in bad]
        whole = not any(x.strip(strip) for x in kept)
        out.append(t if whole or not bad else "\n".join(kept))
    return out


def test_planted_lines_are_cut_in_every_source(spark):
    """Lines repeated over distinct texts go, in large and small sources; lines of single documents stay."""
    rng = random.Random(12)
    texts, sources = [], []
    for source, n in (("large", 2000), ("middle", 400), ("small", 12)):
        for i in range(n):
            planted = [f"planted {k}" for k in range(3) if rng.random() < (0.5 if n < 100 else 0.03)]
            texts.append("\n".join([f"own {source} {i}", *planted, f"more {source} {i}"]))
            sources.append(source)
        texts += [f"planted 0\nplanted 1\nplanted 2\nlast {source} {k}" for k in range(5)]
        sources += [source] * 5
    got = {r["doc_id"]: r["text"] for r in lines.cut_lines(frame(spark, texts, sources), "source").collect()}
    for i, t in enumerate(texts):
        assert got[i] == "\n".join(x for x in t.split("\n") if not x.startswith("planted"))


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    texts, hosts = [], []
    for i in range(120):
        h = rng.choice(["hot", "hot", "small", None])
        ls = ["Home | About"] * rng.randint(0, 1) + [f"line {i}", " ", f"shared {i % 7}"] + ["  footer "] * rng.randint(0, 2)
        texts.append("\n".join(rng.sample(ls, len(ls))))
        hosts.append(h)
    texts += [None, "", "Home | About", "footer\nfooter"]
    hosts += ["hot", None, "hot", "hot"]
    got = lines.cut_lines(frame(spark, texts, hosts), "source", out="n_words", ratio=0.2, min_pages=4)
    assert sorted(got.columns) == sorted(["doc_id", "text", "source", "quality", "n_words"])
    want = brute_lines(texts, hosts, 0.2, 4)
    rows = got.collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(want))
    assert lines.cut_lines(frame(spark, texts, hosts).limit(0), "source").count() == 0


def brute_pii(t):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])]
        if 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_pii_equals_brute_force():
    rng = random.Random(5)
    parts = list("a.b@-_%+ 0129()") + ["@", "@", "com", ".", "4111111111111111", "5500 0000 0000 0004", "+1 (555) 555-7713", "1.2.3.4", "é", "9" * 30]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_pii(t), t


def test_pii_spans_keep_base_and_add_taken_kinds(spark):
    secret = 'token = "99168226c4d3cee7e953ef6959c77215d0cbdfc9"'
    texts = [None, "", f"my key: {secret}", "mail a.b@c.org now", "é call +1 (017) 555-7713 or 9807915762804490", "commit 1234", "Dr. Anna Schmidt wrote"] * 3
    rows = pii.detect(frame(spark, texts)).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(texts)))
    kinds = set()
    for r in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        assert [s for s, x in zip(spans, r["spans"]) if x["base"]] == brute_pii(texts[r["id"]] or "")
        assert spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))
        kinds |= {s[0] for s in spans}
    assert {"email", "phone", "secret", "person"} <= kinds
    assert pii.detect(frame(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("n", [128, 129, 300, 100_000])
def test_pii_spans_hold_whole_secrets_and_names(spark, n):
    rng = random.Random(n)
    # every second one a letter: no cards or addresses inside, which as base spans would take the place
    key = "".join(rng.choice("abcdef" if i % 2 else "0123456789") for i in range(n))
    word = "".join(rng.choice("ABCxyz" if i % 2 else "0189._-") for i in range(n))
    texts = [f"see {key} there", f"my token = {word} there", f"my token = '{key}' there", f"Dr. A{'n' * n} wrote"]
    want = [("secret", 4, 4 + n), ("secret", 11, 11 + n), ("secret", 12, 12 + n), ("person", 0, 5 + n)]
    for t, (kind, a, b) in zip(texts, want):
        spans = [(pii.KINDS[s[0]], s[1], s[2]) for s in pii.candidates_of(t)]
        assert [s for s in spans if s[0] == kind] == [(kind, a, b)]
    found = {r["id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.detect(frame(spark, texts[:3] * 5)).collect()}
    assert all(want[2] in found[i] for i in range(2, 15, 3))


def test_expectation_maximisation_finds_good_and_bad_labelers():
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    codes = np.full(4000, 4)
    for right in (0.95, 0.9, 0.8, 0.55, 0.7):
        vote = np.where(rng.random(4000) < right, truth, ~truth)
        codes = codes << 2 | np.where(vote, 1, 2)
    seen, counts = np.unique(codes << 4, return_counts=True)
    table, p = pii.reliabilities(seen, counts.astype(float))
    good = [table[j, 1, 1] for j in range(5)]
    assert good[0] > good[2] > good[3] and abs(good[0] - 0.95) < 0.03
    verdict = dict(zip(seen, pii.features(seen) @ pii.train(seen, counts.astype(float), p) > 0))
    assert np.mean([verdict[c] == t for c, t in zip(codes << 4, truth)]) > 0.93


def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(bpe.tokenizer_path())
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'", "1", "23", ".", "!!", "é", "ß", "中", "。", "<|endoftext|>", "<|end", "\xa0", "x" * 50, " " * 30,
             "😀", "I'll", "-", "|", "\r\n", "Ünï", "́", "Ƛ"]
    small = bpe.Encoder(bpe.tokenizer_path(), cut_bits=3, store_bytes=3000)
    shared = "A passage that many texts share, word for word, with marks; and numbers 12345. " * 20
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [shared + str(i) for i in range(20)] + ["a" * 50_000, "ab " * 20_000]
    for t in texts:
        want = whole.encode(t, add_special_tokens=False).ids
        assert small.encode(t) == want
        assert small.decode(want) == whole.decode(want, skip_special_tokens=False)
    assert small.held <= 3000
    docs = frame(spark, [*texts[:50], None, ""])
    rows = bpe.round_trip(docs).collect()
    for r in rows:
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, out="quality"), "quality", "again").where(F.coalesce("text", F.lit("")) != F.col("again"))
    assert back.count() == 0
    assert bpe.encode(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "short", "é" * 5000, "z" * 40_000])
def test_chunks_cover_the_text_at_character_starts(text):
    raw, at = text.encode(), 0
    for end in bpe.cuts(raw):
        raw[at:end].decode()
        assert at < end <= at + bpe.MAX_CHUNK
        at = end
    assert at == len(raw)


def test_clashing_columns_and_empty_tables(spark, tmp_path):
    """Operators that read their own columns only: names of their helpers in the input, and no rows."""
    from cadenza.llm import simhash, warc

    rows = [(1, "a b c d e you@site.org", "x", 1), (2, "a b c d e you@site.org", "x", 2), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, fp int").withColumn("spans", F.lit(7)).withColumn("root", F.lit(1))
    found = {(r["id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1)} <= found and len(found) == 3
    assert sorted(len(r["spans"]) for r in pii.detect(docs).collect()) == [0, 1, 1]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and pii.detect(docs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "u", "p" * 50, "x", 3)], "page_id long, url string, html string, payload string, size int").withColumn("digest", F.lit("d"))
    (r,) = warc.read(warc.write(pages, f"file://{tmp_path}/w")).collect()
    assert (r["page_id"], r["payload"], r["payload_bytes"]) == (1, b"p" * 50, 50)
