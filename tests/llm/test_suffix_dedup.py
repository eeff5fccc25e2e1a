import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skillweave.llm import suffix_dedup as s


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_linear_grouping_sorts_all_suffixes(text):
    assert s.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_longer_texts():
    r = random.Random(1)
    for text in ([1] * 500, [1, 2] * 300, [r.randrange(1, 30) for _ in range(4000)], [1, 2, 3] * 50 + [1, 2] + [1, 2, 3] * 50):
        assert s.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(texts, span=s.SPAN):
    raw = [(t or "").encode() for t in texts]
    count = {}
    for x in raw:
        for i in range(len(x) - span + 1):
            w = hash(x[i : i + span])
            count[w] = count.get(w, 0) + 1
    out = []
    for x in raw:
        mask = np.zeros(len(x) + 1, dtype=np.int64)
        for i in range(len(x) - span + 1):
            if count[hash(x[i : i + span])] > 1:
                mask[i] += 1
                mask[i + span] -= 1
        gone = np.cumsum(mask)[: len(x)] > 0
        edges = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(x), int(gone.sum()), edges, hashlib.sha256(bytes(b for b, g in zip(x, gone, strict=True) if not g)).hexdigest()))
    return out


def texts():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdé") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    p = [prose(k) for k in (66, 70, 90, 150, 400)]
    out = [None, "", "short", p[0], prose(300)]
    for k in range(40):
        out.append(prose(r.randrange(1, 120)) + r.choice(p) + r.choice(["", " ", "x"]) + prose(r.randrange(1, 120)))
    near = p[4].split(" ")
    for k in range(12):
        copy = list(near)
        for _ in range(k):
            copy[r.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    out += ["ab" * 400, "ab" * 230 + prose(50), "the cat " * 60, prose(100) + "the cat " * 80 + prose(20), p[3], p[3], "q" * 399, "q" * 400, "z" * 5000]
    return out


@pytest.mark.parametrize("max_group", [s.MAX_GROUP, 2])
def test_against_brute_force(spark, monkeypatch, max_group):
    monkeypatch.setattr(s, "MAX_GROUP", max_group)
    monkeypatch.setattr(s, "BUCKET_RUNS", 20)
    t = texts()
    ids = [None if k == 7 else min(k, 50) for k in range(len(t))]
    df = spark.createDataFrame([(a, x, "y") for a, x in zip(ids, t, strict=True)], "doc_id long, text string, m string").repartition(4)
    from pyspark.sql import functions as F

    rows = s.remove_repeats(df).select("_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    assert sorted(map(str, ((r["_id"], r.n_bytes, r.n_removed, r.n_spans, r.h) for r in rows))) == sorted(map(str, ((a, *x) for a, x in zip(ids, brute(t), strict=True))))


@pytest.mark.parametrize("max_group", [s.MAX_GROUP, 1])
def test_periodic_passages_against_brute_force(spark, monkeypatch, max_group):
    from pyspark.sql import functions as F

    monkeypatch.setattr(s, "MAX_GROUP", max_group)
    r = random.Random(8)
    bits = ["the cat ", "ab", "q", "one two three four five six seven "]
    t = ["".join(r.choice(["x", "yz", "", "w"]) + r.choice(bits) * r.randrange(1, 60) for _ in range(r.randrange(2, 6))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").repartition(3)
    rows = s.remove_repeats(df).select("_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    assert {x["_id"]: tuple(x)[1:] for x in rows} == dict(enumerate(brute(t)))


def test_empty(spark):
    assert s.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.op2_suffix_dedup(spark, sf_dir).collect()}
    assert rows == {a: x for (a, _), x in zip(docs, brute([t for _, t in docs]), strict=True)}
