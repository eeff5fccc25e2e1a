import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillweave.llm import super_kmers as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """doc_id, text pairs -> id, n_words, n_removed, hash of what is kept, by a table of each window's earliest place."""
    words = [WORD.findall(t or "") for _, t in rows]
    earliest = {}
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - s.WINDOW + 1):
            x, at = tuple(w[k : k + s.WINDOW]), (i is not None, i or 0, k)
            earliest[x] = min(earliest.get(x, at), at)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - s.WINDOW + 1):
            if (i is not None, i or 0, k) > earliest[tuple(w[k : k + s.WINDOW])]:
                gone.update(range(k, k + s.WINDOW))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def ours(df):
    return [tuple(r) for r in s.remove_windows(df).select("_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()]


def texts():
    r = random.Random(5)
    prose = lambda n: [r.choice("alpha béta gamma d e x-y   z".split(" ")) + str(r.randrange(40)) for _ in range(n)]
    passages = [prose(k) for k in (19, 20, 21, 33, 60, 200)]
    out = [None, "", "  \n", "short", " ".join(passages[0])]
    for _ in range(60):
        w = prose(r.randrange(1, 60)) + r.choice(passages) + prose(r.randrange(1, 60))
        out.append("".join(x + r.choice([" ", "\n", "\t ", "\r\n", "\x0b"]) for x in w))
    near = passages[5]
    for k in range(12):
        copy = list(near)
        for _ in range(k):
            copy[r.randrange(len(copy))] = "edit"
        out.append(" ".join(copy))
    return [*out, "the cat " * 100, "a " * 500, "a b c " * 90 + "end", " ".join(near), " ".join(near), " ".join(prose(20_000)), "x" * 100_000 + " y" * 30]


@pytest.mark.parametrize(("hot", "block"), [(s.HOT_RUNS, s.BLOCK_WORDS), (2, 64)])
def test_against_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(s, "HOT_RUNS", hot)
    monkeypatch.setattr(s, "BLOCK_WORDS", block)
    monkeypatch.setattr(s, "BUCKET_STRINGS", 100)
    rows = [(None if k == 9 else min(k, 70), t) for k, t in enumerate(texts())]
    rows += [rows[20], rows[21]]
    df = spark.createDataFrame([(i, t, "y", 1) for i, t in rows], "doc_id long, text string, m string, _th int").repartition(5)
    assert sorted(ours(df), key=str) == sorted(brute(rows), key=str)


def test_ids_of_text(spark):
    t = " ".join(f"w{k}" for k in range(30))
    rows = spark.createDataFrame([("b", t), ("a", t), ("é", t + " more")], "doc_id string, text string")
    assert {r["_id"]: (r.n_words, r.n_removed) for r in s.remove_windows(rows).collect()} == {"a": (30, 0), "b": (30, 30), "é": (31, 30)}


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(s, "gram_hashes", lambda x, n: np.zeros(len(x) - n + 1, dtype=np.uint64))
    r = random.Random(2)
    ids = np.array([r.randrange(2) for _ in range(60)] + [7] * 25 + [r.randrange(2) for _ in range(30)] + [7] * 25, dtype=np.int64)
    at = np.arange(len(ids) - s.WINDOW + 1)
    order, same = s.window_groups(ids, at)
    groups = np.empty(len(at), dtype=int)
    groups[order] = np.cumsum(~same)
    want = {}
    assert all(groups[k] == want.setdefault(tuple(ids[k : k + s.WINDOW]), groups[k]) for k in at)
    assert len(want) == len(set(groups.tolist()))


def test_empty(spark):
    assert s.remove_windows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in s.op11_super_kmers(spark, sf_dir).collect()) == sorted(brute(docs))
