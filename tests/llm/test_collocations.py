import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference

from skillweave.llm import collocations as c


def brute(rows, least, top):
    """lang, rank, phrase, a, l, r, n, score of all rows (text, lang), by counting every phrase."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                for k in range(len(w) - size + 1):
                    f.setdefault(lang, Counter())[tuple(w[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in found.items()):
                continue
            s, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus():
    r = random.Random(4)
    words = ["New", "york", "City", "été", "ÉTÉ", "a-b", "#1", " ", "x" * 300, *[f"w{k}" for k in range(30)]]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = [(None, "en"), ("", None), ("...", "de"), ("new york city", None)]
    for k in range(300):
        text = "".join(w + r.choice([" "] * 8 + ["\t", ". ", ",", "\n", "  ", ":"]) for w in r.choices(words, weights, k=r.randrange(1, 60)))
        rows.append((text + r.choice(["", "new york city hall", "los angeles"]), r.choice(["en", "en", None, "de"])))
    return [*rows, ("rare pair " * 3000, "en"), ("y" * 50_000 + " z", "en")]


@pytest.mark.parametrize("bounds", [{}, {"head_words": 12, "head_pairs": 15, "side": 4, "held_numbers": 300, "block_bytes": 64, "max_cells": 8, "held_words": 20}, {"head_pairs": 3, "max_word_bytes": 2, "dense_share": 0}])
def test_against_brute_force(spark, bounds):
    rows = corpus()
    df = spark.createDataFrame([(t, x, "q", 7) for t, x in rows], "text string, lang string, word string, n int").repartition(4)
    for top in (2000, 25):
        got = sorted(tuple(r) for r in c.collocations(df, least=3, top=top, bounds=c.Bounds(**bounds)).collect())
        assert got == brute(rows, 3, top)


def test_counts_in_dense_and_sparse_tiles_agree():
    r = np.random.default_rng(1)
    cells, counts = r.integers(0, 64, 500), r.integers(1, 9, 500)
    assert all((a == b).all() for a, b in zip(c.count_cells(cells, counts, 64), c.count_cells(cells, counts), strict=True))


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("complete", [True, False])
def test_a_block_is_cut_into_tiles_within_a_few_times_its_size(complete):
    """Four million numbers (17 MB) and two million ranked pairs, as on the tool's large table."""
    r = np.random.default_rng(2)
    bounds = c.Bounds()
    x = (r.random(bounds.held_numbers + 1) ** 4 * 50_000).astype(np.int32)
    keys = np.unique(x[:-1].astype(np.int64) << 32 | x[1:])
    keys = r.permutation(keys)[: len(keys) if complete else len(keys) // 2]
    pairs = SimpleNamespace(value=c.Pairs(pa.table({"lang": pa.array(["en"] * len(keys)).dictionary_encode(), "i": keys >> 32, "j": keys & 0xFFFFFFFF})))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([x.tobytes()])], names=["lang", "numbers"])
    for find in (None, pairs):
        n = []
        run = c._tile_batches(find, complete or find is None, 64, bounds)
        assert peak_mb(lambda: n.extend(int(c._unpacked(t, k).sum()) for b in run(iter([batch])) for t, k in zip(b.column("counts").to_pylist(), b.column("n_cells").to_pylist(), strict=True))) < 150
        assert sum(n) == (len(x) - 1 if find is None else len(x) - 2)


def test_counts_travel_in_as_few_bytes_as_they_need():
    for most, size in ((1, 1), (255, 1), (256, 2), (70_000, 4), (1 << 40, 8)):
        counts = np.array([1, most, 1])
        assert len(c._packed(counts)) == 3 * size and (c._unpacked(c._packed(counts), 3) == counts).all()
    tiles = [("en", False, 0, 0, np.array([3, 5], np.int32).tobytes(), c._packed(np.array(x))) for x in ([250, 1], [250, 1 << 40], [250, 9])]
    for share in (0, 1 << 40):
        ((*_, cells, counts),) = c._merged(pa.Table.from_batches([c._tile_batch(tiles)]), c.Bounds(side=4, dense_share=share))
        assert cells.tolist() == [3, 5] and counts.tolist() == [750, (1 << 40) + 10]


def test_a_large_tile_is_merged_where_its_parts_lie():
    bounds = c.Bounds()
    side, r = bounds.side, np.random.default_rng(3)
    parts = [np.sort(r.choice(side * side, 1 << 20, replace=False)).astype(np.int32) for _ in range(12)]
    rows = pa.Table.from_batches([c._tile_batch([("en", False, 0, 0, p.tobytes(), np.full(len(p), 2).tobytes()) for p in parts])])
    found = []
    assert peak_mb(lambda: found.extend(c._merged(rows, bounds))) < 150
    expected = np.bincount(np.concatenate(parts)) * 2
    ((*_, cells, counts),) = found
    assert (cells == np.flatnonzero(expected)).all() and (counts == expected[cells]).all()


def test_scores_past_64_bits(spark):
    a, left, right = 3_000_000_000_000, 3_500_000_000_017, 4_000_000_000_039
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(c._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_empty(spark):
    assert c.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_its_twin(spark, folder):
    assert difference(c.op13_collocations(spark, folder), connect(folder), c.ORACLES["op13_collocations"]) is None
