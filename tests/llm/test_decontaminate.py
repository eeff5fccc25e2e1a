import random

import numpy as np

from skillweave.llm import decontaminate as d


def brute_score(item, window):
    best = 0
    h = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if item[i - 1] == window[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_against_the_plain_recurrence():
    r = random.Random(1)
    for _ in range(60):
        a, b = ([r.randrange(4) for _ in range(r.randrange(1, 20))] for _ in range(2))
        assert d.smith_waterman(np.array(a), np.array(b)) == brute_score(a, b)


def make(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items = [[word() for _ in range(30)] for _ in range(5)]
    noise = lambda n: [word() for _ in range(n)]
    edited = list(items[1])
    for k in (3, 9, 15, 21, 27):
        edited[k] = word()
    docs = [
        (0, " ".join(noise(50) + items[0] + noise(50)), {0}),
        (1, " ".join(noise(20) + edited + noise(9)), {1}),
        (2, " ".join(noise(100)), set()),
        (3, " ".join(noise(5) + items[2][:8] + noise(60)), set()),
        (4, None, set()), (5, "", set()), (None, " ".join(items[3]).upper(), {3}), (6, " ".join(noise(30000) + items[4] + items[0]), {4, 0}),
        (7, ", ".join(items[0]), {0}), (7, ", ".join(items[0]), {0}),
    ]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(None, None), (9, "")], "item_id long, text string")
    return docs, spark.createDataFrame([(a, b, "x") for a, b, _ in docs], "doc_id long, text string, _item string"), bench


def test_planted_leaks(spark, monkeypatch):
    docs, table, bench = make(spark)
    expected = sorted((str(a), k) for a, _, ks in docs for k in ks)
    for chars in (d.BROADCAST_CHARS, 0):
        monkeypatch.setattr(d, "BROADCAST_CHARS", chars)
        rows = d.find_leaks(table, bench).collect()
        assert sorted((str(r["_id"]), r.item_id) for r in rows) == expected
    kept = d.decontaminate(table, bench)
    assert kept.columns == table.columns and {r["_item"] for r in kept.collect()} == {"x"}
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]


def test_an_edited_copy_in_many_documents(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(30)]
    edited = [word() if k % 5 == 4 else w for k, w in enumerate(item)]
    rows = [(k, " ".join([word() for _ in range(20)] + edited + [word() for _ in range(20)])) for k in range(50)]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    for extra in ([], [(50, " ".join(item))]):
        docs = spark.createDataFrame(rows + extra + [(99, " ".join(item[:8]))], "doc_id long, text string")
        assert sorted(x["_id"] for x in d.find_leaks(docs, bench).collect()) == [k for k, _ in rows + extra]


def test_both_joins_give_the_same_rows(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = spark.createDataFrame([(900, "one"), (901, "the of"), (902, None)], "item_id long, text string")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").unionByName(short)
    found = []
    for chars in (d.BROADCAST_CHARS, 0):
        monkeypatch.setattr(d, "BROADCAST_CHARS", chars)
        found.append(sorted(map(tuple, d.find_leaks(docs, bench).select("_id", "item_id", "score", "first_word").collect())))
    assert found[0] == found[1] and found[0]


def test_no_leak_is_lost_at_the_bound(spark, monkeypatch):
    """Random edits of items, with common words and without, around the least score; every leak by the plain recurrence is found."""
    r = random.Random(11)
    items, rows = [], []
    for k in range(60):
        m = r.choice([4, 5, 8, 12, 13, 24, 31])
        pool = [f"w{k}x{j}" for j in range(m)] if k % 2 else [f"c{j}" for j in range(12)]
        items.append([r.choice(pool) for _ in range(m)])
    for item in items:
        for share in (0.15, 0.25, 0.4):
            for _ in range(2):
                out = []
                for w in item:
                    x = r.random()
                    out += [] if x < share / 3 else ["new"] if x < 2 * share / 3 else [w, "put"] if x < share else [w]
                rows.append(" ".join(["before"] * r.randrange(30) + out + ["after"] * r.randrange(30)))
    # three of twelve words replaced; a word put in behind every second one of twenty-four
    items += [[f"a{j}" for j in range(12)], [f"b{j}" for j in range(24)]]
    rows += [" ".join("no" if j in (2, 5, 8) else f"a{j}" for j in range(12)), " ".join(f"b{j} in" if j % 2 else f"b{j}" for j in range(24))]
    expected = set()
    for a, text in enumerate(rows):
        w = d.passage_words(text)
        for k, item in enumerate(items):
            i = d.passage_words(" ".join(item))
            if np.intersect1d(i, w).size and d.smith_waterman(i, w) >= d.MIN_SCORE * len(i):
                expected.add((a, k))
    assert {(len(rows) - 2, 60), (len(rows) - 1, 61)} <= expected and 200 < len(expected) < len(rows) * len(items) / 2
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    for chars in (d.BROADCAST_CHARS, 0):
        monkeypatch.setattr(d, "BROADCAST_CHARS", chars)
        assert {(x["_id"], x.item_id) for x in d.find_leaks(docs, bench).collect()} == expected


def test_empty_tables(spark, monkeypatch):
    docs, table, bench = make(spark)
    monkeypatch.setattr(d, "BROADCAST_CHARS", 0)
    assert d.find_leaks(table.limit(0), bench).count() == 0
    monkeypatch.setattr(d, "BROADCAST_CHARS", -1)
    assert d.find_leaks(table, bench.limit(0)).count() == 0
    monkeypatch.undo()
    assert d.find_leaks(table.limit(0), bench).count() == 0
    assert d.find_leaks(table, bench.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    words = {r.item_id: d.passage_words(r.text) for r in items}
    expected = set()
    for r in docs:
        w = d.passage_words(r.text)
        own = set(w.tolist())
        for k, item in words.items():
            if len(own & set(item.tolist())) >= 0.5 * len(set(item.tolist())) and d.smith_waterman(item, w) >= d.MIN_SCORE * len(item):
                expected.add((r.doc_id, k))
    found = {(r.doc_id, r.item_id) for r in d.op6_decontaminate(spark, sf_dir).collect()}
    assert len(expected) > 0
    assert found == expected
