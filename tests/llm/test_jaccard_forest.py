import random

import numpy as np

from skillweave.llm import jaccard_forest as j


def brute(rows):
    """class of each row as a set of row numbers, and its links."""
    sets = [set(j.shingles(t)[0].tolist()) for _, t in rows]
    near = [[k for k in range(len(rows)) if k != i and sets[i] and len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k])] for i in range(len(rows))]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *[root[k] for k in near[i]]]) for i in range(len(rows))]
    return root, [len(x) for x in near]


def check(spark, rows, found):
    root, links = brute(rows)
    key = {}
    for i, (a, _) in enumerate(rows):
        key.setdefault(root[i], []).append(a)
    expected = sorted((str(a), str(min((x for x in key[root[i]] if x is not None), default=None)), links[i]) for i, (a, _) in enumerate(rows))
    assert sorted((str(r["_id"]), str(r["class_id"]), r["n_links"]) for r in found) == expected


def table(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    base = [[word() for _ in range(200)] for _ in range(6)]
    rows = []
    for k, b in enumerate(base):
        for c in range(8):
            t = list(b)
            for _ in range(c if k else 0):
                t[r.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
    rows += [(100, None), (101, ""), (102, "  \n"), (103, "one two"), (104, "one  Two"), (None, " ".join(base[1])), (105, rows[9][1]), (105, rows[9][1])]
    rows.append((106, " ".join(word() for _ in range(30000))))
    return rows


def test_classes_and_links_against_brute_force(spark, monkeypatch):
    rows = table(spark)
    df = spark.createDataFrame([(a, t, 1) for a, t in rows], "doc_id long, text string, _id int").repartition(5)
    for size in (j.BLOCK_TEXTS, 3):
        monkeypatch.setattr(j, "BLOCK_TEXTS", size)
        check(spark, rows, j.similar_classes(df).collect())
    kept = j.keep_first(df)
    assert kept.columns == df.columns and {r["_id"] for r in kept.collect()} == {1}
    root, _ = brute(rows)
    blank = sum(not (t or "").strip() for _, t in rows)
    assert kept.count() == len({root[i] for i, (_, t) in enumerate(rows) if (t or "").strip()}) + blank


def test_the_prefix_is_shortened_to_what_the_data_needs():
    none, alike, mixed = np.empty(0), np.full(50, 0.97), np.r_[np.full(50, 0.97), np.full(10, 0.8), np.full(500, 0.3)]
    for s in (none, alike, mixed):
        d = j.match_depth(s, 0.8)
        linked = s[s >= 0.8] if len(s) else np.array([0.8])
        assert j.recall_at(d, linked).mean() >= j.TARGET_RECALL - 1e-4
        assert d == j.FULL_DEPTH or j.recall_at(d + 1, linked).mean() < j.TARGET_RECALL
    assert j.match_depth(alike, 0.8) > j.match_depth(mixed, 0.8) >= j.match_depth(none, 0.8)


def test_minhash_estimates_jaccard():
    r = np.random.default_rng(3)
    x = r.integers(0, 1 << 63, 1200, dtype=np.int64).view(np.uint64)
    f = j.Forest(2000, 1)
    a, b = (np.frombuffer(f.signature(y), dtype=np.uint8) for y in (x[:1000], x[200:]))
    assert abs((a == b).mean() - 800 / 1200) < 0.06


def test_trie_neighbours_against_all_pairs(spark):
    """Vertices that share a prefix of a depth in some tree are connected by neighbours of that depth, across ranges too."""
    r = random.Random(8)
    sig = [bytes(r.choice((1, 2)) for _ in range(j.TREES * j.FULL_DEPTH)) for _ in range(60)]
    sig += [sig[0]] * 20 + [sig[1][:37] + sig[2][37:]]
    vertices = spark.createDataFrame(list(enumerate(sig)), "wh long, sig binary")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = [(x.a, x.b, x.depth) for x in j.trie_neighbours(vertices).collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def classes(edges):
        root = list(range(len(sig)))
        for _ in sig:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    label = lambda k, t, d: sig[k][t * j.FULL_DEPTH : t * j.FULL_DEPTH + d]
    for d in range(j.LEAST_DEPTH, j.FULL_DEPTH + 1):
        every = [(a, b) for a in range(len(sig)) for b in range(a) if any(label(a, t, d) == label(b, t, d) for t in range(j.TREES))]
        assert classes([(a, b) for a, b, depth in found if depth >= d]) == classes(every)
    assert all(any(label(a, t, d) == label(b, t, d) for t in range(j.TREES)) for a, b, d in found)


def test_the_depth_comes_from_all_trie_neighbours(spark):
    """5000 pairs, well past any sample: each is counted once, whichever of its two texts comes first and in however many trees they meet."""
    r = np.random.default_rng(6)
    n, size = 5000, j.TREES * j.FULL_DEPTH
    sig = r.integers(0, 256, (n, size), dtype=np.uint8)
    other = sig.copy()
    other[np.arange(n), r.integers(0, size, n)] += np.uint8(1)
    other[: n // 10, :48] += np.uint8(2)
    rows = [(k, x.tobytes()) for k, x in enumerate(np.vstack([sig, other]))]
    near = [(k, n + k, 10) for k in range(n)] + [(n + k, k, 10) for k in range(0, n, 2)]
    vertices, neighbours = spark.createDataFrame(rows, "wh long, sig binary"), spark.createDataFrame(near, "a long, b long, depth int")
    similarities, pairs = j.neighbour_similarities(neighbours, vertices)
    equal = (sig == other).sum(axis=1)
    assert dict(zip(np.round((similarities * 255 + 1) / 256 * size).astype(int).tolist(), pairs.tolist(), strict=True)) == dict(zip(*(x.tolist() for x in np.unique(equal, return_counts=True)), strict=True))
    each = (equal / size - 1 / 256) / (1 - 1 / 256)
    assert j.match_depth(similarities, 0.8, pairs=pairs) == j.match_depth(each, 0.8)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold among unlike texts: at least nine in ten are linked."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    rows = []
    for k in range(150):
        t = [word() for _ in range(300)]
        other = list(t)
        for x in range(6):
            other[10 + 45 * x] = word()
        rows += [(2 * k, " ".join(t)), (2 * k + 1, " ".join(other))]
    root, _ = brute(rows)
    assert all(root[2 * k] == root[2 * k + 1] for k in range(150))
    found = {x["_id"]: x["class_id"] for x in j.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[2 * k] == found[2 * k + 1] for k in range(150)) >= 149


def test_empty(spark):
    assert j.similar_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = [{"_id": r.doc_id, "class_id": r.class_id, "n_links": r.n_links} for r in j.op7_jaccard_forest(spark, sf_dir).collect()]
    check(spark, docs, found)
