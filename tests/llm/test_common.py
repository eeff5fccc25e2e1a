import random

from skillweave.llm import common as c


def test_components_of_random_graphs(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 330)] + [(400, k) for k in range(401, 440)] + [(5, 5)]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    lonely = {v for v in root if all(a == b or v not in (a, b) for a, b in edges)}
    found = {x.v: x.root for x in c.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {v: find(v) for v in root if v not in lonely}


def test_no_edges(spark):
    assert c.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_and_grams():
    text = "  Ab\tcd  Ab\ncd é ".encode()
    w = c.word_hashes(text)
    assert len(w) == 5 and w[0] == w[2] and w[1] == w[3] and w[0] != w[1]
    g = c.gram_hashes(w, 2)
    assert len(g) == 4 and g[0] == g[2] and len(c.gram_hashes(w, 6)) == 0 and len(c.word_hashes(b"")) == 0


def test_a_dropped_folder_is_gone(spark, tmp_path):
    path = f"file://{tmp_path}/x"
    spark.range(3).write.parquet(path)
    c.drop_folder(spark, path)
    assert not (tmp_path / "x").exists()
    c.drop_folder(spark, path)
