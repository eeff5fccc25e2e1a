"""Classes of alternative names against union-find, addresses by hand."""

import random

from pyspark.sql import functions as F

from skillweave.operators import aliases


def union_find(links):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up if top(x) != x}


def test_classes_are_those_of_union_find(spark):
    r = random.Random(5)
    chain = list(range(1000, 1070))
    r.shuffle(chain)
    links = [(r.randrange(150), r.randrange(150)) for _ in range(110)] + list(zip(chain, chain[1:], strict=False)) + [(2000, k) for k in range(2001, 2300)]
    df = spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long")
    assert {x.node: x.root for x in aliases.classes(df).collect()} == union_find([x for x in links if x[0] != x[1]])
    assert aliases.classes(df.limit(0)).count() == 0


def test_earlier_addresses(spark):
    urls = {
        "https://uk.example.com/in/ann-bell-01203a07": ["https://uk.example.com/pub/ann-bell/7/03a/12", "http://uk.example.com/pub/ann-bell/7/03a/12"],
        "http://example.com/in/ann-b0500700": ["http://example.com/pub/ann/0/7/b05"],
        "https://example.com/in/annbell": [],
        "https://example.com/in/ann-bell": [],
        "https://example.com/in/ann-bell-012003": ["https://example.com/pub/ann-bell/0/3/12", "http://example.com/pub/ann-bell/0/3/12"],
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {x.u: x.e for x in df.select("u", aliases.earlier_urls(F.col("u")).alias("e")).collect()}
    assert got == urls


def test_one_of_each_class_stays(spark):
    rows = [
        (1, "http://www.A.com/in/x/?q=1", "t1", 3), (2, "https://m.a.com/in/x.html#top", "t2", 9), (3, "http://b.com/y", "t2", 5),
        (4, "http://c.com/y", None, 1), (5, "http://d.com/y", None, 1), (None, "http://b.com/y", "t2", 9),
        (6, "https://e.com/in/ann-01203a07", None, 2), (7, "http://e.com/pub/ann/7/03a/12", None, 8), (8, None, None, 0), (3, "http://b.com/y", "t2", 5),
    ]
    df = spark.createDataFrame(rows, "id long, url string, title string, version int")
    links = aliases.links_by_key(df, "id", [aliases.url_key(F.col("url")), F.col("title")])
    links = links.unionByName(aliases.links_by_alternatives(df, "id", "url", aliases.earlier_urls(F.col("url"))))
    out = aliases.one_of_each(df, "id", links, [-F.col("version")]).collect()
    assert len(out) == len(rows) and out[0].__fields__ == [*df.columns, "class_id", "survivor", "removed"]
    of = {x.id: (x.class_id, x.survivor, x.removed) for x in out}
    assert of[1] == (1, 2, True) and of[2] == (1, 2, False) and of[3] == (1, 2, True)
    assert of[4] == (4, 4, False) and of[5] == (5, 5, False) and of[8] == (8, 8, False)
    assert of[6] == (6, 7, True) and of[7] == (6, 7, False) and of[None] == (None, None, False)
