"""Pairs of blocks whose texts are all alike: compared in units, without a row for each shared gram."""

import random

import pytest
from pyspark.sql import functions as F
from skillweave.operators import matching as m


def texts(r, n):
    """Texts that begin alike, with edits, accents, signs of two code units, empty ones and short ones."""
    out = ["", "a", "b", "post", "post é", "post 😀a", "post 😀b", "post 😁a"]
    while len(out) < n:
        x = "post no. " + "".join(r.choices("0123", k=r.randrange(3, 9)))
        out.append(x + r.choice(["", "", " été", "é", " 😀"]))
    return out


@pytest.mark.parametrize(("title_least", "text_least"), [(40, 75), (0, 80), (40, 45), (90, 75)])
@pytest.mark.parametrize("titles", ["title", "text"])
def test_crowded_blocks_have_the_same_pairs(spark, title_least, text_least, titles):
    r = random.Random(text_least)
    rows = [(k, r.choice(["x", "y", "y", None]), x[: r.randrange(1, 9)], x) for k, x in enumerate(texts(r, 120))]
    rows += [(500, "x", None, "data"), (501, "x", "data", None), (502, "z", "data", "data"), (503, "z", "data", "data")]
    df = spark.createDataFrame(rows, "id long, place string, title string, text string")
    found = lambda dense: sorted((p.a, p.b) for p in m.near_pairs(df, "place", "id", titles, "text", title_least, text_least, dense=dense).collect())
    by_grams, all_compared = found(1e9), found(0.0)
    assert by_grams == all_compared and by_grams and len(set(by_grams)) == len(by_grams)


def test_units_of_a_block_hold_each_pair_once(spark):
    """Small parts: a block of 61 texts is 9 parts, so 45 units."""
    r = random.Random(3)
    rows = [(k, "x" if k else "y", 61 if k else 1, x) for k, x in enumerate(sorted(set(texts(r, 90)))[:62])]
    nodes = spark.createDataFrame(rows, "id long, k string, size long, x string")
    a, b = (nodes.select("k", F.col("id").alias(c), F.col("x").alias(f"{c}_x")) for c in "ab")
    pair = a.join(b, "k").filter("a < b AND greatest(length(a_x), length(b_x)) <= 2.0 * least(length(a_x), length(b_x))").filter(m.ratio(F.col("a_x"), F.col("b_x")) > 60)
    want = sorted((p.a, p.b) for p in pair.select("a", "b").collect())
    assert sorted((p.a, p.b) for p in m.tiled_pairs(nodes, {"x": 60}, tile=7).collect()) == want and want


def test_alike_names_meet_without_their_grams(spark):
    """400 names of one block share most grams; these made ten rows a pair, now their block is found crowded and makes none."""
    names = spark.range(400).select("id", F.lit("x").alias("k"), F.format_string("supplier#%09d", "id").alias("s"))
    got = m.near_pairs(names, "k", "id", "s", "s")
    counts = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if "Join" in name:
            counts.append((name, node.metrics().apply("numOutputRows").value()))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    plan = got._jdf.queryExecution().executedPlan()
    pairs = plan.executeCollect()
    walk(plan)
    assert len(pairs) == 79800  # numbers of three digits differ by three edits at most
    assert counts and max(c for _, c in counts) <= 79800


def test_common_beginning(spark):
    df = spark.createDataFrame([("abc", "abd", 2), ("ab", "abc", 2), ("ab", "ab", 2), ("", "a", 0), ("é😀a", "é😁a", 1), ("é😀a", "é😀b", 2)], "a string, b string, n int")
    assert all(x.n == x.got for x in df.select("n", m.common_beginning(F.col("a"), F.col("b")).alias("got")).collect())


def test_most_edits_is_the_bound_of_the_ratio(spark):
    for least in (0, 40, 45, 60, 75, 80, 99, 100):
        lengths = spark.range(1, 300).select(F.col("id").cast("int").alias("n"))
        rows = lengths.select("n", m.most_edits(F.col("n"), least).alias("d")).collect()
        assert all([d for d in range(-2, x.n + 1) if 100.0 * (1 - d / x.n) > least][-1] == x.d for x in rows), least
