"""Near-duplicate pairs, phrases in windows and clusters against brute force on small random data."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skillweave.operators import matching as m


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def texts(r, n):
    words = ["data", "engineer", "nurse", "chef", "lead", "a", "aaa", "été", "senior"]
    out = ["", "a", "b", "ab", "ba", "abcd", "abce", "aaaaaaaa", "aaaaaaab", "aaaaaabb"]
    while len(out) < n:
        x = " ".join(r.choices(words, k=r.randrange(1, 7)))
        for _ in range(r.randrange(0, 4)):
            at = r.randrange(len(x) + 1)
            x = x[:at] + r.choice(["", "x", " "]) + x[at + r.randrange(2) :]
        out.append(x)
    return out


@pytest.mark.parametrize(("title_least", "text_least"), [(40, 75), (0, 80), (40, 45)])
def test_all_near_pairs_are_found(spark, title_least, text_least):
    r = random.Random(text_least)
    rows = [(k, r.choice(["x", "y", None]), t[: r.randrange(1, 9)], t) for k, t in enumerate(texts(r, 160))]
    rows += [(500, "x", None, "data"), (501, "x", "data", None), (502, "x", "data", "data"), (503, "x", "data", "data")]
    df = spark.createDataFrame(rows, "id long, place string, title string, text string")
    got = {(p.a, p.b) for p in m.near_pairs(df, "place", "id", "title", "text", title_least, text_least).collect()}
    sort = lambda t: " ".join(sorted(w for w in t.lower().split(" ") if w))
    nodes = {}
    for i, place, title, text in rows:
        if None not in (place, title, text):
            nodes.setdefault((place, sort(title), sort(text)), i)
    want = set()
    score = lambda a, b: 100 * (1 - distance(a, b) / max(len(a), len(b), 1))
    for (pa, ta, xa), a in nodes.items():
        for (pb, tb, xb), b in nodes.items():
            if pa == pb and a < b and max(len(xa), len(xb)) <= 2 * min(len(xa), len(xb)) and score(ta, tb) > title_least and score(xa, xb) > text_least:
                want.add((a, b))
    assert got == want and want


def test_no_pair_of_a_block_is_made_without_a_shared_gram(spark):
    rows = [(k, "x", "t", chr(97 + k % 26) * 20 + str(k // 26) * 20) for k in range(200)]
    nodes = spark.createDataFrame(rows, "id long, k string, t string, x string")
    assert m.prefix_pairs(nodes, 75).count() < 200 * 30


@pytest.mark.parametrize(("margin", "fraction"), [(1.5, 0.75), (1.0, 1.0), (2.0, 0.5)])
def test_phrases_in_windows(spark, margin, fraction):
    r = random.Random(7)
    catalogue = {"one": ["a"], "two": ["a", "b"], "three": ["c", "d", "e"], "four": ["a", "c", "e", "f"], "six": list("abcdef"), "none": ["q", "r"]}
    docs = {k: [r.choice("aabcdefxyzz") for _ in range(r.randrange(0, 25))] for k in range(60)}
    words = spark.createDataFrame([(k, p, w) for k, d in docs.items() for p, w in enumerate(d)], "doc_id long, pos int, word string")
    phrases = spark.createDataFrame([(p, w) for p, ws in catalogue.items() for w in ws], "phrase string, word string")
    got = {(x.doc_id, x.phrase) for x in m.phrase_hits(words, phrases, margin, fraction).collect()}
    want = {(k, p) for k, d in docs.items() for p, ws in catalogue.items() if any(len(set(d[i : math.ceil(i + margin * len(ws))]) & set(ws)) >= fraction * len(ws) for i in range(len(d)))}
    assert got == want


def merged_one_by_one(vectors, k, power, half):
    groups, members = {x: dict(v) for x, v in vectors.items()}, {x: x for x in vectors}
    while len(groups) > k:

        def key(a, b):
            na, nb = (sum(w * w for w in groups[x].values()) for x in (a, b))
            dot = sum(w * groups[b].get(i, 0) for i, w in groups[a].items())
            return round(math.acos(max(-1, min(1, dot / math.sqrt(na * nb)))) * min(na**power, nb**power), 9), a, b

        _, a, b = min(key(a, b) for a in groups for b in groups if a < b)
        for i, w in groups.pop(b).items():
            groups[a][i] = groups[a].get(i, 0) + w
        if half:
            groups[a] = {i: w / 2 for i, w in groups[a].items()}
        members = {x: a if c == b else c for x, c in members.items()}
    return members


@pytest.mark.parametrize(("power", "half", "k"), [(0.0, False, 1), (0.5, True, 3)])
def test_clusters_are_those_of_single_mergers(spark, power, half, k):
    r = random.Random(3)
    vectors = {f"t{x:02d}": {f"s{i}": round(r.random(), 3) + 0.01 for i in r.sample(range(9), r.randrange(1, 5))} for x in range(9)}
    rows = [(x, i, w) for x, v in vectors.items() for i, w in v.items()]
    got = m.clusters(spark.createDataFrame(rows, "label string, item string, w double"), k, power, half).collect()
    assert {x.label: x.cluster for x in got} == merged_one_by_one(vectors, k, power, half)


def test_a_round_merges_several_pairs(spark):
    rows = [(f"{g}{x}", f"i{g}", 1.0) for g in range(6) for x in "ab"] + [(f"{g}{x}", f"own{g}{x}", 0.1) for g in range(6) for x in "ab"]
    both = spark.createDataFrame(rows, "label string, item string, w double")
    norms = both.groupBy("label").agg(F.sum(F.col("w") * F.col("w")).alias("norm"))
    other = both.select(F.col("label").alias("b"), "item", F.col("w").alias("v"))
    dots = both.withColumnRenamed("label", "a").join(other, "item").filter("a < b").groupBy("a", "b").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    assert m._round_of_mergers(dots, norms, 10, 0.0, False).count() == 6
