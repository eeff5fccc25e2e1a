"""Properties and edge cases that the twins don't reach."""

import pytest
from pyspark.sql import functions as F

from skillweave.functions import text as t
from skillweave.operators import areas
from skillweave.operators import history as h
from skillweave.operators import matching as m
from skillweave.operators import relevance as r
from skillweave.operators import reports as rep


def test_upsert_is_idempotent_and_keeps_absent_columns(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, v int")
    new = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    once = h.upsert(old, new, ["k"])
    assert sorted(once.collect()) == [(1, "a", 10), (2, "b", 21), (3, None, 30)]
    assert sorted(h.upsert(once, new, ["k"]).collect()) == sorted(once.collect())


def test_latest_keeps_ties_and_null_times(spark):
    log = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None)], "k string, t int")
    assert sorted(map(str, h.latest(log, "k", "t").collect())) == sorted(map(str, [("a", 2), ("a", 2), ("b", None)])) or h.latest(log, "k", "t").count() == 3


def test_mapping_is_one_step(spark):
    mapping = spark.createDataFrame([(None, "a", "b"), ("s", "a", "c")], "sector string, name string, target string")
    df = spark.createDataFrame([("a", "s"), ("a", "x"), ("b", "s"), (None, "s")], "e string, sector string")
    out = {(x.e, x.sector): x.mapped for x in r.map_entities(df, "e", "sector", mapping).collect()}
    assert out == {("a", "s"): "c", ("a", "x"): "b", ("b", "s"): "b", (None, "s"): None}


def test_cumulative_ends_at_the_sum_and_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,), (None,)], "x double")
    hist = r.histogram(df, F.col("x"), [0.0, 1.0, 2.0])
    assert sorted(tuple(x) for x in hist.collect()) == [(0, 2), (1, 2)]
    assert max(x.n for x in r.cumulative(hist).collect()) == 4


def test_unequal_bins_are_an_error(spark):
    a = r.histogram(spark.range(3).select(F.col("id").cast("double").alias("x")), F.col("x"), [0.0, 1.0])
    b = r.histogram(spark.range(3).select(F.col("id").cast("double").alias("x")), F.col("x"), [0.0, 1.0, 2.0])
    with pytest.raises(Exception, match="unequal bins"):
        r.combine(a, b, lambda x, y: x + y).collect()


def test_relevance_of_an_empty_side(spark):
    df = spark.createDataFrame([(5, 5, 10, 10), (5, 8, 10, 100)], "c1 long, e long, n1 long, n long")
    out = df.select(*r.relevance(*[F.col(c) for c in df.columns])).collect()
    assert out[0][0] == 0.0 and out[0][1] == float("inf") and abs(out[1][0] - (0.5 - 3 / 90)) < 1e-12


def test_keys(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "n string")
    assert [x[0] for x in df.select(t.key("skill", "A", "en", F.col("n"))).collect()] == ["skill:A:en:a", None, None]
    with pytest.raises(Exception, match="not a key"):
        spark.createDataFrame([("a:b",)], "k string").select(t.key_parts(F.col("k"))).collect()


def pay(low, high, sign="£", joint=" - ", tail=""):
    return f"{sign}{low:,}{joint}{sign}{high:,}{tail}"


@pytest.mark.parametrize(("text", "expected"), [
    (pay(41_250, 47_900), (41250.0, 47900.0, "year")),
    (f"Remuneration: {pay(17, 19, joint='-', tail=' per hour')}, rota work", (17.0, 19.0, "hour")),
    (pay(51_700, 58_300, sign="€", joint=" to ", tail=" per annum"), (51700.0, 58300.0, "year")),
    (f"{pay(612, 640, joint=' to ', tail=' per day')} outside of London", (612.0, 640.0, "day")),
    ("Our band is £61-£66k", (61000.0, 66000.0, "year")),
    ("We pay £717 per week and a £90,000 car fund of our own", (90000.0, 90000.0, "year")),
    ("Day rate £310pd - £395pd, inside", (310.0, 395.0, "day")), ("shift work £12.10p/h - £14.60p/h", (12.1, 14.6, "hour")), ("£27’500 - £33’500", (27500.0, 33500.0, "year")),
    ("You own a budget of £85,000 for tools", None), ("Deals from £60K to £7M", None), ("A £6 million programme", None), ("A £12 voucher for lunch", None), ("no amount at all", None), ("", None), (None, None),
])
def test_salaries(spark, text, expected):
    found = spark.createDataFrame([(text,)], "text string").select(m.salary(F.col("text")).alias("s")).first().s
    assert (found and tuple(found)) == expected


def test_job_post_titles(spark):
    titles = {
        "Web Tester": "Web Tester", "4x Web Tester": "Web Tester", "Web Tester x4": "Web Tester", "4 x Web Tester": "Web Tester", "Web Tester - £52k": "Web Tester -",
        "Web Tester 52,500": "Web Tester", "Web Tester up to 450": "Web Tester", "Web Tester, 9 month contract": "Web Tester,", "Contract Tester": "Contract Tester",
        "1st/2nd line Support": "Support", "Second and third Line Help Desk": "Help Desk", "Line Cook": "Line Cook", "First Mate": "First Mate", "": "",
    }
    df = spark.createDataFrame([(x,) for x in titles], "x string")
    assert {r.x: r.y for r in df.select("x", t.job_post_title(F.col("x")).alias("y")).collect()} == titles


def test_brackets_of_all_kinds(spark):
    df = spark.createDataFrame([("Chef [Paris] {x} (a (b) c) d)",)], "x string")
    assert df.select(t.clean(F.col("x"), brackets=True)).first()[0] == "chef d"


def test_phrases_within_their_margin(spark):
    words = spark.createDataFrame([(1, k, w) for k, w in enumerate("big x data big y z q data".split())], "doc_id int, pos int, word string")
    phrases = spark.createDataFrame([("big data", "big"), ("big data", "data"), ("q z", "q"), ("q z", "z"), ("data x data", "data")], "phrase string, word string")
    assert sorted(x.phrase for x in m.phrase_hits(words, phrases).collect()) == ["big data", "data x data", "q z"]


def test_regions_take_the_deepest(spark):
    square = lambda s: [(0.0, 0.0), (s, 0.0), (s, s), (0.0, s)]
    regions = spark.createDataFrame([("A", square(10.0)), ("AB", square(5.0))], "code string, ring array<struct<x: double, y: double>>")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 7.0, 7.0), (3, 11.0, 1.0)], "id int, x double, y double")
    assert {x.id: x.code for x in areas.locate(points, regions.select("code", areas.one_ring(F.col("ring")).alias("parts")), 4.0).collect()} == {1: "AB", 2: "A", 3: None}


def test_views_clip_rings(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    views = [(0.0, 0.0, 5.0, 5.0, 25.0), (-1.0, -1.0, 11.0, 11.0, 50.0), (5.0, 5.0, 9.0, 9.0, 0.0), (0.0, 0.0, 8.0, 20.0, 48.0), (20.0, 0.0, 30.0, 5.0, 0.0)]
    df = spark.createDataFrame([(ring, *v) for v in views], "ring array<struct<x: double, y: double>>, x0 double, y0 double, x1 double, y1 double, area double")
    box = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    out = df.select("area", *[(areas.covered_share(areas.one_ring(F.col("ring")), *box) > k / 100).alias(f"c{k}") for k in (1, 45, 55, 90, 95, 97)]).collect()
    assert all(x[f"c{k}"] == (x.area > 50 * k / 100) for x in out for k in (1, 45, 55, 90, 95, 97))


def test_alike_is_the_ratio_above_a_bound(spark):
    texts = ["", "a", "kitten", "sitting", "the same words", "the same word", "quite another text", None]
    df = spark.createDataFrame([(x, y) for x in texts for y in texts], "a string, b string")
    for least in (0.0, 40.0, 75.0, 92.0):
        out = df.select(m.alike(F.col("a"), F.col("b"), least).alias("x"), (m.ratio(F.col("a"), F.col("b")) > least).alias("y")).collect()
        assert all(bool(o.x) == bool(o.y) for o in out)


def test_posting_bodies_by_precedence(spark):
    ld = '<script type="application/ld+json">{"@type": "%s", "description": "%s"}</script>'
    micro = '<div class="x" itemprop="description">from <b>microdata</b></div>'
    pages = {
        ld % ("Organization", "no") + ld % ("JobPosting", "linked") + micro + "<article>a</article>": "linked",
        ld % ("JobPosting", "") + micro + "<p>p</p>": "from <b>microdata</b>",
        "<script type='application/ld+json'>{broken</script><article>first\nline</article><p>p</p>": "first\nline",
        "<article></article><p>p</p>": "p", "plain": "",
    }
    df = spark.createDataFrame([(x,) for x in pages], "html string")
    assert {x.html: x.body for x in df.select("html", t.posting_body(F.col("html")).alias("body")).collect()} == pages


def test_clouds_merge_or_disagree(spark):
    make = lambda rows: spark.createDataFrame(rows, "skill string, c1 long, n1 long, e long, n long")
    a, b = make([("x", 2, 10, 7, 99), ("y", 1, 10, 4, 99)]), make([("x", 3, 20, 7, 99)])
    assert sorted(map(tuple, r.merge_clouds(a, b, "skill").collect())) == [("x", 5, 30, 7, 99), ("y", 1, 10, 4, 99)]
    with pytest.raises(Exception, match="disagree on e"):
        r.merge_clouds(a, make([("x", 3, 20, 8, 99)]), "skill").collect()


def test_nearest_cluster_keeps_vectors_without_overlap(spark):
    clusters = spark.createDataFrame([("a", "p", 1.0), ("b", "q", 0.6), ("b", "s", 0.8)], "label string, item string, w double")
    rows = spark.createDataFrame([(1, "p", 3.0), (2, "q", 1.0), (2, "p", 0.1), (3, "none", 1.0)], "id int, item string, w double")
    found = {x.id: (x.label, round(x.distance, 4), x.n_shared) for x in r.nearest_cluster(rows, clusters, "id", "label", "item").collect()}
    assert found[1] == ("a", 0.0, 1) and found[3] == ("a", 1.5708, 0) and found[2][0] == "b" and found[2][2] == 1


def test_even_split(spark):
    df = spark.range(11).select(F.col("id").alias("k"))
    assert [x.p for x in h.even_split(df, "k", 4, "p").orderBy("k").collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]


def test_a_fraction_of_a_phrase_is_enough(spark):
    words = spark.createDataFrame([(1, k, w) for k, w in enumerate("one two x three".split())] + [(2, k, w) for k, w in enumerate("one x y two".split())], "doc_id int, pos int, word string")
    phrases = spark.createDataFrame([("p", w) for w in ("one", "two", "three", "four")], "phrase string, word string")
    assert [x.doc_id for x in m.phrase_hits(words, phrases).collect()] == [1]


def test_clusters_merge_the_closest(spark):
    v = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 0.9), ("b", "y", 0.1), ("c", "z", 1.0), ("d", "z", 1.0), ("d", "y", 0.1)], "label string, item string, w double")
    assert {x.label: x.cluster for x in m.clusters(v, 2).collect()} == {"a": "a", "b": "a", "c": "c", "d": "c"}


def test_breakdown_totals(spark):
    rows = spark.createDataFrame([("r1", "t1"), ("r1", "t2"), ("r2", "t1"), ("r2", None)], "region_code string, merged_title string")
    out = rep.breakdown(rows, rep.known_title()).collect()
    assert sum(x.n_jobs for x in out) == 4 and all(x.n_all == 4 for x in out)
    assert {x.title for x in out} == {"t1", "t2", "unknown"}


def test_degrees_and_protected_skills(spark):
    df = spark.createDataFrame([("B.Sc. (Hons) Physics 2nd, 2010",), ("MBA",), ("Ph.D Law",), ("m.a.",), (None,)], "x string")
    assert [x[0] for x in df.select(t.degree_name(F.col("x"))).collect()] == ["bachelor of science physics", "master of business administration", "doctor of philosophy law", "master of arts", None]
    one = spark.createDataFrame([("java software engineer java",), ("java engineer",)], "x string")
    assert [x[0] for x in one.select(t.without_skills(F.col("x"), ["java", "software"])).collect()] == ["software engineer", "java engineer"]
    with pytest.raises(ValueError, match="planet"):
        t.entity_key("planet", "A", "en", F.lit("x"))


def test_unfinished_batches_are_left_out(spark):
    lines = ["Starting batch at 2020-01-01 10:00:00", "Retrieved URLs at 2020-01-01 10:01:40", "Crawled 50 URLs with 98% success", "Starting batch at 2020-01-01 11:00:00", "Starting batch at 2020-01-01 12:00:00", "Retrieved URLs at 2020-01-01 12:00:00", "Crawled 0 URLs with 0% success"]
    df = spark.createDataFrame([("f", k, x) for k, x in enumerate(lines)], "file string, at int, line string")
    assert sorted((x.n, x.percent, x.seconds, x.rate) for x in h.log_batches(df, "file", "at", "line").collect() if x.n) == [(50, 98, 100, 0.5)]
    assert [x.rate for x in h.log_batches(df, "file", "at", "line").collect() if not x.n] == [None]


def test_reinforcement_counts_each_experience(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "profile_id int, phrase string")
    out = m.reinforcement(pairs([(1, "a"), (1, "b"), (1, "c")]), pairs([(1, "a"), (1, "a"), (2, "a")]), pairs([(1, "a"), (1, "a"), (1, "b"), (1, "z")]))
    assert sorted(map(tuple, out.collect())) == [(1, "a", 3, True), (1, "b", 1, False), (1, "c", 0, False)]


def test_crosswalk_takes_the_nearest_name(spark):
    companies = spark.createDataFrame([(1, "A.C.M.E. Limited"), (2, "Acme, Ltd"), (3, "Nobody"), (4, None)], "k int, name string")
    names = spark.createDataFrame([("ACME (UK) plc", 9), ("Acme Ltd", 4), ("acme", 2), ("a c m e", 1)], "matched string, count long")
    out = {x.k: x.matched for x in m.crosswalk(companies, names, "k", "name", []).collect()}
    assert out == {1: "Acme Ltd", 2: "Acme Ltd", 3: None, 4: None}


def test_quarters():
    day = rep.date
    assert rep.is_quarter(day(1996, 4, 1), day(1996, 6, 30)) == "1996Q2" and rep.is_quarter(day(1996, 10, 1), day(1996, 12, 31)) == "1996Q4"
    assert all(rep.is_quarter(*x) is None for x in [(day(1996, 4, 2), day(1996, 6, 30)), (day(1996, 5, 1), day(1996, 7, 31)), (day(1996, 4, 1), day(1996, 6, 29)), (day(1996, 4, 1), day(1997, 6, 30))])


def test_samples_repeat_by_seed(spark):
    ids = spark.range(1000).union(spark.range(1000)).toDF("k")
    take = lambda seed: {x.k for x in rep.sample_ids(ids, "k", 50, seed).collect()}
    assert take(1) == take(1) and len(take(1)) == 50 and take(1) != take(2)


def test_violations_of_one_history(spark):
    rows = [(1, "u", "2020-01-01", False, None, 1), (2, "u", "2020-01-02", True, "r", 0), (3, "u", None, False, None, 0), (4, "v", "2020-01-01", True, None, 2)]
    log = spark.createDataFrame(rows, "id int, url string, crawled_on string, valid boolean, redirect_url string, fail_count int").withColumn("crawled_on", F.to_timestamp("crawled_on"))
    assert sorted(map(tuple, h.crawl_violations(log).collect())) == sorted([("failed crawl is not the last", 1), ("several crawls and no timestamp", 3), ("several crawls and a failed last one without failures", 3), ("valid without a redirect", 4), ("valid with a fail count", 4)])
    assert {x.id: x.fail_count for x in h.repaired(log, "2020-01-01", "2020-01-02").collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_stems_are_the_published_ones(spark):
    """Words that each rule of the published stemmer touches, worked by hand."""
    stems = {
        "running": "run", "analysis": "analysi", "services": "servic", "ties": "tie", "cries": "cri", "gas": "gas", "gaps": "gap", "kiwis": "kiwi", "stress": "stress", "caresses": "caress",
        "agreed": "agre", "feed": "feed", "luxuriated": "luxuri", "hopping": "hop", "hoping": "hope", "hissing": "hiss", "failed": "fail", "sized": "size", "troubling": "troubl", "by": "by", "say": "say", "cry": "cri",
        "happy": "happi", "national": "nation", "relational": "relat", "organization": "organ", "operator": "oper", "usefulness": "use", "sensibility": "sensibl", "geology": "geolog", "quickly": "quick", "electrical": "electr",
        "goodness": "good", "formative": "format", "replacement": "replac", "adoption": "adopt", "opinion": "opinion", "controlling": "control", "roll": "roll", "rate": "rate", "cease": "ceas", "generate": "generat",
        "general": "general", "communication": "communic", "skies": "sky", "news": "news", "proceed": "proceed", "inning": "inning", "engineering": "engin", "manager": "manag", "university": "univers", "youth": "youth", "boy": "boy", "c": "c", "2nd": "2nd", "": "",
    }
    df = spark.createDataFrame([(x,) for x in stems], "x string")
    assert {x.x: x.y for x in df.select("x", t.stem(F.col("x")).alias("y")).collect()} == stems
    row = df.groupBy().agg(F.collect_list("x").alias("w")).select(t.stems(F.col("w")).alias("s"), "w").first()
    assert dict(zip(row.w, row.s, strict=True)) == stems


def test_a_batch_that_runs_twice_is_there_once(spark, tmp_path):
    from skillweave.streaming import crawl

    write = crawl.batch_writer("append", str(tmp_path))
    for number in (0, 1, 1, 0):
        write(spark.range(number * 10, number * 10 + 3), number)
    assert sorted(x.id for x in spark.read.parquet(f"{tmp_path}/out/*").collect()) == [0, 1, 2, 10, 11, 12]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Contract, €310360 per day", (310.0, 360.0, "day")),
        ("Contract, £900100 per day", (900100.0, 900100.0, "day")),
        ("Paid €410500 a year", (410500.0, 410500.0, "year")),
        ("Paid £12.40 P.A.Y.E, that is £12.40 /hour", (12.4, 12.4, "hour")),
        ("You run budgets between £60,000 and £90,000; pay £31,000 pa", (31000.0, 31000.0, "year")),
        ("You run a budget of $2,000 to $7,000, salary $44k", (44000.0, 44000.0, "year")),
    ],
)
def test_lost_dashes_tax_words_and_budget_ranges(spark, text, expected):
    test_salaries(spark, text, expected)


def test_crosswalk_takes_names_inside_each_other(spark):
    companies = spark.createDataFrame([(1, "Acme Tools"), (2, "Acme"), (3, "Northern Acme Tools Ltd"), (4, "Toolset"), (5, None), (6, "Blue Sky Holdings")], "k int, name string")
    names = spark.createDataFrame([("Acme Tools Limited", 3), ("Acme", 1), ("Tools", 9), ("Blue Sky", 2), ("Sky Holdings Group", 5)], "matched string, count long")
    out = {x.k: x.matched for x in m.crosswalk(companies, names, "k", "name", []).collect()}
    assert out == {1: "Acme Tools Limited", 2: "Acme", 3: "Acme Tools Limited", 4: None, 5: None, 6: "Blue Sky"}
