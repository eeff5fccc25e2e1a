"""Regions of several polygons with holes, against areas worked out by hand and crossings counted edge by edge."""

import math
import random

from pyspark.sql import functions as F

from skillweave.operators import areas
from skillweave.sources import files

def BOX(*sides):
    x0, y0, x1, y1 = map(float, sides)
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def holds(parts, x, y):
    n = 0
    for ring in (r for p in parts for r in p):
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                n += 1
    return n % 2 == 1


def frame(spark, regions):
    return spark.createDataFrame(regions, f"code string, parts {areas.PARTS}")


def test_points_in_polygons_with_holes(spark):
    r = random.Random(2)
    star = [(50 + (40 if k % 2 else 17) * math.cos(k * math.pi / 9), 40 + (35 if k % 2 else 15) * math.sin(k * math.pi / 9)) for k in range(18)]
    regions = [
        ("A", [[star, BOX(47, 37, 53, 44)], [BOX(-30, -20, -10, 5)]]),
        ("AB", [[BOX(40.0, 30.0, 60.0, 36.0)]]),
        ("C", [[BOX(0, 0, 90, 0.5)], [[(-40.0, 60.0), (-5.0, 61.0), (-38.0, 90.0)], [(-35.0, 65.0), (-20.0, 64.0), (-34.0, 80.0)]]]),
        ("D", [[BOX(200, 200, 200, 230)]]), ("E", []), ("F", None),
    ]
    points = [(k, r.uniform(-50, 110), r.uniform(-30, 100)) for k in range(1500)]
    points += [(1500 + k, x, y) for k, (x, y) in enumerate((float(x), float(y)) for x in range(-40, 95, 5) for y in (-20, 0, 5, 30, 36, 40, 60, 65))]
    expected = {}
    for k, x, y in points:
        codes = [c for c, parts in regions if parts and holds(parts, x, y)]
        expected[k] = max(codes, key=lambda c: (len(c), c)) if codes else None
    points += [(9001, None, 1.0), (9002, float("nan"), 1.0), (9003, float("inf"), 1.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    for cell in (3.7, 10.0, 400.0):
        got = {x.id: x.code for x in areas.locate(df, frame(spark, regions), cell).collect()}
        assert [got.pop(k) for k in (9001, 9002, 9003)] == [None] * 3
        assert got == expected
    assert {x.code for x in areas.locate(df, frame(spark, regions).limit(0), 5.0).collect()} == {None}


def test_areas_and_what_a_rectangle_covers(spark):
    two = [[BOX(0, 0, 10, 10), BOX(2, 2, 4, 7)], [BOX(20, 0, 24, 5)]]
    df = frame(spark, [("A", two), ("B", []), ("C", None)])
    box = [F.lit(float(v)) for v in (3, 0, 22, 5)]
    out = {x.code: (x.a, x.s) for x in df.select("code", areas.area(F.col("parts")).alias("a"), areas.covered_share(F.col("parts"), *box).alias("s")).collect()}
    # 100 - 10 + 20; of it 7 x 5 less 1 x 3 of the hole, and 2 x 5
    assert out["A"] == (110.0, (35 - 3 + 10) / 110) and out["B"] == (0.0, None) and out["C"] == (None, None)


def test_features_keep_parts_and_holes(spark, tmp_path):
    regions = [("A", [[BOX(0.0, 0.0, 10.0, 10.0), BOX(2.0, 2.0, 4.0, 7.0)], [BOX(20.0, 0.0, 24.0, 5.0)]]), ("B", [[BOX(1.0, 1.0, 2.0, 2.0)]]), ("C", None)]
    df = frame(spark, regions).withColumn("name", F.concat(F.lit("n "), "code"))
    files.geojson_features(df, "code", "name", "parts").write.text(f"file://{tmp_path}/g")
    lines = "".join(x.value for x in spark.read.text(f"file://{tmp_path}/g").collect())
    assert '"type":"MultiPolygon"' in lines and '"type":"Polygon"' in lines and '"geometry":null' in lines
    back = {x.id: (x.name, x.parts) for x in files.read_features(spark, f"file://{tmp_path}/g").collect()}
    plain = lambda parts: parts and [[[tuple(q) for q in ring] for ring in p] for p in parts]
    assert {k: plain(v[1]) for k, v in back.items()} == {c: plain([[ring + ring[:1] for ring in p] for p in parts]) if parts else None for c, parts in regions}
    assert back["A"][0] == "n A" and tuple(files.bounds(files.read_features(spark, f"file://{tmp_path}/g").filter("id = 'A'"), "id", "parts").first()) == ("A", 0.0, 0.0, 24.0, 10.0)


def test_region_codes_of_jobs(spark):
    regions = frame(spark, [("A", [[BOX(0.0, 0.0, 10.0, 10.0)]]), ("A1", [[BOX(0.0, 0.0, 5.0, 10.0)]])])
    jobs = spark.createDataFrame([(1, 1.0, 1.0, "p", "old", "old"), (2, 7.0, 1.0, "p", "old", "old"), (3, None, None, "p", "old", "old"), (4, None, 1.0, "q", "old", "old"), (5, 99.0, 1.0, None, "old", "old"), (6, None, None, None, None, "old")], "id long, x double, y double, place string, r0 string, r1 string")
    places = spark.createDataFrame([("p", "B", "B2"), (None, "Z", "Z")], "place string, r0 string, r1 string")
    out = {x.id: (x.r0, x.r1) for x in areas.job_region_codes(jobs, regions, places, 2.0, (1, 2), ("r0", "r1")).collect()}
    assert out == {1: ("A", "A1"), 2: ("A", None), 3: ("B", "B2"), 4: ("old", "old"), 5: (None, None), 6: (None, "old")}
