"""Regions of several polygons with holes: where points are, areas, and what a rectangle covers.

`parts` is an array of polygons, each an array of rings, each an array of points (x, y): the first ring of a polygon is its outline, the
others are holes. A ring may be closed by its first point or left open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.operators.matching import _let

PARTS = "array<array<array<struct<x: double, y: double>>>>"

_RING = "array<struct<x: double, y: double>>"


def _edges(ring: Column) -> Column:
    rest = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.zip_with(ring, F.concat(rest, F.slice(ring, F.lit(1), F.lit(1))), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _clip(ring: Column, axis: str, bound: Column, upper: bool) -> Column:
    """The part of a ring on one side of a line that is parallel to the other axis."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: p[axis] <= bound if upper else p[axis] >= bound

    def cut(p: Column, q: Column) -> Column:
        across = p[other] + (q[other] - p[other]) * (bound - p[axis]) / F.nullif(q[axis] - p[axis], F.lit(0.0))
        at = {axis: bound.cast("double"), other: across}
        return F.struct(at["x"].alias("x"), at["y"].alias("y"))

    def step(e: Column) -> Column:
        p, q = e["p"], e["q"]
        kept = F.when(inside(p) & inside(q), F.array(q)).when(inside(p), F.array(cut(p, q))).when(inside(q), F.array(cut(p, q), q))
        return F.coalesce(kept.cast(_RING), F.array().cast(_RING))

    return _let(ring, lambda r: F.flatten(F.transform(_edges(r), step)))


def ring_area(ring: Column) -> Column:
    turn = lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    return _let(ring, lambda r: F.abs(F.aggregate(F.transform(_edges(r), turn), F.lit(0.0), lambda a, x: a + x)) / 2)


def one_ring(ring: Column) -> Column:
    """parts of a region that is a single ring."""
    return F.array(F.array(ring)).cast(PARTS)


def area(parts: Column, ring=ring_area) -> Column:
    """The outlines' areas less the holes'."""
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return total(F.transform(parts, lambda p: total(F.transform(p, lambda r, k: F.when(k == 0, ring(r)).otherwise(-ring(r))))))


def covered_share(parts: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The share of a region's area that a rectangle covers; null for a region without area."""
    cut = lambda r: _clip(_clip(_clip(_clip(r, "x", x0, False), "x", x1, True), "y", y0, False), "y", y1, True)
    return F.try_divide(area(parts, lambda r: ring_area(cut(r))), area(parts))


def edges(regions: DataFrame) -> DataFrame:
    """code, x0, y0, x1, y1: the edges of all rings of regions (code, parts) that have a length, from their lower end up."""
    rings = regions.select("code", F.explode(F.flatten("parts")).alias("ring"))
    sides = rings.select("code", F.explode(_let(F.col("ring"), _edges)).alias("e")).select("code", *[F.col(f"e.{p}.{c}").alias(f"{p}{c}") for p in "pq" for c in "xy"])
    up = F.col("py") <= F.col("qy")
    pick = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    return sides.filter("px <> qx OR py <> qy").select("code", pick("px", "qx").alias("x0"), pick("py", "qy").alias("y0"), pick("qx", "px").alias("x1"), pick("qy", "py").alias("y1"))


def grid(regions: DataFrame, cell: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells that lie inside a region: code, cx, cy; cells that its border touches: code, cx, cy; the edges in each row of
    cells: code, cy, edges).

    Edges are cut at the rows of cells that they cross. In a row, the border's cells are those from an edge's left end to its right
    end; the others are inside if the line through their middle is, by the places where edges cross it."""
    cut = edges(regions).withColumn("cy", F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))))
    slope = F.coalesce(F.try_divide(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.lit(0.0))
    at = lambda y: F.col("x0") + (y - F.col("y0")) * slope
    level = F.col("y0") == F.col("y1")
    low, high = at(F.greatest(F.col("y0"), F.col("cy") * cell)), at(F.least(F.col("y1"), (F.col("cy") + 1) * cell))
    # a cell more where an end is as good as on the line between two
    ends = [F.when(level, f("x0", "x1")).otherwise(f(low, high)) for f in (F.least, F.greatest)]
    cells = F.sequence(F.floor(ends[0] / cell - 1e-9), F.floor(ends[1] / cell + 1e-9))
    border = cut.select("code", "cy", F.explode(cells).alias("cx")).distinct().select("code", "cx", "cy")
    by_row = cut.filter(~level).groupBy("code", "cy").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))

    middle = (F.col("cy") + 0.5) * cell
    crossed = cut.filter((F.col("y0") <= middle) & (middle < F.col("y1"))).groupBy("code", "cy").agg(F.array_sort(F.collect_list(at(middle))).alias("xs"))
    spans = F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda k: F.struct(F.ceil(F.get("xs", k) / cell - 0.5).alias("from"), F.floor(F.get("xs", k + 1) / cell - 0.5).alias("to")))
    within = crossed.filter("size(xs) > 1").select("code", "cy", F.inline(spans)).filter("`from` <= `to`").select("code", F.explode(F.sequence("from", "to")).alias("cx"), "cy")
    return within.distinct().join(border, ["code", "cx", "cy"], "left_anti"), border, by_row


def locate(points: DataFrame, regions: DataFrame, cell: float) -> DataFrame:
    """points(id, x, y) with the code of the deepest region (code, parts) that holds each: the longest code wins, then the
    last. Null where there is none, or where a coordinate is null or no number. A point on the left or lower border of a
    region is inside, one on the right or upper border isn't.

    Points meet regions by cell. In a cell inside a region nothing is left to test; in a cell of its border only the
    edges in the cell's row are, never whole rings."""
    inner, border, by_row = grid(regions, cell)
    real = points.filter(~F.isnan("x") & ~F.isnan("y") & (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")))
    at = real.select("id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    sure = at.join(inner, ["cx", "cy"]).select("id", "code")

    def right(e: Column) -> Column:
        spans = (e["y0"] <= F.col("y")) & (F.col("y") < e["y1"])
        return spans & (F.col("x") < e["x0"] + (F.col("y") - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"]))

    tested = at.join(border, ["cx", "cy"]).join(by_row, ["code", "cy"]).filter(F.size(F.filter("edges", right)) % 2 == 1).select("id", "code")
    hits = sure.unionByName(tested).groupBy("id").agg(F.max_by("code", F.struct(F.length("code"), "code")).alias("code"))
    return points.join(hits, "id", "left").select("id", "code")


def job_region_codes(jobs: DataFrame, regions: DataFrame, places: DataFrame, cell: float, levels: tuple[int, ...], columns: tuple[str, ...], place: str = "place") -> DataFrame:
    """jobs with their region columns filled: from their coordinates (x, y) where they have them, cut to the length of each level
    and null where no region of that level is known; else copied from the row of their place (`place` and the columns); jobs
    with neither keep what they had."""
    own = F.col("x").isNotNull() & F.col("y").isNotNull()
    found = locate(jobs.filter(own).select("id", "x", "y"), regions, cell)
    copied = places.select(F.col(place).alias("_place"), F.struct(*columns).alias("_copy"))
    both = jobs.join(found.withColumnRenamed("code", "_code"), "id", "left").join(copied, F.col(place) == F.col("_place"), "left")

    def level(name: str, n: int) -> Column:
        coded = F.when(F.length("_code") >= n, F.substring("_code", 1, n))
        return F.when(own, coded).when(F.col("_copy").isNotNull(), F.col(f"_copy.{name}")).otherwise(F.col(name))

    return both.withColumns({c: level(c, n) for c, n in zip(columns, levels, strict=True)}).select(*jobs.columns)
