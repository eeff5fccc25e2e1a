"""Classes of rows that are one thing under several names, and the one of each class that stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.operators.matching import written


def earlier_urls(url: Column) -> Column:
    """The addresses that a profile may have had before: `.../in/name-LLLSSSFF` was `.../pub/name/FF/SSS/LLL`, numbers without
    their leading zeros, over https or http. Empty for an address of another form; null for null."""
    form = r"^(.*)/[^/]+/([^/]*)-([^/-]{3})([^/-]{3})([^/-]{0,2})[^/-]*$"
    part = lambda k: F.regexp_extract(url, form, k)
    number = lambda k: F.when(part(k).rlike("^[0-9]+$"), F.regexp_replace(part(k), "^0+(?=[0-9])", "")).otherwise(F.when(part(k) == "", "0").otherwise(part(k)))
    old = F.concat(part(1), F.lit("/pub/"), part(2), F.lit("/"), number(5), F.lit("/"), number(4), F.lit("/"), number(3))
    fits = url.rlike(form) & url.rlike("[0-9]")
    return F.when(url.isNull(), F.lit(None)).when(fits, F.array_distinct(F.array(old, F.regexp_replace(old, "^https:", "http:")))).otherwise(F.array().cast("array<string>"))


def url_key(url: Column) -> Column:
    """What stays the same of an address however it is asked for: no scheme, no www or m in front, no query, fragment, page
    suffix or closing slash; the host in lower case."""
    bare = F.regexp_replace(F.substring_index(F.substring_index(url, "#", 1), "?", 1), r"(?i)^https?://(?:www\.|m\.)*", "")
    bare = F.regexp_replace(bare, r"(?i)(?:\.html?|/)+$", "")
    host = F.lower(F.substring_index(bare, "/", 1))
    return F.concat(host, F.substr(bare, F.length(host) + 1))


def links_by_key(rows: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    """a, b: each row with the least id of all that share one of its keys with it; a null key or id links nothing.

    A key of any number of rows costs a row for each, and its least id is found by partial aggregation."""
    tagged = F.array(*[F.struct(F.lit(k).alias("rule"), F.sha2(x.cast("string"), 256).alias("key")) for k, x in enumerate(keys)])
    each = rows.select(F.col(id_col).alias("a"), F.inline(tagged)).filter("a IS NOT NULL AND key IS NOT NULL")
    least = each.groupBy("rule", "key").agg(F.min("a").alias("b"), F.max("a").alias("top")).filter("b < top")
    return each.join(least, ["rule", "key"]).filter("a <> b").select("a", "b").distinct()


def links_by_alternatives(rows: DataFrame, id_col: str, url: str, alternatives: Column) -> DataFrame:
    """a, b: each row with those whose address is among its alternatives."""
    wanted = rows.select(F.col(id_col).alias("a"), F.explode(alternatives).alias("_url"))
    return wanted.join(rows.select(F.col(id_col).alias("b"), F.col(url).alias("_url")), "_url").filter("a <> b").select("a", "b").distinct()


def classes(links: DataFrame) -> DataFrame:
    """node, root: the least node that links (a, b) of any direction lead to, for every node of a link but the roots themselves.

    Large and small stars by turns (each node hands its neighbours to the least one) until every node hangs on a root, in a
    number of rounds that grows with the logarithm of the nodes. Every round is a table in the shared folder; the driver only learns whether
    it was the last. Links to null or to itself say nothing."""
    stars = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while _loose(stars):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = written(both.join(nearest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = written(small.unionByName(nearest.select("a", F.col("m").alias("b"))).distinct())
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _loose(stars: DataFrame) -> bool:
    """Whether some node hangs on two others, or on one that hangs itself."""
    if not stars.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return True
    return not stars.join(stars.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def one_of_each(rows: DataFrame, id_col: str, links: DataFrame, order: list[Column]) -> DataFrame:
    """rows with `class_id` (the least id of the class), `survivor` (the id that stays: the least in `order`, then by id) and
    `removed`. A row without an id is in no class and stays; rows of one id are one and share their fate."""
    roots = classes(links)
    own = rows.join(roots.select(F.col("node").alias("_node"), F.col("root").alias("_root")), F.col(id_col) == F.col("_node"), "left")
    own = own.withColumn("class_id", F.coalesce("_root", F.col(id_col))).drop("_node", "_root")
    rank = F.struct(*[x.alias(f"o{k}") for k, x in enumerate(order)], F.col(id_col).alias("id"))
    best = own.filter(F.col("class_id").isNotNull()).groupBy("class_id").agg(F.min_by(F.col(id_col), rank).alias("survivor"))
    return own.join(best, "class_id", "left").withColumn("removed", F.coalesce(F.col("survivor") != F.col(id_col), F.lit(False))).select(*rows.columns, "class_id", "survivor", "removed")
