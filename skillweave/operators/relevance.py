"""Entity catalogues, mappings, relevance clouds, weights, vectors and histograms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """key, name (the most frequent, the smallest of equals), total: counts are summed before names are compared."""
    counts = df.groupBy(key, name).agg(F.count(F.lit(1)).alias("c"))
    # max_by needs one order: the count up, the name down
    least = W.partitionBy(key).orderBy(F.desc("c"), name)
    ranked = counts.withColumns({"rn": F.row_number().over(least), "total": F.sum("c").over(W.partitionBy(key))})
    return ranked.filter("rn = 1").select(key, name, "total")


def all_catalogues(sources: dict[str, dict[str, tuple[DataFrame, str]]]) -> DataFrame:
    """type, source, name, n: the catalogue of each entity type of each source, {source: {type: (rows, column)}}."""
    parts = [
        rows.groupBy(F.lit(kind).alias("type"), F.lit(source).alias("source"), F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n"))
        for source, kinds in sources.items()
        for kind, (rows, column) in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def per_text(df: DataFrame, text: str, made: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """df with columns that hang on one text alone, {name: function of the text}. Each different text is worked out once, dealt
    over all shuffle partitions however few files there are, and joined back, null to null."""
    texts = df.select(F.col(text).alias("__text")).distinct().repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    worked = texts.select("__text", *[f(F.col("__text")).alias(name) for name, f in made.items()])
    return df.join(worked, F.col(text).eqNullSafe(F.col("__text")), "left").drop("__text")


def word_index(names: DataFrame, key: str) -> DataFrame:
    """word, key: the distinct words of each key."""
    words = F.array_distinct(F.filter(F.split(F.lower(key), r"[^a-z0-9]+"), lambda w: w != ""))
    return names.select(key).distinct().select(F.explode(words).alias("word"), key)


def search(index: DataFrame, key: str, words: list[str]) -> DataFrame:
    """Keys that hold all words, in one pass over the index."""
    return index.filter(F.col("word").isin(words)).groupBy(key).agg(F.count_distinct("word").alias("k")).filter(F.col("k") == len(set(words))).select(key)


def map_entities(df: DataFrame, column: str, sector: str, mapping: DataFrame) -> DataFrame:
    """Adds `mapped`: by the sector's own mapping, else the general one, else itself. mapping(sector, name, target); a
    null sector is general. The row's sector is itself mapped by the general mapping before it is looked up."""
    own = mapping.filter("sector IS NOT NULL").select(F.col("sector").alias("__s"), F.col("name").alias("__n"), F.col("target").alias("__own"))
    general = mapping.filter("sector IS NULL").select(F.col("name").alias("__g"), F.col("target").alias("__general"))
    sectors = general.select(F.col("__g").alias("__from"), F.col("__general").alias("__to"))
    out = df.join(sectors, F.col(sector) == F.col("__from"), "left").withColumn("__sector", F.coalesce("__to", sector))
    out = out.join(own, (F.col("__sector") == F.col("__s")) & (F.col(column) == F.col("__n")), "left").join(general, F.col(column) == F.col("__g"), "left")
    return out.withColumn("mapped", F.coalesce("__own", "__general", column)).drop("__from", "__to", "__sector", "__s", "__n", "__own", "__g", "__general")


def mapping_errors(mapping: DataFrame) -> DataFrame:
    """rule, name: names mapped twice, and targets that are mapped on to something else."""
    twice = mapping.groupBy("sector", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit("duplicate").alias("rule"), "name")
    again = mapping.select(F.col("name").alias("t"), F.col("target").alias("to"))
    chain = mapping.join(again, (F.col("target") == F.col("t")) & (F.col("to") != F.col("t"))).select(F.lit("chain").alias("rule"), "name")
    return twice.unionByName(chain).distinct()


def relevance(c1: Column, e: Column, n1: Column, n: Column) -> tuple[Column, Column]:
    """(score, error): share inside the category less the share outside, with its standard error. An empty side scores 0
    with an infinite error."""
    d = lambda x: x.cast("double")
    n2 = n - n1
    f1, f2 = d(c1) / d(n1), d(e - c1) / d(n2)
    empty = (n1 == 0) | (n2 == 0)
    error = F.sqrt(f1 * (1 - f1) / d(n1) + f2 * (1 - f2) / d(n2))
    return F.when(empty, 0.0).otherwise(f1 - f2), F.when(empty, float("inf")).otherwise(error)


def cooccurrence(rows: DataFrame, category: str, entity: str) -> DataFrame:
    """category, entity, c1, e, n1, n for all categories at once: one grouped pass, totals by windows over the groups."""
    pairs = rows.groupBy(category, entity).agg(F.count(F.lit(1)).alias("c1"))
    totals = rows.agg(F.count(F.lit(1)).alias("n"))
    return pairs.withColumns({"e": F.sum("c1").over(W.partitionBy(entity)), "n1": F.sum("c1").over(W.partitionBy(category))}).crossJoin(F.broadcast(totals))


def cloud(rows: DataFrame, category: str, entity: str, sigma: float, limit: int) -> DataFrame:
    """The entities of each category with score >= sigma errors, best first."""
    co = cooccurrence(rows, category, entity)
    score, error = relevance(F.col("c1"), F.col("e"), F.col("n1"), F.col("n"))
    kept = co.withColumns({"score": score, "error": error}).filter(F.col("score") >= sigma * F.col("error"))
    best = W.partitionBy(category).orderBy(F.desc(F.round("score", 9)), entity)
    return kept.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= limit)


def idf(skills: DataFrame, n_jobs: DataFrame) -> DataFrame:
    """skill, idf = log10(jobs / rows of the skill)."""
    counts = skills.groupBy("skill").agg(F.count(F.lit(1)).alias("c")).crossJoin(F.broadcast(n_jobs.toDF("total")))
    return counts.select("skill", F.log10(F.col("total").cast("double") / F.col("c").cast("double")).alias("idf"))


def skill_vectors(rows: DataFrame, title: str, skill: str, min_count: int) -> DataFrame:
    """title, skill, w: shares of co-occurrence, normalised to length 1; all titles in one pass."""
    often = rows.groupBy(skill).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= min_count).select(skill)
    counts = rows.join(often, skill).groupBy(title, skill).agg(F.count(F.lit(1)).cast("double").alias("w"))
    return counts.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(title))))


def angular_distance(a: DataFrame, b: DataFrame, key_a: str, key_b: str, item: str, power: float = 0.0) -> DataFrame:
    """Distances of all pairs of vectors of two small sets: acos of the cosine, times the smaller norm's power. Pairs
    without a common item have a distance too, so the keys are crossed (both sides are sets of titles or clusters)."""
    norm = lambda v, k, name: v.groupBy(k).agg(F.sum(F.col("w") * F.col("w")).alias(name))
    dots = a.select(key_a, item, F.col("w").alias("wa")).join(b.select(key_b, item, F.col("w").alias("wb")), item).groupBy(key_a, key_b).agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    pairs = norm(a, key_a, "na").crossJoin(norm(b, key_b, "nb")).join(dots, [key_a, key_b], "left")
    cosine = F.coalesce("dot", F.lit(0.0)) / F.sqrt(F.col("na") * F.col("nb"))
    factor = F.least(F.pow("na", F.lit(power)), F.pow("nb", F.lit(power)))
    return pairs.select(key_a, key_b, (F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) * factor).alias("distance"))


def nearest_cluster(rows: DataFrame, clusters: DataFrame, key: str, label: str, item: str) -> DataFrame:
    """key, label, distance, n_shared: the cluster at the least angle to each vector (w by item), and how many items they share.
    Only pairs with a common item are joined; a vector without any is at a right angle to all, and gets the first cluster.
    Clusters have length 1; of equal distances the first label counts."""
    norm = rows.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    near = rows.join(clusters.withColumnRenamed("w", "cw"), item).groupBy(key, label).agg(F.sum(F.col("w") * F.col("cw")).alias("dot"), F.count(F.lit(1)).alias("n_shared"))
    best = near.groupBy(key).agg(F.min_by(F.struct(label, "dot", "n_shared"), F.struct(-F.round("dot", 9), label)).alias("best"))
    first = clusters.agg(F.min(label).alias("first"))
    cosine = F.least(F.lit(1.0), F.coalesce("best.dot", F.lit(0.0)) / F.col("norm"))
    out = norm.join(best, key, "left").crossJoin(F.broadcast(first))
    return out.select(key, F.coalesce(f"best.{label}", "first").alias(label), F.acos(cosine).alias("distance"), F.coalesce("best.n_shared", F.lit(0)).cast("long").alias("n_shared"))


def merge_clouds(a: DataFrame, b: DataFrame, entity: str) -> DataFrame:
    """entity, c1, n1, e, n of two clouds as one: coincidences and category sizes are added; an entity whose own count, or the
    total, is not the same in both is an error."""
    both = a.select(entity, "c1", "n1", "e", "n").unionByName(b.select(entity, "c1", "n1", "e", "n")).groupBy(entity)
    same = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.raise_error(F.lit(f"the clouds disagree on {c}")).cast("bigint")).alias(c)
    return both.agg(F.sum("c1").alias("c1"), F.sum("n1").alias("n1"), same("e"), same("n"))


def bin_of(value: Column, edges: list[float]) -> Column:
    """Number of the right-closed bin (the first is closed on both sides); null outside the edges."""
    below = F.size(F.filter(F.lit(edges), lambda e: e < value))
    inside = (value >= edges[0]) & (value <= edges[-1])
    return F.when(inside, F.greatest(below - 1, F.lit(0)).cast("long"))


def histogram(df: DataFrame, value: Column, edges: list[float], weight: Column | None = None, name: str = "n") -> DataFrame:
    """bin, n: all bins, empty ones with 0."""
    counts = df.select(bin_of(value, edges).alias("bin"), (F.lit(1) if weight is None else weight).alias("w")).filter("bin IS NOT NULL").groupBy("bin").agg(F.sum("w").alias(name))
    bins = df.sparkSession.range(len(edges) - 1).toDF("bin")
    return bins.join(counts, "bin", "left").select("bin", F.coalesce(name, F.lit(0)).alias(name))


def cumulative(hist: DataFrame, name: str = "n", upper: bool = False) -> DataFrame:
    """Running sums from the lower or the upper end."""
    order = F.desc("bin") if upper else F.asc("bin")
    return hist.withColumn(name, F.sum(name).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)))


def combine(a: DataFrame, b: DataFrame, op, name: str = "n") -> DataFrame:
    """op(a, b) bin by bin; unequal bins are an error."""
    both = a.select("bin", F.col(name).alias("x")).join(b.select("bin", F.col(name).alias("y")), "bin", "full_outer")
    checked = F.when(F.col("x").isNull() | F.col("y").isNull(), F.raise_error(F.lit("histograms have unequal bins"))).otherwise(op(F.col("x"), F.col("y")))
    return both.select("bin", checked.alias(name))


def gaussian_power(mean: Column, sdev: Column, exponent: float) -> tuple[Column, Column]:
    """Mean and standard deviation of a variate to a constant power, to first order."""
    return F.pow(mean, F.lit(exponent)), F.abs(exponent * F.pow(mean, F.lit(exponent - 1)) * sdev)


def gaussian(op: str, m1: Column, s1: Column, m2: Column, s2: Column) -> tuple[Column, Column]:
    """Mean and standard deviation of a sum, difference, product or quotient of independent variates."""
    both = lambda x, y: F.sqrt(x * x + y * y)
    if op == "+":
        return m1 + m2, both(s1, s2)
    if op == "-":
        return m1 - m2, both(s1, s2)
    if op == "*":
        return m1 * m2, both(s1 * m2, s2 * m1)
    return m1 / m2, both(s1 / m2, s2 * m1 / (m2 * m2))


def mean_with_error(total: Column, squares: Column, count: Column) -> tuple[Column, Column]:
    """Mean and its standard error from sums; no rows give nulls, one row an error of 0."""
    n = count.cast("double")
    mean = F.when(count > 0, total / n)
    variance = F.greatest(squares / (n - 1) - n / (n - 1) * mean * mean, F.lit(0.0))
    return mean, F.when(count == 1, F.lit(0.0)).when(count > 1, F.sqrt(variance / n))
