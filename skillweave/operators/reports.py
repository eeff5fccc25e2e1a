"""Report building blocks over job posts, skills and areas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Region type -> column of the area table that holds its code.
REGION_FIELDS = {"LA": "la_id", "NUTS0": "nuts0", "NUTS1": "nuts1", "NUTS2": "nuts2"}
BANDS = (0, 10_000, 20_000, 30_000, 40_000, 50_000, 60_000)
BAND_NAMES = ("<10k", "10-20k", "20-30k", "30-40k", "40-50k", "50-60k", ">=60k")


def common_filters(jobs: DataFrame, category: str | None = None, start: date | None = None, end: date | None = None) -> DataFrame:
    """Category equality; created from start on, up to and with the end day."""
    if category is not None:
        jobs = jobs.filter(F.col("category") == category)
    if start is not None:
        jobs = jobs.filter(F.col("created") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        jobs = jobs.filter(F.col("created") < F.date_add(F.lit(end), 1).cast("timestamp_ntz"))
    return jobs


def title_filter(jobs: DataFrame, titles: list[str]) -> DataFrame:
    """Rows with one of the titles; `unknown` alone stands for missing titles."""
    title = F.col("merged_title")
    return jobs.filter(title.isNull() if titles == [UNKNOWN] else title.isin(titles))


def known_title(column: str = "merged_title") -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN))


def in_values(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is in the one-column table; a null there admits nulls."""
    wanted = values.toDF("__value").distinct()
    return df.join(wanted, F.col(column).eqNullSafe(F.col("__value")), "left_semi")


def region_rows(jobs: DataFrame, areas: DataFrame, bridge: DataFrame, kind: str) -> DataFrame:
    """jobs with region_code and region_name: an area, a group of areas (an area may be in several), or a code prefix."""
    if kind == "LEP":
        return jobs.join(bridge, "la_id").withColumns({"region_code": F.col("lep_id").cast("string"), "region_name": F.concat(F.lit("LEP "), F.col("lep_id").cast("string"))})
    if kind not in REGION_FIELDS:
        raise ValueError(f"unknown region type {kind}")
    name = F.col("la_name") if kind == "LA" else F.lit(None).cast("string")
    return jobs.join(areas, "la_id").withColumns({"region_code": F.col(REGION_FIELDS[kind]).cast("string"), "region_name": name}).filter("region_code IS NOT NULL")


def breakdown(rows: DataFrame, by: Column) -> DataFrame:
    """Counts by region and title with totals of region, title and all, and the location quotient."""
    counts = rows.groupBy("region_code", by.alias("title")).agg(F.count(F.lit(1)).alias("n_jobs"))
    d = lambda c: c.cast("double")
    # totals over a few thousand groups; the posts themselves are aggregated before
    region, title = F.sum("n_jobs").over(W.partitionBy("region_code")), F.sum("n_jobs").over(W.partitionBy("title"))
    total = counts.agg(F.sum("n_jobs").alias("n_all"))
    out = counts.withColumns({"n_region": region, "n_title": title}).crossJoin(F.broadcast(total))
    return out.withColumn("location_quotient", (d(F.col("n_jobs")) / d(F.col("n_region"))) / (d(F.col("n_title")) / d(F.col("n_all"))))


def midpoint(low: Column, high: Column) -> Column:
    return F.coalesce((low + high).cast("double") / 2, low.cast("double"), high.cast("double"))


def salary_band(value: Column) -> Column:
    band = F.when(value < BANDS[1], BAND_NAMES[0])
    for k in range(2, len(BANDS)):
        band = band.when(value < BANDS[k], BAND_NAMES[k - 1])
    return band.when(value >= BANDS[-1], BAND_NAMES[-1])


def build_fact(jobs: DataFrame, areas: DataFrame, bridge: DataFrame) -> DataFrame:
    """Posts counted by quarter, category, title and region of each type; one pass over the posts for all area levels."""
    quarter = F.concat(F.year("created").cast("string"), F.lit("Q"), F.quarter("created").cast("string"))
    base = jobs.groupBy(quarter.alias("period"), "category", "merged_title", "la_id").agg(F.count(F.lit(1)).alias("n"))
    with_area = base.join(areas.select("la_id", "nuts0", "nuts1", "nuts2"), "la_id")
    pairs = [F.struct(F.lit(k).alias("region_type"), F.col(c).cast("string").alias("region_code")) for k, c in REGION_FIELDS.items()]
    levels = with_area.withColumn("r", F.explode(F.array(*pairs))).select("period", "category", "merged_title", "r.region_type", "r.region_code", "n")
    groups = base.join(bridge, "la_id").select("period", "category", "merged_title", F.lit("LEP").alias("region_type"), F.col("lep_id").cast("string").alias("region_code"), "n")
    return levels.unionByName(groups).groupBy("period", "category", "merged_title", "region_type", "region_code").agg(F.sum("n").alias("total_jobs"))


def is_quarter(start: date, end: date) -> str | None:
    """The period's name if start to end (inclusive) is exactly one quarter."""
    first, after = start.month, date(end.year + (end.month == 12), end.month % 12 + 1, 1)
    whole = start.day == 1 and first % 3 == 1 and end.year == start.year and end.month == first + 2 and (after - end).days == 1
    return f"{start.year}Q{(first + 2) // 3}" if whole else None


def region_counts(jobs: DataFrame, fact: DataFrame, areas: DataFrame, bridge: DataFrame, region_type: str, start: date, end: date) -> DataFrame:
    """region_code, title, n_jobs of a range of days: from the fact where the range is a quarter that it holds, else from the posts."""
    period = is_quarter(start, end)
    if period is not None:
        rows = fact.filter((F.col("period") == period) & (F.col("region_type") == region_type))
        if not rows.isEmpty():
            return rows.groupBy("region_code", known_title().alias("title")).agg(F.sum("total_jobs").alias("n_jobs"))
    rows = region_rows(common_filters(jobs, None, start, end), areas, bridge, region_type)
    return rows.groupBy("region_code", known_title().alias("title")).agg(F.count(F.lit(1)).alias("n_jobs"))


def sample_ids(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n different keys at random: those with the least hashes under the seed, so that a repeated run takes the same ones."""
    return df.select(key).distinct().orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def crawl_counts() -> list[Column]:
    """Rows crawled, and of these the first crawls, later ones and failed later ones."""
    later, failed = F.col("crawl_number") > 0, F.col("fail_count") > 0
    return [F.count(F.lit(1)).alias("crawled"), F.count_if(~later).alias("n_new"), F.count_if(later & ~failed).alias("recrawl"), F.count_if(later & failed).alias("failed")]


def daily_crawls(log: DataFrame, children: str, fields: list[str]) -> DataFrame:
    """For each day of crawling: counts, sums and sums of squares of a number of children, how often fields are filled, rows
    indexed within 30 days, and the longest delay in days (31: more)."""
    k = F.col(children).cast("long")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    delay = F.floor((micros("indexed_on") - micros("crawled_on")) / 86_400_000_000)
    filled = [F.count(c).alias(f"n_{c}") for c in fields]
    sums = [F.sum(k).alias(f"{children}_sum"), F.sum(k * k).alias(f"{children}_squares")]
    return log.groupBy(F.to_date("crawled_on").alias("day")).agg(*crawl_counts(), *sums, *filled, F.count_if(delay.between(0, 30)).alias("in_delay"), F.max(F.least(delay, F.lit(31))).alias("most_delay"))
