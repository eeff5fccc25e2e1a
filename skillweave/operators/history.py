"""Record selection over crawl history, upserts and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, time: str) -> DataFrame:
    """Rows at their key's latest time; ties are kept, null times only where a key has no other."""
    last = F.max(time).over(W.partitionBy(key))
    return log.withColumn("__last", last).filter(F.col(time).eqNullSafe(F.col("__last"))).drop("__last")


def last_valid(log: DataFrame, key: str, number: str, valid: Column) -> DataFrame:
    """The valid row with the highest number of each key; keys without one are dropped."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.col(number).desc()))
    return log.filter(valid).withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def unseen(new: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return new.dropDuplicates(keys).join(known.select(*keys), keys, "left_anti")


def islands(df: DataFrame, key: str, order: list[str], changed: Column, name: str = "island") -> DataFrame:
    """Numbers the runs of rows between changes, for each key in order."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("__new", F.coalesce(changed.cast("int"), F.lit(1))).withColumn(name, F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("__new")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], protect: tuple[str, ...] = ()) -> DataFrame:
    """old with new's rows inserted or updated: columns that new lacks stay on update and are null on insert; protected
    columns keep a non-null old value; "column.field" protects a field of a struct. new must be unique by key."""
    fresh = new.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__n_{c}") for c in new.columns if c not in keys], F.lit(True).alias("__new"))
    on = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    both = old.withColumn("__old", F.lit(True)).join(fresh, on, "full_outer")
    columns = []
    for c in old.columns:
        if c in keys:
            columns.append(F.coalesce(F.col(c), F.col(f"__k_{c}")).alias(c))
        elif c in new.columns:
            fresh_value = F.col(f"__n_{c}")
            for field in [p.split(".", 1)[1] for p in protect if p.startswith(f"{c}.")]:
                kept = fresh_value.withField(field, F.coalesce(F.col(f"{c}.{field}"), fresh_value[field]))
                fresh_value = F.when(F.col(c).isNotNull(), kept).otherwise(fresh_value)
            value = F.when(F.col("__new"), fresh_value).otherwise(F.col(c))
            columns.append((F.coalesce(F.col(c), value) if c in protect else value).alias(c))
        else:
            columns.append(F.col(c))
    return both.select(*columns)


def replace_children(old: DataFrame, new: DataFrame, parent: str, keys: list[str], delete: bool = True) -> DataFrame:
    """Children of the parents in new become exactly new's; others stay. Without delete, unlisted children stay too."""
    stay = old.join(new.select(parent).distinct(), parent, "left_anti") if delete else old.join(new.select(parent, *keys), [parent, *keys], "left_anti")
    return stay.unionByName(new)


def nested(children: DataFrame, parent: str, order: list[str], name: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """One row for each parent with its children as an ordered array of structs."""
    fields = [*order, *[c for c in children.columns if c != parent and c not in order and c not in exclude]]
    return children.groupBy(parent).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def flat(documents: DataFrame, parent: str, name: str) -> DataFrame:
    """The children of nested documents as rows, with the parent's key; parents without children give one null row."""
    return documents.select(parent, F.explode_outer(name).alias("__c")).select(parent, "__c.*")


def crawl_violations(log: DataFrame) -> DataFrame:
    """rule, id: rows of log(id, url, crawled_on, valid, redirect_url, fail_count) that break a rule of crawl histories. A
    crawl is its URL's last by time, one without a time being later than all others, and by id."""
    by_time = W.partitionBy("url").orderBy(F.asc_nulls_last("crawled_on"), "id")
    several = F.count(F.lit(1)).over(W.partitionBy("url")) > 1
    rows = log.withColumns({"__last": F.lead("id").over(by_time).isNull(), "__several": several})
    valid, last, no_time, fails = F.col("valid"), F.col("__last"), F.col("crawled_on").isNull(), F.col("fail_count")
    rules = {
        "several crawls and no timestamp": F.col("__several") & no_time,
        "several crawls and a failed last one without failures": F.col("__several") & last & ~valid & (fails <= 0),
        "failed crawl is not the last": ~last & ~valid,
        "valid without a redirect": valid & F.col("redirect_url").isNull(),
        "valid without a timestamp": valid & no_time,
        "valid with a fail count": valid & (fails != 0),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return rows.select(F.explode(broken).alias("rule"), "id")


def repaired(log: DataFrame, start: str, end: str) -> DataFrame:
    """log with the fail counts of valid crawls from start to before end set to 0."""
    inside = F.col("valid") & (F.col("crawled_on") >= F.lit(start)) & (F.col("crawled_on") < F.lit(end))
    return log.withColumn("fail_count", F.when(inside, F.lit(0)).otherwise(F.col("fail_count")).cast("long"))


def log_batches(lines: DataFrame, file: str, at: str, line: str) -> DataFrame:
    """file, start, n, percent, seconds, rate of each finished batch of a crawl log: its start, the end on the next line, and
    counts on the one after. Batches without these lines are left out; a rate over no time is null."""
    w = W.partitionBy(file).orderBy(at)
    three = lines.select(file, F.col(line).alias("a"), F.lead(line).over(w).alias("b"), F.lead(line, 2).over(w).alias("c"))
    time = lambda c: F.try_to_timestamp(F.regexp_extract(c, r" at (\S+ \S+)$", 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    whole = three.filter(F.col("a").startswith("Starting batch at ") & F.col("b").startswith("Retrieved URLs at ") & F.col("c").startswith("Crawled "))
    out = whole.select(file, time("a").alias("start"), time("b").alias("stop"), F.regexp_extract("c", r"Crawled (\d+)", 1).cast("long").alias("n"), F.regexp_extract("c", r"(\d+)%", 1).cast("int").alias("percent"))
    out = out.withColumn("seconds", F.unix_timestamp("stop") - F.unix_timestamp("start"))
    return out.select(file, F.col("start").cast("timestamp_ntz").alias("start"), "n", "percent", "seconds", F.expr("n / nullif(seconds, 0)").alias("rate"))


def log_failures(lines: DataFrame, file: str, at: str, line: str, status: int) -> DataFrame:
    """endpoint, n: failed requests that the next line of the log gives the status for."""
    after = F.lead(line).over(W.partitionBy(file).orderBy(at))
    failed = lines.withColumn("__next", after).filter(F.col(line).startswith("Failed getting URL") & (F.col("__next") == f"Received status code {status}"))
    return failed.groupBy(F.substring_index(line, " by ", -1).alias("endpoint")).agg(F.count(F.lit(1)).alias("n"))


def even_split(df: DataFrame, order: str, parts: int, name: str) -> DataFrame:
    """df with the number (from 1) of its part in an order: parts differ in size by one row at most, the larger ones first."""
    ranked = numbered(df, order, "__rank")
    total = ranked.agg(F.count(F.lit(1)).alias("__total"))
    size, more = F.floor(F.col("__total") / parts), F.col("__total") % parts
    large = more * (size + 1)
    part = F.when(F.col("__rank") <= large, F.ceil(F.col("__rank") / (size + 1))).otherwise(more + F.ceil((F.col("__rank") - large) / size))
    return ranked.crossJoin(F.broadcast(total)).withColumn(name, part.cast("long")).drop("__rank", "__total")


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with numbers from 1 in an order, without one task for all rows: rows are sorted in ranges, and each range starts
    after the rows of those before it. The ranges are written once, so both readings agree."""
    from skillweave.sources.files import shared_checkpoint

    ranges = shared_checkpoint(df.repartitionByRange(order).sortWithinPartitions(order).withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()}))
    # one row for each range
    sizes = ranges.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return ranges.join(F.broadcast(starts), "__p").withColumn(name, F.col("__before") + F.col("__i") - F.col("__first") + 1).drop("__p", "__i", "__first", "__before")
