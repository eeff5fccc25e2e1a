"""Crawl history, upserts, nested documents and profile summaries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.operators import history as h
from skillweave.plans.register import Plans
from skillweave.sources import files

plan = Plans()
n = lambda: F.count(F.lit(1))
#: Seconds with their fraction: a day that lacks a part of a second is none.
EPOCH = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
DAYS = lambda a, b: F.floor((EPOCH(b) - EPOCH(a)) / 86400).cast("long")


@plan("r1_latest_version", "W", sql="SELECT id, url, type FROM W WHERE type <> 'signup' QUALIFY crawled_on = max(crawled_on) OVER (PARTITION BY url)")
def r1(log):
    return h.latest(log.filter("type <> 'signup'"), "url", "crawled_on").select("id", "url", "type")


@plan("r2_latest_to_recrawl", "W", sql="SELECT id, url FROM (SELECT *, max(crawled_on) OVER (PARTITION BY url) AS last FROM W) WHERE crawled_on IS NOT DISTINCT FROM last AND fail_count <= 1 AND (crawled_on < TIMESTAMP '2024-01-31' OR NOT valid) AND type IN ('view', 'click', 'error') ORDER BY url, id")
def r2(log):
    due = (F.col("fail_count") <= 1) & ((F.col("crawled_on") < F.lit("2024-01-31").cast("timestamp_ntz")) | ~F.col("valid")) & F.col("type").isin("view", "click", "error")
    return h.latest(log, "url", "crawled_on").filter(due).select("id", "url").orderBy("url", "id")


@plan("r3_last_valid", "W", sql="SELECT id, url, crawl_number FROM W WHERE fail_count = 0 OR fail_count > 3 QUALIFY row_number() OVER (PARTITION BY url ORDER BY crawl_number DESC) = 1")
def r3(log):
    return h.last_valid(log, "url", "crawl_number", (F.col("fail_count") == 0) | (F.col("fail_count") > 3)).select("id", "url", "crawl_number")


@plan("r4_delete_failed", "P", "W", sql="SELECT profile_id, name FROM P WHERE 'u' || CAST(profile_id AS VARCHAR) NOT IN (SELECT url FROM W QUALIFY row_number() OVER (PARTITION BY url ORDER BY crawl_number DESC) = 1 AND fail_count > 0)")
def r4(profiles, log):
    bad = h.last_valid(log, "url", "crawl_number", F.lit(True)).filter("fail_count > 0").select("url")
    return profiles.withColumn("url", F.concat(F.lit("u"), F.col("profile_id").cast("string"))).join(bad, "url", "left_anti").select("profile_id", "name")


LINKS = """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages"""


@plan("r5_harvest_links", "pages", sql=f"SELECT DISTINCT link FROM ({LINKS}) WHERE link NOT IN (SELECT url FROM pages)")
def r5(pages):
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.distinct().join(pages.select(F.col("url").alias("link")), "link", "left_anti")


@plan("r6_only_new_keys", "J", sql="SELECT job_id FROM J WHERE source = 'B' AND company NOT IN (SELECT company FROM J WHERE source = 'A')")
def r6(jobs):
    known = jobs.filter("source = 'A'").select("company").distinct()
    return jobs.filter("source = 'B'").join(known, "company", "left_anti").select("job_id")


@plan("r7_redirect_urls", "W", sql="WITH t AS (SELECT url, type, valid, row_number() OVER (PARTITION BY url ORDER BY crawl_number DESC) AS rn FROM W), v AS (SELECT url, min(rn) AS rn FROM t WHERE valid AND rn <= 2 GROUP BY url) SELECT W.id, coalesce(t.url || '/' || t.type, W.url) AS url FROM W LEFT JOIN v USING (url) LEFT JOIN t ON t.url = v.url AND t.rn = v.rn")
def r7(log):
    last = log.withColumn("rn", F.row_number().over(W.partitionBy("url").orderBy(F.desc("crawl_number")))).filter("rn <= 2 AND valid")
    to = last.groupBy("url").agg(F.min_by("type", "rn").alias("t")).select("url", F.concat("url", F.lit("/"), "t").alias("redirect"))
    return log.join(to, "url", "left").select("id", F.coalesce("redirect", "url").alias("url"))


WD = "WITH t AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY crawled_on DESC NULLS FIRST, id DESC) = 1 AS last, count(*) OVER (PARTITION BY url) > 1 AS several FROM WD)"


@plan("r8_consistency_rules", "WD", sql=f"""{WD} SELECT 'several crawls and no timestamp' AS rule, id FROM t WHERE several AND crawled_on IS NULL
UNION ALL SELECT 'several crawls and a failed last one without failures', id FROM t WHERE several AND last AND NOT valid AND fail_count <= 0
UNION ALL SELECT 'failed crawl is not the last', id FROM t WHERE NOT last AND NOT valid UNION ALL SELECT 'valid without a redirect', id FROM t WHERE valid AND redirect_url IS NULL
UNION ALL SELECT 'valid without a timestamp', id FROM t WHERE valid AND crawled_on IS NULL UNION ALL SELECT 'valid with a fail count', id FROM t WHERE valid AND fail_count <> 0""")
def r8(log):
    return h.crawl_violations(log)


@plan("r8_repaired_counts", "WD", sql="SELECT id, CASE WHEN valid AND crawled_on >= TIMESTAMP '2024-01-05' AND crawled_on < TIMESTAMP '2024-01-20' THEN 0 ELSE fail_count END AS fail_count FROM WD")
def r8_repaired(log):
    return h.repaired(log, "2024-01-05", "2024-01-20").select("id", "fail_count")


@plan("r9_merge_failed_crawls", "W", sql="WITH t AS (SELECT *, sum(CASE WHEN fail_count = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY crawl_number) AS island FROM W) SELECT url, max(crawl_number) AS crawl_number, CAST(sum(fail_count) AS BIGINT) AS fail_count FROM t WHERE fail_count > 0 GROUP BY url, island")
def r9(log):
    t = h.islands(log, "url", ["crawl_number"], F.col("fail_count") == 0)
    return t.filter("fail_count > 0").groupBy("url", "island").agg(F.max("crawl_number").alias("crawl_number"), F.sum("fail_count").alias("fail_count")).drop("island")


@plan("r10_link_diff", "pages", sql=f"WITH l AS (SELECT DISTINCT page_id, link FROM ({LINKS})), a AS (SELECT page_id, link FROM l WHERE link NOT LIKE '%a%'), b AS (SELECT page_id, link FROM l WHERE link NOT LIKE '%e%') SELECT 'missing' AS kind, page_id, link FROM (FROM b EXCEPT FROM a) UNION ALL SELECT 'spurious', page_id, link FROM (FROM a EXCEPT FROM b)")
def r10(pages):
    links = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link")).distinct()
    stored, parsed = links.filter("link NOT LIKE '%a%'"), links.filter("link NOT LIKE '%e%'")
    return parsed.subtract(stored).select(F.lit("missing").alias("kind"), "page_id", "link").unionByName(stored.subtract(parsed).select(F.lit("spurious").alias("kind"), "page_id", "link"))


@plan("r11_duplicate_routing", "W", sql="SELECT id, CASE WHEN row_number() OVER (PARTITION BY url, type ORDER BY id) = 1 THEN NULL ELSE 'duplicate key' END AS cause FROM W")
def r11(log):
    rank = F.row_number().over(W.partitionBy("url", "type").orderBy("id"))
    return log.select("id", F.when(rank > 1, F.lit("duplicate key")).alias("cause"))


@plan("r13_fail_accumulation", "W", sql="WITH t AS (SELECT *, sum(CASE WHEN fail_count = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY crawl_number) AS island FROM W) SELECT id, CAST(sum(fail_count) OVER (PARTITION BY url, island ORDER BY crawl_number) AS BIGINT) AS failures FROM t")
def r13(log):
    t = h.islands(log, "url", ["crawl_number"], F.col("fail_count") == 0)
    w = W.partitionBy("url", "island").orderBy("crawl_number").rowsBetween(W.unboundedPreceding, W.currentRow)
    return t.select("id", F.sum("fail_count").over(w).alias("failures"))


@plan("r14_late_descriptions", "J", "JS", sql="SELECT job_id, skill FROM (SELECT DISTINCT job_id, skill FROM JS WHERE pos > 2) t WHERE NOT EXISTS (SELECT 1 FROM JS o WHERE o.pos <= 2 AND o.job_id = t.job_id AND o.skill = t.skill) AND job_id IN (SELECT job_id FROM J)")
def r14(jobs, skills):
    fresh = h.unseen(skills.filter("pos > 2").select("job_id", "skill"), skills.filter("pos <= 2"), ["job_id", "skill"])
    return fresh.join(jobs.select("job_id"), "job_id", "left_semi")


@plan("r15_page_types", "pages", sql="SELECT page_id, CASE WHEN url LIKE '%#%' THEN 'anchor' WHEN url LIKE '%?%' THEN 'listing' WHEN regexp_matches(url, '/[a-z]{2}/[0-9]+$') THEN 'detail' ELSE 'other' END AS kind, contains(html, '<title>') AS valid FROM pages")
def r15(pages):
    url = F.col("url")
    kind = F.when(url.contains("#"), "anchor").when(url.contains("?"), "listing").when(url.rlike("/[a-z]{2}/[0-9]+$"), "detail").otherwise("other")
    return pages.select("page_id", kind.alias("kind"), F.col("html").contains("<title>").alias("valid"))


OLD = "(SELECT job_id, category, company, salary_min FROM J WHERE job_id % 4 <> 0)"
NEW = "(SELECT job_id, upper(company) AS company, salary_max AS salary_min FROM J WHERE job_id % 2 = 0)"


@plan("w1_upsert", "J", sql=f"SELECT coalesce(o.job_id, n.job_id) AS job_id, o.category, CASE WHEN n.job_id IS NOT NULL THEN n.company ELSE o.company END AS company, CASE WHEN n.job_id IS NOT NULL THEN n.salary_min ELSE o.salary_min END AS salary_min FROM {OLD} o FULL JOIN {NEW} n USING (job_id)")
def w1(jobs):
    old = jobs.filter("job_id % 4 <> 0").select("job_id", "category", "company", "salary_min")
    new = jobs.filter("job_id % 2 = 0").select("job_id", F.upper("company").alias("company"), F.col("salary_max").alias("salary_min"))
    return h.upsert(old, new, ["job_id"])


@plan("w2_replace_children", "JS", sql="SELECT job_id, skill, pos FROM JS WHERE job_id % 3 <> 0 UNION ALL SELECT job_id, upper(skill), pos FROM JS WHERE job_id % 3 = 0 AND pos <= 2 UNION ALL SELECT job_id, skill, pos FROM JS WHERE job_id % 3 = 0 AND job_id NOT IN (SELECT job_id FROM JS WHERE pos <= 2)")
def w2(skills):
    new = skills.filter("job_id % 3 = 0 AND pos <= 2").select("job_id", F.upper("skill").alias("skill"), "pos")
    return h.replace_children(skills, new, "job_id", ["pos"])


@plan("w3_protected_columns", "J", sql=f"SELECT coalesce(o.job_id, n.job_id) AS job_id, o.category, CASE WHEN n.job_id IS NOT NULL THEN n.company ELSE o.company END AS company, coalesce(o.salary_min, n.salary_min) AS salary_min FROM {OLD} o FULL JOIN {NEW} n USING (job_id)")
def w3(jobs):
    old = jobs.filter("job_id % 4 <> 0").select("job_id", "category", "company", "salary_min")
    new = jobs.filter("job_id % 2 = 0").select("job_id", F.upper("company").alias("company"), F.col("salary_max").alias("salary_min"))
    return h.upsert(old, new, ["job_id"], protect=("salary_min",))


@plan("w3_protected_fields", "J", sql=f"SELECT coalesce(o.job_id, n.job_id) AS job_id, CASE WHEN n.job_id IS NOT NULL THEN n.company ELSE o.company END AS company, coalesce(o.salary_min, n.salary_min) AS salary_min FROM {OLD} o FULL JOIN {NEW} n USING (job_id)")
def w3_fields(jobs):
    """The same rule inside a nested value."""
    old = jobs.filter("job_id % 4 <> 0").select("job_id", F.struct("company", "salary_min").alias("doc"))
    new = jobs.filter("job_id % 2 = 0").select("job_id", F.struct(F.upper("company").alias("company"), F.col("salary_max").alias("salary_min")).alias("doc"))
    return h.upsert(old, new, ["job_id"], protect=("doc.salary_min",)).select("job_id", "doc.company", "doc.salary_min")


@plan("w4_nested_document", "JS", sql="SELECT job_id, count(*) AS n_skills, string_agg(CAST(pos AS VARCHAR) || ':' || skill, '|' ORDER BY pos, skill) AS skills FROM JS GROUP BY job_id")
def w4(skills):
    doc = h.nested(skills, "job_id", ["pos"], "skills")
    return doc.select("job_id", F.size("skills").cast("long").alias("n_skills"), F.array_join(F.transform("skills", lambda x: F.concat(x["pos"].cast("string"), F.lit(":"), x["skill"])), "|").alias("skills"))


@plan("w5_flattened_document", "JS", sql="SELECT job_id, pos, skill FROM JS")
def w5(skills):
    return h.flat(h.nested(skills, "job_id", ["pos"], "skills"), "job_id", "skills").select("job_id", "pos", "skill")


@plan("w6_dimension_ids", "P", sql="WITH d AS (SELECT lower(company) AS k, min(company) AS company, row_number() OVER (ORDER BY lower(company)) AS id FROM P GROUP BY lower(company)) SELECT profile_id, id AS company_id FROM P JOIN d ON lower(P.company) = d.k")
def w6(p):
    dim = h.numbered(p.groupBy(F.lower("company").alias("k")).agg(F.min("company").alias("label")), "k", "company_id")
    return p.withColumn("k", F.lower("company")).join(dim, "k").select("profile_id", "company_id")


@plan("w7_missing_bridge_rows", "P", "area_in_group", sql="SELECT DISTINCT sector, lep_id FROM P JOIN area_in_group USING (la_id) WHERE score < 0 EXCEPT SELECT sector, lep_id FROM P JOIN area_in_group USING (la_id) WHERE score > 9000")
def w7(p, bridge):
    rows = p.join(bridge, "la_id")
    return h.unseen(rows.filter("score < 0").select("sector", "lep_id"), rows.filter("score > 9000").select("sector", "lep_id").distinct(), ["sector", "lep_id"])


@plan("w8_folded_children", "J", "JS", sql="SELECT category, string_agg(DISTINCT skill, ',' ORDER BY skill) AS skills FROM J JOIN JS USING (job_id) GROUP BY category")
def w8(jobs, skills):
    doc = h.nested(jobs.join(skills, "job_id").select("category", "skill").distinct(), "category", ["skill"], "s")
    return doc.select("category", F.array_join(F.transform("s", lambda x: x["skill"]), ",").alias("skills"))


@plan("w9_place_ids", "X", "P", "area", sql="SELECT x.exp_id, x.title AS raw_title, a.la_name AS place FROM X x LEFT JOIN P p USING (profile_id) LEFT JOIN area a USING (la_id)")
def w9(x, p, areas):
    place = p.join(areas, "la_id", "left").select("profile_id", F.col("la_name").alias("place"))
    return x.withColumnsRenamed({"title": "raw_title"}).join(place, "profile_id", "left").select("exp_id", "raw_title", "place")


@plan("p1_first_last_experience", "X", sql="SELECT profile_id, arg_min(title, (start_ts, exp_id)) AS first_title, arg_max(title, (start_ts, exp_id)) AS last_title, CASE WHEN count(*) = 1 THEN any_value(company) ELSE arg_max(company, (start_ts, exp_id)) FILTER (end_ts IS NULL) END AS current_company FROM X GROUP BY profile_id")
def p1(x):
    at = F.struct("start_ts", "exp_id")
    open_at = F.when(F.col("end_ts").isNull(), at)
    return x.groupBy("profile_id").agg(
        F.min_by("title", at).alias("first_title"), F.max_by("title", at).alias("last_title"),
        F.when(n() == 1, F.any_value("company")).otherwise(F.max_by("company", open_at)).alias("current_company"))


@plan("p2_first_last_education", "X", sql="SELECT profile_id, arg_max(company, (start_ts, exp_id)) AS last_institute, arg_min(company, (start_ts, exp_id)) AS first_institute, CAST(max(start_ts) AS VARCHAR) IS NOT NULL AS has_end FROM X GROUP BY profile_id")
def p2(x):
    at = F.struct("start_ts", "exp_id")
    return x.groupBy("profile_id").agg(F.max_by("company", at).alias("last_institute"), F.min_by("company", at).alias("first_institute"), F.max("start_ts").isNotNull().alias("has_end"))


@plan("p3_start_range", "X", sql="SELECT profile_id, min(start_ts) AS first_start, max(start_ts) AS last_start FROM X GROUP BY profile_id")
def p3(x):
    return x.groupBy("profile_id").agg(F.min("start_ts").alias("first_start"), F.max("start_ts").alias("last_start"))


@plan("p4_child_counts", "P", "X", sql="SELECT p.profile_id, count(x.exp_id) AS n_experiences FROM P p LEFT JOIN X x USING (profile_id) GROUP BY p.profile_id")
def p4(p, x):
    counts = x.groupBy("profile_id").agg(n().alias("c"))
    return p.join(counts, "profile_id", "left").select("profile_id", F.coalesce("c", F.lit(0)).cast("long").alias("n_experiences"))


STINTS = "WITH c AS (SELECT *, CASE WHEN lag(company) OVER (PARTITION BY profile_id ORDER BY start_ts, exp_id) = company THEN 0 ELSE 1 END AS new FROM X), i AS (SELECT *, sum(new) OVER (PARTITION BY profile_id ORDER BY start_ts, exp_id ROWS UNBOUNDED PRECEDING) AS island FROM c), s AS (SELECT profile_id, island, any_value(company) AS company, min(start_ts) AS start_ts, max(end_ts) AS end_ts FROM i GROUP BY profile_id, island)"


def stints(x):
    w = W.partitionBy("profile_id").orderBy("start_ts", "exp_id")
    i = h.islands(x.withColumn("before", F.lag("company").over(w)), "profile_id", ["start_ts", "exp_id"], F.col("before") != F.col("company"))
    return i.groupBy("profile_id", "island").agg(F.any_value("company").alias("company"), F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))


@plan("p6_employment_stints", "X", sql=f"{STINTS} SELECT profile_id, company, start_ts, end_ts FROM s")
def p6(x):
    return stints(x).select("profile_id", "company", "start_ts", "end_ts")


@plan("p7_availability_features", "X", sql=f"{STINTS}, d AS (SELECT *, CAST(floor((epoch(end_ts) - epoch(start_ts)) / 3600) AS BIGINT) AS hours, row_number() OVER (PARTITION BY profile_id ORDER BY island DESC) AS rn FROM s WHERE end_ts IS NOT NULL) SELECT profile_id, count(*) AS n_stints, max(CASE WHEN rn = 1 THEN hours END) AS last_hours, max(CASE WHEN rn = 2 THEN hours END) AS previous_hours, max(CASE WHEN rn > 1 THEN hours END) AS longest_earlier FROM d GROUP BY profile_id HAVING count(*) >= 2")
def p7(x):
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    d = stints(x).filter("end_ts IS NOT NULL").withColumn("hours", F.floor((seconds("end_ts") - seconds("start_ts")) / 3600).cast("long"))
    d = d.withColumn("rn", F.row_number().over(W.partitionBy("profile_id").orderBy(F.desc("island"))))
    hours = lambda c: F.max(F.when(c, F.col("hours")))
    return d.groupBy("profile_id").agg(n().alias("n_stints"), hours(F.col("rn") == 1).alias("last_hours"), hours(F.col("rn") == 2).alias("previous_hours"), hours(F.col("rn") > 1).alias("longest_earlier")).filter("n_stints >= 2")


@plan("p8_matched_company_people", "X", sql="SELECT profile_id, company, min(start_ts) AS since FROM X WHERE end_ts IS NULL AND company IN ('Company 1', 'Company 2', 'Company 3') GROUP BY ALL")
def p8(x):
    return x.filter("end_ts IS NULL").filter(F.col("company").isin("Company 1", "Company 2", "Company 3")).groupBy("profile_id", "company").agg(F.min("start_ts").alias("since"))


@plan("n4_date_range_repair", "X", sql="SELECT exp_id, CASE WHEN s > e THEN NULL ELSE s END AS start_ts, CASE WHEN s IS NULL OR s > e THEN NULL ELSE e END AS end_ts FROM (SELECT exp_id, CASE WHEN exp_id % 11 = 0 THEN NULL ELSE start_ts END AS s, CASE WHEN exp_id % 5 = 0 THEN start_ts - INTERVAL 1 DAY ELSE end_ts END AS e FROM X)")
def n4(x):
    s = F.when(F.col("exp_id") % 11 != 0, F.col("start_ts"))
    e = F.when(F.col("exp_id") % 5 == 0, F.expr("start_ts - INTERVAL 1 DAY")).otherwise(F.col("end_ts"))
    bad = F.coalesce(s > e, F.lit(False))
    return x.select("exp_id", F.when(~bad, s).alias("start_ts"), F.when(~bad & s.isNotNull(), e).alias("end_ts"))


@plan("n5_duration_days", "X", sql="SELECT exp_id, CAST(floor((epoch(end_ts) - epoch(start_ts)) / 86400) AS BIGINT) AS days FROM X")
def n5(x):
    return x.select("exp_id", DAYS("start_ts", "end_ts").alias("days"))


@plan("n6_years_between", "J", sql="SELECT job_id, CAST(floor(date_diff('day', created::DATE, DATE '2005-06-30') / 365) AS BIGINT) AS years FROM J")
def n6(jobs):
    return jobs.select("job_id", F.floor(F.datediff(F.lit("2005-06-30").cast("date"), F.to_date("created")) / 365).cast("long").alias("years"))


@plan("n7_quarter", "J", sql="SELECT job_id, year(created) AS year, month(created) AS month, CAST((month(created) - 1) // 3 + 1 AS BIGINT) AS quarter FROM J")
def n7(jobs):
    return jobs.select("job_id", F.year("created").cast("long").alias("year"), F.month("created").cast("long").alias("month"), F.expr("(month(created) - 1) div 3 + 1").alias("quarter"))


@plan("n9_salary_midpoint", "J", sql="SELECT job_id, coalesce((salary_min + salary_max) / 2.0::DOUBLE, salary_min::DOUBLE, salary_max::DOUBLE) AS mid FROM J")
def n9(jobs):
    from skillweave.operators.reports import midpoint

    return jobs.select("job_id", midpoint(F.col("salary_min"), F.col("salary_max")).alias("mid"))


@plan("n3_epoch_times", "events", sql="SELECT event_id, make_timestamp(nullif(epoch_us(ts) // 1000000 * (event_id % 3), 0) * 1000000) AS t FROM events")
def n3(events):
    seconds = F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000000") * (F.col("event_id") % 3)
    return events.select("event_id", F.timestamp_seconds(F.nullif(seconds, F.lit(0))).cast("timestamp_ntz").alias("t"))


@plan("k1_max_over", "W", sql="SELECT id, max(crawl_number) OVER (PARTITION BY url) AS last_number FROM W")
def k1(log):
    return log.select("id", F.max("crawl_number").over(W.partitionBy("url")).alias("last_number"))


@plan("k3_neighbours", "X", sql="SELECT exp_id, lag(title) OVER w AS before, lead(title) OVER w AS after FROM X WINDOW w AS (PARTITION BY profile_id ORDER BY start_ts, exp_id)")
def k3(x):
    w = W.partitionBy("profile_id").orderBy("start_ts", "exp_id")
    return x.select("exp_id", F.lag("title").over(w).alias("before"), F.lead("title").over(w).alias("after"))


@plan("k7_first_row", "W", sql="SELECT url, arg_min(type, crawl_number) AS type FROM W GROUP BY url")
def k7(log):
    return log.groupBy("url").agg(F.min_by("type", "crawl_number").alias("type"))


@plan("k8_union_all", "X", "P", sql="SELECT company FROM X UNION ALL SELECT company FROM P")
def k8(x, p):
    return x.select("company").unionByName(p.select("company"))


@plan("k9_union_distinct", "X", "P", sql="SELECT company FROM X UNION SELECT company FROM P")
def k9(x, p):
    return x.select("company").unionByName(p.select("company")).distinct()


@plan("k11_except", "pages", sql=f"SELECT DISTINCT link FROM ({LINKS}) WHERE link LIKE '/%' EXCEPT SELECT link FROM ({LINKS}) WHERE page_id % 2 = 0")
def k11(pages):
    links = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.filter("link LIKE '/%'").select("link").subtract(links.filter("page_id % 2 = 0").select("link"))


@plan("s7_json_documents", "events", sql="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL AS reason FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IS NOT NULL UNION ALL SELECT event_id, NULL, 'k is missing' FROM events WHERE json_extract(props, '$.k') IS NULL")
def s7(events):
    k = F.from_json("props", "k long")["k"]
    return events.select("event_id", k.alias("k"), F.when(k.isNull(), F.lit("k is missing")).alias("reason"))


CHECKED = """SELECT id, doc, CASE WHEN NOT json_valid(doc) THEN 'not a document' WHEN json_type(doc, '$.title') <> 'VARCHAR' THEN 'invalid title'
 WHEN json_type(doc, '$.customer') IS NULL THEN 'missing customer' WHEN NOT starts_with(doc ->> '$.url', 'http') THEN 'invalid url'
 WHEN json_type(doc, '$.tags[1]') <> 'VARCHAR' THEN 'invalid tags' END AS reason FROM DOC"""
SPEC = {"title": ("str", True), "customer": ("int", True), "url": ("url", False), "tags": (["str"], False)}


@plan("s7_checked_documents", "DOC", sql=f"SELECT id, doc ->> '$.title' AS title, CAST(doc ->> '$.customer' AS BIGINT) AS customer, (doc ->> '$.tags[0]') || (doc ->> '$.tags[1]') AS tags FROM ({CHECKED}) WHERE reason IS NULL")
def s7_checked(docs):
    return files.checked_documents(docs, "doc", SPEC)[0].select("id", "title", "customer", F.array_join("tags", "").alias("tags"))


@plan("s7_rejected_documents", "DOC", sql=f"SELECT id, reason FROM ({CHECKED}) WHERE reason IS NOT NULL")
def s7_rejected(docs):
    return files.checked_documents(docs, "doc", SPEC)[1].select("id", "reason")


@plan("s12_search_documents", "J", "JS", sql="""WITH d AS (SELECT DISTINCT company, job_id, skill FROM J JOIN JS USING (job_id))
SELECT 'company' AS type, md5(company) AS id, NULL AS parent, count(DISTINCT job_id) AS n_children FROM d GROUP BY company
UNION ALL SELECT 'job', md5(company || '/' || CAST(job_id AS VARCHAR)), md5(company), count(*) FROM d GROUP BY company, job_id
UNION ALL SELECT 'skill', md5(company || '/' || CAST(job_id AS VARCHAR) || '/' || skill), md5(company || '/' || CAST(job_id AS VARCHAR)), 0 FROM d""")
def s12(jobs, skills):
    """Companies hold jobs, which hold skills; the nested documents are then told apart by type, as an index takes them."""
    rows = jobs.join(skills, "job_id").select("company", "job_id", "skill").distinct()
    inner = rows.groupBy("company", "job_id").agg(F.array_sort(F.collect_list("skill")).alias("skills"))
    doc = h.nested(inner, "company", ["job_id"], "jobs").withColumns({"path": F.col("company"), "id": F.md5("company")})
    job = doc.select(F.col("id").alias("parent"), "path", F.explode("jobs").alias("j")).withColumn("path", F.concat("path", F.lit("/"), F.col("j.job_id").cast("string")))
    skill = job.select(F.md5("path").alias("parent"), "path", F.explode("j.skills").alias("skill"))
    return (doc.select(F.lit("company").alias("type"), "id", F.lit(None).cast("string").alias("parent"), F.size("jobs").cast("long").alias("n_children"))
        .unionByName(job.select(F.lit("job").alias("type"), F.md5("path").alias("id"), "parent", F.size("j.skills").cast("long").alias("n_children")))
        .unionByName(skill.select(F.lit("skill").alias("type"), F.md5(F.concat("path", F.lit("/"), "skill")).alias("id"), "parent", F.lit(0).cast("long").alias("n_children"))))


QUERIES, ORACLES = plan.queries, plan.oracles
