"""Reports over job posts: filters, joins, aggregates, orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.operators import history as h
from skillweave.operators import reports as r
from skillweave.plans.register import Plans

plan = Plans()
n = lambda: F.count(F.lit(1))
START, END = date(1996, 1, 1), date(1997, 12, 31)
IN_RANGE = "created >= TIMESTAMP '1996-01-01' AND created < TIMESTAMP '1998-01-01'"
MID = "coalesce((salary_min + salary_max) / 2.0::DOUBLE, salary_min::DOUBLE, salary_max::DOUBLE)"
BAND = "CASE WHEN mid < 10000 THEN '<10k' WHEN mid < 20000 THEN '10-20k' WHEN mid < 30000 THEN '20-30k' WHEN mid < 40000 THEN '30-40k' WHEN mid < 50000 THEN '40-50k' WHEN mid < 60000 THEN '50-60k' ELSE '>=60k' END"


@plan("s1_table_scan", "orders", sql="SELECT o_orderkey, o_orderpriority FROM orders")
def s1(orders):
    return orders.select("o_orderkey", "o_orderpriority")


@plan("s13_key_range", "J", sql="SELECT job_id, created FROM J WHERE job_id >= 1000 AND job_id < 5000 AND created >= TIMESTAMP '1996-01-01' AND created < TIMESTAMP '1998-01-01'")
def s13(jobs):
    return jobs.filter((F.col("job_id") >= 1000) & (F.col("job_id") < 5000) & (F.col("created") >= "1996-01-01") & (F.col("created") < "1998-01-01")).select("job_id", "created")


@plan("f1_conjunctive_filters", "J", sql="SELECT job_id FROM J WHERE merged_title IS NOT NULL AND salary_min IS NULL AND category NOT IN ('1-URGENT', '2-HIGH')")
def f1(jobs):
    return jobs.filter(F.col("merged_title").isNotNull() & F.col("salary_min").isNull() & ~F.col("category").isin("1-URGENT", "2-HIGH")).select("job_id")


@plan("f2_in_values", "J", sql="SELECT job_id, merged_title FROM J WHERE merged_title IN ('BUILDING', 'MACHINERY') OR merged_title IS NULL")
def f2(jobs):
    wanted = jobs.sparkSession.createDataFrame([("BUILDING",), ("MACHINERY",), (None,)], "v string")
    return r.in_values(jobs, "merged_title", F.broadcast(wanted)).select("job_id", "merged_title")


@plan("f3_common_filters", "J", sql=f"SELECT job_id, category, created FROM J WHERE category = '3-MEDIUM' AND {IN_RANGE}")
def f3(jobs):
    return r.common_filters(jobs, "3-MEDIUM", START, END).select("job_id", "category", "created")


@plan("f4_unknown_title", "J", sql="SELECT job_id FROM J WHERE merged_title IS NULL")
def f4(jobs):
    return r.title_filter(jobs, [r.UNKNOWN]).select("job_id")


@plan("f5_region_dispatch", "J", "area", "area_in_group", sql="SELECT 'LA' AS kind, CAST(la_id AS VARCHAR) AS region_code, count(*) AS n_jobs FROM J JOIN area USING (la_id) GROUP BY la_id UNION ALL SELECT 'LEP', CAST(lep_id AS VARCHAR), count(*) FROM J JOIN area_in_group USING (la_id) GROUP BY lep_id UNION ALL SELECT 'NUTS1', nuts1, count(*) FROM J JOIN area USING (la_id) GROUP BY nuts1")
def f5(jobs, areas, bridge):
    parts = [r.region_rows(jobs, areas, bridge, k).groupBy(F.lit(k).alias("kind"), "region_code").agg(n().alias("n_jobs")) for k in ("LA", "LEP", "NUTS1")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@plan("f6_case_insensitive", "P", sql="SELECT profile_id, sector FROM P WHERE lower(sector) IN ('building', 'household')")
def f6(profiles):
    return profiles.filter(F.lower("sector").isin("building", "household")).select("profile_id", "sector")


@plan("f7_substring", "part", sql="SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), lower('An'))")
def f7(part):
    return part.filter(F.lower("p_name").contains("an")).select("p_partkey", "p_name")


@plan("f8_whole_word", "part", sql="SELECT p_partkey, p_name FROM part WHERE contains(' ' || lower(p_name) || ' ', ' red ') OR contains(' ' || lower(p_name) || ' ', ' steel ')")
def f8(part):
    text = F.concat(F.lit(" "), F.lower("p_name"), F.lit(" "))
    return part.filter(text.contains(" red ") | text.contains(" steel ")).select("p_partkey", "p_name")


@plan("f9_visibility_pruning", "JS", sql="SELECT job_id, string_agg(skill, '|' ORDER BY pos, skill) AS skills FROM JS WHERE pos % 2 = 1 GROUP BY job_id")
def f9(skills):
    nested = skills.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("pos", "skill", (F.col("pos") % 2 == 1).alias("visible")))).alias("items"))
    seen = F.transform(F.filter("items", lambda x: x["visible"]), lambda x: x.dropFields("visible"))
    return nested.withColumn("items", seen).filter(F.size("items") > 0).select("job_id", F.array_join(F.transform("items", lambda x: x["skill"]), "|").alias("skills"))


@plan("f10_aligned_union", "J", "area", sql="SELECT CAST(la_id AS VARCHAR) AS code, la_name AS name, count(*) AS n_jobs FROM J JOIN area USING (la_id) GROUP BY la_id, la_name UNION ALL SELECT nuts1, NULL, count(*) FROM J JOIN area USING (la_id) GROUP BY nuts1")
def f10(jobs, areas):
    both = jobs.join(areas, "la_id")
    la = both.groupBy(F.col("la_id").cast("string").alias("code"), F.col("la_name").alias("name")).agg(n().alias("n_jobs"))
    return la.unionByName(both.groupBy(F.col("nuts1").alias("code")).agg(n().alias("n_jobs")), allowMissingColumns=True)


@plan("f11_drop_empty_children", "X", sql="SELECT profile_id, count(*) AS n_children FROM X WHERE end_ts IS NOT NULL OR value > 50 GROUP BY profile_id")
def f11(x):
    return x.filter(F.col("end_ts").isNotNull() | (F.col("value") > 50)).groupBy("profile_id").agg(n().alias("n_children"))


@plan("f12_random_sample", "X")
def f12(x):
    return r.sample_ids(x, "profile_id", 50, seed=7)


@plan("j1_fact_join", "J", "JS", sql="SELECT category, skill, count(*) AS n FROM JS JOIN J USING (job_id) GROUP BY category, skill")
def j1(jobs, skills):
    return skills.join(jobs.select("job_id", "category"), "job_id").groupBy("category", "skill").agg(n().alias("n"))


@plan("j2_left_join", "J", "area", sql="SELECT job_id, nuts1 FROM J LEFT JOIN (SELECT * FROM area WHERE nuts0 <> 'R1') a USING (la_id)")
def j2(jobs, areas):
    return jobs.join(areas.filter("nuts0 <> 'R1'"), "la_id", "left").select("job_id", "nuts1")


@plan("j3_bridge_join", "region", "J", "area_in_group", sql="SELECT r_name, count(*) AS n FROM J JOIN area_in_group USING (la_id) JOIN region ON r_regionkey = lep_id GROUP BY r_name")
def j3(region, jobs, bridge):
    per_area = jobs.groupBy("la_id").agg(n().alias("n"))
    return per_area.join(bridge, "la_id").join(region, F.col("lep_id") == F.col("r_regionkey")).groupBy("r_name").agg(F.sum("n").alias("n"))


@plan("j6_semi_join", "J", "JS", sql="SELECT job_id, company FROM J WHERE job_id IN (SELECT job_id FROM JS WHERE pos >= 6)")
def j6(jobs, skills):
    return jobs.join(skills.filter("pos >= 6"), "job_id", "left_semi").select("job_id", "company")


@plan("j7_anti_join", "J", "JS", sql="SELECT job_id, company FROM J WHERE job_id NOT IN (SELECT job_id FROM JS WHERE pos >= 3)")
def j7(jobs, skills):
    return jobs.join(skills.filter("pos >= 3"), "job_id", "left_anti").select("job_id", "company")


@plan("j8_dimension_join", "orders", "customer", "nation", sql="SELECT n_name, count(*) AS n FROM orders, customer, nation WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey GROUP BY n_name")
def j8(orders, customer, nation):
    both = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return both.groupBy("n_name").agg(n().alias("n"))


@plan("a1_valid_date_range", "J", sql=f"WITH s AS (SELECT source, min(created) AS lo, max(created) AS hi FROM J WHERE category = '3-MEDIUM' AND {IN_RANGE} GROUP BY source) SELECT max(lo) AS first_date, min(hi) AS last_date FROM s")
def a1(jobs):
    s = r.common_filters(jobs, "3-MEDIUM", START, END).groupBy("source").agg(F.min("created").alias("lo"), F.max("created").alias("hi"))
    return s.agg(F.max("lo").alias("first_date"), F.min("hi").alias("last_date"))


@plan("a2_regional_breakdown", "J", "area", "area_in_group", sql=f"""WITH b AS (SELECT CAST(lep_id AS VARCHAR) AS region_code, coalesce(merged_title, 'unknown') AS title, count(*) AS n_jobs
  FROM J JOIN area_in_group USING (la_id) WHERE {IN_RANGE} GROUP BY 1, 2)
SELECT region_code, title, n_jobs, CAST(sum(n_jobs) OVER (PARTITION BY region_code) AS BIGINT) AS n_region, CAST(sum(n_jobs) OVER (PARTITION BY title) AS BIGINT) AS n_title, CAST(sum(n_jobs) OVER () AS BIGINT) AS n_all,
 round((n_jobs::DOUBLE / (sum(n_jobs) OVER (PARTITION BY region_code))::DOUBLE) / ((sum(n_jobs) OVER (PARTITION BY title))::DOUBLE / (sum(n_jobs) OVER ())::DOUBLE), 8) AS location_quotient FROM b""")
def a2(jobs, areas, bridge):
    rows = r.region_rows(r.common_filters(jobs, None, START, END), areas, bridge, "LEP")
    return r.breakdown(rows, r.known_title()).withColumn("location_quotient", F.round("location_quotient", 8))


@plan("a2_all_sectors", "J", "area", "area_in_group", sql="SELECT nuts1 AS region_code, category AS title, count(*) AS n_jobs, CAST(sum(count(*)) OVER (PARTITION BY nuts1) AS BIGINT) AS n_region FROM J JOIN area USING (la_id) GROUP BY nuts1, category")
def a2_all(jobs, areas, bridge):
    return r.breakdown(r.region_rows(jobs, areas, bridge, "NUTS1"), F.col("category")).select("region_code", "title", "n_jobs", "n_region")


@plan("a2_groups_per_area", "area", "area_in_group", sql="SELECT la_id, string_agg(CAST(lep_id AS VARCHAR), ',' ORDER BY lep_id) AS leps FROM area JOIN area_in_group USING (la_id) GROUP BY la_id")
def a2_leps(areas, bridge):
    return areas.join(bridge, "la_id").groupBy("la_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("lep_id")), lambda x: x.cast("string")), ",").alias("leps"))


@plan("a3_location_quotient", "J", "area", "area_in_group", sql="""WITH b AS (SELECT nuts2 AS region_code, coalesce(merged_title, 'unknown') AS title, count(*)::DOUBLE AS c FROM J JOIN area USING (la_id) GROUP BY 1, 2)
SELECT region_code, title, round((c / sum(c) OVER (PARTITION BY region_code)) / (sum(c) OVER (PARTITION BY title) / sum(c) OVER ()), 8) AS location_quotient FROM b""")
def a3(jobs, areas, bridge):
    out = r.breakdown(r.region_rows(jobs, areas, bridge, "NUTS2"), r.known_title())
    return out.select("region_code", "title", F.round("location_quotient", 8).alias("location_quotient"))


@plan("a4_quarter_from_fact", "J", "area", "area_in_group", sql="SELECT CAST(lep_id AS VARCHAR) AS region_code, coalesce(merged_title, 'unknown') AS title, count(*) AS n_jobs FROM J JOIN area_in_group USING (la_id) WHERE created >= TIMESTAMP '1996-04-01' AND created < TIMESTAMP '1996-07-01' GROUP BY 1, 2")
def a4(jobs, areas, bridge):
    return r.region_counts(jobs, r.build_fact(jobs, areas, bridge), areas, bridge, "LEP", date(1996, 4, 1), date(1996, 6, 30))


@plan("a4_other_dates", "J", "area", "area_in_group", sql="SELECT CAST(lep_id AS VARCHAR) AS region_code, coalesce(merged_title, 'unknown') AS title, count(*) AS n_jobs FROM J JOIN area_in_group USING (la_id) WHERE created >= TIMESTAMP '1996-04-01' AND created < TIMESTAMP '1996-07-02' GROUP BY 1, 2")
def a4_other(jobs, areas, bridge):
    """A range that is no quarter is counted from the posts."""
    return r.region_counts(jobs, r.build_fact(jobs, areas, bridge), areas, bridge, "LEP", date(1996, 4, 1), date(1996, 7, 1))


@plan("a5_report_fact", "J", "area", "area_in_group", sql="""WITH q AS (SELECT *, CAST(year(created) AS VARCHAR) || 'Q' || CAST(quarter(created) AS VARCHAR) AS period FROM J),
u AS (SELECT period, category, merged_title, 'LA' AS region_type, CAST(la_id AS VARCHAR) AS region_code FROM q JOIN area USING (la_id)
 UNION ALL SELECT period, category, merged_title, 'NUTS0', nuts0 FROM q JOIN area USING (la_id) UNION ALL SELECT period, category, merged_title, 'NUTS1', nuts1 FROM q JOIN area USING (la_id)
 UNION ALL SELECT period, category, merged_title, 'NUTS2', nuts2 FROM q JOIN area USING (la_id) UNION ALL SELECT period, category, merged_title, 'LEP', CAST(lep_id AS VARCHAR) FROM q JOIN area_in_group USING (la_id))
SELECT *, count(*) AS total_jobs FROM u GROUP BY ALL""")
def a5(jobs, areas, bridge):
    return r.build_fact(jobs, areas, bridge)


@plan("a6_job_skill_rows", "J", "JS", "area", sql="SELECT job_id, skill, pos, merged_title, salary_min, salary_max, la_id, nuts1 FROM JS JOIN J USING (job_id) JOIN area USING (la_id)")
def a6(jobs, skills, areas):
    return skills.join(jobs, "job_id").join(areas, "la_id").select("job_id", "skill", "pos", "merged_title", "salary_min", "salary_max", "la_id", "nuts1")


@plan("a7_top_skills_by_tfidf", "J", "JS", sql="""WITH t AS (SELECT count(*) AS n FROM J), i AS (SELECT skill, log10((SELECT n FROM t)::DOUBLE / count(*)::DOUBLE) AS idf FROM JS GROUP BY skill),
c AS (SELECT skill, count(*) AS n FROM JS JOIN J USING (job_id) WHERE merged_title = 'BUILDING' GROUP BY skill)
SELECT skill, n, round(n::DOUBLE * coalesce(idf, 0), 6) AS tfidf FROM c LEFT JOIN i USING (skill) ORDER BY tfidf DESC, skill LIMIT 20""")
def a7(jobs, skills):
    idf = skills.groupBy("skill").agg(n().alias("df")).crossJoin(F.broadcast(jobs.agg(n().alias("total"))))
    idf = idf.select("skill", F.log10(F.col("total").cast("double") / F.col("df").cast("double")).alias("idf"))
    counts = skills.join(r.title_filter(jobs, ["BUILDING"]).select("job_id"), "job_id").groupBy("skill").agg(n().alias("n"))
    out = counts.join(idf, "skill", "left").select("skill", "n", F.round(F.col("n").cast("double") * F.coalesce("idf", F.lit(0.0)), 6).alias("tfidf"))
    return r.top(out, 20, F.desc("tfidf"), F.asc("skill"))


@plan("a8_salary_stats", "J", sql="SELECT coalesce(merged_title, 'unknown') AS title, salary_period, year(created) AS year, quarter(created) AS quarter, count(*) AS n, min(salary_min) AS lo, max(salary_max) AS hi, round(avg(salary_min), 2) AS avg_min, round(avg(salary_max), 2) AS avg_max FROM J WHERE salary_min IS NOT NULL OR salary_max IS NOT NULL GROUP BY ALL")
def a8(jobs):
    kept = jobs.filter("salary_min IS NOT NULL OR salary_max IS NOT NULL")
    return kept.groupBy(r.known_title().alias("title"), "salary_period", F.year("created").cast("long").alias("year"), F.quarter("created").cast("long").alias("quarter")).agg(
        n().alias("n"), F.min("salary_min").alias("lo"), F.max("salary_max").alias("hi"), F.round(F.avg("salary_min"), 2).alias("avg_min"), F.round(F.avg("salary_max"), 2).alias("avg_max"))


@plan("a9_salary_distribution", "J", sql=f"WITH m AS (SELECT coalesce(merged_title, 'unknown') AS title, {MID} AS mid FROM J WHERE salary_period = 'year') SELECT title, {BAND} AS band, count(*) AS n FROM m WHERE mid IS NOT NULL GROUP BY ALL")
def a9(jobs):
    mid = r.midpoint(F.col("salary_min"), F.col("salary_max"))
    return jobs.filter("salary_period = 'year'").withColumn("mid", mid).filter("mid IS NOT NULL").groupBy(r.known_title().alias("title"), r.salary_band(F.col("mid")).alias("band")).agg(n().alias("n"))


@plan("a10_salary_of_skilled_jobs", "J", "JS", sql=f"WITH top AS (SELECT skill FROM JS GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 3), k AS (SELECT job_id FROM JS JOIN top USING (skill) GROUP BY job_id HAVING count(DISTINCT skill) >= 2), m AS (SELECT {MID} AS mid FROM J WHERE job_id IN (SELECT job_id FROM k)) SELECT {BAND} AS band, count(*) AS n FROM m WHERE mid IS NOT NULL GROUP BY 1")
def a10(jobs, skills):
    top = r.top(skills.groupBy("skill").agg(n().alias("c")), 3, F.desc("c"), F.asc("skill")).select("skill")
    both = skills.join(F.broadcast(top), "skill").groupBy("job_id").agg(F.count_distinct("skill").alias("k")).filter("k >= 2")
    mid = r.midpoint(F.col("salary_min"), F.col("salary_max"))
    return jobs.join(both, "job_id", "left_semi").withColumn("mid", mid).filter("mid IS NOT NULL").groupBy(r.salary_band(F.col("mid")).alias("band")).agg(n().alias("n"))


@plan("a11_top_advertisers", "J", sql="SELECT company, count(*) AS n FROM J GROUP BY company ORDER BY n DESC, company LIMIT 25")
def a11(jobs):
    return r.top(jobs.groupBy("company").agg(n().alias("n")), 25, F.desc("n"), F.asc("company"))


@plan("a12_posting_history", "J", sql="SELECT coalesce(merged_title, 'unknown') AS title, year(created) AS year, month(created) AS month, count(*) AS n FROM J GROUP BY ALL")
def a12(jobs):
    return jobs.groupBy(r.known_title().alias("title"), F.year("created").cast("long").alias("year"), F.month("created").cast("long").alias("month")).agg(n().alias("n"))


@plan("a13_unknown_group", "J", sql="SELECT coalesce(merged_title, 'unknown') AS title, count(*) AS n FROM J GROUP BY 1")
def a13(jobs):
    return jobs.groupBy(r.known_title().alias("title")).agg(n().alias("n"))


@plan("a14_having_and_order", "JS", sql="SELECT skill, count(*) AS n FROM JS GROUP BY skill HAVING count(*) >= 900 ORDER BY n DESC, skill")
def a14(skills):
    return skills.groupBy("skill").agg(n().alias("n")).filter("n >= 900").orderBy(F.desc("n"), "skill")


@plan("a15_weighted_average", "J", sql="WITH b AS (SELECT merged_title, least(salary_min // 5000, 6) * 5000 AS lower, count(*) AS c FROM J WHERE salary_min IS NOT NULL AND merged_title IS NOT NULL GROUP BY ALL) SELECT merged_title, round(sum(CASE WHEN lower = 30000 THEN lower ELSE lower + 2500 END * c)::DOUBLE / sum(c)::DOUBLE, 6) AS avg_salary FROM b GROUP BY 1")
def a15(jobs):
    lower = F.least(F.expr("salary_min div 5000"), F.lit(6)) * 5000
    bins = jobs.filter("salary_min IS NOT NULL AND merged_title IS NOT NULL").groupBy("merged_title", lower.alias("lower")).agg(n().alias("c"))
    mid = F.when(F.col("lower") == 30000, F.col("lower")).otherwise(F.col("lower") + 2500)
    return bins.groupBy("merged_title").agg(F.round(F.sum(mid * F.col("c")).cast("double") / F.sum("c").cast("double"), 6).alias("avg_salary"))


@plan("a16_sector_average", "J", sql="WITH c AS (SELECT category, merged_title, sum(salary_min) AS s, count(salary_min) AS k FROM J WHERE merged_title IS NOT NULL AND salary_min IS NOT NULL GROUP BY ALL) SELECT category, round(sum(s)::DOUBLE / sum(k)::DOUBLE, 6) AS avg_salary, string_agg(merged_title, ',' ORDER BY merged_title) AS careers FROM c GROUP BY category")
def a16(jobs):
    careers = jobs.filter("merged_title IS NOT NULL AND salary_min IS NOT NULL").groupBy("category", "merged_title").agg(F.sum("salary_min").alias("s"), F.count("salary_min").alias("k"))
    return careers.groupBy("category").agg(F.round(F.sum("s").cast("double") / F.sum("k").cast("double"), 6).alias("avg_salary"), F.array_join(F.array_sort(F.collect_list("merged_title")), ",").alias("careers"))


@plan("a17_career_document", "J", "JS", sql="""WITH h AS (SELECT merged_title, strftime(created, '%Y-%m') AS m, count(*) AS c FROM J WHERE merged_title IS NOT NULL GROUP BY ALL),
k AS (SELECT merged_title, skill, count(*) AS c, row_number() OVER (PARTITION BY merged_title ORDER BY count(*) DESC, skill) AS rn FROM JS JOIN J USING (job_id) WHERE merged_title IS NOT NULL GROUP BY merged_title, skill),
hs AS (SELECT merged_title, string_agg(m || '=' || CAST(c AS VARCHAR), ';' ORDER BY m) AS history FROM h GROUP BY 1), ks AS (SELECT merged_title, string_agg(skill, ';' ORDER BY rn) AS skills FROM k WHERE rn <= 5 GROUP BY 1),
b AS (SELECT merged_title, least(salary_min // 5000, 6) * 5000 AS lower, count(*) AS c FROM J WHERE salary_min IS NOT NULL AND merged_title IS NOT NULL GROUP BY ALL),
bs AS (SELECT merged_title, string_agg(CAST(lower AS VARCHAR) || '=' || CAST(c AS VARCHAR), ';' ORDER BY lower) AS bins, round(sum(CASE WHEN lower = 30000 THEN lower ELSE lower + 2500 END * c)::DOUBLE / sum(c)::DOUBLE, 6) AS avg_salary FROM b GROUP BY 1)
SELECT merged_title, history, skills, bins, avg_salary, 'The work of ' || lower(merged_title) AS description FROM hs JOIN ks USING (merged_title) LEFT JOIN bs USING (merged_title)""")
def a17(jobs, skills):
    known = jobs.filter("merged_title IS NOT NULL")
    history = known.groupBy("merged_title", F.date_format("created", "yyyy-MM").alias("m")).agg(n().alias("c"))
    history = history.groupBy("merged_title").agg(F.array_sort(F.collect_list(F.struct("m", "c"))).alias("h"))
    counts = skills.join(known.select("job_id", "merged_title"), "job_id").groupBy("merged_title", "skill").agg(n().alias("c"))
    ranked = counts.withColumn("rn", F.row_number().over(W.partitionBy("merged_title").orderBy(F.desc("c"), "skill"))).filter("rn <= 5")
    cloud = ranked.groupBy("merged_title").agg(F.array_sort(F.collect_list(F.struct("rn", "skill"))).alias("s"))
    lower = F.least(F.expr("salary_min div 5000"), F.lit(6)) * 5000
    bins = known.filter("salary_min IS NOT NULL").groupBy("merged_title", lower.alias("lower")).agg(n().alias("c"))
    bins = bins.groupBy("merged_title").agg(F.array_sort(F.collect_list(F.struct("lower", "c"))).alias("b")).join(a15(jobs), "merged_title")
    texts = known.select("merged_title").distinct().withColumn("description", F.concat(F.lit("The work of "), F.lower("merged_title")))
    return history.join(cloud, "merged_title").join(bins, "merged_title", "left").join(texts, "merged_title", "left").select(
        "merged_title", F.array_join(F.transform("h", lambda x: F.concat(x["m"], F.lit("="), x["c"].cast("string"))), ";").alias("history"),
        F.array_join(F.transform("s", lambda x: x["skill"]), ";").alias("skills"),
        F.array_join(F.transform("b", lambda x: F.concat(x["lower"].cast("string"), F.lit("="), x["c"].cast("string"))), ";").alias("bins"),
        "avg_salary", "description")


@plan("a18_description_fallback", "P", sql="WITH d AS (SELECT company, sector, min(name) AS text FROM P WHERE sector = 'BUILDING' GROUP BY ALL), g AS (SELECT company, min(name) AS text FROM P GROUP BY company) SELECT profile_id, coalesce(d.text, g.text) AS description FROM P LEFT JOIN d USING (company, sector) LEFT JOIN g USING (company)")
def a18(p):
    own = p.filter("sector = 'BUILDING'").groupBy("company", "sector").agg(F.min("name").alias("own"))
    general = p.groupBy("company").agg(F.min("name").alias("general"))
    return p.join(own, ["company", "sector"], "left").join(general, "company", "left").select("profile_id", F.coalesce("own", "general").alias("description"))


@plan("a19_ranked_descriptions", "P", sql="SELECT sector, name, row_number() OVER (PARTITION BY sector ORDER BY score DESC, profile_id) AS rank FROM P QUALIFY rank <= 10")
def a19(p):
    return p.select("sector", "name", F.row_number().over(W.partitionBy("sector").orderBy(F.desc("score"), "profile_id")).cast("long").alias("rank")).filter("rank <= 10")


@plan("a22_metric_rollup", "J", "JS", sql="SELECT merged_title, max(salary_max) AS max_salary, min(salary_min) AS min_salary, count(DISTINCT skill) AS n_skills, max(pos) AS max_pos FROM J JOIN JS USING (job_id) WHERE merged_title IS NOT NULL GROUP BY 1")
def a22(jobs, skills):
    both = jobs.filter("merged_title IS NOT NULL").join(skills, "job_id")
    return both.groupBy("merged_title").agg(F.max("salary_max").alias("max_salary"), F.min("salary_min").alias("min_salary"), F.count_distinct("skill").alias("n_skills"), F.max("pos").alias("max_pos"))


@plan("a23_bridge_lookup", "P", "area", sql="SELECT DISTINCT sector, nuts0 FROM P JOIN area USING (la_id)")
def a23(p, areas):
    return p.join(areas, "la_id").select("sector", "nuts0").distinct()


@plan("a24_facets", "J", "JS", sql="SELECT skill, count(*) AS n FROM JS JOIN J USING (job_id) WHERE merged_title IN ('BUILDING', 'MACHINERY') GROUP BY skill ORDER BY n DESC, skill LIMIT 10")
def a24(jobs, skills):
    rows = skills.join(r.title_filter(jobs, ["BUILDING", "MACHINERY"]).select("job_id"), "job_id")
    return r.top(rows.groupBy("skill").agg(n().alias("n")), 10, F.desc("n"), F.asc("skill"))


@plan("a25_people_in_career", "P", sql="SELECT count(*) AS n FROM P WHERE company IN ('Supplier 1 Ltd', 'Supplier 2 Ltd') OR (sector = 'BUILDING' AND company IN ('Supplier 3 Ltd', 'Supplier 4 Ltd'))")
def a25(p):
    general = F.col("company").isin("Supplier 1 Ltd", "Supplier 2 Ltd")
    specific = (F.col("sector") == "BUILDING") & F.col("company").isin("Supplier 3 Ltd", "Supplier 4 Ltd")
    return p.filter(general | specific).agg(n().alias("n"))


@plan("a26_ordered_groups", "X", sql="SELECT profile_id, string_agg(title, ',' ORDER BY start_ts, exp_id) AS titles FROM X GROUP BY profile_id")
def a26(x):
    rows = F.array_sort(F.collect_list(F.struct("start_ts", "exp_id", "title")))
    return x.groupBy("profile_id").agg(F.array_join(F.transform(rows, lambda v: v["title"]), ",").alias("titles"))


@plan("a27_key_ranges", "J", sql="WITH d AS (SELECT la_id AS k, row_number() OVER (ORDER BY la_id) AS rn FROM (SELECT DISTINCT la_id FROM J)), b AS (SELECT k, rn FROM d WHERE rn % 4 = 1) SELECT k AS from_key, lead(k) OVER (ORDER BY k) AS to_key, rn FROM b")
def a27(jobs):
    keys = jobs.select(F.col("la_id").alias("k")).distinct()
    ranked = h.numbered(keys, "k", "rn").filter("rn % 4 = 1")
    # one row for each range
    return ranked.select(F.col("k").alias("from_key"), F.lead("k").over(W.orderBy("k")).alias("to_key"), "rn")


@plan("a28_even_split", "J", sql="WITH d AS (SELECT DISTINCT company FROM J) SELECT company, CAST(ntile(8) OVER (ORDER BY company) AS BIGINT) AS chunk FROM d")
def a28(jobs):
    return h.even_split(jobs.select("company").distinct(), "company", 8, "chunk")


@plan("a29_distinct_totals", "P", sql="SELECT count(*) AS n_profiles, count(DISTINCT company) AS n_companies, count_if(score > 0) AS n_positive, count_if(sector IS NOT NULL) AS n_with_sector FROM P")
def a29(p):
    return p.agg(n().alias("n_profiles"), F.count_distinct("company").alias("n_companies"), F.count_if(F.col("score") > 0).alias("n_positive"), F.count_if(F.col("sector").isNotNull()).alias("n_with_sector"))


@plan("k2_row_number_distinct", "J", sql="SELECT category, row_number() OVER (ORDER BY category) AS rn FROM (SELECT DISTINCT category FROM J)")
def k2(jobs):
    return jobs.select("category").distinct().withColumn("rn", F.row_number().over(W.orderBy("category")).cast("long"))


@plan("k4_running_sum", "J", sql="WITH m AS (SELECT merged_title, date_trunc('month', created)::DATE AS m, count(*) AS c FROM J WHERE merged_title IS NOT NULL GROUP BY ALL) SELECT merged_title, m, CAST(sum(c) OVER (PARTITION BY merged_title ORDER BY m ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM m")
def k4(jobs):
    m = jobs.filter("merged_title IS NOT NULL").groupBy("merged_title", F.to_date(F.date_trunc("month", "created")).alias("m")).agg(n().alias("c"))
    w = W.partitionBy("merged_title").orderBy("m").rowsBetween(W.unboundedPreceding, W.currentRow)
    return m.select("merged_title", "m", F.sum("c").over(w).alias("total"))


@plan("k5_multi_key_sort", "J", sql="SELECT category, salary_period, count(*) AS n FROM J GROUP BY ALL ORDER BY category, n DESC")
def k5(jobs):
    return jobs.groupBy("category", "salary_period").agg(n().alias("n")).orderBy("category", F.desc("n"))


@plan("k6_top_k", "JS", sql="SELECT skill, count(*) AS n FROM JS GROUP BY skill ORDER BY n DESC, skill LIMIT 10")
def k6(skills):
    return r.top(skills.groupBy("skill").agg(n().alias("n")), 10, F.desc("n"), F.asc("skill"))


@plan("k10_distinct_on", "P", sql="SELECT sector, arg_min(name, profile_id) AS name FROM P GROUP BY sector")
def k10(p):
    return p.groupBy("sector").agg(F.min_by("name", "profile_id").alias("name"))


@plan("k12_key_intersection", "J", "JS", sql="SELECT count(*) AS n FROM (SELECT skill FROM JS JOIN J USING (job_id) WHERE merged_title = 'BUILDING' INTERSECT SELECT skill FROM JS JOIN J USING (job_id) WHERE merged_title = 'MACHINERY')")
def k12(jobs, skills):
    of = lambda t: skills.join(r.title_filter(jobs, [t]).select("job_id"), "job_id").select("skill")
    return of("BUILDING").intersect(of("MACHINERY")).agg(n().alias("n"))


@plan("k13_request_grid", "region", "nation", sql="SELECT r_name, n_name FROM region, nation WHERE r_regionkey <> n_regionkey")
def k13(region, nation):
    return nation.crossJoin(region).filter("r_regionkey <> n_regionkey").select("r_name", "n_name")


QUERIES, ORACLES = plan.queries, plan.oracles
