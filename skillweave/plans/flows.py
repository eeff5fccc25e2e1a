"""Streams, sinks and file formats, each a round trip over whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions import text as t
from skillweave.operators import aliases, areas, profiles
from skillweave.plans.register import Plans
from skillweave.plans.text import holed_regions, regions
from skillweave.sources import files
from skillweave.sources.fixtures import oracle_with, table
from skillweave.streaming import crawl

plan = Plans()
n = lambda: F.count(F.lit(1))


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Like plan, for queries that need the session and the folder."""

    def add(fn):
        plan.queries[name] = fn
        if sql is not None:
            plan.oracles[name] = oracle_with(views, sql)
        return fn

    return add


@register("st1_daily_stream", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def st1(spark, sf_dir):
    stats = crawl.daily_statistics(crawl.event_stream(spark, f"{sf_dir}/event[s].parquet"))
    out = spark.read.parquet(crawl.run_once(stats, "complete", crawl.scratch(spark)))
    return out.withColumn("day", F.col("day").cast("timestamp_ntz"))


@register("st2_distinct_stream", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def st2(spark, sf_dir):
    stream = crawl.event_stream(spark, f"{sf_dir}/event[s].parquet")
    once = crawl.distinct_events(stream.union(stream).select("event_id", "ts", "event_type"), "40 days")
    return spark.read.parquet(crawl.run_once(once, "append", crawl.scratch(spark))).groupBy("event_type").agg(n().alias("n"))


@register("s3_csv_with_comments", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s3(spark, sf_dir):
    folder = crawl.scratch(spark)
    customer = table(spark, sf_dir, "customer")
    lines = customer.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string")).alias("value"))
    notes = spark.range(3).select(F.concat(F.lit("# note "), F.col("id").cast("string")).alias("value"))
    lines.unionByName(notes).write.text(folder)
    return files.read_csv(spark, folder, "c_custkey long, c_name string, c_acctbal double")[0]


@register("s4_skill_list", "SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'de' ELSE 'en' END AS lang, p_name AS skill FROM part")
def s4(spark, sf_dir):
    folder = crawl.scratch(spark)
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("de, "), "p_name")).otherwise(F.col("p_name"))
    table(spark, sf_dir, "part").select(line.alias("value")).distinct().write.text(folder)
    return files.read_skill_list(spark, folder)


@register("s5_skill_vector_file", "SELECT category AS title, skill, (pos * 2)::DOUBLE AS w FROM (SELECT category, skill, max(pos) AS pos FROM JS JOIN J USING (job_id) GROUP BY ALL)", ("J", "JS"))
def s5(spark, sf_dir):
    rows = table(spark, sf_dir, "JS").join(table(spark, sf_dir, "J").select("job_id", "category"), "job_id")
    v = rows.groupBy(F.col("category").alias("title"), "skill").agg(F.max("pos").cast("double").alias("w")).withColumn("n", F.lit(2))
    folder = crawl.scratch(spark)
    files.write_skill_vectors(v, folder)
    return files.read_skill_vectors(spark, folder)


@register("s6_skill_vector_lines", "SELECT tag, count(*) AS n FROM (SELECT 't' AS tag FROM (SELECT DISTINCT category FROM JS JOIN J USING (job_id)) UNION ALL SELECT 's' FROM (SELECT DISTINCT category, skill FROM JS JOIN J USING (job_id))) GROUP BY tag", ("J", "JS"))
def s6(spark, sf_dir):
    rows = table(spark, sf_dir, "JS").join(table(spark, sf_dir, "J").select("job_id", "category"), "job_id")
    folder = crawl.scratch(spark)
    files.write_skill_vectors(rows.groupBy(F.col("category").alias("title"), "skill").agg(n().cast("double").alias("w")).withColumn("n", F.lit(1)), folder)
    return spark.read.text(folder).groupBy(F.substring_index("value", ",", 1).alias("tag")).agg(n().alias("n"))


@register("s8_job_api_records", "SELECT o_orderkey AS id, o_orderpriority AS title, CASE o_orderkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS full_time, o_orderstatus AS category, 'UK' AS location0, CASE WHEN o_orderkey % 2 = 0 THEN 'London' END AS location1 FROM orders")
def s8(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    area = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("UK"), F.lit("London"))).otherwise(F.array(F.lit("UK")))
    flag = F.when(F.col("o_orderkey") % 3 == 0, "0").when(F.col("o_orderkey") % 3 == 1, "1")
    doc = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"), flag.alias("full_time"), F.struct(area.alias("area")).alias("location"), F.struct(F.col("o_orderstatus").alias("tag")).alias("category"))
    return files.job_records(o.select(F.to_json(doc).alias("json"))).drop("location2", "location3", "location4")


@register("s9_ingest_columns", "SELECT o_orderkey, 'jobs' AS category, 'http://example.com/' || CAST(o_orderkey AS VARCHAR) AS url, true AS stamped FROM orders")
def s9(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("indexed_on", F.current_timestamp())
    return o.select("o_orderkey", F.lit("jobs").alias("category"), F.concat(F.lit("http://example.com/"), F.col("o_orderkey").cast("string")).alias("url"), F.col("indexed_on").isNotNull().alias("stamped"))


@register("s10_csv_report", "SELECT company, CAST(count(*) AS VARCHAR) AS n FROM J GROUP BY company", ("J",))
def s10(spark, sf_dir):
    folder = crawl.scratch(spark)
    table(spark, sf_dir, "J").groupBy("company").agg(n().alias("n")).write.csv(folder, header=True)
    return spark.read.csv(folder, header=True)


@register("s8_job_api_dimensions", "SELECT 'category' AS kind, o_orderstatus AS tag, 'Status ' || o_orderstatus AS label FROM orders UNION SELECT 'company', NULL, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def s8_dimensions(spark, sf_dir):
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    doc = F.struct(F.struct(F.col("o_orderstatus").alias("tag"), F.concat(F.lit("Status "), "o_orderstatus").alias("label")).alias("category"), F.struct(F.col("c_name").alias("display_name")).alias("company"))
    categories, companies = files.job_dimensions(both.select(F.to_json(doc).alias("json")))
    return categories.select(F.lit("category").alias("kind"), "tag", "label").unionByName(companies.select(F.lit("company").alias("kind"), F.lit(None).cast("string").alias("tag"), F.col("company").alias("label")))


@register("s11_geojson_features", "WITH c AS (SELECT n_nationkey % 5 * 2000 - 1000 AS x, n_nationkey // 5 * 300 AS y, * FROM nation) SELECT r_name AS country, count(*) AS n, min(x)::DOUBLE AS west, min(y)::DOUBLE AS south, max(x + 2000)::DOUBLE AS east, max(y + 300)::DOUBLE AS north FROM c JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def s11(spark, sf_dir):
    """Features with their polygons are written and read back; then the box of each country."""
    nation = table(spark, sf_dir, "nation")
    codes = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("R"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"), "r_name")
    folder = crawl.scratch(spark)
    files.geojson_features(regions(nation).join(codes, "code"), "code", "r_name", "parts").write.text(folder)
    back = files.read_features(spark, folder)
    return back.groupBy(F.col("name").alias("country")).agg(n().alias("n")).join(files.bounds(back.withColumnRenamed("name", "country"), "country", "parts"), "country")


@register("s11_multi_polygons", "SELECT 'H' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name, 2 AS n_polygons, 15 AS n_points, 510000.0::DOUBLE AS area FROM nation")
def s11_parts(spark, sf_dir):
    """Regions of two polygons, one with a hole, written as features and read back: what they are made of and their area."""
    nation = table(spark, sf_dir, "nation")
    names = nation.select(F.concat(F.lit("H"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"), "n_name")
    folder = crawl.scratch(spark)
    files.geojson_features(holed_regions(nation).join(names, "code"), "code", "n_name", "parts").write.text(folder)
    back = files.read_features(spark, folder)
    points = F.size(F.flatten(F.flatten("parts")))
    return back.select(F.col("id").alias("code"), "name", F.size("parts").alias("n_polygons"), points.alias("n_points"), areas.area(F.col("parts")).alias("area"))


@register("a20_salary_bins", "WITH b AS (SELECT category, (salary_min // 10000) * 10000 AS lower, count(*) AS c FROM J WHERE salary_min IS NOT NULL GROUP BY ALL) SELECT category, lower, lead(lower) OVER (PARTITION BY category ORDER BY lower) AS upper, c FROM b", ("J",))
def a20(spark, sf_dir):
    bins = table(spark, sf_dir, "J").filter("salary_min IS NOT NULL").groupBy("category", (F.expr("salary_min div 10000") * 10000).alias("lower")).agg(n().alias("c"))
    stored = bins.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("lower", "c"))).alias("bins"))
    rows = stored.select("category", F.explode("bins").alias("lower", "c"))
    return rows.withColumn("upper", F.lead("lower").over(W.partitionBy("category").orderBy("lower")))


@register("a20_salary_history", "SELECT category, date_trunc('month', created)::DATE AS month, round(avg(salary_min), 6) AS salary FROM J WHERE salary_min IS NOT NULL GROUP BY ALL", ("J",))
def a20_history(spark, sf_dir):
    """A map of months to salaries, as rows with dates."""
    months = table(spark, sf_dir, "J").filter("salary_min IS NOT NULL").groupBy("category", F.date_format("created", "yyyy-MM").alias("m")).agg(F.avg("salary_min").alias("salary"))
    stored = months.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("m", "salary"))).alias("history"))
    return stored.select("category", F.explode("history").alias("m", "salary")).select("category", F.to_date(F.concat("m", F.lit("-01"))).alias("month"), F.round("salary", 6).alias("salary"))


@register("a21_occupation_counts", "SELECT sector, coalesce(CASE sector WHEN 'BUILDING' THEN (SELECT count(*) FROM P) WHEN 'MACHINERY' THEN 7 END, count(*)) AS n FROM P GROUP BY sector", ("P",))
def a21(spark, sf_dir):
    p = table(spark, sf_dir, "P")
    codes = spark.createDataFrame([("BUILDING", 101), ("MACHINERY", 102)], "sector string, code int")
    counts = p.agg(n().alias("official")).select(F.lit(101).alias("code"), "official").unionByName(spark.createDataFrame([(102, 7)], "code int, official long"))
    own = p.groupBy("sector").agg(n().alias("own"))
    return own.join(codes, "sector", "left").join(counts, "code", "left").select("sector", F.coalesce("official", "own").alias("n"))


@register("t37_label_words", "SELECT p_partkey, p_name AS label FROM part")
def t37(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", t.without_words(F.concat(F.lit("Ranks "), "p_name", F.lit(" rankings")), t.RANK_WORDS).alias("label"))


@register("t37_course_fields", "SELECT id, CAST(substr(d, 1, 1) AS INTEGER) AS years, CASE WHEN p = 'Not Available' THEN NULL ELSE CAST(split_part(p, '-', 1) AS INTEGER) END AS low, CASE WHEN contains(p, '-') THEN CAST(split_part(p, '-', 2) AS INTEGER) END AS high FROM C", ("C",))
def t37_course(spark, sf_dir):
    low, high = t.points_range(F.col("p"))
    return table(spark, sf_dir, "C").select("id", t.leading_digit(F.col("d")).alias("years"), low.alias("low"), high.alias("high"))


@register("r12_alternative_urls", r"SELECT key, min(page_id) AS kept, count(*) AS n_versions FROM (SELECT page_id, regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^https?://(?:www\.|m\.)?', '') AS key FROM pages) GROUP BY key")
def r12(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    old = pages.select("page_id", F.regexp_replace(F.substring_index(F.substring_index("url", "#", 1), "?", 1), r"^https?://(?:www\.|m\.)?", "").alias("key"))
    return old.groupBy("key").agg(F.min("page_id").alias("kept"), n().alias("n_versions"))


_SAME = r"lower(regexp_replace(regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^https?://(?:www\.|m\.)*', ''), '(?:\.html?|/)+$', ''))"


@register("r12_alias_survivors", f"""
    WITH RECURSIVE k AS (SELECT page_id AS id, 'u' || {_SAME} AS key FROM pages
      UNION SELECT page_id, 'a' || regexp_extract(html, '<article>(.*?)</article>', 1, 's') FROM pages WHERE contains(html, '<article>')
      UNION SELECT page_id, 't' || regexp_extract(html, '<title>(.*?)</title>', 1, 's') FROM pages WHERE contains(html, '<title>')),
    e AS (SELECT DISTINCT a.id AS a, b.id AS b FROM k a JOIN k b USING (key)),
    c AS (SELECT a AS id, b AS other FROM e UNION SELECT c.id, e.b FROM c JOIN e ON c.other = e.a),
    r AS (SELECT id, min(other) AS class_id FROM c GROUP BY id),
    s AS (SELECT class_id, min_by(page_id, (CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END, length(url), page_id)) AS survivor FROM r JOIN pages ON id = page_id GROUP BY class_id)
    SELECT page_id, class_id, survivor, survivor <> page_id AS removed FROM pages JOIN r ON id = page_id JOIN s USING (class_id)""")
def r12_survivors(spark, sf_dir):
    """Pages of one address, article or title are one page, over any number of steps; the https one of the shortest address stays."""
    pages = table(spark, sf_dir, "pages")
    inside = lambda tag: F.when(F.col("html").rlike(f"<{tag}>"), F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1))
    links = aliases.links_by_key(pages, "page_id", [F.lower(aliases.url_key(F.col("url"))), inside("article"), inside("title")])
    return aliases.one_of_each(pages.select("page_id", "url"), "page_id", links, [~F.col("url").startswith("https:"), F.length("url")]).drop("url")


_TEXT = "html"
for _pattern, _by in ((r"(?is)<script\b.*?</script>|<style\b.*?</style>", ""), (r"(?i)<br\s*/?>", "\n"), (r"(?i)</?p\b[^>]*>", "\n\n"), (r"(?s)<[^>]*>", ""), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")):
    _TEXT = f"regexp_replace({_TEXT}, '{_pattern}', '{_by}', 'g')"


@register("t25_page_text", f"SELECT page_id, trim({_TEXT}) AS text FROM pages")
def t25(spark, sf_dir):
    """Breaks become line feeds and paragraphs blank lines; scripts and styles go."""
    html = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", "")
    html = F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>", "\n"), r"(?i)</?p\b[^>]*>", "\n\n")
    text = F.regexp_replace(t.strip_tags(html), r"[ \t]+", " ")
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n")).alias("text"))


@register("p5_canonical_profiles", "SELECT profile_id, 'sector:A:en:' || lower(sector) AS sector_key, 'company:A:en:' || lower(regexp_replace(company, ' Ltd$', '')) AS company_key, upper(name) AS shown FROM P", ("P",))
def p5(spark, sf_dir):
    stop = ("the", "of", "and")
    spec = {
        "sector_key": t.key("sector", "A", "en", t.clean(F.col("sector"), stop=stop)),
        "company_key": t.key("company", "A", "en", t.company_name(F.col("company"), list(stop))),
        "shown": F.upper("name"),
    }
    return table(spark, sf_dir, "P").select("profile_id", *[c.alias(k) for k, c in spec.items()])


@register("p5_career_profiles", """
    WITH dated AS (SELECT *, date(start_ts) AS s, date(end_ts) AS e FROM X), n AS (SELECT profile_id, count(*) AS n_experiences, sum(length(title)) AS chars, min(s) AS first_start, max(s) AS last_start,
      arg_min(title, (s, exp_id)) AS first_title, arg_min(company, (s, exp_id)) AS first_company, arg_max(title, (s, -exp_id)) FILTER (e IS NULL) AS open_title, arg_max(company, (s, -exp_id)) FILTER (e IS NULL) AS open_company,
      any_value(title) AS a_title, any_value(company) AS a_company FROM dated GROUP BY profile_id),
    people AS (SELECT profile_id, sector, name, company AS own FROM P)
    SELECT people.profile_id, coalesce(n_experiences, 0) AS n_experiences, first_start AS first_experience_start, last_start AS last_experience_start, first_title, first_company,
      coalesce(CASE WHEN n_experiences = 1 THEN a_title ELSE open_title END, name) AS curr_title, coalesce(CASE WHEN n_experiences = 1 THEN a_company ELSE open_company END, own) AS company,
      'company:careers:en:' || lower(coalesce(CASE WHEN n_experiences = 1 THEN a_company ELSE open_company END, 'supplier ' || split_part(own, ' ', 2))) AS nrm_company,
      'sector:careers:en:' || lower(sector) AS nrm_sector, 'title:careers:en:' || CASE first_title WHEN 'purchase' THEN 'purchas' ELSE first_title END AS nrm_first_title,
      CAST(length(name || ' at ' || own) + coalesce(chars, 0) AS BIGINT) AS text_length
    FROM people LEFT JOIN n USING (profile_id)""", ("P", "X"))
def p5_careers(spark, sf_dir):
    """Whole canonical rows of people with their experiences, in the order of their ids, nested."""
    e = F.struct("exp_id", "title", "company", F.lit(None).cast("string").alias("description"), F.to_date("start_ts").alias("start"), F.to_date("end_ts").alias("end"))
    own = table(spark, sf_dir, "X").groupBy("profile_id").agg(F.array_sort(F.collect_list(e)).alias("experiences"))
    people = table(spark, sf_dir, "P").select("profile_id", "name", "sector", F.concat_ws(" at ", "name", "company").alias("title"), F.lit("en").alias("language")).join(own, "profile_id", "left")
    people = people.withColumn("educations", F.array().cast("array<struct<institute: string, degree: string, subject: string, start: date, end: date>>"))
    columns = ("n_experiences", "first_experience_start", "last_experience_start", "first_title", "first_company", "curr_title", "company", "nrm_company", "nrm_sector", "nrm_first_title", "text_length")
    return profiles.canonical(people, profiles.CAREERS).select("profile_id", *columns)


@register("j11_nearest_centroid", """
    WITH p AS (SELECT vec_id, label, item, embedding[item]::DOUBLE AS w FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS item FROM embeddings)),
    c AS (SELECT label, item, avg(w) AS w FROM p GROUP BY ALL), m AS (SELECT label, item, w / sqrt(sum(w * w) OVER (PARTITION BY label)) AS y FROM c),
    d AS (SELECT vec_id, m.label, sum(p.w * y) AS dot FROM p JOIN m USING (item) GROUP BY ALL)
    SELECT vec_id, arg_max(label, (round(dot, 9), label)) AS cluster FROM d GROUP BY vec_id""")
def v5c(spark, sf_dir):
    """Each vector's nearest label centroid by angle."""
    v = table(spark, sf_dir, "embeddings")
    parts = v.select("vec_id", "label", F.posexplode("embedding").alias("item", "w")).withColumn("w", F.col("w").cast("double"))
    centre = parts.groupBy("label", "item").agg(F.avg("w").alias("w"))
    norm = centre.withColumn("nn", F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("label"))))
    dots = parts.select("vec_id", "item", F.col("w").alias("x")).join(F.broadcast(norm.select("label", "item", (F.col("w") / F.col("nn")).alias("y"))), "item").groupBy("vec_id", "label").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    return dots.groupBy("vec_id").agg(F.max_by("label", F.struct(F.round("dot", 9), "label")).alias("cluster"))


QUERIES, ORACLES = plan.queries, plan.oracles
