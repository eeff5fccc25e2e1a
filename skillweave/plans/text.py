"""Text canonicalisation, salaries, phrases, pages, duplicates, regions, streams."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions import text as t
from skillweave.functions.html import Field, page_fields
from skillweave.operators import areas
from skillweave.operators import history as h
from skillweave.operators import languages
from skillweave.operators import matching as m
from skillweave.operators import relevance as e
from skillweave.plans.register import Plans

plan = Plans()
n = lambda: F.count(F.lit(1))
STOP = ("a", "and", "at", "for", "in", "of", "on", "or", "the", "to", "with")
QUOTED = ", ".join(f"'{w}'" for w in STOP)
#: The plain canonical words of an expression, in DuckDB.
WORDS = "list_filter(string_split(trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
CLEAN = f"nullif(array_to_string(list_filter({WORDS}, lambda w: w NOT IN ({QUOTED})), ' '), '')"


@plan("t1_clean", "documents", sql=f"SELECT doc_id, {CLEAN.format(x='text')} AS clean FROM documents")
def t1(docs):
    return docs.select("doc_id", t.clean(F.col("text"), stop=STOP).alias("clean"))


@plan("t2_keys", "P", sql="SELECT profile_id, CASE WHEN profile_id % 9 = 0 THEN NULL ELSE 'company:' || 'A' || ':en:' || lower(company) END AS key, CASE WHEN profile_id % 9 = 0 THEN NULL ELSE lower(company) END AS name FROM P")
def t2(p):
    key = t.key("company", "A", "en", F.when(F.col("profile_id") % 9 != 0, F.lower("company")))
    return p.select("profile_id", key.alias("key"), t.key_parts(key)[3].alias("name"))


@plan("t3_skill_tokens", "TT", sql=f"SELECT id, array_to_string(list_filter({WORDS.format(x=chr(39) + 'c++ ' + chr(39) + ' || base')}, lambda w: true), ' ').replace('c ', 'cplusplus ') AS skill FROM TT")
def t3(tt):
    return tt.select("id", t.clean(F.concat(F.lit("c++ "), "base"), replace=t.SKILL_SPELLINGS).alias("skill"))


#: The published stems of the words in the tables, as DuckDB has no stemmer offline, and the canonical words of an expression stemmed.
STEM = "CASE w WHEN 'large' THEN 'larg' WHEN 'economy' THEN 'economi' WHEN 'engineer' THEN 'engin' WHEN 'university' THEN 'univers' WHEN 'apprentice' THEN 'apprentic' ELSE w END"
STEMMED = f"nullif(array_to_string(list_transform(list_filter({WORDS}, lambda w: w NOT IN ({QUOTED})), lambda w: {STEM}), ' '), '')"


def stemmed(sql: str) -> str:
    """The words of an expression stemmed, in DuckDB."""
    return f"array_to_string(list_transform(string_split({sql}, ' '), lambda w: {STEM}), ' ')"


@plan("t4_skill_keys", "part", sql=f"SELECT DISTINCT 'skill:A:en:' || {STEMMED.format(x='p_name')} AS key FROM part")
def t4(part):
    return part.select(t.key("skill", "A", "en", t.clean(F.col("p_name"), stop=STOP, stem_words=True)).alias("key")).distinct()


TITLE = "trim(lower(CASE WHEN id % 5 = 2 THEN '2x ' ELSE prefix END || base || replace(suffix, 'é', 'e')))"


@plan("t5_parsed_title", "TT", sql=f"SELECT id, {TITLE} AS parsed FROM TT")
def t5(tt):
    return tt.select("id", t.parsed_title(F.col("title")).alias("parsed"))


PREFIX = "nullif(trim(CASE id % 5 WHEN 0 THEN 'senior' WHEN 1 THEN 'junior lead' ELSE '' END || CASE WHEN id % 4 = 1 THEN ' intern' ELSE '' END), '')"
BARE = "trim(CASE WHEN id % 5 = 2 THEN '2x ' ELSE '' END || lower(base) || CASE id % 4 WHEN 0 THEN ' engineer' WHEN 2 THEN ' cafe' ELSE '' END)"


@plan("t6_title_prefix", "TT", sql=f"SELECT id, {PREFIX} AS prefix, {BARE} AS title FROM TT")
def t6(tt):
    return tt.select("id", t.split_title(F.split(t.parsed_title(F.col("title")), " ")).alias("s")).select("id", "s.prefix", "s.title")


@plan("t7_title_keys", "TT", sql=f"SELECT id, 'title:A:en:' || {stemmed(BARE)} AS key FROM TT")
def t7(tt):
    return e.per_text(tt, "title", {"key": lambda x: t.entity_key("title", "A", "en", x, STOP)}).select("id", "key")


@plan("t8_without_skills", "TT", sql="SELECT id, nullif(array_to_string(list_filter(string_split(lower(base) || ' red engineer business', ' '), lambda w, i: w NOT IN ('red', 'tin', 'steel') OR string_split(lower(base) || ' red engineer business', ' ')[i + 1] = 'engineer'), ' '), '') AS title FROM TT")
def t8(tt):
    return tt.select("id", t.without_skills(F.concat(F.lower("base"), F.lit(" red engineer business")), ["red", "tin", "steel", "business"]).alias("title"))


@plan("t9_job_post_title", "TT", sql="SELECT id, base AS title FROM TT")
def t9(tt):
    return tt.select("id", t.job_post_title(F.concat(F.lit("2x "), "base", F.lit(" £35k 6 months contract"))).alias("title"))


@plan("t10_job_post_keys", "TT", sql=f"SELECT id, 'title:B:en:' || {stemmed('lower(base)')} AS key FROM TT")
def t10(tt):
    clean = lambda x: t.clean(t.job_post_title(F.concat(x, F.lit(" urgently needed bonus"))), stop=[*STOP, "bonus", "benefits", "needed", "urgently"], stem_words=True)
    return e.per_text(tt, "base", {"key": lambda x: t.key("title", "B", "en", clean(x))}).select("id", "key")


@plan("t11_sector_keys", "customer", sql="SELECT DISTINCT 'sector:A:en:' || lower(c_mktsegment) AS key FROM customer")
def t11(customer):
    return customer.select(t.key("sector", "A", "en", t.clean(F.col("c_mktsegment"), stop=STOP)).alias("key")).distinct()


@plan("t12_company_keys", "P", sql="SELECT profile_id, lower(regexp_replace(company, ' Ltd$', '')) AS company FROM P")
def t12(p):
    return p.select("profile_id", t.company_name(F.concat("company", F.lit(", London - UK")), list(STOP)).alias("company"))


@plan("t13_location_text", "nation", sql="SELECT n_nationkey, 'the ' || lower(n_name) AS place FROM nation")
def t13(nation):
    return nation.select("n_nationkey", F.replace(t.squeeze(F.lower(F.concat(F.lit("  Area of   "), "n_name", F.lit(" ")))), F.lit("area of"), F.lit("the")).alias("place"))


@plan("t14_location_path", "nation", "region", sql="SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN r_name ELSE n_name || ', ' || r_name END AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def t14(nation, region):
    both = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("n_nationkey", F.nullif(F.concat_ws(", ", F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")), "r_name"), F.lit("")).alias("place"))


@plan("t15_institute_keys", "TT", sql=f"SELECT id, array_to_string(list_sort(list_transform(string_split('university ' || lower(base), ' '), lambda w: {STEM})), ' ') AS institute FROM TT")
def t15(tt):
    text = F.regexp_replace(F.lower(F.concat(F.lit("U. of "), "base")), r"\bu\.", "university")
    return tt.select("id", t.clean(text, stop=STOP, stem_words=True, order=True).alias("institute"))


DEGREE_FORMS = {0: ("B.Sc 1st", "bachelor of science"), 1: ("M.A", "master of arts"), 2: ("BEng", "bachelor of engineering"), 3: ("Ph. D.", "doctor of philosophy"), 4: ("MBA", "master of business administration"), 5: ("M.Phil", "master of philosophy"), 6: ("M S c", "master of science"), 7: ("ba", "bachelor of arts")}


@plan("t16_degree_keys", "TT", sql=f"SELECT id, CASE id % 8 {' '.join(f'WHEN {k} THEN {chr(39)}{full}{chr(39)}' for k, (_, full) in DEGREE_FORMS.items())} END || ' ' || lower(base) AS degree FROM TT")
def t16(tt):
    short = F.get(F.lit([s for s, _ in DEGREE_FORMS.values()]), F.col("id") % 8)
    return tt.select("id", t.degree_name(F.concat(short, F.lit(" "), "base", F.lit(" (Hons), honours"))).alias("degree"))


@plan("t17_subject_keys", "part", sql=f"SELECT DISTINCT {STEMMED.format(x='p_type')} AS subject FROM part")
def t17(part):
    return part.select(t.clean(F.substring_index(F.concat("p_type", F.lit("/other")), "/", 1), stop=STOP, stem_words=True).alias("subject")).distinct()


@plan("t18_entity_dispatch", "TT", sql=f"""WITH k AS (SELECT id, lower(base) AS b, {stemmed('lower(base)')} AS s, {BARE} AS title FROM TT)
SELECT id, 'skill:A:en:' || array_to_string(list_transform(list_filter(string_split(b, ' '), lambda w, i: list_position(string_split(b, ' '), w) = i), lambda w: {STEM}), ' ') AS skill, 'title:A:en:' || {stemmed('title')} AS title, 'job_title:A:en:' || s AS job_title, 'company:A:en:' || b AS company,
 'sector:A:en:' || b AS sector, 'institute:A:en:' || array_to_string(list_sort(list_transform(string_split(b, ' '), lambda w: {STEM})), ' ') AS institute, 'degree:A:en:' || s AS degree, 'subject:A:en:' || s AS subject FROM k""")
def t18(tt):
    """Every type of entity through the one dispatcher."""
    kinds = ("skill", "title", "job_title", "company", "sector", "institute", "degree", "subject")
    keys = {k: lambda x, k=k: t.entity_key(k, "A", "en", x, STOP) for k in kinds}
    with_title = e.per_text(tt.select("id", "base", "title"), "title", {"title_key": keys.pop("title")}).drop("title").withColumnRenamed("title_key", "title")
    return e.per_text(with_title, "base", keys).select("id", *kinds)


@plan("t19_is_company", "supplier", sql="SELECT s_suppkey, s_suppkey % 3 = 0 AS is_company FROM supplier")
def t19(supplier):
    return supplier.select("s_suppkey", t.is_company(F.concat("s_name", F.when(F.col("s_suppkey") % 3 == 0, " Ltd.").otherwise(" Group"))).alias("is_company"))


@plan("t20_text_length", "conversations", sql="SELECT conv_id, CAST(sum(length(text)) + sum(length(role)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id")
def t20(conversations):
    nested = conversations.groupBy("conv_id").agg(F.collect_list(F.struct("role", "text")).alias("m"))
    total = F.aggregate(F.transform("m", lambda x: F.coalesce(F.length(x["text"]), F.lit(0)) + F.coalesce(F.length(x["role"]), F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    return nested.select("conv_id", total.alias("n_chars"))


@plan("t21_full_name", "P", sql="SELECT profile_id, CASE WHEN profile_id % 3 = 0 THEN sector || ' ' || company ELSE name END AS full_name FROM P")
def t21(p):
    name = F.when(F.col("profile_id") % 3 != 0, F.col("name"))
    return p.select("profile_id", F.coalesce(name, F.nullif(F.concat_ws(" ", "sector", "company"), F.lit(""))).alias("full_name"))


@plan("t22_first_number", "customer", sql="SELECT c_custkey, TRY_CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT) AS number FROM customer")
def t22(customer):
    return customer.select("c_custkey", t.first_number(F.col("c_name")).alias("number"))


@plan("t23_artefact_tags", "JS", sql="SELECT job_id, string_agg(skill, '|' ORDER BY pos, skill) AS tags FROM JS GROUP BY job_id")
def t23(skills):
    tags = F.array_sort(F.collect_list(F.struct("pos", "skill")))
    nested = skills.groupBy("job_id").agg(F.concat(F.transform(tags, lambda x: x["skill"]), F.array(F.lit("See 10+"), F.lit("…"))).alias("tags"))
    return nested.select("job_id", F.array_join(F.filter("tags", lambda x: ~x.rlike(r"^See \d+\+$|^…$")), "|").alias("tags"))


@plan("t24_strip_tags", "pages", sql=r"SELECT page_id, lower(trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))) AS text FROM pages")
def t24(pages):
    return pages.select("page_id", F.lower(t.squeeze(t.strip_tags(F.col("html")))).alias("text"))


@plan("t26_page_fields", "pages", sql="""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, 'href="([^"]*)"')) AS n_links, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang FROM pages""")
def t26(pages):
    one = lambda p: F.regexp_extract("html", p, 1)
    return pages.select("page_id", one("<title>([^<]*)</title>").alias("title"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).cast("long").alias("n_links"), one('lang="([a-z]+)"').alias("lang"))


_UNESCAPED = "trim(regexp_replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '[\\x20\\x09-\\x0D]+', ' ', 'g'))"
_UNTAGGED = "regexp_replace(regexp_extract(html, '{p}', 1, 's'), '<[^>]*>', '', 'g')"


@plan("t26_page_selectors", "pages", sql=f"""
    SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, nullif({_UNESCAPED.format(x=_UNTAGGED.format(p="<h1>(.*?)</h1>"))}, '') AS head,
           nullif({_UNESCAPED.format(x=_UNTAGGED.format(p='<div class="ad">(.*?)</div>'))}, '') AS ad, nullif({_UNESCAPED.format(x=_UNTAGGED.format(p="<article>(.*)</article>"))}, '') AS body,
           array_to_string(regexp_extract_all(html, '<li><a href="([^"]*)"', 1), '|') AS links, nullif({_UNESCAPED.format(x=_UNTAGGED.format(p="<footer>(.*?)</footer>"))}, '') AS foot
    FROM pages WHERE contains(html, '<h1>') AND contains(html, '<article>')""")
def t26_selectors(pages):
    """Fields by selectors; pages without a head or an article are kept apart, so they aren't here."""
    spec = {
        "lang": Field("html", attr="lang"), "head": Field("article > h1", required=True), "ad": Field("body div.ad"), "body": Field("body > article", required=True),
        "links": Field("nav > ul > li > a[href]", attr="href", many=True), "foot": Field("footer"),
    }
    good, _ = page_fields(pages.select("page_id", "html"), spec)
    return good.withColumn("links", F.array_join(F.transform("links", lambda x: F.coalesce(x, F.lit(""))), "|"))


@plan("t27_posting_body", "pages", sql="SELECT page_id, coalesce(nullif(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), ''), nullif(regexp_extract(html, '<p>(.*?)</p>', 1, 's'), ''), '') AS body FROM pages")
def t27(pages):
    return pages.select("page_id", t.posting_body(F.col("html")).alias("body"))


@plan("t28_display_money", "J", sql="SELECT job_id, CASE WHEN salary_min IS NULL THEN NULL ELSE salary_min // 1000 * 1000 END AS value FROM J")
def t28(jobs):
    text = F.when(F.col("salary_min").isNull(), "Not Available").otherwise(F.concat(F.lit("£"), F.expr("salary_min div 1000").cast("string"), F.lit("k")))
    return jobs.select("job_id", t.money(text).alias("value"))


@plan("t29_complement_split", "P", sql="SELECT profile_id, CASE WHEN profile_id % 2 = 0 THEN profile_id % 101 ELSE 100 - profile_id % 101 END AS male, CASE WHEN profile_id % 2 = 0 THEN 100 - profile_id % 101 ELSE profile_id % 101 END AS female FROM P")
def t29(p):
    v, male = F.col("profile_id") % 101, F.col("profile_id") % 2 == 0
    return p.select("profile_id", F.when(male, v).otherwise(100 - v).alias("male"), F.when(male, 100 - v).otherwise(v).alias("female"))


@plan("t30_ratings", "orders", sql="SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS rating FROM orders")
def t30(orders):
    ranks = F.create_map(F.lit("F"), F.lit(0), F.lit("O"), F.lit(1), F.lit("P"), F.lit(2))
    return orders.select("o_orderkey", ranks[F.col("o_orderstatus")].alias("rating"))


@plan("t31_url_ids", "pages", sql="SELECT page_id, 'p_' || md5(url) AS id, split_part(url, '?', 1) AS bare, regexp_replace(lower(split_part(url, '://', 2)), '[^a-z0-9]+', '-', 'g') AS slug FROM pages")
def t31(pages):
    return pages.select("page_id", F.concat(F.lit("p_"), F.md5("url")).alias("id"), F.substring_index("url", "?", 1).alias("bare"), F.regexp_replace(F.lower(F.split("url", "://")[1]), "[^a-z0-9]+", "-").alias("slug"))


@plan("t32_taxonomy_paths", "nation", "region", sql="SELECT DISTINCT r_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def t32(nation, region):
    path = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.array("r_name", "n_name").alias("p"))
    return path.select("p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("k")).select(F.array_join(F.slice("p", F.lit(1), F.col("k")), "/").alias("path")).distinct()


@plan("t33_mapped_titles", "P", sql="SELECT profile_id, CASE lower(sector) WHEN 'building' THEN 'Construction' WHEN 'machinery' THEN 'Machines' ELSE sector END AS sector FROM P")
def t33(p):
    fixes = p.sparkSession.createDataFrame([("BUILDING", "Construction"), ("Machinery", "Machines")], "old string, fixed string").withColumn("k", F.lower("old"))
    return p.join(F.broadcast(fixes), F.lower("sector") == F.col("k"), "left").select("profile_id", F.coalesce("fixed", "sector").alias("sector"))


#: Trigrams, profiles and the nearest one in DuckDB, over texts x (k, country, text).
CHARS = r"string_split(' ' || trim(regexp_replace(lower({x}), '[^\p{{L}}]+', ' ', 'g')) || ' ', '')"
GRAMS = "SELECT {keys}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM (SELECT {keys}, {chars} AS c FROM {rows})"
PROFILES = f"known AS (SELECT lang, gram, {languages.PROFILE_SIZE} - row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) + 1 AS saved FROM ({GRAMS.format(keys='lang', chars=CHARS.format(x='text'), rows='documents')}) WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY lang, gram QUALIFY saved > 0)"
NEAREST = f"""grams AS ({GRAMS.format(keys="id", chars=CHARS.format(x="text"), rows="texts")}), total AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
sums AS (SELECT id, lang, sum(saved) AS saved, count(*) AS hits FROM grams JOIN known USING (gram) GROUP BY id, lang),
best AS (SELECT id, CASE WHEN hits * 100 >= {languages.LEAST_KNOWN} * n THEN lang END AS told FROM sums JOIN total USING (id) QUALIFY row_number() OVER (PARTITION BY id ORDER BY saved DESC, lang) = 1)"""


@plan("t34_language", "documents", sql=f"WITH {PROFILES}, texts AS (SELECT doc_id AS id, text FROM documents), {NEAREST} SELECT doc_id, lang, coalesce(told, 'en') AS guess FROM documents LEFT JOIN best ON id = doc_id")
def t34(docs):
    return languages.assigned(docs, ["doc_id", "lang"], "text", languages.profiles(docs), None, "en").withColumnRenamed("language", "guess")


@plan("t34_profile_language", "documents", "P", "nation", sql=f"WITH {PROFILES}, texts AS (SELECT profile_id AS id, CASE WHEN profile_id % 3 = 0 THEN NULL ELSE lower(sector) || ' ' || company END AS text FROM P), {NEAREST} SELECT profile_id, n_name AS country, coalesce(told, CASE n_name WHEN 'UNITED KINGDOM' THEN 'en' WHEN 'GERMANY' THEN 'de' WHEN 'FRANCE' THEN 'fr' WHEN 'RUSSIA' THEN 'ru' END) AS language FROM P JOIN nation ON la_id = n_nationkey LEFT JOIN best ON id = profile_id WHERE language IS NOT NULL")
def t34_profiles(docs, people, nation):
    own = F.when(F.col("profile_id") % 3 != 0, F.concat(F.lower("sector"), F.lit(" "), "company")).alias("text")
    rows = people.join(nation, F.col("la_id") == F.col("n_nationkey")).select("profile_id", F.col("n_name").alias("country"), own)
    return languages.assigned(rows, ["profile_id", "country"], "text", languages.profiles(docs), "country")


@plan("t35_query_strings", "J", "JS", sql="SELECT merged_title, string_agg(skill, ' or ' ORDER BY skill) AS query FROM (SELECT merged_title, skill, count(*) AS c, row_number() OVER (PARTITION BY merged_title ORDER BY count(*) DESC, skill) AS rn FROM JS JOIN J USING (job_id) WHERE merged_title IS NOT NULL GROUP BY merged_title, skill) WHERE rn <= 5 GROUP BY merged_title")
def t35(jobs, skills):
    counts = skills.join(jobs.filter("merged_title IS NOT NULL").select("job_id", "merged_title"), "job_id").groupBy("merged_title", "skill").agg(n().alias("c"))
    best = counts.withColumn("rn", F.row_number().over(W.partitionBy("merged_title").orderBy(F.desc("c"), "skill"))).filter("rn <= 5")
    return best.groupBy("merged_title").agg(F.array_join(F.array_sort(F.collect_list("skill")), " or ").alias("query"))


LOGS = """b AS (SELECT type AS file, date_trunc('day', crawled_on) AS day, min(crawled_on) AS start, max(crawled_on) AS stop, count(*) AS n, CAST(round(100.0 * count_if(valid) / count(*)) AS INTEGER) AS percent FROM W GROUP BY type, date_trunc('day', crawled_on))"""


def batch_log(log):
    """file, at, line: the text of a crawl log, three lines a batch; an unfinished batch has only its first."""
    b = log.groupBy(F.col("type").alias("file"), F.date_trunc("day", "crawled_on").alias("day")).agg(F.min("crawled_on").alias("start"), F.max("crawled_on").alias("stop"), n().alias("n"), F.round(F.lit(100.0) * F.count_if("valid") / n()).cast("int").alias("percent"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    done = F.dayofmonth("day") % 7 != 0
    lines = F.array(
        F.concat(F.lit("Starting batch at "), stamp("start")), F.when(done, F.concat(F.lit("Retrieved URLs at "), stamp("stop"))),
        F.when(done, F.format_string("Crawled %d URLs with %d%% success", "n", "percent")))
    return b.select("file", F.unix_micros(F.col("day").cast("timestamp")).alias("d"), F.posexplode(F.array_compact(lines)).alias("k", "line")).select("file", (F.col("d") + F.col("k")).alias("at"), "line")


@plan("t36_log_metrics", "W", sql=f"""WITH {LOGS} SELECT file, date_trunc('second', start) AS start, n, percent, date_diff('second', date_trunc('second', start), date_trunc('second', stop)) AS seconds,
 round(n / nullif(date_diff('second', date_trunc('second', start), date_trunc('second', stop)), 0)::DOUBLE, 9) AS rate FROM b WHERE day(day) % 7 <> 0""")
def t36(log):
    return h.log_batches(batch_log(log), "file", "at", "line").withColumn("rate", F.round("rate", 9))


@plan("t36_log_failures", "W", sql="SELECT 'endpoint-' || CAST(id % 7 AS VARCHAR) AS endpoint, count(*) AS n FROM W WHERE fail_count > 0 GROUP BY 1")
def t36_failures(log):
    """Refusals by endpoint: a line that names the endpoint, and right after it the status."""
    failed = F.col("fail_count") > 0
    lines = F.array(F.concat(F.when(failed, "Failed getting URL by ").otherwise("Got URL by "), F.lit("endpoint-"), (F.col("id") % 7).cast("string")), F.when(failed, F.lit("Received status code 999")))
    text = log.select(F.col("url").alias("file"), "id", F.posexplode(F.array_compact(lines)).alias("k", "line")).select("file", (F.col("id") * 2 + F.col("k")).alias("at"), "line")
    return h.log_failures(text, "file", "at", "line", 999)


@plan("n1_flexible_times", "events", sql="SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('day', ts) END AS t FROM events")
def n1(events):
    shape = lambda s: F.date_format("ts", s)
    text = F.when(F.col("event_id") % 4 == 0, shape("yyyy-MM-dd_HH:mm:ss")).when(F.col("event_id") % 4 == 1, shape("yyyy-MM-dd HH:mm")).when(F.col("event_id") % 4 == 2, shape("yyyy-MM-dd")).otherwise("soon")
    return events.select("event_id", t.first_time(text).alias("t"))


@plan("n2_month_or_year", "J", sql="SELECT job_id, CASE job_id % 3 WHEN 0 THEN date_trunc('month', created)::DATE WHEN 1 THEN date_trunc('year', created)::DATE END AS d FROM J")
def n2(jobs):
    text = F.when(F.col("job_id") % 3 == 0, F.date_format("created", "MMMM yyyy")).when(F.col("job_id") % 3 == 1, F.date_format("created", "yyyy")).otherwise("n/a")
    return jobs.select("job_id", t.month_or_year(text).alias("d"))


@plan("n10_points", "P", sql="SELECT profile_id, CASE WHEN profile_id % 4 = 0 THEN NULL ELSE score END AS lon, CASE WHEN profile_id % 4 = 0 THEN NULL ELSE la_id::DOUBLE END AS lat FROM P")
def n10(p):
    lon, lat = F.when(F.col("profile_id") % 4 != 0, F.col("score")), F.col("la_id").cast("double")
    return p.select("profile_id", F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat"))).alias("g")).select("profile_id", "g.lon", "g.lat")


@plan("n11_adjacent_parts", "nation", "region", sql="SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name || ', ' || r_name ELSE n_name || ', ' || r_name || ', ' || n_name END AS address FROM nation JOIN region ON n_regionkey = r_regionkey")
def n11(nation, region):
    both = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = F.array("n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.col("r_name")), "r_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).otherwise(F.col("n_name")))
    return both.withColumn("p", parts).select("n_nationkey", F.array_join(F.filter("p", lambda x, i: (i == 0) | (x != F.get("p", i - 1))), ", ").alias("address"))


SALARIES = """SELECT id, CASE shape WHEN 0 THEN lo * 1000 WHEN 1 THEN lo WHEN 2 THEN lo * 1000 WHEN 4 THEN lo * 1000 END::DOUBLE AS lo,
 CASE shape WHEN 0 THEN hi * 1000 WHEN 1 THEN lo WHEN 2 THEN hi * 1000 WHEN 4 THEN hi * 1000 END::DOUBLE AS hi, CASE shape WHEN 1 THEN 'hour' WHEN 3 THEN NULL WHEN 5 THEN NULL ELSE 'year' END AS period FROM SAL"""


@plan("y1_salary_extraction", "SAL", sql=SALARIES)
def y1(sal):
    return sal.select("id", m.salary(F.col("text")).alias("s")).select("id", F.col("s.min").alias("lo"), F.col("s.max").alias("hi"), "s.period")


CHOSEN = "source = 'A' AND created >= TIMESTAMP '1996-01-01' AND created < TIMESTAMP '1998-01-01'"


@plan("y5_salary_columns", "SAL", "J", sql=f"SELECT job_id, CASE WHEN {CHOSEN} THEN lo ELSE salary_min END::DOUBLE AS salary_min, CASE WHEN {CHOSEN} THEN hi ELSE salary_max END::DOUBLE AS salary_max, CASE WHEN {CHOSEN} THEN period ELSE salary_period END AS salary_period FROM J JOIN ({SALARIES}) ON id = job_id")
def y5(sal, jobs):
    """One source and range of days is written anew; all other rows keep their columns."""
    posts = jobs.join(sal.select(F.col("id").alias("job_id"), "text"), "job_id")
    out = m.overwrite_salaries(posts, "text", F.expr(CHOSEN))
    return out.select("job_id", F.col("salary_min").cast("double"), F.col("salary_max").cast("double"), "salary_period")


DOC_WORDS = "SELECT doc_id, w[i] AS word, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents))"


def doc_words(docs):
    return docs.select("doc_id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("pos", "word"))


def phrases(docs):
    rows = [("of the", "of"), ("of the", "the"), ("with by", "with"), ("with by", "by"), ("nicht", "nicht"), ("from was as", "from"), ("from was as", "was"), ("from was as", "as")]
    return F.broadcast(docs.sparkSession.createDataFrame(rows, "phrase string, word string"))


PHRASES = "(VALUES ('of the', 'of', 2), ('of the', 'the', 2), ('with by', 'with', 2), ('with by', 'by', 2), ('nicht', 'nicht', 1), ('from was as', 'from', 3), ('from was as', 'was', 3), ('from was as', 'as', 3)) AS p(phrase, word, n)"
HITS = f"WITH w AS ({DOC_WORDS}), h AS (SELECT doc_id, phrase, n, pos, w.word FROM w JOIN {PHRASES} ON w.word = p.word) SELECT DISTINCT doc_id, phrase FROM (SELECT a.doc_id, a.phrase, a.pos, any_value(a.n) AS n, count(DISTINCT b.word) AS k FROM h a JOIN h b ON a.doc_id = b.doc_id AND a.phrase = b.phrase AND b.pos >= a.pos AND b.pos < a.pos + 1.5 * a.n GROUP BY ALL) WHERE k >= 0.75 * n"


@plan("e1_phrase_matches", "documents", sql=HITS)
def e1(docs):
    return m.phrase_hits(doc_words(docs), phrases(docs))


@plan("e2_skills_per_post", "documents", sql=f"SELECT doc_id, count(*) AS n_phrases FROM ({HITS}) GROUP BY doc_id")
def e2(docs):
    return m.phrase_hits(doc_words(docs), phrases(docs)).groupBy("doc_id").agg(n().alias("n_phrases"))


#: Every fourth document is a profile's own text, those after it its experiences.
DECLARED = "(SELECT doc_id AS profile_id, unnest(['of the', 'with by', 'nicht']) AS phrase FROM documents WHERE doc_id % 4 = 0)"


@plan("e3_skill_reinforcement", "documents", sql=f"SELECT d.profile_id, d.phrase, count(x.doc_id) AS score, coalesce(bool_or(x.doc_id % 4 = 0), false) AS reenforced FROM {DECLARED} d LEFT JOIN ({HITS}) x ON x.doc_id - x.doc_id % 4 = d.profile_id AND x.phrase = d.phrase GROUP BY ALL")
def e3(docs):
    hits = m.phrase_hits(doc_words(docs), phrases(docs)).withColumn("profile_id", F.col("doc_id") - F.col("doc_id") % 4)
    declared = docs.filter("doc_id % 4 = 0").select(F.col("doc_id").alias("profile_id"), F.explode(F.lit(["of the", "with by", "nicht"])).alias("phrase"))
    return m.reinforcement(declared, hits.filter("doc_id % 4 = 0"), hits.filter("doc_id % 4 <> 0"))


@plan("e3_experience_skills", "documents", sql=f"SELECT x.doc_id AS exp_id, x.phrase FROM ({HITS}) x JOIN {DECLARED} d ON x.doc_id - x.doc_id % 4 = d.profile_id AND x.phrase = d.phrase WHERE x.doc_id % 4 <> 0")
def e3_links(docs):
    """Links of experiences to the declared skills that they name."""
    hits = m.phrase_hits(doc_words(docs), phrases(docs)).filter("doc_id % 4 <> 0").withColumn("profile_id", F.col("doc_id") - F.col("doc_id") % 4)
    declared = docs.filter("doc_id % 4 = 0").select(F.col("doc_id").alias("profile_id"), F.explode(F.lit(["of the", "with by", "nicht"])).alias("phrase"))
    return hits.join(declared, ["profile_id", "phrase"], "left_semi").select(F.col("doc_id").alias("exp_id"), "phrase")


@plan("e4_declared_and_found", "X", sql="SELECT profile_id, title, CAST(max(d) + sum(f) AS BIGINT) AS score FROM (SELECT profile_id, title, 1 AS d, 0 AS f FROM X WHERE value > 80 UNION ALL SELECT profile_id, title, 0, 1 FROM X WHERE value < 20) GROUP BY ALL")
def e4(x):
    declared = x.filter("value > 80").select("profile_id", "title").distinct().withColumn("score", F.lit(1))
    found = x.filter("value < 20").groupBy("profile_id", "title").agg(n().alias("f"))
    return declared.join(found, ["profile_id", "title"], "full_outer").select("profile_id", "title", (F.coalesce("score", F.lit(0)) + F.coalesce("f", F.lit(0))).alias("score"))


@plan("e5_tag_scores", "J", "JS", sql="SELECT company, skill, count(*) AS score FROM J JOIN JS USING (job_id) GROUP BY ALL")
def e5(jobs, skills):
    return jobs.select("job_id", "company").join(skills, "job_id").groupBy("company", "skill").agg(n().alias("score"))


@plan("e6_declared_weight", "JS", sql="SELECT job_id, skill, CASE WHEN pos = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM JS")
def e6(skills):
    return skills.select("job_id", "skill", F.when(F.col("pos") == 1, 1.0).otherwise(0.0).alias("score"))


@plan("u1_dedup_preparation", "pages", sql=r"SELECT url, max(text) AS text FROM (SELECT url, lower(trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))) AS text FROM pages) GROUP BY url")
def u1(pages):
    return pages.select("url", F.lower(t.squeeze(t.strip_tags(F.coalesce("html", F.lit(""))))).alias("text")).groupBy("url").agg(F.max("text").alias("text"))


SORTED = "array_to_string(list_sort(list_filter(string_split(lower({x}), ' '), lambda w: w <> '')), ' ')"
NODES = f"SELECT brand AS k, {SORTED.format(x='base')} AS t, {SORTED.format(x='title')} AS x, min(id) AS id FROM TT GROUP BY 1, 2, 3"
RATIO = "100.0::DOUBLE * (1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b}), 1))"


@plan("u2_near_duplicates", "TT", sql=f"WITH n AS ({NODES}) SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.k = b.k AND b.id > a.id WHERE greatest(length(a.x), length(b.x)) <= 2.0 * least(length(a.x), length(b.x)) AND {RATIO.format(a='a.t', b='b.t')} > 40 AND {RATIO.format(a='a.x', b='b.x')} > 75")
def u2(tt):
    return m.near_pairs(tt, "brand", "id", "base", "title")


@plan("u3_token_sort_ratio", "supplier", "nation", sql="SELECT s_suppkey, n_name, round(100.0::DOUBLE * (1 - levenshtein(lower(s_name), lower(n_name))::DOUBLE / greatest(length(s_name), length(n_name))), 6) AS ratio FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def u3(supplier, nation):
    both = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return both.select("s_suppkey", "n_name", F.round(m.ratio(F.lower("s_name"), F.lower("n_name")), 6).alias("ratio"))


@plan("u4_company_crosswalk", "supplier", "P", sql="WITH c AS (SELECT company, count(*) AS k FROM P GROUP BY company) SELECT s_suppkey, company, k AS people FROM supplier LEFT JOIN c ON company = 'Supplier ' || CAST(CAST(regexp_extract(s_name, '[0-9]+') AS BIGINT) AS VARCHAR) || ' Ltd'")
def u4(supplier, p):
    names = p.groupBy(F.col("company").alias("matched")).agg(n().alias("count"))
    own = supplier.select("s_suppkey", F.regexp_replace("s_name", "#0*([0-9]+)$", ". $1 (uk) Limited").alias("name"))
    return m.crosswalk(own, names, "s_suppkey", "name", list(STOP)).select("s_suppkey", F.col("matched").alias("company"), F.col("count").alias("people"))


@plan("u4_match_rate", "supplier", "P", sql="SELECT round(100.0 * count_if(CAST(regexp_extract(s_name, '[0-9]+') AS BIGINT) IN (SELECT c_custkey % 20 FROM customer)) / count(*), 6) AS percent FROM supplier")
def u4_rate(supplier, p):
    return u4(supplier, p).agg(F.round(F.lit(100.0) * F.count("company") / n(), 6).alias("percent"))


def rectangle(x0, y0, x1, y1):
    return F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def regions(nation):
    """Rectangles of a grid: a nation's column and row, and half of it as a deeper level."""
    x, y = (F.col("n_nationkey") % 5) * 2000.0 - 1000, F.floor(F.col("n_nationkey") / 5) * 300.0
    parts = lambda x1: areas.one_ring(rectangle(x, y, x1, y + 300)).alias("parts")
    code = F.concat(F.lit("R"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return nation.select(code.alias("code"), parts(x + 2000)).unionByName(nation.select(F.concat(code, F.lit("W")).alias("code"), parts(x + 1000)))


LOCATED = "SELECT c_custkey AS id, CASE WHEN c_acctbal >= -1000 AND c_acctbal < 9000 AND c_custkey % 1600 < 1500 THEN 'R' || lpad(CAST(CAST(floor((c_acctbal + 1000) / 2000) AS BIGINT) + 5 * ((c_custkey % 1600) // 300) AS VARCHAR), 2, '0') || CASE WHEN (c_acctbal + 1000) - floor((c_acctbal + 1000) / 2000) * 2000 < 1000 THEN 'W' ELSE '' END END AS code FROM customer"


def points(customer):
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 1600 + 0.0).cast("double").alias("y"))


@plan("g1_point_in_region", "customer", "nation", sql=LOCATED)
def g1(customer, nation):
    return areas.locate(points(customer), regions(nation), 500.0)


def holed_regions(nation):
    """Two polygons a region: a nation's rectangle with a hole, and an island in the hole of the next nation's."""
    x, y = (F.col("n_nationkey") % 5) * 2000.0 - 1000, F.floor(F.col("n_nationkey") / 5) * 300.0
    main = F.array(rectangle(x, y, x + 2000, y + 300), rectangle(x + 500, y + 100, x + 1500, y + 200))
    ahead = (F.col("n_nationkey") + 1) % 25
    u, v = (ahead % 5) * 2000.0 + 100, F.floor(ahead / 5) * 300.0 + 110
    code = F.concat(F.lit("H"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return nation.select(code.alias("code"), F.array(main, F.array(rectangle(u, v, u + 250, v + 40))).cast(areas.PARTS).alias("parts"))


@plan("g1_polygons_with_holes", "customer", "nation", sql="""
    WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, (c_custkey % 1600)::DOUBLE AS y FROM customer),
    b AS (SELECT n_nationkey AS k, n_nationkey % 5 * 2000.0 - 1000 AS x0, n_nationkey // 5 * 300.0 AS y0, (n_nationkey + 24) % 25 AS before FROM nation),
    h AS (SELECT id, CASE WHEN x >= x0 + 500 AND x < x0 + 1500 AND y >= y0 + 100 AND y < y0 + 200
              THEN CASE WHEN x >= x0 + 1100 AND x < x0 + 1350 AND y >= y0 + 110 AND y < y0 + 150 THEN before END ELSE k END AS k
          FROM p JOIN b ON x >= x0 AND x < x0 + 2000 AND y >= y0 AND y < y0 + 300)
    SELECT p.id, 'H' || lpad(CAST(k AS VARCHAR), 2, '0') AS code FROM p LEFT JOIN h USING (id)""")
def g1_holes(customer, nation):
    return areas.locate(points(customer), holed_regions(nation), 250.0)


@plan("g3_area_and_cover", "nation", sql="SELECT 'H' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, 510000.0::DOUBLE AS area, 150000.0::DOUBLE / 510000 AS main_left FROM nation")
def g3_cover(nation):
    """Areas without holes, and the share of each that its rectangle's first 500 columns cover."""
    x = F.get(F.get(F.get("parts", F.lit(0)), F.lit(0)), F.lit(0))
    view = (x["x"], x["y"], x["x"] + 500, x["y"] + 300)
    return holed_regions(nation).select("code", areas.area(F.col("parts")).alias("area"), areas.covered_share(F.col("parts"), *view).alias("main_left"))


@plan("g2_region_levels", "customer", "nation", sql=f"SELECT id, substr(code, 1, 2) AS level0, substr(code, 1, 3) AS level1, CASE WHEN length(code) > 3 THEN code END AS level2 FROM ({LOCATED})")
def g2(customer, nation):
    code = F.col("code")
    return g1(customer, nation).select("id", F.substring(code, 1, 2).alias("level0"), F.substring(code, 1, 3).alias("level1"), F.when(F.length(code) > 3, code).alias("level2"))


_SHARE = "greatest(0, least(x0 + {w}, x + dx) - greatest(x0, x - dx)) * greatest(0, least(y0 + 300, y + dy) - greatest(y0, y - dy)) > 0.9 * {w} * 300"


@plan("g3_viewport_rule", "customer", "nation", sql=f"WITH l AS ({LOCATED}), a AS (SELECT id, code, CAST(substr(code, 2, 2) AS INTEGER) AS k, c_acctbal::DOUBLE AS x, (c_custkey % 1600)::DOUBLE AS y, c_custkey % 5 * 600.0::DOUBLE AS dx, c_custkey % 4 * 110.0::DOUBLE AS dy FROM l JOIN customer ON id = c_custkey WHERE code IS NOT NULL), b AS (SELECT *, k % 5 * 2000.0 - 1000 AS x0, k // 5 * 300.0 AS y0 FROM a) SELECT id, substr(code, 1, 3) AS level0, CASE WHEN length(code) > 3 AND NOT ({_SHARE.format(w=2000)}) THEN code END AS level1 FROM b")
def g3(customer, nation):
    """A view around each point: the deepest region that the view doesn't cover, with those above it."""
    around = points(customer).select("id", *[(F.col(c) + sign * F.col("id") % k * by).alias(name) for c, sign, k, by, name in (("x", -1, 5, 600.0, "x0"), ("x", 1, 5, 600.0, "x1"), ("y", -1, 4, 110.0, "y0"), ("y", 1, 4, 110.0, "y1"))])
    found = g1(customer, nation).filter("code IS NOT NULL").join(around, "id")
    level = F.explode(F.array_distinct(F.array(F.substring("code", 1, 3), F.col("code")))).alias("level")
    each = found.select("id", "x0", "x1", "y0", "y1", level).join(regions(nation).withColumnRenamed("code", "level"), "level")
    seen = each.select("id", "level", (areas.covered_share(F.col("parts"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")) > 0.9).alias("covered"))
    least = F.min(F.when(F.col("covered"), F.length("level")))
    by_point = seen.groupBy("id").agg(least.alias("least"), *[F.max(F.when(c, F.col("level"))).alias(name) for c, name in ((F.length("level") == 3, "level0"), (F.length("level") > 3, "level1"))])
    return by_point.select("id", "level0", F.when(F.col("least").isNull() | (F.length("level1") <= F.col("least")), F.col("level1")).alias("level1"))


@plan("g4_region_listing", "area", sql="SELECT DISTINCT code FROM (SELECT nuts1 AS code FROM area UNION ALL SELECT nuts2 FROM area) WHERE length(code) = 3 AND code LIKE 'R1%'")
def g4(areas):
    codes = areas.select(F.explode(F.array("nuts1", "nuts2")).alias("code")).distinct()
    return codes.filter((F.length("code") == 3) & F.col("code").startswith("R1"))


@plan("g5_job_region_codes", "J", "area", sql="SELECT job_id, CASE WHEN job_id % 3 = 0 THEN 'R9' ELSE nuts1 END AS nuts1 FROM J JOIN area USING (la_id)")
def g5(jobs, areas):
    own = F.when(F.col("job_id") % 3 == 0, F.lit("R9"))
    return jobs.join(areas, "la_id", "left").select("job_id", F.coalesce(own, "nuts1").alias("nuts1"))


@plan("g6_lookup_candidates", "P", "X", "area", sql="SELECT DISTINCT la_name AS place FROM area WHERE length(la_name) > 5 AND la_id IN (SELECT la_id FROM P) UNION SELECT DISTINCT company FROM X WHERE length(company) > 5")
def g6(p, x, areas):
    names = areas.join(p.select("la_id"), "la_id", "left_semi").select(F.col("la_name").alias("place")).unionByName(x.select(F.col("company").alias("place"))).distinct()
    return names.filter(F.length("place") > 5)


@plan("g7_retry_set", "W", sql="SELECT url, CAST(sum(fail_count) AS BIGINT) AS tries FROM W GROUP BY url HAVING sum(fail_count) < 10 AND count_if(type = 'purchase') < 12")
def g7(log):
    return log.groupBy("url").agg(F.sum("fail_count").alias("tries"), F.count_if(F.col("type") == "purchase").alias("k")).filter("tries < 10 AND k < 12").drop("k")


@plan("g8_profile_regions", "P", "area", sql="SELECT profile_id, nuts0, nuts1, nuts2 FROM P LEFT JOIN area USING (la_id)")
def g8(p, areas):
    return p.join(areas, "la_id", "left").select("profile_id", "nuts0", "nuts1", "nuts2")


@plan("h4_edges_from_centres", "J", sql="WITH c AS (SELECT list(DISTINCT m ORDER BY m) AS c FROM (SELECT (salary_min // 10000) * 10000 + 5000 AS m FROM J WHERE salary_min < 50000)) SELECT array_to_string(list_transform(range(1, len(c) + 2), lambda i: CASE WHEN i = 1 THEN c[1] - (c[2] - c[1]) // 2 WHEN i = len(c) + 1 THEN c[len(c)] + (c[len(c)] - c[len(c) - 1]) // 2 ELSE (c[i - 1] + c[i]) // 2 END), ',') AS edges FROM c")
def h4(jobs):
    centres = jobs.filter("salary_min < 50000").select((F.expr("salary_min div 10000") * 10000 + 5000).alias("m")).distinct().agg(F.array_sort(F.collect_list("m")).alias("c"))
    k = F.size("c")
    inner = F.expr("transform(sequence(1, size(c) - 1), i -> (c[i - 1] + c[i]) div 2)")
    first = F.expr("c[0] - (c[1] - c[0]) div 2")
    last = F.element_at("c", -1) + F.expr("(element_at(c, -1) - element_at(c, -2)) div 2")
    return centres.filter(k > 1).select(F.array_join(F.transform(F.concat(F.array(first), inner, F.array(last)), lambda v: v.cast("string")), ",").alias("edges"))


@plan("m6_title_aliases", "P", sql="SELECT profile_id, CASE WHEN sector = 'BUILDING' AND company = 'Supplier 1 Ltd' THEN 'Builder One' WHEN sector = 'MACHINERY' AND company = 'Supplier 1 Ltd' THEN 'Machines One' ELSE company END AS alias FROM P")
def m6(p):
    aliases = p.sparkSession.createDataFrame([("BUILDING", "Supplier 1 Ltd", "Builder One"), ("MACHINERY", "Supplier 1 Ltd", "Machines One")], "sector string, company string, alias string")
    return p.join(F.broadcast(aliases), ["sector", "company"], "left").select("profile_id", F.coalesce("alias", "company").alias("alias"))


@plan("v4_clusters", "JS", "J")
def v4(skills, jobs):
    v = e.skill_vectors(skills.join(jobs.select("job_id", "category"), "job_id"), "category", "skill", 100)
    return m.clusters(v.select(F.col("category").alias("label"), F.col("skill").alias("item"), "w"), 3)


@plan("v6_cluster_names", "J", sql="SELECT salary_period AS cluster, arg_max(title, (c, title)) AS name, CAST(sum(c) AS BIGINT) AS n FROM (SELECT salary_period, coalesce(merged_title, '-') AS title, count(*) AS c FROM J GROUP BY ALL) GROUP BY 1")
def v6(jobs):
    counts = jobs.groupBy("salary_period", F.coalesce("merged_title", F.lit("-")).alias("title")).agg(n().alias("c"))
    return counts.groupBy(F.col("salary_period").alias("cluster")).agg(F.max_by("title", F.struct("c", "title")).alias("name"), F.sum("c").alias("n"))


@plan("y2_salary_periods", "SAL", sql="SELECT id, CASE id % 5 WHEN 0 THEN 'hour' WHEN 1 THEN 'day' WHEN 2 THEN 'week' WHEN 3 THEN 'month' ELSE 'year' END AS period, lo::DOUBLE AS lo FROM SAL")
def y2(sal):
    forms = (" per hour", "pd", " per week", " a month", " p/a")
    tail = F.get(F.lit(list(forms)), (F.col("id") % 5).cast("int"))
    return sal.select("id", m.salary(F.concat(F.lit("Pay £"), F.col("lo").cast("string"), tail)).alias("s")).select("id", "s.period", F.col("s.min").alias("lo"))


@plan("y3_salary_exclusions", "SAL", sql="SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE (lo * 1000)::DOUBLE END AS lo FROM SAL")
def y3(sal):
    amount = F.concat(F.lit("£"), F.col("lo").cast("string"), F.lit(",000"))
    text = F.when(F.col("id") % 3 == 0, F.concat(F.lit("a bonus of up "), amount)).when(F.col("id") % 3 == 1, F.concat(amount, F.lit(" and a fund of £3 million"))).otherwise(F.concat(F.lit("overtime £9, basic "), amount))
    return sal.select("id", m.salary(text)["min"].alias("lo"))


@plan("y4_salary_validation", "SAL", sql="SELECT id, CASE WHEN id % 2 = 0 THEN NULL ELSE (lo * 1000)::DOUBLE END AS lo, CASE WHEN id % 2 = 0 THEN NULL ELSE (hi * 1000)::DOUBLE END AS hi FROM SAL")
def y4(sal):
    """A range of more than threefold is none; a thousand that is missing on one side is put back."""
    lo, hi = F.col("lo").cast("string"), F.col("hi").cast("string")
    text = F.when(F.col("id") % 2 == 0, F.concat(F.lit("£"), lo, F.lit(",000 - £990,000 pa"))).otherwise(F.concat(F.lit("£"), lo, F.lit("-£"), hi, F.lit(",000 pa")))
    return sal.select("id", m.salary(text).alias("s")).select("id", F.col("s.min").alias("lo"), F.col("s.max").alias("hi"))


@plan("j5_grouped_max", "W", sql="SELECT w.id, w.url FROM W w JOIN (SELECT url, max(crawl_number) AS last FROM W GROUP BY url) l ON w.url = l.url AND w.crawl_number = l.last")
def j5(log):
    from skillweave.operators.history import latest

    return latest(log, "url", "crawl_number").select("id", "url")


@plan("j9_theta_self_join", "supplier", sql="WITH n AS (SELECT s_nationkey AS k, lower(s_name) AS x, min(s_suppkey) AS id FROM supplier GROUP BY ALL) SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.k = b.k AND b.id > a.id WHERE greatest(length(a.x), length(b.x)) <= 2.0 * least(length(a.x), length(b.x)) AND 100.0::DOUBLE * (1 - levenshtein(a.x, b.x)::DOUBLE / greatest(length(a.x), length(b.x))) > 75")
def j9(supplier):
    names = supplier.select("s_suppkey", "s_nationkey", F.regexp_replace("s_name", " ", "_").alias("s"))
    return m.near_pairs(names, "s_nationkey", "s_suppkey", "s", "s")


@plan("j10_points_per_region", "customer", "nation", sql=f"SELECT code, count(*) AS n FROM ({LOCATED}) WHERE code IS NOT NULL GROUP BY code")
def j10(customer, nation):
    return g1(customer, nation).filter("code IS NOT NULL").groupBy("code").agg(n().alias("n"))


@plan("j12_name_match", "supplier", "P", sql="WITH c AS (SELECT DISTINCT company, split_part(company, ' ', 1) AS k FROM P), s AS (SELECT s_suppkey, s_name, regexp_extract(s_name, '^[A-Za-z]+') AS k FROM supplier) SELECT s_suppkey, arg_min(company, (levenshtein(s_name, company), company)) AS company FROM s JOIN c USING (k) GROUP BY s_suppkey")
def j12(supplier, p):
    names = p.select("company").distinct().withColumn("k", F.substring_index("company", " ", 1))
    own = supplier.select("s_suppkey", "s_name", F.regexp_extract("s_name", "^[A-Za-z]+", 0).alias("k"))
    return own.join(names, "k").groupBy("s_suppkey").agg(F.min_by("company", F.struct(F.levenshtein("s_name", "company"), "company")).alias("company"))


QUERIES, ORACLES = plan.queries, plan.oracles
