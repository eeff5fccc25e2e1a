"""Entity catalogues, mappings, relevance, weights, vectors, histograms."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.functions import text as t
from skillweave.operators import relevance as e
from skillweave.operators import reports as r
from skillweave.plans.register import Plans

plan = Plans()
n = lambda: F.count(F.lit(1))
BEST = "SELECT {k}, {v}, total FROM (SELECT {k}, {v}, c, sum(c) OVER (PARTITION BY {k})::BIGINT AS total, row_number() OVER (PARTITION BY {k} ORDER BY c DESC, {v}) AS rn FROM (SELECT {k}, {v}, count(*) AS c FROM {t} GROUP BY ALL)) WHERE rn = 1"


@plan("c1_best_names", "JS", sql=BEST.format(k="k", v="skill", t="(SELECT split_part(skill, ' ', 1) AS k, skill FROM JS)"))
def c1(skills):
    return e.best_names(skills.withColumn("k", F.substring_index("skill", " ", 1)), "k", "skill")


@plan("c2_two_origins", "X", "P", sql="""WITH a AS (SELECT lower(company) AS k, company, count(*) AS c FROM X GROUP BY ALL), b AS (SELECT lower(company) AS k, company, count(*) AS c FROM P GROUP BY ALL)
SELECT k, coalesce(arg_max(a.company, a.c), arg_max(b.company, b.c)) AS label, CAST(coalesce(sum(b.c), 0) AS BIGINT) AS profiles, CAST(coalesce(sum(a.c), 0) AS BIGINT) AS experiences FROM a FULL JOIN b USING (k) GROUP BY k""")
def c2(x, p):
    rows = x.select("company", F.lit(2).alias("origin")).unionByName(p.select("company", F.lit(1).alias("origin"))).withColumn("k", F.lower("company"))
    counts = rows.groupBy("k", "company").agg(F.count_if(F.col("origin") == 1).alias("p"), F.count_if(F.col("origin") == 2).alias("x"))
    best = lambda c: F.max_by("company", F.when(F.col(c) > 0, F.struct(F.col(c), "company")))
    return counts.groupBy("k").agg(F.coalesce(best("x"), best("p")).alias("label"), F.sum("p").alias("profiles"), F.sum("x").alias("experiences"))


@plan("c3_skills_catalogue", "JS", "J", sql="SELECT skill, count(*) AS n_rows, count(DISTINCT job_id) AS n_jobs, count(DISTINCT merged_title) AS n_titles FROM JS JOIN J USING (job_id) GROUP BY skill")
def c3(skills, jobs):
    return skills.join(jobs.select("job_id", "merged_title"), "job_id").groupBy("skill").agg(n().alias("n_rows"), F.count_distinct("job_id").alias("n_jobs"), F.count_distinct("merged_title").alias("n_titles"))


@plan("c4_titles_catalogue", "X", "P", sql="SELECT title, CAST(sum(p) AS BIGINT) AS profiles, CAST(sum(x) AS BIGINT) AS experiences FROM (SELECT title, 0 AS p, count(*) AS x FROM X GROUP BY title UNION ALL SELECT lower(sector), count(*), 0 FROM P GROUP BY lower(sector)) GROUP BY title")
def c4(x, p):
    rows = x.select("title", F.lit(0).alias("p"), F.lit(1).alias("x")).unionByName(p.select(F.lower("sector").alias("title"), F.lit(1).alias("p"), F.lit(0).alias("x")))
    return rows.groupBy("title").agg(F.sum("p").alias("profiles"), F.sum("x").alias("experiences"))


@plan("c5_companies_catalogue", "X", sql=BEST.format(k="k", v="company", t="(SELECT lower(replace(company, ' ', '')) AS k, company FROM X)"))
def c5(x):
    return e.best_names(x.withColumn("k", F.lower(F.replace("company", F.lit(" "), F.lit("")))), "k", "company")


@plan("c6_sectors_catalogue", "P", "X", sql="SELECT sector, count(*) AS profiles, CAST(coalesce(sum(c), 0) AS BIGINT) AS experiences FROM P LEFT JOIN (SELECT profile_id, count(*) AS c FROM X GROUP BY profile_id) USING (profile_id) GROUP BY sector")
def c6(p, x):
    counts = x.groupBy("profile_id").agg(n().alias("c"))
    return p.join(counts, "profile_id", "left").groupBy("sector").agg(n().alias("profiles"), F.coalesce(F.sum("c"), F.lit(0)).alias("experiences"))


#: The institute, degree and subject of each study, told from a profile's and a post's fields.
STUDIES = "(SELECT 'institute' AS type, company AS name, profile_id FROM P UNION ALL SELECT 'degree', sector, profile_id FROM P UNION ALL SELECT 'subject', split_part(title, ' ', 1), profile_id FROM X)"


@plan("c7_institutes_catalogue", "P", "X", sql=f"WITH s AS (SELECT type, name, count(*) AS c FROM {STUDIES} GROUP BY type, name) SELECT type || ':A:en:' || lower(name) AS key, min(name) AS name, CAST(sum(c) AS BIGINT) AS total FROM s GROUP BY type, lower(name)")
def c7(p, x):
    """Three catalogues, each by its own keys."""
    parts = {"institute": p.select(F.col("company").alias("name")), "degree": p.select(F.col("sector").alias("name")), "subject": x.select(F.substring_index("title", " ", 1).alias("name"))}
    named = [e.best_names(df.withColumn("key", t.key(kind, "A", "en", F.lower("name"))), "key", "name") for kind, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@plan("c8_all_catalogues", "X", "P", "J", sql="SELECT 'company' AS type, 'A' AS source, company AS name, count(*) AS n FROM X GROUP BY company UNION ALL SELECT 'title', 'A', title, count(*) FROM X GROUP BY title UNION ALL SELECT 'sector', 'A', sector, count(*) FROM P GROUP BY sector UNION ALL SELECT 'company', 'B', company, count(*) FROM J GROUP BY company UNION ALL SELECT 'sector', 'B', category, count(*) FROM J GROUP BY category")
def c8(x, p, jobs):
    """All entity types of all sources that have them, as one table."""
    sources = {"A": {"company": (x, "company"), "title": (x, "title"), "sector": (p, "sector")}, "B": {"company": (jobs, "company"), "sector": (jobs, "category")}}
    return e.all_catalogues(sources)


WORDS = "SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS word, p_name FROM part"


@plan("c9_word_index", "part", sql=WORDS)
def c9(part):
    return e.word_index(part, "p_name")


@plan("c10_entity_search", "part", sql="SELECT p_name, count(*) AS n FROM part WHERE list_contains(regexp_extract_all(lower(p_name), '[a-z0-9]+'), 'red') GROUP BY p_name HAVING count(*) >= 2")
def c10(part):
    counts = part.groupBy("p_name").agg(n().alias("n")).filter("n >= 2")
    return e.search(e.word_index(part, "p_name"), "p_name", ["red"]).join(counts, "p_name")


@plan("j4_all_words", "part", sql=f"SELECT p_name FROM ({WORDS}) WHERE word IN (SELECT word FROM ({WORDS}) GROUP BY word ORDER BY count(*) DESC, word LIMIT 2) GROUP BY p_name HAVING count(*) = 2")
def j4(part):
    index = e.word_index(part, "p_name")
    top = index.groupBy("word").agg(n().alias("c")).orderBy(F.desc("c"), "word").limit(2).select("word")
    return index.join(F.broadcast(top), "word").groupBy("p_name").agg(n().alias("k")).filter("k = 2").select("p_name")


@plan("c11_locations_catalogue", "P", "area", "X", sql="SELECT la_name, count(DISTINCT profile_id) AS profiles, count(exp_id) AS experiences FROM P JOIN area USING (la_id) LEFT JOIN X USING (profile_id) GROUP BY la_name")
def c11(p, areas, x):
    counts = x.groupBy("profile_id").agg(n().alias("c"))
    per = p.join(areas, "la_id").join(counts, "profile_id", "left")
    return per.groupBy("la_name").agg(n().alias("profiles"), F.coalesce(F.sum("c"), F.lit(0)).alias("experiences"))


MAPPING = "(VALUES (NULL, 'Supplier 1 Ltd', 'Supplier 0 Ltd'), (NULL, 'Supplier 2 Ltd', 'Supplier 0 Ltd'), ('BUILDING', 'Supplier 2 Ltd', 'Supplier 5 Ltd'), (NULL, 'Supplier 3 Ltd', 'Supplier 4 Ltd'), (NULL, 'HOUSEHOLD', 'BUILDING')) AS m(sector, name, target)"


def mapping(p):
    rows = [(None, "Supplier 1 Ltd", "Supplier 0 Ltd"), (None, "Supplier 2 Ltd", "Supplier 0 Ltd"), ("BUILDING", "Supplier 2 Ltd", "Supplier 5 Ltd"), (None, "Supplier 3 Ltd", "Supplier 4 Ltd"), (None, "HOUSEHOLD", "BUILDING")]
    return p.sparkSession.createDataFrame(rows, "sector string, name string, target string")


@plan("m1_mapping_errors", "P", sql="SELECT 'duplicate' AS rule, 'Supplier 7 Ltd' AS name UNION ALL SELECT 'chain', 'Supplier 8 Ltd'")
def m1(p):
    names = p.select(F.lit(None).cast("string").alias("sector"), F.col("company").alias("name"), F.col("company").alias("target")).distinct().filter("name NOT IN ('Supplier 8 Ltd', 'Supplier 1 Ltd')")
    bad = p.sparkSession.createDataFrame([(None, "Supplier 7 Ltd", "Supplier 7 Ltd"), (None, "Supplier 8 Ltd", "Supplier 1 Ltd"), (None, "Supplier 1 Ltd", "Supplier 0 Ltd")], "sector string, name string, target string")
    return e.mapping_errors(names.unionByName(bad))


MAPPED = f"SELECT P.profile_id, P.sector, P.company, coalesce(o.target, g.target, P.company) AS mapped FROM P LEFT JOIN {MAPPING.replace('m(', 'o(')} ON CASE P.sector WHEN 'HOUSEHOLD' THEN 'BUILDING' ELSE P.sector END = o.sector AND P.company = o.name LEFT JOIN {MAPPING.replace('m(', 'g(')} ON g.sector IS NULL AND P.company = g.name"


@plan("m2_map_entities", "P", sql=MAPPED)
def m2(p):
    return e.map_entities(p, "company", "sector", mapping(p)).select("profile_id", "sector", "company", "mapped")


@plan("m3_inverse_map", "P", sql=f"SELECT DISTINCT company FROM ({MAPPED}) WHERE mapped = 'Supplier 0 Ltd'")
def m3(p):
    return e.map_entities(p, "company", "sector", mapping(p)).filter("mapped = 'Supplier 0 Ltd'").select("company").distinct()


@plan("m4_mapped_targets", "P", sql=f"SELECT DISTINCT mapped FROM ({MAPPED}) ORDER BY 1")
def m4(p):
    return e.map_entities(p, "company", "sector", mapping(p)).select("mapped").distinct().orderBy("mapped")


@plan("m5_display_names", "P", sql=f"WITH m AS ({MAPPED}), c AS (SELECT mapped, count(*) AS n FROM m GROUP BY mapped) SELECT mapped, upper(mapped) AS display, n FROM c")
def m5(p):
    counts = e.map_entities(p, "company", "sector", mapping(p)).groupBy("mapped").agg(n().alias("n"))
    names = p.select(F.col("company").alias("mapped"), F.upper("company").alias("display")).distinct()
    shown = F.when(F.col("display").isNull(), F.raise_error(F.lit("entity without a name"))).otherwise(F.col("display"))
    return counts.join(names, "mapped", "left").select("mapped", shown.alias("display"), "n")


CO = "SELECT category, skill, c1, e, n1, n FROM (SELECT *, sum(c1) OVER (PARTITION BY skill)::BIGINT AS e, sum(c1) OVER (PARTITION BY category)::BIGINT AS n1, sum(c1) OVER ()::BIGINT AS n FROM (SELECT category, skill, count(*) AS c1 FROM JS JOIN J USING (job_id) GROUP BY ALL))"
SCORED = f"SELECT *, c1::DOUBLE / n1::DOUBLE - (e - c1)::DOUBLE / (n - n1)::DOUBLE AS score, sqrt((c1::DOUBLE / n1) * (1 - c1::DOUBLE / n1) / n1 + ((e - c1)::DOUBLE / (n - n1)) * (1 - (e - c1)::DOUBLE / (n - n1)) / (n - n1)) AS error FROM ({CO})"
CLOUD = f"SELECT *, row_number() OVER (PARTITION BY category ORDER BY round(score, 9) DESC, skill) AS rank FROM ({SCORED}) WHERE score >= {{sigma}} * error QUALIFY rank <= {{limit}}"


def skill_rows(skills, jobs):
    return skills.join(jobs.select("job_id", "category"), "job_id")


@plan("q1_relevance_score", "JS", "J", sql=f"SELECT category, skill, round(score, 9) AS score, round(error, 9) AS error FROM ({SCORED})")
def q1(skills, jobs):
    score, error = e.relevance(F.col("c1"), F.col("e"), F.col("n1"), F.col("n"))
    return e.cooccurrence(skill_rows(skills, jobs), "category", "skill").select("category", "skill", F.round(score, 9).alias("score"), F.round(error, 9).alias("error"))


@plan("q2_cooccurring_entities", "JS", "J", sql=f"SELECT * FROM ({CO}) WHERE e >= 100")
def q2(skills, jobs):
    return e.cooccurrence(skill_rows(skills, jobs), "category", "skill").filter("e >= 100").select("category", "skill", "c1", "e", "n1", "n")


@plan("q3_entity_cloud", "JS", "J", sql=f"SELECT category, skill, round(score, 9) AS score, rank FROM ({CLOUD.format(sigma=1.0, limit=10)})")
def q3(skills, jobs):
    return e.cloud(skill_rows(skills, jobs), "category", "skill", 1.0, 10).select("category", "skill", F.round("score", 9).alias("score"), "rank")


@plan("q4_skill_cloud_of_titles", "JS", "J", sql=f"SELECT skill, rank FROM ({CLOUD.format(sigma=0.5, limit=25).replace('SELECT category, skill, count(*) AS c1', 'SELECT coalesce(merged_title, chr(45)) AS category, skill, count(*) AS c1')}) WHERE category = 'BUILDING'")
def q4(skills, jobs):
    rows = skills.join(jobs.select("job_id", F.coalesce("merged_title", F.lit("-")).alias("category")), "job_id")
    return e.cloud(rows, "category", "skill", 0.5, 25).filter("category = 'BUILDING'").select("skill", "rank")


@plan("q5_company_cloud", "J", sql=f"SELECT category, skill AS company, rank FROM ({CLOUD.format(sigma=1.5, limit=10).replace('SELECT category, skill, count(*) AS c1 FROM JS JOIN J USING (job_id)', 'SELECT category, company AS skill, count(*) AS c1 FROM J')})")
def q5(jobs):
    return e.cloud(jobs.select("category", "company"), "category", "company", 1.5, 10).select("category", "company", "rank")


@plan("q6_title_cloud", "J", sql="WITH p AS (SELECT category, merged_title, count(*) AS c1 FROM J WHERE merged_title IS NOT NULL GROUP BY ALL), t AS (SELECT *, sum(c1) OVER (PARTITION BY merged_title) AS e FROM p) SELECT category, merged_title, c1, CAST(e AS BIGINT) AS e, (e - c1)::DOUBLE / e::DOUBLE > 0.5 AS sector_filter FROM t")
def q6(jobs):
    co = e.cooccurrence(jobs.filter("merged_title IS NOT NULL"), "category", "merged_title")
    return co.select("category", "merged_title", "c1", "e", ((F.col("e") - F.col("c1")).cast("double") / F.col("e").cast("double") > 0.5).alias("sector_filter"))


@plan("q7_merged_clouds", "JS", "J", sql=f"WITH c AS ({CO}), m AS (SELECT skill, sum(c1) AS c1, sum(n1) AS n1, any_value(e) AS e, any_value(n) AS n FROM c WHERE category IN ('1-URGENT', '2-HIGH') GROUP BY skill) SELECT skill, CAST(c1 AS BIGINT) AS c1, CAST(n1 AS BIGINT) AS n1, round(c1::DOUBLE / n1::DOUBLE - (e - c1)::DOUBLE / (n - n1)::DOUBLE, 9) AS score FROM m")
def q7(skills, jobs):
    co = e.cooccurrence(skill_rows(skills, jobs), "category", "skill")
    merged = e.merge_clouds(co.filter("category = '1-URGENT'"), co.filter("category = '2-HIGH'"), "skill")
    return merged.select("skill", "c1", "n1", F.round(e.relevance(F.col("c1"), F.col("e"), F.col("n1"), F.col("n"))[0], 9).alias("score"))


@plan("q8_top_mapped", "P", sql=f"SELECT sector, mapped, n FROM (SELECT sector, mapped, count(*) AS n FROM ({MAPPED}) GROUP BY sector, mapped) QUALIFY row_number() OVER (PARTITION BY sector ORDER BY n DESC, mapped) <= 3")
def q8(p):
    counts = e.map_entities(p, "company", "sector", mapping(p)).groupBy("sector", "mapped").agg(n().alias("n"))
    return counts.withColumn("rn", F.row_number().over(W.partitionBy("sector").orderBy(F.desc("n"), "mapped"))).filter("rn <= 3").drop("rn")


STEPS = "WITH c AS (SELECT profile_id, title, start_ts, exp_id, lag(title) OVER (PARTITION BY profile_id ORDER BY start_ts, exp_id) AS b FROM X), s AS (SELECT * FROM c WHERE b IS NULL OR b <> title), t AS (SELECT title, lag(title) OVER w AS prev, lead(title) OVER w AS next FROM s WINDOW w AS (PARTITION BY profile_id ORDER BY start_ts, exp_id))"


def steps(x):
    w = W.partitionBy("profile_id").orderBy("start_ts", "exp_id")
    once = x.withColumn("b", F.lag("title").over(w)).filter("b IS NULL OR b <> title")
    return once.select("title", F.lag("title").over(w).alias("prev"), F.lead("title").over(w).alias("next"))


@plan("q9_career_steps", "X", sql=f"{STEPS} SELECT 'previous' AS kind, prev AS other, count(*) AS n FROM t WHERE title = 'click' AND prev IS NOT NULL GROUP BY prev UNION ALL SELECT 'next', next, count(*) FROM t WHERE title = 'click' AND next IS NOT NULL GROUP BY next")
def q9(x):
    t = steps(x).filter("title = 'click'")
    pairs = t.select(F.inline(F.array(F.struct(F.lit("previous").alias("kind"), F.col("prev").alias("other")), F.struct(F.lit("next").alias("kind"), F.col("next").alias("other")))))
    return pairs.filter("other IS NOT NULL").groupBy("kind", "other").agg(n().alias("n"))


@plan("q10_similar_titles", "part", sql="SELECT DISTINCT p_name FROM part WHERE list_contains(regexp_extract_all(lower(p_name), '[a-z0-9]+'), 'red') AND p_name <> 'red small tin'")
def q10(part):
    found = e.search(e.word_index(part, "p_name"), "p_name", ["red"])
    return found.join(part.filter("p_name = 'red small tin'").select("p_name").distinct(), "p_name", "left_anti")


@plan("q11_sector_definition", "J", "JS", sql=f"""WITH jobs AS (SELECT category, count(*) AS n_jobs, count(salary_min) AS n_paid FROM J GROUP BY category),
k AS (SELECT category, string_agg(skill, ';' ORDER BY rank) AS skills FROM ({CLOUD.format(sigma=1.0, limit=5)}) GROUP BY category),
c AS (SELECT category, merged_title, count(*) AS c, round(avg(salary_min), 4) AS pay, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, merged_title) AS rn FROM J WHERE merged_title IS NOT NULL GROUP BY category, merged_title)
SELECT category, n_jobs, n_paid, skills, merged_title AS career, c AS n_career, pay, rn AS rank FROM jobs LEFT JOIN k USING (category) LEFT JOIN c USING (category) WHERE rn <= 3""")
def q11(jobs, skills):
    """Each sector's totals, its skill cloud and its largest careers, as a nested definition; then one row a career."""
    totals = jobs.groupBy("category").agg(n().alias("n_jobs"), F.count("salary_min").alias("n_paid"))
    best = e.cloud(skill_rows(skills, jobs), "category", "skill", 1.0, 5).groupBy("category").agg(F.array_sort(F.collect_list(F.struct("rank", "skill"))).alias("cloud"))
    careers = jobs.filter("merged_title IS NOT NULL").groupBy("category", "merged_title").agg(n().alias("c"), F.round(F.avg("salary_min"), 4).alias("pay"))
    careers = careers.withColumn("rank", F.row_number().over(W.partitionBy("category").orderBy(F.desc("c"), "merged_title")).cast("long")).filter("rank <= 3")
    careers = careers.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("merged_title").alias("career"), F.col("c").alias("n_career"), "pay"))).alias("careers"))
    definition = totals.join(best, "category", "left").join(careers, "category", "left")
    return definition.select("category", "n_jobs", "n_paid", F.array_join(F.transform("cloud", lambda x: x["skill"]), ";").alias("skills"), F.inline("careers"))


@plan("q12_stored_cloud_lookup", "JS", "J", sql=f"SELECT category, rank FROM ({CLOUD.format(sigma=0.0, limit=1000000)}) WHERE skill = (SELECT min(skill) FROM JS)")
def q12(skills, jobs):
    wanted = skills.agg(F.min("skill").alias("skill"))
    return e.cloud(skill_rows(skills, jobs), "category", "skill", 0.0, 1_000_000).join(F.broadcast(wanted), "skill").select("category", "rank")


@plan("q13_all_category_clouds", "JS", "J", sql=f"SELECT category, count(*) AS n_skills FROM ({SCORED}) WHERE n1 >= 1000 AND e >= 100 AND score > 0 GROUP BY category")
def q13(skills, jobs):
    co = e.cooccurrence(skill_rows(skills, jobs), "category", "skill").filter("n1 >= 1000 AND e >= 100")
    return co.filter(e.relevance(F.col("c1"), F.col("e"), F.col("n1"), F.col("n"))[0] > 0).groupBy("category").agg(n().alias("n_skills"))


@plan("q14_all_transitions", "X", sql=f"{STEPS} SELECT prev, title, next, count(*) AS n FROM t GROUP BY ALL")
def q14(x):
    return steps(x).groupBy("prev", "title", "next").agg(n().alias("n"))


IDF = "SELECT skill, log10((SELECT count(*) FROM J)::DOUBLE / count(*)::DOUBLE) AS idf FROM JS GROUP BY skill"


@plan("i1_idf", "JS", "J", sql=f"SELECT skill, round(idf, 9) AS idf FROM ({IDF})")
def i1(skills, jobs):
    return e.idf(skills, jobs.agg(n())).select("skill", F.round("idf", 9).alias("idf"))


@plan("i2_tfidf_words", "documents", sql="WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents), c AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL), f AS (SELECT word, sum(tf) AS f FROM c GROUP BY word) SELECT doc_id, word, round(tf::DOUBLE * ((SELECT count(*) FROM documents)::DOUBLE / f::DOUBLE), 9) AS tfidf FROM c JOIN f USING (word)")
def i2(docs):
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    tf = words.groupBy("doc_id", "word").agg(n().alias("tf"))
    f = tf.groupBy("word").agg(F.sum("tf").alias("f")).crossJoin(F.broadcast(docs.agg(n().alias("total"))))
    return tf.join(f, "word").select("doc_id", "word", F.round(F.col("tf").cast("double") * (F.col("total").cast("double") / F.col("f").cast("double")), 9).alias("tfidf"))


@plan("i3_attach_idf", "JS", "J", sql=f"SELECT skill, count(*) AS c, round(count(*)::DOUBLE * coalesce(any_value(idf), 0), 6) AS weight FROM JS LEFT JOIN ({IDF}) USING (skill) GROUP BY skill ORDER BY weight DESC, skill LIMIT 20")
def i3(skills, jobs):
    counts = skills.groupBy("skill").agg(n().alias("c")).join(e.idf(skills, jobs.agg(n())), "skill", "left")
    return counts.select("skill", "c", F.round(F.col("c").cast("double") * F.coalesce("idf", F.lit(0.0)), 6).alias("weight")).orderBy(F.desc("weight"), "skill").limit(20)


VECTORS = "SELECT category, skill, c::DOUBLE / sqrt(sum((c * c)::DOUBLE) OVER (PARTITION BY category)) AS w FROM (SELECT category, skill, count(*) AS c FROM JS JOIN J USING (job_id) WHERE skill IN (SELECT skill FROM JS GROUP BY skill HAVING count(*) >= 100) GROUP BY ALL)"


@plan("v1_skill_vectors", "JS", "J", sql=f"SELECT category, skill, round(w, 9) AS w FROM ({VECTORS})")
def v1(skills, jobs):
    return e.skill_vectors(skill_rows(skills, jobs), "category", "skill", 100).select("category", "skill", F.round("w", 9).alias("w"))


@plan("v2_trimmed_vectors", "JS", "J", sql=f"SELECT category, count(*) AS n FROM ({VECTORS}) WHERE w >= 0.12 GROUP BY category")
def v2(skills, jobs):
    return e.skill_vectors(skill_rows(skills, jobs), "category", "skill", 100).filter("w >= 0.12").groupBy("category").agg(n().alias("n"))


@plan("v3_angular_distance", "JS", "J", sql=f"WITH v AS ({VECTORS}) SELECT a.category AS a, b.category AS b, round(acos(greatest(-1, least(1, sum(a.w * b.w)))), 5) AS distance FROM v a JOIN v b USING (skill) WHERE a.category < b.category GROUP BY ALL")
def v3(skills, jobs):
    v = e.skill_vectors(skill_rows(skills, jobs), "category", "skill", 100)
    d = e.angular_distance(v.withColumnRenamed("category", "a"), v.withColumnRenamed("category", "b"), "a", "b", "skill")
    return d.filter("a < b").select("a", "b", F.round("distance", 5).alias("distance"))


@plan("v5_nearest_cluster", "JS", "J", sql=f"WITH v AS ({VECTORS}), s AS (SELECT job_id, skill, count(*)::DOUBLE AS x FROM JS GROUP BY ALL), m AS (SELECT job_id, sqrt(sum(x * x)) AS nx FROM s GROUP BY job_id), d AS (SELECT job_id, category, sum(x * w) AS dot, count(*) AS shared FROM s JOIN v USING (skill) GROUP BY ALL), b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY round(dot, 9) DESC, category) = 1) SELECT job_id, coalesce(category, (SELECT min(category) FROM v)) AS cluster, round(acos(least(1, coalesce(dot, 0) / nx)), 5) AS distance, coalesce(shared, 0) AS n_shared FROM m LEFT JOIN b USING (job_id)")
def v5(skills, jobs):
    v = e.skill_vectors(skill_rows(skills, jobs), "category", "skill", 100)
    own = skills.groupBy("job_id", "skill").agg(n().cast("double").alias("w"))
    return e.nearest_cluster(own, v, "job_id", "category", "skill").select("job_id", F.col("category").alias("cluster"), F.round("distance", 5).alias("distance"), "n_shared")


@plan("v7_rekey_vectors", "JS", sql="SELECT DISTINCT 'skill:other:en:' || skill AS key FROM JS")
def v7(skills):
    keyed = skills.select(F.concat(F.lit("skill:first:en:"), "skill").alias("key")).distinct()
    return keyed.select(F.regexp_replace("key", ":first:", ":other:").alias("key"))


EDGES = [0.0, 10000.0, 20000.0, 30000.0, 50000.0]
BIN = "CASE WHEN {v} < 0 OR {v} > 50000 OR {v} IS NULL THEN NULL WHEN {v} <= 10000 THEN 0 WHEN {v} <= 20000 THEN 1 WHEN {v} <= 30000 THEN 2 ELSE 3 END"
HIST = f"SELECT b AS bin, CAST(coalesce(n, 0) AS BIGINT) AS n FROM range(4) t(b) LEFT JOIN (SELECT {BIN.format(v='salary_min')} AS bin, count(*) AS n FROM J GROUP BY 1) h ON h.bin = b"


def salary_histogram(jobs):
    return e.histogram(jobs, F.col("salary_min").cast("double"), EDGES)


@plan("h1_bin_lookup", "J", sql=f"SELECT job_id, CAST({BIN.format(v='salary_min')} AS BIGINT) AS bin FROM J")
def h1(jobs):
    return jobs.select("job_id", e.bin_of(F.col("salary_min").cast("double"), EDGES).alias("bin"))


@plan("h2_weighted_histogram", "J", sql=f"SELECT b AS bin, CAST(coalesce(n, 0) AS BIGINT) AS n FROM range(4) t(b) LEFT JOIN (SELECT {BIN.format(v='salary_min')} AS bin, sum(la_id) AS n FROM J GROUP BY 1) h ON h.bin = b")
def h2(jobs):
    return e.histogram(jobs, F.col("salary_min").cast("double"), EDGES, F.col("la_id"))


@plan("h3_histogram_2d", "J", sql=f"SELECT CAST({BIN.format(v='salary_min')} AS BIGINT) AS x, CAST({BIN.format(v='salary_max')} AS BIGINT) AS y, count(*) AS n FROM J WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL")
def h3(jobs):
    b = lambda c: e.bin_of(F.col(c).cast("double"), EDGES)
    return jobs.select(b("salary_min").alias("x"), b("salary_max").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL").groupBy("x", "y").agg(n().alias("n"))


@plan("h5_bin_bounds", "J", sql=f"SELECT job_id, [0, 10000, 20000, 30000][b + 1]::DOUBLE AS lower, [10000, 20000, 30000, 50000][b + 1]::DOUBLE AS upper FROM (SELECT job_id, {BIN.format(v='salary_min')} AS b FROM J)")
def h5(jobs):
    b = e.bin_of(F.col("salary_min").cast("double"), EDGES).cast("int")
    return jobs.select("job_id", F.get(F.lit(EDGES), b).alias("lower"), F.get(F.lit(EDGES), b + 1).alias("upper"))


@plan("h6_bin_extremes", "J", sql=f"SELECT min(n) AS lo, max(n) AS hi, CAST(sum(n) AS BIGINT) AS total FROM ({HIST})")
def h6(jobs):
    return salary_histogram(jobs).agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("n").alias("total"))


@plan("h7_elementwise_max", "J", sql=f"SELECT a.bin, greatest(a.n, b.n) AS n FROM ({HIST}) a JOIN ({HIST.replace('salary_min', 'salary_max')}) b USING (bin)")
def h7(jobs):
    return e.combine(salary_histogram(jobs), e.histogram(jobs, F.col("salary_max").cast("double"), EDGES), F.greatest)


@plan("h8_histogram_arithmetic", "J", sql=f"SELECT a.bin, a.n + b.n * 2 AS n FROM ({HIST}) a JOIN ({HIST.replace('salary_min', 'salary_max')}) b USING (bin)")
def h8(jobs):
    return e.combine(salary_histogram(jobs), e.histogram(jobs, F.col("salary_max").cast("double"), EDGES), lambda x, y: x + y * 2)


@plan("h9_slices", "J", sql=f"SELECT CAST({BIN.format(v='salary_max')} AS BIGINT) AS y, count(*) AS n FROM J WHERE {BIN.format(v='salary_min')} = 1 AND y IS NOT NULL GROUP BY ALL")
def h9(jobs):
    return h3(jobs).filter("x = 1").select("y", "n")


@plan("h10_cumulative", "J", sql=f"SELECT bin, CAST(sum(n) OVER (ORDER BY bin) AS BIGINT) AS n FROM ({HIST})")
def h10(jobs):
    return e.cumulative(salary_histogram(jobs))


@plan("h11_density", "J", sql=f"SELECT bin, round(n::DOUBLE / [10000, 10000, 10000, 20000][bin + 1]::DOUBLE, 9) AS density FROM ({HIST})")
def h11(jobs):
    width = F.get(F.lit([b - a for a, b in zip(EDGES, EDGES[1:], strict=False)]), F.col("bin").cast("int"))
    return salary_histogram(jobs).select("bin", F.round(F.col("n").cast("double") / width, 9).alias("density"))


@plan("h12_pairwise_histograms", "J", sql=f"WITH v AS (SELECT unnest([{{'a': 'min', 'b': 'max', 'x': salary_min, 'y': salary_max}}, {{'a': 'min', 'b': 'area', 'x': salary_min, 'y': la_id * 1000}}, {{'a': 'max', 'b': 'area', 'x': salary_max, 'y': la_id * 1000}}]) AS s FROM J) SELECT s.a AS a, s.b AS b, CAST({BIN.format(v='s.x')} AS BIGINT) AS x, CAST({BIN.format(v='s.y')} AS BIGINT) AS y, count(*) AS n FROM v WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL")
def h12(jobs):
    values = {"min": F.col("salary_min"), "max": F.col("salary_max"), "area": (F.col("la_id") * 1000)}
    names = list(values)
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), e.bin_of(values[a].cast("double"), EDGES).alias("x"), e.bin_of(values[b].cast("double"), EDGES).alias("y")) for i, a in enumerate(names) for b in names[i + 1 :]]
    return jobs.select(F.inline(F.array(*pairs))).filter("x IS NOT NULL AND y IS NOT NULL").groupBy("a", "b", "x", "y").agg(n().alias("n"))


@plan("h13_daily_crawls", "W", sql="""WITH d AS (SELECT *, crawled_on::DATE AS day, crawl_number % 5 AS k, crawled_on + to_hours(id % 1000) AS indexed_on FROM W)
SELECT day, count(*) AS crawled, count_if(crawl_number = 0) AS n_new, count_if(crawl_number > 0 AND fail_count = 0) AS recrawl, count_if(crawl_number > 0 AND fail_count > 0) AS failed,
 CAST(sum(k) AS BIGINT) AS s, CAST(sum(k * k) AS BIGINT) AS s2, count(CASE WHEN valid THEN type END) AS n_typed, count_if(id % 1000 < 31 * 24) AS in_delay, CAST(max(least(id % 1000 // 24, 31)) AS BIGINT) AS most_delay FROM d GROUP BY day""")
def h13(log):
    w = log.withColumns({"k": F.col("crawl_number") % 5, "indexed_on": F.expr("crawled_on + make_interval(0, 0, 0, 0, CAST(id % 1000 AS INT))"), "typed": F.when(F.col("valid"), F.col("type"))})
    out = r.daily_crawls(w, "k", ["typed"])
    return out.select("day", "crawled", "n_new", "recrawl", "failed", F.col("k_sum").alias("s"), F.col("k_squares").alias("s2"), F.col("n_typed"), "in_delay", "most_delay")


@plan("h13_index_delays", "W", sql="SELECT CAST(id % 1000 // 24 AS BIGINT) AS bin, count(*) AS n FROM W WHERE id % 1000 < 31 * 24 GROUP BY 1")
def h13_delays(log):
    """Rows by whole days between crawl and index, 0 to 30."""
    days = F.floor((F.unix_micros(F.expr("CAST(crawled_on + make_interval(0, 0, 0, 0, CAST(id % 1000 AS INT)) AS TIMESTAMP)")) - F.unix_micros(F.col("crawled_on").cast("timestamp"))) / 86_400_000_000)
    return log.select(days.alias("bin")).filter(F.col("bin").between(0, 30)).groupBy("bin").agg(n().alias("n"))


@plan("h13_before_window", "W", sql="SELECT count(*) AS crawled, count_if(crawl_number = 0) AS n_new, count_if(crawl_number > 0 AND fail_count = 0) AS recrawl, count_if(crawl_number > 0 AND fail_count > 0) AS failed FROM W WHERE crawled_on < (SELECT date_trunc('day', max(crawled_on)) FROM W)")
def h13_before(log):
    last = log.agg(F.date_trunc("day", F.max("crawled_on")).alias("start"))
    return log.crossJoin(F.broadcast(last)).filter(F.col("crawled_on") < F.col("start")).agg(*r.crawl_counts())


@plan("h14_mean_with_error", "W", sql="SELECT crawled_on::DATE AS day, round(avg(crawl_number), 6) AS mean, round(CASE WHEN count(*) = 1 THEN 0 ELSE sqrt(greatest(var_samp(crawl_number), 0) / count(*)) END, 6) AS error FROM W GROUP BY 1")
def h14(log):
    k = F.col("crawl_number").cast("double")
    s = log.groupBy(F.to_date("crawled_on").alias("day")).agg(F.sum(k).alias("s"), F.sum(k * k).alias("s2"), n().alias("c"))
    mean, error = e.mean_with_error(F.col("s"), F.col("s2"), F.col("c"))
    return s.select("day", F.round(mean, 6).alias("mean"), F.round(error, 6).alias("error"))


@plan("h15_normalised_series", "J", sql="WITH m AS (SELECT date_trunc('month', created)::DATE AS m, count(*)::DOUBLE AS c FROM J GROUP BY 1) SELECT m, round(c / avg(c) OVER (), 9) AS x FROM m")
def h15(jobs):
    m = jobs.groupBy(F.to_date(F.date_trunc("month", "created")).alias("m")).agg(n().cast("double").alias("c"))
    return m.crossJoin(F.broadcast(m.agg(F.avg("c").alias("mean")))).select("m", F.round(F.col("c") / F.col("mean"), 9).alias("x"))


@plan("n8_gaussian_arithmetic", "J", sql="WITH g AS (SELECT category, avg(salary_min) AS m1, stddev_pop(salary_min) AS s1, avg(salary_max) AS m2, stddev_pop(salary_max) AS s2 FROM J GROUP BY category) SELECT category, round(m1 + m2, 4) AS total, round(sqrt(s1 * s1 + s2 * s2), 4) AS total_error, round(m1 / m2, 8) AS ratio, round(sqrt((s1 / m2) ** 2 + (s2 * m1 / (m2 * m2)) ** 2), 8) AS ratio_error, round(m1 ** 3, 2) AS cube, round(abs(3 * m1 ** 2 * s1), 2) AS cube_error FROM g")
def n8(jobs):
    g = jobs.groupBy("category").agg(F.avg("salary_min").alias("m1"), F.stddev_pop("salary_min").alias("s1"), F.avg("salary_max").alias("m2"), F.stddev_pop("salary_max").alias("s2"))
    v = [F.col(c) for c in ("m1", "s1", "m2", "s2")]
    (a, ae), (q, qe), (c, ce) = e.gaussian("+", *v), e.gaussian("/", *v), e.gaussian_power(v[0], v[1], 3)
    return g.select("category", F.round(a, 4).alias("total"), F.round(ae, 4).alias("total_error"), F.round(q, 8).alias("ratio"), F.round(qe, 8).alias("ratio_error"), F.round(c, 2).alias("cube"), F.round(ce, 2).alias("cube_error"))


QUERIES, ORACLES = plan.queries, plan.oracles
