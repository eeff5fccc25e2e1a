"""The domain's views over the driver tables: one SQL text for Spark and for the DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: name -> (tables and views it reads, SQL in which they stand in braces)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "area": (("nation",), """
        SELECT n_nationkey AS la_id, n_name AS la_name, concat('R', cast(n_regionkey AS varchar(9))) AS nuts0,
               concat('R', cast(n_regionkey AS varchar(9)), cast(n_nationkey % 3 AS varchar(9))) AS nuts1,
               concat('R', cast(n_regionkey AS varchar(9)), cast(n_nationkey % 3 AS varchar(9)), cast(n_nationkey % 2 AS varchar(9))) AS nuts2
        FROM {nation}"""),
    "area_in_group": (("nation",), """
        SELECT n_nationkey AS la_id, n_regionkey AS lep_id FROM {nation}
        UNION ALL SELECT n_nationkey, (n_regionkey + 1) % 5 FROM {nation} WHERE n_nationkey % 5 = 0"""),
    "J": (("orders", "customer"), """
        SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS source, o_orderdate AS created, o_orderpriority AS category,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS merged_title, c_name AS company, c_nationkey AS la_id,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 8) AS BIGINT) END AS salary_min,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 6) AS BIGINT) END AS salary_max,
               CASE o_orderstatus WHEN 'F' THEN 'year' WHEN 'O' THEN 'hour' ELSE 'day' END AS salary_period
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""),
    "JS": (("lineitem", "part"), """
        SELECT l_orderkey AS job_id, p_name AS skill, l_linenumber AS pos FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""),
    "P": (("customer",), """
        SELECT c_custkey AS profile_id, c_name AS name, c_mktsegment AS sector, c_nationkey AS la_id,
               concat('Supplier ', cast(c_custkey % 20 AS varchar(9)), ' Ltd') AS company, c_acctbal AS score FROM {customer}"""),
    "X": (("events",), """
        SELECT event_id AS exp_id, user_id AS profile_id, event_type AS title, concat('Company ', cast(event_id % 7 AS varchar(9))) AS company,
               ts AS start_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts, value FROM {events}"""),
    "W": (("events",), """
        SELECT event_id AS id, concat('u', cast(user_id AS varchar(9))) AS url, ts AS crawled_on, event_type AS type, event_type <> 'error' AS valid,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fail_count,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS crawl_number FROM {events}"""),
    "TT": (("part",), """
        SELECT p_partkey AS id, p_name AS base, p_type AS kind, p_brand AS brand,
               concat(CASE p_partkey % 5 WHEN 0 THEN 'Senior ' WHEN 1 THEN 'Junior Lead ' WHEN 2 THEN '2x ' ELSE '' END, p_name,
                      CASE p_partkey % 4 WHEN 0 THEN ' Engineer at ' WHEN 1 THEN ' Intern for ' WHEN 2 THEN ' Caf\u00e9 (m/f) at ' ELSE ' - ' END, p_type) AS title,
               CASE p_partkey % 5 WHEN 0 THEN 'Senior ' WHEN 1 THEN 'Junior Lead ' WHEN 2 THEN '2x ' ELSE '' END AS prefix,
               CASE p_partkey % 4 WHEN 0 THEN ' Engineer' WHEN 1 THEN ' Intern' WHEN 2 THEN ' Caf\u00e9' ELSE '' END AS suffix
        FROM {part}"""),
    "SAL": (("orders",), """
        SELECT o_orderkey AS id, o_orderkey % 6 AS shape, 20 + o_orderkey % 40 AS lo, 25 + o_orderkey % 40 AS hi,
               CASE o_orderkey % 6
                 WHEN 0 THEN concat('We offer a salary of \u00a3', CAST(20 + o_orderkey % 40 AS varchar(9)), 'k-\u00a3', CAST(25 + o_orderkey % 40 AS varchar(9)), 'k plus benefits')
                 WHEN 1 THEN concat('Rate: \u00a3', CAST(20 + o_orderkey % 40 AS varchar(9)), ' per hour, overtime \u00a3', CAST(60 + o_orderkey % 40 AS varchar(9)), ' per hour')
                 WHEN 2 THEN concat('Salary $', CAST(20 + o_orderkey % 40 AS varchar(9)), ',000 to $', CAST(25 + o_orderkey % 40 AS varchar(9)), ',000 pa')
                 WHEN 3 THEN concat('Turnover of \u00a3', CAST(20 + o_orderkey % 40 AS varchar(9)), ' million last year')
                 WHEN 4 THEN concat('Band \u20ac', CAST(20 + o_orderkey % 40 AS varchar(9)), '-', CAST(25 + o_orderkey % 40 AS varchar(9)), 'k depending on skill')
                 ELSE 'Competitive pay' END AS text
        FROM {orders}"""),
    "WD": (("events",), """
        SELECT event_id AS id, concat('u', cast(user_id % 2000 AS varchar(9))) AS url, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS crawled_on,
               event_type <> 'error' AS valid, CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS redirect_url,
               CASE WHEN event_type = 'error' THEN event_id % 3 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS fail_count FROM {events}"""),
    "C": (("part",), """
        SELECT p_partkey AS id, concat(cast(p_size AS varchar(9)), ' years') AS d,
               CASE p_partkey % 3 WHEN 0 THEN 'Not Available' WHEN 1 THEN cast(100 + p_size AS varchar(9))
                 ELSE concat(cast(100 + p_size AS varchar(9)), '-', cast(120 + p_size AS varchar(9))) END AS p
        FROM {part}"""),
    "DOC": (("orders",), """
        SELECT o_orderkey AS id, concat('{{"title": ', CASE WHEN o_orderkey % 5 = 0 THEN '17' ELSE concat('"', o_orderpriority, '"') END,
               CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat(', "customer": ', cast(o_custkey AS varchar(9))) END,
               ', "url": "', CASE WHEN o_orderkey % 4 = 0 THEN 'ftp' ELSE 'http' END, '://example.org/", "tags": ["a", ',
               CASE WHEN o_orderkey % 6 = 0 THEN 'null' ELSE '"b"' END, ']', CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '}}' END) AS doc
        FROM {orders}"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view over them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, sql = VIEWS[name]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in needs})


def oracle_with(names: tuple[str, ...], sql: str) -> str:
    """SQL for DuckDB with the views that it needs in front; sql may have CTEs of its own after WITH."""
    ctes = [f"{n} AS ({VIEWS[n][1].format(**{t: t for t in VIEWS[n][0]})})" for n in names if n in VIEWS]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        ctes.append(body[5:])
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
