"""Keys of entities: what a key is made of is worked out once."""

import re

import pytest
from pyspark.sql import functions as F
from skillweave.functions import text as t
from skillweave.operators import relevance as e
from skillweave.plans import registry

KINDS = ("skill", "title", "job_title", "company", "sector", "institute", "degree", "subject")


def readings(df, column):
    """How often the expressions of the optimised plan read a column."""
    top = df._jdf.queryExecution().optimizedPlan()
    reads = lambda node: sum(len(re.findall(rf"\b{column}#\d+", node.expressions().apply(k).toString())) for k in range(node.expressions().size()))
    below = lambda node: [node.children().apply(k) for k in range(node.children().size())]
    nodes, total = [top], 0
    while nodes:
        node = nodes.pop()
        nodes += below(node)
        total += reads(node) if below(node) else 0
    return total


@pytest.mark.parametrize("kind", KINDS)
def test_a_key_reads_its_text_once(spark, kind):
    """An expression that stands in a plan many times is worked out as often inside a lambda."""
    df = spark.createDataFrame([(1, "Senior Chef")], "id int, nm string")
    assert readings(df.select(t.entity_key(kind, "A", "en", F.col("nm"), ("of",)).alias("k")), "nm") == 1


def test_words_beside_a_word_are_not_worked_out_again(spark):
    df = spark.createDataFrame([(1, "2x Chef up to 40k")], "id int, nm string")
    assert readings(df.select(t.job_post_title(F.col("nm")).alias("k")), "nm") == 1
    assert readings(df.select(t.split_title(F.split("nm", " ")).alias("k")), "nm") == 1


def test_each_different_text_is_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(x):
        seen.add(1)
        return None if x is None else x.upper()

    df = spark.createDataFrame([(k, (None, "a", "b", "")[k % 4]) for k in range(400)], "id int, nm string").repartition(7)
    rows = e.per_text(df, "nm", {"k": slow, "n": F.length}).collect()
    assert sorted((r.id, r.nm, r.k, r.n) for r in rows) == [(k, *((None, None, None), ("a", "A", 1), ("b", "B", 1), ("", "", 0))[k % 4]) for k in range(400)]
    assert seen.value == 4


@pytest.mark.parametrize("name", ["t18_entity_dispatch", "t10_job_post_keys", "t7_title_keys"])
def test_queries_work_out_different_texts_only(spark, sf_dir, name):
    """The texts pass a distinct before anything is made of them."""
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    made = [k for k, line in enumerate(plan.splitlines()) if "lambdafunction" in line]
    assert made
    for k in made:
        assert any("Aggregate" in line for line in plan.splitlines()[k + 1 : k + 4]), plan.splitlines()[k][:200]
