"""Round trips of the file formats."""

import uuid

import pytest
from pyspark.sql import functions as F

from skillweave.sources import files


def test_csv_keeps_malformed_rows_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text("# note\n1,a,2.5\n\n2,b\nnot,a,number\n3,c,4\n")
    good, bad = files.read_csv(spark, f"file://{tmp_path}/x.csv", "k long, name string, v double")
    assert sorted(map(tuple, good.collect())) == [(1, "a", 2.5), (3, "c", 4.0)]
    assert {x.line for x in bad.collect()} == {"2,b", "not,a,number"}


def test_skill_vectors_round_trip(spark, tmp_path):
    v = spark.createDataFrame([("t1", "a", 0.5, 2), ("t1", "b", 0.75, 2), ("t2", "a", 1.0, 3)], "title string, skill string, w double, n int")
    files.write_skill_vectors(v, f"file://{tmp_path}/v")
    out = {(x.title, x.skill): x.w for x in files.read_skill_vectors(spark, f"file://{tmp_path}/v").collect()}
    assert out == {("t1", "a"): 1.0, ("t1", "b"): 1.5, ("t2", "a"): 3.0}


def test_job_records(spark):
    rows = [('{"id": "7", "title": "x", "full_time": "1", "location": {"area": ["UK", "London"]}, "category": {"tag": "it", "label": "IT"}}',), ("{}",)]
    out = files.job_records(spark.createDataFrame(rows, "json string")).orderBy(F.desc_nulls_last("id")).collect()
    assert (out[0].id, out[0].full_time, out[0].category, out[0].location0, out[0].location1, out[0].location2) == (7, True, "it", "UK", "London", None)
    assert out[1].id is None


def test_listed_titles_must_exist(spark, tmp_path):
    v = spark.createDataFrame([("t1", "a", 0.5, 2), ("t2", "a", 1.0, 3)], "title string, skill string, w double, n int")
    files.write_skill_vectors(v, f"file://{tmp_path}/v")
    assert [tuple(x) for x in files.read_skill_vectors(spark, f"file://{tmp_path}/v", ["t2"]).collect()] == [("t2", "a", 3.0)]
    with pytest.raises(ValueError, match="t9"):
        files.read_skill_vectors(spark, f"file://{tmp_path}/v", ["t1", "t9"])


def test_database_round_trip(spark):
    """A database inside this process, so only for one machine."""
    url, options = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(1, 201).select(F.col("id").alias("k"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"), (F.col("id") / 4).alias("v"))
    files.write_jdbc(df, url, "people", "overwrite", **options)
    files.write_jdbc(df.filter("k <= 50").withColumn("k", F.col("k") + 200), url, "people", **options)
    back = files.read_jdbc(spark, url, "people", "k", 1, 250, 5, **options)
    assert back.rdd.getNumPartitions() == 5
    assert (back.count(), back.agg(F.sum("v")).first()[0]) == (250, sum(range(1, 201)) / 4 + sum(range(1, 51)) / 4)
    assert back.filter("k = 250").first().name == "name 50"


def test_checked_documents(spark):
    rows = ['{"a": "x", "u": "http://e", "l": ["p", "q"], "f": 1}', '{"a": "x", "l": {"my_array_list": ["p"]}, "f": 1.5}', '{"a": null}', "{}", '{"a": "x", "l": "p"}', '{"a": "x", "l": ["p", 3]}', '{"a": "x", "u": "e"}', '{"a": "x", "f": "1"}', "[1]", "nothing", None, '{"a": "x", "l": []}']
    docs = spark.createDataFrame(list(enumerate(rows)), "id int, doc string")
    good, bad = files.checked_documents(docs, "doc", {"a": ("str", True), "u": ("url", False), "l": (["str"], False), "f": ("float", False)})
    assert sorted(map(tuple, good.collect())) == [(0, "x", "http://e", ["p", "q"], 1.0), (1, "x", None, ["p"], 1.5), (11, "x", None, [], None)]
    why = {x.id: x.reason for x in bad.collect()}
    assert why == {2: "invalid a", 3: "missing a", 4: "invalid l", 5: "invalid l", 6: "invalid u", 7: "invalid f", 8: "not a document", 9: "not a document", 10: "not a document"}


def test_features_close_their_rings(spark, tmp_path):
    square = spark.sql("SELECT 'R1' AS code, 'One' AS name, array(array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 2D, 'y', 0D), named_struct('x', 2D, 'y', 3D)))) AS parts")
    files.geojson_features(square, "code", "name", "parts").write.text(f"file://{tmp_path}/g")
    back = files.read_features(spark, f"file://{tmp_path}/g")
    ring = back.first().parts[0][0]
    assert len(ring) == 4 and ring[0] == ring[-1]
    assert tuple(files.bounds(back, "id", "parts").first()) == ("R1", 0.0, 0.0, 2.0, 3.0)
