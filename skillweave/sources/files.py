"""Readers and writers of the engine's file formats, with declared schemas and quarantine of malformed rows."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.session import work_folder

BAD = "_malformed"


def read_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines): `#` comments and blank lines are skipped; a row of the wrong arity is kept apart, whole."""
    typed = T._parse_datatype_string(schema)
    lines = spark.read.text(path).withColumn("value", F.trim("value")).filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    parsed = lines.select("value", F.from_csv("value", typed.add(BAD, "string").simpleString()[7:-1].replace(":", " ").replace(",", ", "), {"columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"}).alias("r"))
    good = parsed.filter(f"r.{BAD} IS NULL").select(*[F.col(f"r.{f.name}") for f in typed.fields if f.name != BAD])
    return good, parsed.filter(f"r.{BAD} IS NOT NULL").select(F.col("value").alias("line"))


def read_skill_list(spark: SparkSession, path: str) -> DataFrame:
    """lang, skill: one column means English, two are language and skill."""
    cells = spark.read.text(path).filter("trim(value) <> '' AND NOT startswith(value, '#')").select(F.split("value", ",").alias("c"))
    two = F.size("c") > 1
    return cells.select(F.when(two, F.trim(F.col("c")[0])).otherwise("en").alias("lang"), F.trim(F.when(two, F.get("c", F.lit(1))).otherwise(F.col("c")[0])).alias("skill"))


def write_skill_vectors(vectors: DataFrame, path: str) -> None:
    """vectors(title, skill, w, n) as tagged rows in one order: `t,title,n`, then its `s,skill,w` by falling weight."""
    heads = vectors.groupBy("title").agg(F.max("n").alias("n")).select("title", F.lit(0).alias("k"), F.lit(0.0).alias("neg"), F.lit("").alias("s"), F.concat_ws(",", F.lit("t"), "title", F.col("n").cast("string")).alias("value"))
    items = vectors.select("title", F.lit(1).alias("k"), (-F.col("w")).alias("neg"), F.col("skill").alias("s"), F.concat_ws(",", F.lit("s"), "skill", F.col("w").cast("string")).alias("value"))
    # each title's rows stay together and in order in one file; titles are spread over the files by range
    heads.unionByName(items).repartitionByRange("title").sortWithinPartitions("title", "k", "neg", "s").select("value").write.mode("overwrite").text(path)


def read_skill_vectors(spark: SparkSession, path: str, titles: list[str] | None = None) -> DataFrame:
    """title, skill, w: weights times the title's count. A skill row belongs to the last title row above it in its file.
    With a list of titles only these are read; one that no title row names is an error."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("at"))
    cells = F.split("value", ",")
    above = W.partitionBy("f").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    head = F.last(F.when(cells[0] == "t", F.struct(cells[1].alias("title"), F.get(cells, F.lit(2)).cast("double").alias("n"))), ignorenulls=True).over(above)
    if titles is not None:
        # at most one row for each listed title
        found = rows.filter(cells[0] == "t").filter(cells[1].isin(titles)).select(cells[1].alias("title")).distinct().collect()
        missing = sorted(set(titles) - {x.title for x in found})
        if missing:
            raise ValueError(f"titles without a row: {', '.join(missing)}")
    out = rows.withColumn("h", head).filter(cells[0] == "s").select("h.title", cells[1].alias("skill"), (cells[2].cast("double") * F.col("h.n")).alias("w"))
    return out if titles is None else out.filter(F.col("title").isin(titles))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table, read in ranges of a numeric key; the bounds only deal out the rows."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """df into a database table, each partition over a connection of its own."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


#: What a checked field may be: the type of its value as a variant, and the column's type.
FIELD_KINDS = {"str": ("STRING", "string"), "url": ("STRING", "string"), "int": ("BIGINT", "bigint"), "float": ("BIGINT|DOUBLE|DECIMAL.*", "double"), "bool": ("BOOLEAN", "boolean"), "dict": ("OBJECT.*", "string")}


def checked_documents(docs: DataFrame, json_col: str, spec: dict[str, tuple[str | list[str], bool]], wrapper: str = "my_array_list") -> tuple[DataFrame, DataFrame]:
    """(documents with the spec's fields as columns, documents with the reason of the first check that failed).

    spec maps a field to its kind, or a list of one kind, and whether it is required. A null value is of no kind; a url
    starts with http; a list may come inside an object of the wrapper's name alone."""
    v = F.col("__v")

    def wrong(x, kind: str):
        bad = ~F.schema_of_variant(x).rlike(f"^(?:{FIELD_KINDS[kind][0]})$")
        return bad | ~F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("")).startswith("http") if kind == "url" else bad

    columns, reason = [], F.when(v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"), "not a document")
    for name, (kind, required) in spec.items():
        field = F.try_variant_get(v, f"$.{name}", "variant")
        if required:
            reason = reason.when(field.isNull(), f"missing {name}")
        if isinstance(kind, list):
            inner = F.try_variant_get(v, f"$.{name}.{wrapper}", "variant")
            field = F.when(F.schema_of_variant(field).rlike(f"^OBJECT<{wrapper}: [^:]*>$"), inner).otherwise(field)
            items = F.try_variant_get(field, "$", "array<variant>")
            bad = items.isNull() | F.exists(items, lambda x: F.coalesce(wrong(x, kind[0]), F.lit(True)))
            value = F.transform(items, lambda x: F.try_variant_get(x, "$", FIELD_KINDS[kind[0]][1]))
        else:
            bad, value = wrong(field, kind), F.try_variant_get(field, "$", FIELD_KINDS[kind][1])
        reason = reason.when(field.isNotNull() & F.coalesce(bad, F.lit(True)), f"invalid {name}")
        columns.append(value.alias(name))
    parsed = docs.withColumn("__v", F.try_parse_json(json_col))
    parsed = parsed.withColumn("reason", reason)
    own = [c for c in docs.columns if c != json_col]
    return parsed.filter("reason IS NULL").select(*own, *columns), parsed.filter("reason IS NOT NULL").select(*docs.columns, "reason")


def job_dimensions(raw: DataFrame, json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """The distinct categories (tag, label) and companies of job-API records."""
    r = F.from_json(json_col, "category struct<tag: string, label: string>, company struct<display_name: string>")
    rows = raw.select(r.alias("r"))
    categories = rows.select("r.category.tag", "r.category.label").filter("tag IS NOT NULL").distinct()
    return categories, rows.select(F.col("r.company.display_name").alias("company")).filter("company IS NOT NULL").distinct()


def geojson_features(regions: DataFrame, code: str, name: str, parts: str) -> DataFrame:
    """value: one GeoJSON feature a region, its parts (polygons of rings, the first one the outline, of points x, y) as a polygon
    or several, rings closed. A region without parts has no geometry."""

    def ring(r):
        shut = F.when(F.get(r, F.lit(0)) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1)))
        return F.transform(shut, lambda q: F.array(q["x"], q["y"]))

    shapes = F.transform(parts, lambda p: F.transform(p, ring))
    one = F.size(parts) == 1
    geometry = F.concat(F.lit('{"type":"'), F.when(one, "Polygon").otherwise("MultiPolygon"), F.lit('","coordinates":'), F.when(one, F.to_json(F.get(shapes, F.lit(0)))).otherwise(F.to_json(shapes)), F.lit("}"))
    properties = F.to_json(F.struct(F.col(code).alias("id"), F.col(name).alias("name")))
    return regions.select(F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}")).alias("value"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """id, name, parts of GeoJSON polygons and multi-polygons; other geometries have no parts."""
    rows = spark.read.schema("properties struct<id: string, name: string>, geometry struct<type: string, coordinates: string>").json(path)
    polygon = "array<array<array<double>>>"
    shapes = F.when(F.col("geometry.type") == "Polygon", F.array(F.from_json("geometry.coordinates", polygon))).when(F.col("geometry.type") == "MultiPolygon", F.from_json("geometry.coordinates", f"array<{polygon}>"))
    point = lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))
    return rows.select("properties.id", "properties.name", F.transform(shapes, lambda p: F.transform(p, lambda r: F.transform(r, point))).alias("parts"))


def bounds(regions: DataFrame, by: str, parts: str) -> DataFrame:
    """The bounding box of all parts of each group."""
    q = regions.select(by, F.explode(F.flatten(F.flatten(parts))).alias("q"))
    return q.groupBy(by).agg(F.min("q.x").alias("west"), F.min("q.y").alias("south"), F.max("q.x").alias("east"), F.max("q.y").alias("north"))


def job_records(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """Job-API records flat: area levels to columns, "0"/"1" to booleans, ids to numbers."""
    r = F.from_json(json_col, "id string, title string, full_time string, location struct<area: array<string>>, category struct<tag: string, label: string>")
    flag = F.when(F.col("r.full_time") == "1", True).when(F.col("r.full_time") == "0", False)
    areas = [F.get("r.location.area", F.lit(k)).alias(f"location{k}") for k in range(5)]
    return raw.select(r.alias("r")).select(F.col("r.id").try_cast("long").alias("id"), "r.title", flag.alias("full_time"), F.col("r.category.tag").alias("category"), *areas)


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """df, computed once and read back from the session's checkpoint folder; one of its own only where none is named."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()
