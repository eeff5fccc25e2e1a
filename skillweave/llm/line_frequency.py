"""Quality rules with cross-document line frequency.

Each text is split at line feeds. A line is normalised (lower case, runs of white space to one blank) and hashed. For
each host, the distinct documents that hold a line are counted: documents of a host with the same set of lines are one
document, so a group of exact copies doesn't make its own lines look like boilerplate, whatever its size. (Copies that differ
in some line are different documents; the lines that many of them share are frequent lines, as in any template.) Lines above
both limits (so many distinct documents, and such a share of the host's) are removed; a document left with too small a share
of its words is rejected. Base rules on the whole text reject very short and very repetitive documents.

Defined results: a null text is an empty one (no words, so it fails the base rules); a null host is a host of its own;
null or repeated ids are allowed, rows that repeat exactly share their result; lines without a word are never counted or
removed; an empty table gives an empty result; the added columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import WHITE, checkpointed, gram_hashes, key_matches, mix, small, with_key, word_hashes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCUMENTS = 10
MAX_SHARE = 0.002
MIN_LEFT_SHARE = 0.3
SYMBOLS = b"#*$%&|<>"

_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS = "_th long, " + ", ".join(f"{c} long" for c in _FIGURES)
_LINES = "line_set long, lines array<struct<h: long, w: long>>"


def line_hash(line: str) -> int | None:
    """Hash of the normalised line; None for one without a word."""
    words = line.lower().encode("utf-8", "replace").split()
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63) if words else None


def text_stats(text: str) -> tuple[int, int, int, int, int, dict[int, int]]:
    """The base figures of one text, and the words in all of each distinct line by its hash."""
    data = text.encode("utf-8", "replace")
    words = word_hashes(data)
    n_chars = len(text) - (len(data) - len(data.translate(None, WHITE)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))

    repeated = 0
    grams = gram_hashes(words, 3)
    if len(grams) > 1:
        order = np.sort(grams)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if len(twice):
            hit = np.isin(grams, twice)
            covered = np.zeros(len(words), dtype=bool)
            for k in range(3):
                covered[k : k + len(grams)] |= hit
            repeated = int(covered.sum())

    seen: set[str] = set()
    dup_lines = 0
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        n = len(line.encode("utf-8", "replace").split())
        if n:
            dup_lines += line in seen
            seen.add(line)
            h = line_hash(line)
            lines[h] = lines.get(h, 0) + n
    return len(words), n_chars, n_symbols, dup_lines, repeated, lines


def line_set_hash(lines: dict[int, int]) -> int:
    """A hash of a set of lines, whatever their order or number of repeats."""
    return int(mix(np.array([*lines, len(lines)], dtype=np.int64).view(np.uint64)).sum(dtype=np.uint64).view(np.int64))


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int64())]))
    for batch in small(batches):
        found = [text_stats(t or "") for t in batch.column("_text").to_pylist()]
        columns = [pa.array([x[k] for x in found], pa.int64()) for k in range(len(_FIGURES))]
        columns.append(pa.array([line_set_hash(x[-1]) for x in found], pa.int64()))
        columns.append(pa.array([[{"h": h, "w": w} for h, w in x[-1].items()] for x in found], kind))
        keep = [batch.column(x) for x in ("_id", "_host", "_th")]
        yield pa.RecordBatch.from_arrays([*keep, *columns], names=["_id", "_host", "_th", *_FIGURES, "line_set", "lines"])


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """_id, _th, _host, the base figures and the distinct lines of each row; written once to the shared folder."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{host_col}`").alias("_host"), F.col(f"`{text_col}`").alias("_text"))
    types = dict(keyed.dtypes)
    schema = f"_id {types['_id']}, _host {types['_host']}, {_STATS}, {_LINES}"
    return checkpointed(keyed.mapInArrow(_stats_batches, schema))


def frequent_lines(stats: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """_host, h, n_docs: lines above both limits, with the distinct documents that hold them. A set of lines stays one row of
    its host before anything is exploded, and counts are partial sums before they move: no hot host, line or group of copies
    is a hot task."""
    distinct = stats.groupBy("_host", "line_set").agg(F.any_value(F.transform("lines", lambda x: x["h"])).alias("hashes"))
    per_line = distinct.select("_host", F.explode("hashes").alias("h")).groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n_docs"))
    hosts = stats.select("_host", "line_set").distinct().groupBy(F.col("_host").alias("_of")).agg(F.count(F.lit(1)).alias("n_host"))
    return (
        per_line.filter(F.col("n_docs") > min_documents)
        .join(hosts, F.col("_host").eqNullSafe(F.col("_of")))
        .filter(F.col("n_docs") > F.col("n_host") * F.lit(max_share))
        .select("_host", "h", "n_docs")
    )


def verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE, min_left_share: float = MIN_LEFT_SHARE,
) -> DataFrame:
    """One row for each row of docs: _id, _th, the base figures, removed (hashes of the lines to remove), n_removed_words,
    base_failed, depleted, kept."""
    stats = document_stats(docs, id_col, text_col, host_col)
    frequent = frequent_lines(stats, min_documents, max_share).select(F.col("_host").alias("_of"), F.col("h").alias("fh"))
    # a row number is not needed: rows that repeat exactly are made one here and meet again in the join below
    lines = stats.select("_id", "_th", "_host", F.explode("lines").alias("line"))
    hit = lines.join(frequent, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("line.h") == F.col("fh")))
    removed = hit.groupBy(F.col("_id").alias("_rid"), F.col("_th").alias("_rth"), F.col("_host").alias("_rhost")).agg(
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct("line.h", "line.w")))).alias("_lines")
    )
    out = stats.drop("lines", "line_set").join(
        removed, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")) & F.col("_host").eqNullSafe(F.col("_rhost")), "left"
    )
    lost = F.coalesce(F.aggregate(F.map_values("_lines"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(
        "_id", "_th", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce(F.map_keys("_lines"), F.array().cast("array<bigint>")).alias("removed"),
        lost.alias("n_removed_words"),
        base.alias("base_failed"),
        (F.col("n_words") - lost < F.col("n_words") * F.lit(min_left_share)).alias("depleted"),
    ).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def _without(lines_of: tuple[str | None, list[int] | None]) -> str | None:
    text, removed = lines_of
    if text is None or not removed:
        return text
    gone = set(removed)
    return "\n".join(x for x in text.split("\n") if line_hash(x) not in gone)


def _clean_batches(names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column(text_col).to_pylist()
            cleaned = [_without(x) for x in zip(texts, batch.column("__removed").to_pylist(), strict=True)]
            at = names.index(text_col)
            columns = [pa.array(cleaned, pa.string()) if k == at else batch.column(n) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def apply_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """docs without the rejected rows and the frequent lines; same columns, n_chars renewed."""
    v = verdicts(docs, id_col, text_col, host_col)
    v = v.filter("kept").select(F.col("_id").alias("__vid"), F.col("_th").alias("__vth"), F.col("_host").alias("__vhost"), F.col("removed").alias("__removed"))
    v = v.dropDuplicates(["__vid", "__vth", "__vhost"])
    joined = docs.join(v, key_matches(docs, id_col, text_col, v, "__vid", "__vth") & docs[f"`{host_col}`"].eqNullSafe(v["__vhost"]))
    kept = joined.select(*[docs[f"`{c}`"] for c in docs.columns], "__removed")
    out = kept.mapInArrow(_clean_batches(docs.columns, text_col), docs.schema)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(chars_col).isNotNull(), F.length(text_col).cast(docs.schema[chars_col].dataType)))
    return out


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(docs).select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("n_removed_words"), "base_failed", "kept",
    )


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
gg AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM gg WHERE c > 1) GROUP BY doc_id),
l0 AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
l1 AS (SELECT doc_id, source, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
       lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM l0),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS seen FROM l1 WHERE n > 0),
dup AS (SELECT doc_id, sum(CASE WHEN seen > 1 THEN 1 ELSE 0 END) AS n FROM l GROUP BY doc_id),
one AS (SELECT doc_id, source, norm, sum(n) AS n FROM l GROUP BY doc_id, source, norm),
sets AS (SELECT doc_id, source, string_agg(norm, chr(10) ORDER BY norm) AS line_set FROM one GROUP BY doc_id, source),
host AS (SELECT d.source, count(DISTINCT coalesce(sets.line_set, '')) AS n_host FROM d LEFT JOIN sets USING (doc_id) GROUP BY d.source),
f AS (SELECT o.source, o.norm FROM one o JOIN sets USING (doc_id) JOIN host h ON o.source IS NOT DISTINCT FROM h.source GROUP BY o.source, o.norm
      HAVING count(DISTINCT sets.line_set) > {MIN_DOCUMENTS} AND count(DISTINCT sets.line_set) > max(h.n_host) * CAST({MAX_SHARE} AS DOUBLE)),
lost AS (SELECT o.doc_id, sum(o.n) AS n FROM one o JOIN f ON o.source IS NOT DISTINCT FROM f.source AND o.norm = f.norm GROUP BY o.doc_id),
s AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
  AND NOT (n_words - n_removed_words < n_words * CAST({MIN_LEFT_SHARE} AS DOUBLE)) AS kept
FROM s
"""

QUERIES = {"op1_line_frequency": op1_line_frequency}
ORACLES = {"op1_line_frequency": OP1_SQL}
