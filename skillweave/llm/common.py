"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: blank and the control characters 9 to 13.
WHITE = b" \t\n\x0b\x0c\r"
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WHITE)] = True
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share. A session without one gets a folder of its own only in local mode (as
    in tests), where driver and executors are one process; on a cluster that is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="skillweave-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and read back from the shared folder; a lost executor costs nothing that lies before it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def bounded_batches(spark: SparkSession) -> None:
    """Holds Arrow batches of texts to BATCH_ROWS rows, in the JVM as in Python, unless the session names a size."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds _id and _th: an id of any kind, null included, plus a text hash name a row, so equal ids with different
    texts stay apart and rows that repeat exactly share one decision."""
    bounded_batches(docs.sparkSession)
    return docs.withColumns({"_id": F.col(f"`{id_col}`"), "_th": F.xxhash64(F.col(f"`{text_col}`"))})


def key_matches(docs: DataFrame, id_col: str, text_col: str, other: DataFrame, other_id: str, other_th: str) -> Column:
    """Join condition of whole rows of docs with keys as `with_key` gives them; adds no column that could clash."""
    return docs[f"`{id_col}`"].eqNullSafe(other[other_id]) & (F.xxhash64(docs[f"`{text_col}`"]) == other[other_th])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    white = np.ones(len(data) + 2, dtype=np.int8)
    white[1:-1] = _IS_WHITE[data]
    edges = np.flatnonzero(np.diff(white))
    return edges[0::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_edges(data)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n words; empty when there are fewer words."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    count = len(words) - n + 1
    out = words[:count].copy()
    for k in range(1, n):
        out = out * _BASE + words[k : k + count]
    return mix(out)


def connected_components(edges: DataFrame) -> DataFrame:
    """v, root: each vertex of an edge table (a, b: long) with the smallest vertex of its component.

    Large-star and small-star rounds: edges are pulled to the smallest neighbour until nothing moves, however many rounds
    that takes (it grows with the square of the logarithm of the longest path at most). Every round is written to the shared
    folder."""
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = checkpointed(links)
    size = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        # all edges now point to a smaller vertex
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        links = checkpointed(small.filter("a <> b").distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == size:
            break
        size = tuple(now)
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("v"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read back; smaller there than a checkpoint."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As `stored`, with the folder, for `drop_folder` once its last reader is done."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices, so that no more texts than these are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bits of a part of a key filter.
PART_BITS = 19


def key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for the end of each key (k: long), packed; parts are made where their keys are, so the driver gets 2 ** bits bits."""

    def run(part: pa.Table) -> pa.Table:
        held = np.zeros(1 << PART_BITS, dtype=bool)
        held[part.column("bit").to_numpy() & ((1 << PART_BITS) - 1)] = True
        return pa.table({"part": part.column("part")[:1], "bits": pa.array([np.packbits(held).tobytes()], pa.binary())})

    bit = keys.select(F.col("k").bitwiseAND(F.lit((1 << bits) - 1)).alias("bit")).distinct()
    parts = bit.withColumn("part", F.shiftright("bit", PART_BITS)).groupBy("part").applyInArrow(run, "part long, bits binary").collect()
    out = np.zeros(1 << bits >> 3, dtype=np.uint8)
    for r in parts:
        at = r.part << PART_BITS >> 3
        out[at : at + (1 << PART_BITS >> 3)] = np.frombuffer(r.bits, np.uint8)
    return out


def may_hold(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (unsigned) may be among those of a `key_filter`; never false for one that is."""
    bit = keys & np.uint64(8 * len(packed) - 1)
    return ((packed[bit >> np.uint64(3)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1).astype(bool)
