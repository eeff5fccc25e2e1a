"""Line dedup by a deletion-neighbourhood join.

Lines are sequences of lower-case words. A line with a word goes when an equal line comes earlier in the order of (id, text
hash, line number); one of MIN_WORDS words or more also when such a line within one word edit (insert, delete, replace)
does. The earlier line counts whether or not it goes itself. One edit in five words is the usual similarity of 0.8, which
is why shorter lines must be equal.

1. Lines one half of which equals the half of another line, of the same length or a word longer or shorter, are suspects:
   one edit can't touch both halves, so no pair within the bound is missed.
2. For each suspect all variants within the bound are emitted as hashed keys: without word i at place i (equal keys: one
   replaced word), the whole line as the shorter one, and without word i as the longer one (equal keys: one word more).
3. Equal keys are joined through the smallest order of each kind in a key's group, never as pairs of a group; what comes
   out is verified by the edit distance of the words.

Defined results: a null text has no lines and stays null; empty texts stay; null ids sort last and rows that repeat are
documents that repeat each other's lines, and as their keys are equal the lines are kept in both; a text of which no line
is left becomes empty; empty tables give empty results; columns of any name pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import key_matches, mix, powers, small, stored, with_key, word_edges, word_hashes

MIN_WORDS = 5
#: Bytes of the texts that are hashed together.
BLOCK_BYTES = 1 << 19


class Lines:
    """The lines of a block of texts that hold a word, as runs of word hashes."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
        data = b"\n".join(raw)
        self.words = word_hashes(data)
        array = np.frombuffer(data, dtype=np.uint8)
        breaks = np.flatnonzero(array == 10)
        counts = np.bincount(np.searchsorted(breaks, word_edges(array)[0]), minlength=len(breaks) + 1)
        lines = np.array([x.count(b"\n") + 1 for x in raw], dtype=np.int64)
        heads = np.cumsum(lines) - lines
        self.n_lines = np.where([bool(x) for x in raw], lines, 0)
        held = np.flatnonzero(counts)
        self.doc = np.searchsorted(heads, held, side="right") - 1
        self.pos = held - heads[self.doc]
        self.n = counts[held]
        self.start = (np.cumsum(counts) - counts)[held]
        up, self.down = powers(len(self.words) + 1)
        self.total = np.zeros(len(self.words) + 1, dtype=np.uint64)
        np.cumsum(self.words * up[:-1], out=self.total[1:])

    def run_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from start to end, whatever their place in the block."""
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.run_hash(self.start, self.start + self.n)

    def half_keys(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, key, line hash): both halves of each line, as the line of its own length and as one with a word too many;
        in the order of doc."""
        docs, keys, owners = [], [], []
        for more in (0, 1):
            use = self.n >= MIN_WORDS + more
            s, n = self.start[use], self.n[use] - more
            left = n // 2
            for side, (lo, hi) in enumerate(((s, s + left), (s + left + more, s + n + more))):
                keys.append(mix(self.run_hash(lo, hi) + (2 * n + side).astype(np.uint64)))
                owners.append(h[use])
                docs.append(self.doc[use])
        doc = np.concatenate(docs)
        order = np.argsort(doc, kind="stable")
        return doc[order], np.concatenate(keys)[order], np.concatenate(owners)[order]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of blocks of about BLOCK_BYTES; a longer text is a block of its own."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BLOCK_BYTES:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def variant_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, kind) of a line: 0 without word i at place i, 1 as the shorter line, 2 as the longer one."""
    n = len(words)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    i = np.arange(n)
    # what follows word i moves one place down
    without = total[:n] + (total[n] - total[i + 1]) * down[1]
    length = np.uint64(n)
    replaced = mix(mix(without + length) ^ (i.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    longer = np.unique(mix(mix(without + length - np.uint64(1)) + np.uint64(7)))
    whole = mix(mix(total[n : n + 1] + length) + np.uint64(7))
    kinds = np.repeat(np.array([0, 1, 2], dtype=np.int32), [n, 1, len(longer)])
    return np.concatenate([replaced, whole, longer]), kinds


def within_one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the edit distance of two word sequences is at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    if not len(differ):
        return True
    k = int(differ[0])
    if len(a) == len(b):
        return np.array_equal(a[k + 1 :], b[k + 1 :])
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return np.array_equal(longer[k + 1 :], shorter[k:])


def _nested(counts: np.ndarray, fields: list[tuple[str, np.ndarray]]) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(v) for _, v in fields], names=[k for k, _ in fields]))


def _join(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, kind)


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        for first, texts in _blocks(batch.column("_text").to_pylist()):
            part = batch.slice(first, len(texts))
            x = Lines(texts)
            h = x.hashes()
            doc, keys, owners = x.half_keys(h)
            counts = lambda d: np.bincount(d, minlength=len(texts))  # noqa: B023, E731
            lines = _nested(counts(x.doc), [("pos", x.pos.astype(np.int32)), ("h", h.view(np.int64))])
            halves = _nested(counts(doc), [("k", keys.view(np.int64)), ("h", owners.view(np.int64))])
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_th"), pa.array(x.n_lines, pa.int64()), lines, halves], names=["_id", "_th", "n_lines", "lines", "halves"])


def _suspect_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        order, words = [], []
        for t, wanted in zip(batch.column("_text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            lines = (t or "").split("\n")
            for w in wanted:
                order.append(w["ord"])
                words.append(word_hashes(lines[w["pos"]].lower().encode("utf-8", "replace")).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(words, pa.list_(pa.int64()))], names=["ord", "words"])


def _variant_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys, kinds, orders = [], [], []
            for o, w in zip(part.column("ord").to_pylist(), part.column("words"), strict=True):
                k, kind = variant_keys(np.asarray(w.values).view(np.uint64))
                keys.append(k.view(np.int64))
                kinds.append(kind)
                orders.append(np.full(len(k), o, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(_join(keys, np.int64)), pa.array(_join(kinds, np.int32)), pa.array(_join(orders, np.int64))], names=["k", "kind", "ord"])


def _verified_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        ok = [within_one_edit(np.asarray(a.values), np.asarray(b.values)) for a, b in zip(batch.column("words"), batch.column("earlier"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("ord").filter(pa.array(ok, pa.bool_()))], names=["ord"])


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _th, n_lines, removed (numbers of the lines to remove, from 0): one row for each row of docs."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    id_type = dict(keyed.dtypes)["_id"]
    schema = f"_id {id_type}, _th long, n_lines long, lines array<struct<pos: int, h: long>>, halves array<struct<k: long, h: long>>"
    table = stored(keyed.mapInArrow(_line_batches, schema), "lines")

    halves = table.select(F.inline("halves"))
    shared = halves.groupBy("k").agg(F.min("h").alias("least"), F.max("h").alias("most")).filter("least <> most").select("k")
    suspects = halves.join(shared, "k").select(F.col("h").alias("sh")).distinct()

    lines = table.select("_id", "_th", F.explode("lines").alias("line")).select("_id", "_th", "line.pos", "line.h")
    order = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_th"), F.col("pos"))
    firsts = lines.groupBy("h").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    ranked = firsts.join(suspects, F.col("h") == F.col("sh"), "left").filter("n > 1 OR sh IS NOT NULL").orderBy("first")
    ranked = stored(ranked.select("h", "first", (F.col("n") > 1).alias("repeats"), F.col("sh").isNotNull().alias("suspect"), F.monotonically_increasing_id().alias("ord")), "firsts")

    wanted = ranked.filter("suspect").groupBy(F.col("first._id").alias("_wid"), F.col("first._th").alias("_wth")).agg(F.collect_list(F.struct("first.pos", "ord")).alias("wanted"))
    with_text = keyed.join(wanted, keyed["_id"].eqNullSafe(wanted["_wid"]) & (keyed["_th"] == wanted["_wth"])).select("_text", "wanted")
    words = stored(with_text.mapInArrow(_suspect_batches, "ord long, words array<long>").dropDuplicates(["ord"]), "suspects")

    variants = words.mapInArrow(_variant_batches, "k long, kind int, ord long")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("ord")))
    groups = variants.groupBy("k").agg(least(0).alias("m0"), least(1).alias("m1"), least(2).alias("m2"), F.min("ord").alias("low"), F.max("ord").alias("high"))
    met = variants.join(groups.filter("low <> high"), "k")
    earlier = F.when(F.col("kind") == 0, F.col("m0")).when(F.col("kind") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = met.select("ord", earlier.alias("eord")).filter("eord < ord").distinct()
    both = pairs.join(words, "ord").join(words.select(F.col("ord").alias("eord"), F.col("words").alias("earlier")), "eord")
    near = both.select("ord", "words", "earlier").mapInArrow(_verified_batches, "ord long").distinct().select(F.col("ord").alias("nord"))

    marks = ranked.join(near, F.col("ord") == F.col("nord"), "left").filter("repeats OR nord IS NOT NULL")
    marks = marks.select(F.col("h").alias("mh"), "first", F.col("nord").isNotNull().alias("near"))
    later = ~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_th") == F.col("first._th")) & (F.col("pos") == F.col("first.pos")))
    gone = lines.join(marks, F.col("h") == F.col("mh")).filter(F.col("near") | later).groupBy(F.col("_id").alias("_gid"), F.col("_th").alias("_gth"))
    gone = gone.agg(F.array_sort(F.collect_set("pos")).alias("removed"))
    out = table.select("_id", "_th", "n_lines").join(gone, F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left")
    return out.select("_id", "_th", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with the repeated lines taken out of the text; same rows and columns, n_chars renewed."""
    gone = removed_lines(docs, id_col, text_col).filter(F.size("removed") > 0).dropDuplicates(["_id", "_th"])
    gone = gone.select(F.col("_id").alias("__gid"), F.col("_th").alias("__gth"), F.col("removed").alias("__removed"))
    joined = docs.join(gone, key_matches(docs, id_col, text_col, gone, "__gid", "__gth"), "left")
    kept = F.filter(F.split(F.col(f"`{text_col}`"), "\n"), lambda x, i: ~F.array_contains("__removed", i))
    text = F.when(F.col("__removed").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    out = joined.select(*[text.alias(c) if c == text_col else docs[f"`{c}`"] for c in docs.columns])
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(chars_col).isNotNull(), F.length(text_col).cast(docs.schema[chars_col].dataType)))
    return out


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return removed_lines(docs).select(F.col("_id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES: dict[str, str] = {}
