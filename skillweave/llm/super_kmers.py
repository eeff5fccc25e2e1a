"""Substring dedup of word windows by super-k-mer partitioning.

A word is removed when a window of WINDOW words that covers it also starts earlier: in a document of a smaller id, or earlier
in the same document. Windows are judged on the input.

1. Runs: a window's minimiser is the least hash among its strings of MINIMISER words (the leftmost of equals). Consecutive
   windows that share it are a run. Equal windows have equal minimisers, so a minimiser of one run holds nothing that repeats.
2. The other runs travel as one packed string each, the words of all their windows, to the bucket of their minimiser. Equal
   strings of a batch of documents travel once, with the list of their places.
3. A bucket sorts all windows of its strings; neighbours in that order are compared word by word, so hashes only speed the
   sort. A window's earliest place is the least over its strings; its other places are removed.
4. The strings of a minimiser of more than HOT_RUNS runs are not gathered. Equal ones are met by partial aggregation, which
   leaves one of each, the earliest; these are cut again by the longest minimiser there is, the whole window, so each window
   is a string of its own and meets its equals in the same way.

Defined results: a null or empty text has no words; texts shorter than a window lose nothing; a null id is smaller than all
others; rows of the same id are one document, so among them only the earlier start counts, and rows that repeat exactly
(id and text) lose the same words; a text of any length is cut by blocks of words, it only has to fit in a row; other columns
of docs are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import drop_folder, gram_hashes, mix, small, stored_at, with_key, word_hashes

WINDOW = 20
MINIMISER = 8
#: Runs of a minimiser beyond which its windows travel one by one.
HOT_RUNS = 10_000
#: Strings of a bucket, about.
BUCKET_STRINGS = 20_000
#: Texts, words and places that are held as numbers or objects at a time.
SLICE_TEXTS, BLOCK_WORDS, MAX_PLACES = 250, 1 << 18, 10_000
#: A run has at most this many windows.
WIDTH = WINDOW - MINIMISER + 1
_LOW = np.uint64(0xFFFFFFFF)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(m[:n], m[width - size : width - size + n])


class Words:
    """The words of some texts, joined by single blanks: where each starts (and one past the last), and how many each text has."""

    def __init__(self, texts: list[str | None]):
        words = [(t or "").encode("utf-8", "replace").split() for t in texts]
        self.counts = np.array([len(w) for w in words], dtype=np.int64)
        self.before = np.cumsum(self.counts) - self.counts
        self.data = b" ".join([b" ".join(w) for w in words if w])
        at = np.flatnonzero(np.frombuffer(self.data, dtype=np.uint8) == 32) + 1
        self.starts = np.r_[0, at, len(self.data) + 1] if self.data else np.zeros(1, dtype=np.int64)

    def string(self, first: int, words: int) -> bytes:
        return self.data[self.starts[first] : self.starts[first + words] - 1]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Minimiser, first window and number of windows of each run, by blocks of words."""
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        found = []
        for low in range(0, max(0, len(doc) - WINDOW + 1), BLOCK_WORDS):
            high = min(low + BLOCK_WORDS + WINDOW - 1, len(doc))
            g = gram_hashes(word_hashes(self.data[self.starts[low] : self.starts[high] - 1]), MINIMISER)
            # ordered by the upper half of the hash, then by place
            place = _sliding_min((g & ~_LOW) | np.arange(len(g), dtype=np.uint64), WIDTH) & _LOW
            own = doc[low : high - WINDOW + 1] == doc[low + WINDOW - 1 : high]
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (own[1:] != own[:-1])])
            count = np.diff(np.r_[first, len(place)])
            keep = own[first]
            found.append((g[place[first[keep]].astype(np.int64)].view(np.int64), low + first[keep], count[keep]))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text: minimiser, and first window and number of windows in one number."""
    for batch in small(batches, SLICE_TEXTS):
        w = Words(batch.column("_text").to_pylist())
        value, first, count = w.runs()
        doc = np.searchsorted(w.before + w.counts, first, side="right")
        place = (first - w.before[doc]) << 5 | count
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=len(w.counts)))].astype(np.int32))
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(value), pa.array(place)], names=["m", "place"]))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), runs], names=["_id", "_th", "runs"])


def _string_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs the wanted runs: each different string of a batch with all its places, earliest first; m is null for hot runs."""
    for batch in batches:
        found: dict[tuple[bytes, int, int | None], list[tuple[int, int]]] = {}
        for at in range(0, batch.num_rows, SLICE_TEXTS):
            part = batch.slice(at, SLICE_TEXTS)
            w = Words(part.column("_text").to_pylist())
            for k, (before, wanted) in enumerate(zip(w.before.tolist(), part.column("wanted").to_pylist(), strict=True)):
                for x in wanted:
                    first, words = x["place"] >> 5, (x["place"] & 31) + WINDOW - 1
                    key = (w.string(before + first, words), words, None if x["hot"] else x["m"])
                    found.setdefault(key, []).append((at + k, first))
        ids = batch.column("_id").to_pylist()
        rank = {i: r for r, i in enumerate(sorted({i for i in ids if i is not None}))}
        order = [rank.get(i, -1) for i in ids]
        strings, places = [], []
        for key, at in found.items():
            at.sort(key=lambda x: (order[x[0]], x[1]))
            for low in range(0, len(at), MAX_PLACES):
                strings.append(key)
                places.append(at[low : low + MAX_PLACES])
        flat = [x for at in places for x in at]
        row = pa.array([x[0] for x in flat], pa.int64())
        fields = [batch.column("_id").take(row), batch.column("_th").take(row), pa.array([x[1] for x in flat], pa.int64())]
        offsets = pa.array(np.cumsum([0, *map(len, places)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["id", "th", "first"]))
        columns = [pa.array([x[k] for x in strings], kind) for k, kind in ((2, pa.int64()), (0, pa.binary()), (1, pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, lists], names=["m", "string", "words", "places"])


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the strings as a string of its own, with its place."""
    for batch in small(batches):
        windows, row, first = [], [], []
        for k, (string, at) in enumerate(zip(batch.column("string").to_pylist(), batch.column("first").to_pylist(), strict=True)):
            words = string.split(b" ")
            for j in range(len(words) - WINDOW + 1):
                windows.append(b" ".join(words[j : j + WINDOW]))
                row.append(k)
                first.append(at + j)
        take = pa.array(row, pa.int64())
        places = pa.StructArray.from_arrays([batch.column("id").take(take), batch.column("th").take(take), pa.array(first, pa.int64())], names=["id", "th", "first"])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32)), places)
        yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(np.full(len(row), WINDOW)), lists], names=["string", "words", "places"])


def window_groups(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows that start at the given places of a sequence of word numbers, in which equal windows are
    neighbours, and whether each equals the one before it."""
    values = gram_hashes(mix(ids.astype(np.uint64) + np.uint64(1)), WINDOW)[at]
    order = np.argsort(values, kind="stable")
    alike = values[order[1:]] == values[order[:-1]]
    left, right = at[order[:-1][alike]], at[order[1:][alike]]
    if all(bool((ids[left + k] == ids[right + k]).all()) for k in range(WINDOW)):
        return order, np.r_[False, alike][: len(at)]
    # different windows of one hash: by all words
    order = np.lexsort([ids[at + k] for k in range(WINDOW)])
    same = np.ones(max(len(at) - 1, 0), dtype=bool)
    for k in range(WINDOW):
        same &= ids[at[order[1:]] + k] == ids[at[order[:-1]] + k]
    return order, np.r_[False, same]


def _ranks(ids: pa.Array) -> np.ndarray:
    """Place of each id in the order of ids; null is first."""
    known = pc.unique(ids).drop_null()
    known = known.take(pc.sort_indices(known))
    return pc.fill_null(pc.add(pc.index_in(ids, value_set=known), 1), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _later_windows(rows: pa.Table) -> pa.Table:
    """Word ranges of a bucket's places whose windows also start earlier."""
    rows = rows.combine_chunks()
    strings = rows.column("string").to_pylist()
    lists = rows.column("places").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    words = pa.array(b" ".join(strings).split(b" "), pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    size = np.array([s.count(b" ") + 1 for s in strings], dtype=np.int64)
    count = size - WINDOW + 1
    base = np.cumsum(count) - count
    j = np.arange(count.sum()) - np.repeat(base, count)
    order, same = window_groups(words, np.repeat(np.cumsum(size) - size, count) + j)
    # earliest place of each string, then of each window
    places = lists.flatten()
    first = places.field("first").to_numpy(zero_copy_only=False)
    key = (_ranks(places.field("id")) << 32) + first
    sizes = np.diff(lists.offsets.to_numpy())
    earliest = np.minimum.reduceat(key, np.cumsum(sizes) - sizes)
    window = (np.repeat(earliest, count) + j)[order]
    heads = np.flatnonzero(~same)
    least = np.empty(len(window), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(window, heads), np.diff(np.r_[heads, len(window)]))
    # all windows of all places
    string = np.repeat(np.arange(len(strings)), sizes)
    many = count[string]
    place = np.repeat(np.arange(len(key)), many)
    j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    later = key[place] + j > least[base[string][place] + j]
    begins = np.flatnonzero(later & np.r_[True, ~later[:-1] | (j[1:] == 0)])
    ends = np.flatnonzero(later & np.r_[~later[1:] | (j[1:] == 0), True])
    take = pa.array(place[begins])
    return pa.table({"_id": places.field("id").take(take), "_th": places.field("th").take(take), "a": first[place[begins]] + j[begins], "b": first[place[begins]] + j[ends] + WINDOW})


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _th, spans (array of a, b): ranges of words covered by windows that also start earlier; ranges may overlap."""
    spark = docs.sparkSession
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    id_type = dict(keyed.dtypes)["_id"]
    table, runs_at = stored_at(keyed.mapInArrow(_run_batches, f"_id {id_type}, _th long, runs array<struct<m: long, place: long>>").filter(F.size("runs") > 0), "window-runs")
    runs = table.select("_id", "_th", F.inline("runs"))
    shared = runs.groupBy("m").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("m").alias("gm"), (F.col("n") > HOT_RUNS).alias("hot"))
    # a table, so that a minimiser of very many runs can be split in the join
    shared, shared_at = stored_at(shared, "shared-minimisers")
    wanted = runs.join(shared, F.col("m") == F.col("gm")).groupBy(F.col("_id").alias("_wid"), F.col("_th").alias("_wth")).agg(F.collect_set(F.struct("m", "place", "hot")).alias("wanted"))
    texts = keyed.join(wanted, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_th") == F.col("_wth"))).select("_id", "_th", "_text", "wanted")
    strings, strings_at = stored_at(texts.mapInArrow(_string_batches, f"m long, string binary, words long, places array<struct<id: {id_type}, th: long, first: long>>"), "super-kmers")
    drop_folder(spark, runs_at)
    drop_folder(spark, shared_at)

    cold = strings.filter("m IS NOT NULL")
    buckets = max(1, cold.count() // BUCKET_STRINGS)
    cold = cold.withColumn("bucket", F.pmod(F.xxhash64("m"), F.lit(buckets)))
    spans = cold.groupBy("bucket").applyInArrow(_later_windows, f"_id {id_type}, _th long, a long, b long")

    place = lambda x: F.struct(x["id"].isNotNull().alias("known"), x["id"].alias("id"), x["first"].alias("first"))

    def with_least(df: DataFrame) -> DataFrame:
        """Strings with the earliest place of all their equals; the first of a row's places is its earliest."""
        least = df.groupBy(F.col("string").alias("_string")).agg(F.min(place(F.col("places")[0])).alias("least"))
        return df.join(least, F.col("string") == F.col("_string")).drop("_string")

    found = f"_id {id_type}, _th long, spans array<struct<a: long, b: long>>"
    hot, hot_at = stored_at(with_least(strings.filter("m IS NULL")), "hot-strings")
    firsts = hot.select("string", F.explode(F.filter("places", lambda x: place(x) == F.col("least"))).alias("p")).select("string", "p.*")
    windows = firsts.mapInArrow(_window_batches, f"string binary, words long, places array<struct<id: {id_type}, th: long, first: long>>")
    spans = spans.select("_id", "_th", F.array(F.struct("a", "b")).alias("spans"))
    for each in (hot, with_least(windows)):
        spans = spans.unionByName(each.mapInArrow(_later_places, found))
    spans = stored_at(spans, "later-windows")[0]
    drop_folder(spark, strings_at)
    drop_folder(spark, hot_at)
    return spans


def _later_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of words of all places behind their string's earliest, one row for a document of a batch."""
    for batch in small(batches, 500):
        found: dict[tuple, list[list[int]]] = {}
        for words, places, least in zip(batch.column("words").to_pylist(), batch.column("places").to_pylist(), batch.column("least").to_pylist(), strict=True):
            first = (least["known"], least["id"], least["first"])
            for x in places:
                # ids are only compared where both are known
                at = (x["id"] is not None, x["id"], x["first"])
                if at[:2] != first[:2] or at[2] > first[2]:
                    found.setdefault((x["id"], x["th"]), []).append([x["first"], x["first"] + words])
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        spans = pa.array([[{"a": a, "b": b} for a, b in _merged(x)] for x in found.values()], kind)
        id_type = batch.column("places").type.value_type.field("id").type
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], id_type), pa.array([x[1] for x in found], pa.int64()), spans], names=["_id", "_th", "spans"])


def _merged(spans: list) -> list[list[int]]:
    """Ranges in order, joined where they touch."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, SLICE_TEXTS):
        size, removed, kept, cut = [], [], [], []
        for t, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = (t or "").encode("utf-8", "replace").split()
            size.append(len(words))
            merged = _merged([(x["a"], x["b"]) for x in spans or ()])
            if merged:
                keep = np.ones(len(words), dtype=bool)
                for a, b in merged:
                    keep[a:b] = False
                words = list(compress(words, keep.tolist()))
            removed.append(size[-1] - len(words))
            kept.append(b" ".join(words))
            cut.append([{"a": a, "b": b} for a, b in merged])
        columns = [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *columns, pa.array(cut, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["_id", "n_words", "n_removed", "kept", "spans"]
        )


def remove_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, n_words, n_removed, kept (the words left, joined by one blank), spans (maximal removed ranges of words) of each row."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    spans = repeated_spans(docs, id_col, text_col)
    spans = spans.groupBy(F.col("_id").alias("_sid"), F.col("_th").alias("_sth")).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    both = keyed.join(spans, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left").select("_id", "_text", "spans")
    return both.mapInArrow(_cut_batches, f"_id {dict(keyed.dtypes)['_id']}, n_words long, n_removed long, kept string, spans array<struct<a: long, b: long>>")


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_windows(docs).select(F.col("_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op11_super_kmers": op11_super_kmers}
#: Windows of words over whole texts are too slow in SQL; tests/llm/test_super_kmers.py holds the query against brute force.
ORACLES: dict[str, str] = {}
