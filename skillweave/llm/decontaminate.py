"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are lower case, without ASCII punctuation. Passages meet items by a join on seeds, in one pass over the corpus. A benchmark of
up to BROADCAST_CHARS characters is the broadcast side of it, as an index of its word hashes; a larger one is a table of seeds,
joined by a shuffle. Both give the same rows.

Alignment: match +1, mismatch and gap -1; a score of at least half the item's words is a leak: a verbatim copy scores 1, a copy
with a fifth of its words replaced about 0.6. Seeds are pairs of words, and an item of m words and least score s needs s - 1 of its
m - 1 places to have theirs in the text. No leak has fewer: its matches less its errors are s or more, errors part the matches
into one run more than there are errors, and a run of r matches has r - 1 pairs. So the rarest m - s + 1 places of an item (by the
documents that have their pairs) hold a pair of every leak, and the shuffled join is by these alone: what is common in the
corpus is a seed only of an item that has nothing rarer. The passage that is aligned reaches half an item's words beyond the item's
place at the hits, further than the gaps of a leak can. What hits by chance goes out by the words that item and text share.

Defined results: null and empty texts leak nothing, items of fewer than four words are compared whole; each (document, item)
is given once with its best score (of equal scores the first passage's place); rows that repeat are given each; null ids are
carried; a text of any length is read whole; empty tables give an empty result; columns of any name may be there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.llm.common import gram_hashes, key_filter, key_matches, may_hold, small, stored, with_key, word_hashes

SEED_WORDS = 2
MIN_SCORE = 0.5
#: Items of fewer words are one seed.
WHOLE_WORDS = 4
#: Characters of a benchmark that is broadcast (8 bytes a word, and 24 a seed).
BROADCAST_CHARS = 4_000_000
#: Bits of the filter of a larger benchmark's seeds.
SEED_BITS = 27
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def passage_words(text: str | None) -> np.ndarray:
    return word_hashes((text or "").lower().encode("utf-8", "replace").translate(None, _PUNCTUATION))


def seed_length(n_words: int) -> int:
    return SEED_WORDS if n_words >= WHOLE_WORDS else n_words


def item_grams(words: np.ndarray) -> np.ndarray:
    return gram_hashes(words, seed_length(len(words))) if len(words) else np.empty(0, np.uint64)


def places_needed(n_words: int) -> int:
    """How many places of an item have to have their seed in a text that leaks it."""
    return max(1, int(np.ceil(MIN_SCORE * n_words)) - 1)


def smith_waterman(item: np.ndarray, window: np.ndarray) -> int:
    """Best local score of two sequences of word hashes: match +1, mismatch and gap -1."""
    steps = np.arange(len(window) + 1, dtype=np.int64)
    row = np.zeros(len(window) + 1, dtype=np.int64)
    best = 0
    for word in item:
        new = np.maximum(row - 1, 0)
        np.maximum(new[1:], row[:-1] + np.where(window == word, 1, -1), out=new[1:])
        row = np.maximum.accumulate(new + steps) - steps
        best = max(best, int(row.max()))
    return best


def _ranges(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all entries of a sorted array that equal each wanted one, in turn, and how many each has."""
    low, high = np.searchsorted(ordered, wanted, "left"), np.searchsorted(ordered, wanted, "right")
    counts = high - low
    return np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts), counts


def _shared(item: np.ndarray, ordered: np.ndarray) -> int:
    """Words of the item that are among the sorted ones."""
    at = np.minimum(np.searchsorted(ordered, item), len(ordered) - 1)
    return int(np.count_nonzero(ordered[at] == item)) if len(ordered) else 0


class Block:
    """Items of one block as arrays: their words, and the sorted seeds with the (item, position) pairs of each."""

    def __init__(self, items: list[np.ndarray], grams: np.ndarray, owner: np.ndarray, position: np.ndarray):
        order = np.argsort(grams, kind="stable")
        self.items = items
        self.grams, self.owner, self.position = grams[order], owner[order], position[order]
        self.lengths = sorted({seed_length(len(w)) for w in items if len(w)})
        self.needed = np.array([places_needed(len(w)) for w in items], int)

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in words and grams where a gram of this block starts."""
        where, found = [], []
        for n in self.lengths:
            g = gram_hashes(words, n)
            at = np.searchsorted(self.grams, g)
            at[at == len(self.grams)] = 0
            hit = np.flatnonzero(self.grams[at] == g) if len(self.grams) else np.empty(0, int)
            where.append(hit)
            found.append(g[hit])
        return (np.concatenate(where), np.concatenate(found)) if where else (np.empty(0, int), np.empty(0, np.uint64))

    def likely(self, words: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """For each item, whether these distinct grams hit as many of its places as a leak does and the words hold enough of its
        words for MIN_SCORE (a score is at most the number of matches)."""
        hits = np.bincount(self.owner[_ranges(self.grams, grams)[0]], minlength=len(self.items))
        out, own = hits >= self.needed, np.unique(words)
        for k in np.flatnonzero(out):
            out[k] = _shared(self.items[k], own) >= MIN_SCORE * len(self.items[k])
        return out

    def leaks(self, words: np.ndarray, cache: dict) -> Iterator[tuple[int, float, int]]:
        """(item, score, first word of the passage) of each item that these words leak."""
        where, grams = self.known(words)
        if not len(where):
            return
        likely = self.likely(words, np.unique(grams))
        if not likely.any():
            return
        keep = likely[self.owner]
        sorted_grams, owner, position = self.grams[keep], self.owner[keep], self.position[keep]
        at, counts = _ranges(sorted_grams, grams)
        starts = np.repeat(where, counts) - position[at]
        owners = owner[at]
        order = np.lexsort((starts, owners))
        owners, starts, at = owners[order], starts[order], at[order]
        edges = np.flatnonzero(np.diff(owners)) + 1
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(owners)], strict=True):
            k = int(owners[lo])
            item = self.items[k]
            slack = max(4, len(item) // 2)
            s = starts[lo:hi]
            cuts = np.flatnonzero(np.diff(s) > slack) + 1
            best, first = 0, 0
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, hi - lo], strict=True):
                if len(np.unique(at[lo + a : lo + b])) < self.needed[k]:
                    continue
                begin, end = max(0, int(s[a]) - slack), int(s[b - 1]) + len(item) + slack
                window = words[begin:end]
                if _shared(item, np.unique(window)) < MIN_SCORE * len(item):
                    continue
                name = (k, window.tobytes())
                score = cache.get(name)
                if score is None:
                    if len(cache) >= 2000:
                        cache.clear()
                    score = cache[name] = smith_waterman(item, window)
                if score > best:
                    best, first = score, begin
            if best >= MIN_SCORE * len(item):
                yield k, best / len(item), first


def block_of(texts: list[str | None]) -> Block:
    words = [passage_words(t) for t in texts]
    grams = [item_grams(w) for w in words]
    owner = np.repeat(np.arange(len(words)), [len(g) for g in grams])
    position = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, int)
    return Block(words, np.concatenate(grams) if grams else np.empty(0, np.uint64), owner, position)


def _leak_batches(block) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, cache = block.value, {}
        for batch in small(batches):
            rows, item, score, first = [], [], [], []
            for r, t in enumerate(batch.column("_text").to_pylist()):
                for k, s, at in b.leaks(passage_words(t), cache):
                    rows.append(r)
                    item.append(k)
                    score.append(s)
                    first.append(at)
            take = pa.array(rows, pa.int64())
            columns = [batch.column("_id").take(take), batch.column("_th").take(take), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(first, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_th", "_item", "score", "first_word"])

    return run


def _broadcast_leaks(keyed: DataFrame, items: DataFrame) -> DataFrame:
    spark = keyed.sparkSession
    rows = items.collect()
    block = spark.sparkContext.broadcast(block_of([r.text for r in rows]))
    found = keyed.mapInArrow(_leak_batches(block), f"_id {dict(keyed.dtypes)['_id']}, _th long, _item long, score double, first_word long")
    names = spark.createDataFrame([(k, r.item) for k, r in enumerate(rows)], T.StructType([T.StructField("_item", T.LongType()), T.StructField("item_id", items.schema["item"].dataType)]))
    return found.join(F.broadcast(names), "_item").select("_id", "_th", "item_id", "score", "first_word")


def _seed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seed of each place of each item, how many of its rarest places suffice, and the words of a seed."""
    for batch in small(batches):
        keys, grams, places, enough, length = [], [], [], [], []
        for k, t in zip(batch.column("_item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            w = passage_words(t)
            g = item_grams(w).view(np.int64).tolist()
            keys += [k] * len(g)
            grams += g
            places += range(len(g))
            enough += [len(g) - places_needed(len(w)) + 1] * len(g)
            length += [seed_length(len(w))] * len(g)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(grams, pa.int64()), *[pa.array(x, pa.int32()) for x in (places, enough, length)]], names=["_item", "k", "place", "enough", "length"])


def _gram_batches(lengths: list[int], known) -> callable:
    """Distinct n-grams of each text that may be seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = []
            for t in batch.column("_text").to_pylist():
                words = passage_words(t)
                g = np.unique(np.concatenate([gram_hashes(words, n) for n in lengths])) if lengths else np.empty(0, np.uint64)
                found.append(g[may_hold(known.value, g)].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), pa.array(found, pa.list_(pa.int64()))], names=["_id", "_th", "grams"])

    return run


def _aligned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alignment of each (text, item) pair."""
    for batch in small(batches, 100):
        rows, score, first = [], [], []
        for r, (t, item) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("text").to_pylist(), strict=True)):
            for _, s, at in block_of([item]).leaks(passage_words(t), {}):
                rows.append(r)
                score.append(s)
                first.append(at)
        take = pa.array(rows, pa.int64())
        kept = [batch.column(c).take(take) for c in ("_id", "_th", "item_id")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()), pa.array(first, pa.int64())], names=["_id", "_th", "item_id", "score", "first_word"])


def _joined_leaks(keyed: DataFrame, items: DataFrame) -> DataFrame:
    id_type, item_type = dict(keyed.dtypes)["_id"], dict(items.dtypes)["item"]
    named = stored(items.withColumn("_item", F.monotonically_increasing_id()), "benchmark")
    seeds = stored(named.select("_item", "text").mapInArrow(_seed_batches, "_item long, k long, place int, enough int, length int"), "seeds")
    lengths = [r.length for r in seeds.select("length").distinct().collect()]  # 1 to 3
    known = keyed.sparkSession.sparkContext.broadcast(key_filter(seeds, SEED_BITS))
    grams = stored(keyed.mapInArrow(_gram_batches(lengths, known), f"_id {id_type}, _th long, grams array<long>").distinct(), "grams")
    grams = grams.select("_id", "_th", F.explode("grams").alias("k"))
    often = grams.groupBy("k").agg(F.count(F.lit(1)).alias("often"))
    ranked = seeds.join(often, "k").withColumn("rank", F.row_number().over(W.partitionBy("_item").orderBy("often", "k", "place")))
    # places that no document has come first, though they have no row here
    absent = seeds.groupBy("_item").agg(F.count(F.lit(1)).alias("places")).join(ranked.groupBy("_item").agg(F.count(F.lit(1)).alias("met")), "_item").select("_item", (F.col("places") - F.col("met")).alias("absent"))
    rare = ranked.join(absent, "_item").filter(F.col("rank") <= F.col("enough") - F.col("absent")).select("k", "_item").distinct()
    hits = grams.join(rare, "k").select("_id", "_th", "_item").distinct()
    hits = hits.select(F.col("_id").alias("_hid"), F.col("_th").alias("_hth"), "_item")
    pairs = keyed.join(hits, keyed["_id"].eqNullSafe(hits["_hid"]) & (keyed["_th"] == hits["_hth"])).join(named, "_item")
    return pairs.select("_id", "_th", F.col("item").alias("item_id"), "_text", "text").mapInArrow(_aligned_batches, f"_id {id_type}, _th long, item_id {item_type}, score double, first_word long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """_id, _th, item_id, score, first_word: each item that each row of docs leaks."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return (_broadcast_leaks if chars <= BROADCAST_CHARS else _joined_leaks)(keyed, items)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that leak a benchmark item."""
    bad = find_leaks(docs, benchmark, id_col, text_col).select(F.col("_id").alias("__bid"), F.col("_th").alias("__bth")).distinct()
    return docs.join(bad, key_matches(docs, id_col, text_col, bad, "__bid", "__bth"), "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("_id").alias("doc_id"), "item_id", "score", "first_word")


QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES: dict[str, str] = {}
