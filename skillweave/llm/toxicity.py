"""Toxicity by class-conditional Kneser-Ney bigram models.

Two models, of toxic and of ordinary documents, are counted from all labelled rows outside the held-out fold (crc32 of the
id as text, mod 5, is 0) and outside the calibration fold (4). A bigram counts once for a document. A word counts by
continuation: the different words (or the start) that it follows in a class. Counts are discounted; the mass that a class
gives up, and a prior of STRENGTH times the smaller class, go to backoff counts that both classes share: of words, the pooled
continuation counts, and of bigrams, the pooled bigram moved by the class's word model. So an expression that is rare in both
classes, or unseen, says nothing. A document's figures are the differences of its two length-normalised log-likelihoods: over
all words, and over the TOP_SHARE of its words where they are largest (a long text that is toxic in a few lines). They are
compared by a logistic curve, fitted on a sample of the calibration fold (by hash of id and text), which gives the score.

The model is a table of every word and bigram in at least MIN_COUNT documents, whatever their number. The most frequent
HEAD_NGRAMS are broadcast, with a bit filter of fixed size that holds all others; what a document has of those is joined to
the table by key. So the head decides where an n-gram is looked up, never whether. The label, language, source and id are no
inputs of a score (the id only names rows).

Defined results: null and empty texts have no words and get the curve's value at 0; a document with several labels is toxic
if one says so; unlabelled and null-id rows are scored all the same; with no toxic or no ordinary training row every score
is the share of toxic rows (0 without any); rows that repeat are each scored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import bounded_batches, gram_hashes, key_filter, may_hold, mix, small, stored, word_hashes
from skillweave.llm.decontaminate import _PUNCTUATION

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
MIN_COUNT = 2
MAX_CALIBRATION_ROWS = 20_000
#: Labels up to this number of rows (16 bytes each) are broadcast to the texts; more are joined by a shuffle.
MAX_BROADCAST_LABELS = 2_000_000
DISCOUNT = 0.75
#: Stands before a text's first word.
START = 0
STRENGTH = 5.0
TOP_SHARE = 0.02
#: N-grams that are broadcast (16 bytes each), the most frequent; the others are joined, with the same scores.
HEAD_NGRAMS = 4_000_000
#: Bits of the filter of the others.
FILTER_BITS = 27


def fold(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def words_of(text: str | None) -> np.ndarray:
    return word_hashes((text or "").lower().encode("utf-8", "replace").translate(None, _PUNCTUATION))


def labels_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """_lid, _toxic, _fold of the labelled ids outside the held-out fold."""
    each = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_lid"))
    each = each.agg(F.max(F.col(label_col).cast("int")).alias("_toxic")).withColumn("_fold", fold(F.col("_lid"))).filter(F.col("_fold") != HELD_OUT)
    return F.broadcast(each) if each.count() <= MAX_BROADCAST_LABELS else each


def word_keys(words: np.ndarray) -> np.ndarray:
    return mix(words + np.uint64(1))


def bigram_keys(words: np.ndarray) -> np.ndarray:
    return gram_hashes(words, 2)


def distinct_bigrams(words: np.ndarray) -> np.ndarray:
    """The distinct (word, next word) of a text as an array of two columns; START comes before the first word."""
    words = np.r_[np.full(min(len(words), 1), START, np.uint64), words]
    first = np.unique(bigram_keys(words), return_index=True)[1]
    return np.column_stack([words[first], words[first + 1]]) if len(first) else np.empty((0, 2), np.uint64)


def _summed(keys: np.ndarray, toxic: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Occurrences of each key (a row of one or two columns) by class, in the order of keys."""
    order = np.lexsort(keys.T[::-1])
    keys, toxic = keys[order], toxic[order]
    heads = np.flatnonzero(np.r_[len(keys) > 0, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.empty(0, int)
    n = np.diff(np.r_[heads, len(keys)])
    t = np.add.reduceat(toxic, heads) if len(heads) else np.empty(0, np.int64)
    columns = [pa.array(np.ascontiguousarray(keys[heads, c]).view(np.int64)) for c in range(len(names))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(t.astype(np.int64)), pa.array((n - t).astype(np.int64))], names=[*names, "t", "o"])


def _count(rows: DataFrame, keys_of, names: list[str]) -> DataFrame:
    """names, t, o: occurrences of each key in toxic and in ordinary texts; summed in each batch before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [keys_of(words_of(t)).reshape(-1, len(names)) for part in small([batch]) for t in part.column("_text").to_pylist()]
            toxic = np.repeat(batch.column("_toxic").to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in found])
            yield _summed(np.concatenate(found) if found else np.empty((0, len(names)), np.uint64), toxic, names)

    schema = ", ".join(f"{c} long" for c in [*names, "t", "o"])
    return rows.mapInArrow(run, schema).groupBy(*names).agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _keyed(table: DataFrame, names: list[str]) -> DataFrame:
    """k, v, n: the key of each word (b) or bigram (a, b) as `word_keys` and `bigram_keys` give it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(c).to_numpy().view(np.uint64) for c in names]
            k = word_keys(x[0]) if len(x) == 1 else bigram_keys(np.column_stack(x).ravel())[::2]
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), batch.column("v"), batch.column("n")], names=["k", "v", "n"])

    return table.select(*names, "v", "n").mapInArrow(run, "k long, v double, n long")


def fit_model(rows: DataFrame) -> DataFrame:
    """k, v, n: the log-likelihood difference of each word and bigram in MIN_COUNT documents, and how often it counts (a bigram
    once for a document, a word by its bigrams); only totals come to the driver."""
    pairs = stored(_count(rows, distinct_bigrams, ["a", "b"]), "toxicity-pairs")
    words = pairs.groupBy("b").agg(F.sum(F.col("t") + F.col("o")).alias("n"), *[F.count_if(F.col(c) > 0).alias(c) for c in "to"])
    words = stored(words.filter(F.col("n") >= MIN_COUNT), "toxicity-words")
    total = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "to"], *[F.count_if(F.col(c) > 0).alias(f"{c}1") for c in "to"]).first()
    prior = STRENGTH * min(total.t, total.o)
    shared = (F.col("t") + F.col("o")) / F.lit(float(max(total.t + total.o, 1)))
    for c in "to":
        ratio = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / shared + F.lit(DISCOUNT * total[f"{c}1"] + prior)) / F.lit(max(total[c] + prior, 1e-9))
        words = words.withColumn(f"r{c}", F.greatest(ratio, F.lit(1e-12)))
    words = words.select("b", "rt", "ro", "n", (F.log("rt") - F.log("ro")).alias("v"))

    pairs = pairs.filter(F.col("a") != START)
    common = F.col("t") + F.col("o") >= MIN_COUNT
    context = pairs.groupBy("a").agg(*[F.sum(c).alias(f"{c}n") for c in "to"], *[F.count_if(F.col(c) > 0).alias(f"{c}1") for c in "to"])
    seen = pairs.filter(common).join(context, "a").join(words.drop("v", "n"), "b")
    expected = (F.col("t") + F.col("o")) / (F.col("tn") + F.col("on"))
    prior = STRENGTH * F.least("tn", "on") + 1.0
    p = {c: (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + (DISCOUNT * F.col(f"{c}1") + prior) * expected * F.col(f"r{c}")) / (F.col(f"{c}n") + prior) for c in "to"}
    seen = seen.select("a", "b", (F.col("t") + F.col("o")).alias("n"), (F.log(p["t"]) - F.log(p["o"])).alias("v"))
    return stored(_keyed(words, ["b"]).unionByName(_keyed(seen, ["a", "b"])), "toxicity-model")


def _head_cut(model: DataFrame, most: int) -> int:
    """The count from which n-grams are in the head, found on the counts of counts."""
    total, cut = 0, 0
    for r in sorted(model.groupBy("n").count().collect(), key=lambda r: -r.n):
        total += r["count"]
        if total > most:
            return r.n + 1
    return cut


class Head:
    """The frequent part of the model, and the filter of the rest (None if there is no rest)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, others: np.ndarray | None):
        order = np.argsort(keys)
        self.keys, self.values, self.others = keys[order], values[order], others

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each key, whether it is here, its value (or 0), and whether it may be in the rest."""
        here, value = np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            here = self.keys[at] == keys
            value = np.where(here, self.values[at], 0.0)
        if self.others is None:
            return here, value, np.zeros(len(keys), dtype=bool)
        return here, value, ~here & may_hold(self.others, keys)

    def read(self, words: np.ndarray) -> tuple:
        """What is known of a text: words, sum and top of the values that are certain; of each open place (one whose bigram,
        or whose word without a known bigram, may be in the rest) its value so far; and the places, levels (1 word, 2 bigram)
        and keys to ask for."""
        n = len(words)
        k1, k2 = word_keys(words), np.r_[np.zeros(min(n, 1), np.uint64), bigram_keys(words)]
        _, each, open1 = self.find(k1)
        here, value, open2 = self.find(k2)
        here[:1] = open2[:1] = False
        each = np.where(here, value, each)
        open1 &= ~here
        places = np.flatnonzero(open1 | open2)
        sure = np.delete(each, places)
        top = max(1, int(n * TOP_SHARE))
        sure_top = np.partition(sure, -top)[-top:] if len(sure) > top else sure
        one, two = np.flatnonzero(open1), np.flatnonzero(open2)
        level = np.repeat(np.array([1, 2], dtype=np.int32), [len(one), len(two)])
        return n, float(sure.sum()), sure_top, places, each[places], np.r_[one, two], level, np.r_[k1[one], k2[two]].view(np.int64)


def _lists(arrays: list[np.ndarray], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of lists laid end to end."""
    return np.cumsum([0, *map(len, arrays)]).astype(np.int32), np.concatenate(arrays).astype(kind) if arrays else np.empty(0, kind)


def closed(n: int, total: float, top: list[float], places: list[int], values: list[float], found: list[dict] | None) -> tuple[float, float]:
    """Mean log-likelihood difference over all words and over the most toxic share of them; zeros for no words. Of an open
    place the bigram's value counts if it was found, else the word's, else the value so far."""
    if not n:
        return 0.0, 0.0
    known = dict(zip(places, values, strict=True))
    known |= {x["p"]: x["v"] for x in sorted(found or [], key=lambda x: x["level"])}
    late = np.array(list(known.values()))
    top, share = np.concatenate([top, late]), max(1, int(n * TOP_SHARE))
    return (total + float(late.sum())) / n, float(np.sort(top)[-share:].mean())


_READ = ["n", "sum", "top", "places", "values", "asked"]
_READ_SCHEMA = "n long, sum double, top array<double>, places array<int>, values array<double>, asked array<struct<p: int, level: int, k: long>>"


def figures(docs: DataFrame, model: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _s, _all, _top of each row of docs; _s is a hash of id and text."""
    spark = docs.sparkSession
    cut = _head_cut(model, HEAD_NGRAMS)
    head = model.filter(F.col("n") >= cut).select("k", "v").toArrow()
    rest = model.filter(F.col("n") < cut).select("k", "v")
    shared = spark.sparkContext.broadcast(Head(head.column("k").to_numpy().view(np.uint64), head.column("v").to_numpy(), key_filter(rest, FILTER_BITS) if cut else None))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = shared.value
        for batch in small(batches):
            rows = [h.read(words_of(t)) for t in batch.column("_text").to_pylist()]
            part = list(zip(*rows, strict=True)) or [[]] * 8
            columns = [pa.array(part[0], pa.int64()), pa.array(part[1], pa.float64())]
            for arrays, kind in zip(part[2:5], (np.float64, np.int32, np.float64), strict=True):
                columns.append(pa.ListArray.from_arrays(*_lists(arrays, kind)))
            (offsets, p), (_, level), (_, k) = (_lists(x, kind) for x, kind in zip(part[5:], (np.int32, np.int32, np.int64), strict=True))
            columns.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(p), pa.array(level), pa.array(k)], names=["p", "level", "k"])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keys], *columns], names=[*keys, *_READ])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [closed(*x) for x in zip(*[batch.column(c).to_pylist() for c in ("n", "sum", "top", "places", "values", "found")], strict=True)]
            columns = [pa.array([x[c] for x in found], pa.float64()) for c in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_s"), *columns], names=["_id", "_s", "_all", "_top"])

    keys = ["_id", "_s", "_th"]
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).withColumns({"_s": F.xxhash64("_id", "_text"), "_th": F.xxhash64("_text")})
    id_type = dict(base.dtypes)["_id"]
    base = stored(base.mapInArrow(read, f"_id {id_type}, _s long, _th long, {_READ_SCHEMA}"), "toxicity-read")
    asked = base.filter(F.size("asked") > 0).select("_s", "_th", F.explode("asked").alias("x")).select("_s", "_th", "x.*")
    # rows that repeat exactly ask the same and share what is found
    found = asked.join(rest, "k").groupBy("_s", "_th").agg(F.collect_set(F.struct("p", "level", "v")).alias("found"))
    out = base.drop("asked").join(found, ["_s", "_th"], "left").select("_id", "_s", *[c for c in _READ if c != "asked"], "found")
    return stored(out.mapInArrow(close, f"_id {id_type}, _s long, _all double, _top double"), "toxicity-figures")


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and intercept of a logistic curve, by Newton's method with a small penalty on the standardised slopes."""
    if not len(x) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return np.zeros(2), float(np.log(share / (1 - share)))
    middle, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    beta, penalty = np.zeros(3), np.diag([0.1, 0.1, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(3), z.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slopes = beta[:2] / scale
    return slopes, float(beta[2] - slopes @ middle)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """_id, held_out, score, predicted of each row of docs."""
    spark = docs.sparkSession
    bounded_batches(spark)
    each = labels_of(labels, id_col, label_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(each.filter(F.col("_fold") != CALIBRATION), F.col("_id") == F.col("_lid"))
    base = figures(docs, fit_model(rows.select("_toxic", "_text")), id_col, text_col)
    sample = base.join(each.filter(F.col("_fold") == CALIBRATION), F.col("_id") == F.col("_lid"))
    share = min(1.0, MAX_CALIBRATION_ROWS / max(1, sample.count()))
    sample = sample.filter(F.pmod("_s", F.lit(1_000_003)) < int(share * 1_000_003)) if share < 1 else sample
    seen = sample.select("_toxic", "_all", "_top").toPandas()
    slopes, intercept = fit_curve(seen[["_all", "_top"]].to_numpy(dtype=np.float64), seen["_toxic"].to_numpy(dtype=np.float64))
    score = 1 / (1 + F.exp(-(F.lit(float(slopes[0])) * F.col("_all") + F.lit(float(slopes[1])) * F.col("_top") + F.lit(intercept))))
    out = base.withColumn("score", score)
    return out.select("_id", F.coalesce(fold(F.col("_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).withColumnRenamed("_id", "doc_id")


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
