"""N-gram Jaccard join by a MinHash LSH forest, then exact verification.

Texts are sets of hashed runs of five lower-case words (a text of fewer words is one run). Documents with the same words
are one vertex.

1. Each vertex has a signature in each of TREES trees: FULL_DEPTH MinHash values of one byte each. A tree is the prefix trie of
   its signatures, kept as the sorted signatures themselves: what two neighbours in the order have in common is the trie's
   deepest node over both, and all vertices under a node of any depth are a run of neighbours with as long a common prefix.
   Sorting is by ranges, so a node with any number of vertices is spread; the neighbours across ranges are linked afterwards.
2. Matching starts at full depth, and the prefix is shortened until the recall that is estimated on the data reaches the target:
   of all vertices, the trie neighbours that are alike (by the number of equal MinHash values, counted on the executors) tell how
   alike linked texts are here, and so which share of such pairs meets in some tree at a given depth. Where nothing is alike,
   pairs at the threshold itself decide. No sample is taken.
3. Neighbours that match at this depth are candidates. Connected candidates are compared exactly inside their component, in
   blocks of bounded size when it is large; only each text's links are counted and the classes' spanning edges leave a task,
   never all pairs. Copies aren't compared: they share a vertex.

Defined results: texts without a word (null, empty, blank) link to nothing; equal texts of fewer than five words link;
null ids are allowed (a class's id is its smallest non-null one); rows that repeat are documents that link to each other;
of equal ids the smaller text hash comes first; a text of any length is one set, whole; an empty table gives an empty result;
the added columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillweave.llm.common import checkpointed, connected_components, gram_hashes, key_matches, mix, small, stored, with_key, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 24
FULL_DEPTH = 10
#: Prefixes that are shorter match by chance too often to be of use.
LEAST_DEPTH = 5
TARGET_RECALL = 0.999
#: Texts of a component that one task compares with as many others.
BLOCK_TEXTS = 400


def recall_at(depth: int, similarity: np.ndarray, trees: int = TREES) -> np.ndarray:
    """Chance that two texts of this similarity share a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def match_depth(similarities: np.ndarray, threshold: float, target: float = TARGET_RECALL, pairs: np.ndarray | None = None) -> int:
    """Shortens the matched prefix from full depth until pairs as alike as these are found with the target recall; pairs: how many
    there are of each similarity (one).

    A pair was seen as it shared a prefix of LEAST_DEPTH somewhere; it stands for as many as that is rare."""
    pairs = np.ones(len(similarities)) if pairs is None else pairs
    alike = similarities >= threshold
    linked, pairs = (np.minimum(similarities[alike], 1.0), pairs[alike]) if alike.any() else (np.array([threshold]), np.ones(1))
    weight = pairs / recall_at(LEAST_DEPTH, linked)
    depth = FULL_DEPTH
    while depth > LEAST_DEPTH and float((recall_at(depth, linked) * weight).sum() / weight.sum()) < target:
        depth -= 1
    return depth


def shingles(text: str | None, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, int | None]:
    """Sorted distinct shingles of a text, and a hash of its words in order; none for a text without words."""
    words = word_hashes((text or "").lower().encode("utf-8", "replace"))
    if not len(words):
        return words, None
    return np.unique(gram_hashes(words, min(n, len(words)))), xxhash.xxh3_64_intdigest(words.tobytes()) - (1 << 63)


class Forest:
    """MinHash signatures of sets: a byte for each tree and depth."""

    def __init__(self, trees: int = TREES, depth: int = FULL_DEPTH):
        n = trees * depth
        seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
        self.xor = (seeds[:n] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.times = ((seeds[n:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]

    def signature(self, grams: np.ndarray) -> bytes:
        x = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.xor), 0xFFFFFFFF, dtype=np.uint32)
        for k in range(0, len(x), 1024):
            np.minimum(least, ((x[None, k : k + 1024] ^ self.xor) * self.times).min(axis=1), out=least)
        return (mix(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """_id, _th, wh (vertex; null without words), sig: one row for each row of docs, written once."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in small(batches):
            wh, sig = [], []
            for t in batch.column("_text").to_pylist():
                grams, h = shingles(t, n)
                wh.append(h)
                sig.append(forest.signature(grams) if h is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), pa.array(wh, pa.int64()), pa.array(sig, pa.binary())], names=["_id", "_th", "wh", "sig"])

    return checkpointed(keyed.mapInArrow(run, f"_id {dict(keyed.dtypes)['_id']}, _th long, wh long, sig binary"))


_TRIE = "a long, b long, depth int, tree int, label binary"


def _common_depth(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two byte matrices."""
    return np.argmin(np.column_stack([x == y, np.zeros(len(x), dtype=bool)]), axis=1)


def _trie_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted leaves, neighbours with a common node; and the first and the last leaf (b is null), for what lies across."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, wh = batch.column("tree").to_numpy(), batch.column("wh").to_numpy()
        label = np.frombuffer(b"".join(batch.column("label").to_pylist()), dtype=np.uint8).reshape(len(wh), FULL_DEPTH)
        edge = [] if last is not None else [(int(wh[0]), int(tree[0]), label[0].tobytes())]
        if last is not None:
            tree, wh, label = np.r_[last[0], tree], np.r_[last[1], wh], np.vstack([last[2], label])
        last = tree[-1:], wh[-1:], label[-1:]
        depth = np.where(tree[1:] == tree[:-1], _common_depth(label[1:], label[:-1]), 0)
        at = np.flatnonzero(depth >= LEAST_DEPTH)
        yield _leaves(wh[at], wh[at + 1], depth[at])
        if edge:
            yield _ends(edge)
    if last is not None:
        yield _ends([(int(last[1][0]), int(last[0][0]), last[2].tobytes())])


def _leaves(a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(depth, pa.int32()), *none], names=["a", "b", "depth", "tree", "label"])


def _ends(leaves: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    a, tree, label = zip(*leaves, strict=True)
    none = pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), *none, pa.array(tree, pa.int32()), pa.array(label, pa.binary())], names=["a", "b", "depth", "tree", "label"])


def trie_neighbours(vertices: DataFrame) -> DataFrame:
    """a, b, depth: neighbours in the sorted signatures of some tree and how much of the prefix they share, if that is LEAST_DEPTH
    or more. A vertex has two neighbours in a tree at most, however many share its node."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    leaves = vertices.select("wh", tree, "sig").select("tree", F.substring("sig", F.col("tree") * FULL_DEPTH + 1, F.lit(FULL_DEPTH)).alias("label"), "wh")
    found = stored(leaves.repartitionByRange("tree", "label", "wh").sortWithinPartitions("tree", "label", "wh").mapInArrow(_trie_batches, _TRIE), "trie")
    # two leaves of each range, and a range holds a whole partition: this window is as small as the list of partitions
    order = W.orderBy("tree", "label", "a")
    ends = found.filter("b IS NULL").select("a", "tree", "label", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("a", "tree", "label")])
    same = [F.substring("label", k, 1) == F.substring("next_label", k, 1) for k in range(1, FULL_DEPTH + 1)]
    depth = F.lit(FULL_DEPTH)
    for k in reversed(range(FULL_DEPTH)):
        depth = F.when(~same[k], F.lit(k)).otherwise(depth)
    across = ends.filter((F.col("tree") == F.col("next_tree")) & (F.col("a") != F.col("next_a"))).select("a", F.col("next_a").alias("b"), depth.alias("depth"))
    return found.filter("b IS NOT NULL").select("a", "b", "depth").unionByName(across.filter(F.col("depth") >= LEAST_DEPTH))


def neighbour_similarities(neighbours: DataFrame, vertices: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Similarities of all pairs of trie neighbours, estimated by the signatures, and the number of pairs of each: the driver gets one
    row for each number of equal values."""
    pairs = neighbours.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sig = vertices.select("wh", "sig")
    pairs = pairs.join(sig.select(F.col("wh").alias("a"), F.col("sig").alias("x")), "a").join(sig.select(F.col("wh").alias("b"), F.col("sig").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(TREES * FULL_DEPTH + 1, dtype=np.int64)
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, TREES * FULL_DEPTH) for c in "xy")
            counts += np.bincount((x == y).sum(axis=1), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["equal", "n"])

    found = pairs.select("x", "y").mapInArrow(run, "equal long, n long").groupBy("equal").agg(F.sum("n").alias("n")).toPandas()
    # one value in 256 is equal by chance
    equal = found["equal"].to_numpy(dtype=float) / (TREES * FULL_DEPTH)
    return (equal - 1 / 256) / (1 - 1 / 256), found["n"].to_numpy(dtype=float)


def _links_of_block(threshold: float):
    """Exact comparison of one pair of blocks: links of each text, copies counted, and the root of its local class."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        rows = rows.sort_values("wh")
        sets = [np.asarray(x, dtype=np.int64) for x in rows["grams"]]
        side = rows["side"].to_numpy()
        sizes = np.array([len(s) for s in sets])
        copies = rows["copies"].to_numpy()
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        bounds = np.cumsum(sizes) - sizes
        links = np.zeros(len(sets), dtype=np.int64)
        root = np.arange(len(sets))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        flag = np.zeros(len(values), dtype=np.int32)
        for a in range(len(sets) - 1):
            own = codes[bounds[a] : bounds[a] + sizes[a]]
            flag[own] = 1
            both = np.add.reduceat(flag[codes[bounds[a + 1] :]], bounds[a + 1 :] - bounds[a + 1])
            flag[own] = 0
            near = both >= threshold * (sizes[a] + sizes[a + 1 :] - both) - 1e-9
            if i != j:
                near &= side[a + 1 :] != side[a]
            for b in np.flatnonzero(near) + a + 1:
                links[a] += copies[b]
                links[b] += copies[a]
                x, y = find(a), find(int(b))
                root[max(x, y)] = min(x, y)
        wh = rows["wh"].to_numpy()
        return pd.DataFrame({"wh": wh, "root": wh[[find(x) for x in range(len(sets))]], "links": links})

    return run


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """_id, _th, class_id, class_key, n_links, is_first: one row for each row of docs. class_key names the class even where
    all ids are null; is_first holds for the rows of the class's smallest (id, text hash), nulls last."""
    sig = signatures(docs, id_col, text_col, n)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_th"))).alias("first")
    vertices = sig.filter("wh IS NOT NULL").groupBy("wh").agg(F.count(F.lit(1)).alias("copies"), first, F.any_value("sig").alias("sig"))
    vertices = stored(vertices, "vertices")
    neighbours = trie_neighbours(vertices)
    similarities, pairs = neighbour_similarities(neighbours, vertices)
    depth = match_depth(similarities, threshold, pairs=pairs)
    candidates = neighbours.filter(F.col("depth") >= depth).select("a", "b")
    parts = checkpointed(connected_components(candidates).select(F.col("v").alias("wh"), F.col("root").alias("part")))

    # each candidate text comes once, from the row that stands for its copies
    chosen = vertices.select("wh", "copies", "first").join(parts, "wh").select("wh", "copies", "part", F.col("first._id").alias("_fid"), F.col("first._th").alias("_fth"))
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    texts = keyed.join(chosen, keyed["_id"].eqNullSafe(chosen["_fid"]) & (keyed["_th"] == chosen["_fth"])).select("part", "wh", "copies", "_text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [shingles(t, n)[0].view(np.int64) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("part", "wh", "copies")], pa.array(found, pa.list_(pa.int64()))], names=["part", "wh", "copies", "grams"])

    blocks = parts.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("n_blocks"))
    sets = texts.mapInArrow(grams, "part long, wh long, copies long, grams array<long>").dropDuplicates(["wh"]).join(blocks, "part")
    own = F.pmod(F.hash("wh"), F.col("n_blocks"))
    with_block = sets.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    paired = with_block.select("part", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "wh", "copies", "grams")
    compared = checkpointed(paired.groupBy("part", "i", "j").applyInPandas(_links_of_block(threshold), "wh long, root long, links long"))

    counts = compared.groupBy("wh").agg(F.sum("links").alias("links"))
    classes = connected_components(compared.select(F.col("wh").alias("a"), F.col("root").alias("b"))).withColumnRenamed("v", "wh")
    known = vertices.select("wh", "copies", "first").join(counts, "wh", "left").join(classes, "wh", "left").select(
        "wh", F.coalesce("root", "wh").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "first"
    )
    least = known.groupBy(F.col("class_key").alias("_ck")).agg(F.min("first").alias("least"))
    known = known.join(least, F.col("class_key") == F.col("_ck")).select("wh", "class_key", "n_links", "least")
    out = sig.drop("sig").join(known, "wh", "left")
    is_first = F.col("wh").isNull() | (F.col("_id").eqNullSafe(F.col("least._id")) & (F.col("_th") == F.col("least._th")))
    return out.select(
        "_id", "_th", F.when(F.col("wh").isNull(), F.col("_id")).otherwise(F.col("least._id")).alias("class_id"), "class_key",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), is_first.alias("is_first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: that with the smallest id; texts without a word all stay."""
    gone = similar_classes(docs, id_col, text_col).filter("NOT is_first").select(F.col("_id").alias("__gid"), F.col("_th").alias("__gth")).distinct()
    left = docs.join(gone, key_matches(docs, id_col, text_col, gone, "__gid", "__gth"), "left_anti")
    # rows that repeat exactly are one class as well; only they are looked at again
    keys = docs.select(F.col(f"`{id_col}`").alias("__rid"), F.xxhash64(f"`{text_col}`").alias("__rth")).groupBy("__rid", "__rth").count().filter("count > 1").drop("count")
    if keys.isEmpty():
        return left
    same = key_matches(docs, id_col, text_col, keys, "__rid", "__rth") & F.coalesce(docs[f"`{text_col}`"], F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return left.join(keys, same, "left_anti").unionByName(left.join(keys, same, "left_semi").dropDuplicates([id_col, text_col]))


def op7_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar_classes(docs).select(F.col("_id").alias("doc_id"), "class_id", "n_links")


QUERIES = {"op7_jaccard_forest": op7_jaccard_forest}
ORACLES: dict[str, str] = {}
