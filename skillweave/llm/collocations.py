"""Phrase collocation mining by direct-address tiling.

Texts are folded to lower case (A to Z), split at punctuation and line ends into pieces, and pieces into words. Phrases of two
and three words are counted within pieces, each language (null: `und`) for itself, and those found MIN_COUNT times or more are
scored by 10**6 a^2 / (l r), with a, l and r the counts of the phrase and of the two parts at its worst cut.

1. Words are counted. The most frequent ones of MIN_COUNT or more (Bounds.head_words) get a number, their rank within the language, and
   are broadcast; a text then is a row of numbers.
2. Pairs of numbers are cells of a table of words by words, cut into square tiles. Tasks send sorted cells and counts
   by tile; a tile with many of them is counted in a dense array that the cell addresses directly, a sparse one by sorting its
   cells. A tile too large for one task is merged in parts, in rounds.
3. Frequent pairs are ranked in their turn and become the rows of the next table, of pairs by words, whose cells are phrases of
   three words. The most frequent (Bounds.head_pairs) are broadcast; a phrase that begins with another pair is a cell of its own kind, of
   three word numbers, in sparse tiles.
4. Phrases with a frequent word outside the head are counted as strings beside the tiles, so the head bounds memory only.

Defined results: a null text is empty; scores and counts are exact (decimals); a part of an equal phrase counts each time,
overlaps included; rows that repeat count as often as they stand; words of any length and texts of any length are whole (a text
is taken by blocks); ties are ordered by the phrase's bytes; other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skillweave.llm.common import bounded_batches, drop_folder, key_filter, may_hold, small, stored_at

MIN_COUNT, TOP = 10, 2000
FILTER_BITS = 27


@dataclass(frozen=True)
class Bounds:
    """What a broadcast or a task may hold; results are the same under all bounds.

    head_words, head_pairs: numbered words and ranked pairs; max_word_bytes: of a numbered word; side: of a tile; a tile with
    one in dense_share of its cells filled is counted densely; held_words, held_numbers, block_bytes: different words, numbers
    of words and bytes of text that a task holds before it sends or goes on; bucket_cells, max_cells: cells that one task
    merges, about, and at most for one tile (never fewer than four full tiles)."""

    head_words: int = 1 << 19
    head_pairs: int = 1 << 21
    max_word_bytes: int = 256
    side: int = 1 << 11
    dense_share: int = 8
    held_words: int = 400_000
    held_numbers: int = 1 << 22
    block_bytes: int = 1 << 22
    bucket_cells: int = 1 << 21
    max_cells: int = 1 << 24


_FOLD = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" " + b"\n" * 10)
#: Stands for an edge of a piece; no UTF-8 text has this byte.
_EDGE = b"\xff"


def word_blocks(text: str | None, block: int) -> Iterator[list[bytes]]:
    """The words of a text, with _EDGE at the edges of pieces, by blocks."""
    raw = (text or "").encode("utf-8", "replace").lower().translate(_FOLD).replace(b"\n", b" " + _EDGE + b" ")
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= block else raw.rfind(b" ", at, at + block)
        if end <= at:
            end = raw.find(b" ", at + block)
            end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end + 1


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    for batch in small(batches, 200):
        yield from zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)


def _count_batches(bounds: Bounds) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How often each word stands in the texts of a task, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(_EDGE, None)
                words, n = list(counts), list(counts.values())
                for low in range(0, len(words), 50_000):
                    part = pa.array(words[low : low + 50_000], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), part, pa.array(n[low : low + 50_000], pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for lang, text in _texts(batches):
            counts = held.setdefault(lang, Counter())
            for words in word_blocks(text, bounds.block_bytes):
                counts.update(words)
            if len(counts) > bounds.held_words or len(held) > 1000:
                yield from sent()
        yield from sent()

    return run


class Head:
    """The numbered words of each language, as they are broadcast."""

    def __init__(self, table: pa.Table):
        by_lang: dict[str, list[str]] = {}
        for lang, word in zip(table.column("lang").to_pylist(), table.column("word").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(word)
        self.words = {lang: "\n".join(x).encode() for lang, x in by_lang.items()}

    def list_of(self, lang: str) -> list[bytes]:
        return self.words[lang].split(b"\n") if lang in self.words else []

    def numbers_of(self, lang: str) -> dict[bytes, int]:
        words = self.list_of(lang)
        return dict(zip(words, range(len(words)), strict=True))


class Pairs:
    """The ranked pairs of each language: their keys in order with the rank of each, and the keys by rank."""

    def __init__(self, table: pa.Table):
        langs = np.array(table.column("lang").to_pylist(), dtype=object)
        keys = table.column("i").to_numpy() << 32 | table.column("j").to_numpy()
        self.by_rank = {lang: keys[langs == lang] for lang in set(langs.tolist())}
        self.ranks = {lang: np.argsort(k, kind="stable").astype(np.int32) for lang, k in self.by_rank.items()}

    def finder(self, lang: str) -> Callable[[np.ndarray], np.ndarray]:
        """The rank of each key, or -1."""
        ranks = self.ranks.get(lang, np.empty(0, np.int32))
        keys = self.by_rank[lang][ranks] if len(ranks) else np.empty(0, np.int64)

        def run(x: np.ndarray) -> np.ndarray:
            if not len(keys):
                return np.full(len(x), -1, dtype=np.int64)
            at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
            return np.where(keys[at] == x, ranks[at].astype(np.int64), -1)

        return run


def _number_batches(head, rare, bounds: Bounds) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts as rows of word numbers (-1 between texts and pieces and for all other words), a row for each language of a batch.
    rare: a key filter of the frequent words outside the head, if there are any; phrases with such words come as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, int]] = {}
        packed = rare.value if rare is not None else None
        for batch in batches:
            rows: dict[str, list[np.ndarray]] = {}
            phrases: dict[str, Counter] = {}
            for lang, text in _texts([batch]):
                if lang not in known:
                    known[lang] = head.value.numbers_of(lang)
                get, out, carry = known[lang].get, rows.setdefault(lang, []), []
                for words in word_blocks(text, bounds.block_bytes):
                    out.append(np.fromiter((get(w, -1) for w in words), np.int32, len(words)))
                    if packed is not None:
                        both = carry + words
                        _rare_phrases(both, len(carry), get, lang, packed, phrases.setdefault(lang, Counter()))
                        carry = both[-2:]
                out.append(np.full(1, -1, np.int32))
            names = list(rows)
            found = [[{"phrase": p.decode(), "n": n} for p, n in phrases.get(lang, {}).items()] for lang in names]
            kind = pa.list_(pa.struct([("phrase", pa.string()), ("n", pa.int64())]))
            numbers = [np.concatenate(rows[lang]).tobytes() for lang in names]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.binary()), pa.array(found, kind)], names=["lang", "numbers", "phrases"])

    return run


def _rare_phrases(words: list[bytes], done: int, get, lang: str, packed: np.ndarray, out: Counter) -> None:
    """Counts the phrases that end behind the first `done` words and hold a word outside the head that may be frequent."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    rare = np.array([get(w, -1) < 0 and w != _EDGE for w in words], dtype=bool)
    at = np.flatnonzero(rare)
    if len(at):
        keys = np.fromiter((xxhash.xxh64_intdigest(words[k], seed) for k in at.tolist()), np.uint64, len(at))
        rare[at] = may_hold(packed, keys)
    good = rare | np.array([get(w, -1) >= 0 for w in words], dtype=bool)
    for size in (2, 3):
        if len(words) < size:
            continue
        n = len(words) - size + 1
        take = np.logical_and.reduce([good[k : k + n] for k in range(size)]) & np.logical_or.reduce([rare[k : k + n] for k in range(size)])
        take[: max(0, done - size + 1)] = False
        out.update(b" ".join(words[s : s + size]) for s in np.flatnonzero(take).tolist())


_TILES = "lang string, wide boolean, row int, col int, cells binary, counts binary, n_cells long"


def _tile_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    n = pa.array([len(r[4]) // (8 if r[1] else 4) for r in rows], pa.int64())
    return pa.RecordBatch.from_arrays([*columns, n], names=["lang", "wide", "row", "col", "cells", "counts", "n_cells"])


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs: nearly all are small, and tiles are what tasks hold and send."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _unpacked(counts: pa.Buffer | bytes, n: int) -> np.ndarray:
    return np.frombuffer(counts, f"u{len(counts) // max(n, 1) or 1}")


def _tile_rows(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of a thousand tiles, fewer where they are large."""
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += len(r[4]) + len(r[5])
        if len(out) == 1000 or size > 1 << 22:
            yield _tile_batch(out)
            out, size = [], 0
    if out:
        yield _tile_batch(out)


def _buffers(column: pa.Array | pa.ChunkedArray) -> Iterator[pa.Buffer]:
    """Each value of a binary column where it lies, without a copy."""
    return (column[k].as_buffer() for k in range(len(column)))


#: Numbers that are widened or counted at a time; what a task holds beside its block is a few times this.
STEP = 1 << 18


def _tiled(lang: str, keys: np.ndarray, width: int, side: int) -> Iterator[tuple]:
    """Counts keys (tile * side**2 + cell, with `width` tiles in a row), which are sorted in place, a few whole tiles at a time."""
    keys.sort()
    at, size = 0, side * side
    while at < len(keys):
        end = int(np.searchsorted(keys, (int(keys[at + STEP]) // size + 1) * size)) if at + STEP < len(keys) else len(keys)
        for tile, cells, n in _counted(keys[at:end] // size, keys[at:end]):
            yield lang, False, tile // width, tile % width, (cells % size).astype(np.int32).tobytes(), _packed(n)
        at = end


def _wide_tiled(lang: str, keys: np.ndarray, groups: int) -> Iterator[tuple]:
    """Cells of three word numbers, counted and dealt to sparse tiles by their first two."""
    tile = keys >> 21
    tile *= np.int64(0x9E3779B1)
    tile >>= 13
    tile %= groups
    tile = tile.astype(np.int32)
    order = np.argsort(tile, kind="stable")
    tile, keys = tile[order], keys[order]
    del order
    at = 0
    while at < len(keys):
        end = int(np.searchsorted(tile, tile[at + STEP], "right")) if at + STEP < len(keys) else len(keys)
        order = np.lexsort((keys[at:end], tile[at:end]))
        for group, cells, n in _counted(tile[at:end][order], keys[at:end][order]):
            yield lang, True, group, 0, cells.tobytes(), _packed(n)
        at = end


def _counted(tile: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each tile of keys in order by tile, with its different keys and their counts."""
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    n = np.diff(np.r_[at, len(keys)])
    tile, keys = tile[at], keys[at]
    heads = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    ends = np.r_[heads[1:], len(tile)]
    return ((int(tile[a]), keys[a:b], n[a:b]) for a, b in zip(heads.tolist(), ends.tolist(), strict=True))


def _cell_keys(x: np.ndarray, find, complete: bool, side: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys of the cells that a row of word numbers has in tiles, keys in sparse tiles, and tiles in a row; find: of a pair's rank, for
    the table of pairs by words. Only STEP numbers at a time are widened."""
    more = 1 if find is None else 2
    width = int(x.max()) // side + 1 if len(x) else 1
    n = max(len(x) - more, 0)
    keys, wide, used, used_wide = np.empty(n, np.int64), np.empty(0 if complete else n, np.int64), 0, 0
    for low in range(0, n, STEP):
        y = x[low : min(low + STEP, n) + more].astype(np.int64)
        if find is None:
            rows, ok = y[:-1], (y[:-1] >= 0) & (y[1:] >= 0)
        else:
            rank = find(y[:-1] << 32 | y[1:])
            rank[(y[:-1] < 0) | (y[1:] < 0)] = -2
            rows, ok = rank[:-1], (rank[:-1] >= 0) & (rank[1:] >= (0 if complete else -1))
            if not complete:
                other = (rank[:-1] == -1) & (rank[1:] >= -1)
                other = (y[:-2] << 42 | y[1:-1] << 21 | y[2:])[other]
                wide[used_wide : used_wide + len(other)] = other
                used_wide += len(other)
        rows, cols = rows[ok], y[more:][ok]
        keys[used : used + len(rows)] = ((rows // side) * width + cols // side) * (side * side) + (rows % side) * side + cols % side
        used += len(rows)
    return keys[:used], wide[:used_wide], width


def _tile_batches(pairs, complete: bool, groups: int, bounds: Bounds) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tiles of the table of words by words, or, given ranked pairs, of pairs by words. complete: no other pair is frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            while held:
                lang, parts = held.popitem()
                x = np.concatenate(parts)
                del parts
                keys, wide, width = _cell_keys(x, pairs.value.finder(lang) if pairs is not None else None, complete, bounds.side)
                del x
                yield from _tile_rows(_tiled(lang, keys, width, bounds.side))
                del keys
                yield from _tile_rows(_wide_tiled(lang, wide, groups))

        for batch in batches:
            for lang, numbers in zip(batch.column("lang").to_pylist(), _buffers(batch.column("numbers")), strict=True):
                held.setdefault(lang, []).append(np.frombuffer(numbers, dtype=np.int32))
                size += numbers.size // 4
                if size > bounds.held_numbers:
                    yield from sent()
                    size = 0
        yield from sent()

    return run


def count_cells(cells: np.ndarray, counts: np.ndarray, size: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Different cells in order, with the sums of their counts: by direct address in a table of this size, or by sorting."""
    if size:
        return _addressed([(cells, counts)], size, 1)
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]][: len(cells)])
    return cells[heads].astype(np.int64), np.add.reduceat(counts[order], heads) if len(heads) else counts


def _addressed(parts: list[tuple[np.ndarray, np.ndarray]], size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells with sums of `least` or more, from parts that are added to one table where they lie."""
    total = np.zeros(size, dtype=np.int64)
    for cells, counts in parts:
        for low in range(0, len(cells), STEP):
            np.add.at(total, cells[low : low + STEP], counts[low : low + STEP].astype(np.int64))
    at = np.flatnonzero(total >= least)
    return at, total[at]


def _merged(rows: pa.Table, bounds: Bounds, least: int = 1) -> Iterator[tuple[str, bool, int, int, np.ndarray, np.ndarray]]:
    """Each tile of the rows once, with its cells counted `least` times or more."""
    parts: dict[tuple, list[tuple]] = {}
    names = [rows.column(c).to_pylist() for c in ("lang", "wide", "row", "col")]
    for lang, wide, row, col, cells, counts in zip(*names, _buffers(rows.column("cells")), _buffers(rows.column("counts")), strict=True):
        cells = np.frombuffer(cells, np.int64 if wide else np.int32)
        parts.setdefault((lang, wide, row, col), []).append((cells, _unpacked(counts, len(cells))))
    for (lang, wide, row, col), found in parts.items():
        if not wide and sum(len(x) for x, _ in found) * bounds.dense_share >= bounds.side**2:
            cells, counts = _addressed(found, bounds.side**2, least)
        else:
            cells, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            cells, counts = count_cells(cells, counts.astype(np.int64))
            often = counts >= least
            cells, counts = cells[often], counts[often]
        yield lang, wide, row, col, cells, counts


def _part_batches(bounds: Bounds) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        found = _merged(rows, bounds)
        return pa.Table.from_batches([_tile_batch([(lang, wide, row, col, cells.astype(np.int64 if wide else np.int32).tobytes(), _packed(counts)) for lang, wide, row, col, cells, counts in found])])

    return run


def merged_tiles(tiles: DataFrame, frequent: Callable[[pa.Table], pa.Table], schema: str, bounds: Bounds) -> DataFrame:
    """frequent(rows) of buckets of whole tiles; before that, tiles of too many cells are merged in parts, until each
    fits in a task. A part gives at most a full tile, so rounds shrink it."""
    spark, key, most = tiles.sparkSession, ["lang", "wide", "row", "col"], max(bounds.max_cells, 4 * bounds.side**2)
    while True:
        sizes = tiles.groupBy(*key).agg(F.sum("n_cells").alias("size"), F.count(F.lit(1)).alias("rows"))
        large = sizes.filter((F.col("size") > most) & (F.col("rows") > 1) & ~F.col("wide")).select(*[F.col(c).alias(f"_{c}") for c in key], F.ceil(F.col("size") / most).alias("parts"))
        if large.isEmpty():
            break
        same = [F.col(c) == F.col(f"_{c}") for c in key]
        split = tiles.join(large, same).withColumn("part", F.pmod(F.xxhash64("cells"), F.col("parts"))).groupBy(*key, "part")
        split = split.applyInArrow(_part_batches(bounds), _TILES)
        tiles = stored_at(tiles.join(large, same, "left_anti").unionByName(split), "tiles")[0]
    cells = tiles.agg(F.sum("n_cells")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(cells) // bounds.bucket_cells)
    return tiles.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets))).groupBy("bucket").applyInArrow(frequent, schema)


def _columns(found: list[dict], names: list[str]) -> pa.Table:
    """Columns of all tiles: words as strings, all else as numbers."""
    kinds = {"lang": pa.string(), **{f"w{k}": pa.string() for k in (1, 2, 3)}}
    return pa.table({c: pa.concat_arrays([f[c] for f in found]) if found else pa.array([], kinds.get(c, pa.int64())) for c in names})


def _phrases(lang: str, words: pa.Array, numbers: list[np.ndarray], counts: np.ndarray) -> dict:
    out = {"lang": pa.array([lang] * len(counts), pa.string()), "a": pa.array(counts)}
    for k, x in enumerate(numbers):
        out |= {f"w{k + 1}": words.take(pa.array(x)), "ij"[k] if k < 2 else "k": pa.array(x)}
    return out


def _frequent(head, pairs, least: int, names: list[str], bounds: Bounds) -> Callable[[pa.Table], pa.Table]:
    """The phrases of a bucket's tiles that are found often enough, with their words."""

    def run(rows: pa.Table) -> pa.Table:
        words: dict[str, pa.Array] = {}
        found = []
        for lang, wide, row, col, cells, counts in _merged(rows, bounds, least):
            if not len(cells):
                continue
            if lang not in words:
                words[lang] = pa.array(head.value.list_of(lang), pa.binary()).cast(pa.string())
            if wide:
                numbers = [cells >> 42, cells >> 21 & 0x1FFFFF, cells & 0x1FFFFF]
            else:
                numbers = [row * bounds.side + cells // bounds.side, col * bounds.side + cells % bounds.side]
                if pairs is not None:
                    both = pairs.value.by_rank[lang][numbers[0]]
                    numbers = [both >> 32, both & 0xFFFFFFFF, numbers[1]]
            found.append(_phrases(lang, words[lang], numbers, counts))
        return _columns(found, names)

    return run


def _score(a: str, left: str, right: str) -> Column:
    """floor(10**6 a^2 / (left right)), exact up to a = 10**16."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)), whole(left) * whole(right))


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, bounds: Bounds = Bounds()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All words (lang, word, n), and the pairs (lang, w1, w2, a) and triples (lang, w1, w2, w3, a) found `least` times or more."""
    spark = docs.sparkSession
    context = spark.sparkContext
    bounded_batches(spark)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    counted = texts.mapInArrow(_count_batches(bounds), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored_at(counted, "words")[0]
    often = words.filter(F.col("n") >= least)
    top = often.filter(F.octet_length("word") <= bounds.max_word_bytes).orderBy(F.desc("n"), "lang", "word").limit(bounds.head_words).select("lang", "word").toArrow()
    head = context.broadcast(Head(top))
    rare = None
    if often.count() > top.num_rows:
        known = spark.createDataFrame(top)
        rest = often.join(known.select(F.col("lang").alias("_l"), F.col("word").alias("_w")), (F.col("lang") == F.col("_l")) & (F.col("word") == F.col("_w")), "left_anti")
        rare = context.broadcast(key_filter(rest.select(F.xxhash64("lang", "word").alias("k")), FILTER_BITS))
    numbers, numbers_at = stored_at(texts.mapInArrow(_number_batches(head, rare, bounds), "lang string, numbers binary, phrases array<struct<phrase: string, n: long>>"), "numbers")

    tiles, tiles_at = stored_at(numbers.mapInArrow(_tile_batches(None, True, 1, bounds), _TILES), "pair-tiles")
    two = merged_tiles(tiles, _frequent(head, None, least, ["lang", "i", "j", "w1", "w2", "a"], bounds), "lang string, i long, j long, w1 string, w2 string, a long", bounds)
    two, _ = stored_at(two, "pairs")
    drop_folder(spark, tiles_at)
    ranked = two.orderBy(F.desc("a"), "lang", "i", "j").limit(bounds.head_pairs).select("lang", "i", "j").toArrow()
    other = two.count() - ranked.num_rows
    pairs = context.broadcast(Pairs(ranked))
    tiles, tiles_at = stored_at(numbers.mapInArrow(_tile_batches(pairs, other == 0, 64 + other // bounds.side, bounds), _TILES), "triple-tiles")
    three = merged_tiles(tiles, _frequent(head, pairs, least, ["lang", "w1", "w2", "w3", "a"], bounds), "lang string, w1 string, w2 string, w3 string, a long", bounds)
    if rare is not None:
        strings = numbers.select("lang", F.inline("phrases")).groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
        strings, _ = stored_at(strings.select("lang", F.split("phrase", " ").alias("w"), "a"), "rare-phrases")
        part = lambda k: F.element_at("w", k).alias(f"w{k}")
        two = two.select("lang", "w1", "w2", "a").unionByName(strings.filter(F.size("w") == 2).select("lang", part(1), part(2), "a"))
        three = three.unionByName(strings.filter(F.size("w") == 3).select("lang", part(1), part(2), part(3), "a"))
    three, _ = stored_at(three, "triples")
    drop_folder(spark, tiles_at)
    drop_folder(spark, numbers_at)
    return words, two.select("lang", "w1", "w2", "a"), three


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, top: int = TOP, bounds: Bounds = Bounds()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    words, two, three = count_phrases(docs, text_col, lang_col, least, bounds)
    often = words.filter(F.col("n") >= least)

    def with_word(df: DataFrame, word: str, out: str) -> DataFrame:
        one = often.select(F.col("lang").alias("_l"), F.col("word").alias("_w"), F.col("n").alias(out))
        return df.join(one, (F.col("lang") == F.col("_l")) & (F.col(word) == F.col("_w"))).drop("_l", "_w")

    def with_pair(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
        one = two.select(F.col("lang").alias("_l"), F.col("w1").alias("_1"), F.col("w2").alias("_2"), F.col("a").alias(out))
        return df.join(one, (F.col("lang") == F.col("_l")) & (F.col(first) == F.col("_1")) & (F.col(second) == F.col("_2"))).drop("_l", "_1", "_2")

    # pairs that a longer phrase holds often enough
    inside = three.select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    inside = inside.groupBy(F.col("lang").alias("_l"), F.col("p.w1").alias("_1"), F.col("p.w2").alias("_2")).agg(F.max("a").alias("longer"))
    held = (F.col("lang") == F.col("_l")) & (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")) & (F.col("longer") * 100 >= F.col("a") * 50)
    two_scored = with_word(with_word(two.join(inside, held, "left_anti"), "w1", "l"), "w2", "r")
    two_scored = two_scored.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    three_scored = with_pair(with_pair(with_word(with_word(three, "w1", "l1"), "w3", "r2"), "w2", "w3", "r1"), "w1", "w2", "l2")
    three_scored = three_scored.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    late = F.col("s2") < F.col("s1")
    cut = lambda first, second, name: F.when(late, F.col(second)).otherwise(F.col(first)).alias(name)
    three_scored = three_scored.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut("l1", "l2", "l"), cut("r1", "r2", "r"), cut("s1", "s2", "score"))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two_scored.unionByName(three_scored).withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    totals = words.groupBy(F.col("lang").alias("_l")).agg(F.sum("n").alias("n"))
    return ranked.join(totals, F.col("lang") == F.col("_l")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM lists),
f AS (
  SELECT lang, array_to_string(w[k:k + s - 1], ' ') AS phrase, s, count(*) AS a
  FROM starts, (VALUES (1), (2), (3)) AS sizes(s) WHERE k + s - 1 <= len(w) GROUP BY ALL),
candidates AS (SELECT lang, phrase, s, a, string_split(phrase, ' ') AS w FROM f WHERE s >= 2 AND a >= 10),
cuts AS (SELECT *, unnest(range(1, s)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE s = 3),
longer AS (SELECT lang, phrase, max(a) AS a FROM parts GROUP BY ALL),
kept AS (SELECT x.* FROM worst x LEFT JOIN longer y USING (lang, phrase) WHERE y.a IS NULL OR 100 * y.a < 50 * x.a),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE s = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""
}
