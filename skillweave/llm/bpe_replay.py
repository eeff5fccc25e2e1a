"""Byte-level BPE by corpus-level merge replay.

1. Texts are cut into words at blanks and line feeds. In a text whose white space is single ones of these, the tokenizer's
   pattern starts a match at each, so a word is a run of whole pieces, and its ids don't depend on where it stands. Of other
   texts, and with cut=False (for other patterns), the words are the pieces themselves.
2. The documents of each word of the corpus are counted, and the HEAD_WORDS most frequent are solved once: all their pieces become one
   token array; an inverted index maps token pairs to the positions where they stand, by windows of ranks; windows are taken in
   rank order over all words at once, inside one each word's pair of the least rank comes first, and a merge touches its two
   neighbours only. Pairs that come up are filed under their own window.
3. The solved words are broadcast: their number is bounded, whatever the corpus. Documents look their words up; a word beyond the
   head, which is rare by its rank, is solved by the same replay with the other rare words of its block of documents, unless
   its pieces are known. Joining these from a table would move each of their occurrences twice.

Defined results: a null text is an empty one (no ids); special-token strings are ordinary text; rows that repeat and null
ids are allowed; a text of any length is whole, in a block of its own; an empty table gives an empty result; the output
columns replace input columns of the same name.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from struct import Struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillweave.llm.common import bounded_batches, small, stored

#: Words that are solved for the whole corpus and broadcast (about 20 bytes each), the most frequent.
HEAD_WORDS = 200_000
#: Bytes of texts and rare words that are solved together, at most (a text is never split).
BLOCK_BYTES, BLOCK_WORDS = 6 << 20, 100_000
#: Words that one replay of the corpus's words holds at most.
REPLAY_WORDS = 100_000
#: Longer words are solved where they stand, so the head has a bound in bytes too.
MAX_HEAD_CHARS = 64
#: Windows of ranks, from the first merges on; later ones hold ever more ranks.
_WINDOWS = 24


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Merges:
    """All token pairs that merge, sorted, with the number of each in the order of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(r, ranks[t[:k]], ranks[t[k:]]) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
        self.size = max(ranks.values(), default=0) + 1
        self.rank = table[:, 0].copy()
        key = table[:, 1] * self.size + table[:, 2]
        self.number = np.argsort(key).astype(np.int32)
        self.key = key[self.number]
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        #: tokens that can stand in a pair of a lower rank than their own; words are taken one merge at a time there
        back = table[(table[:, 0] < table[:, 1]) | (table[:, 0] < table[:, 2])]
        self.falls = np.zeros(self.size, dtype=bool)
        self.falls[back[:, 1:].ravel()] = True
        steps = np.unique(np.geomspace(1, max(len(table), 2), _WINDOWS).astype(np.int64))
        # no rank is in two windows
        self.windows = np.unique(np.searchsorted(self.rank, self.rank[np.minimum(steps, len(table) - 1)], "right")) if len(table) else np.empty(0, int)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each pair of tokens; -1 where they don't merge (or one is no token)."""
        wanted = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.key, wanted)
        at[at == len(self.key)] = 0
        return np.where((self.key[at] == wanted) & (a >= 0) & (b >= 0), self.number[at], -1) if len(self.key) else np.full(len(a), -1)


class _Words:
    """Pieces as one token array, with the links between neighbours and the pair that starts at each place."""

    def __init__(self, merges: Merges, flat: np.ndarray, ends: np.ndarray):
        n = len(flat)
        self.m = merges
        self.token = merges.bytes[flat]
        self.after, self.before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        self.after[ends - 1] = -1
        self.before[np.r_[0, ends[:-1]]] = -1
        self.word = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(np.r_[0, ends]))
        self.pair = np.full(n, -1, dtype=np.int32)
        self.pair[:-1] = merges.pair(self.token[:-1], self.token[1:])
        self.pair[ends - 1] = -1

    def merge(self, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Merges the pairs that start at these places (apart from each other) to these tokens; gives the places whose pair is new."""
        gone = self.after[at]
        right = self.after[gone]
        self.token[at], self.token[gone] = rank, -1
        self.pair[gone] = -1
        self.after[at] = right
        self.before[right[right >= 0]] = at[right >= 0]
        left = self.before[at]
        touched = np.concatenate([at, left[left >= 0]])
        following = self.after[touched]
        self.pair[touched] = np.where(following >= 0, self.m.pair(self.token[touched], self.token[following]), -1)
        return touched

    def replay(self) -> None:
        filed: list[list[np.ndarray]] = [[] for _ in self.m.windows]
        places = np.flatnonzero(self.pair >= 0).astype(np.int32)
        self.file(places, filed, -1)
        for w, high in enumerate(self.m.windows.tolist()):
            places = np.sort(np.concatenate(filed[w])) if filed[w] else places[:0]
            filed[w] = []
            while True:
                # a pair may have gone meanwhile, or have become one of another window
                number = self.pair[places]
                here = (number >= 0) & (number < high)
                here[1:] &= places[1:] != places[:-1]
                places = places[here]
                if not len(places):
                    break
                rank, word = self.m.rank[number[here]], self.word[places]
                heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(word)]))
                chosen = np.flatnonzero(rank == least)
                at, rank = places[chosen], least[chosen]
                chained = np.r_[False, self.after[at[:-1]] == at[1:]]
                first = np.r_[True, self.word[at[1:]] != self.word[at[:-1]]]
                if chained.any() or not first.all():
                    # of pairs that overlap every other one from the left; a single one where a lower rank may come of it
                    order = np.arange(len(at))
                    head = np.maximum.accumulate(np.where(chained, 0, order))
                    use = ((order - head) % 2 == 0) & (first | ~self.m.falls[rank])
                    at, rank = at[use], rank[use]
                new = self.merge(at, rank)
                self.file(new, filed, w)
                places = np.sort(np.concatenate([places, new]))

    def file(self, places: np.ndarray, filed: list[list[np.ndarray]], window: int) -> None:
        """Notes the places under the windows of their pairs, if those come later."""
        number = self.pair[places]
        of = np.searchsorted(self.m.windows, number, "right")
        late = (number >= 0) & (of > window)
        if not late.any():
            return
        places, of = places[late], of[late]
        order = np.argsort(of, kind="stable")
        places, of = places[order], of[order]
        cuts = np.flatnonzero(np.diff(of)) + 1
        for k, x in zip(of[np.r_[0, cuts]].tolist(), np.split(places, cuts), strict=True):
            filed[k].append(x)


def solve_words(keys: list[str], pattern: regex.Pattern, ranks: dict[bytes, int], merges: Merges, known: _Known | None = None) -> list[bytes]:
    """The ids of each word, packed as little-endian unsigned 32-bit integers; equal pieces are solved once, those that are
    known words not at all."""
    pieces: list[str] = []
    counts = []
    for w in map(text_of, keys):
        found = pattern.findall(w)
        pieces += found
        counts.append(len(found))
    solved: dict[str, bytes] = dict.fromkeys(pieces)
    names, raw = [], []
    for x in solved:
        ids = known.get(x[1:]) if known and x[0] == " " and len(x) > 1 else None
        if ids is None:
            b = x.encode("utf-8")
            rank = ranks.get(b)
            if rank is None:
                names.append(x)
                raw.append(b)
                continue
            ids = _PACK(rank)
        solved[x] = ids
    if names:
        ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
        table = _Words(merges, np.frombuffer(b"".join(raw), dtype=np.uint8), ends)
        table.replay()
        left = table.token >= 0
        packed = table.token[left].astype("<u4").tobytes()
        start = 0
        for x, stop in zip(names, (4 * np.cumsum(np.add.reduceat(left, np.r_[0, ends[:-1]]))).tolist(), strict=True):
            solved[x] = packed[start:stop]
            start = stop
    ids = map(solved.__getitem__, pieces)
    return [next(ids) if n == 1 else b"".join(islice(ids, n)) for n in counts]


_PACK = Struct("<i").pack
#: What may not stand in a text that is cut: the mark below, and white space but for blank and line feed.
_OTHER = re.compile("[\x00\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def cut_words(text: str, pattern: regex.Pattern, cut: bool) -> list[str]:
    """Keys of the words of a text, in order: a line feed and what follows it, a zero and a piece, or what follows a blank."""
    if not cut or _OTHER.search(text) or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or text[-1:] in (" ", "\n"):
        return ["\0" + x for x in pattern.findall(text)]
    words = text.replace("\n", " \n").split(" ")
    if words[0]:
        words[0] = "\0" + words[0]
        return words
    return words[1:]


def text_of(key: str) -> str:
    return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key


def head_words(docs: DataFrame, pattern: str, text_col: str, cut: bool, most: int) -> DataFrame:
    """w: at most so many words of the corpus, those of the most documents (those of the last count are left out together)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, seen = regex.compile(pattern), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])

        for batch in small(batches):
            for t in batch.column("_text").to_pylist():
                seen.update(set(cut_words(t or "", compiled, cut)))
            if len(seen) > BLOCK_WORDS:
                yield out()
                seen.clear()
        yield out()

    counts = docs.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    # a word of one document is solved there
    counts = stored(counts.filter((F.col("n") > 1) & (F.length("w") <= MAX_HEAD_CHARS)), "bpe-words")
    total, least = 0, 2
    for r in sorted(counts.groupBy("n").count().collect(), key=lambda r: -r.n):  # as many rows as there are different counts
        total += r["count"]
        if total > most:
            least = r.n + 1
            break
    return counts.filter(F.col("n") >= least).select("w")


class _Known(dict):
    """Ids by word; a word that is asked for and not known is noted in `rare`, with a cell that its ids go to."""

    def __init__(self, head: tuple[list[str], list[bytes]]):
        super().__init__(zip(*head, strict=True))
        self.rare: dict[str, list[bytes]] = {}

    def __missing__(self, word: str) -> list[bytes]:
        cell = self.rare[word] = self[word] = []
        return cell

    def get(self, word: str) -> bytes | None:
        """What was known before the words that are open now."""
        found = dict.get(self, word)
        return found if type(found) is bytes else None

    def settle(self) -> None:
        """Forgets the rare words, so that their number never adds up."""
        for word in self.rare:
            del self[word]
        self.rare = {}


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", cut: bool = True, head: int = HEAD_WORDS) -> DataFrame:
    """docs plus ids_col: binary, the ids as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks = load_ranks(rank_path)
    tools = spark.sparkContext.broadcast((ranks, Merges(ranks)))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in gathered(batches, REPLAY_WORDS):
            words = batch.column("w").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(solve_words(words, compiled, *tools.value), pa.binary())], names=["w", "ids"])

    words = head_words(docs, pattern, text_col, cut, head)
    # as few replays as the bound on their words allows: all places of a pair are then merged at once
    solved = words.coalesce(max(1, -(-head // REPLAY_WORDS))).mapInArrow(solve, "w string, ids binary").toArrow()
    shared = spark.sparkContext.broadcast((solved.column("w").to_pylist(), solved.column("ids").to_pylist()))
    base = docs.drop(ids_col)
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        known = _Known(shared.value)

        def solved_block(block: list[tuple[pa.RecordBatch, list[list]]]) -> Iterator[pa.RecordBatch]:
            rare = list(known.rare)
            for cell, ids in zip(known.rare.values(), solve_words(rare, compiled, *tools.value, known), strict=True):
                cell.append(ids)
            for batch, packed in block:
                ids = pa.array([b"".join([x if type(x) is bytes else x[0] for x in p]) for p in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*names, ids_col])
            known.settle()

        block, size = [], 0
        for batch in small(batches, 256):
            block.append((batch, [list(map(known.__getitem__, cut_words(t or "", compiled, cut))) for t in batch.column(text_col).to_pylist()]))
            size += batch.nbytes
            if size >= BLOCK_BYTES or len(known.rare) >= BLOCK_WORDS:
                yield from solved_block(block)
                block, size = [], 0
        yield from solved_block(block)

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(ids_col, T.BinaryType())]))


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of up to so many."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def decode(df: DataFrame, rank_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """df plus bytes_col: binary, the bytes that the packed ids stand for; null ids are none."""
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(rank_path))
    base = df.drop(bytes_col)
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in ranks.value.items()}.__getitem__
        for batch in small(batches):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                packed = part.column(ids_col).to_pylist()
                found = [b"".join(map(token, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in packed]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*names, bytes_col])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(bytes_col, T.BinaryType())]))


def op4_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = encode(docs, path, public_tokenizers.PATTERN).drop("text")
    ids = ids.withColumns({"n_tokens": F.floor(F.length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    return decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op4_bpe_replay": op4_bpe_replay}
ORACLES: dict[str, str] = {}
