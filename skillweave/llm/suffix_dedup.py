"""Suffix-array dedup of byte strings that repeat anywhere in the corpus.

Each byte covered by a string of SPAN bytes that also starts elsewhere is removed; strings are judged on the input.

1. Runs: windows of SPAN bytes are grouped by the least hash among their strings of ANCHOR bytes. Equal windows have equal
   anchors, so a window repeats only inside its anchor's group. A run's bytes are named by a second hash; runs that are
   the same bytes repeat whole and never go further, so copies cost nothing more.
2. Runs that share an anchor but differ, at the edges of repeated passages, are cut again with anchors of FINE bytes. What
   still differs goes, by buckets of whole groups, through a suffix array: in a group the anchor is one symbol, so a window
   is a string of SPAN - FINE + 1 symbols, and equal windows are neighbours in the array.
3. The array is built by linear grouping: suffixes are grouped by their Lyndon prefixes, groups taken in descending order
   with previous-smaller pointers, then each group's order is emitted in ascending order; nothing is renamed recursively.
4. A group of more than MAX_GROUP different runs is not gathered: its windows are hashed and counted by key instead, which
   gives the same windows.

Defined results: a null text has no bytes; texts shorter than SPAN bytes lose nothing; rows that repeat are documents that
repeat each other, so both lose their shared strings; null ids are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import mix, powers, small, stored, with_key

SPAN = 400
ANCHOR = 128
FINE = 336
MAX_GROUP = 1500
#: Runs whose suffixes one task sorts together, about.
BUCKET_RUNS = 1500


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each string of `size` symbols."""
    n = len(data)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[size:] - total[: n - size + 1]) * down[: n - size + 1])


def _sliding(x: np.ndarray, width: int, better) -> np.ndarray:
    """`better` (minimum or maximum) of each run of `width` values."""
    size, m = 1, x
    while size * 2 <= width:
        m = better(m[:-size], m[size:])
        size *= 2
    n = len(x) - width + 1
    return better(m[:n], m[width - size : width - size + n])


class Runs:
    """Maximal runs of windows that share their least anchor: its hash, first window, number of windows, the place of
    the anchor, and whether it occurs more than once in the run."""

    def __init__(self, data: np.ndarray, anchor: int, span: int = SPAN):
        width = span - anchor + 1
        if len(data) < span:
            none = np.empty(0, np.int64)
            self.value, self.first, self.count, self.place, self.multiple = none.view(np.uint64), none, none, none, none.astype(bool)
            return
        g = rolling(data, anchor)
        m = _sliding(g, width, np.minimum)
        self.first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        self.count = np.diff(np.r_[self.first, len(m)])
        self.value = m[self.first]
        # a string is the least of some window where it equals the greatest minimum around it
        around = _sliding(np.r_[np.zeros(width - 1, np.uint64), m, np.zeros(width - 1, np.uint64)], width, np.maximum)
        anchors = np.flatnonzero(g == around)
        low = np.searchsorted(anchors, self.first)
        high = np.searchsorted(anchors, self.first + self.count + width - 1)
        sizes = high - low
        run = np.repeat(np.arange(len(self.first)), sizes)
        at = anchors[np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        own = g[at] == self.value[run]
        run, at = run[own], at[own]
        self.multiple = np.bincount(run, minlength=len(self.first)) > 1
        self.place = at[np.searchsorted(run, np.arange(len(self.first)))]


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes of a sequence of symbols >= 1, by linear grouping."""
    n = len(text)
    if not n:
        return []
    s = [*text, 0]
    n += 1
    # groups are ranges of `order`; `start` is the first place of each suffix's group, `size` its length at that place
    symbols = np.asarray(s)
    order = np.argsort(symbols, kind="stable").tolist()
    ranked = symbols[order]
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    lengths = np.diff(np.r_[heads, n])
    start_of = np.empty(n, dtype=np.int64)
    start_of[order] = np.repeat(heads, lengths)
    start = start_of.tolist()
    rank_place = np.empty(n, dtype=np.int64)
    rank_place[order] = np.arange(n)
    place = rank_place.tolist()
    size = [0] * n
    for h, c in zip(heads.tolist(), lengths.tolist(), strict=True):
        size[h] = c
    previous = [-1] * n
    high = n
    while high > 0:
        head = start[order[high - 1]]
        members = sorted(order[head:high])
        high = head
        counts: dict[int, int] = {}
        for i in members:
            # the nearest suffix to the left in a lower group; suffixes done before have their pointers to jump along
            j = i - 1
            while j >= 0 and start[j] >= head:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        # suffixes that are pointed to go up, next to their old group, the more often the higher
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, c in counts.items():
            by_count.setdefault(c, {}).setdefault(start[j], []).append(j)
        for c in sorted(by_count, reverse=True):
            for g, moved in by_count[c].items():
                if len(moved) == size[g]:
                    continue
                tail = g + size[g]
                new = tail - len(moved)
                for j in moved:
                    tail -= 1
                    p, other = place[j], order[tail]
                    order[p], order[tail] = other, j
                    place[other], place[j] = p, tail
                    start[j] = new
                size[new] = len(moved)
                size[g] -= len(moved)
    # each group's order: a suffix takes the next free place of its group, smallest first
    out = [-1] * n
    out[0] = n - 1
    free = list(range(n))
    done = [False] * n
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = start[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = previous[j]
    return out[1:]


def repeated_windows(strings: list[np.ndarray], counts: list[int], length: int) -> list[np.ndarray]:
    """For each string, which of its first `count` places start `length` symbols that also start elsewhere among the
    strings' such places."""
    starts = np.cumsum([0, *[len(x) + 1 for x in strings]])
    text = np.zeros(int(starts[-1]), dtype=np.int64)
    use = np.zeros(len(text), dtype=bool)
    for a, x, c in zip(starts, strings, counts, strict=False):
        text[a : a + len(x)] = x
        text[a + len(x)] = 1  # between strings; symbols of strings are larger
        use[a : a + c] = True
    order = np.asarray(suffix_array(text.tolist()), dtype=np.int64)
    order = order[use[order]]
    equal = np.ones(max(len(order) - 1, 0), dtype=bool)
    left, right = order[:-1], order[1:]
    for k in range(length):
        equal &= text[left + k] == text[right + k]
    hit = np.zeros(len(text), dtype=bool)
    hit[left[equal]] = True
    hit[right[equal]] = True
    return [hit[a : a + c] for a, c in zip(starts, counts, strict=False)]


def spans_of(first: int, hit: np.ndarray, span: int = SPAN) -> list[tuple[int, int]]:
    """Byte ranges covered by the marked windows, the first of which starts at `first`."""
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [(first + int(a), first + int(b) - 1 + span) for a, b in zip(edge[0::2], edge[1::2], strict=True)]


def _name(data: memoryview) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        sizes, parts, names = [], [], []
        for t in batch.column("_text").to_pylist():
            raw = (t or "").encode("utf-8", "replace")
            r = Runs(np.frombuffer(raw, dtype=np.uint8), ANCHOR)
            view = memoryview(raw)
            names += [_name(view[a : a + c + SPAN - 1]) for a, c in zip(r.first.tolist(), r.count.tolist(), strict=True)]
            sizes.append(len(r.first))
            parts.append((r.value.view(np.int64), r.first, r.count, r.multiple))
        column = lambda k, kind: pa.array(np.concatenate([p[k] for p in parts]).astype(kind) if parts else np.empty(0, kind))
        fields = [column(0, np.int64), pa.array(names, pa.int64()), column(1, np.int64), column(2, np.int64), column(3, bool)]
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["m", "seg", "first", "count", "multiple"]))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), runs], names=["_id", "_th", "runs"])


_FINE = "_id {0}, _th long, m long, seg long, first long, count long, multiple boolean, place long, data binary"


def _fine_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the wanted runs of each text again, with fine anchors. A run's bytes come along without its anchor, which all
    runs of the group share; whole where the anchor repeats."""
    for batch in small(batches):
        rows, out = [], []
        for k, (t, wanted) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("wanted").to_pylist(), strict=True)):
            raw = (t or "").encode("utf-8", "replace")
            view = memoryview(raw)
            for w in wanted:
                begin, end = w["first"], w["first"] + w["count"] + SPAN - 1
                r = Runs(np.frombuffer(view[begin:end], dtype=np.uint8), FINE)
                for v, a, c, p, many in zip(r.value.view(np.int64).tolist(), r.first.tolist(), r.count.tolist(), r.place.tolist(), r.multiple.tolist(), strict=True):
                    first, last = begin + a, begin + a + c + SPAN - 1
                    data = raw[first:last] if many else raw[first : begin + p] + raw[begin + p + FINE : last]
                    out.append((v, _name(view[first:last]), first, c, many, p - a, data))
                    rows.append(k)
        take = pa.array(rows, pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
        columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id").take(take), batch.column("_th").take(take), *columns], names=["_id", "_th", "m", "seg", "first", "count", "multiple", "place", "data"]
        )


def _sorted_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans of a bucket of whole groups, by suffix arrays: one over the groups whose anchor never repeats in a run, one
    over whole bytes for the others (their anchor's bytes are taken from a run that came whole)."""
    rows = rows.reset_index(drop=True)
    anchors = {m: data[p : p + FINE] for m, data, p, many in zip(rows["m"], rows["data"], rows["place"], rows["multiple"], strict=True) if many}
    symbol = {m: 258 + k for k, m in enumerate(rows["m"].unique())}
    out = []
    for raw in (False, True):
        part = rows[rows["m"].isin(anchors) == raw]
        if not len(part):
            continue
        strings = []
        for m, data, place, many in zip(part["m"], part["data"], part["place"], part["multiple"], strict=True):
            if raw and not many:
                data = data[:place] + anchors[m] + data[place:]
            x = np.frombuffer(data, dtype=np.uint8).astype(np.int64) + 2
            strings.append(x if raw else np.r_[x[:place], symbol[m], x[place:]])
        hits = repeated_windows(strings, part["count"].tolist(), SPAN if raw else SPAN - FINE + 1)
        for k, first, hit in zip(part.index, part["first"], hits, strict=True):
            out += [(k, a, b) for a, b in spans_of(first, hit)]
    found = rows.loc[[x[0] for x in out], ["_id", "_th"]].reset_index(drop=True)
    found["a"], found["b"] = np.array([x[1] for x in out], dtype=np.int64), np.array([x[2] for x in out], dtype=np.int64)
    return found


def window_names(data: bytes, count: int, many: bool, place: int) -> list[int]:
    """A name of each window of a run; equal windows of a group have equal names. A window that holds the anchor once is
    named without it, as runs with a single anchor come without it."""
    cut = SPAN - FINE
    if not many:
        return [_name(b"%d|" % (place - i) + data[i : i + cut]) for i in range(count)]
    anchor, at = data[place : place + FINE], []
    k = data.find(anchor)
    while k >= 0:
        at.append(k)
        k = data.find(anchor, k + 1)
    out = []
    for i in range(count):
        own = [k for k in at if i <= k <= i + cut]
        out.append(_name(b"%d|" % (own[0] - i) + data[i : own[0]] + data[own[0] + FINE : i + SPAN]) if len(own) == 1 else _name(data[i : i + SPAN]))
    return out


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each window of the runs of groups too large to gather; with the group's own it names the window."""
    for batch in small(batches):
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            first, h, rows = [], [], []
            fields = [part.column(c).to_pylist() for c in ("data", "first", "count", "multiple", "place")]
            for k, (data, a, c, many, place) in enumerate(zip(*fields, strict=True)):
                h += window_names(data, c, many, place)
                first += range(a, a + c)
                rows += [k] * c
            take = pa.array(rows, pa.int64())
            columns = [part.column(n).take(take) for n in ("_id", "_th", "m")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(h, pa.int64()), pa.array(first, pa.int64())], names=["_id", "_th", "m", "w", "a"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _th, a, b: byte ranges covered by strings of SPAN bytes that also start elsewhere; ranges may overlap."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    id_type = dict(keyed.dtypes)["_id"]
    run = "array<struct<m: long, seg: long, first: long, count: long, multiple: boolean>>"
    table = stored(keyed.filter(F.octet_length("_text") >= SPAN).mapInArrow(_run_batches, f"_id {id_type}, _th long, runs {run}"), "runs")
    runs = table.select("_id", "_th", F.inline("runs"))
    groups = runs.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("least"), F.max("seg").alias("most"), F.max("multiple").alias("many"))
    groups = groups.filter("n > 1 OR many").select(F.col("m").alias("gm"), (F.col("least") != F.col("most")).alias("differs"))
    shared = stored(runs.join(groups, F.col("m") == F.col("gm")).drop("gm"), "shared-runs")

    # the same bytes again: every window repeats
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_th"), F.col("first"))).alias("at")
    segments = shared.groupBy("m", "seg").agg(F.count(F.lit(1)).alias("n"), first, F.max("count").alias("count"), F.max("multiple").alias("multiple"), F.max("differs").alias("differs"))
    copied = segments.filter("n > 1").select(F.col("m").alias("cm"), F.col("seg").alias("cs"))
    whole = shared.join(copied, (F.col("m") == F.col("cm")) & (F.col("seg") == F.col("cs")))
    whole = whole.select("_id", "_th", F.col("first").alias("a"), (F.col("first") + F.col("count") + SPAN - 1).alias("b"))

    # one text of each different run goes on
    wanted = segments.filter("differs OR multiple").groupBy(F.col("at._id").alias("_wid"), F.col("at._th").alias("_wth")).agg(F.collect_set(F.struct("at.first", "count")).alias("wanted"))
    with_text = keyed.join(wanted, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_th") == F.col("_wth"))).select("_id", "_th", "_text", "wanted")
    fine = stored(with_text.mapInArrow(_fine_batches, _FINE.format(id_type)), "fine-runs")
    kinds = fine.groupBy("m", "seg").agg(F.count(F.lit(1)).alias("n"), first, F.max("multiple").alias("multiple"))
    again = fine.join(kinds.filter("n > 1").select(F.col("m").alias("cm"), F.col("seg").alias("cs")), (F.col("m") == F.col("cm")) & (F.col("seg") == F.col("cs")))
    again = again.select("_id", "_th", F.col("first").alias("a"), (F.col("first") + F.col("count") + SPAN - 1).alias("b"))
    sizes = kinds.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.max("multiple").alias("many")).filter("kinds > 1 OR many").select(F.col("m").alias("zm"), "kinds")
    chosen = kinds.select(F.col("m").alias("cm"), F.col("seg").alias("cs"), "at").join(sizes, F.col("cm") == F.col("zm"))
    edges = fine.join(
        chosen, (F.col("m") == F.col("cm")) & (F.col("seg") == F.col("cs")) & F.col("_id").eqNullSafe(F.col("at._id")) & (F.col("_th") == F.col("at._th")) & (F.col("first") == F.col("at.first"))
    ).select("_id", "_th", "m", "first", "count", "multiple", "place", "data", "kinds")
    edges = stored(edges, "edge-runs")
    small, large = edges.filter(F.col("kinds") <= MAX_GROUP).drop("kinds"), edges.filter(F.col("kinds") > MAX_GROUP)
    n_buckets = max(1, small.count() // BUCKET_RUNS)
    by_array = small.withColumn("bucket", F.pmod(F.hash("m"), F.lit(n_buckets))).groupBy("bucket").applyInPandas(_sorted_bucket, f"_id {id_type}, _th long, a long, b long")
    windows = large.mapInArrow(_window_batches, f"_id {id_type}, _th long, m long, w long, a long")
    often = windows.groupBy("m", "w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("m").alias("om"), F.col("w").alias("ow"))
    by_hash = windows.join(often, (F.col("m") == F.col("om")) & (F.col("w") == F.col("ow"))).select("_id", "_th", "a", (F.col("a") + SPAN).alias("b"))
    return whole.unionByName(again).unionByName(by_array).unionByName(by_hash)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            size, removed, n_spans, kept, cut = [], [], [], [], []
            for t, spans in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                raw = (t or "").encode("utf-8", "replace")
                merged: list[list[int]] = []
                for x in sorted((x["a"], x["b"]) for x in spans or []):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                bounds = [0, *[v for x in merged for v in x], len(raw)]
                left = b"".join(raw[bounds[k] : bounds[k + 1]] for k in range(0, len(bounds), 2))
                size.append(len(raw))
                removed.append(len(raw) - len(left))
                n_spans.append(len(merged))
                kept.append(left)
                cut.append([{"a": a, "b": b} for a, b in merged])
            columns = [pa.array(x, pa.int64()) for x in (size, removed, n_spans)]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), *columns, pa.array(kept, pa.binary()), pa.array(cut, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                names=["_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, n_bytes, n_removed, n_spans, kept (the bytes left), spans (maximal removed ranges) of each row of docs."""
    keyed = with_key(docs, id_col, text_col).select("_id", "_th", F.col(f"`{text_col}`").alias("_text"))
    spans = repeated_spans(docs, id_col, text_col)
    spans = spans.groupBy(F.col("_id").alias("_sid"), F.col("_th").alias("_sth")).agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    both = keyed.join(spans, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left").select("_id", "_text", "spans")
    return both.mapInArrow(_cut_batches, f"_id {dict(keyed.dtypes)['_id']}, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<a: long, b: long>>")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select(F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLES: dict[str, str] = {}
