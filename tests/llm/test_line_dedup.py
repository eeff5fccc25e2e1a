import random

import numpy as np

from skillweave.llm import line_dedup as d


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(docs):
    """(doc number, removed line numbers) by comparing each line with every earlier one."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0))
    seen, out, distinct = [], {}, {}
    for k in order:
        out[k] = []
        for pos, line in enumerate((docs[k][1] or "").split("\n")):
            w = tuple(line.lower().encode().split())
            if not w:
                continue
            if w in distinct or len(w) >= d.MIN_WORDS and any(len(x) >= d.MIN_WORDS and abs(len(x) - len(w)) <= 1 and len(set(x) ^ set(w)) <= 2 and distance(x, w) <= 1 for x in seen):
                out[k].append(pos)
            if w not in distinct:
                distinct[w] = True
                seen.append(w)
    return out


def made():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdef") for _ in range(3))
    base = [[word() for _ in range(n)] for n in (5, 6, 7, 11, 12, 13, 14, 30, 3)]
    docs = []
    for k in range(60):
        lines = []
        for _ in range(r.randrange(6)):
            w = list(r.choice(base))
            kind = r.randrange(5)
            at = r.randrange(len(w))
            if kind == 1:
                w[at] = word()
            elif kind == 2:
                del w[at]
            elif kind == 3:
                w.insert(at, word())
            elif kind == 4:
                w[0], w[-1] = word(), word()
            lines.append(("  " if k % 7 == 0 else " ").join(w) if w else "")
        docs.append((k, "\n".join(lines)))
    docs += [(None, " ".join(base[7])), (100, None), (101, ""), (102, "\n\n"), (103, " ".join(word() for _ in range(20000)))]
    return docs


def test_against_brute_force(spark):
    docs = made()
    df = spark.createDataFrame([(a, t, "x") for a, t in docs], "doc_id long, text string, _text string").repartition(4)
    expected = brute(docs)
    rows = {r["_id"]: r for r in d.removed_lines(df).collect()}
    assert len(rows) == len(docs)
    for k, (a, _) in enumerate(docs):
        assert rows[a].removed == expected[k], (a, rows[a].removed, expected[k])
    out = d.dedup_lines(df)
    assert out.columns == df.columns
    text = {r.doc_id: r.text for r in out.collect()}
    for k, (a, t) in enumerate(docs):
        assert text[a] == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in expected[k]))


def test_rows_that_repeat_and_empty(spark):
    line = "one two three four five six"
    df = spark.createDataFrame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in d.dedup_lines(df).collect()) == [(1, line), (1, line), (2, "")]
    assert d.removed_lines(df.limit(0)).count() == 0


def test_variants_meet_exactly_within_one_edit():
    r = random.Random(9)
    for _ in range(300):
        a, b = ([r.randrange(3) + 1 for _ in range(r.randrange(5, 8))] for _ in range(2))
        x, y = (np.array(v, dtype=np.uint64) for v in (a, b))
        near = distance(a, b) <= 1
        assert d.within_one_edit(x, y) == near
        ka, kb = (set(zip(*[v.tolist() for v in d.variant_keys(w)], strict=True)) for w in (x, y))
        met = any((k, {0: 0, 1: 2, 2: 1}[kind]) in kb for k, kind in ka)
        assert met == (near and True) or a == b


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = brute(docs)
    rows = {r.doc_id: r for r in d.op3_line_dedup(spark, sf_dir).collect()}
    assert {a: rows[a].removed for a, _ in docs} == {docs[k][0]: v for k, v in expected.items()}
