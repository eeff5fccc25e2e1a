import random

from skillweave.llm import line_frequency as q


def brute(text):
    words = text.encode().split()
    grams = {}
    for k in range(len(words) - 2):
        grams.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + j for ks in grams.values() if len(ks) > 1 for k in ks for j in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_figures_against_brute_force():
    r = random.Random(1)
    alphabet = ["a", "b", "é", " ", " ", "\n", "\t", "#", " ", "🙂", "\x0b"]
    for _ in range(300):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(80)))
        assert q.text_stats(t)[:5] == brute(t), repr(t)


def corpus(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(6))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for k in range(40):
        rows.append((k, "h1", "Accept our  Cookies now\n" + prose(30) + "\nsubscribe to the letter\n" + prose(40)))
    copy = prose(40) + "\n" + prose(40)
    rows += [(100 + k, "h1", copy) for k in range(30)]
    rows.append((200, "h1", "\n".join(["accept our cookies now", "Subscribe to the letter"] * 7 + [prose(10)])))
    rows.append((201, "h2", "accept our cookies now\n" + prose(60)))
    rows += [(300, None, None), (301, "h1", ""), (None, None, prose(60)), (302, "h1", prose(5)), (303, "h2", "x y z " * 60), (304, "h1", prose(30000))]
    rows += [(400, "h1", prose(60))] * 2
    return rows, spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, source string, text string, _id int")


def test_boilerplate_goes_and_copies_stay(spark):
    rows, df = corpus(spark)
    found = q.verdicts(df).collect()
    assert len(found) == len(rows)
    by = {r["_id"]: r for r in found}
    assert all(by[k].kept and by[k].n_removed_words == 8 for k in range(40))
    assert all(by[100 + k].kept and by[100 + k].n_removed_words == 0 for k in range(30))
    assert by[200].depleted or by[200].base_failed
    assert by[201].n_removed_words == 0
    assert [by[k].kept for k in (300, 301, None, 302, 303, 304, 400)] == [False, False, True, False, False, True, True]
    out = q.apply_quality(df)
    assert out.columns == df.columns
    texts = [(r.doc_id, r.text, r["_id"]) for r in out.collect()]
    assert {x[2] for x in texts} == {5} and sum(a == 400 for a, _, _ in texts) == 2
    assert all("Cookies" not in t for a, t, _ in texts if a is not None and a < 40)


def distinct_documents(rows):
    """host -> line -> sets of lines that hold it, by brute force."""
    found = {}
    for _, host, text in rows:
        lines = frozenset(" ".join(x.lower().split()) for x in (text or "").split("\n")) - {""}
        found.setdefault(host, set()).add(lines)
    return {host: {x: sum(x in s for s in sets) for s in sets for x in s} for host, sets in found.items()}


def test_counts_are_of_distinct_documents(spark):
    rows, df = corpus(spark)
    counts = distinct_documents(rows)
    found = {(r["_host"], r.h): r.n_docs for r in q.frequent_lines(q.document_stats(df), 0, 0.0).collect()}
    assert found == {(host, q.line_hash(x)): n for host, lines in counts.items() for x, n in lines.items()}


def test_a_block_of_lines_goes_whole_and_exact_copies_stay(spark):
    r = random.Random(5)
    prose = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(6)) for _ in range(n))
    block = "menu of the day\nimprint and terms\nall rights reserved"
    rows = [(k, "h", f"{block}\n{prose(60)}\n{block.upper()}") for k in range(200)]
    rows += [(1000 + k, "h", "a text of its own\n" + prose(1) * 60 + "\nwith a second line") for k in range(1)]
    copy = prose(50) + "\n" + prose(50)
    rows += [(2000 + k, "h", copy) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    by = {x["_id"]: x for x in q.verdicts(df).collect()}
    assert all(len(by[k].removed) == 3 and by[k].n_removed_words == 20 and by[k].kept for k in range(200))
    assert all(by[2000 + k].kept and not by[2000 + k].removed for k in range(400))
    assert all("menu" not in x.text.lower() and "rights" not in x.text.lower() for x in q.apply_quality(df).filter("doc_id < 200").collect())


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert q.verdicts(df).count() == 0 and q.apply_quality(df).count() == 0
