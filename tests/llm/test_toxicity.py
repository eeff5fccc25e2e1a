import random
import zlib

import numpy as np

from skillweave.llm import toxicity as x


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_documents_are_told_apart(spark):
    r = random.Random(1)
    rows, labels = [], []
    for k in range(600):
        bad = k % 7 == 0
        words = [r.choice(["the", "of", "and", "to", "a", "in"]) if r.random() < 0.6 else f"w{r.randrange(3000)}" for _ in range(r.randrange(20, 200))]
        if bad:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "moron"]))
        rows.append((k, " ".join(words), "z"))
        labels.append((k, int(bad)))
    rows += [(None, "idiot moron", "z"), (1000, None, "z"), (1001, "", "z"), (1002, "the " * 30000, "z"), (0, rows[0][1], "z")]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, _text string"), spark.createDataFrame(labels + [(1, None), (0, 1)], "doc_id long, toxic int")
    out = x.score_toxicity(docs, marks).collect()
    assert len(out) == len(rows) and all(0 <= o.score <= 1 and o.predicted == int(o.score >= 0.5) for o in out)
    by = {o["_id"]: o for o in out}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(by[k].held_out for k in held) and not by[None].held_out
    assert auc(np.array([by[k].score for k in held]), np.array([labels[k][1] for k in held])) > 0.97


def test_labels_of_the_held_out_fold_are_not_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(x.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({o["_id"]: o.score for o in x.score_toxicity(docs, t).collect()} for t in (labels, flipped))
    assert a == b


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [o.predicted for o in x.score_toxicity(docs, labels).collect()] == [0, 0]
    assert x.score_toxicity(docs.limit(0), labels).count() == 0


def brute_model(texts):
    """Log-likelihood difference of every known word and bigram from plain dictionaries."""
    pairs, follows = {}, {"t": {}, "o": {}}
    for text, toxic in texts:
        w = ["", *text.split()]
        for a, b in {(w[k], w[k + 1]) for k in range(len(w) - 1)}:
            pairs.setdefault((a, b), {"t": 0, "o": 0})["t" if toxic else "o"] += 1
            follows["t" if toxic else "o"].setdefault(b, set()).add(a)
    seen = {}
    for (_, b), n in pairs.items():
        seen[b] = seen.get(b, 0) + n["t"] + n["o"]
    words = {b: {c: len(follows[c].get(b, ())) for c in "to"} for b, n in seen.items() if n >= 2}
    total = {c: sum(n[c] for n in words.values()) for c in "to"}
    kinds = {c: sum(n[c] > 0 for n in words.values()) for c in "to"}
    prior = x.STRENGTH * min(total.values())
    out, ratio = {}, {}
    for b, n in words.items():
        shared = (n["t"] + n["o"]) / sum(total.values())
        ratio[b] = {c: (max(n[c] - x.DISCOUNT, 0) / shared + x.DISCOUNT * kinds[c] + prior) / (total[c] + prior) for c in "to"}
        out[(b,)] = np.log(ratio[b]["t"] / ratio[b]["o"])
    for (a, b), n in pairs.items():
        if a and n["t"] + n["o"] >= 2:
            context = {c: sum(m[c] for (p, _), m in pairs.items() if p == a) for c in "to"}
            different = {c: sum(m[c] > 0 for (p, _), m in pairs.items() if p == a) for c in "to"}
            prior = x.STRENGTH * min(context.values()) + 1
            pooled = (n["t"] + n["o"]) / sum(context.values())
            p = {c: (max(n[c] - x.DISCOUNT, 0) + (x.DISCOUNT * different[c] + prior) * pooled * ratio[b][c]) / (context[c] + prior) for c in "to"}
            out[a, b] = np.log(p["t"] / p["o"])
    return out


def test_probabilities_and_figures_against_brute_force(spark):
    r = random.Random(6)
    texts = [(" ".join(r.choice("abcdefghij" if k % 3 else "hijklm") for _ in range(r.randrange(1, 30))), int(k % 3 == 0)) for k in range(60)]
    expected = brute_model(texts)
    model = x.fit_model(spark.createDataFrame([(t, b) for t, b in texts], "_text string, _toxic int").select("_toxic", "_text"))
    key = lambda g: (x.word_keys(x.words_of(g[0])) if len(g) == 1 else x.bigram_keys(x.words_of(" ".join(g)))).view(np.int64)[0]
    found = {m.k: m.v for m in model.collect()}
    assert len(found) == len(expected) and all(abs(found[key(g)] - v) < 1e-9 for g, v in expected.items())

    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)] + [(99, "zz zz"), (100, None)], "doc_id long, text string")
    for d in x.figures(docs, model, "doc_id", "text").collect():
        w = (dict(enumerate(texts)).get(d["_id"], ("zz zz" if d["_id"] == 99 else "",))[0]).split()
        each = [expected.get((w[k - 1], w[k]) if k else None, expected.get((w[k],), 0.0)) for k in range(len(w))]
        top = sorted(each)[-max(1, int(len(w) * x.TOP_SHARE)) :]
        assert abs(d["_all"] - (np.mean(each) if w else 0.0)) < 1e-9 and abs(d["_top"] - (np.mean(top) if w else 0.0)) < 1e-9


def test_every_ngram_of_two_documents_is_in_the_model(spark):
    # more words than the former bound of the model, all but one in three documents
    common = [(k, " ".join(f"w{k // 3}x{i}" for i in range(1000)), 0) for k in range(480)]
    rows = spark.createDataFrame(common + [(k, "vile", 1) for k in (900, 901)], "id long, _text string, _toxic int").select("_toxic", "_text")
    model = {r.k: r.v for r in x.fit_model(rows).collect()}
    assert len(model) == 160 * (1000 + 999) + 1
    vile = x.word_keys(x.words_of("vile")).view(np.int64)[0]
    assert model[vile] > 0 and max(v for k, v in model.items() if k != vile) < model[vile]


def test_the_head_decides_only_where_an_ngram_is_looked_up(spark, sf_dir, monkeypatch):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(docs.limit(20))
    scores = []
    for most, bits in ((x.HEAD_NGRAMS, 27), (2000, 27), (2000, 19), (0, 27)):
        monkeypatch.setattr(x, "HEAD_NGRAMS", most)
        monkeypatch.setattr(x, "FILTER_BITS", bits)
        scores.append(sorted((o["_id"], o.score) for o in x.score_toxicity(docs, labels).collect()))
    for other in scores[1:]:
        assert [a for a, _ in other] == [a for a, _ in scores[0]] and np.allclose([b for _, b in other], [b for _, b in scores[0]])
