import corpus_pipeline as p
import tiktoken
import numpy as np
import public_tokenizers
from test_decontaminate import d as leaks
from test_jaccard_forest import brute as classes
from test_line_dedup import brute as lines

from skillweave.llm import bpe_replay, line_frequency


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}

    one = p.quality_rules(spark, docs, sf_dir)
    assert one.columns == names
    kept = {r["_id"] for r in line_frequency.verdicts(docs).collect() if r.kept}
    first = {r.doc_id: r.text for r in one.collect()}
    assert set(first) == kept
    for a, t in first.items():
        assert set(t.split("\n")) <= set(before[a].split("\n"))
    base = {a for a, t in before.items() if line_frequency.text_stats(t)[0] < 50}
    assert not base & kept and len(kept) > 0.5 * (len(before) - len(base))

    one = spark.createDataFrame(one.collect(), one.schema)
    two = p.dedup_lines(spark, one, sf_dir)
    assert two.columns == names
    order = sorted(first)
    gone = lines([(a, first[a]) for a in order])
    second = {r.doc_id: r.text for r in two.collect()}
    assert second == {a: "\n".join(x for i, x in enumerate(first[a].split("\n")) if i not in gone[k]) for k, a in enumerate(order)}

    two = spark.createDataFrame(two.collect(), two.schema)
    three = p.jaccard_join(spark, two, sf_dir)
    assert three.columns == names
    root, _ = classes([(a, second[a]) for a in order])
    third = {r.doc_id: r.text for r in three.collect()}
    assert set(third) == {a for k, a in enumerate(order) if root[k] == k}

    three = spark.createDataFrame(three.collect(), three.schema)
    four = p.decontaminate_benchmark(spark, three, sf_dir)
    assert four.columns == names
    items = [leaks.passage_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = set()
    for a, t in third.items():
        w = leaks.passage_words(t)
        own = set(w.tolist())
        if not any(len(own & set(i.tolist())) >= 0.5 * len(set(i.tolist())) and leaks.smith_waterman(i, w) >= 0.5 * len(i) for i in items):
            clean.add(a)
    fourth = {r.doc_id: r.text for r in four.collect()}
    assert set(fourth) == clean

    ranks = bpe_replay.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = p.run(spark, sf_dir).collect()
    assert {r.doc_id for r in last} == clean
    for r in last:
        assert np.frombuffer(bytes(r.ids), dtype="<u4").tolist() == theirs.encode_ordinary(fourth[r.doc_id])


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
