import public_tokenizers
from pyspark.sql import functions as F

from skillweave.llm import bpe_replay
from skillweave.llm import token_rollups as r
from skillweave.llm.common import shared_folder


def test_deltas_are_additive_and_batches_idempotent(spark, tmp_path):
    rows = [("a", "en", "one two three"), ("a", "en", "one two three"), (None, "de", "x-1"), ("b", None, None), ("b", "en", "")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "source string, lang string, text string, n_docs int")
    words, fine = r.token_count(F.col("text"), "words-1"), r.token_count(F.col("text"), "pieces-1")
    shared_folder(spark)
    store = r.RollupStore(spark, f"file://{tmp_path}/s")
    store.commit("1", r.inserts(df, "words-1", words))
    before = sorted(map(str, store.totals().collect()))
    store.commit("1", r.inserts(df, "words-1", words))
    assert sorted(map(str, store.totals().collect())) == before
    store.commit("3", r.deletes(df.filter("source = 'a'"), "pieces-1", fine))
    store.commit("2", r.revisions(df, "words-1", words, "pieces-1", fine))
    store.commit("2", r.revisions(df, "words-1", words, "pieces-1", fine))
    found = {(x.source, x.lang, x.version): (x.n_docs, x.n_tokens) for x in store.totals().collect()}
    assert found == {(None, "de", "pieces-1"): (1, 3), ("b", None, "pieces-1"): (1, 0), ("b", "en", "pieces-1"): (1, 0)}
    store.commit("4", r.inserts(df.limit(0), "words-1", words))
    assert store.totals().count() == 3


def test_an_unpublished_or_replaced_attempt_does_not_count(spark, tmp_path):
    df = spark.createDataFrame([("a", "en", "x y")], "source string, lang string, text string")
    store = r.RollupStore(spark, f"file://{tmp_path}/s")
    one, two = (r.inserts(df, "words-1", F.lit(n).cast("long")) for n in (5, 7))
    store.commit("1", one)
    # a job that died after its data and before its commit row
    one.write.parquet(f"file://{tmp_path}/s/attempts/attempt=dead")
    assert [(x.n_docs, x.n_tokens) for x in store.totals().collect()] == [(1, 5)]
    store.commit("1", two)
    assert [(x.n_docs, x.n_tokens) for x in store.totals().collect()] == [(1, 7)]


def test_ledger_with_the_tokenizers_own_counts(spark, sf_dir, tmp_path):
    """Real token counts of two states of the corpus: the deltas lead from the first state's totals to the second's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text")

    def counted(df):
        ids = bpe_replay.encode(df, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
        n = F.floor(F.length("ids") / 4).cast("long").alias("n_tokens")
        return r.ledger_of(ids.select("doc_id", "source", "lang", F.lit("byte_bpe_multi_50k").alias("version"), F.lit(1).cast("long").alias("n_docs"), n))

    later = docs.filter("doc_id % 7 <> 0").withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" more of it"))).otherwise(F.col("text")))
    later = later.withColumn("lang", F.when(F.col("doc_id") % 11 == 0, F.lit(None)).otherwise(F.col("lang")))
    old, new = counted(docs), counted(later.unionByName(spark.createDataFrame([(None, None, "en", "new")], docs.schema)))
    store = r.RollupStore(spark, f"file://{tmp_path}/s")
    store.commit("2", r.ledger_deltas(old, new))
    store.commit("1", old)
    store.commit("2", r.ledger_deltas(old, new))
    expected = new.groupBy(*r.KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    assert sorted(map(str, store.totals().select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert r.ledger_deltas(new, new).count() == 0


def test_clashing_names_and_long_texts(spark, tmp_path):
    df = spark.createDataFrame([("a", "en", "w " * 300_000, "v", 9)], "source string, lang string, text string, version string, n_tokens int")
    store = r.RollupStore(spark, f"file://{tmp_path}/s")
    store.commit("1", r.inserts(df, "words-1", r.token_count(F.col("text"), "words-1")))
    assert [(x.version, x.n_tokens) for x in store.totals().collect()] == [("words-1", 300_000)]
