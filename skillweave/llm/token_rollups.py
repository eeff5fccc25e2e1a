"""Token counts as delta-maintained rollups.

A change is (batch, document, kind, source, lang, version, count): an insert adds its count, a delete takes back what the
document had, a revision takes back the old count and adds the new one. Changes become signed deltas, are summed by
(source, lang, tokenizer version) and committed per batch. Totals are the sum over all committed batches: additive, so batches
may come in any order.

A commit is idempotent and never leaves a batch half there: each attempt is written to a folder of its own, and then published
by one small row that names it; of several published attempts of a batch the last counts. A job that dies before that row
leaves the earlier state as it was. Where the old counts aren't at hand, `ledger_deltas` takes them from the ledger: the counts
by document that the batches before left behind.

Defined results: a null text has no tokens; null sources, languages and ids group as nulls; rows that repeat are documents
of their own (in the ledger a document is its id; of several rows of one id the counts are added); groups whose documents are
all gone are left out of the totals; a text of any length is counted whole; an empty table gives empty totals; of input columns
only source and lang are read, so others may have any name.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm.common import shared_folder

KEYS = ("source", "lang", "version")
DELTA = "source string, lang string, version string, n_docs long, n_tokens long"

#: Tokenizer versions that this module can count: words between white space; runs of letters, of digits, or single signs.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-1": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]"}


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def inserts(docs: DataFrame, version: str, count: Column) -> DataFrame:
    return docs.select(*KEYS[:2], F.lit(version).alias("version"), F.lit(1).cast("long").alias("n_docs"), count.alias("n_tokens"))


def deletes(docs: DataFrame, version: str, count: Column) -> DataFrame:
    return docs.select(*KEYS[:2], F.lit(version).alias("version"), F.lit(-1).cast("long").alias("n_docs"), (-count).alias("n_tokens"))


def revisions(docs: DataFrame, old: str, old_count: Column, new: str, new_count: Column) -> DataFrame:
    """Both sides of each revision from one pass over docs."""
    side = lambda v, n, c: F.struct(F.lit(v).alias("version"), F.lit(n).cast("long").alias("n_docs"), c.alias("n_tokens"))
    both = docs.select(*KEYS[:2], F.explode(F.array(side(old, -1, -old_count), side(new, 1, new_count))).alias("d"))
    return both.select(*KEYS[:2], "d.version", "d.n_docs", "d.n_tokens")


LEDGER = ("doc_id", *KEYS)


def ledger_of(counted: DataFrame) -> DataFrame:
    """doc_id, source, lang, version, n_docs, n_tokens: the documents that a state holds, from its counted rows."""
    return counted.groupBy(*LEDGER).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def ledger_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed deltas that turn the old ledger into the new one: what is gone or changed is taken back as it was counted, what
    is new or changed is added. Both sides are summed by document, so no key meets another's rows."""
    taken = old.withColumns({"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")})
    change = taken.select(*LEDGER, "n_docs", "n_tokens").unionByName(new.select(*LEDGER, "n_docs", "n_tokens"))
    return ledger_of(change).filter("n_docs <> 0 OR n_tokens <> 0").drop("doc_id")


class RollupStore:
    """Committed batches under one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def commit(self, batch: str, deltas: DataFrame) -> None:
        """Sums the deltas into a new folder, then publishes it as the batch's state."""
        attempt = uuid.uuid4().hex
        summed = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        summed.write.parquet(f"{self.folder}/attempts/attempt={attempt}")
        row = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), F.lit(time.time_ns()).alias("at"))
        row.write.mode("append").parquet(f"{self.folder}/commits")

    def totals(self) -> DataFrame:
        """Attempts that nobody published, or that a later one of their batch replaced, don't count."""
        commits = self.spark.read.schema("batch string, attempt string, at long").parquet(f"{self.folder}/commits")
        live = commits.groupBy("batch").agg(F.max_by("attempt", "at").alias("live")).select("live")
        deltas = self.spark.read.schema(f"{DELTA}, attempt string").parquet(f"{self.folder}/attempts")
        out = deltas.join(live, F.col("attempt") == F.col("live")).groupBy(*KEYS)
        return out.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0 OR n_tokens <> 0")


def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents: inserts counted by words; a recount of all by pieces; deletes of the documents
    under 50 words; and the recount delivered a second time, which must change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", "lang", "text")
    words, fine = token_count(F.col("text"), "words-1"), token_count(F.col("text"), "pieces-1")
    store = RollupStore(spark, f"{shared_folder(spark)}/token-rollups-{uuid.uuid4().hex}")
    store.commit("0001", inserts(docs, "words-1", words))
    recount = revisions(docs, "words-1", words, "pieces-1", fine)
    store.commit("0002", recount)
    store.commit("0003", deletes(docs.filter(words < 50), "pieces-1", fine))
    store.commit("0002", recount)
    return store.totals()


OP5_SQL = r"""
WITH d AS (SELECT source, lang, coalesce(text, '') AS text FROM documents)
SELECT source, lang, 'pieces-1' AS version, count(*) AS n_docs,
  CAST(sum(len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]'))) AS BIGINT) AS n_tokens
FROM d WHERE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) >= 50 GROUP BY source, lang
"""

QUERIES = {"op5_token_rollups": op5_token_rollups}
ORACLES = {"op5_token_rollups": OP5_SQL}
