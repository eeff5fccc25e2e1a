import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from skillweave.llm import bpe_replay as b

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = b.load_ranks(PATH)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


MERGES = b.Merges(RANKS)
PATTERN = regex.compile(public_tokenizers.PATTERN)


def ids(texts, cut=True):
    words = [b.cut_words(t, PATTERN, cut) for t in texts]
    assert ["".join(map(b.text_of, w)) for w in words] == texts
    solved = iter(b.solve_words([x for w in words for x in w], PATTERN, RANKS, MERGES))
    return [np.frombuffer(b"".join(next(solved) for _ in w), dtype="<u4").tolist() for w in words]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aabcdeé    ßhtn'sl1\0\n\t\x1c\x85\u00a0\u3000日本🙂"), max_size=60), max_size=6), st.booleans())
def test_words_match_the_library(texts, cut):
    assert ids(texts, cut) == [THEIRS.encode_ordinary(t) for t in texts]


def test_long_runs_and_overlapping_pairs():
    texts = ["a" * n for n in (1, 2, 3, 5, 8, 31, 1000)] + ["ab" * 777, "=" * 501, " " * 300 + "x", "\n" * 99, "aab" * 50 + "b" * 50, "0" * 64 + "1" * 65]
    assert ids(texts) == [THEIRS.encode_ordinary(t) for t in texts]


def test_table_with_nulls_and_long_texts(spark):
    long = "thation erblewh " * 20000 + "a" * 3000
    df = spark.createDataFrame([(1, None), (2, ""), (None, long), (3, "<|endoftext|> x"), (3, "<|endoftext|> x")], "doc_id long, text string")
    out = b.decode(b.encode(df.withColumn("ids", df.text), PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(out) == 5
    for r in out:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert len(r.ids) == 4 * len(THEIRS.encode_ordinary(r.text or ""))


@pytest.mark.parametrize(("head", "cut"), [(0, True), (3, True), (10_000, False)])
def test_the_head_decides_where_a_word_is_solved_not_how(spark, head, cut):
    texts = ["der the la erblewh " * 3 + str(k) for k in range(30)] + ["  two  blanks ", "x\n y", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in b.encode(df, PATH, public_tokenizers.PATTERN, cut=cut, head=head).collect():
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == THEIRS.encode_ordinary(texts[r.doc_id] or "")


def test_query_against_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = b.op4_bpe_replay(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = THEIRS.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(t)
        assert r.ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in t)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("schema", ["doc_id long, text string"])
def test_empty_table(spark, schema):
    assert b.encode(spark.createDataFrame([], schema), PATH, public_tokenizers.PATTERN).count() == 0
