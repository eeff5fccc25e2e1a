import json

import pytest
from pyspark.sql import functions as F

from skillweave.llm import chat_format as c


def test_layouts_become_the_same_turns(spark):
    said = [("user", "hé <|turn|>user\n~1"), ("assistant", "</s>[INST] ok [/INST] ~0~ <|end|>\n")]
    u, a = said[0][1], said[1][1]
    records = [
        {"prompt": u, "response": a}, {"instruction": u, "output": a}, {"messages": [{"role": "user", "content": u}, {"role": "assistant", "content": a}]},
        {"conversations": [{"from": "human", "value": u}, {"from": "gpt", "value": a}]},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "json string")
    out = c.format_conversations(df).select("layout", "formatted", "turns", c.read_back(F.col("formatted")).alias("back"), "loss_spans").collect()
    assert {r.layout for r in out} == {"prompt_response", "instruction_output", "messages", "conversations"}
    for r in out:
        assert [(t.role, t.text) for t in r.back] == said
        spans = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert len(spans) == 1 and spans[0].replace("~1", "").replace("~0", "~") == a
        assert r.formatted.count("<|turn|>") == 2


def test_unknown_layouts_and_nulls(spark):
    df = spark.createDataFrame([('{"other": 1}',), ("not json",), (None,), ('{"prompt": null, "response": "x"}',)], "json string")
    out = c.format_conversations(df).collect()
    assert [r.layout for r in out] == [None, None, None, "prompt_response"]
    assert out[3].formatted == "<|turn|>user\n<|end|>\n<|turn|>assistant\nx<|end|>\n" and out[0].fingerprint is not None


def test_rows_with_nulls_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "a\nb"), (1, 1, None, "a\nb"), (None, 0, "user", "q"), (2, None, "x\ny", "z"), (3, 0, "user", "w " * 50000), (3, 1, "assistant", "é" * 50000)]
    df = spark.createDataFrame([(*r, "m") for r in rows], "conv_id long, turn long, role string, text string, ms string")
    out = {r.conv_id: r for r in c.format_conversations(c.conversation_records(df)).withColumn("back", c.read_back(F.col("formatted"))).collect()}
    assert [(t.role, t.text) for t in out[1].back] == [("user", ""), ("", "a\nb"), ("", "a\nb")]
    assert [(t.role, t.text) for t in out[2].back] == [("x\ny", "z")] and [(t.role, t.text) for t in out[None].back] == [("user", "q")]
    s = out[3].loss_spans[0]
    assert out[3].formatted[s.start : s.end] == "é" * 50000
    assert c.conversation_records(df.limit(0)).count() == 0


def test_a_record_beyond_the_reader_is_an_error(spark):
    df = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.repeat(F.lit("x"), 30_000_000).alias("text"))
    with pytest.raises(Exception, match="larger than"):
        c.format_conversations(c.conversation_records(df)).select(F.length("formatted")).collect()
    whole = c.format_conversations(c.conversation_records(df.withColumn("text", F.repeat(F.lit("x"), 16_000_000))))
    assert whole.select(F.length("formatted")).first()[0] == 16_000_000 + len("<|turn|>user\n<|end|>\n")
