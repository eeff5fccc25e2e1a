"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records arrive as JSON in many layouts. The nested field paths of a record (types left out) are hashed to a fingerprint;
a declarative mapping for that fingerprint says where roles and texts are. All layouts become canonical turns, which a
template turns into one training text with a loss mask over the assistant's texts.

Template: each turn is `<|turn|>ROLE\\nTEXT<|end|>\\n`. Control strings inside roles and texts are broken up reversibly:
`~` becomes `~0`, then a control string gets `~1` after its first character, then (roles only) a line feed becomes `~2`.

Defined results: a null text or role is empty; turns are ordered by number, then role, then text, nulls first, and rows
that repeat are turns of their own; a null conversation id is one conversation; a record whose fingerprint has no
mapping comes back with null turns and its fingerprint, never silently dropped; an empty table gives an empty result; the added
columns replace input columns of the same name. A record is one value, so a conversation has to fit in a row; texts are whole up
to the 20 million characters that Spark's JSON reader takes in one string, and a record beyond its limits is an error, not a null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Characters from which a record that can't be parsed is taken to be too large, not broken.
LARGE_RECORD = 15_000_000
#: Strings that steer known chat templates, as one Java pattern with the first character apart.
CONTROL = r"([<\[])(\|(?:turn|end|im_start|im_end|system|user|assistant|endoftext)\||/?s>|/?INST\]|</?SYS>>|</SYS>>)"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: the field paths that it has, and SQL over the parsed record `r`."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str


#: Declarative mappings; a new layout is a new entry.
MAPPINGS = (
    Mapping("prompt_response", ("prompt", "response"), "prompt string, response string",
            "array(struct('user' AS role, r.prompt AS text), struct('assistant' AS role, r.response AS text))"),
    Mapping("instruction_output", ("instruction", "output"), "instruction string, output string",
            "array(struct('user' AS role, r.instruction AS text), struct('assistant' AS role, r.output AS text))"),
    Mapping("instruction_input_output", ("input", "instruction", "output"), "instruction string, input string, output string",
            "array(struct('system' AS role, r.instruction AS text), struct('user' AS role, r.input AS text), struct('assistant' AS role, r.output AS text))"),
    Mapping("messages", ("messages[].content", "messages[].role"), "messages array<struct<role: string, content: string>>",
            "transform(r.messages, m -> struct(m.role AS role, m.content AS text))"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), "conversations array<struct<`from`: string, value: string>>",
            "transform(r.conversations, m -> struct(CASE m.`from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.`from` END AS role, m.value AS text))"),
)


def shape(paths: tuple[str, ...]) -> str:
    """The canonical text of a record's field paths, as `fingerprint` derives it from data."""
    lists: dict[str, list[str]] = {}
    plain: list[str] = []
    for p in paths:
        if "[]." in p:
            head, tail = p.split("[].")
            lists.setdefault(head, []).append(tail)
        else:
            plain.append(p)
    parts = {p: f"{p}: _" for p in plain} | {h: f"{h}: ARRAY<OBJECT<{', '.join(f'{t}: _' for t in sorted(ts))}>>" for h, ts in lists.items()}
    return f"OBJECT<{', '.join(parts[k] for k in sorted(parts))}>"


def shape_of(json: Column) -> Column:
    """The field paths of a JSON record, scalars' types left out; null for text that isn't JSON."""
    too_large = F.raise_error(F.lit("a conversation is larger than the JSON reader takes")).cast("string")
    kind = F.coalesce(F.schema_of_variant(F.try_parse_json(json)), F.when(F.length(json) > LARGE_RECORD, too_large))
    return F.regexp_replace(kind, r"\b(?:STRING|BIGINT|VOID|BOOLEAN|DOUBLE|VARIANT|DATE|TIMESTAMP|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "_")


def fingerprint(json: Column) -> Column:
    return F.xxhash64(shape_of(json))


def canonical_turns(records: DataFrame, json_col: str = "json", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds fingerprint, layout and turns. Parsing follows the fingerprint, each record by its own mapping."""
    out = records.withColumn("fingerprint", fingerprint(F.col(json_col)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in mappings:
        is_it = F.col("fingerprint") == F.xxhash64(F.lit(shape(m.paths)))
        parsed = F.expr(f"transform(array(from_json(`{json_col}`, '{m.schema}')), r -> {m.turns})")
        layout = F.when(is_it, F.lit(m.name)).otherwise(layout)
        turns = F.when(is_it, parsed[0].cast(TURNS)).otherwise(turns)
    return out.withColumns({"layout": layout, "turns": turns})


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("~"), F.lit("~0")), CONTROL, "$1~1$2")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def formatted(turns: Column) -> Column:
    def one(t: Column) -> Column:
        role = F.replace(escape(F.coalesce(t["role"], F.lit(""))), F.lit("\n"), F.lit("~2"))
        return F.concat(F.lit(OPEN), role, F.lit("\n"), escape(F.coalesce(t["text"], F.lit(""))), F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def pieces(text: Column) -> Column:
    """The turns of a formatted text, still escaped: its parts between CLOSE marks, without the empty last one."""
    return F.filter(F.split(text, r"<\|end\|>\n"), lambda x: F.startswith(x, F.lit(OPEN)))


def read_back(text: Column) -> Column:
    """The turns as the formatted text holds them."""

    def one(x: Column) -> Column:
        body = F.substr(x, F.lit(len(OPEN) + 1))
        head = F.substring_index(body, "\n", 1)
        role = F.replace(head, F.lit("~2"), F.lit("\n"))
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.length(head) + 2)).alias("text"))

    return F.transform(pieces(text), one)


def loss_spans(text: Column) -> Column:
    """array<struct<start, end>>: spans of the assistant's texts in the formatted text, in characters from 0, end excluded."""
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(state: Column, x: Column) -> Column:
        head = F.length(F.substring_index(x, "\n", 1)).cast("long")
        start, end = state["at"] + head + 1, state["at"] + F.length(x)
        ours = F.startswith(x, F.lit(f"{OPEN}assistant\n"))
        span = F.array(F.struct(start.alias("start"), end.cast("long").alias("end")))
        return F.struct((end + len(CLOSE)).cast("long").alias("at"), F.when(ours, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pieces(text), begin, step, lambda s: s["spans"])


def conversation_records(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, json: rows by turn as JSON records in the layout that fits them, as collections of chats mix them: a user
    and an assistant as prompt and response, a system text before them as instruction and input, others as messages."""
    clean = rows.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("content")).alias("m"),
    )
    grouped = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    roles = F.transform("ms", lambda m: m["role"])
    text = lambda k: F.col("ms")[k]["content"]
    pair = F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response")))
    told = F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output")))
    chat = F.to_json(F.struct(F.transform("ms", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")))
    words = lambda *x: F.array(*[F.lit(r) for r in x])
    json = F.when(roles == words("user", "assistant"), pair).when(roles == words("system", "user", "assistant"), told).otherwise(chat)
    return grouped.select("conv_id", json.alias("json"))


def format_conversations(records: DataFrame, json_col: str = "json") -> DataFrame:
    """records with fingerprint, layout, turns, formatted text and loss_spans."""
    out = canonical_turns(records, json_col).withColumn("formatted", formatted(F.col("turns")))
    return out.withColumn("loss_spans", loss_spans(F.col("formatted")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"),
    )
    out = format_conversations(conversation_records(rows.unionByName(extra)))
    back = F.col("back")
    said = F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return out.withColumns({"back": read_back(F.col("formatted")), "loss": loss}).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = "regexp_replace(replace({0}, '~', '~0'), '{1}', '\\1~1\\2', 'g')"
OP8_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum({len(OPEN) + len(CLOSE) + 1} + length({_ESCAPED.format('role', CONTROL)}) + length({_ESCAPED.format('text', CONTROL)})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

QUERIES = {"op8_chat_format": op8_chat_format}
ORACLES = {"op8_chat_format": OP8_SQL}
