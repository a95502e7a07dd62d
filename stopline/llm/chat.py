"""Chat formatting: records of many layouts to canonical turns, one template and a loss mask.

A record's layout is known by its fingerprint: the hash of its nested field paths.
Each declared layout names where the turns are; a record is converted by the
mapping its fingerprint selects, with DataFrame operations only.

Template: each turn is `<|role|>`, line break, text, `<|end|>`, line break. Inside
roles and texts `~ < [ |` are written `~0 ~1 ~3 ~2`, so no control string of this
or other templates can occur there, and every text can be read back exactly. The
loss mask has one entry per turn: code points before the text, code points of the
escaped text, and whether the text is learnt (the assistant's).

Defined results. Null texts and roles are empty. Rows of a conversation are
ordered by turn, then role, then text; repeated rows are repeated turns. A record
of an unknown layout gets a null layout and no turns. A conversation becomes one
string, so its rows meet in one task; that is the result's own size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
_ESCAPES = [("~", "~0"), ("<", "~1"), ("|", "~2"), ("[", "~3")]
END = "<|end|>\n"


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _value(path: str) -> Column:
    return F.variant_get("_v", f"$.{path}", "string")


def _messages(path: str, role: str, text: str, renamed: dict[str, str] | None = None) -> Column:
    items = F.variant_get("_v", f"$.{path}", f"array<struct<{role}:string,{text}:string>>")
    named = renamed or {}

    def turn(x):
        name = F.coalesce(x[role], F.lit(""))
        for old, new in named.items():
            name = F.when(x[role] == old, new).otherwise(name)
        return F.struct(name.alias("role"), x[text].alias("text"))

    return F.transform(items, turn)


def _asked(*paths: str) -> Column:
    """The non-empty parts, a line break between them."""
    return F.array_join(F.filter(F.array(*map(_value, paths)), lambda p: p != ""), "\n")


# Layouts by their field paths, fields in alphabetic order, scalars written `*`.
LAYOUTS = {
    "messages": ("OBJECT<messages:ARRAY<OBJECT<content:*,role:*>>>",
                 lambda: _messages("messages", "role", "content")),
    "conversations": ("OBJECT<conversations:ARRAY<OBJECT<from:*,value:*>>>",
                      lambda: _messages("conversations", "from", "value",
                                        {"human": "user", "gpt": "assistant"})),
    "prompt_completion": ("OBJECT<completion:*,prompt:*>",
                          lambda: F.array(_turn("user", _value("prompt")),
                                          _turn("assistant", _value("completion")))),
    "prompt_response": ("OBJECT<prompt:*,response:*>",
                        lambda: F.array(_turn("user", _value("prompt")),
                                        _turn("assistant", _value("response")))),
    "instruction_output": ("OBJECT<instruction:*,output:*>",
                           lambda: F.array(_turn("user", _value("instruction")),
                                           _turn("assistant", _value("output")))),
    "instruction_input_output": ("OBJECT<input:*,instruction:*,output:*>",
                                 lambda: F.array(_turn("user", _asked("instruction", "input")),
                                                 _turn("assistant", _value("output")))),
    "system_prompt_response": ("OBJECT<prompt:*,response:*,system:*>",
                               lambda: F.array(_turn("system", _value("system")),
                                               _turn("user", _value("prompt")),
                                               _turn("assistant", _value("response")))),
}


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant, values left out."""
    shape = F.regexp_replace(F.schema_of_variant(record), " ", "")
    return F.regexp_replace(shape, r"(?<=[:<])(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9,]*\))?(?=[,>])", "*")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def canonical_turns(records: DataFrame, record: str = "record", into: str = "turns") -> DataFrame:
    """`records` with `layout` and `into`, the canonical turns of the variant column `record`."""
    step = records.withColumn("_v", F.col(record)).withColumn("_f", fingerprint(field_paths(F.col("_v"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, (paths, mapping) in LAYOUTS.items():
        mine = F.col("_f") == fingerprint(F.lit(paths))
        layout = F.when(mine, F.lit(name)).otherwise(layout)
        turns = F.when(mine, mapping().cast(TURNS)).otherwise(turns)
    return step.withColumn("layout", layout).withColumn(into, turns).drop("_v", "_f")


def escape(text: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), _ESCAPES, F.coalesce(text, F.lit("")))


def unescape(text: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[1]), F.lit(e[0])), _ESCAPES[::-1], text)


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """`df` with `formatted`, the text of the template, and `loss_mask`, one entry per turn."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit("<|"), escape(t["role"]), F.lit("|>\n")).alias("head"),
        escape(t["text"]).alias("body"),
        F.coalesce(t["role"] == "assistant", F.lit(False)).alias("learnt")))
    step = df.withColumn("_p", parts)
    return (step
            .withColumn("formatted", F.array_join(F.transform(
                "_p", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss_mask", F.transform("_p", lambda p: F.struct(
                F.length(p["head"]).alias("skip"), F.length(p["body"]).alias("take"), p["learnt"])))
            .drop("_p"))


def read_back(df: DataFrame) -> DataFrame:
    """`df` with `turns_read` and `loss_text` read from `formatted` and `loss_mask` alone."""
    pieces = F.split("formatted", r"<\|end\|>\n", -1)
    step = df.withColumn("_pieces", pieces).withColumn(
        "_pieces", F.slice("_pieces", 1, F.size("_pieces") - 1))
    parts = F.transform("_pieces", lambda p: F.split(p, r"\|>\n", 2))
    step = step.withColumn("turns_read", F.transform(parts, lambda x: F.struct(
        unescape(F.substring(x[0], 3, 1 << 30)).alias("role"), unescape(x[1]).alias("text"))))
    learnt = F.filter(F.zip_with("_pieces", "loss_mask", lambda p, m: F.when(
        m["learnt"], p.substr(m["skip"] + 1, m["take"]))), lambda x: x.isNotNull())
    return step.withColumn("loss_text", unescape(F.array_join(learnt, ""))).drop("_pieces")


def conversation_records(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv_id, record): one `messages` record per conversation of a table with a row per turn."""
    packed = rows.select(F.col(conv_id).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content")).alias("m"))
    lists = packed.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    return lists.select("conv_id", F.to_variant_object(F.struct(F.transform("m", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))).alias("record"))


def digest_rows(conversations: DataFrame) -> DataFrame:
    """One row per conversation, and for conversation -7, of what is read back from the output."""
    control = "</s>[INST] ok [/INST]"
    spark = conversations.sparkSession
    added = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.to_variant_object(F.struct(F.lit(control).alias("prompt"), F.lit(control).alias("response"))).alias("record"))
    records = conversation_records(conversations).unionByName(added)
    back = read_back(formatted(canonical_turns(records)))
    text = F.array_join(F.transform("turns_read", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns_read").cast("long").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(role) + length(regexp_replace(role, '[^~<|\\[]', '', 'g'))
      + length(text) + length(regexp_replace(text, '[^~<|\\[]', '', 'g')) + 13 AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
