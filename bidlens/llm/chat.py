"""Chat formatting, with DataFrame functions only.

Records come in many layouts. A record's fingerprint is the hash of its nested
field paths that hold something; it selects a declarative mapping to canonical
turns (role, text). Turns are written with a template whose control strings are
escaped inside texts, so that what was written can be read back, and with a mask
of what counts for the loss: the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.shared import unused

HEAD, END, ASSISTANT = "### ", "</turn>\n", "assistant"
TURNS = "array<struct<role string, text string>>"
#: Known fields of records; what a record lacks is null.
FIELDS = {
    "messages": "array<struct<role: string, content: string>>",
    "conversations": "array<struct<from: string, value: string>>",
    **dict.fromkeys(("system", "prompt", "completion", "response", "chosen", "instruction", "input", "output", "question", "answer"), "string"),
}
ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


def _turn(role: str, *fields: str) -> tuple[str, tuple[str, ...]]:
    return role, fields


#: Field paths of a layout -> its turns: a path of (role, text) lists, or each turn's role and the fields joined for it.
MAPPINGS: dict[tuple[str, ...], str | list[tuple[str, tuple[str, ...]]]] = {
    ("messages[].role", "messages[].content"): "messages",
    ("conversations[].from", "conversations[].value"): "conversations",
    **{("prompt", a): [_turn("user", "prompt"), _turn(ASSISTANT, a)] for a in ("completion", "response", "chosen", "output")},
    **{("system", "prompt", a): [_turn("system", "system"), _turn("user", "prompt"), _turn(ASSISTANT, a)] for a in ("completion", "response", "chosen")},
    ("instruction", "output"): [_turn("user", "instruction"), _turn(ASSISTANT, "output")],
    ("instruction", "response"): [_turn("user", "instruction"), _turn(ASSISTANT, "response")],
    ("instruction", "input", "output"): [_turn("user", "instruction", "input"), _turn(ASSISTANT, "output")],
    ("system", "instruction", "output"): [_turn("system", "system"), _turn("user", "instruction"), _turn(ASSISTANT, "output")],
    ("question", "answer"): [_turn("user", "question"), _turn(ASSISTANT, "answer")],
}


def records(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the known fields of the JSON objects in ``column``; texts that are no JSON objects have none.

    Columns that already have a known field's name are replaced.
    """
    schema = ", ".join(f"`{k}` {v}" for k, v in FIELDS.items())
    held = unused(df, "_parsed")
    parsed = df.withColumn(held, F.from_json(column, schema))
    return parsed.withColumns({k: F.col(held).getField(k) for k in FIELDS}).drop(held)


def _filled(part: str):
    return lambda x: x[part].isNotNull()


def _paths(df: DataFrame) -> Column:
    """The known field paths that hold something, sorted. Columns of other types than a field's don't count."""
    found = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, kind in FIELDS.items():
        if name not in types:
            continue
        if kind == "string":
            if types[name].typeName() == "string":
                found.append(F.when(F.col(name).isNotNull(), F.lit(name)))
            continue
        for part in ("role", "content") if name == "messages" else ("from", "value"):
            if part in getattr(getattr(types[name], "elementType", None), "names", ()):
                found.append(F.when(F.exists(name, _filled(part)), F.lit(f"{name}[].{part}")))
    return F.array_sort(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _mapped(mapping: str | list) -> Column:
    if mapping == "messages":
        turns = F.transform("messages", lambda x: F.struct(F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["content"], F.lit("")).alias("text")))
    elif mapping == "conversations":
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
        role = lambda x: F.coalesce(F.element_at(names, F.lower(x["from"])), x["from"], F.lit(""))
        turns = F.transform("conversations", lambda x: F.struct(role(x).alias("role"), F.coalesce(x["value"], F.lit("")).alias("text")))
    else:
        turns = F.array(*[F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *fields).alias("text")) for role, fields in mapping])
    return turns.cast(TURNS)


def canonical(df: DataFrame, turns: str = "turns") -> DataFrame:
    """``df`` with its records' turns, by the mapping their fingerprint selects.

    Records of no known layout, and nulls, have null turns; a list without
    elements has no path, and so no layout. Columns that are no known field are
    kept; one that has the output's name is replaced.
    """
    kept = unused(df, "_print")
    out = df.withColumn(kept, fingerprint(_paths(df)))
    choice = F.lit(None).cast(TURNS)
    fields = set(df.columns)
    for paths, mapping in MAPPINGS.items():
        if {p.partition("[")[0] for p in paths} <= fields:
            hashed = fingerprint(F.array_sort(F.array(*map(F.lit, paths))))
            choice = F.when(F.col(kept) == hashed, _mapped(mapping)).otherwise(choice)
    return out.withColumn(turns, choice).drop(kept)


def escape(text: Column) -> Column:
    r"""Backslashes are doubled, then ``</turn>`` becomes ``<\/turn>``, and a ``#`` before two more is followed by a backslash."""
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.regexp_replace(text, "#(?=##)", "#\\\\")


def unescape(text: Column) -> Column:
    text = F.replace(F.regexp_replace(text, r"#\\(?=#)", "#"), F.lit("<\\/turn>"), F.lit("</turn>"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\br>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\br>"), F.lit("\n")))


def write(df: DataFrame, turns: str = "turns", formatted: str = "formatted", mask: str = "loss_mask") -> DataFrame:
    """Adds the formatted conversation and its loss mask: (start, length) of each assistant text, in code points from 1.

    Null turns give nulls, no turns an empty text. A conversation is one cell.
    """
    head = lambda t: F.concat(F.lit(HEAD), escape_role(t["role"]), F.lit("\n"))
    written = F.transform(turns, lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("text"), (t["role"] == ASSISTANT).alias("counts")))
    parts = unused(df, "_written")
    out = df.withColumn(parts, written)
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start int, length int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        at = state["at"] + F.char_length(t["head"])
        span = F.struct(at.alias("start"), F.char_length(t["text"]).alias("length"))
        spans = F.when(t["counts"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((at + F.char_length(t["text"]) + len(END)).alias("at"), spans.alias("spans"))

    out = out.withColumn(formatted, F.array_join(F.transform(parts, lambda t: F.concat(t["head"], t["text"], F.lit(END))), ""))
    return out.withColumn(mask, F.aggregate(parts, start, add, lambda s: s["spans"])).drop(parts)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    parts = F.split(formatted, END, -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    role = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring(role(p), F.lit(len(HEAD) + 1), F.char_length(p))).alias("role"),
        unescape(F.substring(p, F.char_length(role(p)) + 2, F.char_length(p))).alias("text")))


def read_masked(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, m["start"], m["length"]))), "")


def from_rows(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations given a row per turn, as records of messages: (id, messages).

    Rows come in the order of ``turn``, null first; of equal ones, by role and text. Null
    roles and texts are empty; rows without an id form one conversation.
    """
    item = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    grouped = rows.groupBy(F.col(id)).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.select(id, F.transform("items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


CONTROL = "\\### Assistant: </turn> ok"


def digests(rows: DataFrame) -> DataFrame:
    """The contract's figures, read back from what was written, for all rows and conversation -7 of control strings."""
    extra = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(CONTROL).alias("text"))
    out = write(canonical(from_rows(rows.select("conv_id", "turn", "role", "text").union(extra))))
    out = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_masked(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>')) + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
  + length(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), chr(10), '<\br>')) + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: length(x) - 2)), 0) + 13 AS n FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
