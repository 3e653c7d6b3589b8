"""Chat formatting as relational expressions.

The turns of a conversation are collected as structs and sorted, adjacent turns
of one role are merged with array functions, and the parts are concatenated.
Only Spark expressions are used, for writing and for reading back.

Format: each merged turn is ``### <role>: <text></turn>\\n``; the texts of
merged turns are joined by ``<part>``. Inside roles and texts the characters
``\\ < # :`` are written as a backslash and a digit, so no control string can
occur there and the original text can be read back. The loss mask covers the
assistant texts alone: spans of (start, length) in code points, and the same
spans in bytes for slicing long outputs in linear time.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, AFTER_ROLE, PART, END = "### ", ": ", "<part>", "</turn>\n"
#: Escaped characters; the backslash is first when escaping and last when reading.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("#", "\\2"), (":", "\\3"))


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _split(text: Column, by: str) -> Column:
    return F.split(text, "\\Q" + by + "\\E", -1)


def collect_turns(turns: DataFrame) -> DataFrame:
    """conv_id and its turns: array of (turn, role, text) sorted by turn, ties by role and text."""
    text = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(text)).alias("turns"))


def merge_turns(collected: DataFrame) -> DataFrame:
    """Adds merged: array of (role, texts), one for each run of adjacent turns of one role."""
    turns = F.col("turns")
    n = F.size(turns)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get(turns, i)["role"] != F.coalesce(F.get(turns, i - 1)["role"], F.lit(""))))
    with_starts = collected.withColumn("starts", starts)
    merged = F.transform("starts", lambda s, i: F.struct(
        F.get(turns, s)["role"].alias("role"),
        F.transform(F.slice(turns, s + 1, F.coalesce(F.get("starts", i + 1), n) - s), lambda t: t["text"]).alias("texts")))
    return with_starts.withColumn("merged", merged).drop("starts")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length in code points) and loss_bytes (the same in bytes).

    Null role and null text count as empty; a null conv_id is a conversation
    of its own; repeated rows are repeated turns; ties of turn are put in the
    order of role and text. Other columns are not read. One conversation is one
    row, so it must fit a row.
    """
    escaped = merge_turns(collect_turns(turns)).select("conv_id", F.transform("merged", lambda m: F.struct(
        (m["role"] == "assistant").alias("loss"),
        F.concat(F.lit(TURN), escape(m["role"]), F.lit(AFTER_ROLE)).alias("head"),
        F.transform(m["texts"], escape).alias("texts"))).alias("merged"))
    # The formatted conversation as alternating literal pieces and texts.
    piece = F.flatten(F.transform("merged", lambda m: F.transform(m["texts"], lambda t, i: F.struct(
        F.when(i == 0, m["head"]).otherwise(F.lit(PART)).alias("before"), t.alias("text"),
        F.when(i == F.size(m["texts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("after"), m["loss"].alias("loss")))))
    pieces = escaped.select("conv_id", piece.alias("pieces"))

    def spans(size) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("at"),
                        F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)").alias("spans"))

        def step(acc, p):
            start, length = acc["at"] + size(p["before"]), size(p["text"])
            span = F.array(F.struct(start.cast("bigint").alias("start"), length.cast("bigint").alias("length")))
            return F.struct((start + length + size(p["after"])).cast("bigint").alias("at"),
                            F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
        return F.aggregate("pieces", zero, step, lambda acc: acc["spans"])

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), "").alias("formatted"),
        spans(F.char_length).alias("loss_spans"), spans(F.octet_length).alias("loss_bytes"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) and loss_text, from formatted and loss_bytes alone."""
    runs = F.transform(F.filter(_split(F.col("formatted"), END), lambda x: x != ""), lambda x: F.struct(
        F.substring_index(F.substr(x, F.lit(len(TURN) + 1)), AFTER_ROLE, 1).alias("role"), x.alias("all")))
    texts = F.transform(runs, lambda r: F.struct(
        unescape(r["role"]).alias("role"),
        _split(F.substr(r["all"], F.char_length(r["role"]) + len(TURN) + len(AFTER_ROLE) + 1), PART).alias("texts")))
    turns = F.flatten(F.transform(texts, lambda r: F.transform(
        r["texts"], lambda t: F.struct(r["role"].alias("role"), unescape(t).alias("text")))))
    raw = F.col("formatted").cast("binary")
    loss = F.transform("loss_bytes", lambda s: F.substring(raw, s["start"] + 1, s["length"]).cast("string"))
    return formatted.select("conv_id", "formatted", turns.alias("turns"),
                            F.array_join(F.transform(loss, unescape), "").alias("loss_text"))
