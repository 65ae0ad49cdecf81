"""Operator 3: relational chat formatting with Spark expressions only.

Turns are collected and sorted per conversation; adjacent turns of one role share a block and stay apart by a separator.
``&``, ``<|`` inside texts are escaped reversibly, so control strings appear only as marks. Null texts and roles count as
empty; turns that tie are ordered by role and text, and rows that repeat are turns of their own; null conversation ids form one
conversation; a conversation, however long, is one row of the output; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) of every conversation."""
    role = F.replace(escape(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"), F.lit("&nl;"))
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), escape(F.coalesce(F.col("text"), F.lit(""))).alias("text")).alias("t"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    before = F.slice(F.concat(F.array(F.lit(None).cast("struct<turn:bigint,role:string,text:string>")), F.transform("ts", lambda t: F.struct(t["turn"].cast("long").alias("turn"), t["role"].alias("role"), t["text"].alias("text")))), 1, F.size("ts"))
    piece = lambda t, p: F.concat(
        F.when(p.isNull(), F.concat(F.lit(START), t["role"], F.lit("\n"))).when(p["role"] == t["role"], F.lit(SEP)).otherwise(F.concat(F.lit(END + START), t["role"], F.lit("\n"))),
        t["text"],
    )
    return rows.select("conv_id", F.concat(F.array_join(F.zip_with("ts", before, piece), ""), F.lit(END)).alias("formatted"))


def parse(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns array<struct<role,text>>) read back from the output."""
    blocks = F.filter(F.split("formatted", "<\\|im_start\\|>"), lambda b: b != "")

    def turns(b):
        cut = F.instr(b, "\n")
        role = unescape(F.replace(F.substring_index(b, "\n", 1), F.lit("&nl;"), F.lit("\n")))
        body = F.substr(b, cut + 1, F.length(b) - cut - len(END))
        return F.transform(F.split(body, "<\\|im_sep\\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"))


def digests(formatted: DataFrame) -> DataFrame:
    p = parse(formatted)
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    p = p.select("conv_id", "formatted", "turns", loss.alias("loss"))
    return p.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digests_sql(turns: str) -> str:
    """``digests`` of a query's conv_id, turn, role, text in SQL; the length of the output follows from what is escaped and marked."""
    longer = "length({0}) + 4 * (length({0}) - length(replace({0}, '&', ''))) + 3 * ((length({0}) - length(replace({0}, '<|', ''))) // 2)"
    marks = f"CASE WHEN role = lag(role) OVER w THEN {len(SEP)} ELSE {len(START) + 1 + len(END)} + {longer.format('role')} + 3 * (length(role) - length(replace(role, chr(10), ''))) END"
    return f"""WITH s AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({turns}) q),
        t AS (SELECT *, {longer.format("text")} + {marks} AS chars FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id"""
