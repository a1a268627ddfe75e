"""Chat formatting by prefix-target expansion, in DataFrame and SQL operations only.

Every assistant turn becomes an example: all turns up to it, formatted, with only that reply
under the loss mask. The template marks a turn as <|turn|>role<|text|>text<|end|>. Inside
roles and texts, control strings (the template's own and those of other common templates)
get a backslash after their first character; strings that look like an escaped control
string get one more, so unescaping restores every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Opening character, escapes so far, and the rest of <| , <s>, </s>, [INST] and [/INST].
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
BLOCK = "struct<turn:bigint,role:string,text:string>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def examples(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained: str = "assistant") -> DataFrame:
    """Examples of conversations given as rows by turn.

    Columns: conv_col, example (0, 1, ...), text, loss_start, loss_end (code points, end
    excluded), trainable. Turns after the last reply, or all turns of a conversation
    without any, come as one more example with trainable false and an empty mask, so no
    turn is lost. Null roles and texts count as empty; rows of a conversation with one turn
    number follow role and text, a null turn number comes first, null conversation ids are
    one conversation. Other columns are not read. A conversation's turns meet in one task,
    as its output is one text; different conversations don't. Examples repeat their context,
    so the text of a conversation's examples grows with the square of its turns.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = df.groupBy(F.col(conv_col).alias(conv_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.withColumn("parts", F.transform("turns", lambda t: F.struct((t["role"] == trained).alias("own"), F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"), escape(t["text"]).alias("body"))))
    convs = convs.withColumn("blocks", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))))
    each = convs.select(conv_col, "parts", "blocks", F.posexplode("parts").alias("i", "part")).where("part.own OR i = size(parts) - 1")
    return each.select(
        conv_col,
        F.expr("size(filter(slice(parts, 1, i), p -> p.own))").alias("example"),
        F.expr("array_join(slice(blocks, 1, i + 1), '')").alias("text"),
        F.length("part.body").alias("body"),
        F.col("part.own").alias("trainable"),
    ).select(
        conv_col,
        "example",
        "text",
        (F.length("text") - len(END) - F.when(F.col("trainable"), F.col("body")).otherwise(0)).alias("loss_start"),
        (F.length("text") - len(END)).alias("loss_end"),
        "trainable",
    )


def read_back(ex: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """turns (role, text), loss (texts under the mask, in order) and formatted_chars of each conversation, from its examples alone."""
    masked = F.when(F.col("trainable"), unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))))
    convs = ex.groupBy(conv_col).agg(
        F.max_by("text", F.struct("example", F.length("text"))).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("trainable"), F.struct("example", masked.alias("loss"))))).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    blocks = F.expr(f"slice(split(whole, '{TURN.replace('|', '[|]')}', -1), 2, size(split(whole, '{TURN.replace('|', '[|]')}', -1)) - 1)")
    turns = F.transform(blocks, lambda b: F.struct(unescape(F.substring_index(b, TEXT, 1)).alias("role"), unescape(F.substring_index(F.substring_index(b, TEXT, -1), END, 1)).alias("text")))
    return convs.select(conv_col, turns.alias("turns"), F.transform("losses", lambda x: x["loss"]).alias("loss"), "formatted_chars")


def op3_chat(spark, sf_dir: str) -> DataFrame:
    own = spark.sql("select -1L as conv_id, n as turn, role, '</s>[INST] ok [/INST]' as text from values (0L, 'user'), (1L, 'assistant') as t(n, role)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = read_back(examples(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP3_SQL = r"""
with c as (select conv_id, turn, coalesce(role,'') as role, coalesce(text,'') as text from conversations
           union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     n as (select *, row_number() over (partition by conv_id order by turn, role, text) as i, count(*) over (partition by conv_id) as k,
                  8 + length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 8
                    + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 7 as len from c),
     r as (select *, sum(len) over (partition by conv_id order by i) as upto from n)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by i), '')) as loss_sha256,
       sum(case when role = 'assistant' or i = k then upto else 0 end)::bigint as formatted_chars
from r group by conv_id
"""
