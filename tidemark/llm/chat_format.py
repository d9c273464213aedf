"""Chat formatting with Spark expressions.

A conversation's turns are collected as structs and sorted. Adjacent turns of one role are merged into
one block by array aggregation; the texts of a block stay apart by a mark of their own. Texts and roles
are escaped, so marks stand in the output only where the template puts them and all of it can be read
back. The loss mask lists the code points of assistant texts, without marks.

Template: <|turn|>role<|says|>text[<|and|>text...]<|end|> for each block, in order.
Escape: a backslash is doubled, then <| becomes <\\|, a sequence that no doubled backslash yields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
TURN, SAYS, AND, END = "<|turn|>", "<|says|>", "<|and|>", "<|end|>"

#: Role whose texts are learned.
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def chunks(name: str) -> Column:
    """An array in chunks of about the square root of its length. Folds that grow an array copy it at each step,
    and a character is found by search from a string's start; in chunks, neither takes the square of the length."""
    size = F.greatest(F.size(name), F.lit(1))
    length = F.ceil(F.sqrt(size)).cast("int")
    return F.transform(F.sequence(F.lit(1), size, length), lambda at: F.slice(name, at, length))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learned: str = LEARNED) -> DataFrame:
    """One row for each conversation: its id, `formatted`, and `loss_spans`, structs of `start` and
    `length` in code points, one for each text of the learned role, in order.

    Turns are ordered by their number, then role and text; null numbers come first. Null roles and texts
    are empty, and very long texts stay whole. Rows of a null id are one conversation. Repeated rows and ties
    are turns of their own; which of equal turns comes first makes no difference. A conversation is one
    string, so its turns meet in one task. An empty table gives an empty result. Other columns are not read.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy(F.col(conv_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # A turn opens a block unless the turn before has its role; blocks are runs of turns.
    opens = F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].role <> turns[i - 1].role)")
    blocks = grouped.withColumn("opens", opens).select(
        conv_col,
        F.expr(
            "transform(opens, (i, k) -> named_struct('role', turns[i].role, 'texts',"
            " transform(slice(turns, i + 1, coalesce(try_element_at(opens, k + 2), size(turns)) - i), t -> t.text)))"
        ).alias("blocks"),
    )
    escaped = blocks.select(
        conv_col,
        F.transform("blocks", lambda b: F.struct(b["role"].alias("role"), escape(b["role"]).alias("name"), F.transform(b["texts"], escape).alias("texts"))).alias("blocks"),
    )
    texts = F.transform("blocks", lambda b: F.concat(F.lit(TURN), b["name"], F.lit(SAYS), F.array_join(b["texts"], AND), F.lit(END)))
    made = escaped.select(conv_col, "blocks", F.array_join(texts, "").alias("formatted"))
    head, between, tail = len(TURN) + len(SAYS), len(AND), len(END)
    # Each text is a step with the marks before and behind it.
    steps = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.lit(head) + F.char_length(b["name"])).otherwise(F.lit(between)).alias("before"),
                    F.char_length(t).alias("length"),
                    F.when(i == F.size(b["texts"]) - 1, F.lit(tail)).otherwise(F.lit(0)).alias("after"),
                    (b["role"] == F.lit(learned)).alias("learned"),
                ),
            ),
        )
    )
    width = lambda s: s["before"] + s["length"] + s["after"]

    def spans(chunk: Column, start: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(start.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
            lambda acc, s: F.struct(
                (acc["at"] + width(s)).alias("at"),
                F.when(s["learned"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["before"]).alias("start"), s["length"].alias("length"))))).otherwise(acc["spans"]).alias("spans"),
            ),
            lambda acc: acc["spans"],
        )

    sizes = F.transform("chunks", lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + width(s)))
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
    placed = made.withColumn("steps", steps).withColumn("chunks", chunks("steps")).withColumn("starts", starts)
    found = F.flatten(F.zip_with("chunks", F.slice("starts", 1, F.size("chunks")), spans))
    return placed.select(conv_col, "formatted", found.alias("loss_spans"))


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What an output of format_conversations holds: its id, `turns` (role, text) and `learned_texts`, unescaped texts under the loss mask."""
    parts = F.filter(F.split("formatted", "\\Q" + END + "\\E", -1), lambda b: b != "")
    blocks = F.transform(parts, lambda b: F.split(F.substring(b, F.lit(len(TURN) + 1), F.char_length(b)), "\\Q" + SAYS + "\\E", 2))
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(F.split(F.element_at(b, 2), "\\Q" + AND + "\\E", -1), lambda t: F.struct(unescape(F.element_at(b, 1)).alias("role"), unescape(t).alias("text"))),
        )
    )
    begin = lambda spans: F.element_at(spans, 1)["start"]
    end = lambda spans: F.element_at(spans, -1)["start"] + F.element_at(spans, -1)["length"]
    # Of each chunk of spans first the part of the output that holds them, in which a text is found with less search.
    parts_of = F.transform("chunks", lambda spans: F.struct(F.substring("formatted", begin(spans) + 1, end(spans) - begin(spans)).alias("part"), begin(spans).alias("at"), spans.alias("spans")))
    learned = F.flatten(F.transform("parts", lambda p: F.transform(p["spans"], lambda s: unescape(F.substring(p["part"], s["start"] - p["at"] + 1, s["length"])))))
    return (
        formatted.withColumn("chunks", F.filter(chunks("loss_spans"), lambda c: F.size(c) > 0))
        .withColumn("parts", parts_of)
        .select(conv_col, "formatted", turns.alias("turns"), learned.alias("learned_texts"))
    )
