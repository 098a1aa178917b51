r"""Chat transcripts as training examples, one for every assistant turn.

A turn is written ``<|im_start|>ROLE\nTEXT<|im_end|>\n``. Inside roles and texts a backslash is doubled
and ``<|`` becomes ``<\|``; in roles a line end becomes ``<\/``. So the marks stand only where a turn
begins or ends, and every role and text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per conversation: conv_id, formatted, spans.

    ``formatted`` has all turns in order of turn (ties by role, then text; null first). ``spans`` lists
    the turns as (start, reply_start, reply_end, end, trainable), code points from 0: the turn
    is formatted[start:end], its escaped text formatted[reply_start:reply_end]; trainable marks
    assistant turns. Null roles and texts count as empty, repeated rows are turns of their own, rows
    with a null conv_id form one conversation, an empty table gives no rows. Other columns are
    ignored. A conversation has to fit in one row, as every training example does.
    """
    pieces = turns.select(
        "conv_id",
        "turn",
        escape_role(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    listed = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    written = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)),
    )
    sizes = F.transform(
        "turns",
        lambda t: F.struct(
            (F.length(t["role"]) + len(START) + 1).alias("head"),
            F.length(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("trainable"),
        ),
    )
    listed = listed.select("conv_id", F.concat_ws("", written).alias("formatted"), sizes.alias("sizes"))
    # running borders in one pass: each step appends a span that begins where the last one ended
    empty = F.array().cast("array<struct<start:int,reply_start:int,reply_end:int,end:int,trainable:boolean>>")
    spans = F.aggregate(
        "sizes",
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda done, s: F.struct(
            (done["at"] + s["head"] + s["body"] + len(END)).alias("at"),
            F.concat(
                done["spans"],
                F.array(
                    F.struct(
                        done["at"].alias("start"),
                        (done["at"] + s["head"]).alias("reply_start"),
                        (done["at"] + s["head"] + s["body"]).alias("reply_end"),
                        (done["at"] + s["head"] + s["body"] + len(END)).alias("end"),
                        s["trainable"].alias("trainable"),
                    )
                ),
            ).alias("spans"),
        ),
    )["spans"]
    return listed.select("conv_id", "formatted", spans.alias("spans"))


def examples(formatted: DataFrame) -> DataFrame:
    """Prefix-target expansion: one row per assistant turn of format_conversations().

    conv_id, example (0, 1, ...), text (all turns up to and with this one), loss_start, loss_end (code
    points from 0: only this reply is trainable) and ``whole`` (the example ends its conversation).
    A conversation that does not end with an assistant turn gives one row more, with all its turns and
    an empty loss span at its end, so that no turn is lost. The texts are cut from the formatted
    conversation row by row; nothing is gathered.
    """
    last = F.element_at("spans", -1)
    replies = F.filter("spans", lambda s: s["trainable"])
    targets = F.transform(
        replies, lambda s: F.struct(s["reply_start"].alias("a"), s["reply_end"].alias("b"), s["end"].alias("end"))
    )
    tail = F.when(
        ~last["trainable"],
        F.array(F.struct(last["end"].alias("a"), last["end"].alias("b"), last["end"].alias("end"))),
    ).otherwise(F.array().cast("array<struct<a:int,b:int,end:int>>"))
    rows = formatted.select(
        "conv_id",
        "formatted",
        last["end"].alias("n"),
        F.posexplode(F.concat(targets, tail)).alias("example", "target"),
    )
    return rows.select(
        "conv_id",
        "example",
        F.substring("formatted", F.lit(1), F.col("target.end")).alias("text"),
        F.col("target.a").alias("loss_start"),
        F.col("target.b").alias("loss_end"),
        (F.col("target.end") == F.col("n")).alias("whole"),
    )


def read_turns(text: Column) -> Column:
    """The (role, text) pairs of a formatted text, unescaped."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(
                F.substring_index(F.substring(p, F.lit(len(START) + 1), F.length(p)), "\n", 1)
            ).alias("role"),
            unescape(F.substring(p, F.instr(p, F.lit("\n")) + 1, F.length(p))).alias("text"),
        ),
    )


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the texts and loss spans of examples()."""
    reply = unescape(
        F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    )
    per_conversation = rows.select(
        "conv_id", "example", reply.alias("reply"), F.when(F.col("whole"), F.col("text")).alias("all_text"),
        F.length("text").alias("chars"),
    ).groupBy("conv_id").agg(
        F.max("all_text").alias("all_text"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"),
        F.count(F.lit(1)).alias("n_examples"),
        F.sum("chars").alias("example_chars"),
    )
    per_conversation = per_conversation.select(
        "conv_id",
        read_turns(F.col("all_text")).alias("turns"),
        F.concat_ws("", F.transform("replies", lambda r: r["reply"])).alias("loss"),
        F.length("all_text").cast("long").alias("formatted_chars"),
        "n_examples",
        "example_chars",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return per_conversation.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
        "example_chars",
    )
