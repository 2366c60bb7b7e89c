"""Chat formatting by Spark expressions: sorted turn structs, merged roles, one text and its loss mask.

The template, where ``role`` and ``text`` are escaped:

    <s>[role]\\n text <sep> text ... </s>\\n   per run of turns of one role

``<sep>`` stands between the texts of merged turns, so they can be told apart
again. Escaping leaves no ``<``, ``[`` or ``]`` in roles and texts, hence no
control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NAMED, SEP, CLOSE = "<s>[", "]\n", "<sep>", "</s>\n"
#: What replaces each character that control strings are made of; the escape sign itself comes first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def chat(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted``.

    ``segments`` are the formatted text in pieces, ``struct<text, loss>``;
    ``loss`` marks what the role ``learn`` says, without the control strings
    around it. ``formatted`` is all pieces joined.

    Turns are ordered by turn, then role, then text, NULL first; repeated rows
    are repeated turns. Adjacent turns of one role are merged into one run.
    NULL texts and roles read as empty. Rows with NULL conv_id are one
    conversation. Other columns don't matter; an empty table gives an empty
    result. A conversation becomes one row, as its formatted text is one
    value: that, not the number of conversations, bounds a row's size.
    """
    said = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("t"))
    # Beside each turn its neighbours' roles; nothing equals the NULL at either end.
    held = held.withColumn("r", F.transform("t", lambda x: x["role"]))
    end = F.array(F.lit(None).cast("string"))
    held = held.withColumn("before", F.slice(F.concat(end, "r"), 1, F.size("r")))
    held = held.withColumn("after", F.concat(F.slice("r", 2, F.size("r")), end))
    rows = F.arrays_zip("t", "before", "after")
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(x: Column) -> Column:
        role = x["t"]["role"]
        start = F.when(x["before"].eqNullSafe(role), F.lit(SEP)).otherwise(F.concat(F.lit(OPEN), escape(role), F.lit(NAMED)))
        end = F.when(x["after"].eqNullSafe(role), F.lit("")).otherwise(F.lit(CLOSE))
        return F.array(piece(start, F.lit(False)), piece(escape(x["t"]["text"]), role == learn), piece(end, F.lit(False)))

    held = held.select("conv_id", F.flatten(F.transform(rows, pieces)).alias("segments"))
    return held.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: ``array<struct<role, text>>``."""
    runs = F.filter(F.split(formatted, CLOSE), lambda r: r != "")

    def turns(run: Column) -> Column:
        role = F.substring_index(run, NAMED, 1)
        body = F.substr(run, F.length(role) + len(NAMED) + 1)
        said = unescape(F.substr(role, F.lit(len(OPEN) + 1)))
        return F.transform(F.split(body, SEP), lambda x: F.struct(said.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(runs, turns))


def loss_text(segments: Column) -> Column:
    """What the loss mask covers, as it was said: each text once, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
