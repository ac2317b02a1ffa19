"""Quotation linking for conversations, in DataFrame functions.

Lines that begin with ``>`` are quoted, once per ``>``.  A passage is a line,
or a run of lines of one level without a blank one between, so that a quote
still matches where it was wrapped anew.  Passages are normalised (quote marks
off, lower case, single spaces) and hashed; a quoted passage is joined to the
first message of its conversation that has it unquoted, if that message came
earlier.  Deeper levels repeat what the quoted message quoted itself, so a
message replies to the message that its least nested passages lead to: the one
with most of them, the later one on a tie.  Reply order is given as columns:
the root of a message's thread, its depth there and its turn.

Only messages with quoted lines are joined; a text is never shuffled unless
its message quotes.  Keys hold the line's hash, so that one huge conversation
is spread over all tasks.

Defined results: null text stays null and quotes nothing; null conv_id or turn
link to nothing; repeated rows are returned each, with equal links; blank
quoted lines link to nothing; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetlake.llm.common import stage

QUOTE = r"^\s*>[\s>]*"
_RUN, _LEVEL = "\u0001", "\u0002"


def _normal(line: Column) -> Column:
    plain = F.translate(F.regexp_replace(line, QUOTE, ""), _RUN + _LEVEL, "  ")
    return F.lower(F.trim(F.regexp_replace(plain, r"\s+", " ")))


def quote_level(line: Column) -> Column:
    """How many ``>`` a line begins with."""
    head = F.regexp_extract(line, QUOTE, 0)
    return F.length(head) - F.length(F.replace(head, F.lit(">"), F.lit("")))


def passages(levels: Column, normal: Column) -> Column:
    """Distinct hashes, each with its level at the end, of a message's lines and runs of lines.

    Both arrays go line by line; runs are put together as one string, in
    which a mark and the level stand before each, so work is linear in the text.
    """
    starts = lambda x, i: (i == 0) | (x == "") | (F.get(normal, i - 1) == "") \
        | (F.get(levels, i) != F.get(levels, i - 1))
    head = lambda i: F.concat(F.lit(_RUN), F.get(levels, i).cast("string"), F.lit(_LEVEL))
    runs = F.split(F.array_join(F.transform(
        normal, lambda x, i: F.concat(F.when(starts(x, i), head(i)).otherwise(F.lit(" ")), x)), ""), _RUN, -1)
    alone = F.zip_with(levels, normal, lambda lv, x: F.struct(lv.alias("level"), x.alias("text")))
    together = F.transform(F.filter(runs, lambda x: x != ""), lambda x: F.struct(
        F.substring_index(x, _LEVEL, 1).cast("int").alias("level"), F.substring_index(x, _LEVEL, -1).alias("text")))
    # level and hash as one string: distinct strings are hashed, distinct structs are compared pair by pair
    return F.array_distinct(F.transform(F.filter(F.concat(alone, together), lambda p: p["text"] != ""), lambda p: F.concat(
        F.sha2(p["text"].cast("binary"), 256), p["level"].cast("string"))))


def _thread(links: DataFrame) -> DataFrame:
    """Root and depth of every linked message, by pointer doubling."""
    at = stage(links.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("r"),
                       F.col("depth").alias("d"))
        step = at.join(up, (F.col("conv_id") == F.col("c")) & (F.col("root") == F.col("t")), "left")
        at = stage(step.select("conv_id", "turn", F.coalesce("r", "root").alias("root"),
                               (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
                               F.col("r").isNotNull().alias("moved")), "threads")
        if not at.where("moved").limit(1).count():
            return at.drop("moved")


def link_quotes(conversations: DataFrame) -> DataFrame:
    """One row per message: its text without quotes, what it replies to, its place."""
    m = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    m = m.withColumn("lines", F.split("text", "\n", -1))
    m = m.withColumn("quoted", F.filter("lines", lambda x: quote_level(x) > 0))
    m = m.withColumn("plain", F.filter("lines", lambda x: quote_level(x) == 0))
    m = m.withColumn("n_quoted", F.coalesce(F.when(F.col("text").isNotNull(), F.size("quoted")), F.lit(0)).cast("long"))
    clean = F.when(F.col("n_quoted") > 0, F.btrim(F.array_join("plain", "\n"), F.lit(" \t\r\n"))).otherwise(F.col("text"))
    keyed = m.where("conv_id is not null and turn is not null") \
        .withColumn("levels", F.transform("lines", quote_level)).withColumn("normal", F.transform("lines", _normal)) \
        .withColumn("p", passages(F.col("levels"), F.col("normal")))
    # explode_outer: a filter inferred from explode would work out the arrays once more
    part = lambda d: d.select("conv_id", "turn", F.explode_outer("p").alias("p")).where("p is not null") \
        .select("conv_id", "turn", F.substring("p", 1, 64).alias("h"), F.substring("p", 65, 10).cast("int").alias("level"))
    quoted = stage(part(keyed.where("n_quoted > 0")).where("level > 0"), "quoted")
    base = m.select("conv_id", "turn", "role", clean.alias("clean_text"), "n_quoted",
                    F.coalesce(F.aggregate(F.col("quoted"), F.lit(0), lambda a, x: F.greatest(a, quote_level(x))),
                               F.lit(0)).alias("quote_levels"))
    lone = lambda d: d.select("*", F.lit(None).cast("bigint").alias("reply_to"),
                              F.col("turn").alias("root_turn"), F.lit(0).alias("depth"))
    if not quoted.limit(1).count():
        return lone(base)
    first = part(keyed).where("level = 0").groupBy("conv_id", "h").agg(F.min("turn").alias("source"))
    votes = quoted.join(first, ["conv_id", "h"]).where("source < turn") \
        .groupBy("conv_id", "turn", "level", "source").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("outer"), "n", "source"))
    links = stage(votes.groupBy("conv_id", "turn").agg(best["source"].alias("reply_to")), "reply-links")
    threads = _thread(links).join(links, ["conv_id", "turn"]) \
        .select("conv_id", "turn", "reply_to", F.col("root").alias("root_turn"), "depth")
    replies = base.where("n_quoted > 0").join(threads, ["conv_id", "turn"], "left") \
        .withColumn("root_turn", F.coalesce("root_turn", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
    return lone(base.where("n_quoted = 0")).unionByName(replies)
