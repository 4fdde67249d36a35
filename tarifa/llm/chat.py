"""Conversations formatted for training, in windows of a token budget. DataFrame functions only.

A turn costs a fixed number of tokens and one per four characters. Prefix sums over the turns of a conversation place each
turn on a grid, and the turns that begin in one cell are a window's own: windows are turn-aligned and each turn is own once.
The cell is half of what the budget leaves, so that turns of up to a cell stay within it; a window with a longer turn is
marked. Before its own turns a window repeats the system turn and the turns that began shortly before its cell. Only the
texts of own assistant turns are under the loss mask.

A conversation of any length is summed in two levels, in blocks of turn numbers and over the blocks.

A turn is written ``<s>[INST]role[/INST]text</s>``. Where a text or role holds one of these marks, or one that has been escaped,
a backslash is put behind its first character; reading takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 64
TURN_TOKENS, TOKEN_CHARS = 4, 4
#: Turn numbers summed together.
BLOCK = 64

MARKS = r"(/?s>|/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + MARKS, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + MARKS, r"$1$2$3")


def placed(turns: DataFrame) -> DataFrame:
    """Turns with ``place`` (block, number in the block) and ``begin``, the tokens of the conversation before them."""
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))
    turns = turns.withColumn("block", block).withColumn("tokens", F.ceil(F.length("text") / TOKEN_CHARS) + TURN_TOKENS)
    sums = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base")
    )
    turns = turns.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    running = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return turns.withColumn("begin", F.col("base") + running - F.col("tokens")).withColumn(
        "place", F.struct("block", F.row_number().over(inside).alias("number"))
    )


def windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, window, formatted, loss, repeated, tokens, over_budget): the windows of each conversation.

    ``loss`` lists the ranges [start, end) of characters under the mask, ``repeated`` is the number of leading turns that are
    only context. Turns are in the order of ``turn`` (NULL first), then role and text; repeated rows are turns of their own.
    NULL roles and texts are empty. Rows without conversation are one conversation. An empty table gives no windows; other
    columns are not read.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    turns = placed(turns)
    system = turns.where("role = 'system'").groupBy("conv_id")
    system = system.agg(F.min(F.struct("place", "text", "tokens")).alias("s"))
    system = system.select(F.col("conv_id").alias("c"), F.col("s"))
    turns = turns.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    left = F.lit(budget - history) - F.coalesce("s.tokens", F.lit(0))
    turns = turns.withColumn("cell", F.greatest(F.floor(left / 2), F.lit(history), F.lit(1)))
    turns = turns.withColumn("window", F.floor(F.col("begin") / F.col("cell")))
    # 0: the system turn, 1: history, 2: own
    again = F.col("begin") >= (F.col("window") + 1) * F.col("cell") - history
    uses = F.array(
        F.struct(F.col("window"), F.lit(2).alias("use")),
        F.when(again, F.struct((F.col("window") + 1).alias("window"), F.lit(1).alias("use"))),
    )
    used = turns.withColumn("u", F.explode(F.array_compact(uses))).select(
        "conv_id", F.col("u.window").alias("window"), F.col("u.use").alias("use"), "place", "role", "text", "tokens", "s"
    )
    turn_text = F.concat(F.lit("<s>[INST]"), escaped(F.col("role")), F.lit("[/INST]"), escaped(F.col("text")), F.lit("</s>"))
    item = F.struct("use", "place", turn_text.alias("written"), F.length(escaped(F.col("text"))).alias("chars"), "role", "tokens")
    grouped = used.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("use").alias("most"), F.first("s").alias("s")
    )
    grouped = grouped.where("most = 2")
    there = F.exists("items", lambda x: x["place"] == F.col("s.place"))
    first = F.array(
        F.struct(
            F.lit(0).alias("use"),
            F.col("s.place").alias("place"),
            F.concat(F.lit("<s>[INST]system[/INST]"), escaped(F.col("s.text")), F.lit("</s>")).alias("written"),
            F.length(escaped(F.col("s.text"))).alias("chars"),
            F.lit("system").alias("role"),
            F.col("s.tokens").alias("tokens"),
        )
    )
    items = F.when(F.col("s").isNotNull() & ~there, F.concat(first, "items")).otherwise(F.col("items"))
    grouped = grouped.withColumn("items", items)
    # lengths before each item, then the ranges of own assistant texts
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

    def add(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x["written"]) - len("</s>")
        mine = (x["use"] == 2) & (x["role"] == "assistant")
        span = F.array(F.struct((end - x["chars"]).alias("start"), end.alias("end")))
        return F.struct((end + len("</s>")).alias("at"), F.when(mine, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    tokens = F.aggregate("items", F.lit(0).cast("long"), lambda acc, x: acc + x["tokens"])
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("items", lambda x: x["written"]), "").alias("formatted"),
        F.aggregate("items", state, add, lambda acc: acc["found"]).alias("loss"),
        F.size(F.filter("items", lambda x: x["use"] < 2)).alias("repeated"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from the windows alone.

    Digests are over a whole conversation in order, so its text meets in one row here; the windows themselves never do.
    """
    parts = F.split("formatted", "</s>")
    own = F.slice(parts, F.col("repeated") + 1, F.size(parts) - 1 - F.col("repeated"))

    def plain(turn: Column) -> Column:
        body = F.substring_index(turn, "[/INST]", 1)
        role = F.substr(body, F.lit(len("<s>[INST]") + 1))
        text = F.substr(turn, F.length(body) + len("[/INST]") + 1)
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    masked = F.transform("loss", lambda r: unescaped(F.substr(F.col("formatted"), r["start"] + 1, r["end"] - r["start"])))
    rows = formatted.select(
        "conv_id",
        F.struct(
            "window",
            F.size(own).cast("long").alias("n"),
            F.array_join(F.transform(own, plain), "").alias("turns"),
            F.array_join(masked, "").alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    total = lambda name: F.aggregate("ws", F.lit(0).cast("long"), lambda acc, w: acc + w[name])
    text = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
