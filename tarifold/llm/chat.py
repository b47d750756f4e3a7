"""Chat formatting: conversations as budgeted training windows with a loss mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template. A text never holds "<": it is escaped, so the marks can't be forged.
OPEN, CLOSE = "<|turn|>", "<|end|>"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\b``, then ``<`` becomes ``\l``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def estimated_tokens(piece: Column) -> Column:
    """About one token per four UTF-8 bytes, one at least."""
    return F.ceil(F.octet_length(piece) / 4).cast("long")


def format_conversations(turns: DataFrame, budget: int = 512, history: int = 128,
                         tokens: Callable[[Column], Column] = estimated_tokens) -> DataFrame:
    """Windows of whole turns: ``conv_id, window, text, loss, n_context, n_turns``.

    Turns of a conversation are put in order of (turn, role, text). A leading system turn stands at the head
    of each window. Running sums of the other turns' tokens are cut into cells of ``budget``: turns
    inside one cell make a window, a turn that crosses a cell's border makes one of its own. So a
    window's new turns keep to the budget, except that one turn larger than the budget is not cut. Before them the turns
    that begin within ``history`` tokens are repeated. ``loss`` lists (start, length) in code points of the
    assistant texts that count: those of new turns; repeated ones are masked, so each counts once.
    ``n_context`` says how many leading turns of a window are repeated (system turn included).

    NULL texts and roles are empty, NULL turns come first, NULL conv_ids are one conversation; repeated
    rows are turns like others. A conversation of only a system turn is one window. An empty table gives
    an empty table. Sums and frames are window functions, which spill; a frame has at most
    ``history`` rows, so no conversation is held in memory as a whole.
    """
    order = ["turn", "role", "text"]
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    by_turn = Window.partitionBy("conv_id").orderBy(*order)
    rows = rows.withColumn("n", F.row_number().over(by_turn).cast("long"))
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit("\n"))
    body = escape(F.col("text"))
    rows = rows.select(
        "conv_id", "n", F.concat(head, body, F.lit(CLOSE)).alias("piece"), F.char_length(head).alias("head"),
        F.char_length(body).alias("body"), F.col("role").eqNullSafe("assistant").alias("answers"),
        ((F.col("n") == 1) & (F.col("role") == "system")).alias("leads"),
    ).withColumn("tokens", F.when(F.col("leads"), 0).otherwise(F.greatest(tokens(F.col("piece")), F.lit(1))))
    by_n = Window.partitionBy("conv_id").orderBy("n")
    rows = rows.withColumn("end", F.sum("tokens").over(by_n.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("start", F.col("end") - F.col("tokens"))
    cell = F.floor(F.col("start") / budget)
    crosses = F.floor((F.col("end") - 1) / budget) > cell
    # the system turn joins whatever comes first
    rows = rows.withColumn("window", F.when(F.col("leads"), F.lit(-1)).otherwise(cell * 2 + crosses.cast("int")).cast("long"))
    rows = rows.withColumn("opens", F.col("window") != F.coalesce(F.lag("window").over(by_n), F.lit(-2)))
    content = F.struct("n", "piece", "head", "body", "answers")
    # windows that open within ``history`` tokens after this turn's start
    ahead = Window.partitionBy("conv_id").orderBy("start").rangeBetween(1, history)
    later = F.collect_list(F.when(F.col("opens") & ~F.col("leads"), F.col("window"))).over(ahead)
    whole = Window.partitionBy("conv_id")
    spread = rows.select(
        "conv_id", "window", "opens", "leads", content.alias("t"),
        F.array_remove(F.array_distinct(later), F.col("window")).alias("later"),
        # the system turn, on each row that opens a window
        F.first(F.when(F.col("leads"), content), ignorenulls=True).over(by_n.rowsBetween(Window.unboundedPreceding, 0)).alias("system"),
        F.min(F.when(~F.col("leads"), F.col("window"))).over(whole).alias("lowest"),
    )
    new, old = F.lit(True).alias("new"), F.lit(False).alias("new")
    own = spread.where(~F.col("leads") | F.col("lowest").isNull()).select("conv_id", "window", new, "t")
    again = spread.where(~F.col("leads")).select("conv_id", F.explode("later").alias("window"), old, "t")
    headed = spread.where(F.col("opens") & ~F.col("leads") & F.col("system").isNotNull()).select(
        "conv_id", "window", (F.col("window") == F.col("lowest")).alias("new"), F.col("system").alias("t"))
    members = own.select("conv_id", "window", "new", "t").unionByName(again).unionByName(headed)
    lists = members.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(F.struct("t.n", "new", "t.piece", "t.head", "t.body", "t.answers"))).alias("ts"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        span = F.array(F.struct((s["at"] + t["head"]).alias("start"), t["body"].alias("length")))
        return F.struct((s["at"] + F.char_length(t["piece"])).alias("at"),
                        F.when(t["new"] & t["answers"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return lists.select(
        "conv_id", "window", F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("text"),
        F.aggregate("ts", zero, step, lambda s: s["spans"]).alias("loss"),
        F.size(F.filter("ts", lambda t: ~t["new"])).alias("n_context"), F.size("ts").alias("n_turns"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The turns in formatted windows: ``conv_id, window, turns`` (role, text of new turns, in order) and
    ``answers``, the unescaped texts under the loss mask."""
    pieces = F.split(F.col("text"), r"<\|end\|>", -1)
    fresh = F.slice(pieces, F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))

    def parse(p: Column) -> Column:
        inner = F.substring(p, F.lit(len(OPEN) + 1), F.char_length(p))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(F.url_decode(role).alias("role"),
                        unescape(F.substring(inner, F.char_length(role) + 2, F.char_length(inner))).alias("text"))

    spans = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    return windows.select("conv_id", "window", F.char_length("text").alias("chars"),
                          F.transform(fresh, parse).alias("turns"), spans.alias("answers"))
