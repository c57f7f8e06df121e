"""Chat formatting in budgeted, turn-aligned windows.

Prefix sums of the turns' tokens place each turn on its conversation's token line, which
is cut into stretches of the budget. The turns that lie within a stretch are one span;
a turn across the border of two stretches is a span of its own, so that spans keep to
the budget unless a single turn exceeds it. A window holds the system turn, a limited
history before the span, and the span. A system turn of over half of the budget stands
whole in a first window of its own and is not repeated, so that the output stays in
proportion to the input. Repeated turns are masked: only a span's own
assistant texts are targets, so each is one exactly once.

Everything is built-in expressions. Prefix sums are taken in blocks of turns, then over
blocks, so that a very long conversation is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# The template. A turn is OPEN role newline text CLOSE.
OPEN, CLOSE = "<s>", "</s>"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
# A control string in a text gets one more backslash after its first character.
CONTROL, ESCAPED = r"<(\\*)(/?)s>", r"<\\(\\*)(/?)s>"

WINDOW_TOKENS = 1024
HISTORY_TOKENS = 256
SYSTEM_PART = 2  # a system turn over this part of the budget is not repeated
TURN_TOKENS = 4  # the template's share of a turn
BLOCK = 1024  # turns whose prefix sums are taken together
# What counts as a token: up to six letters or digits, or another visible character.
TOKEN = r"[\p{L}\p{N}]{1,6}|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"<\\$1$2s>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "<$1$2s>")


def token_count(text: Column) -> Column:
    """A tokenizer-free estimate of a turn's tokens with its part of the template."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint") + TURN_TOKENS


def place_turns(
    turns: DataFrame, conv_id: str, turn: str, role: str, text: str, budget: int, history: int
) -> DataFrame:
    """Stored turns with their position, token line start and span.

    (key, conv_id, pos, role, text, start, span, room, is_system, recurs): ``room`` is the
    length of the conversation's stretches, ``recurs`` says that a system turn is repeated in
    every window. Turns are ordered by turn, nulls first; ties by role
    and text.
    """
    ident = F.col(f"`{conv_id}`")
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), ident.cast("string")), F.lit("?")).alias("key"),
        ident.alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        words.alias("text"),
        token_count(words).alias("tokens"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]

    first = F.struct(F.coalesce("turn", F.lit(-(1 << 62))), "role", "text")
    system = F.when(F.col("role") == SYSTEM_ROLE, F.col("tokens")).otherwise(0)
    heads = rows.groupBy("key").agg(F.min_by(system, first).alias("system_tokens"))
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("key", "block")
        .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("turns"))
        .select(
            "key",
            "block",
            F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("tokens_before"),
            F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        )
        .join(heads, "key")
    )
    within = Window.partitionBy("key", "block").orderBy(*order)
    before = F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, -1))
    line = F.coalesce(before, F.lit(0)) + F.col("tokens_before")
    # A long system turn is said once, in a window of its own; others are in every window.
    recurs = F.col("system_tokens") <= budget // SYSTEM_PART
    room = budget - history - F.when(recurs, F.col("system_tokens")).otherwise(0)
    placed = (
        rows.join(blocks, ["key", "block"])
        .withColumn("pos", F.row_number().over(within) - 1 + F.col("turns_before"))
        .withColumn("line", line)
        .withColumn("next_tokens", F.lead("tokens").over(within))
        .withColumn("is_system", (F.col("pos") == 0) & (F.col("system_tokens") > 0))
        .withColumn("recurs", F.col("is_system") & recurs)
        .withColumn("room", room)
        # The system turn takes no part in the token line.
        .withColumn(
            "start", F.when(F.col("is_system"), 0).otherwise(F.col("line") - F.col("system_tokens"))
        )
    )
    stretch = F.floor(F.col("start") / F.col("room"))
    tokens = F.when(F.col("is_system"), F.coalesce("next_tokens", F.lit(1))).otherwise(F.col("tokens"))
    across = F.floor((F.col("start") + tokens - 1) / F.col("room")) > stretch
    return stored(
        placed.select(
            "key",
            "conv_id",
            "pos",
            "role",
            "text",
            "start",
            F.when(F.col("is_system") & ~F.col("recurs"), F.lit(-1).cast("bigint"))
            .otherwise(2 * stretch + across.cast("bigint"))
            .alias("span"),
            "room",
            "is_system",
            "recurs",
        ),
        "placed-turns",
    )


def _members(placed: DataFrame, history: int) -> DataFrame:
    """Turns with the windows they are in: their own span's, and those they repeat in."""
    spans = (
        placed.groupBy("key", "span")
        .agg(F.min(F.when(~F.col("is_system"), F.col("start"))).alias("begins"))
    )
    # Only the spans that may begin within the history's reach: at most a handful.
    last = 2 * F.floor((F.col("start") + history) / F.col("room")) + 1
    reach = (
        placed.filter(~F.col("is_system") & (last > F.col("span")))
        .select("key", "pos", "start", F.explode(F.sequence(F.col("span") + 1, last)).alias("span"))
    )
    again = F.xxhash64("key", "span").alias("_hash")
    recalled = (
        reach.select("*", again)
        .join(spans.select("*", again), ["key", "span", "_hash"])
        .filter(F.col("begins") - F.col("start") <= history)
        .select("key", "pos", F.col("span").alias("window"))
    )
    repeats = recalled.groupBy("key", "pos").agg(F.collect_list("window").alias("others"))
    own = F.array(F.col("span"))
    talk = (
        placed.join(repeats, ["key", "pos"], "left")
        .withColumn("windows", F.concat(own, F.coalesce("others", F.array().cast("array<bigint>"))))
        .select("key", "conv_id", "pos", "role", "text", "span", F.explode("windows").alias("window"))
    )
    opening = placed.filter("recurs").select("key", "conv_id", "pos", "role", "text", "span")
    later = opening.join(
        spans.select("key", F.col("span").alias("window")), "key"
    ).filter("window <> span")
    return talk.unionByName(later.select(talk.columns))


def format_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = WINDOW_TOKENS,
    history: int = HISTORY_TOKENS,
) -> DataFrame:
    """One row per window: conv_id, window, formatted, repeated, loss_spans.

    ``window`` numbers a conversation's windows in order, with gaps. ``repeated`` tells
    for each turn of ``formatted`` whether an earlier window has it as its own.
    ``loss_spans`` are (start, length) in code points: the escaped texts of the window's
    own assistant turns. A window keeps to the budget unless one turn alone exceeds it; a
    long system turn has the first window to itself. Null roles and texts are empty, null conversation ids one
    conversation, null turn numbers come first; turns that tie are ordered by role and
    text and all kept. Other columns are ignored; an empty table gives no rows.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("the history may take a quarter of the budget")
    placed = place_turns(turns, conv_id, turn, role, text, budget, history)
    members = _members(placed, history)
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit("\n"))
    body = escape(F.col("text"))
    rendered = members.select(
        "key",
        "conv_id",
        "window",
        F.struct(
            "pos",
            (F.col("span") != F.col("window")).alias("repeated"),
            head.alias("head"),
            body.alias("body"),
            (F.col("role") == TARGET_ROLE).alias("target"),
        ).alias("turn"),
    )
    packed = (
        rendered.groupBy("key", "window")
        .agg(F.any_value("conv_id").alias("conv_id"), F.sort_array(F.collect_list("turn")).alias("turns"))
    )
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")
    )

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["head"])
        span = F.struct(start.alias("start"), F.length(x["body"]).alias("length"))
        wanted = x["target"] & ~x["repeated"]
        return F.struct(
            (start + F.length(x["body"]) + len(CLOSE)).alias("at"),
            F.when(wanted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    whole = F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE)))
    return packed.select(
        "conv_id",
        "window",
        F.array_join(whole, "").alias("formatted"),
        F.transform("turns", lambda x: x["repeated"]).alias("repeated"),
        F.aggregate("turns", empty, add)["spans"].alias("loss_spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows' text and masks alone: the turns once, and all targets.

    (conv_id, n_turns, turns, loss, formatted_chars): ``turns`` is role, newline, text,
    newline for each turn; ``loss`` all text under the mask. A conversation's result is
    one value, so its windows meet in one row.
    """
    told = F.filter(F.split("formatted", CLOSE), lambda x: x != "")
    fresh = F.filter(told, lambda x, i: ~F.get(F.col("repeated"), i))

    def parsed(x: Column) -> Column:
        inner = F.substring(x, len(OPEN) + 1, 1 << 30)
        at = F.locate("\n", inner)
        name = F.url_decode(inner.substr(F.lit(1), at - 1))
        words = unescape(inner.substr(at + 1, F.lit(1 << 30)))
        return F.concat(name, F.lit("\n"), words, F.lit("\n"))

    masked = F.transform(
        "loss_spans",
        lambda x: unescape(F.col("formatted").substr(x["start"] + 1, x["length"])),
    )
    per_window = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.size(fresh).cast("bigint").alias("n"),
            F.array_join(F.transform(fresh, parsed), "").alias("turns"),
            F.array_join(masked, "").alias("loss"),
            F.length("formatted").cast("bigint").alias("chars"),
        ).alias("w"),
    )
    whole = per_window.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("w")).alias("w"),
        F.sum("w.n").alias("n_turns"),
        F.sum("w.chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"),
        "formatted_chars",
    )
