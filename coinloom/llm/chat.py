"""Chat formatting: turn-aligned windows under a token budget, with reversible escapes and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>\n"
# A backslash inside a text becomes \b; every control string is broken behind its first character by \x.
_CONTROL = r"(<(?=\|im_start\|>|\|im_end\|>|/?s>|</?SYS>>)|\[(?=/?INST\]))"
# Tokens of a turn's two marks, as `count_tokens` counts them.
MARKS = 10
# Turns whose numbers lie in one stretch of this length are summed together first.
STRETCH = 256


def escape(text: Column) -> Column:
    """Make a text free of control strings; `unescape` gives it back exactly."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\b")), _CONTROL, "$1\\\\x")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\x"), F.lit("")), F.lit("\\b"), F.lit("\\"))


def count_tokens(text: Column) -> Column:
    """Words and single marks; an estimate of tokens that needs no vocabulary."""
    return F.length(F.regexp_replace(text, r"\w+|[^\w\s]", "x")) - F.length(
        F.regexp_replace(text, r"\w+|[^\w\s]", "")
    )


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def format_windows(turns: DataFrame, budget: int = 2048, history: int = 256) -> DataFrame:
    """Format the conversations in `turns` (conv_id, turn, role, text) as training windows.

    Returns one row per window: `conv_id, window, n_new, n_repeated, formatted, loss`, where `loss`
    is an array of (start, length) in code points of `formatted` over the texts that are trained on.

    A window is the conversation's system turn (its first turn, if its role is `system`), then the turns
    before its own that fit in `history` tokens, then its own turns. Tokens are those of `count_tokens`,
    the template's marks and the role included. Turns of more than a quarter of what the budget leaves
    beside the history have a window of their own. The others go by where they start: the running token
    count of the conversation, without its system turn, is cut at equal strides, and a stride is what
    the budget leaves beside the history, the system turn and one such quarter. So every window is
    within the budget but those of a single turn that does not fit with the system turn and the
    history. Only own assistant turns are under the loss: a repeated target is masked.

    Turns are ordered by turn (null first), role, text; repeated rows are separate turns. A null
    role or text counts as empty. Rows with a null conv_id form one conversation. Extra columns are
    ignored, an empty table gives an empty table. Long conversations are spread: texts only meet in
    windows; one conversation's window numbers, not its texts, pass through one task.
    """
    quarter = max(1, (budget - history) // 4)
    role, body = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = (
        turns.select(
            "conv_id",
            F.coalesce(F.expr(f"turn div {STRETCH}"), F.lit(-(2**62))).alias("part"),
            F.col("turn").cast("long").alias("turn"),
            role.alias("role"),
            body.alias("text"),
        )
        .withColumn("tokens", F.lit(MARKS) + count_tokens(_role(F.col("role"))) + count_tokens(escape(F.col("text"))))
        .withColumn("wide", (F.col("tokens") > quarter).cast("int"))
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), F.col("role").alias("role"))
    systems = F.when(F.col("role") == "system", F.struct(F.col("turn").isNull(), F.bitwise_not("turn"), "tokens", "wide"))
    parts = rows.groupBy("conv_id", "part").agg(
        F.sum("tokens").alias("t"), F.count("*").alias("n"), F.sum("wide").alias("w"), F.min(place).alias("m"), F.max(systems).alias("s")
    )
    by_part = Window.partitionBy("conv_id").orderBy("part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    led = F.first("m.role").over(by_part) == "system"
    parts = parts.select(
        F.col("conv_id").alias("c0"),
        F.col("part").alias("p0"),
        *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}0") for k in "tnw"),
        F.when(led, F.first("s.tokens").over(by_part)).otherwise(0).alias("system"),
        F.when(led, F.first("s.wide").over(by_part)).otherwise(0).alias("system_wide"),
    )
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    stride = F.greatest(F.lit(1), F.lit(budget - history - quarter) - F.col("system"))
    placed = (
        rows.withColumn("ended", F.sum("tokens").over(running))
        .withColumn("nth", F.row_number().over(inside))
        .withColumn("wides", F.sum("wide").over(running))
        .join(parts, F.col("conv_id").eqNullSafe(F.col("c0")) & (F.col("part") == F.col("p0")))
        .select(
            "conv_id",
            (F.col("n0") + F.col("nth") - 1).alias("pos"),
            F.greatest(F.lit(0), F.col("t0") + F.col("ended") - F.col("tokens") - F.col("system")).alias("start"),
            F.greatest(F.lit(0), 2 * (F.col("w0") + F.col("wides") - F.col("system_wide")) - F.col("wide")).alias("step"),
            stride.alias("stride"),
            "role",
            "text",
        )
        .withColumn("cut", F.struct(F.expr("start div stride").alias("at"), "step"))
    )
    by_conv = Window.partitionBy("conv_id").orderBy("cut")
    windows = (
        placed.groupBy("conv_id", "cut")
        .agg(F.min("start").alias("from"))
        .select(
            F.col("conv_id").alias("c1"),
            F.col("cut").alias("w1"),
            (F.row_number().over(by_conv) - 1).alias("window"),
            F.lead("from").over(by_conv).alias("next_from"),
            F.count("*").over(Window.partitionBy("conv_id")).alias("n_windows"),
        )
    )
    own, repeated = F.lit(False), F.lit(True)
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    to = lambda w, again: F.struct(w.cast("int").alias("window"), again.alias("again"))
    copies = F.when(
        is_system,
        F.transform(F.sequence(F.lit(0), F.col("n_windows").cast("int") - 1), lambda w: to(w, w > 0)),
    ).otherwise(
        F.when(
            F.col("next_from") - F.col("start") <= history,
            F.array(to(F.col("window"), own), to(F.col("window") + 1, repeated)),
        ).otherwise(F.array(to(F.col("window"), own)))
    )
    spread = (
        placed.join(windows, F.col("conv_id").eqNullSafe(F.col("c1")) & (F.col("cut") == F.col("w1")))
        .select("conv_id", "pos", "role", "text", F.explode(copies).alias("to"))
        .select("conv_id", "to.window", "to.again", "pos", "role", "text")
    )
    head = F.concat(F.lit(TURN_OPEN), _role(F.col("role")), F.lit("\n"))
    piece = F.struct(
        "pos",
        "again",
        F.concat(head, escape(F.col("text")), F.lit(TURN_CLOSE)).alias("piece"),
        F.length(head).alias("head"),
        F.when((F.col("role") == "assistant") & ~F.col("again"), F.length(escape(F.col("text"))))
        .otherwise(-1)
        .alias("target"),
    )
    packed = spread.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    step = lambda a, x: F.struct(
        (a["at"] + F.length(x["piece"])).alias("at"),
        F.when(
            x["target"] >= 0,
            F.concat(a["spans"], F.array(F.struct((a["at"] + x["head"]).alias("start"), x["target"].alias("length")))),
        )
        .otherwise(a["spans"])
        .alias("spans"),
    )
    return packed.select(
        "conv_id",
        "window",
        F.size(F.filter("p", lambda x: ~x["again"])).alias("n_new"),
        F.size(F.filter("p", lambda x: x["again"])).alias("n_repeated"),
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.aggregate("p", start, step, lambda a: a["spans"]).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: `conv_id, window, turns, targets, chars`.

    `turns` are the window's own turns (role, text), unescaped; `targets` the texts under the loss.
    """
    pieces = F.filter(F.split("formatted", F.lit(r"<\|im_end\|>\n"), F.lit(-1)), lambda p: p != "")
    fresh = F.slice(pieces, F.col("n_repeated") + 1, F.greatest(F.col("n_new"), F.lit(1)))
    body = lambda p: F.substr(p, F.lit(len(TURN_OPEN) + 1))
    role = lambda p: F.substring_index(body(p), "\n", 1)
    parsed = F.transform(
        fresh,
        lambda p: F.struct(
            unescape(F.replace(role(p), F.lit("\\n"), F.lit("\n"))).alias("role"),
            unescape(F.substr(body(p), F.length(role(p)) + 2)).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return windows.select(
        "conv_id",
        "window",
        parsed.alias("turns"),
        targets.alias("targets"),
        F.length("formatted").cast("long").alias("chars"),
    )


def conversation_digest(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: counts and digests of turns and targets."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    each = read_back(windows).select(
        "conv_id",
        "chars",
        F.size("turns").alias("n"),
        F.struct("window", said.alias("said"), F.array_join("targets", "").alias("loss")).alias("w"),
    )
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    return (
        each.groupBy("conv_id")
        .agg(
            F.sum("n").cast("long").alias("n_turns"),
            F.array_sort(F.collect_list("w")).alias("w"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(joined("said"), 256).alias("turns_sha256"),
            F.length(joined("loss")).cast("long").alias("loss_chars"),
            F.sha2(joined("loss"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
