"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of the turns' tokens choose spans of whole turns. A window is the conversation's system
turn, a few turns of the window before (repeated, masked), and its own turns; the loss mask covers
the texts of its own assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window; half of them are for its own turns, so that history and system turn find room. A turn counts as many as it has
#: bytes, unless the caller brings counts: no vocabulary whose tokens hold a byte or more makes more of it.
BUDGET = 8192
#: Turns of the window before that are repeated.
HISTORY = 2
#: Turn numbers whose prefix sums are made in one group; sums of groups come before them.
BLOCK = 128

OPEN, COLON, END = "### ", ": ", "</turn>\n"


def escaped(text: Column) -> Column:
    """``text`` without the template's control strings: backslashes are doubled, and one is put into each of the others."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("</turn>"), F.lit("<\\/turn>")), F.lit("##"), F.lit("#\\#"))


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped` (and of a role's escaping): a backslash gives way to what follows it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit(":"), F.lit("\\:")), F.lit(COLON), escaped(text), F.lit(END))


def turn_tokens(role: Column, text: Column) -> Column:
    """A bound from above for every vocabulary whose tokens hold a byte or more: the bytes of the rendered turn, markers and escapes included."""
    return F.octet_length(rendered(role, text)).cast("long")


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv``, ``turn``, ``role``, ``text``, ``tokens``) with ``idx`` (from 0) and ``upto``, the tokens up to and with the turn.

    Sums of blocks of turn numbers come first, so a conversation's turns need not be in one task; those of one number, or without, are in one.
    """
    rows = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    sums = rows.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("s"))
    before = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s")
    )
    own = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return (
        rows.join(sums, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")), "left")
        .withColumn("idx", F.col("n") + F.row_number().over(own) - 1)
        .withColumn("upto", F.col("s") + F.sum("tokens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
        .select("conv", "turn", "role", "text", "tokens", "idx", "upto")
    )


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """A row for each window: ``conv_id``, ``first_idx``, ``formatted``, ``loss_spans``, ``n_system``, ``n_history``, ``n_own``, ``tokens``, ``over_budget``.

    A window's own turns are those whose prefix sum ends in the same stretch of ``budget`` / 2 tokens;
    history is added, the latest first, while the budget lasts. ``loss_spans`` are code point offsets (start, end) of the escaped texts of
    its own assistant turns: each assistant turn is under the mask of one window. Turns are never
    cut; a window that a long turn brings over the budget says so. Turns go by number (null first),
    then role and text; repeated rows are turns each. A null role or text is empty, rows without ``conv_id`` are
    one conversation; a conversation without rows has no window, an empty table gives no rows. ``tokens`` names a column with the tokens of
    each rendered turn; without one, or where it is null, the turn's bytes are the bound. Further columns are ignored.
    """
    half = max(1, budget // 2)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    given = F.col(f"`{tokens}`").cast("long") if tokens else F.lit(None).cast("long")
    turns = conversations.select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"), F.coalesce(given, turn_tokens(role, text)).alias("tokens"))
    rows = numbered(turns).withColumn("win", F.floor((F.col("upto") - 1) / half))
    turn = F.struct("idx", "tokens", "role", rendered(F.col("role"), F.col("text")).alias("shown"), F.length(escaped(F.col("text"))).alias("size"))
    own = rows.groupBy("conv", "win").agg(F.array_sort(F.collect_list(turn)).alias("own"))
    own = own.withColumn("first_idx", F.col("own")[0]["idx"]).withColumn("last_idx", F.element_at("own", -1)["idx"])
    if history:
        tails = own.select(F.col("conv").alias("c"), (F.col("last_idx") + 1).alias("f"), F.slice("own", -F.least(F.size("own"), F.lit(history)), history).alias("tail"))
        own = own.join(tails, F.col("conv").eqNullSafe(F.col("c")) & (F.col("first_idx") == F.col("f")), "left").drop("c", "f")
    else:
        own = own.withColumn("tail", F.lit(None).cast(own.schema["own"].dataType))
    system = rows.where("role = 'system'").groupBy("conv").agg(F.min_by(turn, F.col("idx")).alias("system"))
    own = own.join(system.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    total = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda s, t: s + t["tokens"])
    empty = F.array().cast(own.schema["own"].dataType)
    # The system turn leads every window that begins after it; history that holds it doesn't repeat it.
    own = own.withColumn("lead", F.when(F.col("system.idx") < F.col("first_idx"), F.array("system")).otherwise(empty))
    room = F.lit(budget) - total(F.col("own")) - total(F.col("lead"))
    # Turns of the tail, the latest first, while their running sum leaves room.
    taken = F.aggregate(
        F.reverse(F.filter(F.coalesce("tail", empty), lambda t: F.col("system.idx").isNull() | (t["idx"] != F.col("system.idx")))),
        F.struct(room.alias("room"), empty.alias("turns")),
        lambda s, t: F.when((s["room"] >= t["tokens"]), F.struct((s["room"] - t["tokens"]).alias("room"), F.concat(F.array(t), s["turns"]).alias("turns"))).otherwise(
            F.struct(F.lit(-1).cast("long").alias("room"), s["turns"].alias("turns"))
        ),
    )
    own = own.withColumn("past", taken["turns"]).withColumn("shown", F.concat("lead", "past", "own"))
    texts = F.array_join(F.transform("shown", lambda t: t["shown"]), "")
    n_before = F.size("lead") + F.size("past")
    # Offsets: a turn's text ends before its end mark.
    spans = F.aggregate(
        F.transform("shown", lambda t, i: F.struct(F.length(t["shown"]).alias("long"), t["size"].alias("size"), ((i >= n_before) & (t["role"] == "assistant")).alias("loss"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + t["long"]).alias("at"),
            F.when(
                t["loss"],
                F.concat(s["spans"], F.array(F.struct((s["at"] + t["long"] - len(END) - t["size"]).alias("start"), (s["at"] + t["long"] - len(END)).alias("end")))),
            ).otherwise(s["spans"]).alias("spans"),
        ),
    )["spans"]
    return own.select(
        F.col("conv").alias("conv_id"),
        "first_idx",
        texts.alias("formatted"),
        spans.alias("loss_spans"),
        F.size("lead").alias("n_system"),
        F.size("past").alias("n_history"),
        F.size("own").alias("n_own"),
        total(F.col("shown")).alias("tokens"),
        (total(F.col("shown")) > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """From the windows' texts and masks alone: ``conv_id``, ``first_idx``, ``turns`` (role, text) of their own turns, and ``loss``, the texts under the mask."""
    parts = F.split("formatted", END.replace("\n", "\\n"))
    own = F.slice(parts, F.col("n_system") + F.col("n_history") + 1, F.col("n_own"))
    form = r"(?s)\A### ((?:[^\\:]++|\\.)*+): (.*)\z"
    turns = F.transform(own, lambda t: F.struct(unescaped(F.regexp_extract(t, form, 1)).alias("role"), unescaped(F.regexp_extract(t, form, 2)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return windows.select("conv_id", "first_idx", turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """A row for each conversation: how many turns, what the turns say and what the mask covers, read back from the windows.

    A digest is of a whole conversation, which one task therefore holds at the end.
    """
    back = read_back(windows).select(
        "conv_id",
        F.size("turns").alias("n"),
        "chars",
        F.struct(
            "first_idx",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join("loss", "").alias("loss"),
        ).alias("part"),
    )
    whole = back.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), F.count("*").alias("n_windows"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    text = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
