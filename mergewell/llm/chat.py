"""Chat formatting from event logs: fold, render and read back, native plans only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A control string of the template, in which any number of backslashes may follow the first character.
_GUARDED = r"([<\[])(\\*)(/?s>|/?INST\])"
_GUARDED_ONCE = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """Adds a backslash after the first character of each control string.

    Strings that already look escaped get one more, so ``unescape`` is exact.
    """
    return F.regexp_replace(text, _GUARDED, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _GUARDED_ONCE, "$1$2$3")


def turn_events(rows: DataFrame) -> DataFrame:
    """Finished turns as the log that a streaming service would have left of them.

    Rows of a conversation are numbered by (turn, role, text); rows that repeat
    a turn stay messages of their own. Of each message the log has a first draft
    (the second half of its text, then a mark), which an ``edit`` of the user's or a ``regenerate``
    of another's discards with the first third of the text, and two deltas with the rest.
    """
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    n = F.coalesce(F.char_length("text"), F.lit(0))
    third, rest = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
    cut = lambda a, b: F.substring("text", a + 1, F.greatest(b - a, F.lit(0)))
    again = F.when(F.col("role") == "user", "edit").otherwise("regenerate")
    event = lambda k, op, text: F.struct((5 * F.col("message") + k).alias("seq"), op.alias("op"), text.alias("text"))
    delta = F.lit("delta")
    log = F.array(
        event(0, delta, cut(rest, n)), event(1, delta, F.lit("…")), event(2, again, cut(F.lit(0), third)), event(3, delta, cut(third, rest)), event(4, delta, cut(rest, n)),
    )
    return rows.withColumn("message", number).select("conv_id", "message", "role", F.explode(log).alias("e")).select("conv_id", "message", "e.seq", "e.op", "role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Folds ``conv_id, message, seq, op, role, text`` into final messages.

    In the order of ``seq`` (ties: op, then text), a ``delta`` appends its text
    to its message, an ``edit`` or ``regenerate`` discards what the message held
    and starts again with its text, and a ``delete`` removes the message unless
    a later edit or regeneration brings it back. The role is the last one that is not null.
    Null text counts as empty, a null role as an empty one. No events, no messages.
    """
    key = Window.partitionBy("conv_id", "message")
    log = events.select(
        "conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.isnotnull("role").alias("_named"),
        F.coalesce("text", F.lit("")).alias("text"), "op", F.struct("seq", "op", F.coalesce("text", F.lit("")).alias("text")).alias("_at"),
    )
    start = F.max(F.when(F.col("op").isin("edit", "regenerate", "delete"), F.col("_at"))).over(key)
    live = log.withColumn("_start", start).where(F.isnull("_start") | (F.col("_at") >= F.col("_start")) | F.col("_named"))
    counts = F.isnull("_start") | (F.col("_at") >= F.col("_start"))
    return (
        live.groupBy("conv_id", "message")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(counts, F.col("_at")))), lambda x: x["text"]), "").alias("text"),
            F.coalesce(F.max_by("role", F.when(F.col("_named"), F.col("_at"))), F.lit("")).alias("role"),
            F.coalesce(F.bool_or(F.col("_start.op") == "delete"), F.lit(False)).alias("_deleted"),
        )
        .where(~F.col("_deleted"))
        .drop("_deleted")
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` → one row for each conversation.

    A turn is ``<s>role[INST]text[/INST]</s>`` and a line end, with role and
    text escaped. ``formatted`` is all turns in the order of ``message``;
    ``loss_spans`` has (start, length) in code points of each assistant text.
    """
    role, text = escape(F.col("role")), escape(F.col("text"))
    turn = F.concat(F.lit("<s>"), role, F.lit("[INST]"), text, F.lit("[/INST]</s>\n"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    turns = messages.select("conv_id", "message", "role", turn.alias("_turn"), F.char_length(role).alias("_role"), F.char_length(text).cast("long").alias("_text"))
    turns = turns.withColumn("_at", F.coalesce(F.sum(F.char_length("_turn")).over(before), F.lit(0)) + 9 + F.col("_role"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("_at").alias("start"), F.col("_text").alias("length")))
    return turns.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("message", "_turn"))), lambda x: x["_turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    turns = F.filter(F.split(formatted, r"(?<=\[/INST\]</s>)\n", -1), lambda t: t != "")

    def parts(turn: Column) -> Column:
        at = F.instr(turn, "[INST]")
        role = F.substring(turn, F.lit(4), at - 4)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(turn, at + 6, F.char_length(turn) - at - 16)).alias("text"))

    return F.transform(turns, parts)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
