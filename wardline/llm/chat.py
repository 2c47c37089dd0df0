"""Chat formatting with a grammar round trip, DataFrame operations only.

A conversation is rendered as turns ``### role: text</turn>`` + line feed. The parser is
deterministic: ``</turn>`` + line feed ends a turn, ``: `` ends the role, escapes are undone left to
right. Each turn is first rendered as it is and parsed again; a turn that does not come back
identical is escaped, and the parsed conversation must equal its source or the job fails.

Escapes: ``\\\\`` backslash, ``\\e`` end mark, ``\\h`` turn mark, ``\\c`` end of a role.

A conversation is one value of the result, so its turns meet in one task; lengths and offsets are
taken per turn before that. Defined results: null text and null role are empty; rows of one
conversation that share a turn number go by role, then text; a null turn comes first; a null
conv_id is one conversation; rows that repeat are repeated turns; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, ROLE_END, TURN_END = "### ", ": ", "</turn>"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(F.replace(out, F.lit(TURN_END), F.lit("\\e")), F.lit(TURN), F.lit("\\h"))
    return F.replace(out, F.lit(ROLE_END), F.lit("\\c")) if role else out


def unescaped(text: Column) -> Column:
    """Undo escapes left to right: double backslashes are cut out first, the rest is literal."""
    pieces = F.transform(
        F.split(text, r"\\\\"),
        lambda p: F.replace(
            F.replace(F.replace(p, F.lit("\\e"), F.lit(TURN_END)), F.lit("\\h"), F.lit(TURN)),
            F.lit("\\c"), F.lit(ROLE_END),
        ),
    )
    return F.array_join(pieces, "\\")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN), role, F.lit(ROLE_END), text, F.lit(TURN_END + "\n"))


def parsed(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    ends = F.split(formatted, TURN_END + "\n")
    bodies = F.slice(ends, F.lit(1), F.greatest(F.lit(0), F.size(ends) - 1))

    def turn(body: Column) -> Column:
        at = F.instr(body, ROLE_END)
        role = F.substring(body, F.lit(len(TURN) + 1), at - len(TURN) - 1)
        return F.struct(
            unescaped(role).alias("role"),
            unescaped(F.substring(body, at + len(ROLE_END), F.length(body))).alias("text"),
        )

    return F.transform(bodies, turn)


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, turns (parsed back from it),
    loss_spans (start and length, in code points of ``formatted``, of each assistant text)."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    source = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = parsed(rendered(F.col("role"), F.col("text")))
    same = (F.size(plain) == 1) & (plain[0]["role"] == F.col("role")) & (plain[0]["text"] == F.col("text"))
    # A lone backslash before the end mark would change its meaning, so a final one is a conflict.
    same = same & ~F.col("text").endswith("\\") & ~F.col("role").endswith("\\")
    same = same & ~F.contains("text", F.lit(TURN)) & ~F.contains("text", F.lit(TURN_END))
    safe = (
        source.withColumn("same", F.coalesce(same, F.lit(False)))
        .withColumn("safe_role", F.when(F.col("same"), F.col("role")).otherwise(escaped(F.col("role"), True)))
        .withColumn("safe_text", F.when(F.col("same"), F.col("text")).otherwise(escaped(F.col("text"))))
        .withColumn("piece", rendered(F.col("safe_role"), F.col("safe_text")))
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + len(TURN) + F.length("safe_role") + len(ROLE_END)
    placed = safe.withColumn("n", F.row_number().over(order)).withColumn("start", start)
    gathered = F.array_sort(
        F.collect_list(F.struct("n", "piece", "role", "text", "start", F.length("safe_text").alias("length")))
    )
    whole = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_source"), gathered.alias("t"))
    out = whole.select(
        "conv_id",
        F.array_join(F.col("t")["piece"], "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        F.transform(
            F.filter("t", lambda x: x["role"] == "assistant"),
            lambda x: F.struct(x["start"].cast("long").alias("start"), x["length"].cast("long").alias("length")),
        ).alias("loss_spans"),
    ).withColumn("turns", parsed(F.col("formatted")))
    proved = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("conversation not recovered: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    )
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "formatted", proved.alias("turns"), "loss_spans")


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, one after the other."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )
