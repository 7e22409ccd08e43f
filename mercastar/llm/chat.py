"""Chat transcripts as training text, proved by reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import quoted

OPEN, CLOSE, END = "[INST] ", " [/INST]", "</s>"
LEARNED_ROLES = ("assistant",)

# Each control string begins with one of the two signs; the third is the escape sign.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\o"))


def escaped(text: Column) -> Column:
    for sign, code in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """Undo `escaped`. The escape sign comes last: `\\el` is a sign and a letter."""
    for sign, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def _turn(part: Column) -> Column:
    """(role, text) of one turn without its end mark; NULL role if it is no turn."""
    body = F.substring(part, len(OPEN) + 1, 2**31 - 1)
    close = F.instr(body, F.lit(CLOSE))
    well = part.startswith(OPEN) & (close > 0)
    return F.struct(
        F.when(well, unescaped(F.substring(body, F.lit(1), close - 1))).alias("role"),
        F.when(well, unescaped(F.substring(body, close + len(CLOSE), F.length(body)))).alias("text"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, by its grammar alone.

    A text is a sequence of turns `[INST] role [/INST]text</s>`. The parser cuts at
    every end mark, takes the first close mark of a turn as the end of its role, and
    unescapes both parts.
    """
    parts = F.split(formatted, "</s>", -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(turns, _turn)


def format_chats(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One formatted text per conversation, and what its own parser reads from it.

    A turn is first rendered as it is and parsed; if role and text do not come back,
    it is escaped. The whole conversation is then parsed and compared with the source
    turns; if any turn differs, all its turns are escaped. Escaped content holds no
    control string and always comes back, so `round_trip` is true for every row.

    Returns `conv_id, formatted, turns (array of role, text), round_trip`. NULL role
    and text count as empty, NULL conversations form one, NULL turns come first;
    equal turn numbers are ordered by role, then text; repeated rows are repeated
    turns; other columns are ignored; an empty table gives no rows.

    Rendering, parsing and escaping of turns run before the shuffle on single rows.
    One conversation becomes one row, since its text is one value.
    """
    blank = F.lit("")
    turns = df.select(
        F.col(quoted(conversation)).alias("conv_id"),
        F.col(quoted(turn)).alias("at"),
        F.coalesce(F.col(quoted(role)).cast("string"), blank).alias("role"),
        F.coalesce(F.col(quoted(text)).cast("string"), blank).alias("text"),
    )
    plain = rendered(F.col("role"), F.col("text"))
    source = F.array(F.struct("role", "text"))
    safe = rendered(escaped(F.col("role")), escaped(F.col("text")))
    turns = turns.withColumn("shown", F.when(parsed(plain) == source, plain).otherwise(safe))
    line = F.sort_array(F.collect_list(F.struct("at", "role", "text", "shown")))
    chats = turns.groupBy("conv_id").agg(line.alias("line"))
    chats = chats.select(
        "conv_id",
        F.transform("line", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(
            "source"
        ),
        F.array_join(F.transform("line", lambda x: x["shown"]), "").alias("first"),
    )
    all_safe = F.array_join(
        F.transform("source", lambda x: rendered(escaped(x["role"]), escaped(x["text"]))), ""
    )
    same = parsed(F.col("first")) == F.col("source")
    chats = chats.select(
        "conv_id", "source", F.when(same, F.col("first")).otherwise(all_safe).alias("formatted")
    )
    return chats.select(
        "conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), "source"
    ).select("conv_id", "formatted", "turns", (F.col("turns") == F.col("source")).alias("round_trip"))


def loss_text(turns: Column, roles: tuple[str, ...] = LEARNED_ROLES) -> Column:
    """The text a model learns from: the texts of the learned roles, in order."""
    learned = F.filter(turns, lambda x: x["role"].isin(*roles))
    return F.array_join(F.transform(learned, lambda x: x["text"]), "")
