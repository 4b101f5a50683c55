"""Rebuilding turns and reply pairs from transcripts and from turn rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.text import strip

CUSTOMER = "Customer"
SUPPORT = "Support"
_NO_TURNS = "array<struct<role:string,text:string>>"


def _as_turn(line: Column, speakers: list[str]) -> Column:
    out = None
    for s in speakers:
        value = F.struct(F.lit(s).alias("role"), strip(F.substr(line, F.lit(len(s) + 3))).alias("text"))
        hit = line.startswith(s + ": ")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def strict_turns(transcript: Column, speakers: tuple[str, ...] = (CUSTOMER, SUPPORT)) -> Column:
    """array<struct<role,text>>: only lines that begin with a speaker prefix."""
    lines = F.split(strip(transcript), "\n")
    return F.array_compact(F.transform(lines, lambda ln: _as_turn(ln, list(speakers))))


def joined_turns(transcript: Column, speakers: tuple[str, ...] = (CUSTOMER, SUPPORT)) -> Column:
    """As ``strict_turns``, but lines without a prefix continue the current turn.

    The transcript is cut in front of each prefix, so a turn arrives together with
    its continuation lines and nothing has to be exploded or grouped again.
    """
    ahead = "|".join(speakers)
    blocks = F.split(strip(transcript), rf"\n(?=(?:{ahead}): )")
    flat = F.transform(blocks, lambda b: F.replace(b, F.lit("\n"), F.lit(" ")))
    return F.array_compact(F.transform(flat, lambda b: _as_turn(b, list(speakers))))


def first_text(turns: Column, role: str) -> Column:
    """Text of the first turn of a role, or null."""
    return F.get(F.filter(turns, lambda t: t["role"] == role), F.lit(0))["text"]


def threads_from_transcripts(df: DataFrame, turns: Column, brand="company", conversation="conversation_id") -> DataFrame:
    """One row per conversation: first texts, turn count and the turns themselves."""
    t = df.select(F.col(brand).alias("brand"), F.col(conversation).alias("conversation_id"), turns.alias("turns"))
    return t.select(
        "brand",
        "conversation_id",
        first_text(F.col("turns"), CUSTOMER).alias("customer_text"),
        first_text(F.col("turns"), SUPPORT).alias("support_reply"),
        F.size("turns").alias("turn_count"),
        "turns",
    )


def threads_from_turn_rows(
    df: DataFrame, brand="brand", conversation="conversation_id", turn="turn", role="role", text="text"
) -> DataFrame:
    """The same from one-row-per-turn tables, with partial aggregation only."""

    def first(of):
        return F.min_by(F.when(F.col(role) == of, F.col(text)), F.when(F.col(role) == of, F.col(turn)))

    counted = F.count(F.when(F.col(role).isin(CUSTOMER, SUPPORT), F.lit(1)))
    return (
        df.groupBy(F.col(brand).alias("brand"), F.col(conversation).alias("conversation_id"))
        .agg(
            first(CUSTOMER).alias("customer_text"),
            first(SUPPORT).alias("support_reply"),
            counted.cast("int").alias("turn_count"),
        )
    )


def reply_pairs(messages: DataFrame, child_filter: Column | None = None) -> DataFrame:
    """Every reply joined to the message it answers (message-grain table).

    Expects message_id, parent_id, author_id, inbound, text, response_id.  The join key is
    the unique message id, so the exchange is even whatever the thread sizes are.
    """
    child = messages if child_filter is None else messages.where(child_filter)
    child = child.where(F.col("parent_id").isNotNull()).select(
        F.col("message_id").alias("reply_id"),
        F.col("author_id").alias("author_id"),
        F.col("parent_id").alias("message_id"),
        F.col("text").alias("reply_text"),
        F.col("response_id").alias("reply_response_id"),
    )
    parent = messages.select("message_id", F.col("text").alias("customer_text"))
    return child.join(parent, "message_id", "inner")
