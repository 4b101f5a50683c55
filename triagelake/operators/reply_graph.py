"""Reply-graph audit over message rows (message_id, parent_id, author_id, inbound, text, response_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import matches
from triagelake.functions.text import mentions, message_tokens
from triagelake.operators.brand_audit import token_entropy
from triagelake.operators.topn import top_n_per_group
from triagelake.operators.turns import reply_pairs


def outbound_volume(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Outbound messages per author, most active first."""
    counts = messages.where(~F.col("inbound")).groupBy("author_id").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "author_id")
    return ordered if top is None else ordered.limit(top)


def brand_pairs(messages: DataFrame) -> DataFrame:
    """Brand replies with the message they answer."""
    return reply_pairs(messages, ~F.col("inbound"))


def replied_customers(messages: DataFrame) -> DataFrame:
    """(author_id, message_id): customer messages each brand answered, once each."""
    asked = (
        messages.where(~F.col("inbound") & F.col("parent_id").isNotNull())
        .select("author_id", F.col("parent_id").alias("message_id"))
        .distinct()
    )
    return asked.join(messages.where(F.col("inbound")).select("message_id"), "message_id", "left_semi")


def mention_rows(messages: DataFrame, brands: list[str]) -> DataFrame:
    """(author_id, message_id, text): inbound messages that mention a listed brand."""
    named = F.array_compact(
        F.array(*[F.when(mentions(F.col("text"), b), F.lit(b)) for b in brands])
    )
    return messages.where(F.col("inbound")).select(
        F.explode(named).alias("author_id"), "message_id", "text"
    )


def reach(messages: DataFrame, brands: list[str]) -> DataFrame:
    """Distinct customer messages per brand that were answered or mention it."""
    both = replied_customers(messages).select("author_id", "message_id").unionByName(
        mention_rows(messages, brands).select("author_id", "message_id")
    )
    return both.where(F.col("author_id").isin(*brands)).distinct().groupBy("author_id").agg(
        F.count(F.lit(1)).alias("usable_customer_messages")
    )


def reply_rates(pairs: DataFrame) -> DataFrame:
    """Per brand: pairs, mean reply length, redirect and guidance rates, multi-turn share."""
    r = F.col("reply_text")

    def pct(test):
        return F.round(F.avg(F.coalesce(test, F.lit(False)).cast("double")) * 100, 1)

    return pairs.groupBy("author_id").agg(
        F.count(F.lit(1)).alias("usable_pairs"),
        F.round(F.avg(F.length(r)), 1).alias("avg_reply_length"),
        pct(matches(r, V.GRAPH_REDIRECT)).alias("dm_redirect_rate"),
        pct(matches(r, V.GRAPH_ACTIONABLE)).alias("actionable_reply_rate"),
        pct(F.col("reply_response_id").isNotNull()).alias("multi_turn_pct"),
    )


def mention_measures(mentioned: DataFrame) -> DataFrame:
    """Per brand over its mentions: token entropy, vocabulary, length, junk and risk shares."""
    t = F.col("text")
    tokens = mentioned.select("author_id", F.explode(message_tokens(t)).alias("token"))
    entropy = token_entropy(tokens, ["author_id"]).select(
        "author_id", F.round("entropy", 2).alias("vocab_entropy"), "vocab_size"
    )
    texts = mentioned.groupBy("author_id").agg(
        F.round(F.avg(F.length(t)), 1).alias("avg_cust_len"),
        F.round(F.avg((F.length(t) < 20).cast("double")) * 100, 1).alias("short_junk_pct"),
        F.round(F.avg(matches(t, V.GRAPH_RISK).cast("double")) * 100, 1).alias("high_risk_pct"),
    )
    return texts.join(entropy, "author_id", "left").na.fill(0.0, ["vocab_entropy"]).na.fill(0, ["vocab_size"])


def pair_samples(pairs: DataFrame, per_brand: int = 5) -> DataFrame:
    return top_n_per_group(pairs, ["author_id"], [F.col("reply_id")], per_brand)


def audit(messages: DataFrame, brands: list[str], sample: int | None = None, per_brand: int = 5) -> DataFrame:
    """One row per listed brand with all measures of the reply graph; measures without data are 0, samples then null.

    ``sample`` keeps the first mentions per brand for the token measures; None uses all.
    """
    outbound = messages.where(~F.col("inbound") & F.col("author_id").isin(*brands))
    volume = outbound.groupBy("author_id").agg(F.count(F.lit(1)).alias("outbound_messages"))
    pairs = brand_pairs(messages).where(F.col("author_id").isin(*brands))
    mentioned = mention_rows(messages, brands)
    if sample is not None:
        mentioned = top_n_per_group(mentioned, ["author_id"], [F.col("message_id")], sample).drop("rank")
    samples = pair_samples(pairs, per_brand).groupBy("author_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "customer_text", "reply_text"))).alias("sample_pairs")
    )
    out = messages.sparkSession.createDataFrame([(b,) for b in dict.fromkeys(brands)], "author_id string")
    for part in (volume, reach(messages, brands), reply_rates(pairs), mention_measures(mentioned), samples):
        out = out.join(part, "author_id", "left")
    return out.na.fill(0)
