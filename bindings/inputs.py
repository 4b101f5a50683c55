"""Inputs derived from the test tables, in Spark.

The tables hold invented prose without support wording.  ``inbox`` therefore puts a
support message in front of every user turn, chosen from MESSAGES by conversation and turn;
``pairs`` does the same for replies.  Every row of the source table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.text import clean_for_query, seeded_key
from triagelake.operators import labelling
from triagelake.operators.intents import detect, detect_raw, hybrid
from triagelake.operators.replies import with_cues, with_reply
from triagelake.operators.triage import constant_baseline, keyword_baseline, with_triage
from triagelake.sources.readers import spread

MESSAGES = [
    "Where is my parcel, and when will it arrive?",
    "The tracking says delivered yesterday but it was never left at my door!",
    "A thief took it, someone stole my package from the hall.",
    "My package was delivered to the wrong address again.",
    "Someone hacked my account and placed unauthorized orders.",
    "I want to talk to a human agent now.",
    "Mera refund kab aayega, please tell me.",
    "I was not charged extra for my prime membership, thank you.",
    "I do not want a refund, just send my package.",
    "asdfkj qwerty zxcvbn plokmi",
    "Here is my card 4532-1234-5678-9012 and security code 123, please charge it.",
    "Order # 112-9876543-1234567 is the one, see @115821 too.",
    "The vase came shattered and the box was torn.",
    "Please cancel my order, it is already shipped but too late for me.",
    "Cancel my order before it ships and change my address.",
    "Where is my refund? I am still waiting for money.",
    "My kindle app is frozen with an error code, see https://t.co/abc123 now.",
    "Thank you, great job, kudos to the team!",
    "Worst service ever, I am disgusted and will call my lawyer.",
    "They double charged me, this is an unauthorized charge on my statement.",
    "No bank fee was mentioned, yet the subscription will renew.",
    "Tell me about the return label and the exchange of shoes.",
    "My account is locked and I cannot access my account, password reset fails.",
    "Reach me at jo.doe+help@example.org or +1-800-555-0199 about the delivery.",
    "My id is 000-12-3456, cvv: 789, card 3782-822463-10005, fix the billing.",
    "Cashback is missing from my wallet balance.",
    "Is the voucher valid on the website? See https://example.com/promo?a=1&b=<2>.",
    "Give me my refund, the package is late and delayed!",
    "Thanks for nothing, yeah right.",
    "The driver broke my gate and hit my car, I will call the police.",
    "It says delivered but it is nowhere, maybe with the neighbors.",
    "Your order status page shows \"in transit\" and 'delayed' <b>again</b>.",
    "Hello there",
    "The missing item was delivered empty, box was empty, I want my money back now.",
    "I never asked for a replacement, and the carrier is late.",
    "Charged for prime again, chargeback is next.",
    "Order number ABC-12345678 was sent to you in a direct message.",
    "I appreciate the help with my echo, it works.",
    "The courier was on the way when I asked to modify order 5.",
    "Contact customer care executive about the defective screen, my password: hunter2 leaked.",
    "What a terrible surprise, unacceptable, I may sue.",
]

REPLIES = [
    "Sorry for the delay, the carrier UPS will deliver it tomorrow. ^GR",
    "Please check with neighbors or around your property, USPS left it there. ^LL",
    "Please send us a direct message with your order number via [link]. ^TN",
    "You can track and cancel the order on the page, step by step. ^abc",
    "Hermes has it, call 800-555-0142 or visit the portal.",
    "Please share your credit card so that we can check the charge",
    "Royal Mail lost it, we will refund you. Please do not post your password here ^KX",
    "Happy to help, restart the app and update the settings ^JS",
    "DM us please",
    "FedEx needs a private message with your details. ^longtag",
    "Groups of parcels are sorted, the household can pick them up. ^OB",
]

SYSTEMS = ["constant", "keyword", "hybrid"]
BRANDS = [f"brand_{i}" for i in range(6)]
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "on", "it", "that", "for", "are", "was", "as", "with", "by", "an", "be", "this",
    "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui",
    "der", "die", "das", "und", "ein", "eine", "zu", "den", "von", "mit",
    "el", "los", "las", "del", "por", "con", "una", "se", "al",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, d) -> DataFrame:
    """The long texts, over all slots."""
    return spread(table(spark, d, "documents"), "doc_id")


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def with_keys(turns: DataFrame) -> DataFrame:
    return turns.withColumn("msg_id", F.concat_ws(":", "conv_id", "turn")).withColumn(
        "brand", F.concat(F.lit("brand_"), (F.col("conv_id") % 6).cast("string"))
    )


def message_text():
    return F.concat(_pick(MESSAGES, F.col("conv_id") * 7 + F.col("turn")), F.lit(" "), F.col("text"))


def reply_text():
    return F.concat(F.col("text"), F.lit(" "), _pick(REPLIES, F.col("conv_id") * 5 + F.col("turn")))


def inbox_of(turns: DataFrame) -> DataFrame:
    """Works on batches and on streams."""
    return with_keys(turns.where(F.col("role") == "user")).select(
        "conv_id", "turn", "msg_id", "brand", message_text().alias("text")
    )


def turn_rows(spark, d) -> DataFrame:
    return spread(table(spark, d, "conversations"), "conv_id")


def inbox(spark, d) -> DataFrame:
    return inbox_of(turn_rows(spark, d))


def messages(spark, d) -> DataFrame:
    """Message-grain graph: every turn answers the turn before it."""
    t = with_keys(turn_rows(spark, d)).where(F.col("role") != "system")
    handle = F.concat(F.lit(" @"), F.upper("brand"))
    text = F.when(F.col("role") == "user", F.concat(message_text(), F.when(F.col("turn") % 2 == 0, handle).otherwise(F.lit(""))))
    return t.select(
        F.col("msg_id").alias("message_id"),
        F.when(F.col("turn") > 0, F.concat_ws(":", "conv_id", F.col("turn") - 1)).alias("parent_id"),
        F.when(F.col("role") == "user", F.concat(F.lit("c"), F.col("conv_id").cast("string"))).otherwise(F.col("brand")).alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        text.otherwise(reply_text()).alias("text"),
        F.when(F.col("turn") < 6, F.concat_ws(":", "conv_id", F.col("turn") + 1)).alias("response_id"),
    )


def pairs(spark, d) -> DataFrame:
    """(conversation_id, brand, customer_text, support_reply): a user turn and the reply to it."""
    turns = with_keys(table(spark, d, "conversations"))
    user = turns.where(F.col("role") == "user").select("conv_id", "turn", "msg_id", "brand", message_text().alias("customer_text"))
    agent = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), reply_text().alias("support_reply")
    )
    return user.join(agent, ["conv_id", "turn"]).withColumnRenamed("msg_id", "conversation_id")


def transcripts(spark, d) -> DataFrame:
    """(company, conversation_id, conversation): one transcript per exchange, with stray lines."""
    p = pairs(spark, d)
    return p.select(
        F.col("brand").alias("company"), "conversation_id",
        F.concat(
            F.lit("greeting line\nCustomer: "), "customer_text", F.lit("\nSupport:  "), "support_reply",
            F.lit("\nlast line\nCustomer: ok "), F.col("conversation_id"), F.lit("\n"),
        ).alias("conversation"),
    )


def whole_transcripts(spark, d) -> DataFrame:
    """(company, conversation_id, conversation): one transcript per conversation with all its turns."""
    t = with_keys(table(spark, d, "conversations"))
    line = (
        F.when(F.col("role") == "user", F.concat(F.lit("Customer: "), message_text()))
        .when(F.col("role") == "assistant", F.concat(F.lit("Support: "), reply_text()))
        .otherwise(F.concat(F.lit("System: "), F.col("text")))
    )
    lines = F.sort_array(F.collect_list(F.struct("turn", line.alias("line"))))
    return t.groupBy(F.col("brand").alias("company"), F.col("conv_id").alias("conversation_id")).agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("conversation")
    )


def turn_threads(spark, d) -> DataFrame:
    """Thread rows (brand, conversation_id, first texts, turn_count) of whole conversations."""
    from triagelake.operators.turns import threads_from_turn_rows

    t = with_keys(table(spark, d, "conversations"))
    rows = t.select(
        "brand", F.col("conv_id").alias("conversation_id"), "turn",
        F.when(F.col("role") == "user", F.lit("Customer")).when(F.col("role") == "assistant", F.lit("Support")).alias("role"),
        F.when(F.col("role") == "user", message_text()).otherwise(reply_text()).alias("text"),
    )
    return threads_from_turn_rows(rows)


def _hex(n: int, *parts) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, n), 16, 10).cast("long")


def with_posterior(df: DataFrame, detected: str = "raw_detected") -> DataFrame:
    """A stand-in for the model: integers from md5, cubed, boosted where a rule fired, normalized."""
    weights = []
    for label in V.INTENTS:
        u = _hex(2, F.col("msg_id"), F.lit(label)) + 1
        weights.append(u * u * u * F.when(F.array_contains(detected, label), 40).otherwise(1))
    total = weights[0]
    for w in weights[1:]:
        total = total + w
    return df.withColumn("_w", F.array(*weights)).withColumn(
        "posterior", F.transform("_w", lambda w: w / F.aggregate("_w", F.lit(0).cast("long"), lambda a, v: a + v))
    ).drop("_w")


def classified_of(box: DataFrame) -> DataFrame:
    df = box.withColumn("clean", clean_for_query(F.col("text")))
    df = df.withColumn("detected", detect(F.col("clean"))).withColumn("raw_detected", detect_raw(F.col("clean")))
    df = with_posterior(df).withColumn("_h", hybrid(F.col("detected"), F.col("posterior"), V.INTENTS))
    return df.withColumn("intent", F.col("_h.intent")).withColumn("intent_confidence", F.col("_h.confidence")).drop("_h")


def scored_of(box: DataFrame) -> DataFrame:
    """Row-local scoring: intent, triage, pseudo evidence and reply."""
    df = with_triage(classified_of(box), "clean")
    df = df.withColumn("similarity", F.round(_hex(4, F.col("msg_id"), F.lit("similarity")) / 65536.0 / 2, 4))
    df = df.withColumn("past_reply", _pick(REPLIES, F.col("conv_id") * 5 + F.col("turn")))
    return with_reply(with_cues(df), "clean")


def scored(spark, d) -> DataFrame:
    return scored_of(inbox(spark, d))


def tier():
    h = _hex(4, F.col("msg_id"), F.lit("tier"))
    return F.when(h < 45000, "normal").when(h < 58000, "difficult").otherwise("adversarial")


def gold(spark, d) -> DataFrame:
    """Gold labels of the inbox: the proposed labels."""
    df = inbox(spark, d).withColumn("difficulty_tier", tier()).withColumnRenamed("text", "customer_text")
    return labelling.with_proposal(labelling.with_pools(df)).select(
        F.col("msg_id").alias("case_id"), "conv_id", "turn", "customer_text", "difficulty_tier", "all_applicable_intents",
        "adversarial_reason", "pool", "proposed_intent", "proposed_triage", "proposed_escalation_category",
        "proposed_escalation_reason",
    )


KEEP = ["case_id", "intent", "decision", "reply", "intent_confidence"]


def _keyword(spark, d) -> DataFrame:
    """The scored inbox with the keyword baseline's answer in kw_* columns."""
    base = scored(spark, d).withColumnRenamed("msg_id", "case_id")
    top = F.array_max("posterior")
    names = F.array(*[F.lit(i) for i in V.INTENTS])
    mine = ["intent", "decision", "escalation_category", "reason", "reply", "intent_confidence"]
    kept = base.withColumn("top_reply", F.when(F.col("similarity") > 0.05, F.col("past_reply")))
    for m in mine:
        kept = kept.withColumnRenamed(m, f"own_{m}")
    kw = keyword_baseline(kept, "text")
    return (
        kw.withColumn("intent", F.get(names, (F.array_position("posterior", top) - 1).cast("int")))
        .withColumn("intent_confidence", F.round(top, 4))
    )


def predictions(spark, d) -> dict[str, DataFrame]:
    kw = _keyword(spark, d)
    return {
        "constant": constant_baseline(kw.select("case_id"), "our help team").select(*KEEP),
        "keyword": kw.select(*KEEP),
        "hybrid": kw.select("case_id", *[F.col(f"own_{m}").alias(m) for m in KEEP[1:]]),
    }


def stacked_predictions(spark, d) -> DataFrame:
    """All three systems, one row each per message, out of a single scoring pass."""
    kw = _keyword(spark, d)
    names = ["pred_intent", "pred_decision", "reply", "intent_confidence"]

    def answer(system, values):
        return F.struct(F.lit(system).alias("system"), *[v.alias(n) for n, v in zip(names, values)])

    fixed = [F.lit(V.INTENTS[0]), F.lit(V.AUTO), F.lit(B.CONSTANT_REPLY.replace("{brand}", "our help team")), F.lit(0.5)]
    answers = F.array(
        answer("constant", fixed),
        answer("keyword", [F.col(m) for m in KEEP[1:]]),
        answer("hybrid", [F.col(f"own_{m}") for m in KEEP[1:]]),
    )
    return kw.select("case_id", F.explode(answers).alias("a")).select("case_id", "a.*")


def evaluation(spark, d) -> DataFrame:
    """Gold next to the predictions of all three systems."""
    from triagelake.operators import metrics

    g = gold(spark, d).select(
        "case_id", F.col("proposed_intent").alias("gold_intent"), F.col("proposed_triage").alias("gold_decision"),
        F.col("difficulty_tier").alias("tier"), "all_applicable_intents",
    )
    return metrics.align(g, stacked_predictions(spark, d))


def doc_language(spark, d) -> DataFrame:
    """documents with a guessed language next to the true one."""
    from triagelake.functions.text import is_english_strict

    t = F.lower("text")

    def any_letter(letters):
        return t.rlike("[" + letters + "]")

    guess = (
        F.when(is_english_strict(F.col("text")), "en").when(any_letter("üßäö"), "de").when(any_letter("ñóíáú"), "es").otherwise("fr")
    )
    return documents(spark, d).select(
        "doc_id", F.lit("guess").alias("system"), F.col("lang").alias("gold_intent"), guess.alias("pred_intent")
    )


LANGS = ["de", "en", "es", "fr"]
