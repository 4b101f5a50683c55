"""Evidence cues, drafted replies and the final sanitizer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.pii import mask_pii
from triagelake.functions.rules import matches
from triagelake.functions.text import signature, strip


def admissible_reply(similarity: Column, past_reply: Column, gate: float = V.EVIDENCE_GATE) -> Column:
    """The past reply when it is similar enough, else an empty text."""
    return F.when(similarity >= gate, F.coalesce(past_reply, F.lit(""))).otherwise(F.lit(""))


def carrier_cue(past_reply: Column, carriers: list[str] = V.CARRIERS) -> Column:
    """First carrier of the fixed list named as a whole word, null when there is none."""
    return F.coalesce(*[F.when(matches(past_reply, rf"\b{c}\b"), F.lit(c)) for c in carriers])


def with_cues(df: DataFrame, similarity="similarity", past_reply="past_reply") -> DataFrame:
    """Add cue_signature, cue_carrier and cue_neighbour taken from the best past reply."""
    out = df.withColumn("_past", admissible_reply(F.col(similarity), F.col(past_reply)))
    return (
        out.withColumn("cue_signature", signature(F.col("_past")))
        .withColumn("cue_carrier", carrier_cue(F.col("_past")))
        .withColumn("cue_neighbour", matches(F.col("_past"), V.NEIGHBOUR_CHECK))
        .drop("_past")
    )


def _fill(template: str, sign: Column, carrier: Column, neighbour: Column, voice: B.Voice) -> Column:
    body = F.lit(template)
    if "{neighbour}" in template:
        body = F.replace(body, F.lit("{neighbour}"), F.when(neighbour, F.lit(voice.neighbour_hint)).otherwise(F.lit("")))
    if "{carrier}" in template:
        body = F.replace(body, F.lit("{carrier}"), F.coalesce(carrier, F.lit(voice.default_carrier)))
    return F.replace(body, F.lit("{signature}"), sign)


def draft(
    text: Column,
    intent: Column,
    decision: Column,
    category: Column,
    sign: Column,
    carrier: Column,
    neighbour: Column,
    voice: B.Voice = B.Voice(),
) -> Column:
    """Reply text from the template of the escalation category or of the auto intent."""

    def fill(template):
        return _fill(template, sign, carrier, neighbour, voice)

    escalated = None
    for name, body in voice.escalation.items():
        escalated = F.when(category == name, fill(body)) if escalated is None else escalated.when(category == name, fill(body))
    escalated = escalated.when(matches(text, V.HUMAN_MENTION), fill(voice.human)).otherwise(fill(voice.apology))
    auto = None
    for name, body in voice.auto.items():
        auto = F.when(intent == name, fill(body)) if auto is None else auto.when(intent == name, fill(body))
    auto = auto.otherwise(fill(voice.feedback))
    return F.when(decision == V.ESCALATE, escalated).otherwise(auto)


def sanitize(reply: Column) -> Column:
    """Replace credential solicitation, mask personal data, append a missing sign-off."""
    safe = F.regexp_replace(reply, "(?iuUd)" + V.CREDENTIAL_SOLICITING, B.SOLICIT_REPLACEMENT)
    return ensure_signoff(mask_pii(safe))


def ensure_signoff(reply: Column) -> Column:
    return F.when(strip(reply).rlike("(?d)" + V.SIGNATURE), reply).otherwise(
        F.concat(strip(reply), F.lit(" " + V.DEFAULT_SIGNATURE))
    )


def with_reply(df: DataFrame, text="text", voice: B.Voice = B.Voice()) -> DataFrame:
    """Add the sanitized ``reply``; needs intent, decision, category and the cue columns."""
    c = F.col
    raw = draft(
        c(text), c("intent"), c("decision"), c("escalation_category"),
        c("cue_signature"), c("cue_carrier"), c("cue_neighbour"), voice,
    )
    out = df.withColumn("_draft", raw)
    out = out.withColumn(
        "_draft", mask_pii(F.regexp_replace("_draft", "(?iuUd)" + V.CREDENTIAL_SOLICITING, B.SOLICIT_REPLACEMENT))
    )
    return out.withColumn("reply", ensure_signoff(c("_draft"))).drop("_draft")


def solicits_credentials(reply: Column) -> Column:
    """True when a reply asks for credentials and does not warn against sharing them."""
    return matches(reply, V.SOLICIT_VERB_THEN_CREDENTIAL) & ~matches(reply, V.DO_NOT_SHARE)
