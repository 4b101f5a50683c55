"""Intent detection, collision handling and the hybrid with a model's posterior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import RulePack

INTENT_PACK = RulePack.of(
    V.INTENT_PATTERNS,
    negations={
        "BILLING_SUBSCRIPTION_PRIME": V.NEGATED_BILLING,
        "REFUND_RETURN_EXCHANGE": V.NEGATED_REFUND,
    },
)
TOPIC_PACK = RulePack.of(V.TOPIC_PATTERNS)


def detect(text: Column, pack: RulePack = INTENT_PACK) -> Column:
    """Every matching intent, negated billing and refund mentions ignored."""
    return pack.all_labels(text)


def detect_raw(text: Column, pack: RulePack = INTENT_PACK) -> Column:
    """Every matching intent, negation ignored."""
    return pack.without_negation().all_labels(text)


def by_priority(detected: Column, priority: list[str] = V.INTENT_PRIORITY, general: str = V.GENERAL_INTENT) -> Column:
    """The first label of the fixed order; no detected label means the general class."""
    chain = F.when(F.size(detected) == 0, F.lit(general))
    for label in priority:
        chain = chain.when(F.array_contains(detected, label), F.lit(label))
    return chain.otherwise(F.get(detected, F.lit(0)))


def hybrid(detected: Column, posterior: Column, classes: list[str]) -> Column:
    """struct<intent,confidence> from detected labels and a posterior array.

    Nothing detected: the model's top class.  Security detected: security.  Otherwise
    the detected label with the highest posterior, the earlier one on a tie.  A class that the model has not learnt
    counts 0 among several detected ones and is reported with the model's top probability.
    """
    names = F.array(*[F.lit(c) for c in classes])

    def known(label: Column) -> Column:
        """The label's probability, null for a class that the model has not learnt."""
        at = F.array_position(names, label)
        return F.when(at > 0, F.get(posterior, (at - 1).cast("int")))

    def prob(label: Column) -> Column:
        return F.coalesce(known(label), F.lit(0.0))

    top = F.array_max(posterior)
    top_label = F.get(names, (F.array_position(posterior, top) - 1).cast("int"))
    ranked = F.transform(detected, lambda d, i: F.struct(prob(d).alias("p"), (-i).alias("o"), d.alias("label")))
    best = F.array_max(ranked)
    label = (
        F.when(F.size(detected) == 0, top_label)
        .when(F.array_contains(detected, V.SECURITY_INTENT), F.lit(V.SECURITY_INTENT))
        .otherwise(best["label"])
    )
    confidence = (
        F.when(F.size(detected) == 0, top)
        .when(F.array_contains(detected, V.SECURITY_INTENT), F.coalesce(known(F.lit(V.SECURITY_INTENT)), top))
        .otherwise(F.coalesce(known(best["label"]), top))
    )
    return F.struct(label.alias("intent"), F.round(confidence, 4).alias("confidence"))


def with_intents(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``detected`` and its priority label ``intent``."""
    return df.withColumn("detected", detect(F.col(text))).withColumn("intent", by_priority(F.col("detected")))
