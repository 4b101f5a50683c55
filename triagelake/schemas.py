"""Declared schemas; nothing but parquet carries its own."""

from pyspark.sql import types as T


def _s(name, type_=None, nullable=True):
    return T.StructField(name, type_ or T.StringType(), nullable)


CONVERSATIONS = T.StructType([_s("company"), _s("conversation_id"), _s("conversation")])

MESSAGES = T.StructType([
    _s("tweet_id"), _s("author_id"), _s("inbound", T.BooleanType()), _s("created_at"), _s("text"),
    _s("response_tweet_id"), _s("in_response_to_tweet_id"),
])

KB_PAIRS = T.StructType([
    _s("conversation_id"), _s("customer_text"), _s("support_reply"), _s("raw_customer_text"),
    _s("raw_support_reply"), _s("turn_count", T.IntegerType()),
])

CANDIDATES = T.StructType([
    _s("id"), _s("conversation_id"), _s("customer_text"), _s("proposed_intent"),
    _s("all_applicable_intents", T.ArrayType(T.StringType())), _s("difficulty_tier"), _s("proposed_triage"),
    _s("proposed_escalation_category"), _s("proposed_escalation_reason"), _s("historical_brand_reply"),
    _s("human_verified", T.BooleanType()), _s("audit_status"),
])

GOLD_CASES = T.StructType([
    _s("id"), _s("conversation_id"), _s("customer_text"), _s("golden_intent"),
    _s("all_applicable_intents", T.ArrayType(T.StringType())), _s("difficulty_tier"), _s("golden_triage"),
    _s("golden_escalation_category"), _s("golden_escalation_reason"), _s("historical_brand_reply"),
    _s("human_verified", T.BooleanType()), _s("annotation_notes"), _s("human_annotator"), _s("verification_status"),
])

REQUESTS = T.StructType([
    _s("message"), _s("session_id"), _s("history", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])

STORED_TURN = T.StructType([_s("customer"), _s("agent_reply"), _s("intent"), _s("escalation_category")])

TURN_ROWS = T.StructType([
    _s("conv_id", T.LongType()), _s("turn", T.LongType()), _s("role"), _s("text"),
])

EVENTS = T.StructType([
    _s("event_id", T.LongType()), _s("ts", T.TimestampNTZType()), _s("user_id", T.LongType()), _s("event_type"),
    _s("value", T.DoubleType()), _s("props"),
])
