"""Labels, orders, thresholds, word lists and patterns.

Everything in this module is a fixed value that decides which rows match, so a
change here changes results.  Patterns are written for case-insensitive,
Unicode-aware matching; ``functions.rules`` adds the flags.
"""

# --- fixed values: label sets and orders ------------------------------------

INTENTS = [
    "DELIVERY_STATUS_DELAY",
    "DAMAGED_WRONG_MISSING",
    "REFUND_RETURN_EXCHANGE",
    "ORDER_CHANGE_CANCEL",
    "BILLING_SUBSCRIPTION_PRIME",
    "ACCOUNT_SECURITY_ACCESS",
    "TECHNICAL_PRODUCT_SUPPORT",
    "FEEDBACK_COMPLAINT_GENERAL",
]

INTENT_PRIORITY = [
    "ACCOUNT_SECURITY_ACCESS",
    "DAMAGED_WRONG_MISSING",
    "BILLING_SUBSCRIPTION_PRIME",
    "REFUND_RETURN_EXCHANGE",
    "ORDER_CHANGE_CANCEL",
    "DELIVERY_STATUS_DELAY",
    "TECHNICAL_PRODUCT_SUPPORT",
    "FEEDBACK_COMPLAINT_GENERAL",
]

GENERAL_INTENT = "FEEDBACK_COMPLAINT_GENERAL"
SECURITY_INTENT = "ACCOUNT_SECURITY_ACCESS"

AUTO = "AUTO_HANDLE"
ESCALATE = "ESCALATE"

ESCALATION_CATEGORIES = [
    "NONE",
    "ACCOUNT_SECURITY_RISK",
    "LOST_OR_STOLEN_DELIVERY",
    "DAMAGED_PHYSICAL_MERCHANDISE",
    "FINANCIAL_OR_BILLING_DISPUTE",
    "MANUAL_REFUND_OR_RETURN_OVERRIDE",
    "CUSTOMER_AGITATION_OR_LEGAL_THREAT",
    "ACCOUNT_SPECIFIC_PII_REQUIRED",
    "AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION",
]

# values that only the error route emits
FALLBACK_CATEGORY = "HUMAN_AGENT_REQUEST"
FALLBACK_CHAT_INTENT = "SYSTEM_ERROR_FALLBACK"
FALLBACK_TRIAGE_INTENT = "UNKNOWN"

TIERS = ["normal", "difficult", "adversarial"]

# --- fixed values: thresholds and sizes --------------------------------------

SEED = 42
CONFIDENCE_GATE = 0.40
EVIDENCE_GATE = 0.12
FOLLOW_UP_CONFIDENCE = 0.95
HOLDOUT_SIZE = 1200
TRAIN_PER_CLASS = 1200
BASELINE_SAMPLE = 10000
RETRIEVER_TERMS = 50000
CLASSIFIER_TERMS = 8000
BASELINE_TERMS = 25000
SESSION_TURNS = 20
SESSION_LIMIT = 2000
ADMISSION_LIMIT = 60
ADMISSION_WINDOW_SECONDS = 60
MESSAGE_MAX_CHARS = 4096
HISTORY_MAX_TURNS = 30
LONG_TEXT_CHARS = 140
QUOTAS = {
    "normal": 140,
    "per_intent": 17,
    "difficult": 40,
    "collisions": 30,
    "adversarial": 20,
}
LONG_PICK_INTENTS = [
    "DAMAGED_WRONG_MISSING",
    "ACCOUNT_SECURITY_ACCESS",
    "BILLING_SUBSCRIPTION_PRIME",
    "ORDER_CHANGE_CANCEL",
]
SCORECARD_WEIGHTS = {
    "usable_conversations": 0.25,
    "resolution_coverage": 0.20,
    "issue_diversity": 0.20,
    "thread_richness": 0.15,
    "data_quality": 0.10,
    "evaluation_difficulty": 0.10,
}
# hundredths, so that the pass test is exact integer arithmetic
RUBRIC_WEIGHTS = {"groundedness": 35, "actionability": 25, "tone": 20, "pii_safety": 20}
RUBRIC_PASS_HUNDREDTHS = 380

# --- fixed values: English tests ----------------------------------------------

ENGLISH_WORDS_STRICT = [
    "the", "my", "to", "and", "is", "for", "in", "it", "you", "that", "on",
    "was", "have", "with", "this", "me", "from", "order", "delivery", "package",
    "amazon", "help", "not", "can", "please", "been", "when", "why", "what", "where",
]
ENGLISH_WORDS_TOPICS = [
    "the", "my", "to", "and", "is", "for", "in", "it", "you", "that", "on",
    "was", "have", "with", "this", "me", "from", "order", "delivery", "package", "amazon",
]

# --- fixed values: risk patterns, in match order --------------------------------

RISK_PATTERNS = [
    ("ACCOUNT_SECURITY_RISK",
     r"\b(hacked|fraud|compromised|phishing|unauthorized access|scam|"
     r"stole my identity|otp bypass|someone accessed|hacked ho gaya|account hack)\b"),
    ("LOST_OR_STOLEN_DELIVERY",
     r"\b(says delivered|marked delivered|never arrived|stole|stolen|steal|stealing|theft|thief|"
     r"thieves|porch pirate|box was empty|carrier stole|not received but delivered|"
     r"delivered to (the )?wrong address|delivered to (my )?neighbor|"
     r"taken from (my )?(doorstep|porch|lobby))\b|"
     r"\b(shows?|says?|marked|claims?)\s+(as\s+)?delivered\b.*\b(not\s+(here|received|arrived)|"
     r"never\s+(left|received|got)|missing|nowhere|stole|theft|empty)\b|"
     r"\bdelivered\b.*\b(not\s+received|nowhere to be found|didn't get|never got)\b"),
    ("DAMAGED_PHYSICAL_MERCHANDISE",
     r"\b(shattered|smashed|completely broken|damaged goods|ruined|defective screen|leaking everywhere)\b"),
    ("FINANCIAL_OR_BILLING_DISPUTE",
     r"\b(?<!not\s)(?<!never\s)(?<!no\s)(?<!wasn't\s)(unauthorized charge|charged my card|"
     r"double charged|unrecognized charge|bank fee|stolen credit card|chargeback|paisa kat|"
     r"paise kat|amount deduct|extra charge|unauthorized debit)\b"),
    ("CUSTOMER_AGITATION_OR_LEGAL_THREAT",
     r"\b(human agent|talk to a (human|person|agent|representative)|"
     r"speak with (a )?(human|person|agent|representative)|customer care executive|"
     r"connect (me )?to (an? )?agent|transfer (me )?to (an? )?agent|real person|live agent|"
     r"representative|lawyer|attorney|police|court|legal action|consumer court|"
     r"better business bureau|bbb complaint|lawsuit|unacceptable service|furious|disgusted)\b"),
    ("ACCOUNT_SPECIFIC_PII_REQUIRED",
     r"\b(?:\d{4}[- ]?){3}\d{4}\b|"
     r"\b3[47]\d{2}[- ]?\d{6}[- ]?\d{5}\b|"
     r"\b(?:cvv|cvc|security code|cid)\s*[:=]?\s*\d{3,4}\b|"
     r"\b\d{3}-\d{2}-\d{4}\b|"
     r"\b(?:password|passwd)\s*[:=]?\s*\S+\b"),
]

# --- fixed values: intent patterns, in pack order ---------------------------------

INTENT_PATTERNS = [
    ("ACCOUNT_SECURITY_ACCESS",
     r"\b(hacked|fraud|unauthorized|phishing|otp|locked out|password|scam|security|"
     r"compromised|login|someone else accessed|hacked ho gaya|account hack)\b"),
    ("DAMAGED_WRONG_MISSING",
     r"\b(damaged|broken|empty box|missing|wrong item|defective|shattered|cracked|ruined|"
     r"torn|opened package|stole|stolen|steal|stealing|theft|thief|never arrived|"
     r"delivered to (the )?wrong address|porch pirate)\b|"
     r"\b(shows?|says?|marked|claims?)\s+(as\s+)?delivered\b.*\b(not\s+(here|received|arrived)|"
     r"never\s+(left|received|got)|missing|stolen|theft|empty|porch|nowhere)\b|"
     r"\bdelivered\b.*\b(not\s+received|nowhere\s+to\s+be\s+found|didn't\s+get|never got|stolen|porch)\b"),
    ("BILLING_SUBSCRIPTION_PRIME",
     r"\b(prime|membership|subscription|charged|billing|debit|card charged|renew|"
     r"unrecognized charge|audible fee|annual charge|cashback|amazon pay balance|"
     r"wallet balance|promotional credit|paisa kat|paise kat)\b"),
    ("REFUND_RETURN_EXCHANGE",
     r"\b(refund|return|returning|exchange|money back|pickup|drop off|refunded|"
     r"send back|return label|replacement|mera refund|paisa wapas|refund nahi mila)\b"),
    ("ORDER_CHANGE_CANCEL",
     r"\b(cancel|cancelled|cancellation|change address|modify order|wrong address|"
     r"change payment|stop delivery)\b"),
    ("DELIVERY_STATUS_DELAY",
     r"\b(delivery|deliver|late|delayed|delay|where is|tracking|track|carrier|package|"
     r"parcel|courier|transit|arrive|arriving|eta|status|not delivered|kab aayega)\b"),
    ("TECHNICAL_PRODUCT_SUPPORT",
     r"\b(kindle|fire stick|echo|alexa|app|website|code|voucher|coupon|promo|"
     r"error|crash|bug|tv app|frozen)\b"),
    ("FEEDBACK_COMPLAINT_GENERAL",
     r"\b(thank\s*you|thanks|kudos|shoutout|great job|awesome service|terrible service|"
     r"worst service|horrible|unacceptable service|disappointed|appreciate|good job|"
     r"praise|complaint|feedback|poor customer care)\b"),
]

NEGATED_BILLING = (
    r"\b(not|never|wasn't|was not|no|didn't|did not)\s+(really\s+)?(charged|charge|billed|debit|fee)"
    r"(\s+(extra|again|twice|more|anything))?"
    r"(\s+(for|on|about|in)\s*(my\s+|the\s+)?(prime|membership|subscription|renewal))?"
)
NEGATED_REFUND = (
    r"\b(do not|don't|not|never|didn't|did not)\s+(really\s+)?"
    r"(want|wanted|need|needed|ask for|asked for|request|requested)\s+((a|an)\s+)?"
    r"(refund|return(\s+label)?|replacement|exchange)\b"
)

# --- fixed values: topic anchors, in match order ------------------------------------

TOPIC_PATTERNS = [
    ("DELIVERY_STATUS_DELAY",
     r"\b(delivery|deliver|late|delayed|delay|where is|tracking|track|carrier|package|parcel|"
     r"courier|transit|arrive|arriving|eta|status)\b"),
    ("DAMAGED_WRONG_MISSING",
     r"\b(damaged|broken|empty box|missing|wrong item|defective|shattered|cracked|ruined|torn|opened|incomplete)\b"),
    ("REFUND_RETURN_EXCHANGE",
     r"\b(refund|return|returning|exchange|money back|pickup|drop off|refunded|send back)\b"),
    ("ORDER_CHANGE_CANCEL",
     r"\b(cancel|cancelled|cancellation|change address|modify order|wrong address|change payment)\b"),
    ("ACCOUNT_SECURITY_ACCESS",
     r"\b(hacked|fraud|unauthorized|phishing|otp|locked out|password|scam|security|compromised|login)\b"),
    ("SUBSCRIPTION_BILLING_PRIME",
     r"\b(prime|membership|subscription|charged|fee|billing|debit|card charged|renew|unrecognized charge)\b"),
    ("TECHNICAL_PRODUCT_SUPPORT",
     r"\b(kindle|fire stick|echo|alexa|app|website|code|voucher|coupon|promo|error|crash|bug|tv)\b"),
]

# --- fixed values: triage patterns ----------------------------------------------------

HUMAN_REQUEST = (
    r"\b(human agent|talk to a (human|person|agent|representative)|"
    r"speak with (a )?(human|person|agent|representative)|customer care executive|"
    r"connect (me )?to (an? )?agent|transfer (me )?to (an? )?agent|real person|live agent|"
    r"representative)\b"
)
DELIVERY_LOSS = (
    r"\b(shows?|says?|marked|claims?)\s+(as\s+)?delivered\b.*\b(not\s+(here|received|arrived)|"
    r"never\s+(left|received|got)|missing|nowhere|stole|theft|empty)\b|"
    r"\bdelivered\b.*\b(not\s+received|nowhere\s+to\s+be\s+found|didn't\s+get|never got|wrong address)\b|"
    r"\b(stole|stolen|theft|thief|porch pirate|box was empty|carrier stole|"
    r"delivered to (the )?wrong address)\b"
)
DAMAGED_DELIVERY = r"\b(delivered|porch|doorstep|stole|stolen|theft|missing|empty box|never arrived)\b"
ORDER_DISPATCHED = r"\b(delivered to (the )?wrong address|already delivered|already shipped|too late|on the way|in transit)\b"
WRONG_ADDRESS = r"wrong address"
REFUND_DELAY = (
    r"\b(where is my refund|haven't received refund|still waiting for money|refund delay|"
    r"mera refund|paisa wapas|refund nahi mila)\b"
)
HOSTILITY = r"\b(terrible|worst|disgusted|furious|lawyer|police|sue|unacceptable)\b"
KEYWORD_ESCALATE = (
    r"\b(stolen|delivered|refund|cancel|hacked|fraud|charge|broken|damaged|lawyer|police|sue|unauthorized)\b"
)

# --- fixed values: reply patterns --------------------------------------------------------

SIGNATURE = r"\^([a-zA-Z]{2,3})$"
DEFAULT_SIGNATURE = "^CS"
CARRIERS = ["USPS", "UPS", "FedEx", "Royal Mail", "Hermes"]
NEIGHBOUR_CHECK = r"\b(neighbors?|household|around your (property|porch))\b"
HUMAN_MENTION = r"\b(human|agent|person|representative)\b"
ORDER_NUMBER = r"\b\d{3}-\d{7}-\d{7}\b|\b(order\s*(number|id|#)?\s*[:=]?\s*[A-Z0-9-]{8,})\b"
FOLLOW_UP_CUES = ["order number", "direct message"]
CREDENTIAL_SOLICITING = (
    r"\b(please\s+(tweet|post|share|send|provide)\s+(us\s+)?(your\s+)?"
    r"(credit card|cvv|password|full card number|card details))\b.*"
)
SOLICIT_VERB_THEN_CREDENTIAL = (
    r"\b(tweet|post|send|provide|share)\b.*\b(credit card|cvv|full card number|your password)\b"
)
DO_NOT_SHARE = r"\b(do not|don't|never)\s+(share|post|tweet|provide)\b"

# --- fixed values: personal-data patterns, in masking order ---------------------------------

CARD = r"\b(?:\d{4}[- ]?){3}\d{4}\b|\b3[47]\d{2}[- ]?\d{6}[- ]?\d{5}\b"
CVV = r"\b(?:cvv|cvc|security code|cid)\s*[:=]?\s*\d{3,4}\b"
NATIONAL_ID = r"\b\d{3}-\d{2}-\d{4}\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,7}\b"
PHONE = r"(?<!\d)(?<!\d-)(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)\d{3}[-.\s]?\d{4}(?!-\d)(?!\d)"
CREDENTIAL_WORD = r"(?<!\[)\b(credit card|cvv|password|full card number)\b(?!-redacted\])"

# --- fixed values: rubric word lists -----------------------------------------------------------

RUBRIC_SENSITIVE = r"\b(credit card|cvv|password|full card number)\b"
RUBRIC_PRIVATE_CHANNEL = r"\b(dm|direct message|private|link|contact us)\b"
EMPATHY_MARKERS = [
    "sorry", "apologize", "apologies", "understand", "hate to hear",
    "frustrating", "glad to help", "happy to help", "make this right",
]
ACTION_MARKERS = [
    "visit", "click", "dm", "send us", "select", "restart", "track", "step", "portal", "link",
]
GROUNDING_KEYWORDS = {
    "DELIVERY_STATUS_DELAY": ["track", "order", "delivery", "carrier", "arrive", "link", "schedule"],
    "DAMAGED_WRONG_MISSING": ["damaged", "broken", "package", "replacement", "refund", "investigate", "dm", "order"],
    "REFUND_RETURN_EXCHANGE": ["return", "refund", "replace", "order", "items", "label", "orders"],
    "ORDER_CHANGE_CANCEL": ["cancel", "order", "address", "shipping", "process", "orders"],
    "BILLING_SUBSCRIPTION_PRIME": ["charge", "billing", "prime", "statement", "specialist", "account", "dm"],
    "ACCOUNT_SECURITY_ACCESS": ["security", "password", "reset", "specialist", "portal", "protect"],
    "TECHNICAL_PRODUCT_SUPPORT": ["restart", "cache", "device", "button", "app", "troubleshooting"],
    "FEEDBACK_COMPLAINT_GENERAL": ["feedback", "experience", "improve", "apologize", "assist"],
}
DEFAULT_GROUNDING = ["order", "help", "support"]

# --- fixed values: labelling patterns ----------------------------------------------------------------

ADVERSARIAL_HOSTILE = r"\b(lawyer|police|court|sue|lawsuit|bbb|disgusting|pathetic|worst company|useless|scammers)\b"
ADVERSARIAL_SARCASM = r"\b(thanks for nothing|great job amazon|yeah right|surely)\b"
PROPOSE_DELIVERY_LOSS = r"delivered|never arrived|stolen|missing"
PROPOSE_DISPATCHED = r"already shipped|on the way|in transit|too late"
PROPOSE_REFUND_OVERDUE = r"where is my refund|money back now|haven't received my refund|still waiting for refund"
PROPOSE_HOSTILE = r"lawyer|sue|court|fraud|police|unacceptable|furious"

PRAISE = r"\b(shoutout|thank you|thanks to|kudos|great job|helped me with|resolved my)\b"
NOT_PRAISE = r"\b(sarcasm|no thanks|worst|still waiting)\b"
PASS1_DELIVERED_MISSING = (
    r"\b(shows?|says?|marked)\s+(as\s+)?delivered\b.*\b(not\s+(here|received|arrived)|"
    r"never\s+(left|received|got)|missing|stolen|empty|porch)\b|"
    r"\b(delivered\b.*\b(not\s+received|nowhere\s+to\s+be\s+found|didn't\s+get|stolen|porch))\b"
)
PASS1_WALLET = r"\b(cashback|amazon pay balance|pay balance|instant discount|wallet balance|promotional credit)\b"
PASS1_CHANGE = r"\b(haven't even shipped|before it ships|cancel my order|change my address)\b"
PASS1_RETURN_WORDS = r"\b(return|exchange)\b"
PASS1_REFUND_DEMAND = r"\b(give me my refund|want my money back|refund me now)\b"
PASS1_LATENESS = r"\b(late|delayed|package)\b"

PASS2_MISCONDUCT = r"\b(breaks in|broken hinges|hit my car|stole|driver broke|police|lawyer|court|sue|illegal)\b"
PASS2_BREAK_IN_PHRASES = ["breaks in", "driver broke"]
PASS2_BLOCKED = r"\b(account.*(blocked|suspended|locked|hacked)|blocked from past|cannot access my account)\b"
PASS2_OVERDUE_REFUND = (
    r"\b(where is my refund|give me my refund|haven't received my refund|"
    r"still waiting for.*refund|want my refund)\b"
)
PASS2_DELIVERED_MISSING = (
    r"\b(shows?|says?|marked|claims?)\s+(as\s+)?delivered\b.*\b(not\s+(here|received|arrived)|"
    r"never\s+(left|received|got)|missing|stolen|empty|porch)\b|"
    r"\b(delivered\b.*\b(not\s+received|nowhere\s+to\s+be\s+found|didn't\s+get|stolen|porch))\b"
)
PASS2_CHANGE = r"\b(before it ships|haven't even shipped.*cancel|cancel.*before dispatch)\b"
PASS2_CHARGE = r"\b(prime.*charge|charged for prime|cashback|wallet balance|unauthorized charge)\b"

# --- fixed values: audit patterns (plain substrings, no word boundaries) --------------------------------

AUDIT_RESOLUTION = r"link|refund|track|cancel|setting|update|restart|check|step|order|form|app|visit|call"
AUDIT_REDIRECT = r"dm|direct message|private message"
AUDIT_RISK = (
    r"stolen|lost|refund|money|charge|fraud|hacked|broken|damage|scam|lawyer|police|court|"
    r"unacceptable|furious|never arrived"
)
GRAPH_REDIRECT = r"DM|direct message|private message"
GRAPH_ACTIONABLE = r"refund|cancel|track|order|link|troubleshoot|update|settings|restart|step"
GRAPH_RISK = (
    r"stolen|fraud|charge|money|never arrived|broken|hacked|terrible|worst|lawyer|police|lawsuit|unacceptable"
)

# --- fixed values: stop words -------------------------------------------------------------------------------

# words that carry negation stay in the classifier's vocabulary
KEPT_NEGATIONS = ["not", "no", "never", "neither", "nor", "none", "cannot", "without", "nothing"]
ARTEFACT_WORDS = ["user", "link", "http", "https"]
