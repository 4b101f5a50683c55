"""Default wording: triage reasons, reply templates and label rationales.

All of it is data.  Pass another ``Voice`` to change the brand's wording; the
placeholders are {brand}, {signature}, {carrier} and {neighbour}.
"""

from __future__ import annotations

from dataclasses import dataclass, field

RISK_REASON = "Safety rule fired: {category} found in the message."
HUMAN_REASON = "The customer asked for a person."
GATE_REASON = ("Confidence ", " is under the gate; a specialist asks for clarification.")

POLICY_REASONS = {
    "security": "Possible account takeover; identity has to be checked in private.",
    "billing": "A charge is in question; the billing team has to look at the account.",
    "damaged_delivery": "The parcel is lost, stolen or not where the carrier says; the carrier must trace it.",
    "damaged_goods": "The goods are damaged or wrong; a replacement or refund needs approval.",
    "delivery_loss": "Marked as delivered but not received; the carrier must check this account's parcel.",
    "delivery_auto": "Tracking and arrival questions are answered by the order page.",
    "change_dispatched": "The parcel has left or went to the wrong place; it needs an intercept or a supervisor.",
    "change_auto": "Changes before dispatch can be made on the order page.",
    "refund_overdue": "An outstanding refund can only be looked up in the customer's account.",
    "refund_auto": "Returns and labels are available on the order page.",
    "technical_auto": "First troubleshooting steps can be given without an agent.",
    "feedback_hostile": "The customer is very upset; a supervisor should answer.",
    "feedback_auto": "General feedback gets a courteous acknowledgement.",
    "follow_up": "Follow-up: the customer sent the order number asked for.",
    "constant": "Constant baseline.",
    "keyword_hit": "A keyword of the baseline matched.",
    "keyword_miss": "No keyword of the baseline matched.",
    "error": "The message could not be processed; a person takes over.",
}

NEIGHBOUR_HINT = "Parcels are sometimes handed to neighbors or put in a quiet spot on the property, so a quick look is worth it. "
DEFAULT_CARRIER = "the carrier"

# Each reply says what happens next, then what the customer should do.  The words that the rubric counts (direct message,
# specialist, secure, [link], ...) appear where they carry the meaning.
ESCALATION_REPLIES = {
    "AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION":
        "A support specialist is ready to assist, one thing is missing: what happened, and when? A direct message via [link] "
        "is the place for it. {signature}",
    "LOST_OR_STOLEN_DELIVERY":
        "That parcel should have reached you, sorry. {neighbour}Our specialist will investigate the trail with {carrier}; for that "
        "we need the order number by direct message over the secure form [link], never in a public post. {signature}",
    "ACCOUNT_SECURITY_RISK":
        "Step one: reset your password. Step two: tell an account specialist at the secure portal [link] what you noticed. "
        "Neither passwords nor payment data belong in a public post. {signature}",
    "FINANCIAL_OR_BILLING_DISPUTE":
        "Every charge can be traced, and we understand that this one needs an answer. An account specialist will walk through it "
        "with you; open the conversation on our secure page [link] or by DM. {signature}",
    "DAMAGED_PHYSICAL_MERCHANDISE":
        "Sorry, goods should not arrive like that. With the order number (direct message, [link]) a specialist will investigate "
        "and arrange whichever you prefer, replacement or refund. {signature}",
    "ACCOUNT_SPECIFIC_PII_REQUIRED":
        "Your post shows private details: deleting it is the safest thing to do now. An account specialist can assist through the "
        "verified portal [link], where nobody will ask for credentials. {signature}",
}
HUMAN_REPLY = (
    "A person it is! One specialist takes over from here and will look at everything in one go; the direct message line is "
    "[link]. {signature}"
)
APOLOGY_REPLY = (
    "You deserved better, and we are sorry. A representative with the right to decide will review the case as soon as a direct "
    "message from you arrives: [link]. {signature}"
)
AUTO_REPLIES = {
    "DELIVERY_STATUS_DELAY":
        "Late parcels are annoying, sorry! Where it is and when it is due can be seen live: open [link], choose the order, then "
        "track. {signature}",
    "REFUND_RETURN_EXCHANGE":
        "Returns run without waiting for us: open the orders page [link], select what goes back, and print the label; postage is "
        "paid. {signature}",
    "ORDER_CHANGE_CANCEL":
        "Until an order ships it is yours to change or cancel: open it at [link] and click the matching button. {signature}",
    "TECHNICAL_PRODUCT_SUPPORT":
        "Three things solve most glitches, step by step: restart, update the app, empty its cache. Still stuck? The guides at "
        "[link] go deeper. {signature}",
}
FEEDBACK_REPLY = "Good to hear from you, thank you! Should an order ever need a hand, we can assist right here. {signature}"
FOLLOW_UP_REPLY = (
    "Got it: the number is with the specialist who handles your case, and the answer comes in private. For your security, take "
    "down any public post that shows it. ^CS"
)
CONSTANT_REPLY = "{brand} here, hello! Order status and self-service are one click away on the orders page. ^CS"
KEYWORD_DEFAULT_REPLY = "Thanks for writing! The account page answers most questions, and our team answers the rest. ^CS"
ERROR_REPLY = "Our system stumbled over this message, so a support specialist reads it next. ^CS"
SOLICIT_REPLACEMENT = "use the private channel at [link] instead"

PROPOSAL_REASONS = {
    "DAMAGED_WRONG_MISSING": "Defects, missing contents and lost parcels need a carrier check and approval.",
    "ACCOUNT_SECURITY_ACCESS": "Security problems need a person and a private identity check.",
    "BILLING_SUBSCRIPTION_PRIME": "Disputed charges need an identity check and an account review.",
    "delivery_loss": "Reported as delivered or lost; the carrier and the account have to be checked.",
    "delivery_auto": "In transit; the customer can follow the parcel online.",
    "change_dispatched": "Already under way; an intercept or manual return is needed.",
    "change_auto": "Can be cancelled online before dispatch.",
    "refund_overdue": "An overdue refund has to be looked up in the account.",
    "refund_auto": "Return rules and labels are available online.",
    "technical_auto": "First troubleshooting steps can be given automatically.",
    "feedback_hostile": "Very upset customer or formal grievance; a supervisor should answer.",
    "feedback_auto": "Polite or general comment; an acknowledgement is enough.",
}
ADVERSARIAL_REASONS = {
    "hostile": "Hostility or legal threat",
    "collision": "Three or more intents: ",
    "terse": "Very short message without context",
    "sarcasm": "Sarcasm",
}
PASS1_NOTES = {
    "praise": "Customer praises solved issue; acknowledge.",
    "missing": "Marked as delivered but not received; the carrier has to trace it.",
    "wallet": "Wallet or cashback credit in dispute; billing has to review it.",
    "change": "Change before dispatch.",
    "refund": "Customer demands a refund for a late parcel; an override is needed.",
}
PASS2_REASONS = {
    "misconduct": "Review: property damage, theft or legal threat needs a supervisor.",
    "blocked": "Review: blocked account needs a manual identity check.",
    "refund": "Review: missing refund needs a look into the customer's ledger.",
    "missing": "Review: delivered but not received; the carrier has to trace it.",
    "praise": "Review: praise for a solved issue; acknowledge politely.",
    "change": "Review: cancelling before dispatch can be done online.",
    "charge": "Review: disputed charge or missing credit needs the billing team.",
    "delivery": "Review: routine tracking question; self-service is enough.",
    "technical": "Review: first troubleshooting steps are enough.",
    "fallback": "Review: label confirmed. Intent: ",
}


@dataclass(frozen=True)
class Voice:
    """Reply wording of one brand."""

    brand: str = "our help team"
    escalation: dict = field(default_factory=lambda: dict(ESCALATION_REPLIES))
    auto: dict = field(default_factory=lambda: dict(AUTO_REPLIES))
    human: str = HUMAN_REPLY
    apology: str = APOLOGY_REPLY
    feedback: str = FEEDBACK_REPLY
    neighbour_hint: str = NEIGHBOUR_HINT
    default_carrier: str = DEFAULT_CARRIER
