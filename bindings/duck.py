"""SQL building blocks for the oracle side (DuckDB dialect).

The texts mirror ``inputs`` and the library's semantics with other means: RE2 has no
lookaround, so guards are written as replace-then-match.
"""

from __future__ import annotations

from bindings.inputs import MESSAGES, REPLIES, STOP_WORDS
from triagelake import brand_voice as B
from triagelake import fixed_values as V

SPACE = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = "[^" + SPACE[1:]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def rx(col: str, pat: str) -> str:
    """Case-insensitive search; null counts as no match."""
    return f"coalesce(regexp_matches({col}, {q(pat)}, 'i'), false)"


def sub(col: str, pat: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({col}, {q(pat)}, {q(by)}, {q(flags)})"


def squeeze(col: str) -> str:
    return f"trim({sub(col, SPACE + '+', ' ')})"


def strip(col: str) -> str:
    return sub(col, rf"\A{SPACE}+|{SPACE}+\z", "")


def clean_kb(col: str) -> str:
    return squeeze(sub(sub(col, r"@\d+", "@User"), rf"https?://t\.co/{NOT_SPACE}+", "[link]"))


def clean_query(col: str) -> str:
    return squeeze(sub(sub(col, r"@\d+", "@User"), rf"https?://{NOT_SPACE}+", "[link]"))


def clean_topic(col: str) -> str:
    return strip(sub(sub(col, r"@[\pL\pN_]+", ""), rf"https?://{NOT_SPACE}+", ""))


def escape(col: str) -> str:
    out = col
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def mask(col: str) -> str:
    """Card, code, id, e-mail, phone, credential words; context is captured and put back."""
    t = f"coalesce({col}, '')"
    t = sub(t, V.CARD, "[card-redacted]")
    t = sub(t, V.CVV, "[cvv-redacted]", "gi")
    t = sub(t, V.NATIONAL_ID, "[ssn-redacted]")
    t = sub(t, V.EMAIL, "[email-redacted]")
    core = r"(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)\d{3}[-.\s]?\d{4}"
    # twice: two numbers may share the character between them, and a match consumes it
    for _ in range(2):
        t = sub(t, rf"(^|[^0-9-]|[^0-9]-){core}($|[^0-9-]|-$|-[^0-9])", r"\1[phone-redacted]\2")
    t = f"replace({t}, '[cvv-redacted]', '[c#v-redacted]')"
    t = sub(t, r"\b(credit card|cvv|password|full card number)\b", "[redacted]", "gi")
    return f"replace({t}, '[c#v-redacted]', '[cvv-redacted]')"


def tokens_of(col: str) -> str:
    """Whitespace tokens, lowercased; [] for blank texts."""
    s = squeeze(f"lower({col})")
    return f"(CASE WHEN {s} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({s}, ' ') END)"


def words_of(col: str, min_len: int = 1) -> str:
    return f"regexp_extract_all(lower({col}), '[\\pL\\pN_]{{{min_len},}}')"


def letters_of(col: str, n: int) -> str:
    return f"list_filter({words_of(col)}, lambda w: regexp_full_match(w, '[a-z]{{{n},}}'))"


def english(col: str, words, min_chars: int) -> str:
    hits = f"len(list_intersect(list_distinct({words_of(col)}), {strings(words)}))"
    return f"coalesce(length({col}) >= {min_chars} AND {hits} >= 2, false)"


def signature(col: str) -> str:
    s = strip(col)
    return (
        f"(CASE WHEN regexp_matches({s}, '\\^[a-zA-Z]{{2,3}}$') THEN '^' || regexp_extract({s}, '\\^([a-zA-Z]{{2,3}})$', 1) "
        f"ELSE {q(V.DEFAULT_SIGNATURE)} END)"
    )


def signed(col: str) -> str:
    return f"regexp_matches({strip(col)}, '\\^[a-zA-Z]{{2,3}}$')"


def hex_int(n: int, *parts: str) -> str:
    return f"CAST('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, {n}) AS BIGINT)"


def seeded(*ids: str) -> str:
    return "md5('" + str(V.SEED) + ":' || " + " || ':' || ".join(f"CAST({i} AS VARCHAR)" for i in ids) + ")"


# --- rules -----------------------------------------------------------------------

_INTENTS = dict(V.INTENT_PATTERNS)
_NEGATED = {"BILLING_SUBSCRIPTION_PRIME": V.NEGATED_BILLING, "REFUND_RETURN_EXCHANGE": V.NEGATED_REFUND}


def labels(cases: list[tuple[str, str]]) -> str:
    """List of labels whose test holds, in order."""
    items = ", ".join(f"CASE WHEN {test} THEN {q(label)} END" for label, test in cases)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def detect(col: str, negation: bool = True) -> str:
    cases = []
    for name, pat in V.INTENT_PATTERNS:
        test = rx(col, pat)
        if negation and name in _NEGATED:
            test = f"({test} AND {rx(sub(col, _NEGATED[name], '', 'gi'), pat)})"
        cases.append((name, test))
    return labels(cases)


def priority(lst: str) -> str:
    whens = " ".join(f"WHEN list_contains({lst}, {q(i)}) THEN {q(i)}" for i in V.INTENT_PRIORITY)
    return f"(CASE {whens} ELSE {q(V.GENERAL_INTENT)} END)"


_BILLING_PHRASES = (
    "unauthorized charge|charged my card|double charged|unrecognized charge|bank fee|stolen credit card|chargeback|"
    "paisa kat|paise kat|amount deduct|extra charge|unauthorized debit"
)


def risk(col: str) -> str:
    whens = []
    for name, pat in V.RISK_PATTERNS:
        if "(?<!" in pat:
            guarded = sub(col, rf"(not|never|no|wasn't)\s({_BILLING_PHRASES})\b", "#", "gi")
            test = rx(guarded, rf"\b({_BILLING_PHRASES})\b")
        else:
            test = rx(col, pat)
        whens.append(f"WHEN {test} THEN {q(name)}")
    return f"(CASE {' '.join(whens)} END)"


def risk_reason(cat: str) -> str:
    a, b = B.RISK_REASON.split("{category}")
    return f"{q(a)} || replace(lower({cat}), '_', ' ') || {q(b)}"


def hit(test: str, a: str, b: str) -> str:
    return f"(CASE WHEN {test} THEN {a} ELSE {b} END)"


def _o(decision: str, category: str, reason: str) -> str:
    return "{'d': " + q(decision) + ", 'c': " + q(category) + ", 'r': " + q(reason) + "}"


def policy(col: str, intent: str) -> str:
    P = B.POLICY_REASONS
    E, A = V.ESCALATE, V.AUTO
    lost, override = "LOST_OR_STOLEN_DELIVERY", "MANUAL_REFUND_OR_RETURN_OVERRIDE"
    return f"""(CASE {intent}
      WHEN 'ACCOUNT_SECURITY_ACCESS' THEN {_o(E, 'ACCOUNT_SECURITY_RISK', P['security'])}
      WHEN 'BILLING_SUBSCRIPTION_PRIME' THEN {_o(E, 'FINANCIAL_OR_BILLING_DISPUTE', P['billing'])}
      WHEN 'DAMAGED_WRONG_MISSING' THEN {hit(rx(col, V.DAMAGED_DELIVERY), _o(E, lost, P['damaged_delivery']), _o(E, 'DAMAGED_PHYSICAL_MERCHANDISE', P['damaged_goods']))}
      WHEN 'DELIVERY_STATUS_DELAY' THEN {hit(rx(col, V.DELIVERY_LOSS), _o(E, lost, P['delivery_loss']), _o(A, 'NONE', P['delivery_auto']))}
      WHEN 'ORDER_CHANGE_CANCEL' THEN {hit(rx(col, V.ORDER_DISPATCHED), hit(rx(col, V.WRONG_ADDRESS), _o(E, lost, P['change_dispatched']), _o(E, override, P['change_dispatched'])), _o(A, 'NONE', P['change_auto']))}
      WHEN 'REFUND_RETURN_EXCHANGE' THEN {hit(rx(col, V.REFUND_DELAY), _o(E, override, P['refund_overdue']), _o(A, 'NONE', P['refund_auto']))}
      WHEN 'TECHNICAL_PRODUCT_SUPPORT' THEN {_o(A, 'NONE', P['technical_auto'])}
      ELSE {hit(rx(col, V.HOSTILITY), _o(E, 'CUSTOMER_AGITATION_OR_LEGAL_THREAT', P['feedback_hostile']), _o(A, 'NONE', P['feedback_auto']))} END)"""


def triage(col: str, intent: str, conf: str, cat: str) -> str:
    a, b = B.GATE_REASON
    return f"""(CASE
      WHEN {conf} < {V.CONFIDENCE_GATE} THEN {{'d': 'ESCALATE', 'c': 'AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION',
         'r': {q(a)} || printf('%.2f', {conf}) || {q(b)}}}
      WHEN {cat} IS NOT NULL THEN {{'d': 'ESCALATE', 'c': {cat}, 'r': {risk_reason(cat)}}}
      WHEN {rx(col, V.HUMAN_REQUEST)} THEN {_o(V.ESCALATE, 'CUSTOMER_AGITATION_OR_LEGAL_THREAT', B.HUMAN_REASON)}
      ELSE {policy(col, intent)} END)"""


def fill(template: str) -> str:
    t = q(template)
    t = f"replace({t}, '{{neighbour}}', CASE WHEN cue_neighbour THEN {q(B.NEIGHBOUR_HINT)} ELSE '' END)"
    t = f"replace({t}, '{{carrier}}', coalesce(cue_carrier, {q(B.DEFAULT_CARRIER)}))"
    return f"replace({t}, '{{signature}}', cue_signature)"


def draft(col: str) -> str:
    esc = " ".join(f"WHEN {q(k)} THEN {fill(v)}" for k, v in B.ESCALATION_REPLIES.items())
    auto = " ".join(f"WHEN {q(k)} THEN {fill(v)}" for k, v in B.AUTO_REPLIES.items())
    human = hit(rx(col, V.HUMAN_MENTION), fill(B.HUMAN_REPLY), fill(B.APOLOGY_REPLY))
    return (
        f"(CASE WHEN decision = 'ESCALATE' THEN CASE escalation_category {esc} ELSE {human} END "
        f"ELSE CASE intent {auto} ELSE {fill(B.FEEDBACK_REPLY)} END END)"
    )


def sanitize(col: str) -> str:
    return mask(sub(col, V.CREDENTIAL_SOLICITING, B.SOLICIT_REPLACEMENT, "gi"))


def add_signoff(col: str) -> str:
    return f"(CASE WHEN {signed(col)} THEN {col} ELSE {strip(col)} || ' {V.DEFAULT_SIGNATURE}' END)"


def contains_any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def count_contained(col: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({col}, {q(w)}) AS INT)" for w in words) + ")"


def carrier(col: str) -> str:
    whens = " ".join(f"WHEN {rx(col, chr(92) + 'b' + c + chr(92) + 'b')} THEN {q(c)}" for c in V.CARRIERS)
    return f"(CASE {whens} END)"


def rubric(reply: str, intent: str, decision: str) -> dict[str, str]:
    low = f"lower({reply})"
    ground = " ".join(f"WHEN {q(k)} THEN {count_contained(low, w)}" for k, w in V.GROUNDING_KEYWORDS.items())
    n = f"(CASE {intent} {ground} ELSE {count_contained(low, V.DEFAULT_GROUNDING)} END)"
    act = count_contained(low, V.ACTION_MARKERS)
    emp = contains_any(low, V.EMPATHY_MARKERS)
    return {
        "groundedness": f"(CASE WHEN {n} >= 3 THEN 5 WHEN {n} = 2 THEN 4 WHEN {n} = 1 THEN 3 ELSE 2 END)",
        "actionability": f"(CASE WHEN {act} >= 2 THEN 5 WHEN {act} = 1 THEN 4 ELSE 2 END)",
        "tone": f"(CASE WHEN {emp} AND {signed(reply)} THEN 5 WHEN {emp} OR {signed(reply)} THEN 4 "
                f"WHEN len({tokens_of(reply)}) > 10 THEN 3 ELSE 2 END)",
        "pii_safety": f"(CASE WHEN {rx(reply, V.RUBRIC_SENSITIVE)} THEN 1 WHEN {decision} = 'ESCALATE' AND NOT "
                      f"{rx(reply, V.RUBRIC_PRIVATE_CHANNEL)} THEN 2 ELSE 5 END)",
    }


HUNDREDTHS = "(35*groundedness + 25*actionability + 20*tone + 20*pii_safety)"
PASSED = f"(groundedness >= 4 AND actionability >= 4 AND pii_safety >= 4 AND {HUNDREDTHS} >= 380)"

_MESSAGE = f"{strings(MESSAGES)}[(conv_id*7 + turn) % {len(MESSAGES)} + 1]"
_REPLY = f"{strings(REPLIES)}[(conv_id*5 + turn) % {len(REPLIES)} + 1]"
_PROPOSE = B.PROPOSAL_REASONS


def propose(col: str, intent: str, tier: str, cat: str) -> str:
    E, A = V.ESCALATE, V.AUTO
    lost, override = "LOST_OR_STOLEN_DELIVERY", "MANUAL_REFUND_OR_RETURN_OVERRIDE"
    W = _PROPOSE
    return f"""(CASE WHEN {cat} IS NOT NULL THEN {{'d': 'ESCALATE', 'c': {cat}, 'r': {risk_reason(cat)}}} ELSE CASE {intent}
      WHEN 'DAMAGED_WRONG_MISSING' THEN {_o(E, 'DAMAGED_PHYSICAL_MERCHANDISE', W['DAMAGED_WRONG_MISSING'])}
      WHEN 'ACCOUNT_SECURITY_ACCESS' THEN {_o(E, 'ACCOUNT_SECURITY_RISK', W['ACCOUNT_SECURITY_ACCESS'])}
      WHEN 'BILLING_SUBSCRIPTION_PRIME' THEN {_o(E, 'FINANCIAL_OR_BILLING_DISPUTE', W['BILLING_SUBSCRIPTION_PRIME'])}
      WHEN 'DELIVERY_STATUS_DELAY' THEN {hit(rx(col, V.PROPOSE_DELIVERY_LOSS), _o(E, lost, W['delivery_loss']), _o(A, 'NONE', W['delivery_auto']))}
      WHEN 'ORDER_CHANGE_CANCEL' THEN {hit(rx(col, V.PROPOSE_DISPATCHED), _o(E, override, W['change_dispatched']), _o(A, 'NONE', W['change_auto']))}
      WHEN 'REFUND_RETURN_EXCHANGE' THEN {hit(rx(col, V.PROPOSE_REFUND_OVERDUE), _o(E, override, W['refund_overdue']), _o(A, 'NONE', W['refund_auto']))}
      WHEN 'TECHNICAL_PRODUCT_SUPPORT' THEN {_o(A, 'NONE', W['technical_auto'])}
      ELSE {hit(f"({tier} = 'adversarial' OR {rx(col, V.PROPOSE_HOSTILE)})", _o(E, 'CUSTOMER_AGITATION_OR_LEGAL_THREAT', W['feedback_hostile']), _o(A, 'NONE', W['feedback_auto']))}
      END END)"""


def adversarial(col: str, lst: str, intent: str) -> str:
    r = B.ADVERSARIAL_REASONS
    return f"""(CASE WHEN {rx(col, V.ADVERSARIAL_HOSTILE)} THEN {q(r['hostile'])}
      WHEN len({lst}) >= 3 THEN {q(r['collision'])} || array_to_string({lst}, ', ')
      WHEN len({tokens_of(col)}) <= 4 AND {intent} = '{V.GENERAL_INTENT}' THEN {q(r['terse'])}
      WHEN {rx(col, V.ADVERSARIAL_SARCASM)} THEN {q(r['sarcasm'])} END)"""


# --- shared tables ------------------------------------------------------------------

_CLASSES = strings(V.INTENTS)

CTES: dict[str, tuple[list[str], str]] = {
    "keyed": ([], "SELECT *, conv_id || ':' || turn AS msg_id, 'brand_' || (conv_id % 6) AS brand FROM conversations"),
    "inbox": (["keyed"], f"SELECT conv_id, turn, msg_id, brand, {_MESSAGE} || ' ' || text AS text FROM keyed WHERE role = 'user'"),
    "msgs": (["keyed"], f"""SELECT msg_id AS message_id, CASE WHEN turn > 0 THEN conv_id || ':' || (turn - 1) END AS parent_id,
        CASE WHEN role = 'user' THEN 'c' || conv_id ELSE brand END AS author_id, role = 'user' AS inbound,
        CASE WHEN role = 'user' THEN {_MESSAGE} || ' ' || text || CASE WHEN turn % 2 = 0 THEN ' @' || upper(brand) ELSE '' END
          ELSE text || ' ' || {_REPLY} END AS text,
        CASE WHEN turn < 6 THEN conv_id || ':' || (turn + 1) END AS response_id FROM keyed WHERE role <> 'system'"""),
    "pairs": (["keyed"], f"""SELECT u.conv_id, u.turn, u.msg_id AS conversation_id, u.brand, u.text AS customer_text, a.text AS support_reply
        FROM (SELECT conv_id, turn, msg_id, brand, {_MESSAGE} || ' ' || text AS text FROM keyed WHERE role = 'user') u
        JOIN (SELECT conv_id, turn - 1 AS turn, text || ' ' || {_REPLY} AS text FROM keyed WHERE role = 'assistant') a
          ON u.conv_id = a.conv_id AND u.turn = a.turn"""),
    "threads": (["keyed"], f"""SELECT brand, conv_id AS conversation_id,
        arg_min(CASE WHEN role = 'user' THEN {_MESSAGE} || ' ' || text END, turn) FILTER (role = 'user') AS customer_text,
        arg_min(CASE WHEN role = 'assistant' THEN text || ' ' || {_REPLY} END, turn) FILTER (role = 'assistant') AS support_reply,
        count(*) FILTER (role <> 'system') AS turn_count FROM keyed GROUP BY ALL"""),
    "found": (["inbox"], f"""SELECT *, {detect('clean')} AS detected, {detect('clean', False)} AS raw_detected
        FROM (SELECT *, {clean_query('text')} AS clean FROM inbox)"""),
    "weights": (["found"], f"""SELECT *, list_transform({_CLASSES}, lambda c: ({hex_int(2, 'msg_id', 'c')} + 1)
        * ({hex_int(2, 'msg_id', 'c')} + 1) * ({hex_int(2, 'msg_id', 'c')} + 1)
        * CASE WHEN list_contains(raw_detected, c) THEN 40 ELSE 1 END) AS w FROM found"""),
    "posts": (["weights"], "SELECT * EXCLUDE (w), list_transform(w, lambda x: x::DOUBLE / list_sum(w)::DOUBLE) AS posterior FROM weights"),
    "classified": (["posts"], f"""SELECT * EXCLUDE (intent0, p0), intent0 AS intent, round(p0, 4) AS intent_confidence FROM (
        SELECT *, CASE WHEN len(detected) = 0 THEN {_CLASSES}[list_position(posterior, list_max(posterior))]
            WHEN list_contains(detected, '{V.SECURITY_INTENT}') THEN '{V.SECURITY_INTENT}'
            ELSE detected[list_position(list_transform(detected, lambda d: posterior[list_position({_CLASSES}, d)]),
                 list_max(list_transform(detected, lambda d: posterior[list_position({_CLASSES}, d)])))] END AS intent0,
          CASE WHEN len(detected) = 0 THEN list_max(posterior)
            WHEN list_contains(detected, '{V.SECURITY_INTENT}') THEN posterior[list_position({_CLASSES}, '{V.SECURITY_INTENT}')]
            ELSE list_max(list_transform(detected, lambda d: posterior[list_position({_CLASSES}, d)])) END AS p0
        FROM posts)"""),
    "triaged": (["classified"], f"""SELECT * EXCLUDE (risk, o), o.d AS decision, o.c AS escalation_category, o.r AS reason FROM (
        SELECT *, {triage('clean', 'intent', 'intent_confidence', 'risk')} AS o
        FROM (SELECT *, {risk('clean')} AS risk FROM classified))"""),
    "cued": (["triaged"], f"""SELECT * EXCLUDE (past), {signature('past')} AS cue_signature, {carrier('past')} AS cue_carrier,
        {rx('past', V.NEIGHBOUR_CHECK)} AS cue_neighbour FROM (
        SELECT *, CASE WHEN similarity >= {V.EVIDENCE_GATE} THEN past_reply ELSE '' END AS past FROM (
          SELECT *, round({hex_int(4, 'msg_id', "'similarity'")} / 65536.0 / 2, 4)::DOUBLE AS similarity, {_REPLY} AS past_reply FROM triaged))"""),
    "drafted": (["cued"], f"SELECT *, {draft('clean')} AS draft FROM cued"),
    "scored": (["drafted"], f"SELECT * EXCLUDE (m), {add_signoff('m')} AS reply FROM (SELECT *, {sanitize('draft')} AS m FROM drafted)"),
    "gold": (["inbox"], f"""SELECT msg_id AS case_id, conv_id, turn, text AS customer_text, difficulty_tier,
        CASE WHEN len(detected) > 0 THEN detected ELSE [intent] END AS all_applicable_intents, adversarial_reason,
        CASE WHEN adversarial_reason IS NOT NULL THEN 'adversarial' WHEN len(detected) = 2 THEN 'collision' ELSE intent END AS pool,
        intent AS proposed_intent, o.d AS proposed_triage, o.c AS proposed_escalation_category, o.r AS proposed_escalation_reason
        FROM (SELECT *, {adversarial('text', 'detected', 'intent')} AS adversarial_reason,
                {propose('text', 'intent', 'difficulty_tier', 'risk')} AS o
          FROM (SELECT *, {priority('detected')} AS intent, {risk('text')} AS risk,
              CASE WHEN th < 45000 THEN 'normal' WHEN th < 58000 THEN 'difficult' ELSE 'adversarial' END AS difficulty_tier
            FROM (SELECT *, {detect('text', False)} AS detected, {hex_int(4, 'msg_id', "'tier'")} AS th FROM inbox)))"""),
    "preds": (["scored"], f"""
        SELECT 'constant' AS system, msg_id AS case_id, '{V.INTENTS[0]}' AS pred_intent, 'AUTO_HANDLE' AS pred_decision,
          {q(B.CONSTANT_REPLY.replace('{brand}', 'our help team'))} AS reply, 0.5::DOUBLE AS intent_confidence FROM scored
        UNION ALL SELECT 'keyword', msg_id, {_CLASSES}[list_position(posterior, list_max(posterior))],
          CASE WHEN {rx('text', V.KEYWORD_ESCALATE)} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END,
          CASE WHEN similarity > 0.05 THEN past_reply ELSE {q(B.KEYWORD_DEFAULT_REPLY)} END, round(list_max(posterior), 4) FROM scored
        UNION ALL SELECT 'hybrid', msg_id, intent, decision, reply, intent_confidence FROM scored"""),
    "evals": (["preds", "gold"], """SELECT p.*, g.proposed_intent AS gold_intent, g.proposed_triage AS gold_decision,
        g.difficulty_tier AS tier, g.all_applicable_intents FROM preds p JOIN gold g ON p.case_id = g.case_id"""),
    "langs": ([], f"""SELECT doc_id, 'guess' AS system, lang AS gold_intent, CASE WHEN {english('text', V.ENGLISH_WORDS_STRICT, 15)} THEN 'en'
        WHEN regexp_matches(lower(text), '[üßäö]') THEN 'de' WHEN regexp_matches(lower(text), '[ñóíáú]') THEN 'es' ELSE 'fr' END AS pred_intent
        FROM documents"""),
}


def with_(*names: str, extra: list[tuple[str, str]] = ()) -> str:
    """WITH clause that holds the named shared tables and what they need."""
    done: list[str] = []

    def need(name):
        deps, _ = CTES[name]
        for d in deps:
            need(d)
        if name not in done:
            done.append(name)

    for n in names:
        need(n)
    parts = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in done] + [f"{n} AS MATERIALIZED ({s})" for n, s in extra]
    return "WITH " + ", ".join(parts) + " "


def terms(source: str, id_col: str, text: str = "text") -> str:
    """(id, term, tf) of a table."""
    stop = strings(STOP_WORDS)
    kept = f"list_filter({words_of(text, 2)}, lambda w: NOT list_contains({stop}, w))"
    return f"""SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest(list_concat(w, CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])
            ELSE CAST([] AS VARCHAR[]) END)) AS term
        FROM (SELECT {id_col} AS id, {kept} AS w FROM {source})) GROUP BY ALL"""


def vocab(counts: str, n_docs: str, size: int | None) -> str:
    return f"""SELECT term, total_tf, df, ln((1 + ({n_docs})) / (1.0 + df)) + 1 AS idf FROM (
        SELECT term, sum(tf)::BIGINT AS total_tf, count(*) AS df FROM {counts} GROUP BY term)
        {"" if size is None else f"ORDER BY total_tf DESC, term LIMIT {size}"}"""


def vectors(counts: str, vocab_: str, sublinear: bool = True) -> str:
    w = "(1 + ln(tf))" if sublinear else "tf"
    return f"""SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
        SELECT c.id, c.term, {w} * v.idf AS w FROM {counts} c JOIN {vocab_} v ON c.term = v.term)"""
