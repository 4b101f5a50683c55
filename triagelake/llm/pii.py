"""Personal data: fixed patterns, and a character tagger that is trained on their spans and adds what they miss.

The tagger (bidirectional LSTM with CRF transitions) reads overlapping windows.  Every kind has a digit, an '@' or a bracketed
'at', so a window without these holds none and is not decoded.  Windows of a text are reconciled as one: spans of neighbouring
windows that overlap are joined, and the heaviest set of spans that do not overlap is kept.  Ends of a span move to the ends of
the words or of the address they cut.  A span of the tagger must also be sound for its kind (check digit, ranges, number of digits); it never
touches a span of the fixed patterns, which always stay.

Values in other spellings than the patterns' are learnt from altered copies of the labelled spans: numbers with other
separators, phones without '+', addresses with blanks, brackets or a spelled 'at' and 'dot' (`altered`).  Windows with other
numbers in their place (dates, prices, measures, references; `decoy`) are marked as holding nothing.

Spans are looked for in all documents.  Training rows are at most `windows` windows with spans and as many without, those of
the lowest hashes; every kind has an equal share of the windows with spans first, so a kind that occurs is trained on.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.arrow_text import mix, replaced, small_batches, text_bytes
from triagelake.llm.tagger import Tagger, encode
from triagelake.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
WINDOWS = 400
PLAIN = len(KINDS)
MARGIN = 2.0
AT_ONCE = 512
COPIES = 3
LONGEST = 320
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# not behind a digit: a run of digits that fails once fails from each of its digits
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = r"(?:@|[(\[{<]\s?at\s?[)\]}>])"
_DOT = r"(?:\.|[(\[{<]\s?(?:dot|\.)\s?[)\]}>]|\sdot\s)"
_ADDRESS = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}\s*{_AT}\s*[A-Za-z0-9-]+(?:\s*{_DOT}\s*[A-Za-z0-9-]+)*\s*{_DOT}\s*[A-Za-z]{{2,24}}", re.IGNORECASE)
_IP_GAP = re.compile(rf"\s*{_DOT}\s*", re.IGNORECASE)
_PLAIN_PHONE = re.compile(r"\+?\(?[0-9](?:[^0-9A-Za-z:,;@#%]{0,5}[0-9])+")
_JOINED_BEFORE, _JOINED_AFTER = re.compile(r"[0-9][-./:]$|#$"), re.compile(r"[-./:][0-9]")
_SPELLED = r"(?i)[(\[{<]\s?at\s?[)\]}>]"
_EVIDENCE = re.compile(rf"(?i)[0-9@]|{_SPELLED[4:]}", re.ASCII)
_HAS_EVIDENCE = np.zeros(256, dtype=bool)
_HAS_EVIDENCE[[*range(0x30, 0x3A), 0x40]] = True


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_CHAR:
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            out.append((begin, 0, domain.end()))
            free = domain.end()
        else:
            free = at + 1  # no local part reaches over an '@'
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def sound(kind: int, text: str, start: int, end: int) -> bool:
    """A tagged span is a plausible whole value of its kind: form, ranges, check digit, number of digits."""
    if end - start > LONGEST:
        return False
    body = text[start:end]
    d = _digits(body)
    if text[start - 1 : start].isdigit() and body[:1].isdigit() or text[end : end + 1].isdigit() and body[-1:].isdigit():
        return False
    if kind == 0:
        return _ADDRESS.fullmatch(body) is not None
    if not body.isascii() and re.search(r"[^\W_]", re.sub(r"[\x00-\x7F]", "", body)):
        return False
    if kind == 1:
        parts = re.split(r"[^0-9]+", body)
        return len(parts) == 4 and all(p and _small(p) for p in parts) and all(_IP_GAP.fullmatch(g) for g in re.findall(r"[^0-9]+", body))
    if kind == 2:
        return 14 <= len(d) <= 19 and luhn(d) and re.fullmatch(r"[0-9](?:[^0-9A-Za-z]{0,3}[0-9])+", body) is not None
    # a part of a longer row of numbers (a date with its time, a reference) is not whole; only the first group has one digit
    if _JOINED_BEFORE.search(text[max(0, start - 2) : start]) or _JOINED_AFTER.match(text[end : end + 2]):
        return False
    groups = re.findall(r"[0-9]+", body.removeprefix("00"))
    return 10 <= len(d) <= 15 and len(groups) > 1 and min(map(len, groups[1:])) > 1 and _PLAIN_PHONE.fullmatch(body) is not None


def settled(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """The span without blanks and punctuation at its ends, and with the whole words (up to 64 characters) that it cuts; of an address, its form in the span."""
    own = _LOCAL_CHAR if kind == 0 else frozenset("0123456789")
    opening = own if kind != 3 else own | {"+", "("}
    while start < end and text[start] not in opening:
        start += 1
    while end > start and (text[end - 1] not in own or text[end - 1] in "._%+-"):
        end -= 1
    least, most = max(0, start - 64), min(len(text), end + 64)
    while start > least and text[start - 1] in own and start < end:
        start -= 1
    while end < most and text[end] in own and text[end] not in "._%+" and start < end:
        end += 1
    if kind == 3 and start < end:
        while start > 0 and text[start - 1] in "(+":
            start -= 1
    if kind == 0 and start < end:
        whole = _ADDRESS.search(text[start : start + LONGEST])
        if whole and start + whole.start() < end:
            start, end = start + whole.start(), start + whole.end()
    return start, end


_NUMBER_GAPS = (" ", "-", ".", "/", "  ", " - ", "\n", "_", "\u00a0")
_ADDRESS_ATS = ("@", " @ ", "@ ", " @", "(at)", " (at) ", "[at]", " [at] ", "{at}", "\n@")
_ADDRESS_DOTS = (".", ".", " . ", "(dot)", " (dot) ", "[dot]", "[.]", " dot ")
_IP_DOTS = (" . ", ". ", "[.]", "(.)", " .", " dot ", "[dot]", "(dot)")


def _draw(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n).tolist()))


def _pick(rng: np.random.Generator, values):
    return values[int(rng.integers(len(values)))]


def _checked(rng: np.random.Generator, n: int) -> str:
    body = str(int(rng.integers(3, 7))) + _draw(rng, n - 2)
    return next(body + c for c in "0123456789" if luhn(body + c))


def altered(kind: int, body: str, rng: np.random.Generator) -> str:
    """The value, or one with other digits, in another spelling."""
    if kind == 0:
        local, _, domain = body.partition("@")
        if rng.random() < 0.5:
            letters = "abcdefghijklmnopqrstuvwxyz"
            local = "".join(_pick(rng, letters) for _ in range(int(rng.integers(2, 9)))) + _pick(rng, ("", "", ".", "_", "-")) + _pick(rng, (_draw(rng, 2), _pick(rng, letters) * 2, "lee", "max"))
            domain = "".join(_pick(rng, letters) for _ in range(int(rng.integers(3, 9)))) + "." + _pick(rng, ("com", "org", "net", "de", "fr", "es", "co.uk", "edu"))
        return local + _pick(rng, _ADDRESS_ATS) + _pick(rng, _ADDRESS_DOTS).join(domain.split("."))
    if kind == 1:
        parts = body.split(".") if rng.random() < 0.4 else [str(int(x)) for x in rng.integers(0, 256, 4)]
        return _pick(rng, _IP_DOTS).join(parts)
    if kind == 2:
        d = _digits(body) if rng.random() < 0.3 else _checked(rng, _pick(rng, (14, 15, 16, 16, 16, 19)))
        sizes = (4, 6, 9) if len(d) in (14, 15) else (4,) * 5
        ends = [0, *accumulate(sizes)]
        return _pick(rng, _NUMBER_GAPS).join(d[x:y] for x, y in zip(ends, ends[1:]) if d[x:y])
    d = _digits(body)
    d = d[-10:] if rng.random() < 0.3 else str(int(rng.integers(2, 10))) + _draw(rng, 9)
    gap, front = _pick(rng, _NUMBER_GAPS), _pick(rng, ("", "", "", "1", "00 1", "0", "+1", "0049", "+33"))
    area = _pick(rng, ("{}", "({})", "({}) ")).format(d[:3])
    return front + (gap if front and not front.endswith("0") else " " if front else "") + area + ("" if area.endswith(" ") else gap) + d[3:6] + gap + d[6:]


def decoy(rng: np.random.Generator) -> str:
    """Numbers that are no personal data."""
    n = lambda k: str(int(rng.integers(1, 10))) + _draw(rng, k - 1)
    two = lambda top: f"{int(rng.integers(1, top)):02d}"
    year = str(int(rng.integers(1900, 2100)))
    gap = _pick(rng, ("-", "/", "."))
    day = gap.join((year, two(13), two(29))) if rng.random() < 0.5 else gap.join((two(29), two(13), year))
    return _pick(rng, (
        lambda: day, lambda: f"{day} {two(24)}:{two(60)}:{two(60)}", lambda: f"{day}T{two(24)}:{two(60)}", lambda: f"{year}-{int(year) + 1}",
        lambda: f"{n(3)},{n(3)}.{n(2)}", lambda: f"{n(2)}.{n(1)} x {n(2)}.{n(1)}", lambda: f"v{n(1)}.{n(2)}.{n(1)}", lambda: n(int(rng.integers(2, 20))),
        lambda: f"{n(3)} {n(3)} {n(3)}", lambda: f"{n(2)}, {n(3)}, {n(2)}, {n(4)}", lambda: f"{n(1)}. {n(2)}. {n(1)}.", lambda: f"#{n(7)}-{n(3)}",
        lambda: f"{n(3)}-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: f"{n(5)} ({n(2)} %)", lambda: f"{n(4)} (at) {n(2)}", lambda: f"@{n(3)}", lambda: f"{n(2)} @ {n(2)}.{n(2)}",
    ))()


def window_starts(text: str) -> list[int]:
    """Starts of the windows that have a digit or an '@'."""
    out: set[int] = set()
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) if len(text) > WINDOW else 0
    for m in _EVIDENCE.finditer(text):
        k = m.start() // STRIDE
        out.update(w for w in range(max(0, k - WINDOW // STRIDE + 1), k + 1) if w <= last)
        if k > last:
            out.add(last)
    return sorted(w * STRIDE for w in out)


def _gold(spans, start: int) -> np.ndarray:
    tags = np.zeros(WINDOW, dtype=np.int64)
    for s, kind, e in spans:
        lo, hi = max(s, start), min(e, start + WINDOW)
        if lo < hi and not tags[lo - start : hi - start].any():
            tags[lo - start : hi - start] = 2 * kind + 2
            tags[lo - start] = 2 * kind + 1
    return tags


def _padded(text: str, start: int) -> np.ndarray:
    row = np.full(WINDOW, 32, dtype=np.int64)
    own = encode(text[start : start + WINDOW])
    row[: len(own)] = own
    return row


def _marked_windows(text: str):
    """(start, tags) of the windows that have a span and of the first that has none."""
    spans, at, plain = base_spans(text), 0, False
    for w in window_starts(text):
        while at < len(spans) and spans[at][2] <= w:
            at += 1
        last = at
        while last < len(spans) and spans[last][0] < w + WINDOW:
            last += 1
        tags = _gold(spans[at:last], w)
        if tags.any():
            yield w, tags
        elif not plain:
            plain = True
            yield w, tags


def _lowest(rows: dict[bytes, tuple[int, bytes]], n: int) -> dict[bytes, tuple[int, bytes]]:
    return dict(sorted(rows.items(), key=lambda x: (x[1], x[0]))[:n])


def _training_windows(windows: int):
    """The different windows of the lowest draws of each kind, and of those without spans (kind PLAIN), of a task's documents."""

    def run(batches):
        kept: list[dict[bytes, tuple[int, bytes]]] = [{} for _ in range(PLAIN + 1)]
        bound = [1 << 63] * (PLAIN + 1)  # draws over it are not among the lowest
        for batch in batches:
            for text, own in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist()):
                for w, tags in _marked_windows(text):
                    draw = int(mix(np.array([own + w], dtype=np.uint64))[0] >> np.uint64(1))
                    kinds = set(((tags[tags > 0] - 1) // 2).tolist()) or {PLAIN}
                    if all(draw > bound[k] for k in kinds):
                        continue
                    symbols, row = _padded(text, w).astype(np.uint8).tobytes(), (draw, tags.astype(np.uint8).tobytes())
                    for k in kinds:
                        kept[k][symbols] = min(row, kept[k].get(symbols, row))
                        if len(kept[k]) >= 2 * windows:
                            kept[k] = _lowest(kept[k], windows)
                            bound[k] = max(d for d, _ in kept[k].values())
        rows = [(k, d, symbols, tags) for k in range(PLAIN + 1) for symbols, (d, tags) in _lowest(kept[k], windows).items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["kind", "draw", "symbols", "tags"])

    return run


def training_rows(docs: DataFrame, *, text: str = "text", windows: int = WINDOWS) -> list[tuple[bytes, bytes]]:
    """(symbols, tags) of the windows to train on; no row where no document has a span."""
    draw = F.pmod(F.xxhash64(F.lit("pii"), F.col(text)), F.lit(1 << 40))
    rows = docs.where(F.col(text).rlike(_EVIDENCE.pattern)).select(F.col(text).alias("text"), draw.alias("draw"))
    found = rows.mapInArrow(_training_windows(windows), "kind int, draw long, symbols binary, tags binary")
    found = cut_lineage(found.groupBy("kind", "symbols").agg(F.min(F.struct("draw", "tags")).alias("r")).select("kind", "symbols", "r.draw", "r.tags"), "pii")
    by_kind = [[(r.draw, r.symbols, r.tags) for r in found.where(F.col("kind") == k).orderBy("draw", "symbols").limit(windows).collect()] for k in range(PLAIN + 1)]
    if not any(by_kind[:PLAIN]):
        return []
    share = windows // len(KINDS)
    order = [x for own in by_kind[:PLAIN] for x in own[:share]] + sorted(x for own in by_kind[:PLAIN] for x in own[share:])
    picked: dict[bytes, bytes] = {}
    for _, symbols, tags in order:
        if len(picked) < windows:
            picked.setdefault(bytes(symbols), bytes(tags))
    # a window that is marked in one place is not plain in another
    plain = {bytes(symbols): bytes(tags) for _, symbols, tags in by_kind[PLAIN] if bytes(symbols) not in picked}
    return [*picked.items(), *plain.items()]


def _spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the marked spans of a window."""
    out = []
    for t in np.flatnonzero(tags % 2 == 1).tolist():
        kind, e = (int(tags[t]) - 1) // 2, t + 1
        while e < len(tags) and tags[e] == 2 * kind + 2:
            e += 1
        out.append((t, kind, e))
    return out


def _respelled(symbols: np.ndarray, tags: np.ndarray, rng: np.random.Generator, change) -> tuple[np.ndarray, np.ndarray] | None:
    """The window with change(kind, body) in place of each span that lies in it whole, cut or filled with blanks to its length.

    change gives (text, whether it is still marked).  None where no span lies in the window whole.
    """
    out_s, out_t, at, changed = [], [], 0, False
    for s, kind, e in _spans_of(tags):
        if s == 0 or e == WINDOW:
            continue
        body, marked = change(kind, bytes(symbols[s:e].tolist()).decode("ascii"))
        own = encode(body)
        mark = np.zeros(len(own), dtype=np.int64)
        if marked:
            mark[:], mark[0] = 2 * kind + 2, 2 * kind + 1
        out_s += [symbols[at:s], own]
        out_t += [tags[at:s], mark]
        at, changed = e, True
    if not changed:
        return None
    fill = np.full(WINDOW, 32, dtype=np.int64)
    row = np.concatenate([*out_s, symbols[at:], fill])[:WINDOW]
    return row, np.concatenate([*out_t, tags[at:], 0 * fill])[:WINDOW]


def with_spellings(rows: list[tuple[bytes, bytes]], copies: int = COPIES, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, tags) of the rows, `copies` altered copies of each window with whole spans, and one with decoys for them."""
    rng = np.random.default_rng(seed)
    symbols, tags = ([np.frombuffer(r[c], dtype=np.uint8).astype(np.int64) for r in rows] for c in (0, 1))
    more = []
    for own, marks in zip(symbols, tags):
        if marks.any():
            more += [_respelled(own, marks, rng, lambda kind, body: (altered(kind, body, rng), True)) for _ in range(copies)]
            more.append(_respelled(own, marks, rng, lambda kind, body: (decoy(rng), False)))
    more = [m for m in more if m is not None]
    return np.stack([*symbols, *[m[0] for m in more]]), np.stack([*tags, *[m[1] for m in more]])


def fit(docs: DataFrame, *, text: str = "text", windows: int = WINDOWS) -> Tagger | None:
    """Train on the fixed patterns' spans and on other spellings of them; None where no document holds a span."""
    rows = training_rows(docs, text=text, windows=windows)
    if not rows:
        return None
    tagger = Tagger(len(KINDS))
    tagger.train(*with_spellings(rows))
    return tagger


def _tagged(tags: np.ndarray, scores: np.ndarray, trans: np.ndarray):
    """(kind, start, end, margin over 'outside') of the spans of a window."""
    out, t = [], 0
    while t < len(tags):
        if tags[t] % 2 == 1:
            kind, e = int(tags[t] - 1) // 2, t + 1
            while e < len(tags) and tags[e] == 2 * kind + 2:
                e += 1
            own = tags[t:e]
            margin = float((scores[np.arange(t, e), own] - scores[t:e, 0]).sum() + trans[own[:-1], own[1:]].sum() - trans[0, 0] * (e - t - 1))
            out.append((kind, t, e, margin))
            t = e
        else:
            t += 1
    return out


def reconcile(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the heaviest set of spans without overlap, after joining equal kinds that overlap."""
    joined: list[list] = []
    for kind, s, e, weight in sorted(found, key=lambda x: (x[0], x[1], x[2])):
        if joined and joined[-1][0] == kind and s < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], e)
            joined[-1][3] = max(joined[-1][3], weight)
        else:
            joined.append([kind, s, e, weight])
    joined = sorted((x for x in joined if x[3] > MARGIN), key=lambda x: (x[2], x[1], x[0]))
    ends = [x[2] for x in joined]
    best: list[tuple[float, int]] = [(0.0, -1)]
    for i, (_, s, _, weight) in enumerate(joined):
        with_it = best[bisect_right(ends, s, 0, i)][0] + weight
        best.append((with_it, i) if with_it > best[i][0] else (best[i][0], -1))
    out, i = [], len(joined)
    while i:
        if best[i][1] < 0:
            i -= 1
        else:
            kind, s, e, _ = joined[i - 1]
            out.append((s, kind, e))
            i = bisect_right(ends, s, 0, i - 1)
    return sorted(out)


def _overlap_test(spans: list[tuple[int, int, int]]):
    """Whether a range touches one of the spans (in order of their starts)."""
    starts, ends = [s for s, _, _ in spans], [0, *accumulate((e for _, _, e in spans), max)]
    return lambda s, e: ends[bisect_left(starts, e)] > s


def tag_texts(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """(fixed spans, added spans) of texts that have evidence."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, []) for b in base]
    where = [(d, w) for d, t in enumerate(texts) for w in window_starts(t)]
    found: list[list] = [[] for _ in texts]
    trans = tagger.p["trans"]
    for at in range(0, len(where), AT_ONCE):
        own = where[at : at + AT_ONCE]
        tags, scores = tagger.decode(np.stack([_padded(texts[d], w) for d, w in own]))
        for k in np.flatnonzero(tags.any(axis=1)).tolist():
            d, w = own[k]
            found[d] += [(kind, s + w, min(e + w, len(texts[d])), m) for kind, s, e, m in _tagged(tags[k], scores[k], trans) if s + w < len(texts[d])]
    out = []
    for d, t in enumerate(texts):
        taken, added = _overlap_test(base[d]), []
        for s, k, e in reconcile(found[d]):
            s, e = settled(k, t, s, e)
            if s < e and (not added or added[-1][2] <= s) and not taken(s, e) and sound(k, t, s, e):
                added.append((s, k, e))
        out.append((base[d], added))
    return out


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first, then the longest counts."""
    out, at = [], 0
    for s, kind, e in sorted(spans, key=lambda x: (x[0], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, tagger: Tagger | None, *, text: str = "text", keep: list[str] | None = None, mask: bool = False) -> DataFrame:
    """keep (default: all columns) with pii_base and pii_added: lists of (kind, start, end) in code points.

    With mask, the text's spans are replaced by <KIND>.  Null and empty texts have no spans and stay as they are; repeated
    rows are read each for itself; columns of docs named like the new ones are replaced; an empty table gives an empty
    result.  Without a tagger nothing is added.
    """
    new = ["pii_base", "pii_added"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    given = docs.select(*keep) if text in keep else docs.select(*keep, text)  # the text crosses once
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(c, span) for c in new]])
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def run(batches):
        for batch in small_batches(batches, text):
            column = batch.column(text)
            raw, offsets = text_bytes(column)
            seen = np.concatenate([[0], np.cumsum(_HAS_EVIDENCE[raw[offsets[0] : offsets[-1]]])])
            spelled = pc.fill_null(pc.match_substring_regex(column, _SPELLED), False).to_numpy(zero_copy_only=False)
            likely = np.flatnonzero((seen[offsets[1:] - offsets[0]] > seen[offsets[:-1] - offsets[0]]) | spelled).tolist()
            base: list[list] = [[] for _ in range(batch.num_rows)]
            added: list[list] = [[] for _ in range(batch.num_rows)]
            changed: dict[int, str] = {}
            for at in range(0, len(likely), 256):
                rows = likely[at : at + 256]
                texts = [column[r].as_py() for r in rows]
                for r, t, (b, a) in zip(rows, texts, tag_texts(texts, shared.value)):
                    base[r], added[r] = listed(b), listed(a)
                    if mask and (a or b):
                        changed[r] = masked(t, a + b)
            columns = {c: batch.column(c) for c in keep}
            if changed:
                columns[text] = replaced(column, changed)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(base, span_type), pa.array(added, span_type)], names=[*keep, *new])

    return given.mapInArrow(run, schema)
