"""Personal data by candidate gradient boosting (operator 2).

High-recall generators propose overlapping spans of a kind (email, ip, card,
phone): the base patterns and looser forms of them. Base matches are final.
The other proposals get format and context features; boosted trees score them
and a threshold per kind, calibrated for precision on rows the trees have not
seen, selects further spans. They overlap no other span, but one may contain
base spans whole (the base pattern then found only a part of the value).

There is no table of marked personal data, so the trees learn from a training
set made by rule: values of each kind in many written forms, and look-alikes
(dates, versions, amounts, order numbers, numbers that fail their check),
set into contexts cut from a bounded sample of the documents.

Defined results: a null or empty text has no spans; a null id stays null;
repeated rows are treated alike; an empty table gives an empty result and a
model with empty contexts; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmart.llm.boosting import Boosted, fit_boosted
from quillmart.llm.common import map_batches, ship, smallest_hashes, text_rows

KINDS = ("email", "ip", "card", "phone")
_ORDER = {k: i for i, k in enumerate(KINDS)}
Span = tuple[str, int, int]

# The base patterns. Look-behinds and possessive runs only spare
# starts inside a run of digits, which match nothing that its first digit doesn't.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# The looser proposals.
_ANY_AT = re.compile(r"(?<![^\s@])[^\s@]++@[^\s@]+")
_WORDED_AT = re.compile(r"(?<!\S)[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+"
                        r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+", re.I)
_LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?: ?(?:\[\.\]|[.,-]) ?[0-9]{1,3}){3}(?![\w])")
_LOOSE_DIGITS = re.compile(r"(?<!\w)[(]?[0-9][0-9 ().\-/_]{5,}[0-9]")
_GROUP = re.compile(r"[(]?[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield "email", start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; failing ones are dropped."""
    out = list(_emails(text))
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            d = _only_digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m.group())) <= 15]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _stretches(text: str, a: int, b: int) -> Iterator[Span]:
    """Every stretch of neighbouring digit groups in a digit run that has the
    digits of a card or phone number; at most 19 from each group on."""
    groups = [(m.start(), m.end(), m.end() - m.start() - (text[m.start()] == "(")) for m in _GROUP.finditer(text, a, b)]
    for i, (start, _, _) in enumerate(groups):
        n = 0
        for k in range(i, len(groups)):
            n += groups[k][2]
            if n > 19:
                break
            if n >= 13:
                yield "card", start, groups[k][1]
            if 7 <= n <= 15:
                yield "phone", start, groups[k][1]


def proposals(text: str) -> Iterator[Span]:
    """Overlapping spans beyond the base patterns, of every kind they could be."""
    if "@" in text:
        yield from (("email", *m.span()) for m in _ANY_AT.finditer(text))
    lower = text.lower()
    if "(dot)" in lower or "[dot]" in lower or " dot " in lower:
        yield from (("email", *m.span()) for m in _WORDED_AT.finditer(text))
    if _DIGIT.search(text):
        yield from (("ip", *m.span()) for m in _LOOSE_IP.finditer(text))
        for m in _LOOSE_DIGITS.finditer(text):
            yield from _stretches(text, *m.span())


# Words that speak for a kind, or against any.
_HINTS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
          "card": ("card", "visa", "master", "credit", "pay"), "phone": ("tel", "phone", "call", "fax", "mobile", "whatsapp")}
_AGAINST = ("order", "invoice", "version", "isbn", "page", "date", "no.", "nr", "item", "token", "ref", "build")
_DATE = re.compile(r"(?:19|20)\d\d[-/.](?:0?\d|1[0-2])[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.](?:19|20)\d\d")


_BEFORE = re.compile(r"([0-9]+)([ ().\-/_]{1,3})\Z")
_AFTER = re.compile(r"([ ().\-/_]{1,3})([0-9]+)")


def _beside(text: str, a: int, b: int) -> tuple[int, ...]:
    """The digit groups that stand next to a span (up to 24 characters): their
    lengths and those of the separators, 0 for none, and whether these are a
    single mark that a number is written with."""
    left, right = _BEFORE.search(text[max(0, a - 24):a]), _AFTER.match(text, b, min(len(text), b + 24))
    return (len(left[1]) if left else 0, len(left[2]) if left else 0, bool(left) and left[2] in "-./",
            len(right[2]) if right else 0, len(right[1]) if right else 0, bool(right) and right[1] in "-./")


def features(text: str, span: Span) -> list[float]:
    """Format features of the span and context features of 24 characters
    before and 8 after it."""
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - 24):a].lower(), text[b:b + 8]
    digits, groups = _only_digits(s), re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    name, _, domain = s.partition("@")
    labels = domain.rstrip(".,;:!?)\"'").split(".")
    spoken = bool(_WORDED_AT.fullmatch(s))
    return [
        *(kind == k for k in KINDS), len(s), len(digits), sum(map(str.isalpha, s)), len(groups), max(sizes), min(sizes),
        s.count(" "), s.count("."), s.count("-"), s.count("/"), s.count("(") + s.count(")"), s[:1] == "+", a > 0 and text[a - 1] == "+",
        luhn(digits) if digits else 0, all(int(g[:4]) <= 255 for g in groups) and len(groups) == 4,
        bool(domain), len(labels), len(labels[-1]) if domain and labels[-1].isalpha() else 0, len(name) if domain else 0, spoken,
        bool(_DATE.search(s)), before[-1:].isalnum(), after[:1].isalnum(),
        any(h in before for h in _HINTS[kind]), any(h in before for h in _AGAINST), sizes[0] >= 3 and sizes[-1] == 4,
        *_beside(text, a, b), len({c for c in s if not c.isalnum()}), sizes[0], sizes[-1],
    ]


@dataclass
class PiiModel:
    trees: Boosted
    thresholds: dict[str, float]

    def spans(self, text: str, base: list[Span] | None = None) -> list[Span]:
        """Base spans and the proposals selected beside them. A proposal may
        contain base spans whole; one that cuts a base span, or lies in one,
        is left out. Proposals are scored in blocks, and only those that reach
        their threshold are held."""
        base = base_spans(text) if base is None else base
        taken, edge = bytearray(len(text)), bytearray(len(text) + 1)
        for _, a, b in base:
            taken[a:b] = b"\1" * (b - a)
        for _, a, b in base:
            edge[a + 1:b] = b"\1" * (b - a - 1)  # places inside a base span
        stands = lambda a, b: taken.find(1, a, b) < 0 or not (edge[a] or edge[b])
        own = {(a, b) for _, a, b in base}
        open_ = (p for p in proposals(text) if p[1:] not in own and stands(p[1], p[2]))
        good: set[tuple[float, Span]] = set()
        while block := list(islice(open_, 4096)):
            scores = self.trees.probability(np.array([features(text, p) for p in block], float))
            good.update((float(x), p) for x, p in zip(scores, block) if x >= self.thresholds[p[0]])
        chosen: list[Span] = []
        used = bytearray(len(text))
        for _, p in sorted(good, key=lambda x: (-x[0], x[1][1], _ORDER[x[1][0]], -x[1][2])):
            if used.find(1, p[1], p[2]) < 0:
                used[p[1]:p[2]] = b"\1" * (p[2] - p[1])
                chosen.append(p)
        return ordered(base + chosen)


def _luhn_number(rng: random.Random, n: int, valid: bool = True) -> str:
    body = "4" + "".join(rng.choices("0123456789", k=n - 2))
    good = next(d for d in "0123456789" if luhn(body + d))
    return body + (good if valid else str((int(good) + rng.randint(1, 9)) % 10))


def _example(rng: random.Random) -> tuple[str | None, str]:
    """A value and its kind, or a look-alike and none."""
    num = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda: "".join(rng.choices("abcdefghiklmnoprstuv", k=rng.randint(3, 8)))
    pick = lambda *x: rng.choice(x)
    user, host, top = pick(word(), f"{word()}.{num(2)}"), pick(word(), f"mail.{word()}"), pick("com", "org", "net", "de", "example")
    area, line = f"{rng.randint(2, 9)}{num(2)}", f"{rng.randint(2, 9)}{num(2)}"
    octets = [str(rng.randint(1, 255)) for _ in range(4)]
    card = _luhn_number(rng, rng.randint(14, 19))
    quads = " ".join(re.findall(".{1,4}", card))
    return pick(
        ("email", f"{user}@{host}.{top}"), ("email", f"{user} at {host} dot {top}"), ("email", f"{user}(at){host}(dot){top}"),
        ("email", f"{user} [at] {host} [dot] {top}"), ("email", f"<{user}@{host}.{top}>"),
        ("ip", ".".join(octets)), ("ip", "[.]".join(octets)), ("ip", " . ".join(octets)),
        ("card", card), ("card", quads), ("card", quads.replace(" ", "-")), ("card", quads.replace(" ", ".")), ("card", quads.replace(" ", " - ")),
        ("phone", f"+{rng.randint(1, 98)} ({area}) {line}-{num(4)}"), ("phone", f"({area}) {line}-{num(4)}"),
        ("phone", f"{area}-{line}-{num(4)}"), ("phone", f"{area}.{line}.{num(4)}"), ("phone", f"0{num(3)}/{num(7)}"),
        (None, f"{pick(19, 20)}{num(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}"), (None, f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/20{num(2)}"),
        (None, f"{rng.randint(1, 8)}.{rng.randint(0, 19)}.{rng.randint(0, 39)}.{rng.randint(256, 9998)}"), (None, f"{num(2)}, {num(2)}, {num(2)}, {num(3)}"),
        (None, num(rng.randint(7, 12))), (None, f"{num(4)} {num(4)}"), (None, f"20{num(2)} 20{num(2)} 20{num(2)}"),
        (None, _luhn_number(rng, rng.randint(13, 19), valid=False)), (None, f"{num(3)}-{num(1)}-{num(2)}-{num(6)}-{num(1)}"),
        (None, f"{num(1)} {num(2)} {num(1)} {num(3)} {num(2)}"), (None, f"{num(2)} - {num(3)} / {num(2)}"), (None, f"{num(5)}.{num(8)}"),
        (None, f"{word()}@{word()}"), (None, f"@{word()}"), (None, f"{word()}@{num(2)}"), (None, f"{num(20)}{num(rng.randint(1, 19))}"),
    )


def training_rows(contexts: list[str], n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of the proposals found in made examples. A
    proposal is right if it covers the value's own span, give or take two
    characters, under its kind."""
    rng = random.Random(seed)
    x, y, kinds = [], [], []
    pools = sorted(set(contexts)) or [""]
    for _ in range(n):
        kind, value = _example(rng)
        around = rng.choice(pools)
        at = rng.randint(0, len(around))
        at = around.find(" ", at) + 1 or len(around)
        cue = ""
        if rng.random() < 0.3:
            cue = rng.choice(_HINTS[kind] if kind else _AGAINST) + rng.choice((" ", ": "))
        left, right = around[max(0, at - 60):at] + cue, " " + around[at:at + 40]
        values = [(kind, value)]
        if kind in ("card", "phone") and rng.random() < 0.4:  # another of its kind beside it
            other, again = _example(rng)
            while other != kind:
                other, again = _example(rng)
            values.append((kind, again))
            between = rng.choice((" ", ", ", " / ", " - ", ". "))
        elif rng.random() < 0.15:  # a number that a digit run takes in
            right = rng.choice((". ", " ", " - ", ".  ")) + str(rng.randint(1, 99)) + right
        text, true = left, []
        for at, (k, v) in enumerate(values):
            text += between if at else ""
            true.append((k, len(text), len(text) + len(v)))
            text += v
        a, b = true[0][1], true[-1][2]
        text += right
        for p in sorted({*proposals(text), *base_spans(text)}):
            if p[1] < b and a < p[2]:
                x.append(features(text, p))
                y.append(any(p[0] == k and abs(p[1] - f) <= 2 and abs(p[2] - t) <= 2 for k, f, t in true))
                kinds.append(p[0])
    return np.array(x, float).reshape(len(y), -1), np.array(y, int), np.array(kinds)


def fit(docs: DataFrame, contexts: int = 400, examples: int = 8000, precision: float = 0.99,
        id_col: str = "doc_id", text_col: str = "text") -> PiiModel:
    """Learn from ``examples`` made examples in at most ``contexts`` stretches
    of 400 characters cut from documents (those with the smallest hashes of
    their ids). Three quarters grow the trees; on the rest each kind's
    threshold is the lowest at which the selected share of right spans reaches
    ``precision`` (none: no spans of that kind are added)."""
    cut = F.substring("text", 200, 400)
    rows = text_rows(docs, id_col, text_col).where("length(text) > 100").select("doc_id", cut.alias("cut"))
    rows = smallest_hashes(rows, contexts, "doc_id", "cut").collect()
    x, y, kinds = training_rows([r["cut"] for r in rows], examples)
    grow = np.arange(len(y)) % 4 != 3
    trees = fit_boosted(x[grow], y[grow], rounds=60)
    thresholds = {}
    p, right = trees.probability(x[~grow]), y[~grow]
    for k in KINDS:
        of = kinds[~grow] == k
        order = np.argsort(-p[of], kind="stable")
        share = np.cumsum(right[of][order]) / np.arange(1, of.sum() + 1)
        enough = np.flatnonzero(share >= precision)
        thresholds[k] = float(max(p[of][order][enough[-1]], 0.5)) if len(enough) else 2.0
    return PiiModel(trees, thresholds)


def find(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base spans and all spans, as arrays of
    (kind, start, end) in code points, end exclusive."""

    def make():
        def run(c: dict) -> dict:
            base = [base_spans(t) for t in c["text"]]
            every = [model.spans(t, b) for t, b in zip(c["text"], base)]
            as_rows = lambda spans: [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            return {"doc_id": c["doc_id"], "base": as_rows(base), "spans": as_rows(every)}

        return run

    kind = "array<struct<kind: string, start: long, `end`: long>>"
    return map_batches(text_rows(docs, id_col, text_col), make, f"doc_id long, base {kind}, spans {kind}")


def digest(text: str, model: PiiModel) -> tuple:
    """n_email, n_ip, n_card, n_phone (base spans), the digest of the base
    spans, and all spans joined."""
    base = base_spans(text)
    count = [sum(s[0] == k for s in base) for k in KINDS]
    return (*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(model.spans(text, base)))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or stretch of overlapping ones, replaced by
    the kind of its first."""
    out, done = [], 0
    for k, a, b in ordered(spans):
        if a >= done:
            out += [text[done:a], f"[{k.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: PiiModel, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with the spans replaced in the text (null stays
    null) and its length corrected where there is such a column."""
    ship(docs.sparkSession)
    names, kinds = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                new = [None if t is None else redacted(t, model.spans(t)) for t in part.column(at).to_pylist()]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.schema.field(at).type)
                if chars_col in names:
                    i = names.index(chars_col)
                    old = cols[i].to_pylist()
                    cols[i] = pa.array([o if t is None else len(t) for o, t in zip(old, new)], part.schema.field(i).type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(run, kinds)
