"""Personal data: fixed patterns plus candidate spans judged by boosted trees."""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting
from tidemark.llm.common import smallest_hashes
from tidemark.llm.quality_zip import calibrate

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its first digit only: later ones can't match where that fails
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches end to end from each @: the local part reaches back to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        else:
            # a later match may not reach over this @ anyway
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by kind and then by place."""
    out = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_AT = re.compile(r" ?@ ?| ?\(at\) ?| ?\[at\] ?| at ")
_BEFORE_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\Z")
_AFTER_AT = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]{1,63}){1,8}")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])")
_QUADS = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,3}(?: ?(?:\.| dot |\[\.\]|\(dot\)|\[dot\]) ?[0-9]{1,3}){3}(?![0-9A-Za-z])")


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Possible spans in the gaps between those taken; they may overlap one another."""
    out: list[Span] = []
    digits = _DIGIT.search(text)
    edge = 0
    for _, start, end in [*sorted(taken, key=lambda s: s[1]), ("", len(text), len(text))]:
        if start > edge:
            for m in _AT.finditer(text, edge, start):
                left = _BEFORE_AT.search(text, max(edge, m.start() - 65), m.start())
                right = _AFTER_AT.match(text, m.end(), start) if left else None
                if right:
                    out.append(("email", left.start(), right.end()))
            if digits:
                out += [("ip", m.start(), m.end()) for m in _QUADS.finditer(text, edge, start)]
                for m in _NUMBER.finditer(text, edge, start):
                    n = len(_DIGIT.findall(m.group()))
                    out += [(kind, m.start(), m.end()) for kind, least, most in (("phone", 7, 15), ("card", 12, 19)) if least <= n <= most]
        edge = max(edge, end)
    return out


_CUES = (
    re.compile(r"phone|tel\b|tel\.|call|fax|mobile|cell|whatsapp|sms", re.I),
    re.compile(r"mail|contact|write|reach|reply", re.I),
    re.compile(r"card|visa|master|amex|credit|debit|paid|payment", re.I),
    re.compile(r"\bip\b|host|server|address|ping|login|client", re.I),
    re.compile(r"order|invoice|ref|isbn|version|id\b|no\.|#|total|date", re.I),
)
_DATE = re.compile(r"(?:19|20)[0-9]{2}[-/. ][0-9]{1,2}[-/. ][0-9]{1,2}|[0-9]{1,2}[-/. ][0-9]{1,2}[-/. ](?:19|20)?[0-9]{2}")


def _side(c: str) -> int:
    if not c or c.isspace():
        return 0
    if c.isalpha():
        return 1
    if c.isdigit():
        return 2
    return 4 if c in "=:\"'#$" else 3


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, start, end = span
    s = text[start:end]
    groups = re.findall(r"[0-9]+", s)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    last = re.split(r"[^A-Za-z0-9]+", s)[-1]
    before = text[max(0, start - 30) : start]
    return [
        KINDS.index(kind), len(s), len(digits), sum(c.isalpha() for c in s), s.count("."), s.count("-"), s.count(" "),
        s.count("("), s.count("/"), float(s[0] == "+"), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        float(len(digits) > 1 and luhn(digits)), float(digits[:1] in tuple("3456")), max((min(int(g[:6]), 999_999) for g in groups), default=0),
        float("@" in s), float(" at " in s), float("(at)" in s or "[at]" in s), len(last), float(last.isalpha()),
        float("dot" in s), float(bool(_DATE.search(s))), float(len(set(sizes)) == 1),
        _side(text[start - 1 : start]), _side(text[end : end + 1]), *(float(bool(c.search(before))) for c in _CUES),
    ]


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(n))


def _card(draw: random.Random, valid: bool) -> str:
    body = draw.choice("3456") + _digits(draw, draw.choice((14, 14, 14, 15, 17)))
    check = next(c for c in "0123456789" if luhn(body + c))
    return body + (check if valid else draw.choice([c for c in "0123456789" if not luhn(body + c)]))


def _name(draw: random.Random, least: int, most: int) -> str:
    return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(least, most)))


def specimens(draw: random.Random) -> list[tuple[str, str, int]]:
    """Made-up values as (kind, text, 1 if personal): usual, written-out and unusual forms, and
    decoys. The usual forms matter where a neighbour keeps a fixed pattern from matching."""
    d = lambda n: _digits(draw, n)
    name, host, top = _name(draw, 3, 9), _name(draw, 3, 9), draw.choice(("com", "org", "net", "de", "fr", "es", "example.com"))
    at = draw.choice((" at ", "(at)", " (at) ", "[at]", " [at] ", " @ "))
    dot = draw.choice((" dot ", "(dot)", "[dot]", " [dot] "))
    area, middle, line = draw.choice("23456789") + d(2), draw.choice("23456789") + d(2), d(4)
    quads = [str(draw.randint(1, 255)) for _ in range(4)]
    card, broken = _card(draw, True), _card(draw, False)
    spaced = lambda x, sep: sep.join(x[i : i + 4] for i in range(0, len(x), 4))
    sep = draw.choice(("-", " ", ".", "/"))
    year, month, day = str(draw.randint(1990, 2029)), f"{draw.randint(1, 12):02d}", f"{draw.randint(1, 28):02d}"
    return [
        ("email", f"{name}.{d(2)}@{host}.{top}", 1),
        ("phone", f"+{draw.choice(('1', '33', '44', '49'))} ({area}) {middle}-{line}", 1),
        ("ip", ".".join(quads), 1),
        ("card", draw.choice((card, spaced(card, " "), spaced(card, "-"))), 1),
        ("email", f"{name}{draw.choice(('', '.' + _name(draw, 3, 6), d(2)))}{at}{host}{draw.choice((dot, '.'))}{top}", 1),
        ("email", f"{name}{' at '}{host}.{_name(draw, 4, 9).capitalize()}", 0),
        ("email", f"{name} at {d(draw.choice((1, 2)))}.{d(draw.choice((1, 2)))}", 0),
        ("phone", draw.choice((f"({area}) {middle}-{line}", f"{area}-{middle}-{line}", f"{area}.{middle}.{line}", f"1-{area}-{middle}-{line}", f"00{draw.choice(('33', '49', '34', '44'))} {d(2)} {d(4)} {d(4)}")), 1),
        ("phone", draw.choice((f"{year}-{month}-{day}", f"{day}/{month}/{year}", f"{year}-{month}-{day} {d(2)}", d(draw.choice((7, 8, 9, 10, 11, 12))), f"{d(1)}.{d(6)}", f"{d(3)} {d(3)} {d(3)}", f"{d(5)}-{d(4)}", f"{d(3)}-{d(10)}", f"{d(1)}-{d(4)}-{d(4)}-{d(1)}")), 0),
        ("ip", draw.choice((dot, "[.]")).join(quads), 1),
        ("ip", sep.join([str(draw.randint(256, 999)), *quads[1:]]).replace("/", ".").replace("-", ".").replace(" ", "."), 0),
        ("ip", f"{draw.randint(300, 999)}.{quads[1]}.{quads[2]}.{draw.randint(256, 999)}", 0),
        ("card", spaced(card, draw.choice((".", "/", "  ", " - "))[:2]), 1),
        ("card", broken, 0),
        ("card", broken if draw.random() < 0.5 else spaced(broken, sep), 0),
        ("card", d(draw.choice((12, 13, 14))), 0),
    ]


@dataclass
class Model:
    """Trees, calibration and the chance from which a candidate of a kind is taken."""

    trees: boosting.Trees | None = None
    slope: float = 1.0
    shift: float = 0.0
    least: dict[str, float] = field(default_factory=dict)

    def chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.shift, -40, 40)))

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Candidates taken per text, best first where they overlap."""
        found = [candidates(t, b) for t, b in zip(texts, base)]
        places = [(i, c) for i, cs in enumerate(found) for c in cs]
        out: list[list[Span]] = [[] for _ in texts]
        if not places or self.trees is None:
            return out
        chances = self.chances(np.array([describe(texts[i], c) for i, c in places], dtype=float))
        likely = [k for k in range(len(places)) if chances[k] >= self.least[places[k][1][0]]]
        taken: list[list[Span]] = [[] for _ in texts]
        for k in sorted(likely, key=lambda k: (places[k][0], -chances[k], places[k][1][1], places[k][1])):
            i, c = places[k]
            if _insert(taken[i], c):
                out[i].append(c)
        return out


def _insert(spans: list[Span], c: Span) -> bool:
    """Put a span among others sorted by place, unless it overlaps one of them."""
    at = bisect_left(spans, c[1], key=lambda s: s[1])
    if at and spans[at - 1][2] > c[1] or at < len(spans) and spans[at][1] < c[2]:
        return False
    spans.insert(at, c)
    return True


def train(docs: DataFrame, sample: int = 600, rounds: int = 4, precision: float = 0.98) -> Model:
    """Fit on made-up values and decoys set into whole texts of the corpus.

    At most ``sample`` texts, those of the smallest hashes, come to the driver and lend contexts:
    a value is put between two of their words. A row that repeats counts once. Candidates that the texts hold already and the fixed patterns
    refuse count as decoys. A third of the texts sets the calibration and, for each kind, the
    lowest chance at which at least ``precision`` of the candidates are personal.
    """
    total = docs.count()
    if not total:
        return Model()
    drawn = smallest_hashes(docs.where("text is not null").select("doc_id", "text"), sample, F.lit(sample / total), "personal")
    texts = sorted(r.text for r in drawn.collect())
    rng = random.Random(17)
    rows: list[tuple[list[float], int, int, str]] = []
    for i, text in enumerate(texts or [""]):
        taken = base_spans(text)
        rows += [(describe(text, c), 0, i % 3, c[0]) for c in candidates(text, taken)]
        for _ in range(rounds):
            for kind, value, personal in specimens(rng):
                cut = text.find(" ", rng.randrange(len(text) + 1)) if text else -1
                left, right = (text[max(0, cut - 60) : cut + 1], text[cut : cut + 60]) if cut >= 0 else ("", "")
                part = f"{left}{value}{right}"
                for c in candidates(part, []):
                    if c[1] < len(left) + len(value) and len(left) < c[2]:
                        exact = (c[1], c[2]) == (len(left), len(left) + len(value))
                        rows.append((describe(part, c), int(personal and exact and c[0] == kind), i % 3, c[0]))
    x, y = np.array([r[0] for r in rows], dtype=float), np.array([r[1] for r in rows])
    part, kinds = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    fitted = part > 0 if len(set(part)) > 1 else np.ones(len(rows), bool)
    check = ~fitted if (~fitted).any() and len(set(y[~fitted])) == 2 else np.ones(len(rows), bool)
    model = Model(boosting.fit(x[fitted], y[fitted]))
    model.slope, model.shift = calibrate(model.trees.margin(x[check]), y[check])
    chances = model.chances(x[check])
    for kind in KINDS:
        p, hit = chances[kinds[check] == kind], y[check][kinds[check] == kind]
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(hit[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(right >= precision)
        model.least[kind] = max(0.5, float(p[order][enough[-1]])) if len(enough) else 2.0
    return model


def find(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with ``base_spans`` and ``spans``, arrays of (kind, first, end).

    Places are code points, ends exclusive. ``spans`` holds the base spans and what the model
    adds, by kind and place. A null text has none. Spans of one kind do not overlap; base spans of
    different kinds may. Columns of these two names are replaced. The model is broadcast: its size
    is fixed by its trees.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(c for c in docs.columns if c not in ("base_spans", "spans")))
    span = "array<struct<kind: string, first: int, end: int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("end", pa.int32())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", base_spans {span}, spans {span}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = shared.value.added(texts, base)
            whole = [sorted(b + a, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) for b, a in zip(base, added)]
            arrays = [pa.array([[dict(zip(("kind", "first", "end"), s)) for s in spans] for spans in x], kind) for x in (base, whole)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "base_spans", "spans"])

    return rows.mapInArrow(run, schema)


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with every span of ``text`` replaced by its kind in brackets; of
    overlapping spans the one that begins first, then the longer, names the replacement, which
    covers them all. A null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = [b + a for b, a in zip(base, shared.value.added(texts, base))]
            new = [None if not ok else redact(t, s) for ok, t, s in zip(batch.column("text").is_valid().to_pylist(), texts, spans)]
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names
            )

    return docs.mapInArrow(run, docs.schema)


def redact(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= done:
            parts += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
