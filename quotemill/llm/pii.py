"""Personal data: proposed spans, judged by boosted trees, beside spans that four fixed patterns give.

The fixed patterns find written-out addresses and numbers and always stay. They miss what stands in
the way of a pattern: a phone number with another number after it, a card number inside a longer
chain of digits, an address with its signs spelled out. Generators of high recall propose such spans,
overlapping each other as they like; gradient-boosted trees judge each by its format and by what stands
around it. A proposal is taken if its calibrated score reaches its kind's threshold, the least one that
kept PRECISION on findings the trees were not trained on, and if it overlaps no fixed span; of
overlapping ones the best stays.

The trees are Spark's own GBTClassifier, trained from labelled findings: at most some thousand
short texts with the spans in them, made by rule for want of a table of real ones. They are small and go
to every task, so that texts are read once and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.toxicity import fit_curve

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
TREES, DEPTH, STEP, SEED = 24, 4, 0.3, 5
#: Labelled texts made by rule of each sort, and the share of proposals that a threshold must get right.
PER_SORT, PRECISION = 60, 0.98
#: Characters before and after a span that count as its surroundings.
AROUND = 48

Span = tuple[int, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can't begin inside a run of digits
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of what the fixed patterns find: each kind's matches from left to right; those that fail their test are dropped."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:  # by the sign, so that long runs without one are read once
        if m := _DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                out.append((EMAIL, start, end))
        at = text.find("@", at + 1)
    out += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for part in m[0].split("."))]
    out += [(CARD, m.start(), m.end()) for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(PHONE, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out


#: Each generator proposes spans of one kind; lookaheads let spans overlap. Lengths are bounded, as the written forms of such data are.
_AT_SIGN = re.compile(r"@|[\[({<]\s?at\s?[\])}>]| at ", re.I)
_SPELLED = re.compile(r" {0,2}[A-Za-z0-9-]{1,63}(?: {0,2}(?:\.|[\[({<] ?dot ?[\])}>]| dot ) {0,2}[A-Za-z0-9-]{1,63}){1,8}", re.I)
_GENERATORS = (
    (IP, re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")),
    (IP, re.compile(r"(?<![0-9A-Za-z])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)| dot )[0-9]{1,3}){3}(?![0-9])")),
    (IP, re.compile(r"(?<![0-9])(?=([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))")),
    (CARD, re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")),
    (CARD, re.compile(r"(?<![0-9])(?=([0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){3}(?:[ ._/-]{1,2}[0-9]{1,3})?)(?![0-9]))")),
    (CARD, re.compile(r"(?<![0-9])(?=([0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){3})(?![0-9]))")),
    (CARD, re.compile(r"(?<![0-9])(?=([0-9]{4}[ ._/-]{1,2}[0-9]{6}[ ._/-]{1,2}[0-9]{4,5})(?![0-9]))")),
    (PHONE, re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])")),
    (PHONE, re.compile(r"(?<![0-9A-Za-z+])\([0-9]{2,5}\)[ -]?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9])")),
)
#: A phone number from its sign on is proposed with every number of groups.
_AFTER_PLUS = re.compile(r"\+[0-9]{1,4}")
_GROUP = re.compile(r"[ .-]{0,2}\(?[0-9]{1,5}\)?(?![0-9])")


def proposals(text: str) -> list[Span]:
    """(kind, start, end) of all that the generators propose, each once."""
    found = set()
    for m in _AT_SIGN.finditer(text):
        if domain := _SPELLED.match(text, m.end()):
            stop = m.start()
            while stop > 0 and m.start() - stop < 2 and text[stop - 1] == " ":
                stop -= 1
            start = stop
            while start > 0 and stop - start < 64 and text[start - 1] in _LOCAL:
                start -= 1
            if start < stop:
                found.add((EMAIL, start, domain.end()))
    if re.search("[0-9]", text):
        for kind, pattern in _GENERATORS:
            if kind == IP and pattern is _GENERATORS[0][1] and "::" not in text and text.count(":") < 2:
                continue
            found.update((kind, *(m.span(1) if pattern.groups else m.span())) for m in pattern.finditer(text))
        for m in _AFTER_PLUS.finditer(text):
            end, digits = m.end(), len(m[0]) - 1
            while digits < 16 and (g := _GROUP.match(text, end)):
                end, digits = g.end(), digits + len(digits_of(g[0]))
                if 7 <= digits <= 15:
                    found.add((PHONE, m.start(), end))
    return sorted(found)


#: Fixed lists: words that announce a kind, words that announce other numbers, and endings of host names.
ANNOUNCE = (
    r"mail|contact|write|reach|schreib|kontakt|écri|correo|adresse",
    r"\bip\b|host|server|address|ping|login from|gateway|client",
    r"card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    r"phone|tel|call|mobile|cell|fax|whatsapp|anruf|rufnummer|appel|llam",
)
OTHER_NUMBERS = r"order|invoice|isbn|issn|version|release|date|page|serial|sku|article|ticket|case no|build|rechnung|bestell|commande|pedido|population|total|price|ratio|score|mac|time"
ENDINGS = "com|org|net|edu|gov|info|biz|io|de|fr|es|it|nl|uk|eu|us|ch|at|example|test|co|local"
_ANNOUNCE, _OTHER = [re.compile(x, re.I) for x in ANNOUNCE], re.compile(OTHER_NUMBERS, re.I)
_ENDING, _DATE = re.compile(rf"\b(?:{ENDINGS})$", re.I), re.compile(r"(?:19|20)[0-9]{2}[-./][01]?[0-9][-./][0-3]?[0-9]|[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)?[0-9]{2}(?![0-9])")

FEATURES = (
    "kind", "length", "digits", "groups", "first_group", "last_group", "least_group", "most_group", "luhn", "plus", "brackets", "spaces", "dots", "dashes", "colons", "letters", "zero_first", "issuer", "bytes", "different",
    "date", "ending", "labels", "spelled_at", "spelled_dot", "local_length", "local_marked", "spaced_dot", "letter_before", "letter_after", "digits_before", "digits_after", "announced", "announced_near", "other_numbers", "groups_of_four",
)


def features(text: str, span: Span) -> list[float]:
    """In the order of FEATURES."""
    kind, start, end = span
    value, left, right = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    groups = re.findall("[0-9]+", value)
    digits, sizes = "".join(groups), [len(g) for g in groups] or [0]
    sign = _AT_SIGN.search(value)
    local = value[: sign.start()].strip() if kind == EMAIL and sign else ""
    near = left[-16:]
    return [float(x) for x in (
        kind, len(value), len(digits), len(groups), sizes[0], sizes[-1], min(sizes), max(sizes),
        13 <= len(digits) <= 19 and luhn(digits), value.startswith("+"), bool(re.search(r"[(\[{<]", value)), value.count(" "), value.count("."), value.count("-"), value.count(":"), sum(c.isalpha() for c in value),
        digits[:1] == "0", bool(re.match("4|5[1-5]|2[2-7]|3[47]|6[05]", digits)), len(groups) == 4 and all(int(g) <= 255 for g in groups if len(g) <= 4) and max(sizes) <= 3, len(set(digits)),
        bool(_DATE.search(value)), bool(_ENDING.search(value)), len(re.findall(r"\.|\bdot\b", value[sign.end() :] if sign else "", re.I)), bool(sign) and sign[0] != "@", bool(re.search(r"\bdot\b", value, re.I)), len(local), bool(re.search("[0-9._+-]", local)), ". " in value or " ." in value,
        left[-1:].isalnum(), right[:1].isalnum(), bool(re.search(r"[0-9][ .,/:-]?$", left)), bool(re.match(r"[ .,/:-]?[0-9]", right)),
        bool(_ANNOUNCE[kind].search(left)), bool(_ANNOUNCE[kind].search(near)), bool(_OTHER.search(near)), len(groups) >= 4 and sizes[:4] == [4, 4, 4, 4],
    )]


def labelled_findings(per_sort: int = PER_SORT, seed: int = SEED) -> list[tuple[str, list[Span]]]:
    """(text, spans in it): texts made by rule, the same every time; a sort has one form of personal data, or one of what only looks like it."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choices("0123456789", k=k))
    octet = lambda: str(r.randrange(1, 256))
    name = lambda: r.choice(("anna", "j.smith", "maria_k", "info", "li.wei", "sales", "o.brien", "k27", "peter", "noreply", "thinly.63", "eau.42"))
    host = lambda: r.choice(("example", "mail7.example", "acme", "uni-ulm", "post", "firma", "web-shop", "lists.python"))
    end = lambda: r.choice(("com", "org", "net", "de", "fr", "es", "co", "edu"))
    ip = lambda: ".".join(octet() for _ in range(4))
    words = lambda k: " ".join("".join(r.choices(("er", "in", "the", "and", "ou", "la", "de", "ung", "ción", "ei", "th", "re", "sch", "on", "at", "que", "é"), k=r.randrange(1, 4))) for _ in range(k))

    def card(prefix: str = "", size: int = 16) -> str:
        body = (prefix or r.choice(("4", "51", "55", "37", "6011", "35")))
        body += n(size - 1 - len(body))
        return next(body + d for d in "0123456789" if luhn(body + d))

    def wrong_card() -> str:
        c = card()
        return c[:-1] + str((int(c[-1]) + r.randrange(1, 10)) % 10)

    fours = lambda c, sep: sep.join(c[k : k + 4] for k in range(0, len(c), 4))
    us = lambda: f"({n(3)}) {n(3)}-{n(4)}"
    hexes = lambda k: "".join(r.choices("0123456789abcdef", k=k))
    sep = lambda: r.choice((" ", "-", ".", "_", "/", "  "))
    after_number = lambda: r.choice((ip(), n(4), n(16), n(2), us(), f"+1 {us()}", "+49 " + n(3) + " " + n(7), f"{n(2)}.{n(2)}.2024"))
    announce = (("mail", "contact:", "write to", "e-mail"), ("ip", "host", "server", "address:"), ("card", "visa", "pay with", "credit card"), ("phone", "tel.", "call", "mobile:", "fax"))
    prose = ("", "", "", "")
    other = ("order", "invoice", "isbn", "version", "date", "page", "serial", "build", "total")
    both = lambda kind: (*announce[kind], *prose)
    sorts = (  # kind of the span (None: there is none), words before it, the span, what follows it
        (PHONE, both(PHONE), lambda: f"+1 {us()}", lambda: " " + after_number()),
        (PHONE, both(PHONE), lambda: f"+{r.choice(('1', '44', '49', '33', '351'))} {n(2)} {n(4)} {n(4)}", lambda: " " + after_number()),
        (PHONE, both(PHONE), lambda: f"+{r.choice(('1', '44', '49', '33', '351'))}-{n(3)}-{n(3)}-{n(4)}", lambda: " " + after_number()),
        (PHONE, both(PHONE), us, lambda: r.choice((" ", ". ", ", "))),
        (PHONE, announce[PHONE], lambda: f"{n(3)}-{n(3)}-{n(4)}", lambda: " "),
        (PHONE, announce[PHONE], lambda: f"{n(3)}.{n(3)}.{n(4)}", lambda: " "),
        (PHONE, announce[PHONE], lambda: f"0{n(3)} {n(3)} {n(4)}", lambda: " "),
        (PHONE, announce[PHONE], lambda: f"00{n(2)} {n(2)} {n(4)} {n(3)}", lambda: " "),
        (EMAIL, both(EMAIL), lambda: f"{name()} [at] {host()} [dot] {end()}", lambda: " "),
        (EMAIL, both(EMAIL), lambda: f"{name()}(at){host()}.{end()}", lambda: " "),
        (EMAIL, both(EMAIL), lambda: f"{name()} at {host()} dot {end()}", lambda: " "),
        (EMAIL, announce[EMAIL], lambda: f"{name()} @ {host()}.{end()}", lambda: " "),
        (EMAIL, both(EMAIL), lambda: f"{name()} (at) {host()} (dot) {end()}", lambda: " "),
        (IP, both(IP), lambda: ":".join(hexes(4) for _ in range(8)), lambda: " "),
        (IP, both(IP), lambda: f"2001:{hexes(3)}::{hexes(4)}", lambda: " "),
        (IP, both(IP), lambda: "[.]".join(octet() for _ in range(4)), lambda: " "),
        (IP, announce[IP], lambda: " dot ".join(octet() for _ in range(4)), lambda: " "),
        (CARD, both(CARD), card, lambda: " " + after_number()),
        (CARD, both(CARD), lambda: fours(card(), r.choice(" -")), lambda: " " + after_number()),
        (CARD, both(CARD), lambda: fours(card(), r.choice(("_", ".", "  ", "/"))), lambda: " "),
        (CARD, both(CARD), lambda: (lambda c, s: s.join((c[:4], c[4:10], c[10:])))(card("37", 15), sep()), lambda: " "),
        (CARD, announce[CARD], lambda: card("34", 15), lambda: " "),
        (None, prose, lambda: f"{words(1)} at {words(1)}. {words(1).capitalize()}", lambda: " "),
        (None, prose, lambda: f"{words(1)} at {words(1)} . {words(1)}", lambda: " "),
        (None, prose, lambda: f"{words(1)} at {words(1)}. {words(1).capitalize()}. {words(1).capitalize()}", lambda: ". "),
        (None, (*announce[EMAIL], *prose), lambda: f"{words(1).capitalize()} at {words(1)}.{words(1).capitalize()}", lambda: " "),
        (None, announce[EMAIL], lambda: f"{words(1)} at {words(1)}. {r.choice(('De', 'It', 'At', 'Es', 'Co'))}", lambda: f" {words(2)} "),
        (None, prose, lambda: f"{words(1)} at {host()}.{end()}", lambda: " "),
        (None, (*other, *prose), lambda: f"20{n(2)}-0{r.randrange(1, 10)}-{r.randrange(10, 29)} {r.randrange(10, 24)}:{n(2)}:{n(2)}", lambda: " "),
        (None, (*other, *prose), lambda: f"{r.randrange(10, 29)}.0{r.randrange(1, 10)}.20{n(2)}", lambda: " "),
        (None, (*other, *prose), lambda: f"{n(1)}.{n(2)}.{n(1)}.{n(2)}.{n(1)}", lambda: " "),
        (None, (*other, *prose), wrong_card, lambda: " "),
        (None, (*other, *prose), lambda: fours(wrong_card(), r.choice(" -./_")), lambda: " "),
        (None, (*other, *announce[CARD]), wrong_card, lambda: " "),
        (None, other, lambda: n(r.choice((13, 14, 15))), lambda: " "),
        (None, prose, lambda: n(r.choice((13, 14, 15, 17, 18, 19))), lambda: " "),
        (None, (*other, *prose), lambda: f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", lambda: " "),
        (None, (*other, *prose), lambda: f"{r.randrange(1800, 2030)}-{r.randrange(1800, 2030)}", lambda: " "),
        (None, (*other, *prose), lambda: " ".join(n(r.randrange(2, 5)) for _ in range(r.randrange(2, 5))), lambda: " "),
        (None, (*other, *prose), lambda: f"{n(2)}.{n(3)}.{n(3)},{n(2)}", lambda: " "),
        (None, (*other, *prose), lambda: f"{n(3)}/{n(3)}/{n(4)}", lambda: " "),
        (None, (*other, *prose), lambda: f"{n(3)}-{n(3)}-{n(4)}", lambda: " "),
        (None, prose, lambda: f"{r.randrange(10, 24)}:{r.randrange(10, 60)}:{r.randrange(10, 60)}", lambda: " "),
        (None, prose, lambda: ":".join(hexes(2) for _ in range(6)), lambda: " "),
        (None, prose, lambda: f"{words(1)}::{words(1)} {n(2)}", lambda: " "),
        (None, prose, lambda: ".".join(n(4) for _ in range(4)), lambda: " "),
    )
    out = []
    for kind, befores, value, after in sorts:
        for _ in range(per_sort):
            before = r.choice(befores)
            left = f"{words(r.randrange(0, 5))} {before} ".replace("  ", " ").lstrip()
            found = value()
            text = f"{left}{found}{after()} {words(r.randrange(0, 5))}"
            out.append((text, [] if kind is None else [(kind, len(left), len(left) + len(found))]))
    return out


def _tree(lines: list[str], at: int, nodes: list[list[float]]) -> tuple[int, int]:
    """(node, line after it) of the tree printed from a line on; nodes: [feature or -1, bound or value, yes, no]."""
    here = len(nodes)
    if m := re.match(r"Predict: (\S+)", lines[at]):
        nodes.append([-1, float(m[1]), here, here])
        return here, at + 1
    feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
    nodes.append([int(feature), float(bound), 0, 0])
    nodes[here][2], at = _tree(lines, at + 1, nodes)
    nodes[here][3], at = _tree(lines, at + 1, nodes)  # steps over "Else (...)"
    return here, at


class Judge:
    """Boosted trees as arrays, a calibration curve and a threshold for each kind."""

    def __init__(self, printed: str, weights: list[float]) -> None:
        lines = [x.strip() for x in printed.splitlines()]
        self.trees = []
        for k, x in enumerate(lines):
            if x.startswith("Tree "):
                nodes: list[list[float]] = []
                _tree(lines, k + 1, nodes)
                self.trees.append(np.array(nodes))
        self.weights, self.slope, self.intercept, self.thresholds = weights, 1.0, 0.0, np.full(len(KINDS), 0.5)

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """The chance of a true finding by the trees alone."""
        margin = np.zeros(len(rows))
        for tree, weight in zip(self.trees, self.weights, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                feature = tree[at, 0].astype(np.int64)
                yes = rows[np.arange(len(rows)), np.maximum(feature, 0)] <= tree[at, 1]
                at = np.where(yes, tree[at, 2], tree[at, 3]).astype(np.int64)
            margin += weight * tree[at, 1]
        return 1 / (1 + np.exp(-2 * np.clip(margin, -15, 15)))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        p = self.odds(rows)
        return 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.intercept)))

    def calibrate(self, rows: np.ndarray, true: np.ndarray, precision: float = PRECISION) -> None:
        """Fits the curve, and sets each kind's threshold to the least score from 0.5 on from which on so many are true."""
        self.slope, self.intercept = fit_curve(self.odds(rows), true)
        score = self.scores(rows)
        for kind in range(len(KINDS)):
            own = rows[:, 0] == kind
            order = np.argsort(-score[own], kind="stable")
            s, share = score[own][order], np.cumsum(true[own][order]) / np.arange(1, own.sum() + 1)
            fit = np.flatnonzero((share >= precision) & (s >= 0.5) & np.r_[s[1:] < s[:-1], True])
            self.thresholds[kind] = s[fit[-1]] if len(fit) else 1.01


def trained(spark: SparkSession, findings: list[tuple[str, list[Span]]], precision: float = PRECISION) -> Judge:
    """Trees from four fifths of the findings, curve and thresholds from the rest."""
    rows = [(k % 5 == 4, features(text, p), float(p in spans)) for k, (text, spans) in enumerate(findings) for p in proposals(text) if not overlaps(p, base_spans(text))]
    table = spark.createDataFrame([(y, Vectors.dense(x)) for late, x, y in rows if not late], ["label", "features"]).coalesce(1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, minInstancesPerNode=5).fit(table)
    judge = Judge(model.toDebugString, list(model.treeWeights))
    judge.calibrate(np.array([x for late, x, _ in rows if late]), np.array([y for late, _, y in rows if late]), precision)
    return judge


_KNOWN: dict[str, Judge] = {}


def known_judge(spark: SparkSession) -> Judge:
    """The judge trained from the findings made by rule, once in an application."""
    app = spark.sparkContext.applicationId
    if app not in _KNOWN:
        _KNOWN[app] = trained(spark, labelled_findings())
    return _KNOWN[app]


def overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < end and start < span[2] for _, start, end in others)


def _free(found: list[Span], taken: list[Span]) -> list[Span]:
    """Those that overlap none that is taken."""
    edges = sorted((start, end) for _, start, end in taken)
    starts, reach, most = [s for s, _ in edges], [], 0
    for _, end in edges:
        most = max(most, end)
        reach.append(most)
    last = np.searchsorted(starts, [p[2] for p in found], side="left") - 1  # the last one that begins before the end
    return [p for p, k in zip(found, last.tolist(), strict=True) if k < 0 or reach[k] <= p[1]]


def spans_of(texts: list[str], judge: Judge) -> list[tuple[list[Span], list[tuple[Span, float]]]]:
    """For each text, the spans of the fixed patterns, and those added with their scores; both by kind, then start."""
    base = [base_spans(t) for t in texts]
    offered = [_free(proposals(t), b) for t, b in zip(texts, base, strict=True)]
    rows = [features(t, p) for t, ps in zip(texts, offered, strict=True) for p in ps]
    scores = iter(judge.scores(np.array(rows)).tolist() if rows else [])
    out = []
    for own, ps in zip(base, offered, strict=True):
        judged = [(p, s) for p, s in zip(ps, scores, strict=False) if s >= judge.thresholds[p[0]]] if ps else []
        taken: list[tuple[Span, float]] = []
        used: set[int] = set()
        for p, s in sorted(judged, key=lambda x: (-x[1], x[0][1] - x[0][2], x[0])):
            places = range(p[1], p[2])
            if used.isdisjoint(places):
                used.update(places)
                taken.append((p, s))
        out.append((sorted(own), sorted(taken)))
    return out


def told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, judge: Judge | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row of docs.

    The counts and base_sha256 are of the fixed patterns' spans, spans holds all. A null text counts as
    empty: no spans, the digest of an empty string. Rows with null or repeated ids stay rows of their
    own. Places are code points, ends exclusive. Other columns aren't looked at, whatever their names; an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(judge or known_judge(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of([t or "" for t in batch.column("text").to_pylist()], sent.value)
            counts = {f"n_{name}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k, name in enumerate(KINDS)}
            rest = {
                "base_sha256": [hashlib.sha256(told(base).encode()).hexdigest() for base, _ in found],
                "spans": [told([*base, *(p for p, _ in added)]) for base, added in found],
                "n_added": pa.array([len(added) for _, added in found], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | counts | rest)

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, judge: Judge | None = None, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets, from left to right; null texts stay null, and an overlapping span's rest goes with the first."""
    sent = docs.sparkSession.sparkContext.broadcast(judge or known_judge(docs.sparkSession))

    def masked(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            found = spans_of([t or "" for t in texts], sent.value)
            new = [None if t is None else masked(t, [*base, *(p for p, _ in added)]) for t, (base, added) in zip(texts, found, strict=True)]
            yield batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(new, batch.column(text_col).type))

    return docs.mapInArrow(run, docs.schema)
