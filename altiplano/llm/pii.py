"""Personal data: fixed patterns, and gradient-boosted trees over the spans of high-recall generators.

The base spans are exact matches of four patterns.  The generators propose more, overlapping spans (phones without a
plus sign, spelled-out addresses, cards in other groupings, addresses with a port); boosted trees score each from its
format and its context, a logistic calibration on held-out rows turns scores into probabilities, and a threshold by
kind, set for precision on those rows, selects.  Of overlapping selected spans the most probable stays; a base span
always stays, also inside a selected span of its kind that extends it.  The trees are trained here, on labelled findings written from a seeded grammar (TRAIN_ROWS of them).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import arrow_map, known_id, raw

KINDS = ("email", "ip", "card", "phone")
#: Labelled findings that the trees are fitted on; a third more are held out for the calibration.
TRAIN_ROWS = 6000
PRECISION = 0.995

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELLED = re.compile(r"[\[(]at[\])]| dot ", re.I)
_ANY = re.compile(r"[0-9@]|[\[(]at[\])]| dot ", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a match has one @, so the runs left of each @ are looked at in turn."""
    done, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > done and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _FIRST_DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


_FIRST_DIGIT = re.compile("[0-9]")

#: The generators, by kind.
_PROPOSE = (
    (0, re.compile(r"(?<![\w.])[\w.+-]{2,40}(?: ?(?:\[at\]|\(at\)) ?[\w-]{2,40}(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z]{2,12}){1,3}| at [\w-]{2,40}(?: dot [A-Za-z]{2,12}){1,3})(?!\w)", re.I | re.A)),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]?[0-9]{4}){2}[ ./_-]?[0-9]{1,7}(?![0-9])|(?<![0-9])3[0-9]{3}[ .-]?[0-9]{6}[ .-]?[0-9]{5}(?![0-9])")),
    (3, re.compile(r"(?<![0-9A-Za-z])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,2}[0-9]{2,8}){1,5}(?![0-9A-Za-z])|(?<![0-9A-Za-z.+])[0-9]{9,11}(?![0-9A-Za-z])")),
)
_NEAR = tuple(re.compile(p, re.I) for p in (r"\b(?:e-?mail|mail|contact|write|reach)", r"\b(?:ip|host|server|address|addr|login|ping|node)\b", r"\b(?:card|visa|master\w*|amex|payment|pay|credit|debit)\b", r"\b(?:phone|tel|telephone|mobile|cell|call|fax|dial|whatsapp|ring)\b", r"\b(?:version|ver|v|release|build|section|isbn|order|invoice|ref|page|pp|no|id|code|serial|score|date|since|from|price|total|sku|lot|art|issue|vol)\b"))
_DATE = re.compile(r"(?:1[89]|20)[0-9]{2}[ ./-][01]?[0-9]|[0-3]?[0-9][ ./-][01]?[0-9][ ./-](?:1[89]|20)?[0-9]{2}$")


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span, and the words and characters beside it."""
    s = text[start:end]
    d = _digits(s)
    before, after = text[max(0, start - 40) : start], text[end : end + 20]
    groups = re.findall("[0-9]+", s)
    seps = [c for c in s if not c.isalnum()]
    return [
        float(kind),
        float(len(s)),
        float(len(d)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(len(groups[0]) if groups else 0),
        float(len(groups[-1]) if groups else 0),
        float(len(set(seps))),
        float(seps.count(" ")),
        float(seps.count("-")),
        float(seps.count(".")),
        float(seps.count("/")),
        float("(" in s),
        float(luhn(d)) if d else -1.0,
        float(d[0]) if d else -1.0,
        float(len(set(d))),
        float(bool(_DATE.search(s))),
        float(all(int(g[-4:]) <= 255 and len(g) <= 3 for g in groups)) if groups else -1.0,
        float(any(len(g) > 1 and g[0] == "0" for g in groups)),
        float(bool(re.search(r"\[at\]|\(at\)", s, re.I))),
        float(bool(re.search(r" at ", s, re.I))),
        float(bool(re.search(r"\[dot\]|\(dot\)| dot ", s, re.I))),
        float("@" in s),
        float(bool(re.search(r"(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$", s, re.I))),
        float(":" in s),
        *[float(bool(p.search(before))) for p in _NEAR],
        float(before[-1:].isdigit() or after[:1].isdigit()),
        float(before[-1:] in "$€£#="),
        float(after.lstrip()[:1] in "%€$"),
    ]


class Trees:
    """Logistic gradient boosting with histogram trees of fixed depth."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature, cut by inner node; value by leaf
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(rate / (1 - rate)))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                for n in range((1 << level) - 1, (2 << level) - 1):
                    rows = np.flatnonzero(node == n)
                    best = 1e-6
                    gt, ht = g[rows].sum(), h[rows].sum()
                    for f in range(x.shape[1]):
                        if not len(cuts[f]) or len(rows) < 10:
                            continue
                        gl = np.cumsum(np.bincount(binned[rows, f], g[rows], len(cuts[f]) + 1))[:-1]
                        hl = np.cumsum(np.bincount(binned[rows, f], h[rows], len(cuts[f]) + 1))[:-1]
                        gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                        at = int(gain.argmax())
                        if gain[at] > best:
                            best, feature[n], cut[n] = gain[at], f, cuts[f][at]
                    node[rows] = 2 * n + 1 + (x[rows, feature[n]] > cut[n])
            leaf = node - ((1 << self.depth) - 1)
            value = self.rate * np.bincount(leaf, g, 1 << self.depth) / (np.bincount(leaf, h, 1 << self.depth) + self.ridge)
            self.trees.append((feature, cut, value))
            margin += value[leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - ((1 << self.depth) - 1)]
        return out


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of the probability 1 / (1 + exp(-(a * margin + b))), by Newton steps with a small ridge."""
    w = np.array([1.0, 0.0])
    z = np.column_stack([margin, np.ones(len(margin))])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(hess, z.T @ (y - p) - 1e-3 * w)
    return float(w[0]), float(w[1])


def labelled(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of findings from a seeded grammar: personal data, and what only looks like it."""
    r = np.random.default_rng(seed)
    num = lambda n: "".join(map(str, r.integers(0, 10, n)))
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    word = lambda: "".join(pick(["an", "er", "the", "on", "re", "ti", "le", "ou", "ing", "st", "ba", "mo", "ka", "zu"]) for _ in range(int(r.integers(1, 4))))

    def card() -> str:
        body = pick(["4", "5", "37"]) + num(14)
        body = body[: 14 if body[0] == "3" else 15]
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    def found() -> tuple[int, str, str]:
        kind = int(r.integers(4))
        if kind == 0:
            at, dot = pick([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("[at]", "."), (" (at) ", ".")])
            return 0, word() + pick(["", ".", "_"]) + word() + at + word() + dot + pick(["com", "org", "net", "de", "fr"]), pick(["email me: ", "contact ", "write to ", "mail ", ""])
        if kind == 1:
            return 1, ".".join(str(r.integers(1, 255)) for _ in range(4)) + pick(["", f":{r.integers(20, 65000)}"]), pick(["host ", "server ", "ip ", "from ", "ping ", ""])
        if kind == 2:
            c = card()
            sep = pick([".", "/", "_", "-", " "])
            return 2, sep.join(c[i : i + 4] for i in range(0, len(c), 4)), pick(["card ", "visa: ", "pay with ", "credit card no ", ""])
        shape = pick(["({a}) {b}-{c}", "{a}-{b}-{c}", "0{a} {b}{c}", "({a}) {b} {c}", "00{a} {b} {c}", "(0{a}) {b}{c}", "{a}{b}{c}", "0{a}{b}{c}"])
        return 3, shape.format(a=pick([num(3), "2" + num(2), "5" + num(2)]), b=num(3), c=num(4)), pick(["call ", "phone: ", "tel ", "tel. ", "mobile ", "fax "])

    def false() -> tuple[int, str, str]:
        kind = int(r.integers(4))
        if kind == 0:
            return 0, pick([f"{word()} (at) {word()}. {word()}", f"{word()} at {word()} dot {word()}", f"{word()} at the dot {word()}", f"{word()} [at] {word()}.{word()}"]), pick(["looked ", "we ", "", "was "])
        if kind == 1:
            return 1, ".".join(pick([str(r.integers(256, 999)), str(r.integers(0, 20))]) for _ in range(4)), pick(["version ", "section ", "release ", "v ", ""])
        if kind == 2:
            return 2, pick([num(16), num(4) + "-" + num(4) + "-" + num(4) + "-" + num(4), num(15)]), pick(["order ", "isbn ", "serial ", "invoice ", "id ", ""])
        return 3, pick([f"{r.integers(1900, 2030)}-{r.integers(1, 13):02d}-{r.integers(1, 29):02d}", f"{r.integers(1, 29)}/{r.integers(1, 13)}/{r.integers(1950, 2030)}", f"{num(2)} {num(3)}", f"{num(4)}-{num(4)}", f"{num(3)}.{num(2)}", f"{num(3)} {num(3)} {num(3)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(2)}-{num(2)}", num(9), num(10), num(11), f"{num(4)} {num(8)}", f"{num(3)} {num(7)}"]), pick(["on ", "order ", "pages ", "since ", "price ", "score ", "no ", "id ", "", ""])

    xs, ys = [], []
    for i in range(rows):
        kind, span, lead = found() if i % 2 else false()
        text = f"{word()} {word()} {lead}"
        xs.append(features(text + span + pick([" ", ". ", ", "]) + word(), kind, len(text), len(text) + len(span)))
        ys.append(i % 2)
    return np.array(xs), np.array(ys, float)


@lru_cache(maxsize=2)
def fit(rows: int = TRAIN_ROWS, precision: float = PRECISION, seed: int = 7) -> tuple[Trees, float, float, tuple[float, ...]]:
    """Trees, the calibration, and the least probability of each kind that had the precision on held-out findings."""
    trees = Trees().fit(*labelled(rows, seed))
    x, y = labelled(max(300, rows // 3), seed + 1)
    m = trees.margin(x)
    a, b = calibrate(m, y)
    p = 1 / (1 + np.exp(-(a * m + b)))
    least = []
    for kind in range(len(KINDS)):
        own = np.flatnonzero(x[:, 0] == kind)
        order = own[np.argsort(-p[own])]
        good = np.cumsum(y[order]) / np.arange(1, len(order) + 1) >= precision
        ok = np.flatnonzero(good)
        least.append(max(0.5, float(p[order[ok[-1]]])) if len(ok) else 1.1)
    return trees, a, b, tuple(least)


def propose(text: str) -> list[tuple[int, int, int]]:
    return [(m.start(), kind, m.end()) for kind, p in _PROPOSE if kind or _SPELLED.search(text) for m in p.finditer(text)]


class Taken:
    """Disjoint spans, for a quick look whether another meets one."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, s: int, e: int) -> bool:
        i = bisect_left(self.ends, s + 1)
        return i < len(self.starts) and self.starts[i] < e

    def add(self, s: int, e: int) -> None:
        i = bisect_left(self.starts, s)
        self.starts.insert(i, s)
        self.ends.insert(i, e)


def beside(base: list[tuple[int, int, int]], proposed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The proposed spans that meet no base span, or that hold all of those they meet, of their own kind, and more."""
    out, at = [], 0
    longest = max((e - s for s, _, e in base), default=0)
    for s, kind, e in sorted(proposed):
        while at < len(base) and base[at][0] < s - longest:
            at += 1
        held = True
        for i in range(at, len(base)):
            a, k, b = base[i]
            if a >= e:
                break
            if b > s and (k != kind or a < s or b > e or (a, b) == (s, e)):
                held = False
                break
        if held:
            out.append((s, kind, e))
    return out


def select(base: list[tuple[int, int, int]], proposed: list[tuple[int, int, int]], prob: np.ndarray, least: tuple[float, ...]) -> list[tuple[int, int, int]]:
    """All base spans, and of the proposed ones (from beside()), most probable first, those above their threshold that
    meet none chosen before."""
    out, taken = list(base), Taken()
    for i in np.lexsort(([x[2] for x in proposed], [x[0] for x in proposed], -prob)):
        s, kind, e = proposed[i]
        if prob[i] >= least[kind] and not taken.meets(s, e):
            taken.add(s, e)
            out.append((s, kind, e))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(model):
    def run(batches) -> Iterator[dict]:
        trees, a, b, least = model.value
        for batch in batches:
            ks, found, wanted, xs = batch.column(0).to_pylist(), [], [], []
            for text in batch.column(1).to_pylist():
                text = text.decode("utf-8", "replace")
                if not _ANY.search(text):
                    found.append([])
                    wanted.append([])
                    continue
                base = base_spans(text)
                more = beside(base, propose(text))
                found.append(base)
                wanted.append(more)
                xs += [features(text, k, s, e) for s, k, e in more]
            prob = 1 / (1 + np.exp(-np.clip(a * trees.margin(np.array(xs)) + b, -30, 30))) if xs else np.empty(0)
            out = {"k": ks, "base": [], "spans": [], **{f"n_{x}": [] for x in KINDS}}
            at = 0
            for base, more in zip(found, wanted, strict=True):
                out["base"].append(joined(base))
                out["spans"].append(joined(select(base, more, prob[at : at + len(more)], least)) if more else joined(base))
                at += len(more)
                for i, x in enumerate(KINDS):
                    out[f"n_{x}"].append(sum(k == i for _, k, _ in base))
            if ks:
                yield {c: out[c] for c in ("k", *[f"n_{x}" for x in KINDS], "base", "spans")}

    return run


def _digests(run):
    def digested(batches) -> Iterator[dict]:
        for out in run(batches):
            yield out | {"base": [hashlib.sha256(x.encode()).hexdigest() for x in out["base"]]}

    return digested


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """id_col, n_email, n_ip, n_card, n_phone (of the base), base (digest: base_sha256), spans, by row of docs.

    Spans are kind:start:end in code points, end exclusive, by start and then kind.  A null text is empty; a null id
    comes back null; repeated rows come back as often; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit())
    run = _scan(model)
    counts = ", ".join(f"n_{x} long" for x in KINDS)
    out = arrow_map(raw(docs, id_col, text_col), _digests(run) if digest else run, f"k long, {counts}, base string, spans string")
    return out.withColumn("k", known_id()).withColumnRenamed("k", id_col).withColumnRenamed("base", "base_sha256" if digest else "base")


def redact(text: str, spans: str) -> str:
    """text with each span of a spans column replaced by its kind."""
    out, last = [], 0
    for x in filter(None, spans.split(",")):
        kind, s, e = x.split(":")
        if int(s) >= last:
            out += [text[last : int(s)], f"<{kind}>"]
        last = max(last, int(e))
    return "".join(out) + text[last:]
