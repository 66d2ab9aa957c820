"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans (``Proposals``): around every at-sign, however it is written, the address as far as it goes; and of every
run of digit groups with the separators people use, all sub-runs that begin and end at group borders and have as many digits as a kind can have (a
card 12 to 19, a phone number 7 to 15, an address of the network four groups). Boosted trees score each candidate from its format (digits, separators,
checksums, group sizes, the neighbours in its run) and its context (cue words, neighbouring characters). A logistic curve over held-out margins calibrates the
scores, and each kind has the least threshold that keeps its precision there. Every candidate is scored, those of the base patterns too, and the
scores choose between overlapping ones: the likeliest first, none touching another. Spans of the four base patterns always stay, with their score
and the model's verdict beside them; other accepted spans are added where they touch no base span.

The trees learn from contexts of the documents themselves (``contexts``): at most ``fit_spans`` places of base spans and as many of other digit runs, drawn by a
hash from at most about ``fit_docs`` documents; this sample, and `span_chars` of a span in it, are the only bounds. True spans are the base ones, also rewritten in other formats of their kind at the same
places, and a few seeded contexts, so that every kind has some where the documents have none. False ones are all other candidates that overlap a
true one (sub-runs, runs with a neighbour, other kinds), runs of digits without a cue, and dates, versions, numbers and amounts at such places.

Texts are scanned where they are, joined in pieces of a batch, by arrays and by patterns that don't go back: time follows the length, also
of a text of digits alone. Nothing is shuffled.

Defined results: null and empty texts have no spans; a null doc_id stays null; repeated rows are scanned each for itself; positions are code
points; of equally likely candidates the first, then the kind as listed, then the shorter wins; empty tables give no rows; without documents the trees
learn from the seeded contexts; extra columns are not read by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared, words
from vellumq.llm.toxicity import calibration

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP_, CARD_, PHONE_ = range(4)
#: The base patterns. Possessive repeats give the same matches as plain ones here, without going back.
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The generators: at-signs, hosts after them, what may stand between the groups of a number (one or two characters).
AT = re.compile(r" ?@ ?| ?[(\[] ?at ?[)\]] ?", re.I)
ANY_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?[(\[] ?dot ?[)\]] ?)[A-Za-z0-9-]++)++", re.I)
GAPS = " ().-/[]"
MOST_DIGITS, GROUPS = 19, 19
#: Cue words of several languages before a span, by kind, and words that speak against one.
CUES = {
    "email": re.compile(r"(?:e-?mail|contact|courriel|correo|write|reply)\W{0,3}(?:\w+\W{1,2})?$", re.I),
    "ip": re.compile(r"(?:\bip|address|host|server|adresse|from)\W{0,3}(?:\w+\W{1,2})?$", re.I),
    "card": re.compile(r"(?:card|visa|mastercard|amex|carte|tarjeta|karte)\W{0,3}(?:\w+\W{1,2})?$", re.I),
    "phone": re.compile(r"(?:phone|tel|t[ée]l[ée]phone|call|fax|mobile|cell|telefon|tel[ée]fono|ring)\W{0,3}(?:\w+\W{1,2})?$", re.I),
}
NOT = re.compile(r"(?:version|\bv|license|licence|section|chapter|page|isbn|issn|no|nr|id|order|ticket|invoice|\$|€|£)\W{0,3}$", re.I)
BEFORE, AFTER = 24, 8
#: Between the texts of a piece: no pattern takes it.
BREAK = "\x00"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' spans, leftmost and not overlapping within a kind."""
    found: list[tuple[int, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (host := HOST.match(text, at + 1)):
            found.append((start, EMAIL, host.end()))
            done = host.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(map(_octet, m.group().split("."))):
            found.append((m.start(), IP_, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 2 * MOST_DIGITS:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD_, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            found.append((m.start(), PHONE_, m.end()))
    return sorted(found)


#: Names of the columns of ``Proposals.values``.
NAMES = (
    "kind", "chars", "digits", "groups", "longest", "shortest", "first", "last", "luhn", "octets", "dots", "dashes", "spaces", "slashes", "brackets", "plus",
    "cue", "other_cue", "against", "letter_before", "letter_after", "sign_after", "run_before", "run_after", "year_first", "year_last", "at_form", "labels", "last_label", "local",
)


@dataclass
class Proposals:
    """Candidates of a text, or of texts joined by BREAK: where they begin and end, their kind, and a row of values for each."""

    start: np.ndarray
    kind: np.ndarray
    end: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def _cues(text: str, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each place: the cues of the four kinds and the words against, in the characters before it."""
    out = np.zeros((len(starts), 5))
    telling = np.concatenate(([0], np.cumsum((codes >= 0x41) | (codes == 0x24))))  # letters and signs of money
    for i in np.flatnonzero(telling[starts] > telling[np.maximum(starts - BEFORE, 0)]).tolist():
        s = int(starts[i])
        window = text[max(0, s - BEFORE) : s]
        window = window[window.rfind(BREAK) + 1 :]
        out[i] = [bool(CUES[k].search(window)) for k in KINDS] + [bool(NOT.search(window))]
    return out


def _addresses(text: str) -> list[tuple[int, int, int, int, int, int]]:
    """(start, end, form of the at-sign, labels of the host, length of its last label or 0 if not of letters, length of the local part)."""
    out = []
    for m in AT.finditer(text):
        start = m.start()
        while start and text[start - 1] in LOCAL:
            start -= 1
        host = ANY_HOST.match(text, m.end())
        if start < m.start() and host:
            labels = re.split(r"\.| ?[(\[] ?dot ?[)\]] ?", host.group(), flags=re.I)
            form = 2 if "@" not in m.group() else int(len(m.group()) > 1)
            out.append((start, host.end(), form, len(labels), len(labels[-1]) if labels[-1].isalpha() else 0, m.start() - start))
    return out


class _Groups:
    """The digit groups of a text, and sums over them; ``rows`` makes the candidates that begin at some of them."""

    def __init__(self, text: str, codes: np.ndarray):
        self.text, self.codes = text, codes
        digit = (codes >= 0x30) & (codes <= 0x39)
        edge = np.diff(np.concatenate(([False], digit, [False])).astype(np.int8))
        self.begin, self.end = begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.length = length = end - begin
        outside = np.concatenate(([0], np.cumsum(~np.isin(codes, [ord(c) for c in GAPS]))))
        self.linked = np.zeros(len(begin) + 1, bool)  # to the group before
        self.linked[1:-1] = (begin[1:] - end[:-1] <= 3) & (outside[begin[1:]] == outside[end[:-1]])
        self.sums = np.concatenate(([0], np.cumsum(length)))
        # Luhn sums of any stretch of all digits: the digit before the last is the first that is doubled
        value = (codes[digit] - 0x30).astype(np.int64)
        doubled = np.where(value > 4, 2 * value - 9, 2 * value)
        even = np.arange(len(value)) % 2 == 0
        self.checks = [np.concatenate(([0], np.cumsum(np.where(even == (p == 0), doubled, value)))) for p in (0, 1)]  # doubled at even places, at odd ones
        power = 10.0 ** np.minimum(np.repeat(self.sums[1:], length) - 1 - np.arange(len(value)), 30)
        weight = np.bincount(np.repeat(np.arange(len(begin)), length), value * power, len(begin))
        self.small = np.concatenate(([0], np.cumsum(weight <= 255)))
        self.year = (length == 4) & (weight >= 1900) & (weight < 2100)
        signs = {"dots": ".", "dashes": "-", "spaces": " ", "slashes": "/", "brackets": "()[]"}
        self.signs = {k: np.concatenate(([0], np.cumsum(np.isin(codes, [ord(c) for c in v]), dtype=np.int32))) for k, v in signs.items()}

    def runs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last group of all sub-runs with 7 to 19 digits, or of four groups, that begin at groups low to high."""
        n = len(self.begin)
        first = np.arange(low, high)
        firsts, lasts, last = [], [], first
        for k in range(GROUPS):
            digits = self.sums[last + 1] - self.sums[first]
            fit = digits <= MOST_DIGITS
            first, last, digits = first[fit], last[fit], digits[fit]
            ok = (digits >= 7) | (k == 3)
            firsts.append(first[ok])
            lasts.append(last[ok])
            on = self.linked[np.minimum(last + 1, n)]
            first, last = first[on], last[on] + 1
            if not len(first):
                break
        return np.concatenate(firsts), np.concatenate(lasts)

    def rows(self, low: int, high: int) -> Proposals:
        first, last = self.runs(low, high)
        codes, length, sums = self.codes, self.length, self.sums
        start, stop = self.begin[first], self.end[last]
        padded = np.concatenate(([0, 0], codes))
        one, two = padded[start + 1], padded[start]  # one and two characters before
        opened = one == 0x28
        plus = (one == 0x2B) | opened & (two == 0x2B)
        start = start - opened - plus
        digits, groups = sums[last + 1] - sums[first], last - first + 1
        longest, shortest = length[first].copy(), length[first].copy()
        for k in range(1, int(groups.max(initial=0))):
            inner = length[np.minimum(first + k, last)]
            longest, shortest = np.maximum(longest, inner), np.minimum(shortest, inner)
        a, b = sums[first], sums[last + 1]
        valid = np.where(b % 2 == 0, self.checks[0][b] - self.checks[0][a], self.checks[1][b] - self.checks[1][a]) % 10 == 0
        counts = {k: v[stop] - v[start] for k, v in self.signs.items()}
        octets = (groups == 4) & (self.small[last + 1] - self.small[first] == 4) & (counts["dots"] == 3) & (counts["dashes"] + counts["slashes"] == 0)
        where, inverse = np.unique(start, return_inverse=True)
        cues = _cues(self.text, codes, where)[inverse]
        parts = []
        for kind, own in ((IP_, groups == 4), (CARD_, (digits >= 12) & (digits <= 19)), (PHONE_, (digits >= 7) & (digits <= 15))):
            i = np.flatnonzero(own)
            values = np.zeros((len(i), len(NAMES)), np.float32)
            others = [k for k in range(4) if k != kind]
            _fill(
                values, kind=kind, chars=(stop - start)[i], digits=digits[i], groups=groups[i], longest=longest[i], shortest=shortest[i], first=length[first[i]], last=length[last[i]],
                luhn=valid[i] & (digits[i] >= 13), octets=octets[i], plus=plus[i], cue=cues[i, kind], other_cue=cues[i][:, others].max(1, initial=0), against=cues[i, 4],
                run_before=self.linked[first[i]], run_after=self.linked[last[i] + 1], year_first=self.year[first[i]], year_last=self.year[last[i]], **{k: v[i] for k, v in counts.items()},
            )
            _around(values, codes, start[i], stop[i])
            parts.append(Proposals(start[i], np.full(len(i), kind), stop[i], values))
        return _together(parts)


def _together(parts: list[Proposals]) -> Proposals:
    return Proposals(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("start", "kind", "end", "values")))


def proposed(text: str, groups: int = 4096) -> Iterator[Proposals]:
    """All candidates, in parts that begin at so many digit groups; spans overlap, and one span may be proposed as several kinds."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    numbers = _Groups(text, codes)
    for low in range(0, len(numbers.begin), groups):
        yield numbers.rows(low, min(low + groups, len(numbers.begin)))
    addresses = _addresses(text) if AT.search(text) else []
    if addresses:
        start, stop, form, labels, tail, local = (np.array(x) for x in zip(*addresses, strict=True))
        values = np.zeros((len(start), len(NAMES)), np.float32)
        cues = _cues(text, codes, start)
        _fill(values, kind=EMAIL, chars=stop - start, cue=cues[:, 0], other_cue=cues[:, 1:4].max(1), against=cues[:, 4], at_form=form, labels=labels, last_label=tail, local=local)
        _around(values, codes, start, stop)
        yield Proposals(start, np.full(len(start), EMAIL), stop, values)


def proposals(text: str) -> Proposals:
    """All candidates of a text."""
    none = np.zeros(0, np.int64)
    return _together([Proposals(none, none, none, np.zeros((0, len(NAMES)), np.float32)), *proposed(text)])


def _fill(values: np.ndarray, **columns) -> None:
    for k, v in columns.items():
        values[:, NAMES.index(k)] = v


def _around(values: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
    padded = np.concatenate(([0], codes, [0]))
    before, after = padded[start], padded[end + 1]

    def letter(c: np.ndarray) -> np.ndarray:
        return (c >= 0x30) & (c <= 0x39) | (c >= 0x41) & (c <= 0x5A) | (c >= 0x61) & (c <= 0x7A) | (c >= 0xC0)

    _fill(values, letter_before=letter(before), letter_after=letter(after), sign_after=np.isin(after, [0x25, 0x2F, 0xB0]))


class Trees:
    """Gradient boosting of shallow regression trees for logistic loss, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 24, ridge: float = 1.0):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[:-1])) for j in range(x.shape[1])]
        self.rate, self.depth, self.bins, self.ridge = rate, depth, bins, ridge
        binned = self.binned(x)
        self.first = float(np.log(y.mean() / (1 - y.mean())))
        self.trees: list[tuple[np.ndarray, ...]] = []
        margin = np.full(len(y), self.first)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree: list[list[float]] = []
            self._grow(tree, binned, p - y, p * (1 - p), np.arange(len(y)), depth)
            rows = np.array(tree)
            self.trees.append((*rows[:, :4].astype(np.int64).T, rows[:, 4]))
            margin += rate * self._one(self.trees[-1], binned)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def _grow(self, tree: list, x: np.ndarray, g: np.ndarray, h: np.ndarray, own: np.ndarray, depth: int) -> int:
        """Adds a node (column, cut, where to go below it and above it, value) and all under it. A leaf goes to itself."""
        me, (n, width) = len(tree), x.shape
        total, weight = g[own].sum(), h[own].sum()
        tree.append([0, 255, me, me, -total / (weight + self.ridge)])
        if not depth:
            return me
        cells = (x[own] + np.arange(width) * self.bins).ravel()
        left, under = (np.cumsum(np.bincount(cells, np.repeat(v[own], width), width * self.bins).reshape(width, self.bins), axis=1)[:, :-1] for v in (g, h))
        gain = left**2 / (under + self.ridge) + (total - left) ** 2 / (weight - under + self.ridge) - total**2 / (weight + self.ridge)
        gain[(under < 1) | (weight - under < 1)] = 0
        best = int(gain.argmax())
        if gain.flat[best] > 1e-3:
            column, cut = divmod(best, self.bins - 1)
            low = x[own, column] <= cut
            tree[me][:2] = column, cut
            tree[me][2] = self._grow(tree, x, g, h, own[low], depth - 1)
            tree[me][3] = self._grow(tree, x, g, h, own[~low], depth - 1)
        return me

    def _one(self, tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
        column, cut, below, above, value = tree
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = np.where(x[rows, column[at]] <= cut[at], below[at], above[at])
        return value[at]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sums of all trees; equal rows are summed once."""
        binned = np.ascontiguousarray(self.binned(x))
        _, first, inverse = np.unique(binned.view(f"V{binned.shape[1]}").ravel(), return_index=True, return_inverse=True)
        kinds = binned[first]
        return (self.first + self.rate * sum(self._one(t, kinds) for t in self.trees))[inverse]


# -- what the trees learn from


def contexts(documents: DataFrame, fit_docs: int = 20_000, fit_spans: int = 2_000, span_chars: int = 600) -> list[tuple[str, int, int, int]]:
    """(text, start, kind, end) of at most fit_spans base spans, and as many other digit runs (kind -1), each with the characters around it; of longer spans the first span_chars characters."""
    total = documents.count()
    key = F.xxhash64("doc_id", "text", F.lit(13))
    picked = documents.select(key.alias("order"), "text").filter(shared.within(key, fit_docs / max(1, total)) & F.col("text").rlike("[0-9@]"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            rows: tuple[list, ...] = ([], [], [], [], [])
            texts = part.column("text").to_pylist()
            joined = BREAK.join(texts)
            begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
            kept, own = base(joined), proposals(joined)
            taken = bytearray(len(joined))
            for s, _, e in kept:
                taken[s:e] = b"\1" * (e - s)
            lone = {s: e for s, e in sorted(zip(own.start.tolist(), own.end.tolist(), strict=True)) if taken.find(1, s, e) < 0}  # of each place the longest
            spans = [*kept, *((s, -1, e) for s, e in lone.items())]
            of = np.searchsorted(begins, [s for s, _, _ in spans], "right") - 1
            at = np.array([s for s, _, _ in spans], np.int64) - begins[of]
            order = words.mix(part.column("order").to_numpy().view(np.uint64)[of] ^ words.mix(at.astype(np.uint64))) >> np.uint64(1)
            for (s, k, e), i, mixed in zip(spans, of.tolist(), order.tolist(), strict=True):
                low, high = max(int(begins[i]), s - 2 * BEFORE), min(int(begins[i + 1]) - 1, e + 2 * BEFORE)
                end = min(e, s + span_chars)
                for x, v in zip(rows, (mixed, joined[low:end] + joined[e:high], s - low, k, end - low), strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["order", "text", "start", "kind", "end"])

    rows = shared.written(picked.mapInArrow(cut, "order bigint, text string, start bigint, kind int, end bigint"), "contexts")
    out = [tuple(r) for side in ("kind >= 0", "kind < 0") for r in rows.filter(side).orderBy("order", "text", "start", "kind").limit(fit_spans).select("text", "start", "kind", "end").collect()]
    shared.remove(rows)
    return out


def rewritten(r: random.Random, kind: int, span: str) -> str:
    """The span in another format of its kind."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == EMAIL:
        name, _, host = span.partition("@")
        dots = r.choice([" [dot] ", "(dot)", ".", "[dot]"])
        return name + r.choice([" [at] ", "(at)", " @ ", "[at]", " (at) "]) + host.replace(".", dots)
    if kind == IP_:
        return r.choice(["[.]", " . ", "(.)"]).join(re.findall("[0-9]+", span))
    if kind == CARD_:
        return r.choice([".", " - ", "  "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    d = digits[-10:]
    return r.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"0{d[1]} {d[2:4]} {d[4:6]} {d[6:8]} {d[8:]}", f"({d[:3]}) {d[3:6]} {d[6:]}"])


def invented(r: random.Random, kind: int) -> str:
    """A true span of a kind in a base format."""

    def d(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    if kind == EMAIL:
        return f"{r.choice(['ana', 'b.lee', 'info', 'j_doe', 'max.m'])}{r.choice(['', d(2)])}@{r.choice(['mail', 'example', 'corp-x', 'uni'])}.{r.choice(['com', 'org', 'de', 'co.uk'])}"
    if kind == IP_:
        return ".".join(str(r.randint(1, 255)) for _ in range(4))
    if kind == CARD_:
        while True:
            x = r.choice("3456") + d(15)
            if luhn(x):
                return r.choice(["", " ", "-"]).join(x[i : i + 4] for i in range(0, 16, 4))
    return f"+{r.randint(1, 99)} {r.randint(2, 9)}{d(2)} {d(3)} {d(4)}"


def wrong(r: random.Random) -> str:
    """Digits that are no personal data."""

    def d(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    year = r.randint(1900, 2030)
    return r.choice([
        f"{r.randint(1, 30)}.{r.randint(1, 12)}.{year}", f"{year}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{year}/{r.randint(10, 12)}/{r.randint(10, 28)}", f"{r.randint(10, 28)}/{r.randint(10, 12)}/{year}", d(9), d(r.randint(6, 24)),
        f"{r.randint(256, 999)}.{d(3)}.{d(3)}.{d(3)}", ".".join(d(1) for _ in range(6)), f"{d(3)}.{d(3)}.{d(3)},{d(2)}", " ".join(d(r.randint(1, 3)) for _ in range(5)), f"{year} {year + 1}", f"{year}-{year + 9}", f"97{r.choice('89')}-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(4)}/{d(4)}", "-".join(d(5) for _ in range(3)), f"{d(2)}.{d(6)}", f"{d(1)}.{d(2)}.{d(4)}-{d(3)}",
    ])


def examples(held: list[tuple[str, int, int, int]], seeded: int = 1200, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Values and labels of the candidates in the contexts, as found and rewritten, and in seeded ones."""
    r = random.Random(seed)
    cues = {EMAIL: ["email", "contact", "mail:"], IP_: ["ip", "host", "server"], CARD_: ["card", "visa", "card no."], PHONE_: ["phone", "tel.", "call", "fax:"]}

    def word() -> str:
        return "".join(r.choice("abdeghilnorstuéü") for _ in range(r.randint(2, 8)))

    texts: list[tuple[str, list[tuple[int, int, int]]]] = []

    def put(before: str, spans: list[tuple[int, str]], after: str, between: str = " ") -> None:
        at, text, true = len(before), before, []
        for i, (kind, span) in enumerate(spans):
            text += (between if i else "") + span
            if kind >= 0:
                true.append((len(text) - len(span), kind, len(text)))
        assert at <= len(text)
        texts.append((text + after, true))

    for text, s, k, e in held:
        before, span, after = text[:s], text[s:e], text[e:]
        if k >= 0:
            put(before, [(k, span)], after)
            # another format only where its kind is named, as digits alone tell little
            told = before if CUES[KINDS[k]].search(before[-BEFORE:]) else before + r.choice(cues[k]) + " "
            put(told, [(k, rewritten(r, k, span))], after)
            if k in (CARD_, PHONE_):
                put(told, [(k, span), (-1, r.choice([f"{r.randint(1, 12):02}/{r.randint(20, 40)}", f"{r.randint(100, 999)}"]))], after)
                put(told, [(k, rewritten(r, k, span)), (k, rewritten(r, k, invented(r, k)))], after)
        else:
            texts.append((text, []))
            put(before, [(-1, wrong(r))], after)
    for _ in range(seeded):
        kind = r.randrange(4)
        span = invented(r, kind)
        cue = r.choice(cues[kind]) + " " if r.random() < 0.6 else ""
        before, after = " ".join(word() for _ in range(3)) + " ", r.choice([" ", ". ", ", ", "\n"]) + word()
        put(before + cue, [(kind, span)], after)
        told = before + r.choice(cues[kind]) + " "
        put(told, [(kind, rewritten(r, kind, span))], after)
        if kind in (CARD_, PHONE_):
            put(told, [(kind, span), (-1, f"{r.randint(1, 12):02}/{r.randint(20, 40)}")], after)
            put(told, [(kind, rewritten(r, kind, span)), (kind, rewritten(r, kind, invented(r, kind)))], after)
        put(before + r.choice(["", "", "version ", "no. ", "id ", "section ", "$", "order "]), [(-1, wrong(r))], after)
    joined = BREAK.join(text for text, _ in texts)
    begins = np.cumsum([0, *(len(text) + 1 for text, _ in texts)]).tolist()
    told = {(s + at, k, e + at) for at, (_, true) in zip(begins, texts, strict=False) for s, k, e in true} | set(base(joined))
    taken = bytearray(len(joined))
    for s, _, e in told:
        taken[s:e] = b"\1" * (e - s)
    own = proposals(joined)
    spans = list(zip(own.start.tolist(), own.kind.tolist(), own.end.tolist(), strict=True))
    true = np.array([x in told for x in spans])
    touches = np.array([taken.find(1, s, e) >= 0 for s, _, e in spans])
    known = touches | (own.values[:, NAMES.index("cue")] == 0)  # a cue, and no base span: not known
    return own.values[known], true[known].astype(float)


class Model:
    """Trees, the curve that calibrates them, and a threshold for each kind."""

    def __init__(self, held: list[tuple[str, int, int, int]], precision: float = 0.995, seed: int = 20):
        x, y = examples(held, seed=seed)
        order = np.random.default_rng(seed).permutation(len(y))
        x, y = x[order], y[order]
        half = len(y) // 2
        self.trees = Trees(x[:half], y[:half])
        margin, label = self.trees.margin(x[half:]), y[half:]
        # Platt's targets, a little inside 0 and 1, keep the curve finite where the halves agree wholly
        self.slope, self.constant = calibration(margin, np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / (len(label) - label.sum() + 2)))
        p, kinds = self.score(x[half:]), x[half:, 0]
        self.threshold = []
        for k in range(len(KINDS)):
            own, true = p[kinds == k], label[kinds == k]
            order = np.argsort(-own, kind="stable")
            good = np.cumsum(true[order]) / np.arange(1, len(own) + 1)
            ok = np.flatnonzero((good >= precision) & (own[order] >= 0.5))
            self.threshold.append(float(own[order][ok[-1]]) if len(ok) else 1.1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.constant, -500, 500)))

    def spans(self, text: str) -> list[tuple[int, int, int, float, bool, bool]]:
        """(start, kind, end, score, base, accepted) of all base spans and of the accepted candidates that touch none, nor each other; in order.

        A base span that no generator proposes, as one with hundreds of zeros, has score 0.
        """
        kept = base(text)
        given = {(s, k, e): 0.0 for s, k, e in kept}
        starts = np.array(sorted({s for s, _, _ in kept}), np.int64)
        likely: list[tuple[float, int, int, int]] = []
        for own in proposed(text):
            if not len(own):
                continue
            p = self.score(own.values)
            telling = np.flatnonzero((p >= np.array(self.threshold)[own.kind]) | np.isin(own.start, starts))
            for s, k, e, x in zip(*(c[telling].tolist() for c in (own.start, own.kind, own.end, p)), strict=True):
                if (s, k, e) in given:
                    given[s, k, e] = x
                elif x >= self.threshold[k]:
                    likely.append((-x, s, k, e))
        taken = bytearray(len(text)) if likely else b""
        if likely:
            for s, _, e in kept:
                taken[s:e] = b"\1" * (e - s)
        out = [(s, k, e, x, True, x >= self.threshold[k]) for (s, k, e), x in given.items()]
        for x, s, k, e in sorted(likely):
            if taken.find(1, s, e) < 0:
                taken[s:e] = b"\1" * (e - s)
                out.append((s, k, e, -x, False, True))
        return sorted(out)


def model(documents: DataFrame, fit_docs: int = 20_000, fit_spans: int = 2_000) -> Model:
    """The model learnt from contexts of the documents."""
    return Model(contexts(documents, fit_docs, fit_spans))


def spans_of(texts: list[str | None], boosted: Model) -> Iterator[list[tuple[int, int, int, float, bool, bool]]]:
    """The spans of each text; texts are scanned together, a break between them."""
    joined = BREAK.join(t or "" for t in texts)
    found = boosted.spans(joined)
    at = i = 0
    for t in texts:
        end, own = at + len(t or ""), []
        while i < len(found) and found[i][0] < end:
            s, k, e, *rest = found[i]
            own.append((s - at, k, e - at, *rest))
            i += 1
        yield own
        at = end + 1


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean,accepted:boolean>>"


def find(documents: DataFrame, boosted: Model | None = None) -> DataFrame:
    """doc_id, spans (kind, start, end, score, base, accepted) of every document."""
    sent = documents.sparkSession.sparkContext.broadcast(boosted or model(documents))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_()), ("accepted", pa.bool_())]))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            out = [[{"kind": KINDS[k], "start": s, "end": e, "score": p, "base": b, "accepted": a} for s, k, e, p, b, a in rows] for rows in spans_of(part.column("text").to_pylist(), sent.value)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(out, kind)], names=["doc_id", "spans"])

    return documents.select("doc_id", "text").mapInArrow(scan, f"doc_id bigint, spans {SPANS}")


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """Each span, or run of spans that overlap, replaced by the kind of its first in brackets."""
    out, done, reach = [], 0, 0
    for s, k, e in sorted(found):
        if s >= reach or not out:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = reach = max(reach, e)
    return "".join(out) + text[done:]


def redact(documents: DataFrame, boosted: Model | None = None) -> DataFrame:
    """The same rows and columns; the texts without personal data. Null texts stay null."""
    sent = documents.sparkSession.sparkContext.broadcast(boosted or model(documents))

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            texts = part.column("text").to_pylist()
            out = [redacted(t, [x[:3] for x in rows]) if rows else t for t, rows in zip(texts, spans_of(texts, sent.value), strict=True)]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    return documents.mapInArrow(clean, documents.schema)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans; then how many were added, and each span's score and whether the model accepts it, in the order of spans."""

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = tuple([] for _ in range(9))
            for spans in batch.column("spans").to_pylist():
                own = [x for x in spans if x["base"]]
                for x, k in zip(rows, KINDS, strict=False):
                    x.append(sum(s["kind"] == k for s in own))
                rows[4].append(hashlib.sha256(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in own).encode()).hexdigest())
                rows[5].append(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans))
                rows[6].append(len(spans) - len(own))
                rows[7].append(",".join(f"{s['score']:.4f}" for s in spans))
                rows[8].append(",".join("01"[s["accepted"]] for s in spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows, kinds)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "scores", "accepted"])

    return found.mapInArrow(tell, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, scores string, accepted string")


def op2_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents: counts and digest of base spans, all spans, the model's scores and verdicts. Odd rows as in the module's text."""
    return digests(find(shared.table(spark, sf_dir, "documents")))
