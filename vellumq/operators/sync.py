"""A source text and its reviewed reading, brought together: decisions inside the source, and the checks that nothing was lost.

Each pair of a source and a review is one row, handled within an Arrow batch: the source is tokenised without loss, the machine's reading made, the review
aligned word by word, each difference classified and written into the source, and the result read back.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as E
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumq.operators import align as A
from vellumq.operators import markup as M
from vellumq.operators.graph import dealt

VOWELS = "aeiouy"


@lru_cache(1 << 18)
def machine(word: str) -> str:
    """The unambiguous letterform rules, with the printed word's capitals."""
    w = word.lower()
    if not re.fullmatch("[a-z]+", w):
        return word
    w = re.sub("^v(?=[bcdfghjklmnpqrstwxz])", "u", w)
    w = re.sub(f"(?<=[{VOWELS}])u(?=[{VOWELS}])", "v", w)
    w = re.sub("^i(?=[aeou])", "j", w)
    w = w[:-1] if w.endswith("sse") and len(w) > 4 else w[:-2] + "y" if w.endswith("ie") and len(w) > 3 else w
    return w.upper() if word.isupper() and len(word) > 1 else w[:1].upper() + w[1:] if word[:1].isupper() else w


def kind_of(old: str, new: str) -> str:
    """The type of a decision."""
    if not new:
        return "omission"
    if A.restyled(old, new):
        return "reference"
    if old.replace(" ", "").lower() == new.replace(" ", "").lower() and old.lower() != new.lower():
        return "spacing"
    return A.decision_class(old, new)


@dataclass
class Decision:
    at: int  # of the source's words
    orig: str
    auto: str | None
    editor: str | None
    type: str


def spread(source: list[str], target: list[str]) -> list[str]:
    """The target words of a cluster, given to its source words: those that are alike keep each other in order, the rest go to the word before them, or to the first. A source word without any is left out."""
    owner = [0] * len(target)
    at = 0
    lowered = [w.lower() for w in source]
    for j, word in enumerate(w.lower() for w in target):
        best, where = 0.0, at
        for i in range(at, len(lowered)):
            if lowered[i] == word and len(word) < 200:  # of longer ones the library leaves common letters out
                where = i
                break
            bound = A.at_most(lowered[i], word)
            if bound >= 0.5 and bound > best and (now := A.word_ratio(lowered[i], word)) >= 0.5 and now > best:
                best, where = now, i
        at = where
        owner[j] = min(at, len(source) - 1)
    readings: list[list[str]] = [[] for _ in source]
    for w, o in zip(target, owner, strict=True):
        readings[o].append(w)
    return [" ".join(words) for words in readings]


def compared(source: list[str], target: list[str]) -> list[tuple[str, int, int, int, int]]:
    return A.opcodes([machine(w).lower() for w in source], [w.lower() for w in target])


def decided(source: list[str], target: list[str], found: list[tuple[str, int, int, int, int]] | None = None) -> list[Decision]:
    """Decisions that make the source's words read as the target's. Words that the target adds belong to the word before. found: their opcodes, if they are known."""
    readings: list[str] = list(source)
    for op, i1, i2, j1, j2 in compared(source, target) if found is None else found:
        if op == "equal":
            readings[i1:i2] = target[j1:j2]
        elif op == "insert":
            added = " ".join(target[j1:j2])
            if i1:
                readings[i1 - 1] = f"{readings[i1 - 1]} {added}".strip()
        else:
            readings[i1:i2] = spread(source[i1:i2], target[j1:j2]) if op == "replace" else [""] * (i2 - i1)
    out = []
    for i, (orig, reading) in enumerate(zip(source, readings, strict=True)):
        auto = machine(orig)
        if reading == orig and auto == orig:
            continue
        editor = reading if reading != auto else None
        out.append(Decision(i, orig, auto if auto != orig else None, editor, kind_of(orig, reading)))
    return out


@lru_cache(2)
def _tokens(xml: str) -> tuple[M.Token, ...]:
    """A source and what came of it are read several times each."""
    return tuple(M.tokenised(E.fromstring(xml)))


@lru_cache(1)
def _reviewed(review: str) -> tuple[str, ...]:
    """The words of a review."""
    return tuple(w for w, kind, _ in M.parse_review(review).body if kind == "w" and re.match(r"\w", w))


def synced(xml: str, review: str) -> tuple[str, list[Decision]]:
    """The source with its decisions, and these. Notes stay as they are."""
    tokens = _tokens(xml)
    places = [i for i, t in enumerate(tokens) if t.kind == "word" and not t.in_note]
    source = [M.reading(tokens[i], "orig") for i in places]
    target = list(_reviewed(review))
    lead: list[str] = []
    # words that the review adds before the first word are given to it, in front
    found: list | None = compared(source, target)
    if found and found[0][0] == "insert" and source:
        lead = target[: found[0][4]]
        target, found = target[found[0][4] :], None
    decisions = decided(source, target, found)
    if lead:
        old = decisions[0] if decisions and decisions[0].at == 0 else Decision(0, source[0], None, None, "emendation")
        own = old.editor if old.editor is not None else old.auto or source[0]
        decisions = [Decision(0, source[0], old.auto, " ".join([*lead, own]).strip(), "emendation"), *[d for d in decisions if d.at]]
    by = {places[d.at]: d for d in decisions}
    out = []
    for i, t in enumerate(tokens):
        if d := by.get(i):
            regs = [{"text": d.auto, "resp": "#auto", "type": None if d.editor is not None else d.type}] if d.auto is not None else []
            regs += [{"text": d.editor, "resp": "#editor", "type": d.type}] if d.editor is not None else []
            out.append(M.choice_xml(d.orig, regs))
        elif t.regs and t.kind == "word" and not t.in_note:
            out.append(M._escaped(M.reading(t, "orig")))  # an older decision that the review takes back
        else:
            out.append(t.text)
    return "".join(out), decisions


def words_of(xml: str, layer: str) -> list[str]:
    """Words of a layer's text, without notes."""
    found = []
    for t in _tokens(xml):
        if t.kind == "word" and not t.in_note:
            chosen = next((r for r in t.regs if r["resp"] == "#editor"), t.regs[0] if t.regs else None) if layer == "reg" else None
            found += re.findall(r"\w+(?:['’]\w+)*", chosen["text"] if chosen else M.reading(t, "orig"))
    return found


def checks(xml: str, review: str, out: str) -> dict[str, bool]:
    """What must hold of a synced text."""
    target = _reviewed(review)
    return {
        "reads as reviewed": words_of(out, "reg") == [x for w in target for x in re.findall(r"\w+(?:['’]\w+)*", w)],
        "printed words kept": words_of(out, "orig") == words_of(xml, "orig"),
        "synced again stays": synced(out, review)[0] == out,
    }


def as_xml(text: str) -> str:
    return "<div>" + "".join(f"<p>{M._escaped(line)}</p>" for line in text.split("\n")) + "</div>"


SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("xml", pa.string()), ("decisions", pa.list_(pa.struct([("at", pa.int64()), ("orig", pa.string()), ("auto", pa.string()), ("editor", pa.string()), ("type", pa.string())]))), ("failed", pa.list_(pa.string()))])


def sync(pairs: DataFrame) -> DataFrame:
    """a, b, xml, decisions, failed (names of checks that don't hold); pairs: a, b, xml, review. Texts that aren't well formed fail as such."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                xml, review = r["xml"] or "", r["review"] or ""
                row = {"a": r["a"], "b": r["b"]}
                try:
                    out, found = synced(xml, review)
                    failed = [k for k, ok in checks(xml, review, out).items() if not ok]
                    row |= {"xml": out, "decisions": [vars(d) for d in found], "failed": failed}
                except E.ParseError:
                    row |= {"xml": xml, "decisions": [], "failed": ["well formed"]}
                yield pa.RecordBatch.from_pylist([row], SCHEMA)

    return dealt(pairs.select("a", "b", "xml", "review"), "a", "b").mapInArrow(run, "a bigint, b bigint, xml string, decisions array<struct<at:bigint,orig:string,auto:string,editor:string,type:string>>, failed array<string>")


def structure(pairs: DataFrame) -> DataFrame:
    """a, b, at, kind, word: changes of block marks between aligned words; pairs: a, b, text_a, text_b, both in the review markup."""
    def marked(text: str) -> tuple[list[str], list[list[str]]]:
        body = M.parse_review(text).body
        heads = {at for at, _, _ in M.parse_review(text).headings}
        words, marks, now = [], [], []
        for i, (w, kind, _) in enumerate(body):
            if i in heads:
                now.append("H")
            if kind == "m":
                now.append(w)
            elif re.match(r"\w", w):
                words.append(w)
                marks.append(now)
                now = []
        return words, marks

    def make(x: str, y: str) -> Iterator[tuple]:
        (wa, ma), (wb, mb) = marked(x), marked(y)
        for op, i1, i2, j1, _ in A.opcodes([w.lower() for w in wa], [w.lower() for w in wb]):
            if op == "equal":
                for k in range(i2 - i1):
                    if kind := M.block_changes(ma[i1 + k], mb[j1 + k]):
                        yield i1 + k, kind, wa[i1 + k]

    return A.over_pairs(pairs, make, "at int, kind string, word string", [("at", pa.int32()), ("kind", pa.string()), ("word", pa.string())])


def facets(pairs: DataFrame) -> DataFrame:
    """a, b, facet, same: whether two chapters have the same words, italics, notes, headings and lists."""
    def make(x: str, y: str) -> Iterator[tuple]:
        p, q = M.parse_review(x), M.parse_review(y)
        for name, one in (("words", lambda r: [w for w, k, _ in r.body if k == "w"]), ("italics", lambda r: [i for _, k, i in r.body if k == "w"]), ("notes", lambda r: [t for _, t in r.notes]), ("headings", lambda r: [t for _, _, t in r.headings]), ("lists", lambda r: [d for _, d, _ in r.items])):
            yield name, one(p) == one(q)

    return A.over_pairs(pairs, make, "facet string, same boolean", [("facet", pa.string()), ("same", pa.bool_())])


def once(texts: DataFrame, phrases: list[str], key: str = "doc_id") -> DataFrame:
    """phrase, n: how often each phrase of a settings list stands in all texts, white space being any; phrases that don't stand exactly once need a look."""
    if len(phrases) > 1000:
        raise ValueError("a settings list has 1,000 phrases at most")
    counts = F.array(*[F.struct(F.lit(p).alias("phrase"), F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(flexible(p)), F.lit(0))).alias("n")) for p in phrases])
    return texts.select(F.explode(counts).alias("x")).groupBy("x.phrase").agg(F.sum("x.n").alias("n"))


def flexible(phrase: str) -> str:
    """A pattern of the phrase for Java, white space being any."""
    return r"\s+".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in phrase.split())


def partners(rows: DataFrame, group: str, order: str, key: str) -> DataFrame:
    """Each row with its neighbours' keys."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(order)
    return rows.withColumn("before", F.lag(key).over(w)).withColumn("after", F.lead(key).over(w))


def signature(text: str) -> tuple[str, str]:
    """A closing and the name under it: 'Your servant, J. O.' as ('Your servant,', 'J. O.'). Without a name the second is empty."""
    m = re.match(r"(?s)(.*?[,.;])\s+((?:[A-Z]\.\s?)+|[A-Z][A-Z. ]+)\s*$", text.strip())
    return (m.group(1).strip(), m.group(2).strip()) if m else (text.strip(), "")
