"""Marked-up texts: lossless tokens of XML, decisions in it, conversion, and the review markup."""

from __future__ import annotations

import re
import xml.etree.ElementTree as E
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

TEI = "http://www.tei-c.org/ns/1.0"
#: Elements that hold running text; the rest of the inline ones are atoms of one token.
CONTAINERS = frozenset("p head l lg ab item note q quote emph hi label cell sp speaker div list row table".split())
SPLIT = re.compile(r"\s+|[^\W_]+(?:['’][^\W_]+)*|[^\w\s]|_")


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


@dataclass
class Token:
    """kind: word, space, punct, open, close or atom; text is exactly what it stood for."""

    kind: str
    text: str
    path: tuple[str, ...]
    orig: str | None = None
    regs: list[dict] = field(default_factory=list)
    in_note: bool = False


def _kind(text: str) -> str:
    return "space" if text.isspace() else "word" if re.match(r"\w", text) else "punct"


def _start(el: E.Element) -> str:
    return f"<{local(el.tag)}" + "".join(f' {local(k)}="{_quoted(v)}"' for k, v in el.attrib.items()) + ">"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(text: str) -> str:
    return _escaped(text).replace('"', "&quot;")


def source_of(el: E.Element) -> str:
    """An element as text, without namespaces."""
    return _start(el) + _escaped(el.text or "") + "".join(source_of(k) + _escaped(k.tail or "") for k in el) + f"</{local(el.tag)}>"


def tokenised(el: E.Element, path: tuple[str, ...] = (), in_note: bool = False) -> Iterator[Token]:
    """Every character and element in exactly one token, in document order."""
    name = local(el.tag)
    if name == "choice":
        orig = next(("".join(k.itertext()) for k in el if local(k.tag) in ("orig", "abbr", "sic")), "")
        regs = [{"text": "".join(k.itertext()), "resp": k.get("resp"), "type": k.get("type")} for k in el if local(k.tag) in ("reg", "corr", "expan")]
        yield Token("word", source_of(el), path, orig, regs, in_note)
        return
    if name not in CONTAINERS and path:
        yield Token("atom", source_of(el), path, in_note=in_note)
        return
    here, note = (*path, name), in_note or name == "note"
    yield Token("open", _start(el), here, in_note=note)
    for text, kid in [(el.text, None), *[(k.tail, k) for k in el]]:
        if kid is not None:
            yield from tokenised(kid, here, note)
        for part in SPLIT.findall(text or ""):
            yield Token(_kind(part), part if part.isalnum() or part == " " else _escaped(part), here, in_note=note)
    yield Token("close", f"</{name}>", here, in_note=note)


def rebuilt(tokens: Iterable[Token]) -> str:
    return "".join(t.text for t in tokens)


def reading(token: Token, layer: str = "reg", machine_only: bool = False) -> str:
    """The text of a token in a layer: the editor's reading, else the first, else what is printed."""
    if token.kind in ("open", "close", "atom"):
        return ""
    plain = token.orig if token.orig is not None else E.fromstring(f"<x>{token.text}</x>").text if re.search("[&<\r]", token.text) else token.text
    if layer == "orig" or not token.regs:
        return plain or ""
    wanted = "#auto" if machine_only else "#editor"
    chosen = next((r for r in token.regs if r["resp"] == wanted), None if machine_only else token.regs[0])
    return chosen["text"] if chosen else plain or ""


def layer_text(xml: str, layer: str = "reg", notes: bool = False, machine_only: bool = False) -> str:
    out = [reading(t, layer, machine_only) if t.kind not in ("open", "close") else "\n" if t.kind == "close" and t.path[-1] in ("p", "head", "l") else "" for t in tokenised(E.fromstring(xml)) if notes or not t.in_note]
    return "".join(out).strip()


def choice_xml(orig: str, regs: list[dict]) -> str:
    """A decision as markup."""
    inner = "".join("<reg" + "".join(f' {k}="{_quoted(r[k])}"' for k in ("resp", "type") if r.get(k)) + f">{_escaped(r['text'])}</reg>" for r in regs)
    return f"<choice><orig>{_escaped(orig)}</orig>{inner}</choice>"


def over_texts(rows: DataFrame, key: str, column: str, make: Callable[[str], Iterable[dict]], schema: pa.Schema, ddl: str) -> DataFrame:
    """key and the rows that make(text) gives, a text at a time."""
    full = pa.schema([(key, pa.int64()), *schema])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist([{key: k} | r for r in make(text or "")], full)

    return rows.select(key, column).mapInArrow(run, f"{key} bigint, {ddl}")


REG = pa.list_(pa.struct([("text", pa.string()), ("resp", pa.string()), ("type", pa.string())]))


def xml_tokens(documents: DataFrame, key: str = "doc_id", column: str = "xml") -> DataFrame:
    """key, tok_id, kind, text, orig, regs, path, in_note. A text that isn't well formed is one token of kind 'error'."""
    def make(xml: str) -> Iterator[dict]:
        try:
            root = E.fromstring(xml)
        except E.ParseError:
            yield {"tok_id": 0, "kind": "error", "text": xml, "orig": None, "regs": [], "path": [], "in_note": False}
            return
        for i, t in enumerate(tokenised(root)):
            yield {"tok_id": i, "kind": t.kind, "text": t.text, "orig": t.orig, "regs": t.regs, "path": list(t.path), "in_note": t.in_note}

    schema = pa.schema([("tok_id", pa.int64()), ("kind", pa.string()), ("text", pa.string()), ("orig", pa.string()), ("regs", REG), ("path", pa.list_(pa.string())), ("in_note", pa.bool_())])
    return over_texts(documents, key, column, make, schema, "tok_id bigint, kind string, text string, orig string, regs array<struct<text:string,resp:string,type:string>>, path array<string>, in_note boolean")


#: Elements of the theological markup, and the encoding initiative's for them.
THML = {"p": "p", "h1": "head", "h2": "head", "h3": "head", "h4": "head", "i": "emph", "em": "emph", "b": "hi", "note": "note", "ul": "list", "ol": "list", "li": "item", "table": "table", "tr": "row", "td": "cell", "th": "cell", "verse": "lg", "l": "l", "blockquote": "quote", "scripRef": "ref", "br": "lb", "hr": "milestone", "pb": "pb"}


def thml_to_tei(xml: str) -> str:
    """divN become typed divisions with their titles as heads; other elements by the table; unknown ones leave their content. Number cells and speakers keep their place."""
    def convert(el: E.Element) -> str:
        name = local(el.tag)
        inner = _escaped(el.text or "") + "".join(convert(k) + _escaped(k.tail or "") for k in el)
        if re.fullmatch(r"div[1-6]", name):
            title = el.get("title")
            typed = (el.get("type") or "section").lower()
            head = f"<head>{_escaped(title)}</head>" if title and not any(local(k.tag) in ("h1", "h2", "h3", "h4") for k in el) else ""
            return f'<div type="{_quoted(typed)}">{head}{inner}</div>'
        if name in ("ThML", "ThML.body"):
            return inner
        if name == "ThML.head":
            return ""
        if name == "p" and "speaker" in (el.get("class") or ""):
            return f"<speaker>{inner}</speaker>"
        if name in THML:
            kind = ' rend="bold"' if name == "b" else ' type="ordered"' if name == "ol" else ' role="label"' if name == "th" else f' n="{_quoted(el.get("n"))}"' if name == "note" and el.get("n") else ""
            return f"<{THML[name]}{kind}>{inner}</{THML[name]}>" if inner else f"<{THML[name]}{kind}/>"
        return inner

    return f"<text><body>{convert(E.fromstring(xml))}</body></text>"


def closing(text: str, at: int) -> int | None:
    """Where the bracket that opens at a place closes; a backslash takes the next sign's meaning."""
    depth = 0
    i = at
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 1
        elif c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if not depth:
                return i
        i += 1
    return None


CALL = re.compile(r"#(footnote|emph|smallcaps|strong|super|pad)(?:\([^()]*\))?\[")


@dataclass
class Review:
    """The reviewed text: tokens (text, kind w or m, italic), notes apart with their anchors, headings, list items and levels by token place."""

    body: list[tuple[str, str, bool]] = field(default_factory=list)
    notes: list[tuple[int, str]] = field(default_factory=list)
    headings: list[tuple[int, int, str]] = field(default_factory=list)
    items: list[tuple[int, int, bool]] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)


def _inline(text: str, out: Review, italic: bool) -> None:
    i = 0
    while i < len(text):
        m = CALL.search(text, i)
        stop = m.start() if m else len(text)
        plain = re.sub(r"\\(.)", r"\1", text[i:stop])
        out.body += [(w, "w", italic) for w in re.findall(r"[^\W_]+(?:['’][^\W_]+)*|[^\w\s]", plain)]
        if not m:
            return
        end = closing(text, m.end() - 1)
        inner = text[m.end() : end if end is not None else len(text)]
        if m.group(1) == "footnote":
            out.notes.append((len(out.body), inner))
        else:
            _inline(inner, out, italic != (m.group(1) == "emph"))
        i = len(text) if end is None else end + 1


def parse_review(text: str, em_level: Callable[[float], int] = lambda em: int(em / 2) if em <= 6 else int(em - 3)) -> Review:
    """Headings, paragraphs, lists and set-in paragraphs of the review markup."""
    out = Review()
    for block in re.split(r"\n\s*\n", text.strip("\n")):
        if m := re.match(r"(=+)\s+(.*)", block, re.S):
            out.headings.append((len(out.body), len(m.group(1)), m.group(2).strip()))
            continue
        if re.match(r"\s*[+-] ", block):
            for line in block.split("\n"):
                if m := re.match(r"(\s*)([+-]) (.*)", line):
                    out.items.append((len(out.body), len(m.group(1)) // 2, m.group(2) == "+"))
                    out.body.append((m.group(2), "m", False))
                    _inline(m.group(3), out, False)
            continue
        level = 0
        if m := re.match(r"#pad\(left: ([\d.]+)em\)\[", block):
            level = em_level(float(m.group(1)))
            end = closing(block, m.end() - 1)
            block = block[m.end() : end if end is not None else len(block)]
        out.levels.append(level)
        out.body.append(("¶", "m", False))
        _inline(block, out, False)
    return out


def review_tokens(documents: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """key, pos, kind, text, italic."""
    def make(text: str) -> Iterator[dict]:
        for i, (w, kind, italic) in enumerate(parse_review(text).body):
            yield {"pos": i, "kind": kind, "text": w, "italic": italic}

    return over_texts(documents, key, column, make, pa.schema([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("italic", pa.bool_())]), "pos int, kind string, text string, italic boolean")


def table_grid(rows: list[list[tuple[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(cell, row, column, rowspan, colspan) of cells given as (rowspan, colspan) by row; a cell takes the first free columns."""
    taken: set[tuple[int, int]] = set()
    out, n = [], 0
    for r, cells in enumerate(rows):
        c = 0
        for down, right in cells:
            while (r, c) in taken:
                c += 1
            taken |= {(r + i, c + j) for i in range(down) for j in range(right)}
            out.append((n, r, c, down, right))
            n, c = n + 1, c + right
    return out


def block_changes(source: list[str], target: list[str], words: str = "") -> str | None:
    """What a change of block marks (¶ + - > H) between two words is: None if it is none, 'unresolved' if no kind fits."""
    if source == target:
        return None
    s, t = "".join(source), "".join(target)
    kinds = {("", "¶"): "split", ("¶", ""): "merge", ("", "+"): "list", ("", "-"): "list", ("¶", "+"): "list", ("¶", "-"): "list", ("+", "¶"): "unlist", ("-", "¶"): "unlist", ("+", "-"): "renumber", ("-", "+"): "renumber", ("¶", ">"): "quote", ("", ">"): "quote", (">", "¶"): "unquote", (">", ""): "unquote", ("¶", "H"): "headsplit", ("H", "¶"): "inline", ("H", ""): "headmerge", ("+", ""): "merge", ("-", ""): "merge"}
    return kinds.get((s, t), "unresolved")
