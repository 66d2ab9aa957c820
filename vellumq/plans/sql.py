"""Pieces of DuckDB SQL that the oracles share."""

from __future__ import annotations

W = r"[\p{L}\p{N}_]"
WORD = rf"{W}+(?:[''’]{W}+)*"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def pairs(x: str) -> str:
    """Each pair of one letter as one."""
    for c in LETTERS:
        x = f"replace({x}, '{c}{c}', '{c}')"
    return x


def runs(x: str) -> str:
    """Each run of one letter as one."""
    for c in LETTERS:
        x = f"regexp_replace({x}, '{c}+', '{c}', 'g')"
    return x


def final_e(x: str) -> str:
    return f"(SELECT CASE WHEN length(q) > 3 AND right(q, 1) = 'e' THEN left(q, -1) ELSE q END FROM (SELECT {x} AS q))"


def loose(x: str) -> str:
    return final_e(pairs(f"translate(regexp_replace(replace(lower({x}), 'ſ', 's'), '[^a-z]', '', 'g'), 'vjy', 'uii')"))


def ocr(x: str) -> str:
    return final_e(runs(f"replace(translate(regexp_replace(translate(lower({x}), 'ſf', 'ss'), '[^a-z]', '', 'g'), 'vjy', 'uii'), 'w', 'uu')"))


def crop(x: str) -> str:
    x = f"regexp_replace(translate(lower({x}), 'ſf', 'ss'), '[^a-z0-9]', '', 'g')"
    x = pairs(x)
    for c in "0123456789":
        x = f"replace({x}, '{c}{c}', '{c}')"
    return x


#: tok(doc_id, lang, source, pos, word): the words of all documents.
TOK = f"""tok AS (SELECT doc_id, lang, source, i - 1 AS pos, w[i] AS word FROM (SELECT doc_id, lang, source, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents), unnest(range(1, len(w) + 1)) AS u(i))"""
#: sent(doc_id, lang, source, sent_no, s): sentences, as text, in order.
SENT = r"""sent AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS sent_no, x AS s FROM (SELECT doc_id, lang, source, i, p[i] AS x FROM (SELECT doc_id, lang, source, string_split(regexp_replace(coalesce(text, ''), '([.!?][”’"''\)\]]*)(\s+|$)', '\1' || chr(1), 'g'), chr(1)) AS p FROM documents), unnest(range(1, len(p) + 1)) AS u(i)) WHERE trim(x, chr(32) || chr(10) || chr(9) || chr(13)) <> '')"""
#: line(doc_id, lang, source, line_no, s): lines.
LINE = """line AS (SELECT doc_id, lang, source, i - 1 AS line_no, l[i] AS s FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS u(i))"""


def letterforms(x: str) -> str:
    """The letterform rules of a lower-case word."""
    v = f"CASE WHEN regexp_matches({x}, '^v[bcdfghjklmnpqrstwxz]') THEN 'u' || {x}[2:] ELSE {x} END"
    v = f"(SELECT list_aggregate(list_transform(range(1, length(q) + 1), lambda i: CASE WHEN q[i] = 'u' AND i > 1 AND i < length(q) AND contains('aeiouy', q[i-1]) AND contains('aeiouy', q[i+1]) THEN 'v' ELSE q[i] END), 'string_agg', '') FROM (SELECT {v} AS q))"
    j = f"(SELECT CASE WHEN regexp_matches(q2, '^i[aeou]') THEN 'j' || q2[2:] ELSE q2 END FROM (SELECT {v} AS q2))"
    return f"(SELECT CASE WHEN q3 LIKE '%sse' AND length(q3) > 4 THEN left(q3, -1) WHEN q3 LIKE '%ie' AND length(q3) > 3 THEN left(q3, -2) || 'y' ELSE q3 END FROM (SELECT {j} AS q3))"
