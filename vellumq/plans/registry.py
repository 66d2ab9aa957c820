"""All queries of the text-edition engine, and their oracles."""

from __future__ import annotations

from vellumq.plans import aligned, cited, editions, misc, named, pairs, planted, quoted, records, rewritten, selection, trees, webpages, words

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _part in (editions, words, selection, pairs, webpages, records, misc, aligned, trees, rewritten, cited, named, planted, quoted):
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
