"""Many names at once in texts: one automaton of all forms, sent by a checked size, walks each batch of texts once.

A name stands between characters that are neither letters nor numbers (or a text's ends); of names that overlap the one that begins first is taken, of those that begin together the longest. A form of several
names is the least one's. Null texts hold none. The time is that of the texts' length and the matches, however many names there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("form", pa.string()), ("name", pa.string())])
#: Names with NUL can't be told from the mark between two texts of a batch.
BETWEEN = "\0"
#: Characters that the automaton walks at once: a batch's texts are cut into stretches of about so many, whole texts each.
STRETCH = 1 << 22


def variants(names: DataFrame) -> DataFrame:
    """form, name: each name (name) as it is and in capitals, with and without its blanks."""
    close = F.replace("name", F.lit(" "), F.lit(""))
    forms = F.array("name", F.upper("name"), close, F.upper(close))
    return names.select(F.explode(forms).alias("form"), "name").filter(F.col("form") != "").groupBy("form").agg(F.min("name").alias("name"))


def spans(text: str, automaton: ahocorasick.Automaton) -> Iterator[tuple[int, int, int]]:
    """(start, end, number of the form), in order, none overlapping."""
    met = []
    for last, (n, size) in automaton.iter(text):
        start, end = last + 1 - size, last + 1
        if not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum()):
            met.append((start, -end, n))
    done = 0
    for start, end, n in sorted(met):
        if start >= done:
            done = -end
            yield start, done, n


def stretches(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STRETCH:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def found(documents: DataFrame, forms: DataFrame, most: int = 200_000) -> DataFrame:
    """doc_id, start, end, form, name for each name in each text (doc_id, text). forms: form, name; more than ``most`` of them are refused, as every task holds their automaton (some 100 bytes a character)."""
    rows = forms.filter(~F.col("form").contains(BETWEEN)).groupBy("form").agg(F.min("name").alias("name")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most:,} forms")
    listed = [(r.form, r.name) for r in rows if r.form]
    sent = documents.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for n, (form, _) in enumerate(sent.value):
            automaton.add_word(form, (n, len(form)))
        automaton.make_automaton()
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in stretches(texts):
                starts = np.cumsum([0, *[len(t) + 1 for t in texts[a:b]]])
                met = np.array(list(spans(BETWEEN.join(texts[a:b]), automaton)) if listed else [], dtype=np.int64).reshape(-1, 3)
                own = np.searchsorted(starts, met[:, 0], "right") - 1
                told = [sent.value[n] for n in met[:, 2]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][own], pa.int64()), pa.array(met[:, 0] - starts[own], pa.int32()), pa.array(met[:, 1] - starts[own], pa.int32()), pa.array([f for f, _ in told], pa.string()), pa.array([m for _, m in told], pa.string())], schema=SCHEMA)

    held = documents.select("doc_id", "text").filter("text IS NOT NULL AND doc_id IS NOT NULL")
    return held.mapInArrow(run, "doc_id bigint, start int, end int, form string, name string")
