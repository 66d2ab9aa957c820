"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template.

Only DataFrame functions. Turns are handled in chunks of neighbouring turns: each chunk becomes an array of
segments and a transition function (for each state the machine may be in before the chunk: the state after it, and the first turn that
has no move). A conversation's verdict, whether its turns are in order and which is the first that isn't, is the composition of its
chunks' functions, so that one conversation with a third of all rows is chunks in many tasks until the digest, which by its
definition needs the whole conversation in one row.

Template (``Template``): what stands before and after each role's text, which roles carry loss, and the machine's states and
moves. Inside texts and roles the escape character goes before every character that begins a control string, and before itself, so that no
control string occurs there and ``unescape`` gives the text back.

Defined results: a null text or role is empty; an unknown role is written with the default marks and moves the machine to its error state; turns with the same
number are ordered by role, then text; null turns come first; repeated rows are repeated turns; a null conv_id is a conversation; empty tables give no rows;
extra columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared


@dataclass(frozen=True)
class Template:
    head: str = "### "
    after_role: str = ": "
    tail: str = " </turn>\n"
    escape: str = "\\"
    #: First characters of control strings, and what ends a role.
    marked: str = "#<:"
    loss: tuple[str, ...] = ("assistant",)
    start: str = "start"
    error: str = "error"
    #: (state, role) -> state
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"), ("start", "user", "user"), ("system", "user", "user"),
        ("user", "assistant", "assistant"), ("assistant", "user", "user"),
    )
    final: tuple[str, ...] = ("assistant",)

    @property
    def states(self) -> list[str]:
        return sorted({self.start, self.error, *(x for a, _, b in self.moves for x in (a, b))})

    def escaped(self, text: Column) -> Column:
        e = "\\" + self.escape
        return F.regexp_replace(text, f"([{e}{self.marked}])", f"{e}$1")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, f"(?s)\\{self.escape}(.)", "$1")

    def step(self, state: Column, role: Column) -> Column:
        """The machine's next state."""
        out = F.lit(self.error)
        for a, r, b in self.moves:
            out = F.when((state == a) & (role == r), b).otherwise(out)
        return out


def formatted(conversations: DataFrame, template: Template = Template(), chunk: int = 64) -> DataFrame:
    """Rows of chunks: conv_id, chunk, segments (text, loss), states (for each state before the chunk: the state after it, and the place of its first turn without a move, or null)."""
    t = template
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / chunk).cast("long"))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(x: Column) -> Column:
        loss = x["role"].isin(*t.loss)
        return F.array(
            F.struct(F.concat(F.lit(t.head), t.escaped(x["role"]), F.lit(t.after_role)).alias("text"), F.lit(False).alias("loss")),
            F.struct(t.escaped(x["text"]).alias("text"), loss.alias("loss")),
            F.struct(F.lit(t.tail).alias("text"), F.lit(False).alias("loss")),
        )

    def run(start: str) -> Column:
        begin = F.struct(F.lit(start).alias("state"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bad"))

        def move(now: Column, x: Column) -> Column:
            state = t.step(now["state"], x["role"])
            return F.struct(state.alias("state"), (now["n"] + 1).alias("n"), F.when(now["bad"].isNull() & (state == t.error), now["n"]).otherwise(now["bad"]).alias("bad"))

        return F.aggregate("turns", begin, move)

    after = F.array(*[run(s) for s in t.states])
    return chunks.select("conv_id", "chunk", F.flatten(F.transform("turns", segments)).alias("segments"), F.map_from_arrays(F.array(*map(F.lit, t.states)), after).alias("states"))


def read_back(segments: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that the concatenated segments say."""
    t = template
    whole = F.array_join(F.transform(segments, lambda x: x["text"]), "")
    turns = F.split(whole, f"\\Q{t.tail}\\E")
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        body = F.substring(x, F.lit(len(t.head) + 1), F.length(x))
        at = F.locate(t.after_role, F.regexp_replace(body, f"(?s)\\{t.escape}.", "__"))
        return F.struct(t.unescaped(F.substring(body, F.lit(1), at - 1)).alias("role"), t.unescaped(F.substring(body, at + len(t.after_role), F.length(body))).alias("text"))

    return F.transform(turns, turn)


def conversations_digest(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Read back from the formatted segments: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; and the machine's verdict: valid (the turns are in order and end in a final state), first_bad (the first turn, from 0, that the machine has no move for; null if none)."""
    t = template
    chunks = formatted(conversations, t)
    read = read_back(F.col("segments"), t)
    loss = F.array_join(F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: t.unescaped(x["text"])), "")
    names = F.array(*map(F.lit, t.states))
    parts = chunks.select(
        "conv_id", "chunk", F.transform(names, lambda s: F.col("states")[s]).alias("after"), loss.alias("loss"), read.alias("turns"),
        F.aggregate("segments", F.lit(0).cast("long"), lambda n, x: n + F.length(x["text"])).alias("chars"),
    ).select(
        "conv_id", "chunk", "after", "loss", "chars", F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("turns"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "turns", "loss", "after"))).alias("c"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("c", lambda x: x["loss"]), "")
    begin = F.struct(F.lit(t.start).alias("state"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bad"))

    def compose(now: Column, x: Column) -> Column:
        after = F.element_at(x["after"], F.array_position(names, now["state"]).cast("int"))
        return F.struct(after["state"].alias("state"), (now["n"] + after["n"]).alias("n"), F.coalesce(now["bad"], F.when(now["state"] != t.error, now["n"] + after["bad"])).alias("bad"))

    verdict = F.aggregate("c", begin, compose)
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("c", lambda x: x["turns"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", verdict.alias("verdict"),
    ).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", F.col("verdict.state").isin(*t.final).alias("valid"), F.col("verdict.bad").alias("first_bad"))


def op7_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted and read back, with the machine's verdict. Odd rows as in the module's text."""
    trap = "\\### Assistant: </turn> ok"
    rows = shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(trap).alias("text"))
    return conversations_digest(rows.unionByName(more))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
machine AS (  -- a letter for each turn; what is in order is a text of the form s?(ua)*
  SELECT conv_id, string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn NULLS FIRST, role, text) AS seen FROM rows GROUP BY conv_id),
verdicts AS (
  SELECT conv_id, regexp_full_match(seen, 's?(ua)+') AS valid, CASE WHEN length(regexp_extract(seen, '^s?(ua)*u?')) < length(seen) THEN length(regexp_extract(seen, '^s?(ua)*u?')) END AS first_bad FROM machine),
lengths AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\#<:]', '', 'g')) + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + 15 AS chars FROM rows)
SELECT lengths.conv_id AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '') FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, any_value(valid) AS valid, any_value(first_bad) AS first_bad
FROM lengths LEFT JOIN verdicts ON lengths.conv_id IS NOT DISTINCT FROM verdicts.conv_id GROUP BY lengths.conv_id
"""
