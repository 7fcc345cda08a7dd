"""Chat formatting by a finite-state machine and a declarative template, in SQL functions.

A template names, for each role, the control strings around a turn, whether its text counts
for the loss, and the states in which it may come. Control strings inside texts get a
backslash after their first sign, one more than they have, which reading back takes off.
First signs occur nowhere else in a control string, so text next to one cannot make another.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    """How turns of one role are written; `after` lists the states it may follow."""

    opening: str
    closing: str
    loss: bool
    after: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """Roles by name. A state is the role of the turn before, at first "start".

    Turns of other roles are written between `other` with their role's name, have no loss and
    are not valid. A conversation is complete when it ends in one of the states `final`.
    """

    roles: dict[str, Role]
    other: tuple[str, str, str]
    final: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for role in self.roles.values() for m in (role.opening, role.closing)]
        object.__setattr__(self, "controls", tuple(dict.fromkeys([*marks, *self.other])))
        bare = [mark.strip() for mark in self.controls]
        firsts = {mark[0] for mark in bare}
        if any(set(mark[1:]) & firsts for mark in bare):
            raise ValueError("a control string holds the first sign of one after its start")
        if len(set(self.controls)) < len(marks) + len(self.other):
            raise ValueError("two control strings are the same")


INSTRUCT = Template(
    roles={
        "system": Role("[SYS] ", " [/SYS]", False, ("start",)),
        "user": Role("[INST] ", " [/INST]", False, ("start", "system", "assistant")),
        "assistant": Role("<s> ", " </s>", True, ("user",)),
    },
    other=("[ROLE] ", " [TURN] ", " [/TURN]"),
    final=("assistant",),
)


def _rests(template: Template) -> dict[str, str]:
    """For each first sign, a pattern of what may follow it in a control string."""
    found: dict[str, set[str]] = {}
    for mark in template.controls:
        found.setdefault(mark.strip()[0], set()).add(re.escape(mark.strip()[1:]))
    return {first: "|".join(sorted(rests)) for first, rests in sorted(found.items())}


def escaped(text: Column, template: Template = INSTRUCT) -> Column:
    for first, rests in _rests(template).items():
        text = F.regexp_replace(text, f"({re.escape(first)})(?=\\\\*(?:{rests}))", r"$1\\")
    return text


def unescaped(text: Column, template: Template = INSTRUCT) -> Column:
    for first, rests in _rests(template).items():
        text = F.regexp_replace(text, f"({re.escape(first)})\\\\(?=\\\\*(?:{rests}))", "$1")
    return text


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation, its turns in an array in order."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    given = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    grouped = given.withColumn("_alone", alone).groupBy("conv_id", "_alone")
    return grouped.agg(F.sort_array(F.collect_list("turn")).alias("turns")).drop("_alone")


def _segments(turn: Column, template: Template) -> Column:
    """The opening, the text and the closing of one turn, each with its loss flag."""

    def segment(text: Column | str, loss: bool) -> Column:
        value = F.lit(text) if isinstance(text, str) else text
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    head, middle, tail = template.other
    name = F.concat(F.lit(head), escaped(turn["role"], template), F.lit(middle))
    text = escaped(turn["text"], template)
    chosen = F.array(segment(name, False), segment(text, False), segment(tail, False))
    for name, role in template.roles.items():
        written = F.array(
            segment(role.opening, False), segment(text, role.loss), segment(role.closing, False)
        )
        chosen = F.when(turn["role"] == name, written).otherwise(chosen)
    return chosen


def _is_valid(turns: Column, template: Template) -> Column:
    """Run the machine over the roles: every step allowed, and the last state a final one."""

    def step(state: Column, turn: Column) -> Column:
        allowed = F.lit(False)
        for name, role in template.roles.items():
            allowed = F.when(turn["role"] == name, state["at"].isin(*role.after)).otherwise(allowed)
        return F.struct(turn["role"].alias("at"), (state["valid"] & allowed).alias("valid"))

    first = F.struct(F.lit("start").alias("at"), F.lit(True).alias("valid"))
    return F.aggregate(
        turns, first, step, lambda end: end["valid"] & end["at"].isin(*template.final)
    )


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), valid.

    Turns come by number, then role and text, so the order is fixed where numbers repeat; a
    repeated row is a turn of its own. Null numbers come first; a null role or text is empty.
    A row without a conv_id is a conversation of its own, so such rows, however many, are never
    gathered. `valid` says whether the machine accepts the
    order of roles; conversations it does not accept are formatted all the same. Other columns
    are not read; an empty table gives no rows. A conversation is one row here as it is in a
    training file, so the longest must fit into a task's memory.
    """
    turns = _turns(conversations)
    segments = F.flatten(F.transform("turns", lambda turn: _segments(turn, template)))
    return turns.select(
        "conv_id", segments.alias("segments"), _is_valid(F.col("turns"), template).alias("valid")
    )


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What the formatted text alone tells: its turns (role, text), and the texts with a loss.

    Adds `formatted`, the whole text, `turns` and `loss_texts`, all control strings taken out
    and texts as they were.
    """
    patterns = [
        f"{re.escape(o)}.*?{re.escape(c)}"
        for o, c in [
            *((role.opening, role.closing) for role in template.roles.values()),
            (template.other[0], template.other[2]),
        ]
    ]
    whole = F.array_join(F.col("segments.text"), "")
    written = formatted.withColumn("formatted", whole)
    chunks = F.regexp_extract_all("formatted", F.lit("(?s)" + "|".join(patterns)), F.lit(0))

    def inner(chunk: Column, opening: str, closing: str) -> Column:
        length = F.length(chunk) - F.lit(len(opening) + len(closing))
        return F.substring(chunk, F.lit(len(opening) + 1), length)

    def turn(role: Column, text: Column) -> Column:
        return F.struct(
            unescaped(role, template).alias("role"), unescaped(text, template).alias("text")
        )

    def parsed(chunk: Column) -> Column:
        head, middle, tail = template.other
        body = inner(chunk, head, tail)
        at = F.instr(body, middle)
        told = turn(
            F.substring(body, F.lit(1), at - 1),
            F.substring(body, at + F.lit(len(middle)), F.length(body)),
        )
        for name, role in template.roles.items():
            plain = turn(F.lit(name), inner(chunk, role.opening, role.closing))
            told = F.when(F.startswith(chunk, F.lit(role.opening)), plain).otherwise(told)
        return told

    learned = F.filter("segments", lambda segment: segment["loss"])
    texts = F.transform(learned, lambda segment: unescaped(segment["text"], template))
    return written.withColumns(
        {"turns": F.transform(chunks, parsed), "loss_texts": texts}
    )


# The results of `op6_chat_format`, worked out from the rows themselves.
SQL_TEXT = r"""
    WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    ordered AS (
      SELECT *, row_number() OVER w AS nr,
             lag(role) OVER w AS before, lead(role) OVER w IS NULL AS is_last,
             regexp_replace(regexp_replace(text,
               '(\[)(\\*(?:/?SYS\]|/?INST\]|ROLE\]|/?TURN\]))', '\1\\\2', 'g'),
               '(<)(\\*/?s>)', '\1\\\2', 'g') AS shown,
             regexp_replace(regexp_replace(role,
               '(\[)(\\*(?:/?SYS\]|/?INST\]|ROLE\]|/?TURN\]))', '\1\\\2', 'g'),
               '(<)(\\*/?s>)', '\1\\\2', 'g') AS shown_role
      FROM given
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
           cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), ''))
             AS loss_sha256,
           cast(sum(length(shown) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15
                    WHEN 'assistant' THEN 9 ELSE 24 + length(shown_role) END) AS bigint)
             AS formatted_chars,
           bool_and(CASE role WHEN 'system' THEN before IS NULL
                    WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                    WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END
                    AND (NOT is_last OR role = 'assistant')) AS valid
    FROM ordered GROUP BY conv_id"""
