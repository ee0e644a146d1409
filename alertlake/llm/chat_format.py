"""Chat formatting: a finite-state machine over roles, and text segments from a declarative template.

Everything is a DataFrame expression. A conversation is one training example, so its turns come together
in one row; there the machine is folded over the roles, and each turn becomes three segments: the mark that
opens it, its escaped text, the mark that closes it. Only the text of a role with ``loss`` counts for the loss.

Control strings inside texts and role names are escaped: a backslash is doubled, and one more is set behind
the first character of each control string, so that none is left. ``Template`` refuses control strings
that could also arise where a mark meets a text. ``read_back`` cuts the formatted string at the marks alone.

Defined results: null texts and roles are empty; rows of one turn are ordered by role, then text; a null
turn comes first; null ids are one conversation. Roles the template does not know keep their name inside the
mark. Conversations that break the turn order are formatted too: ``valid`` is false, ``bad_turn`` is the place
of the first turn the machine does not take (null if only the end is missing). Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake.llm.common import fresh, read

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """Marks of a role: control strings, each with plain text beside it."""

    opens: str
    closes: str
    loss: bool = False
    open_pad: str = ""
    close_pad: str = ""

    @property
    def opening(self) -> str:
        return self.opens + self.open_pad

    @property
    def closing(self) -> str:
        return self.close_pad + self.closes


@dataclass(frozen=True)
class Template:
    """Marks by role, those of any other role (its name stands before ``name_end``), and the turn order."""

    roles: Mapping[str, Turn]
    other: Turn
    name_end: str
    order: Mapping[str, Mapping[str, str]]
    start: str
    ends: frozenset[str]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        turns = [*self.roles.values(), self.other]
        found = [x for t in turns for x in (t.opens, t.closes)] + [self.name_end]
        if len(set(found)) != len(found) or any(not x or ESCAPE in x for x in found):
            raise ValueError("control strings have to differ, not be empty and hold no backslash")
        if "" in self.order or "" in (b for steps in self.order.values() for b in steps.values()):
            raise ValueError("a state has to have a name")
        for one in found:
            for two in found:
                for k in range(0 if one != two else 1, len(one)):
                    tail = one[k:]
                    if two.startswith(tail) or tail.startswith(two):
                        raise ValueError(f"{one!r} may run into {two!r}")
        object.__setattr__(self, "controls", tuple(found))


#: Marks in the manner of public instruction formats; the machine asks for system?, then (user, assistant)+.
DEFAULT = Template(
    roles={
        "system": Turn("<<SYS>>", "<</SYS>>", open_pad="\n", close_pad="\n"),
        "user": Turn("[INST]", "[/INST]", open_pad=" ", close_pad=" "),
        "assistant": Turn("<s>", "</s>", loss=True, open_pad=" ", close_pad=" "),
    },
    other=Turn("[TURN]", "[/TURN]", open_pad=" ", close_pad=" "),
    name_end="[:]",
    order={
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="start",
    ends=frozenset({"answered"}),
)


def _any_of(strings) -> str:
    return "|".join(re.escape(x) for x in strings)


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """``text`` without any control string; ``unescape`` undoes it."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, rf"(?=(?:{_any_of(template.controls)}))(.)", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _fold(turns: Column, template: Template) -> Column:
    """(state, bad): the machine's state after the turns, empty once a turn is refused, and that turn's place."""
    pairs = [F.lit(x) for a, steps in template.order.items() for r, b in steps.items() for x in (f"{a} {r}", b)]
    table = F.create_map(*pairs)
    start = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("bad")
    )

    def step(a: Column, turn: Column) -> Column:
        step = F.coalesce(F.element_at(table, F.concat_ws(" ", a["state"], turn["role"])), F.lit(""))
        state = F.when(a["bad"].isNull(), step).otherwise(F.lit(""))
        bad = F.coalesce(a["bad"], F.when(state == "", a["place"]))
        return F.struct(state.alias("state"), (a["place"] + 1).alias("place"), bad.alias("bad"))

    return F.aggregate(turns, start, step)


def _segments(turn: Column, template: Template) -> Column:
    """The three segments of a turn."""
    segment = lambda text, loss: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    text = escape(turn["text"], template)

    def of(marks: Turn, opening: Column) -> Column:
        return F.array(segment(opening, False), segment(text, marks.loss), segment(F.lit(marks.closing), False))

    named = F.concat(
        F.lit(template.other.opens), escape(turn["role"], template), F.lit(template.name_end + template.other.open_pad)
    )
    made = of(template.other, named)
    for role, marks in template.roles.items():
        made = F.when(turn["role"] == role, of(marks, F.lit(marks.opening))).otherwise(made)
    return made


def formatted(
    rows: DataFrame,
    template: Template = DEFAULT,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_turns, segments, formatted, valid, bad_turn): a row for each conversation.

    ``segments`` holds (text, loss) in order; ``formatted`` is their texts joined.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    one = F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    together = rows.select(F.col(conv_col).alias("id"), one.alias("t")).groupBy("id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )
    machine = together.select(
        "id",
        F.size("turns").alias("n_turns"),
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        _fold(F.col("turns"), template).alias("end"),
    )
    return machine.select(
        "id",
        "n_turns",
        "segments",
        F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        F.col("end.state").isin(*sorted(template.ends)).alias("valid"),
        F.col("end.bad").alias("bad_turn"),
    )


def read_back(text: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) of a formatted string, cut at its marks and unescaped."""
    every = [*template.roles.values(), template.other]
    opens, closes = _any_of(t.opens for t in every), _any_of(t.closes for t in every)
    turns = F.regexp_extract_all(text, F.lit(rf"(?s)(?:{opens}).*?(?:{closes})"), F.lit(0))

    def turn(role: Column, body: Column) -> Column:
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    def between(x: Column, head: str, tail: str) -> Column:
        return F.substring(x, F.lit(len(head) + 1), F.length(x) - len(head) - len(tail))

    def parsed(x: Column) -> Column:
        other = template.other
        name = between(F.substring_index(x, template.name_end, 1), other.opens, "")
        head = F.length(name) + len(other.opens) + len(template.name_end + other.open_pad)
        body = F.substring(x, head + 1, F.length(x) - head - len(other.closing))
        made = turn(unescape(name), body)
        for role, marks in template.roles.items():
            made = F.when(
                F.startswith(x, F.lit(marks.opens)), turn(F.lit(role), between(x, marks.opening, marks.closing))
            ).otherwise(made)
        return made

    return F.transform(turns, parsed)


#: The conversation that the query adds.
ADDED_ID, ADDED_TEXT = -1, "</s>[INST] ok [/INST]"


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    made = formatted(rows).unionByName(formatted(added))
    back = made.select(
        "*",
        read_back(F.col("formatted")).alias("turns"),
        F.concat_ws(
            "", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
        ).alias("learnt"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def sql(template: Template = DEFAULT) -> str:
    """DuckDB SQL for ``report``: lengths of escaped texts and marks, and the default order as a pattern."""
    escaped = "replace({}, '\\', '\\\\')"
    for x in template.controls:
        escaped = f"replace({escaped}, '{x}', '{x[0]}\\{x[1:]}')"
    cases = " ".join(
        f"WHEN '{r}' THEN {len(m.opening + m.closing)}" for r, m in template.roles.items()
    )
    other = len(template.other.opening + template.name_end + template.other.closing)
    learnt = ", ".join(f"'{r}'" for r, m in template.roles.items() if m.loss)
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 0 AS added FROM conversations
  UNION ALL SELECT {ADDED_ID}, 0, 'user', '{ADDED_TEXT}', 1
  UNION ALL SELECT {ADDED_ID}, 1, 'assistant', '{ADDED_TEXT}', 1),
marked AS (
  SELECT *, length({escaped.format("text")})
    + CASE role {cases} ELSE {other} + length({escaped.format("role")}) END AS n,
    CASE WHEN role IN ({learnt}) THEN text ELSE '' END AS learnt,
    CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS letter
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(length(learnt)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learnt, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(letter, '' ORDER BY turn NULLS FIRST, role, text), 's?(ua)+') AS valid
FROM marked GROUP BY conv_id, added
"""
