"""Conversation structure repair: weighted interval parsing of turns, bottom-up by span length.

A repaired conversation reads ``(s?(ua)+)?`` in the initials of its roles. The repair grammar is in Chomsky
normal form: a nonterminal N(p, q) stands for the edits of a span that take the conversation from state p to
state q; N(p, q) -> N(p, r) N(r, q) joins two spans, and N(p, q) -> row covers one row: kept, given another
role or deleted, after the insertions that lead there (their closure is folded into this rule). A cell
holds the least (cost, audit) for its span.

Since nonterminals are pairs of states, every derivation of a span passes some state at any place inside it:
all places to split a span give the same cell, and one is enough. So neighbouring spans of equal length are
joined, 1, 2, 4, ... rows, which takes a number of joins that grows with the rows and not with their cube.
Audits of spans of the same rows are never prefixes of one another, as each row ends with one letter that
is not an insertion; so the least audits of two spans make the least audit of both.

Rows are dealt by ranges of (conversation, turn), so that a long conversation is parsed by many tasks; what
leaves a task is one fragment for each conversation in it, and fragments are joined in the same way. Text stays
out of this: rows carry a digest of role and text. Repeated rows are counted before they are shuffled. With
the audit known, texts are read once more and edited in order, row by row.

Defined results: null roles and texts are empty; a null turn comes first; rows of one turn are ordered
by role, then by the digest; null ids are one conversation. Roles go by their first letter as it is. Gaps beyond 64 bits
count as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import read, slices

#: The states, and where a role's initial leads: nothing yet, system, user, assistant.
STATES = (0, 1, 2, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}  # what may be inserted or set
LEGAL = ("su", "ua", "au")
OK, TRUNCATED, REMOVE = 0, 1, 2
_LONG = (1 << 63) - 1

Cell = dict[tuple[int, int], tuple[int, str]]


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


@cache
def insertions() -> dict[tuple[int, int], int]:
    """Fewest insertions from state to state."""
    least = {(p, p): 0 for p in STATES}
    for _ in STATES:
        for (p, q), n in list(least.items()):
            for initial in ROLES:
                if (q, initial) in STEP:
                    to = p, STEP[q, initial]
                    least[to] = min(least.get(to, n + 1), n + 1)
    return least


@cache
def row_cell(initial: str, fault: int, costs: Costs) -> Cell:
    """Cells of one row: insertions, then its own edit."""
    edits = [(r, r, costs.delete, "D") for r in STATES]
    if fault != REMOVE:
        more = costs.truncated if fault == TRUNCATED else 0
        for (r, x), q in STEP.items():
            if x == initial:
                edits.append((r, q, more, "K"))
            if x in ROLES:
                edits.append((r, q, more + costs.rerole, "R"))
    cell: Cell = {}
    for (p, r), n in insertions().items():
        for start, q, cost, letter in edits:
            if start == r:
                found = (n * costs.insert + cost, "I" * n + letter)
                cell[p, q] = min(cell.get((p, q), found), found)
    return cell


def deleted(n: int, costs: Costs) -> Cell:
    """Cells of n rows that have to go."""
    cell = one = row_cell("", REMOVE, costs)
    for bit in bin(n)[3:]:
        cell = joined(cell, cell)
        if bit == "1":
            cell = joined(cell, one)
    return cell


def joined(left: Cell, right: Cell) -> Cell:
    """The rules N(p, q) -> N(p, r) N(r, q) for two neighbouring spans."""
    cell: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other is None:
                continue
            total, known = cost + other[0], cell.get((p, q))
            if known is None or total < known[0]:
                cell[p, q] = total, audit + other[1]
            elif total == known[0]:
                cell[p, q] = min(known, (total, audit + other[1]))
    return cell


class Spans:
    """Cells of a run of rows: neighbours of equal length are joined as soon as both are there."""

    def __init__(self):
        self.open: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.open and self.open[-1][0] == size:
            cell = joined(self.open.pop()[1], cell)
            size *= 2
        self.open.append((size, cell))

    def whole(self) -> Cell | None:
        cell = None
        for _, left in reversed(self.open):
            cell = left if cell is None else joined(left, cell)
        return cell


def cheapest(cell: Cell | None, costs: Costs) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, with the insertions behind its last row."""
    if cell is None:
        return 0, ""
    ends = []
    for (p, q), (cost, audit) in cell.items():
        if p == STATES[0]:
            more = min(n for (a, b), n in insertions().items() if a == q and b in ENDS)
            ends.append((cost + more * costs.insert, audit + "I" * more))
    return min(ends)


def edited(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the audit leaves or inserts."""
    letters, state = iter(audit), STATES[0]

    def made(letter: str, role: str, text: str):
        nonlocal state
        if letter in "IR":
            (initial,) = (x for x in ROLES if (state, x) in STEP)
            role = ROLES[initial]
        state = STEP[state, role[:1]]
        return letter, role, text

    for role, text in rows:
        while (letter := next(letters)) == "I":
            yield made(letter, "", "")
        if letter != "D":
            yield made(letter, role, text)
    for letter in letters:
        yield made(letter, "", "")


# ---- Spark ----

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PLAN = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("gaps", *_COUNTS, "cost")] + [T.StructField("audit", T.StringType())]
)
_FRAGMENT = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("part", T.IntegerType())]
    + [T.StructField(x, T.LongType()) for x in (*_COUNTS, "low", "high", "turns")]
    + [T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]
    + [T.StructField("cell", T.ArrayType(T.StructType().add("p", "integer").add("q", "integer").add("cost", "long").add("audit", "string")))]
)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _bound(x: int) -> int:
    return max(-_LONG - 1, min(_LONG, x))


class _Conversation:
    """What is known of a conversation, or of the run of it that one task has."""

    def __init__(self):
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = None
        self.turns = 0
        self.first = self.last = None
        self.spans = Spans()

    def _meets(self, first: str) -> None:
        if self.first is None:
            self.first = first
        elif self.last + first not in LEGAL:
            self.counts["illegal"] += 1

    def _turns(self, low: int | None, high: int | None, n: int) -> None:
        if low is not None:
            self.turns += n - (self.high == low)  # turns come in ascending order
            self.low = low if self.low is None else self.low
            self.high = high

    def row(self, x: dict, costs: Costs) -> None:
        """``n`` equal rows; all but the first are duplicates."""
        n, fault = x["n"], REMOVE if x["blank"] or x["duplicate"] else TRUNCATED if x["truncated"] else OK
        self._meets(x["initial"])
        self.last = x["initial"]
        self._turns(x["turn"], x["turn"], 1)
        self.counts["illegal"] += n - 1
        if x["blank"] or x["duplicate"]:
            self.counts["blank" if x["blank"] else "duplicate"] += n
        else:
            self.counts["duplicate"] += n - 1
            self.counts["truncated"] += fault == TRUNCATED
        self.spans.add(row_cell(x["initial"], fault, costs))
        if n > 1:
            self.spans.add(deleted(n - 1, costs))

    def fragment(self, x: dict) -> None:
        if x["first"] is None:  # stands for the conversation only
            return
        self._meets(x["first"])
        self.last = x["last"]
        self._turns(x["low"], x["high"], x["turns"])
        for name in _COUNTS:
            self.counts[name] += x[name]
        self.spans.add({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in x["cell"]})

    def as_fragment(self) -> dict:
        cell = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in self.spans.whole().items()]
        known = {"low": self.low, "high": self.high, "turns": self.turns, "first": self.first, "last": self.last}
        return self.counts | known | {"cell": cell}

    def plan(self, costs: Costs) -> dict:
        cost, audit = cheapest(self.spans.whole(), costs)
        gaps = 0 if self.low is None else _bound(self.high - self.low + 1 - self.turns)
        return self.counts | {"gaps": gaps, "cost": cost, "audit": audit}


def _runs(batches: Iterable[pa.RecordBatch], take) -> Iterator[tuple[int | None, _Conversation]]:
    """Conversations of sorted rows, each when its last row has been taken."""
    now = None
    for batch in slices(batches, 2048):
        for x in batch.to_pylist():
            if now is None or now[0] != x["id"]:
                if now:
                    yield now
                now = x["id"], _Conversation()
            take(now[1], x)
    if now:
        yield now


def _in_batches(rows: Iterable[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of ``size`` rows, or fewer where their texts are long."""
    held, room = [], 1 << 23
    for row in rows:
        held.append(row)
        room -= sum(len(x) for x in row.values() if isinstance(x, str))
        if len(held) == size or room < 0:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, room = [], 1 << 23
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


SPACES = " \t\n\x0b\x0c\r"


def _turns_of(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    made = rows.select(
        F.col(conv_col).cast("long").alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        empty(role_col).alias("role"),
        empty(text_col).alias("text"),
    )
    return made.withColumn("digest", F.unhex(F.sha2(F.concat_ws("\0", "role", "text"), 256)))


_COLUMNS = ("conv_id", "turn", "role", "text")


def plans(rows: DataFrame, costs: Costs = Costs(), columns: tuple = _COLUMNS, ids: DataFrame | None = None) -> DataFrame:
    """(id, plan): faults, cost and audit of each conversation; also of those of ``ids`` (id) without rows."""
    last = F.right(F.btrim("text", F.lit(SPACES)), F.lit(1))
    made = _turns_of(rows, *columns).select(
        "id", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")
    )
    counted = made.groupBy("id", "turn", "role", "digest", "blank", "truncated").agg(F.count("*").alias("n"))
    # Whether the same role and text came at an earlier turn. The key of the join has no nulls.
    keyed = counted.select("*", F.concat_ws(":", "id", F.hex("digest")).alias("same"))
    first = keyed.groupBy("same").agg(F.min(F.struct("turn")).alias("first"))
    judged = keyed.join(first, "same").select(
        "id", "turn", "role", "digest", "blank", "truncated", "n",
        (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("duplicate"),
        F.left("role", F.lit(1)).alias("initial"),
    )
    order = ["id", "turn", "role", "digest"]
    dealt = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    fragment, whole = _arrow(_FRAGMENT), T.StructType([_FRAGMENT["id"], T.StructField("plan", _PLAN)])
    planned = _arrow(whole)

    def parse(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        found = _runs(batches, lambda run, x: run.row(x, costs))
        return _in_batches(({"id": i, "part": part} | run.as_fragment() for i, run in found), fragment)

    def join(batches):
        found = _runs(batches, lambda run, x: run.fragment(x))
        return _in_batches(({"id": i, "plan": run.plan(costs)} for i, run in found), planned)

    narrow = dealt.select("id", "turn", "initial", "blank", "duplicate", "truncated", "n")
    parts = narrow.mapInArrow(parse, _FRAGMENT)
    if ids is not None:
        known = ids.select(F.col("id").cast("long").alias("id")).distinct()
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in _FRAGMENT.fields[1:]]
        parts = parts.unionByName(known.select("id", *others))
    return parts.repartition("id").sortWithinPartitions("id", "part").mapInArrow(join, whole)


def _edits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[dict]]]:
    """(first row with its plan, the rows behind it) of each conversation; the rows have to be used up."""
    flat = (x for batch in slices(batches) for x in batch.to_pylist())
    ahead = next(flat, None)
    while ahead is not None:
        head = ahead

        def rest():
            nonlocal ahead
            for ahead in flat:
                if ahead["plan"] is not None:
                    return
                yield ahead["role"], ahead["text"]
            ahead = None

        yield head, edited(head["plan"]["audit"], rest())


def _with_plans(rows: DataFrame, planned: DataFrame, columns: tuple) -> DataFrame:
    """Each conversation's plan, then its rows in order, in one partition."""
    texts = _turns_of(rows, *columns).select("id", F.lit(None).cast(_PLAN).alias("plan"), "turn", "role", "text", "digest")
    heads = planned.select("id", "plan", *(F.lit(None).cast(texts.schema[x].dataType).alias(x) for x in texts.columns[2:]))
    together = heads.unionByName(texts).repartition("id")
    return together.sortWithinPartitions("id", F.col("plan").isNull(), "turn", "role", "digest").drop("digest", "turn")


def repaired(rows: DataFrame, costs: Costs = Costs(), columns: tuple = _COLUMNS) -> DataFrame:
    """(id, place, edit, role, text): the turns of the repaired conversations; edit is K, R or I."""
    schema = T.StructType().add("id", "long").add("place", "long").add("edit", "string").add("role", "string").add("text", "string")
    made = _arrow(schema)

    def run(batches):
        return _in_batches(
            (
                {"id": head["id"], "place": k, "edit": edit, "role": role, "text": text}
                for head, turns in _edits(batches)
                for k, (edit, role, text) in enumerate(turns)
            ),
            made,
        )

    return _with_plans(rows, plans(rows, costs, columns), columns).mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, planned: DataFrame, columns: tuple = _COLUMNS) -> DataFrame:
    """(id, plan, digest): SHA-256 of the repaired turns, ``role:text`` joined by newlines."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("plan", _PLAN), T.StructField("digest", T.StringType())])
    made = _arrow(schema)

    def digest(turns) -> str:
        found = hashlib.sha256()
        for k, (_, role, text) in enumerate(turns):
            found.update(f"{chr(10) if k else ''}{role}:{text}".encode())
        return found.hexdigest()

    def run(batches):
        return _in_batches(
            ({"id": h["id"], "plan": h["plan"], "digest": digest(turns)} for h, turns in _edits(batches)), made
        )

    return _with_plans(rows, planned, columns).mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage, dealt by crc32 of ``conv_id:turn``; nulls become one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    made = rows.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return made.drop("copy")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hurt = damaged(rows)
    planned = plans(hurt, ids=rows.select(F.col("conv_id").alias("id")))
    return repaired_digests(hurt, planned).select(
        F.col("id").alias("conv_id"),
        *(F.col(f"plan.{x}").alias(x) for x in ("gaps", *_COUNTS, "cost", "audit")),
        F.col("digest").alias("repaired_sha256"),
    )


def _moves(costs: Costs) -> str:
    """SQL values (p, q, initial, cost, letters, inserted, role): every way to treat one row."""
    found = []
    for (p, r), n in insertions().items():
        put, state = "", p
        for _ in range(n):
            (x,) = (x for x in ROLES if (state, x) in STEP)
            put, state = f"{put}|{ROLES[x]}:", STEP[state, x]
        ahead, lead = n * costs.insert, "I" * n
        found.append((p, r, "", ahead + costs.delete, lead + "D", put, ""))
        for (a, x), q in STEP.items():
            if a == r:
                found.append((p, q, x, ahead, lead + "K", put, ""))
                if x in ROLES:
                    found.append((p, q, "", ahead + costs.rerole, lead + "R", put, ROLES[x]))
    return ", ".join(str(x) for x in found)


def sql() -> str:
    """DuckDB SQL for ``report``: a search from row to row that keeps the least edits for each state."""
    costs = Costs()
    tails = "(0, 0, '', ''), (1, 6, 'II', '|user:|assistant:'), (2, 3, 'I', '|assistant:'), (3, 0, '', '')"
    lines = lambda x: f"replace({x}, '|', chr(10))"
    return rf"""
WITH RECURSIVE codes AS (
  SELECT list(c ORDER BY i) AS codes FROM (
    SELECT i, list_reduce(range(8)::BIGINT[],
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
    lambda x: CAST(ascii(x) AS BIGINT)) AS place
  FROM conversations),
dealt AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(place, lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM named, codes),
hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE kind <> 0),
placed AS (
  SELECT conv_id, turn, role, text, role[1:1] AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || chr(0) || text)) AS i,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM hurt),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    coalesce(lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
judged AS (SELECT *, blank OR again AS gone, cut AND NOT blank AND NOT again AS truncated FROM seen),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id),
moves(p, q, x, cost, letters, put, role) AS (VALUES {_moves(costs)}),
search AS (
  SELECT conv_id, 0 AS i, 0 AS state, {{'cost': 0, 'audit': '', 'made': ''}} AS best FROM counts
  UNION ALL
  SELECT s.conv_id, s.i + 1, m.q, min({{
    'cost': s.best.cost + m.cost + CASE WHEN truncated AND m.letters NOT LIKE '%D' THEN {costs.truncated} ELSE 0 END,
    'audit': s.best.audit || m.letters,
    'made': s.best.made || {lines("m.put")} || CASE WHEN m.letters LIKE '%D' THEN ''
      ELSE chr(10) || CASE m.role WHEN '' THEN r.role ELSE m.role END || ':' || r.text END}})
  FROM search s JOIN judged r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1
    JOIN moves m ON m.p = s.state AND (m.letters LIKE '%D' OR NOT r.gone) AND (m.x = '' OR m.x = r.x)
  GROUP BY s.conv_id, s.i, m.q),
tails(state, cost, audit, put) AS (VALUES {tails}),
ended AS (
  SELECT c.conv_id, min({{'cost': best.cost + t.cost, 'audit': best.audit || t.audit, 'made': best.made || {lines("t.put")}}}) AS best
  FROM counts c JOIN search s ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = c.n JOIN tails t USING (state)
  GROUP BY c.conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(best.made[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
  LEFT JOIN counts c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ended e ON d.conv_id IS NOT DISTINCT FROM e.conv_id
"""
