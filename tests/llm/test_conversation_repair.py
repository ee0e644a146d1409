"""Repair of conversations against all edits, against the full chart, and whole queries against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from alertlake.llm import conversation_repair as repair
from alertlake.llm.conversation_repair import OK, REMOVE, TRUNCATED, Costs, Spans

FORM = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def all_edits(rows, costs):
    """The cheapest of every way to edit a few rows, with up to two insertions at each place."""
    best = None
    places = [["", "u", "a", "ua", "au"]] * (len(rows) + 1)
    for chosen in itertools.product(*([list("KDua")] * len(rows))):
        cost, options = 0, []
        for (initial, fault), edit in zip(rows, chosen):
            if edit == "D":
                cost += costs.delete
                options.append(("D", ""))
            else:
                cost += (fault == TRUNCATED) * costs.truncated + (edit != "K") * costs.rerole
                options.append(("K", initial or "?") if edit == "K" else ("R", edit))
        if any(fault == REMOVE and edit != "D" for (_, fault), edit in zip(rows, chosen)):
            continue
        for put in itertools.product(*places):
            roles = "".join(p + o[1] for p, o in zip(put, [*options, ("", "")]))
            if FORM.fullmatch(roles):
                audit = "".join("I" * len(p) + o[0] for p, o in zip(put, [*options, ("", "")]))
                found = (cost + costs.insert * sum(map(len, put)), audit)
                best = found if best is None else min(best, found)
    return best


def full_chart(cells):
    """All spans and all places to split them."""
    n = len(cells)
    chart = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for k in range(i + 1, i + length):
                for at, found in repair.joined(chart[i, k], chart[k, i + length]).items():
                    cell[at] = min(cell.get(at, found), found)
            chart[i, i + length] = cell
    return chart.get((0, n))


def parsed(rows, costs=Costs()):
    spans = Spans()
    for initial, fault in rows:
        spans.add(repair.row_cell(initial, fault, costs))
    return repair.cheapest(spans.whole(), costs)


@pytest.mark.parametrize("costs", [Costs(), Costs(rerole=2, delete=2, insert=1, truncated=1), Costs(1, 5, 3, 0)])
def test_cheapest_of_all_edits(costs):
    r = random.Random(3)
    for n in range(4):
        every = list(itertools.product("sua", [OK, TRUNCATED, REMOVE])) + [("", OK), ("t", TRUNCATED)]
        for _ in range(60):
            rows = [r.choice(every) for _ in range(n)]
            assert parsed(rows, costs) == all_edits(rows, costs), rows


def test_one_split_is_enough():
    r = random.Random(4)
    for _ in range(150):
        rows = [(r.choice("suuaaat"), r.choice([OK, OK, OK, TRUNCATED, REMOVE])) for _ in range(r.randrange(1, 14))]
        cells = [repair.row_cell(x, f, Costs()) for x, f in rows]
        spans = Spans()
        for c in cells:
            spans.add(c)
        assert spans.whole() == full_chart(cells)
    many = repair.deleted(13, Costs())
    one = [repair.row_cell("", REMOVE, Costs())] * 13
    assert many == full_chart(one)


def brute_force(rows):
    """The contract's columns from all rows, by a plain left-to-right search."""
    ids = {x[0] for x in rows}
    hurt = {i: [] for i in ids}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        hurt[c] += [(t, role, text)] * (2 if kind == 3 else 1)
    digest = lambda role, text: hashlib.sha256(f"{role}\0{text}".encode()).digest()
    for c, turns in hurt.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], digest(x[1], x[2])))
        counts, judged, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, [], set()
        for _, role, text in turns:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
            fault = fault or ("truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role[:1], fault))
        initials = [x for x, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = {t for t, _, _ in turns if t is not None}
        gaps = min(max(known) - min(known) + 1 - len(known), (1 << 63) - 1) if known else 0
        # least (cost, audit, repaired) for each state, row by row
        best = {0: (0, "", ())}

        def opened(found):
            for _ in range(3):
                for state, (cost, audit, made) in list(found.items()):
                    x = "a" if state == 2 else "u"
                    to, more = (3, "assistant:") if x == "a" else (2, "user:")
                    new = (cost + 3, audit + "I", (*made, more))
                    found[to] = min(found.get(to, new), new)
            return found

        for (_, role, text), (x, fault) in zip(turns, judged):
            after = {}

            def put(state, new):
                after[state] = min(after.get(state, new), new)

            for state, (cost, audit, made) in opened(dict(best)).items():
                put(state, (cost + 4, audit + "D", made))
                if fault in ("blank", "duplicate"):
                    continue
                cost += 3 * (fault == "truncated")
                nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
                if x in nexts:
                    put(nexts[x], (cost, audit + "K", (*made, f"{role}:{text}")))
                name = "assistant" if state == 2 else "user"
                put(nexts[name[0]], (cost + 3, audit + "R", (*made, f"{name}:{text}")))
            best = after
        cost, audit, made = min(x for s, x in opened(dict(best)).items() if s in (0, 3))
        sha = hashlib.sha256("\n".join(made).encode()).hexdigest()
        yield (c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)


def odd_rows():
    r = random.Random(5)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n", "a. ", "b.\x0b", "ünd so 😀", "?"]
    rows = []
    for c in range(120):
        for t in range(r.randrange(1, 9)):
            role = "ua"[t % 2] if c % 3 else r.choice("suax")
            role = {"u": "user", "a": "assistant", "s": "system", "x": r.choice(["tool", "", "System", "u", None])}[role]
            rows.append((c, t * r.choice([1, 1, 2]), role, r.choice(texts) if c % 2 else f"{t} {c}."))
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 3, "user", "a."), (200, -2, None, None)]
    rows += [(None, 1, "user", "q."), (None, 2, "assistant", "a."), (201, None, None, None), (202, 5, "user", "x" * 100_000)]
    rows += [(203, 7, "user", "again.")] * 40 + [(204, t, "user" if t % 2 else "assistant", f"{t}!") for t in range(700)]
    return rows + [(205, 1 << 62, "user", "far."), (205, -(1 << 62) - 5, "assistant", "away.")]


@pytest.fixture(scope="module")
def conversations(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("conversations"))
    schema = "conv_id long, turn long, role string, text string, id int, plan string, n int, digest string"
    rows = spark.createDataFrame([(*x, 1, "p", 2, "d") for x in odd_rows()], schema).repartition(5)
    rows.write.parquet(f"{path}/conversations.parquet")
    return path


def test_query_equals_brute_force(spark, conversations):
    got = sorted((tuple(x) for x in repair.report(spark, conversations).collect()), key=str)
    assert got == sorted(brute_force(odd_rows()), key=str)


def test_repaired_rows(spark, conversations):
    rows = spark.read.parquet(f"{conversations}/conversations.parquet")
    made = repair.repaired(rows).orderBy("id", "place").collect()
    by_id = {}
    for x in made:
        assert x.place == len(by_id.setdefault(x.id, []))
        by_id[x.id].append(x)
    for turns in by_id.values():
        assert FORM.fullmatch("".join(x.role[0] for x in turns))
    kept = [x.text for x in by_id[204]]
    assert kept[:2] == ["", "0!"] and len(kept) == 702  # a user before the first, an assistant behind the last
    empty = rows.limit(0)
    assert repair.repaired(empty).count() == 0 and repair.plans(empty).count() == 0


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t // 2} said{'.' if t % 5 else ''}") for t in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    many, one = (repair.plans(df.repartition(n)) for n in (6, 1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = many.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert wide == one.collect()
    assert len(wide) == 1 and len(wide[0].plan.audit.replace("I", "")) == 1500
