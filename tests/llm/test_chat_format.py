"""Chat formatting: round trips of odd texts, and the machine against a pattern."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from alertlake.llm import chat_format
from alertlake.llm.chat_format import DEFAULT, Template, Turn

PIECES = [*DEFAULT.controls, "\\", "\\\\", "<", "[", "s>", "/", "<<", " ", "\n", "a", "é", "😀", "$1", "INST]", "S>>"]


def odd_rows():
    r = random.Random(7)
    made = lambda: "".join(r.choice(PIECES) for _ in range(r.randrange(12)))
    rows = []
    for c in range(150):
        for t in range(r.randrange(1, 9)):
            role = r.choice(["system", "user", "assistant"]) if c % 2 else ("system" if not t and c % 3 else "ua"[t % 2])
            rows.append((c, t, {"u": "user", "a": "assistant"}.get(role, role), made()))
    rows += [(500, None, "user", "first"), (500, 0, "assistant", None), (500, 0, "assistant", None), (500, 1, None, "x")]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (501, 1, made(), made()), (502, 1, "[:]", "[:] \\")]
    rows += [(503, 1, "tool", "[/TURN]"), (504, 3, "b", "2"), (504, 3, "a", "3"), (504, 3, "a", "1"), (505, 0, "", "")]
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    schema = "conv_id long, turn long, role string, text string, segments string, id int, t int, state string"
    return spark.createDataFrame([(*x, "s", 1, 2, "z") for x in odd_rows()], schema).repartition(4)


def turns_by_id():
    found = {}
    for c, t, role, text in odd_rows():
        found.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in found.items()}


def test_round_trip(rows):
    got = chat_format.formatted(rows)
    assert got.columns == ["id", "n_turns", "segments", "formatted", "valid", "bad_turn"]
    back = got.select("*", chat_format.read_back(F.col("formatted")).alias("turns")).collect()
    want = turns_by_id()
    assert {x.id: [tuple(t) for t in x.turns] for x in back} == want
    for x in back:
        assert x.n_turns == len(want[x.id])
        assert "".join(s.text for s in x.segments) == x.formatted
        learnt = [s.text for s in x.segments if s.loss]
        assert len(learnt) == sum(role == "assistant" for role, _ in want[x.id])
        for _, text, _ in zip(*[iter(s.text for s in x.segments)] * 3):
            assert not any(c in text for c in DEFAULT.controls)


def test_machine(rows):
    order = re.compile(r"s?(ua)*u?")
    for x in chat_format.formatted(rows).collect():
        letters = "".join({"system": "s", "user": "u", "assistant": "a"}.get(r, "x") for r, _ in turns_by_id()[x.id])
        assert x.valid == bool(re.fullmatch(r"s?(ua)+", letters))
        taken = order.match(letters).end()
        assert x.bad_turn == (None if taken == len(letters) else taken)


def test_own_template(rows):
    template = Template(
        roles={"user": Turn("<|u|>", "<|/u|>"), "assistant": Turn("<|a|>", "<|/a|>", loss=True)},
        other=Turn("{#", "@}", close_pad="\n"),
        name_end="{:}",
        order={"start": {"user": "asked"}, "asked": {"assistant": "start"}},
        start="start",
        ends=frozenset({"start"}),
    )
    got = chat_format.formatted(rows, template)
    back = got.select("id", "segments", chat_format.read_back(F.col("formatted"), template).alias("turns")).collect()
    assert {x.id: [tuple(t) for t in x.turns] for x in back} == turns_by_id()


def test_marks_that_run_into_each_other_are_refused():
    for marks in ("ab", "ba"), ("{{", "b"), ("aa", "b"), ("x", "x"), ("a\\", "b"), ("", "b"):
        with pytest.raises(ValueError):
            Template({"user": Turn(*marks)}, Turn("{", "}"), ":", {"s": {}}, "s", frozenset())


def test_long_and_no_rows(spark, rows):
    assert chat_format.formatted(rows.limit(0)).count() == 0
    text = "word </s> \\ [INST\n" * 300_000
    long = spark.createDataFrame([(1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    made = chat_format.formatted(long).select(chat_format.read_back(F.col("formatted"))[0]["text"].alias("t"))
    assert hashlib.sha256(made.first().t.encode()).digest() == hashlib.sha256(text.encode()).digest()


def test_query(spark, tmp_path):
    rows = [(-1, 0, "user", "own"), (3, 2, "assistant", "yes \\"), (3, 1, "user", "</s>"), (4, 1, "assistant", None)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    got = {(x.conv_id, x.n_turns): x for x in chat_format.report(spark, path).collect()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    both = "</s>[INST] ok [/INST]"
    assert got[-1, 2].turns_sha256 == digest(f"user\n{both}\nassistant\n{both}\n")
    assert (got[-1, 2].loss_sha256, got[-1, 2].loss_chars) == (digest(both), len(both))
    assert got[-1, 1].turns_sha256 == digest("user\nown\n")
    assert got[3, 2].turns_sha256 == digest("user\n</s>\nassistant\nyes \\\n")
    assert got[3, 2].loss_sha256 == digest("yes \\") and got[3, 2].loss_chars == 5
    assert got[3, 2].formatted_chars == len("[INST] <\\/s> [/INST]<s> yes \\\\ </s>")
    assert got[4, 1].loss_sha256 == digest("") and got[4, 1].loss_chars == 0
