"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Texts are lower-cased (A-Z only) and cut into words; each benchmark word becomes one symbol, so
the automaton runs over word symbols and a match cannot begin or end inside a word. A text is
read once; word positions are mapped back to offsets of the original text for texts with hits.

The benchmark decides the automaton's size, so it is taken in blocks of ``BLOCK_BYTES``; each
block is broadcast and scanned in the same pass over the rows (no shuffle of texts). With a
benchmark of up to one block, which is the usual case, there is one automaton.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import built_once, fresh, raw_texts, with_computed

WINDOW = 13
#: Benchmark text in one automaton. 256 KB of text make about 45,000 windows and 25 MB of automaton.
BLOCK_BYTES = 256 * 1024

_TO_WORDS = bytes(
    ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_OTHER = "\x01"

HIT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
        T.StructField(
            "words",
            T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])),
        ),
    ]
)


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-cased words of a text given as UTF-8; none for null."""
    return raw.translate(_TO_WORDS).split() if raw else []


def _symbol(i: int) -> str:
    code = i + 2
    return chr(code if code < 0xD800 else code + 0x800)


class Automaton:
    """Aho-Corasick automaton over the windows of benchmark items."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW) -> None:
        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set[str | None]] = {}
        for item_id, raw in items:
            words = words_of(raw)
            text = "".join(self.symbols.setdefault(w, _symbol(len(self.symbols))) for w in words)
            for at in range(max(1, len(text) - window + 1) if text else 0):
                owners.setdefault(text[at : at + window], set()).add(item_id)
        self.automaton = ahocorasick.Automaton()
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), tuple(i for i in ids if i is not None)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges inside any occurrence (first and last word, unmerged) and the items."""
        if self.empty or not words:
            return [], set()
        get = self.symbols.get
        ranges, found = [], set()
        for last, (length, ids) in self.automaton.iter("".join([get(w, _OTHER) for w in words])):
            ranges.append((last - length + 1, last))
            found.update(ids)
        return ranges, found


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _offsets(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code-point offsets, in the original text, of ranges of words."""
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    out, at, seen = [], 0, 0
    for first, last in ranges:
        ends = []
        for byte in (places[first][0], places[last][1]):
            seen += len(raw[at:byte].decode())
            at = byte
            ends.append(seen)
        out.append({"start": ends[0], "end": ends[1]})
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterable[list[tuple[str | None, bytes | None]]]:
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("raw")
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    count = -(-total // BLOCK_BYTES) or 1
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "raw"), F.lit(count)) == k)
        yield [(r.item, None if r.raw is None else bytes(r.raw)) for r in part.toLocalIterator()]


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "hits",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of what the automaton found, and that column's name.

    The struct holds ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items``
    (ids with an occurring window, as sorted strings), ``spans`` (code points in the original text, end
    exclusive) and ``words`` (the same as first and last word). Null and empty texts have no words
    and no hits; items without words match nothing; the windows of an item with a null id hit words
    like others, and only ``items`` leaves it out; an item in several rows counts once; repeated rows of ``docs`` stay. If ``docs`` has a column ``name``, underscores
    are put in front.
    """
    spark = docs.sparkSession
    name = fresh(docs.columns, name)
    out = docs
    for k, block in enumerate(_blocks(benchmark, item_col, item_text)):
        given = spark.sparkContext.broadcast(block)
        key = (f"automaton {k}", window, hashlib.sha256(repr(block).encode()).hexdigest())
        before = name if k else None

        def compute(texts: pa.Array, earlier: pa.Array | None = None, given=given, key=key) -> list:
            automaton = built_once(key, lambda: Automaton(given.value, window))
            found = earlier.to_pylist() if earlier is not None else [None] * len(texts)
            out = []
            for raw, old in zip(raw_texts(texts), found, strict=True):
                words = words_of(raw)
                ranges, items = automaton.scan(words)
                if old:
                    ranges = [*ranges, *((r["first"], r["last"]) for r in old["words"])]
                    items = items | set(old["items"])
                ranges = merged(ranges)
                out.append(
                    {
                        "n_words": len(words),
                        "n_hit": sum(last - first + 1 for first, last in ranges),
                        "items": sorted(items),
                        "spans": _offsets(raw, ranges) if ranges else [],
                        "words": [{"first": a, "last": b} for a, b in ranges],
                    }
                )
            return out

        if before is None:
            out = with_computed(out, name, HIT, [text_col], compute)
        else:
            later = fresh(out.columns, name)
            out = with_computed(out, later, HIT, [text_col, name], compute)
            out = out.drop(name).withColumnRenamed(later, name)
    return out, name


def is_contaminated(n_words, n_hit):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def items_digest(items):
    """SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.sort_array(items)), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose hits are below a twentieth of their words; columns as given."""
    out, name = with_hits(docs, benchmark)
    hits = F.col(name)
    return out.where(~is_contaminated(hits["n_words"], hits["n_hit"])).drop(name)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: counts, digest of the items, verdict and spans."""
    out, name = with_hits(docs.select("doc_id", "text"), benchmark)
    hits = F.col(name)
    return out.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        items_digest(hits["items"]).alias("items_sha256"),
        is_contaminated(hits["n_words"], hits["n_hit"]).alias("contaminated"),
    )


def brute_force(doc: str | None, items: list[tuple[int, str | None]], window: int = WINDOW) -> tuple:
    """n_words, n_hit, item digest by plain comparison of every window; for tests."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = pattern.findall((doc or "").translate(lower))
    hit, found = set(), set()
    for item_id, text in items:
        mine = pattern.findall((text or "").translate(lower))
        n = min(window, len(mine))
        for i in range(len(mine) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == mine[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(item_id)
    found.discard(None)
    digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    return len(words), len(hit), len(found), digest
