"""Removal of repeated passages: winnowing over the hashes of rolling word lines.

A line here is ``LINE`` consecutive words, one beginning at every word, because passages repeat
inside lines of text as well as in whole ones. Of every ``SPAN`` consecutive words, the line with
the smallest hash is selected as a fingerprint (the last of equals). So two texts that share
``SPAN`` words share a fingerprint there.

1. Fingerprints are joined by hash; those that occur once are done with.
2. Texts with fingerprints that occur again extend them both ways: of all spans that selected such
   a fingerprint, the hash of the span's words decides whether it occurred before, at a smaller
   (document, position).
3. Words of spans that occurred before are deleted, each with the space that follows it; runs of
   such spans are one deletion. The first occurrence of a span stays. Where a span overlaps its
   own first occurrence in the same text, only the part after that occurrence goes.

A span hash has 64 bits of hashed words; equal hashes of different spans have a chance of about
n*n/2**65 for n repeated spans. Within a chunk of texts repeats are settled at once, so that what
is shuffled of a passage is one row for each chunk with it, not one for each occurrence. Of texts
that are whole copies only the first is looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from alertlake.llm.common import fresh, raw_texts, slices

SPAN = 50
LINE = 25
#: Words whose hashes are held at once (texts of 256 rows more, or one long text, can be above it).
WORDS_AT_ONCE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1), modulo 2**64; kept for the next call."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes that are hashed at once, and the length from which a word is hashed by itself.
PIECE, LONG_WORD = 1 << 20, 1 << 16
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_starts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, in bytes."""
    word = ~_IS_SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(np.r_[False, word, False]))
    return edges[::2], edges[1::2]


def _piece_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word from its bytes and their places in it, and where the words begin."""
    starts, ends = word_starts(raw)
    values = _BYTE_VALUES[np.frombuffer(raw, np.uint8)]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * _power(_BASE, len(raw)), out=sums[1:])
        hashes = _mixed((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(raw) + 1)[starts])
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(raw[starts[k] : ends[k]])
    return hashes, starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text cut between words, a word of more than a piece by itself."""
    at = 0
    while len(raw) - at > PIECE:
        found = _SPACE.search(raw, at + PIECE)
        end = found.start() if found else len(raw)
        if end - at > PIECE + LONG_WORD:  # a long word: what is ahead of it, then the word
            ahead = max(raw.rfind(bytes([c]), at, at + PIECE) for c in np.flatnonzero(_IS_SPACE))
            if ahead > at:
                yield raw[at:ahead]
            at = max(ahead, at)
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and how many each text has."""
    found, counts = [np.empty(0, np.uint64)], np.zeros(len(raws), np.int64)
    held: list[tuple[int, bytes]] = []

    def settle() -> None:
        if held:
            offsets = np.cumsum([0, *(len(raw) + 1 for _, raw in held)])
            hashes, starts = _piece_hashes(b" ".join(raw for _, raw in held))
            found.append(hashes)
            of = np.searchsorted(offsets, starts, side="right") - 1
            np.add.at(counts, np.array([k for k, _ in held])[of], 1)
            held.clear()

    size = 0
    for k, raw in enumerate(raws):
        for piece in _pieces(raw):
            if size and size + len(piece) > PIECE:
                settle()
                size = 0
            if len(piece) > PIECE + LONG_WORD:  # one word, and spaces
                words = piece.split()
                found.append(np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64))
                counts[k] += len(words)
            else:
                held.append((k, piece))
                size += len(piece)
    settle()
    return np.concatenate(found), counts


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words (none if there are fewer)."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _power(_BASE_INVERSE, n), out=sums[1:])
        return _mixed((sums[width:] - sums[:-width]) * _power(_BASE, n - width + 1))


def selected(lines: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` consecutive line hashes the place of the smallest, the last of equals."""
    if len(lines) < window:
        return np.empty(0, np.int64)
    least, at, width = lines, np.arange(len(lines)), 1
    while width < window:
        step = min(width, window - width)
        right = least[step:] <= least[:-step]
        least = np.where(right, least[step:], least[:-step])
        at = np.where(right, at[step:], at[:-step])
        width += step
    return at


class Chunk:
    """The words of several texts, one after the other."""

    def __init__(self, texts: list[tuple], hashes: np.ndarray, lengths: np.ndarray) -> None:
        self.texts = np.array([t[:2] for t in texts], np.int64).reshape(-1, 2)
        self.more = [t[2:] for t in texts]
        self.starts = np.r_[0, np.cumsum(lengths)]
        self.lines, self.spans = rolling(hashes, LINE), rolling(hashes, SPAN)
        chosen = selected(self.lines, SPAN - LINE + 1)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        ends = self.starts[1:][self.row]
        #: First words of the spans that lie in one text, and the line each has selected.
        self.firsts = np.flatnonzero(np.arange(len(chosen)) + SPAN <= ends[: len(chosen)])
        self.chosen = chosen[self.firsts]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys sorted ascending: where a new key begins, and how often it occurs."""
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return new, np.diff(np.r_[new, len(keys)])


# Rows that leave a worker. A text is known by its document and a hash of its bytes. Settled rows
# are results already; others are to be compared with rows of the same key from other chunks. Rows
# leave in the order of their texts, which keeps them small when they are shuffled.
FOUND = T.StructType(
    [T.StructField("settled", T.BooleanType()), T.StructField("key", T.LongType())]
    + [T.StructField(x, T.LongType()) for x in ("doc", "sig", "place", "size")]
)
TEXT_KEY = ["doc", "sig"]
#: Parts into which the rows of a group of copies are dealt.
SALTS = 32
#: Stands for a null id, whose rows are left as they are.
NO_DOC = -(1 << 63)


def _table(settled: np.ndarray, key: np.ndarray, texts: np.ndarray, place, size) -> pa.RecordBatch:
    columns = [key.view(np.int64), texts[:, 0], texts[:, 1], place, size]
    order = np.lexsort((place, texts[:, 1], texts[:, 0]))
    arrays = [pa.array(settled[order]), *(pa.array(x[order], pa.int64()) for x in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=FOUND.names)


def _own_keys(texts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Keys of settled rows, which are to spread."""
    with np.errstate(over="ignore"):
        return _mixed(texts[:, 0].view(np.uint64) * np.uint64(_BASE) + place.view(np.uint64))


def _chunks(batches: Iterable[pa.RecordBatch], at: tuple[int, ...]) -> Iterator[Chunk]:
    """Chunks of the rows; ``at`` has the columns of document, hash, text, and what else is wanted."""
    texts, hashes, lengths, n = [], [], [], 0
    for part in slices(batches):
        doc, sig, raw, *more = (part.column(i) for i in at)
        words, counts = word_hashes([x or b"" for x in raw_texts(raw)])
        enough = counts >= SPAN
        rows = zip(*(c.to_pylist() for c in (doc, sig, *more)), strict=True)
        texts.extend(row for row, some in zip(rows, enough, strict=True) if some)
        hashes.append(words[np.repeat(enough, counts)])
        lengths.append(counts[enough])
        n += len(hashes[-1])
        if n >= WORDS_AT_ONCE:
            yield Chunk(texts, np.concatenate(hashes), np.concatenate(lengths))
            texts, hashes, lengths, n = [], [], [], 0
    if texts:
        yield Chunk(texts, np.concatenate(hashes), np.concatenate(lengths))


#: Rows of fingerprints: a settled row holds all places of a text that are settled in its chunk.
FINGERPRINTS = T.StructType([*FOUND.fields[:4], T.StructField("places", T.ArrayType(T.LongType()))])


def _fingerprint_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the selected lines of the columns (doc, sig, text).

    A line that is repeated in the chunk is settled as such wherever it is, in one row for each text, and
    one of its rows goes on, twice, to tell the other chunks.
    """
    for chunk in _chunks(batches, (0, 1, 2)):
        at = np.unique(chunk.chosen)
        at = at[np.argsort(chunk.lines[at], kind="stable")]
        keys, row = chunk.lines[at], chunk.row[at]
        of, place = chunk.texts[row], at - chunk.starts[row]
        new, count = _repeats(keys)
        again = np.flatnonzero(np.repeat(count > 1, count))
        again = again[np.lexsort((place[again], row[again]))]
        first, n_places = _repeats(row[again])
        on = np.repeat(new, np.minimum(count, 2))
        lead = again[first]
        texts, heads = np.concatenate([of[lead], of[on]]), np.r_[place[lead], place[on]]
        ends = np.cumsum(np.r_[0, n_places, np.ones(len(on), np.int64)])
        places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.r_[place[again], place[on]], pa.int64()))
        key = np.r_[_own_keys(of[lead], place[lead]), keys[on]].view(np.int64)
        settled = np.arange(len(heads)) < len(lead)
        rows = pa.RecordBatch.from_arrays(
            [pa.array(settled), pa.array(key), pa.array(texts[:, 0]), pa.array(texts[:, 1]), places],
            names=FINGERPRINTS.names,
        )
        yield rows.take(pa.array(np.lexsort((heads, texts[:, 1], texts[:, 0]))))


def _span_rows(batches: Iterable[pa.RecordBatch], at: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """A row for each first span of the chunk that selected a repeated line; spans that came
    before in the chunk are settled, and so is all of a text that is a copy of an earlier one."""
    for chunk in _chunks(batches, at):
        repeated = [np.array([], np.int64)]
        whole = []
        for k, (places, copied) in enumerate(chunk.more):
            if copied:
                whole.append(k)
            elif places:
                repeated.append(np.array(places, np.int64) + chunk.starts[k])
        firsts = chunk.firsts[np.isin(chunk.chosen, np.concatenate(repeated))]
        row = chunk.row[firsts]
        keys, of, place = chunk.spans[firsts], chunk.texts[row], firsts - chunk.starts[row]
        order = np.lexsort((place, of[:, 1], of[:, 0], keys))
        keys, of, place = keys[order], of[order], place[order]
        new, count = _repeats(keys)
        later = np.ones(len(keys), bool)
        later[new] = False
        first = np.repeat(new, count)
        own = (of == of[first]).all(axis=1)
        start = np.where(own, np.maximum(place, place[first] + SPAN), place)
        cut_of, cut_start, cut_end = _runs(of[later], start[later], place[later] + SPAN)
        copies = chunk.texts[whole]
        zeros = np.zeros(len(whole), np.int64)
        settled_of = np.r_[cut_of, copies]
        settled_start = np.r_[cut_start, zeros]
        yield _table(
            np.r_[np.ones(len(settled_start), bool), np.zeros(len(new), bool)],
            np.r_[_own_keys(settled_of, settled_start), keys[new]],
            np.r_[settled_of, of[new]],
            np.r_[settled_start, place[new]],
            np.r_[cut_end - cut_start, np.diff(chunk.starts)[whole], np.full(len(new), SPAN)],
        )


def _runs(of: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of (start, end) by text."""
    some = end > start
    of, start, end = of[some], start[some], end[some]
    if not len(of):
        return of, start, end
    order = np.lexsort((start, of[:, 1], of[:, 0]))
    of, start, end = of[order], start[order], end[order]
    # A span that begins later ends later, and a trimmed one ends where it would have ended.
    new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]).any(axis=1) | (start[1:] > end[:-1])])
    return of[new], start[new], np.maximum.reduceat(end, new)


def repeated_lines(texts: DataFrame) -> DataFrame:
    """(doc, sig, places): places of the fingerprints that occur twice or more, anywhere."""
    given = texts.where(F.col("doc") != NO_DOC).select("doc", "sig", "text")
    rows = given.mapInArrow(_fingerprint_rows, FINGERPRINTS)
    by_key = Window.partitionBy("settled", "key").orderBy("doc", "sig")
    again = F.lag("doc").over(by_key).isNotNull() | F.lead("doc").over(by_key).isNotNull()
    found = rows.withColumn("again", F.col("settled") | again).where("again")
    return found.groupBy(*TEXT_KEY).agg(F.flatten(F.collect_list("places")).alias("places"))


def copies(texts: DataFrame) -> DataFrame:
    """(doc, sig) of the texts that equal one of a smaller document, by two hashes and the length."""
    same = [F.col("sig"), F.hash("text").alias("other"), F.octet_length("text").alias("length")]
    known = texts.where(F.col("doc") != NO_DOC).select("doc", *same).where("length > 0")
    first = known.groupBy("sig", "other", "length").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # A large group of copies is dealt out by a salt, to each of which its first text goes.
    salted = first.where("first < last").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = known.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    later = dealt.join(salted, ["sig", "other", "length", "salt"]).where("doc > first")
    return later.select("doc", "sig").distinct()


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(doc, sig, runs): the word ranges to delete of each text, as structs (start, size)."""
    copied = copies(texts).withColumn("copied", F.lit(True))
    repeated = repeated_lines(texts).join(copied, TEXT_KEY, "left")
    repeated = repeated.withColumn("places", F.when(F.col("copied").isNull(), F.col("places")))
    joined = texts.join(repeated.hint("shuffle_hash"), TEXT_KEY)
    at = tuple(joined.columns.index(x) for x in ("doc", "sig", "text", "places", "copied"))
    rows = joined.mapInArrow(lambda batches: _span_rows(batches, at), FOUND)
    by_key = Window.partitionBy("settled", "key").orderBy("doc", "sig", "place")
    ranked = rows.select(
        "*",
        F.row_number().over(by_key).alias("nth"),
        F.first(F.struct("doc", "sig", "place")).over(by_key).alias("first"),
    )
    own = ~F.col("settled") & (F.col("first.doc") == F.col("doc")) & (F.col("first.sig") == F.col("sig"))
    start = F.when(own, F.greatest("place", F.col("first.place") + SPAN)).otherwise(F.col("place"))
    cut = ranked.where("settled or nth > 1").select(*TEXT_KEY, start.alias("start"), (F.col("place") + F.col("size") - start).alias("size"))
    return cut.where("size > 0").groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("start", "size")).alias("runs"))


CUT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def _cut(raw: bytes | None, runs: list[dict] | None) -> dict | None:
    if raw is None or not runs:
        return None
    merged: list[list[int]] = []
    for start, end in sorted((r["start"], r["start"] + r["size"]) for r in runs):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    begins, _ = word_starts(raw)
    out, at = [], 0
    for start, end in merged:
        out.append(raw[at : begins[start]])
        at = begins[end] if end < len(begins) else len(raw)
    out.append(raw[at:])
    return {"text": b"".join(out).decode(), "n_removed": sum(b - a for a, b in merged), "spans": merged}


@F.arrow_udf(CUT)
def _cuts(raws: pa.Array, runs: pa.Array) -> pa.Array:
    made = [_cut(r, c) for r, c in zip(raw_texts(raws), runs.to_pylist(), strict=True)]
    return pa.array(made, type=to_arrow_type(CUT))


def with_cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column, and its name: the text left, the number of words removed, and
    the removed word ranges; null for a text without a repeated passage.

    Rows with a null id or text are left as they are, and so is every text without a repeated
    passage, to the byte. Rows that share id and text are one document and do not delete each
    other. Texts that share an id are documents of their own, in the order of their hashes. A
    text whose every word repeats becomes empty; its row stays.
    """
    plain = {c: "text" if c == text_col else f"c{i}" for i, c in enumerate(docs.columns)}
    doc = F.coalesce(F.col(plain[id_col]).cast("long"), F.lit(NO_DOC))
    texts = docs.toDF(*plain.values()).select(
        *plain.values(), doc.alias("doc"), F.xxhash64("text").alias("sig")
    )
    joined = texts.join(repeated_runs(texts).hint("shuffle_hash"), TEXT_KEY, "left")
    cut = _cuts(F.when(F.col("runs").isNotNull(), F.col("text")), "runs")
    name = fresh(docs.columns, "cut")
    return joined.select(*plain.values(), cut.alias("cut")).toDF(*docs.columns, name), name


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``n_chars``, if there, follows."""
    made, name = with_cuts(docs)
    cut = F.col(name)
    changed = {"text": F.coalesce(cut["text"], F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length(cut["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.coalesce(length, F.col("n_chars"))
    return made.select(*(changed[c].alias(c) if c in changed else c for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: how many words went, and the text that is left."""
    made, name = with_cuts(docs.select("doc_id", "text"))
    cut = F.col(name)
    return made.select(
        "doc_id", F.coalesce(cut["n_removed"], F.lit(0)).alias("n_removed"), F.coalesce(cut["text"], "text").alias("text")
    )


#: DuckDB SQL for ``report``: every span of 50 words against its first occurrence.
SQL = rf"""
WITH docs AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    string_split_regex(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS spaces
  FROM documents),
spans AS (
  SELECT doc_id, i, array_to_string(words[i:i + {SPAN - 1}], ' ') AS t
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {SPAN - 2})) AS i FROM docs)),
ranked AS (
  SELECT doc_id, i, row_number() OVER w AS nth, first_value(doc_id) OVER w AS first_doc, first_value(i) OVER w AS first_i
  FROM spans WINDOW w AS (PARTITION BY t ORDER BY doc_id, i)),
cut AS (
  SELECT doc_id, unnest(range(CASE WHEN first_doc = doc_id THEN greatest(i, first_i + {SPAN}) ELSE i END, i + {SPAN})) AS j
  FROM ranked WHERE nth > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM cut GROUP BY doc_id),
kept AS (
  SELECT doc_id, spaces[1] AS head, j, words[j] || spaces[j + 1] AS t
  FROM (SELECT doc_id, words, spaces, unnest(range(1, len(words) + 1)) AS j FROM docs SEMI JOIN gone USING (doc_id))
  ANTI JOIN cut USING (doc_id, j)),
joined AS (SELECT doc_id, string_agg(t, '' ORDER BY j) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  CASE WHEN js IS NULL THEN text ELSE spaces[1] || coalesce(t, '') END AS text
FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN joined USING (doc_id)
"""
