"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark.

Words are hashed to 64 bits. Workers count the pairs of a chunk of training text in sorted arrays
and deal them out by a hash of the first word (by a hash of the pair for the few words that are
frequent enough to fill more than their share of a shard). Each shard of pairs is merged and
written as a sorted array of pair hashes with their counts; what it knows of its words goes on to
the shards of words, which become sorted arrays too. Scoring workers map these files into memory
and look the pairs of a chunk of texts up in order, so that a text is neither shuffled nor held
against a model in heap memory.

The files lie in the shared folder (``spark.checkpoint.dir``), reached through pyarrow's file
systems; where it is no mounted folder, a worker copies a file to its temporary folder before it
maps it. A task that runs again writes the same bytes to the same names.
"""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import built_once, remainder, slices
from alertlake.session import scratch_path

FOLDS, HELD_OUT = 7, 2
TOKENS_AT_ONCE = 2 << 20
SHARDS_PER_PARTITION = 4
#: Shards of pairs for each shard of words. Each of the former sends a row to each of the latter.
PAIR_SHARDS_PER_WORD_SHARD = 16
#: Rows (in the mean) that are looked at to find frequent words; this only balances the shards.
ROWS_FOR_BALANCE = 20_000

#: No word has white space, so no word is one of these.
END, BEGIN = (xxhash.xxh64_intdigest(x) for x in (b"\n", b"\n\n"))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(before * _ODD + word)


def tokens_of(raw: bytes | None) -> list[int]:
    """Hashes of the lower-cased words, then the end token."""
    digest = xxhash.xxh64_intdigest
    return [*(digest(w) for w in (raw or b"").lower().split()), END]


@dataclass(frozen=True)
class Layout:
    """Where the files are and which shard a word or a pair belongs to."""

    root: str
    shards: int
    frequent: tuple[int, ...]

    @property
    def n_word_shards(self) -> int:
        return max(1, self.shards // PAIR_SHARDS_PER_WORD_SHARD)

    def of_words(self, words: np.ndarray) -> np.ndarray:
        return (_mixed(words) % np.uint64(self.n_word_shards)).astype(np.int64)

    def of_pairs(self, before: np.ndarray, keys: np.ndarray) -> np.ndarray:
        spread = np.isin(before, np.array(self.frequent, np.uint64))
        return np.where(spread, keys % np.uint64(self.shards), _mixed(before) % np.uint64(self.shards)).astype(np.int64)

    def place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root if "://" in self.root else "file://" + self.root.removeprefix("file:"))

    def put(self, name: str, array: np.ndarray) -> None:
        system, root = self.place()
        system.create_dir(root, recursive=True)
        held = io.BytesIO()
        np.save(held, array)
        part = f"{root}/{name}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part) as out:
            out.write(held.getbuffer())
        system.move(part, f"{root}/{name}.npy")


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Ids, tokens and lengths of texts up to about TOKENS_AT_ONCE; the columns are (id, text)."""
    ids, tokens, lengths, n = [], [], [], 0
    for part in slices(batches):
        for doc, raw in zip(part.column(0), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
            mine = np.array(tokens_of(raw), np.uint64)
            ids.append(doc)
            tokens.append(mine)
            lengths.append(len(mine))
            n += len(mine)
            if n >= TOKENS_AT_ONCE:
                yield ids, np.concatenate(tokens), np.array(lengths)
                ids, tokens, lengths, n = [], [], [], 0
    if ids:
        yield ids, np.concatenate(tokens), np.array(lengths)


def _before(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.r_[0, np.cumsum(lengths)[:-1]]] = BEGIN
    return out


def _starts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.empty(0, np.int64)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64)


_PAIRS = "shard int, before binary, n binary, word binary, count binary"
_WORDS = "shard int, context binary, numbers binary, word binary, counts binary, of_counts array<bigint>"
_TOTALS = "kind string, shard int, tokens bigint, words bigint, contexts bigint, of_counts array<bigint>"


def _pairs(layout: Layout):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, lengths in _chunks(batches):
            before = _before(tokens, lengths)
            keys, at, count = np.unique(pair_keys(before, tokens), return_index=True, return_counts=True)
            before, word = before[at], tokens[at]
            shard = layout.of_pairs(before, keys)
            order = np.lexsort((before, shard))
            before, word, count, shard = before[order], word[order], count[order], shard[order]
            cuts = _starts(shard)
            for a, b in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                new = _starts(before[a:b])
                columns = (
                    before[a:b][new],
                    np.diff(np.r_[new, b - a]).astype(np.uint32),
                    word[a:b],
                    count[a:b].astype(np.uint32),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[a])], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in columns)],
                    names=["shard", "before", "n", "word", "count"],
                )

    return run


def _joined(rows: pd.Series, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in rows]) if len(rows) else np.empty(0, kind)


def _of_counts(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == i).sum()) for i in range(1, 5)]


def _merge_pairs(layout: Layout):
    """Writes a shard of pairs; gives its words to the shards of words, and its counts of counts."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        before = np.repeat(_joined(rows.before, np.uint64), _joined(rows.n, np.uint32))
        word = _joined(rows.word, np.uint64)
        count = _joined(rows["count"], np.uint32).astype(np.int64)
        keys = pair_keys(before, word)
        order = np.argsort(keys)
        keys = keys[order]
        new = _starts(keys)
        count = np.add.reduceat(count[order], new)
        keys, before, word = keys[new], before[order][new], word[order][new]
        many = np.flatnonzero(count > 255)
        layout.put(f"pairs-{shard}", keys)
        layout.put(f"counts-{shard}", np.minimum(count, 255).astype(np.uint8))
        layout.put(f"many-{shard}", np.stack([many, count[many]]).astype(np.int64))

        contexts, at = np.unique(before, return_inverse=True)
        size = len(contexts)
        numbers = np.stack(
            [np.bincount(at, count, size), *(np.bincount(at[m], minlength=size) for m in (count == 1, count == 2, count > 2))],
            axis=1,
        ).astype(np.int64)
        words, at = np.unique(word, return_inverse=True)
        counts = np.stack([np.bincount(at, count, len(words)), np.bincount(at, minlength=len(words))], axis=1).astype(np.int64)
        context_shard, word_shard = layout.of_words(contexts), layout.of_words(words)
        out = []
        by_context, by_word = np.argsort(context_shard, kind="stable"), np.argsort(word_shard, kind="stable")
        ends = np.arange(layout.n_word_shards + 1)
        a = np.searchsorted(context_shard[by_context], ends)
        b = np.searchsorted(word_shard[by_word], ends)
        for k in range(layout.n_word_shards):
            c, w = by_context[a[k] : a[k + 1]], by_word[b[k] : b[k + 1]]
            if len(c) or len(w):
                packed = (contexts[c], _small(numbers[c]), words[w], _small(counts[w]))
                out.append((k, *(x.tobytes() for x in packed), None))
        out.append((-1 - shard, b"", b"", b"", b"", _of_counts(count)))
        return pd.DataFrame(out, columns=["shard", "context", "numbers", "word", "counts", "of_counts"])

    return run


def _table(rows: pd.DataFrame, key: str, values: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values by key; a row's values are 4 or 8 bytes wide each."""
    keys = _joined(rows[key], np.uint64)
    parts = []
    for k, v in zip(rows[key], rows[values], strict=True):
        n = len(k) // 8
        wide = n and len(v) // (n * width) == 8
        parts.append(np.frombuffer(v, np.uint64 if wide else np.uint32).reshape(-1, width).astype(np.int64))
    sums = np.concatenate(parts) if parts else np.empty((0, width), np.int64)
    order = np.argsort(keys)
    new = _starts(keys[order])
    return keys[order][new], np.add.reduceat(sums[order], new, axis=0) if len(new) else sums[:0]


def _merge_words(layout: Layout):
    """Writes a shard of words: count, kinds of words before, and as a context its count and how
    many pairs of it have count 1, 2 and more."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        columns = ["kind", "shard", "tokens", "words", "contexts", "of_counts"]
        if shard < 0:
            return pd.DataFrame([("pairs", -1 - shard, 0, 0, 0, list(rows.of_counts.iloc[0]))], columns=columns)
        contexts, numbers = _table(rows, "context", "numbers", 4)
        words, counts = _table(rows, "word", "counts", 2)
        keys = np.union1d(contexts, words)
        table = np.zeros((len(keys), 6), np.int64)
        table[np.searchsorted(keys, words), :2] = counts
        table[np.searchsorted(keys, contexts), 2:] = numbers
        layout.put(f"words-{shard}", keys)
        layout.put(f"table-{shard}", _small(table))
        of = [*_of_counts(counts[:, 1]), int((counts[:, 1] > 2).sum())]
        return pd.DataFrame(
            [("words", shard, int(counts[:, 0].sum()), len(words), int(counts[:, 1].sum()), of)], columns=columns
        )

    return run


def discounts(of_counts: list[int]) -> np.ndarray:
    """What is taken off counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4.

    Where the estimate is not defined, or not between 0 and the count, 0.5, 1 and 1.5 are taken.
    """
    n1, n2, n3, n4 = of_counts[:4]
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 <= d <= i for i, d in enumerate(found, 1)):
            return np.array([0.0, *found])
    return np.array([0.0, 0.5, 1.0, 1.5])


@dataclass(frozen=True)
class Model:
    """A trained model; its arrays are in the files of the layout."""

    layout: Layout
    word_shards: frozenset[int]
    pair_shards: frozenset[int]
    tokens: int
    words: int
    pairs: int
    word_discounts: tuple[float, ...]
    pair_discounts: tuple[float, ...]
    #: Words seen after one, two, and more kinds of words.
    kinds: tuple[int, int, int]

    def rest(self) -> float:
        """The share of the word distribution that is spread over all words and the unknown one."""
        if not self.pairs:
            return 1.0
        return float(np.dot(self.word_discounts[1:], self.kinds)) / self.pairs


class Arrays:
    """The files of a model, mapped into memory when first asked for."""

    def __init__(self, layout: Layout) -> None:
        self.system, self.root = layout.place()
        self.open: dict[str, np.ndarray] = {}
        self.copies = None
        if not isinstance(self.system, fs.LocalFileSystem):
            self.copies = tempfile.mkdtemp(prefix="ngram-")
            atexit.register(shutil.rmtree, self.copies, ignore_errors=True)

    def get(self, name: str) -> np.ndarray:
        if name not in self.open:
            path = f"{self.root}/{name}.npy"
            if self.copies:
                own = os.path.join(self.copies, f"{name}.npy")
                with self.system.open_input_stream(path) as source, open(own, "wb") as out:
                    shutil.copyfileobj(source, out)
                path = own
            self.open[name] = np.load(path, mmap_mode="r")
        return self.open[name]


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and whether each is there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.arrays = model, Arrays(model.layout)

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        cuts = _starts(shard[order])
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            yield int(shard[order[a]]), order[a:b]

    def words(self, wanted: np.ndarray) -> np.ndarray:
        """The rows of the word table for ascending distinct words; zeros for unknown ones."""
        out = np.zeros((len(wanted), 6), np.int64)
        for shard, at in self._by_shard(self.model.layout.of_words(wanted)):
            if shard in self.model.word_shards:
                place, there = _found(self.arrays.get(f"words-{shard}"), wanted[at])
                out[at[there]] = self.arrays.get(f"table-{shard}")[place[there]]
        return out

    def pairs(self, before: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for shard, at in self._by_shard(self.model.layout.of_pairs(before, keys)):
            if shard in self.model.pair_shards:
                place, there = _found(self.arrays.get(f"pairs-{shard}"), keys[at])
                count = self.arrays.get(f"counts-{shard}")[place].astype(np.int64)
                many = self.arrays.get(f"many-{shard}")
                if many.shape[1]:
                    where, big = _found(many[0], place)
                    count[big] = many[1][where[big]]
                out[at[there]] = count[there]
        return out

    def logs(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: its training count, the base logarithm and the model's."""
        m = self.model
        before = _before(tokens, lengths)
        wanted, at = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        table = self.words(wanted)
        at, at_before = at[: len(tokens)], at[len(tokens) :]
        count = table[at, 0]
        base = np.log10((count + 1) / (m.tokens + m.words + 1))

        d1, d2 = np.array(m.word_discounts), np.array(m.pair_discounts)
        kinds = table[:, 1]
        known = (kinds - d1[np.minimum(kinds, 3)]) / max(m.pairs, 1)
        word = known + m.rest() / (m.words + 1)
        total = table[:, 2]
        left = (table[:, 3:] @ d2[1:]) / np.maximum(total, 1)

        keys, first, back = np.unique(pair_keys(before, tokens), return_index=True, return_inverse=True)
        pairs = self.pairs(before[first], keys)[back]
        here = total[at_before]
        seen = (pairs - d2[np.minimum(pairs, 3)]) / np.maximum(here, 1) + left[at_before] * word[at]
        return count, base, np.log10(np.where(here > 0, seen, word[at]))


def fit(docs: DataFrame) -> Model:
    """A model of the texts of ``docs`` (id, text); nulls are empty texts, which have an end token."""
    spark = docs.sparkSession
    shards = SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = docs.select("id", F.coalesce("text", F.lit("")).alias("text"))
    n = text.count()
    few = text.sample(min(1.0, ROWS_FOR_BALANCE / n) if n else 1.0, seed=1)
    split = few.select(F.explode(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+")).alias("w"))
    counts = split.where("w <> ''").groupBy("w").count()
    top = counts.orderBy(F.desc("count")).limit(4 * shards).collect()
    all_ = counts.agg(F.sum("count")).first()[0] or 0
    share = all_ / (4 * shards)
    frequent = [xxhash.xxh64_intdigest(r.w.encode()) for r in top if r["count"] > share]
    layout = Layout(scratch_path(spark, "ngram-model"), shards, tuple(sorted([*frequent, BEGIN])))

    pairs = text.mapInArrow(_pairs(layout), _PAIRS)
    words = pairs.groupBy("shard").applyInPandas(_merge_pairs(layout), _WORDS)
    totals = words.groupBy("shard").applyInPandas(_merge_words(layout), _TOTALS).collect()  # a row for each shard

    of_pairs = np.sum([[0] * 4, *(r.of_counts for r in totals if r.kind == "pairs")], axis=0)
    own = [r for r in totals if r.kind == "words"]
    of_words = np.sum([[0] * 5, *(r.of_counts for r in own)], axis=0)
    return Model(
        layout,
        frozenset(r.shard for r in own),
        frozenset(r.shard for r in totals if r.kind == "pairs"),
        sum(r.tokens for r in own),
        sum(r.words for r in own),
        sum(r.contexts for r in own),
        tuple(discounts(list(of_words))),
        tuple(discounts(list(of_pairs))),
        (int(of_words[0]), int(of_words[1]), int(of_words[4])),
    )


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) for each row of (id, text)."""
    schema = T.StructType(
        [
            docs.schema["id"],
            *(T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(x, T.DoubleType()) for x in ("base_score", "score", "perplexity")),
        ]
    )
    kind = pa.int64() if isinstance(docs.schema["id"].dataType, T.LongType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = built_once(("ngrams", model.layout.root), lambda: Scorer(model))
        for ids, tokens, lengths in _chunks(batches):
            count, base, log = scorer.logs(tokens, lengths)
            at = np.r_[0, np.cumsum(lengths)[:-1]]
            total = np.add.reduceat(log, at)
            columns = [
                pa.array(ids, kind),
                pa.array(lengths.astype(np.int64)),
                pa.array(np.add.reduceat((count > 0).astype(np.int64), at)),
                pa.array(np.full(len(at), model.tokens, np.int64)),
                pa.array(np.add.reduceat(base, at)),
                pa.array(total),
                pa.array(10 ** (-total / lengths)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("id", "text").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text); rows of remainder HELD_OUT are not learnt from."""
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    model = fit(texts.where(remainder("id", FOLDS) != HELD_OUT))
    made = scores(texts, model)
    return made.select(
        F.col("id").alias("doc_id"),
        (remainder("id", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "perplexity",
    )
