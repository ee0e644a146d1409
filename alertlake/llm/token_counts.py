"""Token counts by byte-pair merging with a heap and a linked list.

A word's symbols form a linked list; the heap holds its adjacent pairs by merge rank. The pair of
lowest rank, the leftmost of equals, is merged until none is left. The count is the number of
first symbols minus the number of merges; no token ids are given out. Normalisation (NFC, lower
case) and the cutting into words follow the vocabulary's file. The file is read once on the
driver (under 2 MB, a fixed size) and broadcast.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections import Counter
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.byte_bpe import byte_symbols
from alertlake.llm.common import built_once, fresh, with_computed

WORDS_AT_ONCE = 1 << 16
REMEMBERED = 500_000
LIMIT = 2048


class Counts:
    """Counts tokens with one vocabulary; remembers the counts of words."""

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        model = spec["model"]
        steps = spec["normalizer"]["normalizers"]
        split, by_bytes = spec["pre_tokenizer"]["pretokenizers"]
        if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or by_bytes["type"] != "ByteLevel":
            raise ValueError("this vocabulary normalises in another way")
        if model["type"] != "BPE" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("this vocabulary cuts words in another way")
        self.word = regex.compile(split["pattern"]["Regex"])
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.suffix = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.ids = ids
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(map(self._pair, model["merges"]))}
        self.symbols = byte_symbols()
        self.known: dict[str, int] = {}

    @staticmethod
    def _pair(merge: str | list[str]) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def of_word(self, word: str) -> int:
        """First symbols minus merges."""
        marks = [self.symbols[b] for b in word.encode()]
        marks[-1] += self.suffix
        at = [self.ids[m] for m in marks]
        n = len(at)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if (hit := merges.get((at[i], at[i + 1]))) is not None:
                heap.append((hit[0], i, at[i], at[i + 1], hit[1]))
        heapify(heap)
        done = 0
        while heap:
            _, i, left, right, made = heappop(heap)
            j = after[i]
            if at[i] != left or j >= n or at[j] != right:
                continue  # one of the two is no longer what it was
            at[i], at[j] = made, -1
            done += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (hit := merges.get((made, at[k]))) is not None:
                    heappush(heap, (hit[0], i, made, at[k], hit[1]))
            h = before[i]
            if h >= 0 and (hit := merges.get((at[h], made))) is not None:
                heappush(heap, (hit[0], h, at[h], made, hit[1]))
        return n - done

    def _of_plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Lower case is taken character by character; only the final sigma depends on its place.
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        found = (m.group() for m in self.word.finditer(text))
        total = 0
        while part := list(islice(found, WORDS_AT_ONCE)):
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            for w, n in Counter(part).items():
                count = known.get(w)
                if count is None:
                    count = known[w] = self.of_word(w)
                total += n * count
        return total

    def of_text(self, text: str | None) -> int:
        """Tokens of a text; each special string in it is one token, as the library's default is."""
        if not text:
            return 0
        if self.special is None:
            return self._of_plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._of_plain(x) for x in parts)


def with_counts(docs: DataFrame, path: str, name: str = "n_tokens", text_col: str = "text") -> DataFrame:
    """``docs`` with the long column ``name``; null and empty texts have no tokens.

    Rows and other columns stay; ``name`` must not be a column already.
    """
    with open(path, "rb") as f:
        raw = f.read()
    given = docs.sparkSession.sparkContext.broadcast(raw)
    key = ("counts", hashlib.sha256(raw).hexdigest())

    def compute(texts: pa.Array) -> list[int]:
        counts = built_once(key, lambda: Counts(given.value))
        return [counts.of_text(x) for x in texts.to_pylist()]

    return with_computed(docs, name, T.LongType(), [text_col], compute)


def report(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    name = fresh(["doc_id", "text"], "n_tokens")
    made = with_counts(docs.select("doc_id", "text"), path, name)
    return made.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        name,
        (F.col(name) > limit).alias("over_limit"),
    )
