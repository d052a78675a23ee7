"""Token counts by heap and linked list, without building token ids.

A piece starts as one symbol per byte. Neighbouring pairs that have a merge rank wait in a heap; the lowest
rank, leftmost first, is popped, its right symbol is unlinked, and the pairs on both sides of the merged
symbol enter the heap. The count is the number of symbols less the number of merges.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfline.llm.pieces import BYTE_LEVEL, splitter

#: Piece counts kept for later texts; beyond it the store starts empty again.
KEPT = 1_000_000


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: printable Latin-1 bytes
    stand for themselves, the others take code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Counter:
    """Merge ranks of a tokenizer file and the piece counts met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix",
                                               "end_of_word_suffix"))
        if not (model["type"] == "BPE" and plain and spec["normalizer"] is None and cut["type"] == "ByteLevel"
                and cut.get("use_regex", True) and not cut.get("add_prefix_space")):
            raise ValueError("not a plain byte-level BPE file")
        ids = model["vocab"]
        self.start = [ids[letter] for letter in byte_letters()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their surroundings are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.cut = splitter(BYTE_LEVEL)
        self.known: dict[str, int] = {}

    def count_piece(self, piece: str) -> int:
        merges, start = self.merges, self.start
        symbols = [start[b] for b in piece.encode()]
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for at in range(n - 1):
            merge = merges.get((symbols[at], symbols[at + 1]))
            if merge:
                heap.append((merge[0], at, merge[1]))
        heapq.heapify(heap)
        merged = 0
        while heap:
            rank, at, made = heapq.heappop(heap)
            right = after[at]
            # A pair that an earlier merge has changed no longer has this rank.
            if symbols[at] < 0 or right >= n or merges.get((symbols[at], symbols[right]), (-1,))[0] != rank:
                continue
            symbols[at], symbols[right] = made, -1
            after[at] = right = after[right]
            merged += 1
            if right < n:
                before[right] = at
                merge = merges.get((made, symbols[right]))
                if merge:
                    heapq.heappush(heap, (merge[0], at, merge[1]))
            left = before[at]
            if left >= 0:
                merge = merges.get((symbols[left], made))
                if merge:
                    heapq.heappush(heap, (merge[0], left, merge[1]))
        return n - merged

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        pieces, known = self.cut(text), self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) > KEPT:
                known.clear()
            for piece in set(pieces).difference(known):
                known[piece] = self.count_piece(piece)
            return sum(map(known.__getitem__, pieces))


_counters: dict[str, Counter] = {}


def token_counts(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of each whole text, special strings inside a text counting as one token.

    Null and empty texts count 0. Other columns and repeated rows stay; a column already named like the
    result is replaced. An empty table gives an empty table. A piece of n bytes takes about n log n steps,
    however long it is.
    """
    carried = [c for c in df.columns if c != out]
    narrow = df.select(*carried)
    schema = StructType([*narrow.schema.fields, StructField(out, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        count = _counters[path].count
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array([count(x.as_py()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*carried, out])

    # A text column that the result would replace is not there any more: refuse rather than guess.
    if text not in carried:
        raise ValueError("the result can't replace the text column")
    return narrow.mapInArrow(run, schema)


def budget(df: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and whether it exceeds `limit` tokens."""
    counted = token_counts(df, path, text)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return counted.withColumns({"n_bytes": size, "over_limit": F.col("n_tokens") > limit})
