"""Exact removal of repeated byte strings, by a depth-limited radix sort over digits of falling coarseness.

Every 400-byte window of every text is to be sorted by content, only as deep as 400 bytes, and windows in groups
of two or more are the repeated ones. The digits are chosen so that most windows never become rows:

1. A window's first digit is its minimizer, the 100-byte string in it with the smallest hash. Neighbouring windows
   share it, so a run of windows (about 150) is one row. Equal windows have equal minimizers at equal offsets.
2. The second digit is the string that all windows of a cell, CELL neighbouring offsets from the minimizer, have
   in common.
3. The last digit is the window itself.

Each pass groups rows by the digits so far. A group of one is unique and leaves the sort. Rows of a group whose
whole stretch is equal are repeated in full and marked; one row of each different stretch goes on to the next
pass, to be told apart from the others. Groups are counts by hash, combined map-side: no group is ever gathered.

Equal texts are one class, sorted once; a class with two texts is repeated throughout. The classes are written
once as a table bucketed by class, so that later passes bring rows to the texts and never shuffle a text again.
Strings are compared by 128-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.frames import stored, unused
from shelfline.session import run_dir

LENGTH = 400
GRAM = 100
CELL = 32
#: Windows of one text that are hashed at a time: bounds memory for very long texts.
SEGMENT = 1 << 20

# An odd base modulo 2^64, its inverse follows; the multiplier of a 64-bit mixer.
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            factors = np.full(size, base & (1 << 64) - 1, np.uint64)
            factors[0] = 1
            _powers.append(np.multiply.accumulate(factors))
        del _powers[:-2]
    return _powers[0][:n], _powers[1][:n]


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of each `gram`-byte string of the data, in order of its start."""
    n = len(data)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, by running minima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1:n])


def minimizer_runs(data: bytes, length: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, number of windows, place of their minimizer, its hash) for runs of windows that share
    a minimizer, over all windows of the data."""
    low = np.uint64((1 << 31) - 1)
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin:begin + SEGMENT + length - 1]
        hashes = gram_hashes(part, gram)
        # The place breaks ties to the left, alike in equal windows.
        packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        at = (window_minima(packed, length - gram + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        counts = np.diff(np.concatenate([first, [len(at)]]))
        for p, n, a, h in zip(first.tolist(), counts.tolist(), at[first].tolist(), hashes[at[first]].view(np.int64).tolist()):
            yield begin + p, n, begin + a, h


ROWS = "digit binary, whole binary, id binary, first int, n int, anchor int"


def _emit(texts: DataFrame, rows_of: Callable[..., Iterator[tuple]]) -> DataFrame:
    """Rows (digit, whole, id, first, n, anchor) from rows (id, text, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digit", "whole", "id", "first", "n", "anchor"]
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            made = (out for row in zip(*batch.columns) for out in rows_of(*(x.as_py() for x in row)))
            while some := list(islice(made, 20_000)):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)

    return texts.mapInArrow(run, ROWS)


def _digest(data: bytes, seed: int = 0) -> bytes:
    return xxhash.xxh3_128_digest(data, seed=seed & (1 << 64) - 1)


def _first_pass(length: int, gram: int) -> Callable[..., Iterator[tuple]]:
    def rows_of(name: bytes, text: bytes) -> Iterator[tuple]:
        for p, n, a, h in minimizer_runs(text, length, gram):
            yield h.to_bytes(8, "little", signed=True), _digest(text[p:p + n - 1 + length], a - p), name, p, n, a
    return rows_of


def _cell_pass(length: int, cell: int) -> Callable[..., Iterator[tuple]]:
    def rows_of(name: bytes, text: bytes, runs: list[dict]) -> Iterator[tuple]:
        for run in runs:
            p, n, a = run["first"], run["n"], run["anchor"]
            # Offsets of the anchor in the windows fall from a - p; cells lie on a grid of offsets.
            for c in range((a - p - n + 1) // cell, (a - p) // cell + 1):
                top, bottom = min(a - p, c * cell + cell - 1), max(a - p - n + 1, c * cell)
                # Each window of the cell, taken or not, holds these bytes.
                common = text[a - c * cell:a - c * cell - cell + 1 + length]
                yield (_digest(common, c), _digest(text[a - top:a - bottom + length], top * length + bottom),
                       name, a - top, top - bottom + 1, a)
    return rows_of


def _window_pass(length: int) -> Callable[..., Iterator[tuple]]:
    def rows_of(name: bytes, text: bytes, runs: list[dict]) -> Iterator[tuple]:
        for run in runs:
            for p in range(run["first"], run["first"] + run["n"]):
                digest = _digest(text[p:p + length])
                yield digest, digest, name, p, 1, run["anchor"]
    return rows_of


def _repeated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of one pass: the rows whose whole stretch is repeated, and those that go on."""
    # Counts are written first: joins of plain tables can split a frequent digit or stretch.
    shared = stored(rows.groupBy("digit").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("digit"), "digits")
    left = stored(rows.join(shared, "digit"), "radix")
    kinds = stored(left.groupBy("digit", "whole").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "first", "n", "anchor")).alias("row")), "stretches")
    marked = left.join(kinds.filter("copies > 1").select("digit", "whole"), ["digit", "whole"]).select("id", "first", "n")
    many = stored(kinds.groupBy("digit").agg(F.count(F.lit(1)).alias("_kinds")).filter("_kinds > 1").select("digit"), "forks")
    onward = kinds.join(many, "digit").select("row.*")
    return marked, onward


def _with_texts(texts: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Texts with the rows that refer to them; only rows are shuffled."""
    gathered = rows.groupBy("id").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "id"])).alias(name))
    return texts.join(gathered.hint("shuffle_merge"), "id").select("id", "text", name)


def _classes(df: DataFrame, text: str, own: str) -> tuple[DataFrame, DataFrame]:
    """Each row's key and class, and the distinct texts as bytes, bucketed by class."""
    spark: SparkSession = df.sparkSession
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    name = F.substring(F.unhex(F.sha2(data, 256)), 1, 16)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = f"texts_{uuid.uuid4().hex}"
    distinct = df.select(name.alias("id"), data.alias("text")).dropDuplicates(["id"])
    writer = distinct.repartition(width, "id").write.bucketBy(width, "id").sortBy("id")
    writer.format("parquet").option("path", run_dir(spark, "texts")).saveAsTable(label)
    return df.select("*", name.alias(own)), spark.table(label)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, cell: int = CELL) -> DataFrame:
    """Rows (id, first, n): every window of `length` bytes that starts at first .. first + n - 1 of the
    text has an equal one elsewhere among the different texts (id, text)."""
    marked, runs = _repeated(_emit(texts.select("id", "text"), _first_pass(length, gram)))
    found = [marked]
    for rows_of in (_cell_pass(length, cell), _window_pass(length)):
        marked, runs = _repeated(_emit(_with_texts(texts, runs, "runs"), rows_of))
        found.append(marked)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(df: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, cell: int = CELL,
                   spans: str = "removed", kept: str = "kept") -> DataFrame:
    """Adds `spans`, the maximal runs of bytes (start, end) covered by a `length`-byte string that starts
    anywhere else too, and `kept`, the other bytes of the text.

    Texts are taken as UTF-8 bytes, null as empty; a text shorter than `length` loses nothing. Repeated rows
    and equal texts repeat each other throughout. Other columns stay; one named like a result is replaced.
    An empty table gives an empty table.
    """
    rest = df.drop(spans, kept)
    own, cut_of = unused(rest, "_id", "_class")
    rows, texts = _classes(rest, text, own)
    windows = stored(repeated_spans(texts, length, gram, cell), "repeats")
    copies = rows.groupBy(F.col(own).alias("id")).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    gathered = windows.groupBy("id").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    every = texts.join(gathered.hint("shuffle_merge"), "id", "left").join(
        copies.hint("shuffle_merge"), "id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            removed, left = [], []
            for data, runs, n in zip(*(batch.column(c) for c in (1, 2, 3))):
                data, n = data.as_py(), n.as_py()
                cuts: list[dict] = []
                if n and len(data) >= length:
                    cuts = [{"start": 0, "end": len(data)}]
                else:
                    for x in sorted(runs.as_py() or (), key=lambda x: x["first"]):
                        start, end = x["first"], x["first"] + x["n"] - 1 + length
                        if cuts and start <= cuts[-1]["end"]:
                            cuts[-1]["end"] = max(end, cuts[-1]["end"])
                        else:
                            cuts.append({"start": start, "end": end})
                edges = [0, *(e for c in cuts for e in (c["start"], c["end"])), len(data)]
                removed.append(cuts)
                left.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, span), pa.array(left, pa.binary())], [cut_of, spans, kept])

    cut = every.select("id", "text", "runs", "_copies").mapInArrow(
        run, f"`{cut_of}` binary, `{spans}` array<struct<start:int,end:int>>, `{kept}` binary")
    return rows.join(cut, F.col(own) == F.col(cut_of)).drop(own, cut_of)


def size_of(spans: str | Column) -> Column:
    """Bytes in all runs."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["start"]))
