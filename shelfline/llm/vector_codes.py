"""Product codes of vectors, with nearest entries found by slicing and intersecting bit masks.

Components become integers, vectors are cut into PARTS, and each part's codebook of ENTRIES is improved by ROUNDS of assigning
parts to nearest entries and moving entries to the means, all in whole numbers, so that every run gives the same codes.

Nearest entries: for every dimension of a part, the entries' coordinates are sorted, and place k carries the mask, 64 bits, of
the entries at the first k places. The entries within a radius of a component are a range of places, and the mask
at its end less that at its start. These masks, ANDed over the dimensions, name exactly the entries of the box of
that radius; only their distances are computed. If the nearest of them is no farther than the radius, nothing
outside the box is nearer. Otherwise its distance, which bounds the nearest one's, is the next radius; an
empty box is doubled.

A round is one pass over the stored integers. Tasks send sums for each entry, not rows; the driver gets
PARTS x ENTRIES sums a round, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfline.llm.frames import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Larger integers count as this, so that squared distances fit 64 bits.
LIMIT = 1 << 25
RESULTS = ("code", "error", "label_error", "codebooks_sha256")
FAR = np.iinfo(np.int64).max


class Slices:
    """Sorted coordinates of one part's entries and the masks of their prefixes."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask holds 64 entries")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, 0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.concatenate([np.zeros((1, entries.shape[1]), np.uint64), np.bitwise_or.accumulate(bits, axis=0)])
        # The first radius reaches from any entry to its nearest neighbour.
        apart = ((entries[:, None] - entries[None]) ** 2).sum(2)
        np.fill_diagonal(apart, FAR)
        self.radius = int(np.ceil(np.sqrt(float(apart.min(1).max())))) if len(entries) > 1 else 1

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of the entries that are within the radius in every dimension, for each row."""
        mask = np.full(len(x), ~np.uint64(0))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, side="right")
            mask &= self.prefix[high, d] & ~self.prefix[low, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, the lowest of several, and its squared distance."""
        found, distance = np.zeros(len(x), np.int64), np.full(len(x), FAR)
        left, radius = np.arange(len(x)), np.full(len(x), max(self.radius, 1), np.int64)
        while len(left):
            mask, own = self.box(x[left], radius), x[left]
            best, least = np.zeros(len(left), np.int64), np.full(len(left), FAR)
            for e in range(len(self.entries)):
                inside = np.flatnonzero(mask >> np.uint64(e) & np.uint64(1))
                far = ((own[inside] - self.entries[e]) ** 2).sum(1)
                nearer = far < least[inside]
                best[inside[nearer]], least[inside[nearer]] = e, far[nearer]
            done = least <= radius ** 2
            found[left[done]], distance[left[done]] = best[done], least[done]
            some = least < FAR
            radius = np.where(some, np.ceil(np.sqrt(np.where(some, least, 0).astype(float))).astype(np.int64) + 1, radius * 2)[~done]
            left = left[~done]
        return found, distance


class Codebooks:
    """Entries of all parts, as an array of parts x entries x positions."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.slices = [Slices(own) for own in entries]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of vectors as rows x parts x positions: entries and squared distances, rows x parts."""
        pairs = [own.nearest(x[:, p]) for p, own in enumerate(self.slices)]
        return np.stack([a for a, _ in pairs], 1), np.stack([d for _, d in pairs], 1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, keep: list[str]) -> DataFrame:
    """Rows (row, key, label, v) of the vectors that have only finite components, as integers."""
    value = lambda x: F.floor(x.cast("double") * SCALE)
    number = lambda x: F.least(F.greatest(value(x), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int")
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False)))
    return df.filter(whole & (F.size(vector) > 0)).select(
        F.struct(*keep).alias("row"), F.col(key).alias("key"), F.col(label).alias("label"), F.transform(vector, number).alias("v"))


def _vectors(batch: pa.RecordBatch, dim: int, parts: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("v")).flatten()
    return np.asarray(values).astype(np.int64).reshape(batch.num_rows, parts, dim // parts)


def improved(books: Codebooks, vectors: DataFrame) -> Codebooks:
    """One round: entries move to the floor of the mean of their parts, unused ones stay."""
    parts, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            x = _vectors(batch, parts * width, parts)
            slot = books.assign(x)[0] + np.arange(parts) * entries
            n += np.bincount(slot.ravel(), minlength=len(n))
            order = np.argsort(slot.ravel(), kind="stable")
            used, first = np.unique(slot.ravel()[order], return_index=True)
            total[used] += np.add.reduceat(x.reshape(-1, width)[order], first, axis=0) if len(used) else 0
        at = np.repeat(np.arange(len(n)), width)
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(at, pa.int32()), "place": pa.array(np.tile(np.arange(width), len(n)), pa.int32()),
            "total": pa.array(total.ravel()), "n": pa.array(n[at])})

    partial = vectors.select("v").mapInArrow(sums, "slot int, place int, total long, n long")
    entry = books.entries.copy()
    for r in partial.groupBy("slot", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        if r.n:
            entry[r.slot // entries, r.slot % entries, r.place] = r.total // r.n
    return Codebooks(entry)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of stored rows of `whole_vectors`; none without rows. They start as the vectors of the smallest keys, null last,
    equal keys by vector."""
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    dim = len(first[0].v)
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    start = np.array([r.v for r in first if len(r.v) == dim], np.int64)
    books = Codebooks(start.reshape(len(start), parts, dim // parts).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        books = improved(books, vectors.filter(F.size("v") == dim))
    return books


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             keep: list[str] | None = None, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Adds code (two hexadecimal digits a part), error (the sum of the squared distances of the parts to their entries),
    label_error (the error of all rows of the same label, null being one) and codebooks_sha256.

    Vectors that are null, empty or hold null or non-finite components are dropped, as are those of another length than the
    vector of the smallest key. Components count as LIMIT / SCALE at most. Columns of `keep` (default all) and repeated rows
    stay; columns named like a result are replaced. An empty table gives an empty table.
    """
    kept = [c for c in (keep or df.columns) if c not in RESULTS]
    vectors = stored(whole_vectors(df, key, vector, label, kept), "vectors")
    books = train(vectors, parts, entries, rounds)
    dim = books.entries.shape[0] * books.entries.shape[2] if books else 0
    schema = StructType([*(vectors.schema[c] for c in ("row", "label")), StructField("code", StringType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, far = books.assign(_vectors(batch, dim, parts))
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(far.sum(1), pa.int64())], schema.names)

    coded = stored(vectors.filter(F.size("v") == dim).select("row", "label", "v").mapInArrow(run, schema), "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept], "code", "error", "label_error", digest.alias("codebooks_sha256"))
