"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A unit vector is turned by a random rotation; the signs of its coordinates are its code. The inner product of
the code (as a unit vector) with the turned vector is stored as the correction factor: an inner product with the
code, divided by the factor, is an unbiased estimate of the inner product with the vector, with an error whose
spread the factor gives, less the nearer the two vectors are. The other vector of a pair takes part with its turned
coordinates in 16 levels, whose rounding adds to the spread. Pairs whose estimate plus EPSILON spreads is below the
threshold either way round are dropped; the others fetch their vectors and are computed again in double precision.

Which pairs are looked at: bits of further rotations make tables of buckets. With n vectors, a bucket key has
about log2(n / 16) bits, and there are as many tables as make a pair right at the threshold share no bucket with
probability MISSED. Equal vectors count once. Buckets hold codes, not vectors. A bucket of more than BLOCK vectors is
dealt out as pairs of blocks, so nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.components import components
from shelfline.llm.frames import stored

COSINE = 0.9
MISSED = 0.001
EPSILON = 4.0
BLOCK = 512
SEED = 20_240_521


def plan_tables(n: int, cosine: float = COSINE, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a bucket key and number of tables for n vectors."""
    same = 1 - math.acos(cosine) / math.pi
    bits = max(8, math.ceil(math.log2(max(n, 1) / 16)))
    return bits, math.ceil(math.log(missed) / math.log(1 - same**bits))


@lru_cache(maxsize=16)
def rotations(dim: int, count: int) -> np.ndarray:
    """`count` random orthogonal matrices, the same in every task."""
    drawn = np.random.default_rng((SEED, dim)).standard_normal((count, dim, dim))
    return np.linalg.qr(drawn)[0]


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if null, empty, zero or not finite throughout."""
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    most = np.abs(x).max()
    if not np.isfinite(x).all() or most == 0:
        return None
    x = x / most + 0.0
    return x / np.sqrt(x @ x)


def _nodes(df: DataFrame, key: str, vector: str) -> DataFrame:
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x.as_py() for x in batch.column(1)]
            units = [unit(x) for x in raw]
            # Vectors are named by their given values, so only equal ones share a node.
            names = [None if u is None else xxhash.xxh3_128_digest((np.asarray(x, np.float64) + 0.0).tobytes()) for u, x in zip(units, raw)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.binary()), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())],
                ["key", "node", "unit"])

    return df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).mapInArrow(run, f"key {kind}, node binary, unit binary")


def _bit_rows(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket keys, one column a table, from the signs under further rotations than the code's."""
    dim = units.shape[1]
    turned = units @ np.concatenate(rotations(dim, 1 + math.ceil(bits * tables / dim))[1:], axis=1)
    signs = (turned[:, : bits * tables] > 0).reshape(len(units), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def sketches(units: np.ndarray) -> np.ndarray:
    """One row of bytes a vector: factor, lowest level and step as 32-bit floats, the code's bits, then the turned
    coordinates as four-bit levels."""
    dim = units.shape[1]
    turned = units @ rotations(dim, 1)[0]
    factor = np.abs(turned).sum(1) / math.sqrt(dim)
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / 15, 1e-30)
    levels = np.rint((turned - low[:, None]) / step[:, None]).clip(0, 15).astype(np.uint8)
    levels = np.pad(levels, ((0, 0), (0, dim % 2)))
    numbers = np.stack([factor, low, step], axis=1).astype(np.float32).view(np.uint8)
    return np.concatenate([numbers, np.packbits(turned > 0, axis=1), levels[:, ::2] << 4 | levels[:, 1::2]], axis=1)


def estimates(rows: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of each sketch (row, by its code) with each (column, by its levels), and their
    spreads for vectors at right angles; the part that rounding adds comes squared as the third result."""
    factor, low, step = np.ascontiguousarray(rows[:, :12]).view(np.float32).astype(float).T
    ends = 12 + (dim + 7) // 8
    codes = np.where(np.unpackbits(rows[:, 12:ends], axis=1, count=dim), 1.0, -1.0) / math.sqrt(dim)
    levels = np.stack([rows[:, ends:] >> 4, rows[:, ends:] & 15], axis=2).reshape(len(rows), -1)[:, :dim]
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
    rounding = step[None, :] ** 2 / 12 / factor[:, None] ** 2
    return codes @ (levels * step[:, None] + low[:, None]).T / factor[:, None], spread, rounding


def likely(rows: np.ndarray, dim: int, own: np.ndarray, other: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sketches `own` x `other` that the bounds leave possible, both ways round."""
    guess, spread, rounding = estimates(rows, dim)
    # The code's error stands at right angles to the vector: a pair at the threshold sees its sine only.
    error = np.sqrt((1 - cosine**2) * spread[:, None] ** 2 + rounding)
    maybe = guess + EPSILON * error >= cosine - 1e-6
    i, j = np.nonzero((maybe & maybe.T)[np.ix_(own, other)])
    return own[i], other[j]


def _bucketed(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Rows (bucket, dim, node, sketch), one a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, units = batch.column(0), batch.column(1)
            dims = np.array([len(u) // 8 for u in units.to_pylist()])
            for dim in np.unique(dims):
                some = pa.array(np.flatnonzero(dims == dim))
                vectors = np.frombuffer(b"".join(units.take(some).to_pylist())).reshape(-1, dim)
                keys = _bit_rows(vectors, bits, tables)
                rows = pa.array([r.tobytes() for r in sketches(vectors)], pa.binary())
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[:, t] * tables + t), pa.array(np.full(len(some), dim, np.int32)), node.take(some), rows],
                        ["bucket", "dim", "node", "sketch"])

    return nodes.select("node", "unit").mapInArrow(run, "bucket bigint, dim int, node binary, sketch binary")


def _candidates(ordered: DataFrame, cosine: float) -> DataFrame:
    """Rows (bucket, dim, first, second, block, node, sketch) in order of the first four to pairs (a, b), a < b."""

    def compare(rows: list[tuple]) -> tuple[list[bytes], list[bytes]]:
        _, dim, first, second = rows[0][:4]
        block = np.array([r[4] for r in rows])
        data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1)
        i, j = likely(data, dim, np.flatnonzero(block == first), np.flatnonzero(block == second), cosine)
        names = [r[5] for r in rows]
        pairs = [sorted((names[x], names[y])) for x, y in zip(i.tolist(), j.tolist()) if first != second or x < y]
        return [p[0] for p in pairs], [p[1] for p in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            a, b = compare(rows) if len(rows) > 1 else ([], [])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if waiting and waiting[0][:4] != row[:4]:
                    yield from made(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield from made(waiting)

    return ordered.mapInArrow(run, "a binary, b binary")


def _exact(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) whose vectors reach the threshold in double precision."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("unit").alias(f"u_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "u_a", "u_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            products = [np.frombuffer(x) @ np.frombuffer(y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(np.array(products) >= cosine, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def links(nodes: DataFrame, cosine: float = COSINE, missed: float = MISSED) -> DataFrame:
    """Pairs (a, b) of the different vectors in (node, unit) whose cosine is at least `cosine`."""
    bits, tables = plan_tables(nodes.count(), cosine, missed)
    members = _bucketed(nodes, bits, tables)
    sizes = members.groupBy("bucket", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    # Stored, so that Spark knows the size: few buckets are large, and then codes are shuffled once.
    large = stored(sizes.filter("blocks > 1"), "large-buckets")
    dealt = members.join(large, ["bucket", "dim"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    each = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select(
        "bucket", "dim", F.least("block", "_with").alias("first"), F.greatest("block", "_with").alias("second"),
        "block", "node", "sketch")
    width = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unit = ["bucket", "dim", "first", "second"]
    ordered = each.repartition(width, *unit).sortWithinPartitions(*unit)
    pairs = stored(_candidates(ordered, cosine).distinct(), "vector-pairs")
    return _exact(pairs, nodes, cosine)


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Rows (key, n_links, component_id, kept), one per input row.

    n_links counts the other rows at cosine `cosine` or more, equal vectors included; component_id is the
    smallest key that links reach. Vectors that are null, empty or zero, or hold null or non-finite
    components, and those of another length, link with nothing; they keep their own key and are kept. Null
    keys count as rows; a component of null keys has a null id and is kept. Repeated rows are equal vectors.
    Other columns are not carried, so their names can't clash. An empty table gives an empty table.
    """
    rows = stored(_nodes(df, key, vector), "vectors")
    nodes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")), "vector-nodes")
    found = stored(links(nodes, cosine), "vector-links")
    both = found.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        found.select(F.col("b").alias("node"), F.col("a").alias("other")))
    copies = nodes.select(F.col("node").alias("other"), "copies")
    counts = both.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("others"))
    labelled = nodes.join(components(found), "node", "left").join(counts, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "root").select(F.col("node").alias("_node"), "n_links", "component_id")
    joined = rows.select("key", "node").join(classes, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept"))
