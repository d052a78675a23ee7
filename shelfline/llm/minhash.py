"""Near duplicates by HyperMinHash sketches, banding, and confirmation on full shingle sets.

A document's set holds the hashes of its 5-word shingles. A hash's first bits choose one of 128 buckets; a bucket's
register keeps its smallest hash as the number of leading zeros and ten bits of mantissa, 16 bits in all. Four
registers in a row make a band; documents that share a band are candidates. Candidates whose Jaccard estimate,
corrected for chance collisions of registers, is clearly too low are put aside, and all others are compared on
their full sets. Documents with equal sets count as one node, so copies never meet pair by pair.

No band is expanded into pairs. The nodes of a band are first compared with one of them, the one whose bands are
the most frequent: of many edits of a text, that is the nearest to the original. Most bands are connected after
that. In the others, nodes of different components are compared block by block on their registers, inside a task,
first for the best partner of each node outside the block's largest component, then, for what is still apart, for
all pairs that neither the registers nor the sets' smallest hashes rule out. Sets of up to LOWEST shingles have all
their hashes there, so of such sets only true links become rows. A band with more than CROSS such comparisons a node is
dealt out again by a second band before, so that nodes that agree in one frequent passage only part ways. The second
band is one of the same 32 or of 32 others, of registers that lie far apart, so that a pair with no other band in
common is met there too.

With 32 bands of four, a pair at similarity 0.75 has no band in common with probability 5e-6. It has one only with
probability 8e-5, and then, by a rough count, none of the 32 others in 0.2% of cases: that adds 2e-7 at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from shelfline.llm.components import components
from shelfline.llm.frames import stored

WORDS = 5
BUCKET_BITS = 7
MANTISSA = 10
ROWS = 4
BANDS = (1 << BUCKET_BITS) // ROWS
#: Nodes of a block.
BLOCK = 512
#: Smallest hashes of a set that go with its registers into a block.
LOWEST = 1024
#: Comparisons a node of a band that are made before the band is split by a second one.
CROSS = 4096
#: Standard errors that an estimate may fall short of the threshold by before a pair is put aside.
ERRORS = 4.5
PERCENT = 75

# Odd multipliers that tell the places of a shingle apart, and the finisher of a 64-bit mixer.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's 5-word shingles, A-Z taken as a-z; a text of one to four
    words has one, for the whole sequence, and a text without words none."""
    # On bytes, lower() changes A-Z alone and split() cuts at ASCII white space alone.
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    h = each[:n] * PLACES[0]
    for k in range(1, WORDS):
        h += each[k:k + n] * PLACES[k]
    for m in MIX:
        h ^= h >> np.uint64(33)
        h *= m
    h ^= h >> np.uint64(33)
    return np.unique(h)


def registers(sorted_hashes: np.ndarray) -> np.ndarray:
    """One 16-bit register a bucket, 0 if empty: leading zeros + 1, then the bits after the leading one."""
    out = np.zeros(1 << BUCKET_BITS, np.uint16)
    bucket = sorted_hashes >> np.uint64(64 - BUCKET_BITS)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for i in first:
        rest = (int(sorted_hashes[i]) << BUCKET_BITS) & 0xFFFFFFFFFFFFFFFF
        zeros = min(64 - rest.bit_length(), 62)
        tail = (rest << (zeros + 1)) & 0xFFFFFFFFFFFFFFFF
        out[bucket[i]] = (zeros + 1) << MANTISSA | tail >> (64 - MANTISSA)
    return out


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, corrected for registers that agree by chance, and how many
    registers are filled. For sets much larger than the number of buckets, two unrelated registers agree
    with probability 0.1699 * 4r / (1 + r)^2 / 2^mantissa for sizes in the ratio r."""
    filled = ((a > 0) | (b > 0)).sum(1)
    agree = ((a == b) & (a > 0)).sum(1)
    ratio = n_a / np.maximum(n_b, 1)
    chance = 0.169919 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    return (agree / np.maximum(filled, 1) - chance) / (1 - chance), filled


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, mark, node, n, registers): node names the shingle set and is null for an empty one."""
    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([xxhash.xxh3_128_digest(u.tobytes()) if len(u) else None for u in found], pa.binary()),
                pa.array([len(u) for u in found], pa.int64()),
                pa.array([registers(u).tobytes() for u in found], pa.binary()),
            ], ["key", "mark", "node", "n", "registers"])

    return rows.mapInArrow(run, f"key {kind}, mark bigint, node binary, n bigint, registers binary")


def full_sets(rows: DataFrame) -> DataFrame:
    """Rows (node, text) to rows (node, items), the shingle hashes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py()).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "items"])

    return rows.select("node", "text").mapInArrow(run, "node binary, items array<bigint>")


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether register rows leave the threshold possible: the estimate is at most ERRORS standard errors
    below it, and the smaller set is large enough for the larger one."""
    return _possible(*estimates(a, b, n_a, n_b), n_a, n_b)


def _possible(value: np.ndarray, filled: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    share = PERCENT / 100
    # Filled registers are a sample of the union without replacement: of a small union they are nearly all.
    union = np.maximum((n_a + n_b) / (1 + share), filled + 1)
    error = np.sqrt(share * (1 - share) / np.maximum(filled, 1) * (union - filled) / (union - 1))
    near = value >= share - ERRORS * error - 2 / np.maximum(filled, 1)
    return near & (100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b))


def bands(nodes: DataFrame) -> DataFrame:
    """Rows (key, band, node): the bands of each node, none of empty registers only."""
    width = 2 * ROWS
    each = F.array(*[F.substring("registers", i * width + 1, width) for i in range(BANDS)])
    return nodes.select("node", F.posexplode(each).alias("band", "cut")).filter(
        F.col("cut") != F.lit(bytes(width))).select(F.xxhash64("cut", "band").alias("key"), "band", "node")


def far_bands(nodes: DataFrame) -> DataFrame:
    """Rows (key, node): as `bands`, of every BANDS-th register instead of neighbours."""
    each = F.array(*[F.concat(*[F.substring("registers", 2 * (i + k * BANDS) + 1, 2) for k in range(ROWS)]) for i in range(BANDS)])
    return nodes.select("node", F.posexplode(each).alias("band", "cut")).filter(
        F.col("cut") != F.lit(bytes(2 * ROWS))).select(F.xxhash64("cut", F.col("band") + BANDS).alias("key"), "node")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that the registers don't rule out."""
    side = lambda c: nodes.select(
        F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                r_a, r_b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in (4, 5))
                n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array(likely(r_a, r_b, n_a, n_b)))

    return both.mapInArrow(run, "a binary, b binary")


class _Lowest:
    """The smallest hashes of the sets of a block, for estimates of one set against others.

    Hashes are kept as their 31 leading bits; two that agree there count as equal, which can only raise an estimate."""

    def __init__(self, parts: list[np.ndarray], n: np.ndarray):
        self.n = n
        self.lengths = np.array([len(p) for p in parts])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        values, self.places = np.unique(np.concatenate(parts), return_inverse=True)
        self.whole = self.lengths >= n
        # Beyond its limit a set's hashes are unknown.
        self.limits = np.where(self.whole, len(values), self.places[self.starts + self.lengths - 1])
        self.own = np.zeros(len(values), bool)

    def possible(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether set i may reach the threshold with each of `others`, and their estimates."""
        mine = self.places[self.starts[i]:self.starts[i] + self.lengths[i]]
        self.own[mine] = True
        common = np.add.reduceat(self.own[self.places], self.starts, dtype=np.int64)[others]
        self.own[mine] = False
        theirs = np.add.reduceat(self.places <= self.limits[i], self.starts, dtype=np.int64)[others]
        seen = np.searchsorted(mine, self.limits[others], side="right") + theirs - common
        value = common / np.maximum(seen, 1)
        exact = self.whole[i] & self.whole[others]
        near = _possible(value, seen, np.full(len(others), self.n[i]), self.n[others])
        return np.where(exact, 100 * common >= PERCENT * seen, near), value


def _by_unit(rows: DataFrame, compare: Callable[[list[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """What `compare` makes of all rows of each unit, the first column, together."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def made(unit: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = compare(unit)
            while some := list(islice(found, 10_000)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), arrow.types)], schema.names)

        for batch in batches:
            columns = [
                (x.values.to_numpy() for x in c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if waiting and waiting[0][0] != row[0]:
                    yield from made(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield from made(waiting)

    return rows.repartition(width, "unit").sortWithinPartitions("unit").mapInArrow(run, schema)


class _Unit:
    """Rows (unit, second, alone, node, root, n, registers, ...) of one unit."""

    def __init__(self, rows: list[tuple]):
        self.roots = np.unique([r[4] for r in rows], return_inverse=True)[1]
        self.registers = np.frombuffer(b"".join(r[6] for r in rows), np.uint16).reshape(len(rows), -1)
        self.n = np.array([r[5] for r in rows], float)
        self.side, self.alone = np.array([r[1] for r in rows]), rows[0][2]

    def estimates(self, i: int, others: np.ndarray) -> np.ndarray:
        own = np.broadcast_to(self.registers[i], (len(others), self.registers.shape[1]))
        return estimates(own, self.registers[others], np.full(len(others), self.n[i]), self.n[others])[0]

    def partners(self, i: int, once: bool = False) -> np.ndarray:
        """Rows of other components that the registers leave possible for row i: of the same block, or of the other one if
        the unit has two. With `once`, each pair comes from one of its rows only."""
        where = self.roots != self.roots[i]
        if not self.alone:
            where &= (self.side != self.side[i]) & (not once or not self.side[i])
        elif once:
            where &= np.arange(len(where)) > i
        others = np.flatnonzero(where)
        if len(others):
            own = np.broadcast_to(self.registers[i], (len(others), self.registers.shape[1]))
            others = others[likely(own, self.registers[others], np.full(len(others), self.n[i]), self.n[others])]
        return others


def _crossing(members: DataFrame, nodes: DataFrame, sets: DataFrame, best: bool) -> DataFrame:
    """Pairs (a, b) of different components in rows (key, m, node, root), m nodes having the key, that registers
    and smallest hashes leave possible; with `best`, only the likeliest partner of each node that isn't in the
    largest component of its blocks.

    A key is dealt out as pairs of blocks of BLOCK nodes or so, each compared in one step of a task: first on registers alone, then, for
    nodes that have a possible partner left in the unit, on their smallest hashes too.
    """
    dealt = members.withColumn("blocks", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.join(nodes.select("node", "n", "registers"), "node")
    each = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws("-", "key", F.least("block", "_with"), F.greatest("block", "_with")).alias("unit"),
        (F.col("block") > F.col("_with")).cast("int").alias("second"), (F.col("block") == F.col("_with")).alias("alone"),
        "node", "root", "n", "registers")

    def hopeful(rows: list[tuple]) -> Iterator[tuple]:
        unit, some = _Unit(rows), np.zeros(len(rows), bool)
        if unit.roots.max() > 0 and best:
            # Where one partner of each is sought, the one of the highest estimate by registers.
            largest = np.bincount(unit.roots).argmax()
            for i in np.flatnonzero(unit.roots != largest):
                others = unit.partners(i)
                if len(others):
                    some[i] = some[others[unit.estimates(i, others).argmax()]] = True
        elif unit.roots.max() > 0:
            # Partners of a node are marked with it and not looked at again, so units of near copies cost little here.
            for i in range(len(rows)):
                if not some[i]:
                    others = unit.partners(i)
                    some[others] = True
                    some[i] = len(others) > 0
        yield from (rows[i] for i in np.flatnonzero(some))

    def compare(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        unit = _Unit(rows)
        if unit.roots.max() == 0:
            return
        largest = np.bincount(unit.roots).argmax()
        lowest = _Lowest([r[7] for r in rows], unit.n)
        # The best partner is sought from both ends.
        for i in np.flatnonzero(unit.roots != largest) if best else range(len(rows)):
            others = unit.partners(i, once=not best)
            if len(others):
                near, value = lowest.possible(i, others)
                found, value = others[near], value[near]
                for j in found[[value.argmax()]] if best and len(found) else found:
                    yield rows[i][3], rows[j][3]

    # Items are sorted, so the first are the smallest.
    smallest = F.transform(F.slice("items", 1, LOWEST), lambda h: F.shiftrightunsigned(h, 33).cast("int"))
    left = stored(_by_unit(each, hopeful, each.schema), "hopeful")
    whole = left.join(sets.select("node", smallest.alias("lowest")), "node").select(*each.columns, "lowest")
    ends = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])
    pairs = _by_unit(whole, compare, ends)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("items").alias(f"i_{c}"))
    common = F.size(F.array_intersect("i_a", "i_b"))
    pairs = stored(pairs, "pairs")
    both = pairs.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", common.alias("common"), (F.size("i_a") + F.size("i_b")).alias("sizes"))
    return stored(both.filter(100 * F.col("common") >= PERCENT * (F.col("sizes") - F.col("common"))).select("a", "b"), "confirmed")


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (key, m, cross, node, root) of the keys in (key, node) whose nodes aren't all connected; cross
    is the number of pairs of different components."""
    owned = members.join(components(links), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    owned = stored(owned, "owned")
    shares = owned.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    counts = shares.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("within"))
    counts = counts.withColumn("cross", (F.col("m") * F.col("m") - F.col("within")) / 2).filter("cross > 0").drop("within")
    # Written first: joins of plain tables can split a frequent key.
    return stored(owned.join(stored(counts, "open-keys"), "key"), "open")


def near_links(nodes: DataFrame, documents: DataFrame, cross: int = CROSS) -> DataFrame:
    """Confirmed links (a, b) between nodes (node, rep, n, registers): enough to connect whatever links
    connect. Texts come from (key, mark, text) by `rep`, once, for nodes that share a band with another."""
    keyed = bands(nodes)
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "band-sizes")
    shared = stored(keyed.join(sizes, "key"), "shared-bands")
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    wanted = stored(weights.join(nodes.select("node", "rep"), "node"), "shared-nodes")
    found = wanted.select("node", F.col("rep.key").alias("_key"), F.col("rep.mark").alias("_mark")).join(
        documents, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_mark") == F.col("mark")))
    sets = stored(full_sets(found).dropDuplicates(["node"]), "sets")

    hubs = shared.join(wanted.select("node", "weight"), "node").groupBy("key").agg(
        F.max(F.struct("weight", "node")).getField("node").alias("hub"))
    star = shared.join(stored(hubs, "hubs"), "key").filter("node <> hub").select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    links = _confirmed(_likely(star, nodes), sets)

    members = shared.select("key", "node")
    for depth in (1, 2):
        unsettled = _open(members, links)
        if unsettled.isEmpty():
            break
        heavy = F.col("cross") > cross * F.col("m") if depth == 1 else F.lit(False)
        links = links.unionByName(_confirmed(_crossing(unsettled.filter(~heavy), nodes, sets, True), sets))
        unsettled = _open(members, links)
        links = links.unionByName(_confirmed(_crossing(unsettled.filter(~heavy), nodes, sets, False), sets))
        split = unsettled.filter(heavy)
        if split.isEmpty():
            break
        again = shared.select("node", "key").unionByName(
            far_bands(nodes.join(split.select("node").distinct(), "node", "left_semi")).select("node", "key"))
        members = stored(
            split.select(F.col("key").alias("first"), "node").join(again.select("node", F.col("key").alias("second")), "node")
            .filter("first <> second").select(F.xxhash64("first", "second").alias("key"), "node"), "second-bands")
    return links


def _grouped(df: DataFrame, key: str, text: str, cross: int) -> tuple[DataFrame, DataFrame]:
    """The signatures, and rows (node, rep, least, root) of the shingle sets, root naming the component."""
    rows = stored(signatures(df, key, text), "signatures")
    documents = df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    # Structs are in order of their fields: a null key comes last.
    first = F.struct(F.col("key").isNull().alias("none"), "key", "mark")
    nodes = stored(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.min(first).alias("rep"), F.min("key").alias("least"),
            F.first("n").alias("n"), F.first("registers").alias("registers")), "nodes")
    roots = components(near_links(nodes, documents, cross))
    return rows, nodes.join(roots, "node", "left").select("node", "rep", "least", F.coalesce("root", "node").alias("root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", cross: int = CROSS) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept), one per input row.

    component_id is the smallest key that links reach, kept whether it is the row's own. Null, empty and
    wordless texts have no shingles, link with nothing and keep their own key. Null keys take part; a
    component of null keys only has a null id and is kept. Repeated rows share a component and, having the
    same key, are all kept or none. Other columns are not carried, so their names can't clash. An empty
    table gives an empty table.
    """
    rows, labelled = _grouped(df, key, text, cross)
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "root").select(F.col("node").alias("_node"), "component_id")
    joined = rows.join(classes, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", cross: int = CROSS) -> DataFrame:
    """The input without near copies, its columns as they are: of each component the row with the smallest key
    (null after all others), then the smallest hash of the text, then the smallest other columns.

    Rows without shingles are no copies of anything and all stay, repeated ones too. Keys needn't be unique:
    different texts under one key, or without a key, are rows of their own. Other columns must be of types that
    can be put in order. An empty table gives an empty table.
    """
    rows, labelled = _grouped(df, key, text, cross)
    chosen = labelled.groupBy("root").agg(F.min("rep").alias("rep")).select(
        F.col("rep.key").alias("_key"), F.col("rep.mark").alias("_mark"), F.lit(False).alias("_alone"))
    alone = rows.filter("node IS NULL").select("key", "mark", F.lit(True)).distinct()
    chosen = stored(chosen.unionByName(alone.toDF(*chosen.columns)), "chosen")
    marked = df.select(F.struct("*").alias("_row"), F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_hash"))
    kept = stored(marked.join(chosen, F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_mark"))).select(
        "_row", "_id", "_hash", "_alone"), "kept")
    # One key and text can be several rows still.
    first = kept.filter(~F.col("_alone")).groupBy("_id", "_hash").agg(F.min("_row").alias("_row")).select("_row.*")
    return kept.filter("_alone").select("_row.*").unionByName(first)
