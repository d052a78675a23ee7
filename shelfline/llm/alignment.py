"""Alignment of two tokenizers' tokens by the byte offsets where tokens of both end.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model that sets a space before the text;
both encode the space and the text. Token lists are composed as fragments. A fragment covers a byte range and
holds the tokens that end in it, with the places where tokens of both end: what comes before the first such place
is its open prefix, what lies between are closed groups, what follows the last is its open suffix. Composing two
neighbours joins the left one's open suffix and the right one's open prefix into one group; that is associative,
with the empty fragment as unit, so fragments may be composed in any grouping.

A text falls into units at every single space between signs that are no white space. No token of either tokenizer
crosses there (B's vocabulary is looked through for that), so a unit's fragment doesn't depend on its
surroundings: a worker keeps the fragments of units it has met. Texts of more than `span` bytes are cut at units
into pieces, dealt over all tasks, encoded there, cut into fragments of `span` bytes (a unit of any length may
cross them) and composed by a tree, FAN neighbours at a time; no task has more than a part of a long text
until the last level, which makes the row of the document.

Memory: a worker keeps fragments of at most KEPT units and KEPT_IDS ids for later texts; beyond that it starts anew.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from shelfline.llm.frames import stored
from shelfline.llm.pieces import chunks
from shelfline.llm.token_count import byte_letters

#: Bytes of a fragment of a long text.
SPAN = 1 << 16
#: Neighbours that one step of the tree composes (twice as many at most, as a piece may end in a short fragment).
FAN = 16
SLICE = 500_000
KEPT = 150_000
KEPT_IDS = 4_000_000
#: Units that the libraries get at a time.
BATCH = 2_000
RESULTS = ("a_ids", "b_ids", "a_sizes", "b_sizes")
#: Neither tokenizer has a token that crosses from a sign to a space and goes on after it.
CUT = re.compile(r"(?<=\S) (?=\S)")
BLANK = "▁"


@dataclass(frozen=True)
class Fragment:
    """Tokens that end in a byte range, and how many of each had ended at every place where both end."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray

    @staticmethod
    def compose(*parts: Fragment) -> Fragment:
        """Neighbours from left to right; none give the empty fragment."""
        at_a = np.cumsum([0, *(len(p.a) for p in parts)])
        at_b = np.cumsum([0, *(len(p.b) for p in parts)])
        empty = np.zeros(0, np.int32)
        return Fragment(
            np.concatenate([empty, *(p.a for p in parts)]), np.concatenate([empty, *(p.b for p in parts)]),
            np.concatenate([empty, *(p.a_cuts + x for p, x in zip(parts, at_a))]).astype(np.int64),
            np.concatenate([empty, *(p.b_cuts + x for p, x in zip(parts, at_b))]).astype(np.int64))

    @property
    def prefix(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens up to the first common end, whose group may have begun before; all tokens if there is none."""
        return (self.a[:self.a_cuts[0]], self.b[:self.b_cuts[0]]) if len(self.a_cuts) else (self.a, self.b)

    @property
    def closed(self) -> tuple[np.ndarray, np.ndarray]:
        """Sizes, in tokens of A and of B, of the groups between the first and the last common end."""
        return np.diff(self.a_cuts), np.diff(self.b_cuts)

    @property
    def suffix(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens after the last common end, of a group that the next fragment may close."""
        return (self.a[self.a_cuts[-1]:], self.b[self.b_cuts[-1]:]) if len(self.a_cuts) else (self.a[:0], self.b[:0])


def _gather(values: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of `values` that `codes` name, one after another, and their lengths."""
    starts = ends[codes]
    lengths = ends[codes + 1] - starts
    done = np.cumsum(lengths)
    return values[np.repeat(starts - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)], lengths


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for one in lists for x in one), np.int32, int(counts.sum())), counts


class Aligner:
    """Both tokenizers, and the fragments of the units met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        # Special strings inside a text are then ordinary text.
        self.a.encode_special_tokens = True
        if self.a.normalizer is not None or "ByteLevel(add_prefix_space=False" not in str(self.a.pre_tokenizer):
            raise ValueError("not a plain byte-level BPE file")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in pieces):
            raise ValueError("tokens of this model go on after a space: texts can't be cut there")
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(byte[x] for x in t) if all(x in byte for x in t) else t.encode() for t in tokens]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Bits of an id of B in the number of a link.
        self.bits = len(pieces).bit_length()
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.same = np.zeros(0, bool)
        # Of a, b, group sizes in a and in b: values and where each unit's end, with a leading 0.
        self.values = [np.zeros(0, np.int32) for _ in range(4)]
        self.ends = [np.zeros(1, np.int64) for _ in range(4)]

    def learn(self, units: list[str]) -> None:
        """Encodes units and groups their tokens. A unit whose tokens don't spell it has none."""
        ids_a, ids_b = [], []
        # The library's result of a unit is large beside its ids.
        for at in range(0, len(units), BATCH):
            some = units[at:at + BATCH]
            ids_a += [x.ids for x in self.a.encode_batch_fast([" " + u for u in some], add_special_tokens=False)]
            ids_b += self.b.encode(some, num_threads=1)
        same = np.zeros(len(units), bool)
        for i, unit in enumerate(units):
            want = b" " + unit.encode()
            same[i] = (b"".join([self.bytes_a[x] for x in ids_a[i]]) == want
                       and b"".join([self.bytes_b[x] for x in ids_b[i]]) == want)
            if not same[i]:
                ids_a[i], ids_b[i] = [], []
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        # Both spell the same bytes, so offsets into all units together are common to both.
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        cut_a, cut_b = np.searchsorted(end_a, common) + 1, np.searchsorted(end_b, common) + 1
        last_a = np.cumsum(n_a)
        groups = np.diff(np.searchsorted(cut_a, last_a, side="right"), prepend=0)
        for k, (x, n) in enumerate(((a, n_a), (b, n_b), (np.diff(cut_a, prepend=0), groups), (np.diff(cut_b, prepend=0), groups))):
            self.values[k] = np.concatenate([self.values[k], x.astype(np.int32)])
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(n)])
        base = len(self.code)
        self.code.update((unit, base + i) for i, unit in enumerate(units))
        self.same = np.concatenate([self.same, same])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """For each text whether its tokens spell it; the four lists of RESULTS of all texts one after another;
        how many of these each text has."""
        cut = [CUT.split(text) if text else [] for text in texts]
        seen = set().union(*cut)
        new = [unit for unit in seen if unit not in self.code]
        if new and self.code and (len(self.code) + len(new) > KEPT or len(self.values[0]) > KEPT_IDS):
            self.clear()
            new = list(seen)
        if new:
            self.learn(new)
        n_units = np.fromiter(map(len, cut), np.int64, len(cut))
        codes = np.fromiter((self.code[unit] for units in cut for unit in units), np.int64, int(n_units.sum()))
        text_of = np.repeat(np.arange(len(cut)), n_units)
        same = (n_units > 0) & (np.bincount(text_of[~self.same[codes]], minlength=len(cut)) == 0)
        codes, text_of = codes[same[text_of]], text_of[same[text_of]]
        values, counts = [], []
        for k in range(4):
            x, lengths = _gather(self.values[k], self.ends[k], codes)
            values.append(x)
            counts.append(np.bincount(text_of, weights=lengths, minlength=len(cut)).astype(np.int64))
        return same, values, counts

    def links(self, lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The last ids of A and B of each group as one number, of 4 bytes if all such numbers fit."""
        (a, _), (b, _), (size_a, _), (size_b, _) = lists
        found = (a[np.cumsum(size_a) - 1].astype(np.int64) << self.bits) | b[np.cumsum(size_b) - 1]
        return found.astype("<i4" if len(self.bytes_a) << self.bits <= 1 << 31 else "<i8")

    def fragments(self, text: str, start: int, span: int) -> Iterator[tuple[int, bool, Fragment]]:
        """Fragments of `span` bytes of a piece of a text that begins at byte `start`: (first byte, spelt, fragment)."""
        same, (a, b, size_a, size_b), _ = self.align([text])
        if not same[0]:
            yield start, False, Fragment.compose()
            return
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut_a, cut_b = np.cumsum(size_a), np.cumsum(size_b)
        borders = np.append(np.arange(0, end_a[-1], span), end_a[-1])
        in_a, in_b, in_cuts = (np.searchsorted(x, borders, side="right") for x in (end_a, end_b, end_a[cut_a - 1]))
        for k in range(len(borders) - 1):
            own = slice(in_cuts[k], in_cuts[k + 1])
            yield start + int(borders[k]), True, Fragment(
                a[in_a[k]:in_a[k + 1]], b[in_b[k]:in_b[k + 1]], cut_a[own] - in_a[k], cut_b[own] - in_b[k])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One a Python worker: it outlives the tasks that the worker runs."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def pieces(text: str, span: int) -> Iterator[tuple[int, str]]:
    """A text cut at units into pieces of at least `span` characters, with their first bytes (a space each)."""
    at = first = 0
    while at <= len(text):
        end = CUT.search(text, at + span)
        piece = text[at:end.start() if end else len(text)]
        yield first, piece
        if not end:
            return
        at, first = end.end(), first + 1 + len(piece.encode())


INTS = ArrayType(IntegerType())
FRAGMENTS = StructType([
    StructField("doc", LongType()), StructField("at", LongType()), StructField("same", BooleanType()),
    StructField("a", INTS), StructField("b", INTS), StructField("a_cuts", INTS), StructField("b_cuts", INTS),
])
ARROW_FRAGMENTS = pa.schema([
    ("doc", pa.int64()), ("at", pa.int64()), ("same", pa.bool_()),
    *((name, pa.list_(pa.int32())) for name in ("a", "b", "a_cuts", "b_cuts")),
])


def _rows(found: list[tuple[int, int, bool, Fragment]]) -> dict[str, pa.Array]:
    doc, at, same, parts = zip(*found)
    lists = lambda get: pa.array([get(p) for p in parts], pa.list_(pa.int32()))
    return {
        "doc": pa.array(doc, pa.int64()), "at": pa.array(at, pa.int64()), "same": pa.array(same, pa.bool_()),
        "a": lists(lambda p: p.a), "b": lists(lambda p: p.b),
        "a_cuts": lists(lambda p: p.a_cuts.astype(np.int32)), "b_cuts": lists(lambda p: p.b_cuts.astype(np.int32)),
    }


def _compose(table: pa.Table) -> pa.Table:
    table = table.sort_by("at").combine_chunks()
    column = lambda name: [np.asarray(x.values) for x in table.column(name)]
    parts = [Fragment(*x) for x in zip(*(column(name) for name in ("a", "b", "a_cuts", "b_cuts")))]
    same = all(table.column("same").to_pylist())
    whole = Fragment.compose(*parts) if same else Fragment.compose()
    first = (table.column("doc")[0].as_py(), table.column("at")[0].as_py(), same, whole)
    return pa.table(_rows([first]), schema=ARROW_FRAGMENTS)


def _long(rows: DataFrame, path_a: str, path_b: str, span: int) -> DataFrame:
    """(row, RESULTS) of texts of more than `span` bytes, composed by the tree."""
    spark = rows.sparkSession
    numbered = stored(rows.withColumn("doc", F.monotonically_increasing_id()), "long")
    longest = numbered.agg(F.max(F.octet_length("text"))).first()[0] or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for at, piece in pieces(text.as_py(), span):
                    yield pa.RecordBatch.from_pydict({"doc": [doc], "at": [at], "text": [piece]})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for doc, at, text in zip(*(batch.column(i) for i in range(3))):
                for first, same, part in own.fragments(text.as_py(), at.as_py(), span):
                    yield pa.RecordBatch.from_pydict(_rows([(doc.as_py(), first, same, part)]), schema=ARROW_FRAGMENTS)

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.select("doc", "text").mapInArrow(cut, "doc long, at long, text string").repartition(width, "doc", "at")
    parts, reach = dealt.mapInArrow(encode, FRAGMENTS), span
    while True:
        reach *= FAN
        parts = parts.groupBy("doc", F.floor(F.col("at") / F.lit(reach)).alias("block")).applyInArrow(_compose, FRAGMENTS)
        if reach > longest:
            break
    # Sizes of groups are the steps between the places where both tokenizers end.
    steps = lambda c: F.transform(c, lambda x, i: x - F.when(i > 0, F.get(c, i - 1)).otherwise(0))
    # Written first: a Python worker after another in one task would double the workers that an executor keeps.
    whole = stored(parts, "composed").select("doc", "a", "b", steps(F.col("a_cuts")).alias("a_sizes"), steps(F.col("b_cuts")).alias("b_sizes"))
    return numbered.select("doc", "row").join(whole, "doc").select(
        "row", F.col("a").alias("a_ids"), F.col("b").alias("b_ids"), "a_sizes", "b_sizes")


def _rows_of(df: DataFrame, text: str, keep: list[str] | None, span: int) -> tuple[list[str], DataFrame, DataFrame]:
    """The columns to keep, and (row, text) of texts up to `span` bytes, null ones too, and of longer ones."""
    kept = [c for c in (keep or df.columns) if c not in RESULTS]
    rows = df.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
    long = F.coalesce(F.octet_length("text") > span, F.lit(False))
    return kept, rows.filter(~long), rows.filter(long)


def _aligned(batches: Iterator[pa.RecordBatch], own: Aligner) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]]:
    """Of batches (row, text): rows, and the values and lengths of their RESULTS, in slices."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for first, last in chunks(texts, SLICE):
            _, values, counts = own.align(texts[first:last])
            yield batch.column(0).slice(first, last - first), list(zip(values, counts))


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None,
          span: int = SPAN) -> DataFrame:
    """Adds a_ids and b_ids, the tokens of the space and the whole text, and a_sizes and b_sizes, how many of them
    each group has: a group ends where tokens of both end.

    Null and empty texts, and texts that the tokens of either don't spell byte for byte, have empty lists. The
    columns of `keep` (default all) and repeated rows stay; a column named like a result is replaced. An
    empty table gives an empty table. Long texts may stand in any number of tasks, a single unit of a text (a run
    without a space between other signs) is encoded by one.
    """
    kept, short, long = _rows_of(df, text, keep, span)
    schema = StructType([short.schema["row"], *(StructField(name, INTS) for name in RESULTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, lists in _aligned(batches, aligner(path_a, path_b)):
            made = [
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(x, pa.int32()))
                for x, n in lists]
            yield pa.RecordBatch.from_arrays([rows, *made], schema.names)

    both = short.mapInArrow(run, schema).unionByName(_long(long, path_a, path_b, span))
    return both.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *RESULTS)


#: What `linked` says of a document, besides its links: numbers of tokens and groups, and the SHA-256 of the groups
#: written as `a1,a2|b1;a3|b2,b3`. Without tokens the numbers are 0 and the text is empty.
SUMMARY = (("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("groups_sha256", StringType()))
#: What `scored` adds: links, those whose count is the highest of their B id, and the sum of the counts of all.
SCORES = ("n_links", "n_best", "count_sum")


def linked(df: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None,
           span: int = SPAN) -> DataFrame:
    """What the counts need of `align`, in less space. Two kinds of rows: of documents, `row` (the columns of `keep`), SUMMARY
    and `links`, for each group its last ids of A and B as one number of 4 or 8 bytes; and of links, with `row` null, their
    number `link` and how often a task met it, `n`. Ids that end together are linked; each group has one such pair."""
    _, short, long = _rows_of(df, text, keep, span)
    schema = StructType([
        StructField("row", short.schema["row"].dataType), *(StructField(*x) for x in SUMMARY), StructField("links", BinaryType()),
        *(StructField(name, LongType()) for name in ("link", "b", "n"))])

    def summed(slices: Iterator[tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]], own: Aligner) -> Iterator[pa.RecordBatch]:
        keys, counts, kind = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for rows, lists in slices:
            kind = rows.type
            links, n_groups = own.links(lists), lists[2][1]
            found, n = np.unique(links, return_counts=True)
            keys, place = np.unique(np.concatenate([keys, found]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(n_groups)])
            packed = [links[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])]
            nothing = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows, *(pa.array(x, pa.int64()) for x in (lists[0][1], lists[1][1], n_groups)), pa.array(_digests(lists), pa.string()),
                 pa.array(packed, pa.binary()), nothing, nothing, nothing], schema.names)
        if kind:
            nulls = [pa.nulls(len(keys), t) for t in (kind, *[pa.int64()] * 3, pa.string(), pa.binary())]
            own_b = keys & ((1 << own.bits) - 1)
            yield pa.RecordBatch.from_arrays(
                [*nulls, *(pa.array(x.astype(np.int64)) for x in (keys, own_b, counts))], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        yield from summed(_aligned(batches, own), own)

    def run_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A long text at a time.
        single = (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows))
        yield from summed(((one.column(0), _lists(one)) for one in single), aligner(path_a, path_b))

    return short.mapInArrow(run, schema).unionByName(_long(long, path_a, path_b, span).mapInArrow(run_long, schema))


def _lists(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values and lengths of the RESULTS of a batch."""
    found = [batch.column(batch.schema.get_field_index(name)) for name in RESULTS]
    return [(np.asarray(x.flatten()), np.asarray(x.value_lengths())) for x in found]


def link_counts(rows: DataFrame) -> DataFrame:
    """(link, n, best) of stored rows of `linked`: how many links of all documents are this one, and whether no other A id has
    more links with its B id.

    Linked ids end in the same bytes, one being a suffix of the other, so there are no more different links than bytes in the
    tokens of both vocabularies (twice those of B, as a byte may be spelt two ways), however large the corpus is.
    """
    counts = rows.filter("link IS NOT NULL").groupBy("link", "b").agg(F.sum("n").alias("n"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def shared_counts(counts: DataFrame) -> Broadcast:
    """The table of `link_counts` for all tasks; `link_counts` says what bounds its size."""
    table = counts.toArrow()
    keys, n, best = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("link", "n", "best"))
    order = np.argsort(keys)
    return counts.sparkSession.sparkContext.broadcast((keys[order], n[order].astype(np.int64), best[order].astype(bool)))


def scored(rows: DataFrame, counts: Broadcast) -> DataFrame:
    """Documents of stored rows of `linked`: row, SUMMARY and SCORES."""
    docs = rows.filter("link IS NULL").select("row", *(name for name, _ in SUMMARY), "links")
    schema = StructType([*docs.schema.fields[:-1], *(StructField(name, LongType()) for name in SCORES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, best = counts.value
        for batch in batches:
            made = []
            for packed, n in zip(batch.column(len(schema) - len(SCORES)), batch.column(3).to_pylist()):
                raw = packed.as_buffer()
                place = np.searchsorted(keys, np.frombuffer(raw, f"<i{raw.size // n}")) if n else np.zeros(0, np.int64)
                made.append((n, int(best[place].sum()), int(times[place].sum())))
            found = [pa.array(x, pa.int64()) for x in zip(*made)] if made else [pa.array([], pa.int64())] * len(SCORES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], schema.names)

    return docs.mapInArrow(run, schema)


_words: dict[int, np.ndarray] = {}


def _spelt(most: int) -> np.ndarray:
    """Decimal ids with what follows them: `,`, `|`, `;` or nothing, at 4 * id + kind."""
    if most not in _words:
        _words[most] = np.array([b"%d%s" % (i, end) for i in range(most) for end in (b",", b"|", b";", b"")], object)
    return _words[most]


def _digests(lists: list[tuple[np.ndarray, np.ndarray]]) -> list[str]:
    (a, n_a), (b, n_b), (size_a, _), (size_b, n_groups) = lists
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    kind_a, kind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    kind_a[end_a - 1], kind_b[end_b - 1] = 1, 2
    kind_b[np.cumsum(n_b)[n_b > 0] - 1] = 3
    # A group's tokens of A stand before its tokens of B.
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = 4 * a.astype(np.int64) + kind_a
    order[np.arange(len(b)) + np.repeat(end_a, size_b)] = 4 * b.astype(np.int64) + kind_b
    # In steps of 65,536 ids, so that few tables are made.
    most = (int(max(a.max(initial=0), b.max(initial=0))) // 65_536 + 1) * 65_536
    words = _spelt(most)[order].tolist()
    ends = np.concatenate([[0], np.cumsum(n_a + n_b)])
    return [
        hashlib.sha256(b"".join(words[x:y])).hexdigest() if y > x else "" for x, y in zip(ends[:-1], ends[1:])]
