"""Byte-level BPE encoding and decoding as DuckDB queries inside each partition.

Spark deals the documents out; a Python worker cuts each text into pieces and hands the pieces it has
not met before to one recursive query. There, each token position is a row. A step joins neighbouring
positions with the merge table, takes each piece's lowest-ranked, leftmost pair, and contracts it; a piece
without a mergeable pair leaves the recursion. Decoding joins ids with the vocabulary and aggregates the
bytes in order of position.

Memory: texts are worked on in slices of SLICE characters, the encodings of at most KEPT pieces are kept
for later texts, and beyond that the store starts empty again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from shelfline.llm.pieces import BYTE_LEVEL, chunks, splitter

SLICE = 4_000_000
KEPT = 800_000
#: Longer pieces contract all places of a piece's lowest-ranked pair in a step; see LONG_STEP.
LONG = 64

SYMBOLS = """
CREATE OR REPLACE TEMP TABLE symbols AS
SELECT w, p::int AS p, v.id AS t
FROM (SELECT w, s, unnest(range(length(s))) AS p FROM pieces) x JOIN vocab v ON v.piece = substr(s, p + 1, 1)
"""

#: `best` packs rank, position and the next position, so that one minimum names the leftmost pair.
STEP = """
WITH RECURSIVE step AS (
  SELECT w, p, t, true AS live FROM symbols
  UNION ALL
  SELECT s.w, s.p, CASE WHEN s.p = (best >> 23) & 8388607 THEN (best >> 46)::int ELSE s.t END, best IS NOT NULL
  FROM step s LEFT JOIN (
    SELECT n.w, min((m.rank::bigint << 46) | (n.p::bigint << 23) | n.next_p) AS best
    FROM (SELECT w, p, t, lead(t) OVER o AS next_t, lead(p) OVER o AS next_p
          FROM step WHERE live WINDOW o AS (PARTITION BY w ORDER BY p)) n
    JOIN merges m ON m.a = n.t AND m.b = n.next_t GROUP BY n.w) b ON b.w = s.w
  WHERE s.live AND (best IS NULL OR s.p <> best & 8388607)
)
SELECT w, list(t ORDER BY p) AS ids FROM step WHERE NOT live GROUP BY w ORDER BY w
"""

#: One step contracts every place of the lowest rank, from the left, skipping overlaps (every second pair
#: of a run). That equals contracting one place at a time if no merge makes a pair of lower rank, which
#: holds for a vocabulary whose every token encodes to itself alone (`Engine.consistent`); others keep STEP.
LONG_STEP = """
WITH RECURSIVE step AS (
  SELECT w, p, t, true AS live FROM symbols
  UNION ALL
  SELECT w, p, CASE WHEN taken THEN low ELSE t END, low IS NOT NULL
  FROM (
    SELECT *, lag(taken, 1, false) OVER (PARTITION BY w ORDER BY p) AS gone
    FROM (
      SELECT w, p, t, low,
             at_low AND row_number() OVER (PARTITION BY w, at_low, k - k_low ORDER BY p) % 2 = 1 AS taken
      FROM (
        SELECT *, row_number() OVER (PARTITION BY w, at_low ORDER BY p) AS k_low
        FROM (
          SELECT *, coalesce(rank = low, false) AS at_low
          FROM (
            SELECT n.w, n.p, n.t, n.k, m.rank, min(m.rank) OVER (PARTITION BY n.w) AS low
            FROM (SELECT w, p, t, lead(t) OVER o AS next_t, row_number() OVER o AS k
                  FROM step WHERE live WINDOW o AS (PARTITION BY w ORDER BY p)) n
            LEFT JOIN merges m ON m.a = n.t AND m.b = n.next_t)))))
  WHERE NOT gone
)
SELECT w, list(t ORDER BY p) AS ids FROM step WHERE NOT live GROUP BY w ORDER BY w
"""

#: Tokens come in order of position, and one thread aggregates them as they come. The positions, aggregated beside the bytes, show
#: whether it did; if not, DECODE_SORTED puts them in order first, which takes five times as long.
DECODE = """
SELECT d, string_agg(piece, '') AS s, list(p) AS ps FROM tokens LEFT JOIN vocab ON id = t GROUP BY d ORDER BY d
"""
DECODE_SORTED = """
SELECT d, string_agg(piece, '' ORDER BY p) AS s, list(p ORDER BY p) AS ps FROM tokens LEFT JOIN vocab ON id = t GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Engine:
    """The vocabulary and merge table in an in-process DuckDB, and the pieces encoded so far.

    Bytes travel as Latin-1 text, one character a byte.
    """

    def __init__(self, path: str, pattern: str):
        self.cut = splitter(pattern)
        self.con = duckdb.connect()
        self.con.execute("SET threads = 1; SET memory_limit = '500MB'; SET preserve_insertion_order = false")
        ranks = read_ranks(path)
        self.con.register("ranks", pa.table({
            "id": pa.array(list(ranks.values()), pa.int32()),
            "piece": pa.array([token.decode("latin-1") for token in ranks]),
        }))
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM ranks").fetchall()
        self.con.unregister("ranks")
        self.con.execute("""
            CREATE TABLE merges AS SELECT l.id AS a, r.id AS b, v.id AS rank
            FROM (SELECT id, piece, unnest(range(1, length(piece))) AS k FROM vocab) v
            JOIN vocab l ON l.piece = substr(v.piece, 1, v.k) JOIN vocab r ON r.piece = substr(v.piece, v.k + 1)
        """).fetchall()
        self.whole = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.long_step = ""
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def merge(self, pieces: list[str], step: str) -> pa.Table:
        self.con.register("pieces", pa.table({
            "w": pa.array(np.arange(len(pieces), dtype=np.int32)), "s": pa.array(pieces, pa.string()),
        }))
        self.con.execute(SYMBOLS).fetchall()
        out = self.con.sql(step).to_arrow_table()
        self.con.unregister("pieces")
        return out

    def consistent(self) -> bool:
        """Whether every token of the vocabulary encodes to itself alone."""
        tokens = list(self.whole)
        ids = self.merge(tokens, STEP).column("ids").combine_chunks()
        return ids.flatten().to_pylist() == [self.whole[t] for t in tokens]

    def learn(self, new: list[str]) -> None:
        """Encodes pieces and keeps their ids: first by whole-piece lookup, then by merging."""
        raw = [piece.encode().decode("latin-1") for piece in new]
        # The sort sets short pieces (merged pair by pair) before long ones.
        order = sorted(range(len(new)), key=lambda i: (raw[i] not in self.whole, len(raw[i])))
        lookup = [i for i in order if raw[i] in self.whole]
        rest = order[len(lookup):]
        parts, counts = [np.array([self.whole[raw[i]] for i in lookup], np.int32)], [np.ones(len(lookup), np.int64)]
        short = [i for i in rest if len(raw[i]) <= LONG]
        if len(short) < len(rest) and not self.long_step:
            self.long_step = LONG_STEP if self.consistent() else STEP
        for some, step in ((short, STEP), (rest[len(short):], self.long_step)):
            if some:
                ids = self.merge([raw[i] for i in some], step).column("ids").combine_chunks()
                ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
                counts.append(np.diff(ids.offsets.to_numpy()))
                parts.append(ids.flatten().to_numpy())
        base = len(self.code)
        self.code.update((new[i], base + k) for k, i in enumerate(order))
        self.ids = np.concatenate([self.ids, *parts])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(counts))])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end (with a leading 0)."""
        cut = [self.cut(text) if text else [] for text in texts]
        seen = set().union(*cut)
        new = [piece for piece in seen if piece not in self.code]
        if len(self.code) + len(new) > KEPT and self.code:
            self.clear()
            new = list(seen)
        if new:
            self.learn(new)
        n_pieces = np.array([len(pieces) for pieces in cut], np.int64)
        codes = np.empty(int(n_pieces.sum()), np.int64)
        at = 0
        for pieces in cut:
            codes[at:at + len(pieces)] = list(map(self.code.__getitem__, pieces))
            at += len(pieces)
        starts, lengths = self.ends[codes], self.ends[codes + 1] - self.ends[codes]
        done = np.cumsum(lengths)
        ids = self.ids[np.repeat(starts - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)]
        ends = np.concatenate([[0], done])[np.concatenate([[0], np.cumsum(n_pieces)])]
        return ids, ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each id list; an unknown id adds nothing."""
        out = [b""] * (len(ends) - 1)
        self.con.register("tokens", pa.table({
            "d": np.repeat(np.arange(len(out), dtype=np.int32), np.diff(ends)),
            "p": np.arange(len(ids), dtype=np.int32), "t": ids.astype(np.int32),
        }))
        got = self.con.sql(DECODE).to_arrow_table()
        # Texts come in order too, so all positions must.
        places = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in got.column("ps").chunks)])
        if not np.array_equal(places, np.arange(len(ids))):
            got = self.con.sql(DECODE_SORTED).to_arrow_table()
        self.con.unregister("tokens")
        for d, s in zip(got.column("d").to_pylist(), got.column("s").to_pylist()):
            out[d] = (s or "").encode("latin-1")
        return out


_engines: dict[tuple[str, str], Engine] = {}


def engine(path: str, pattern: str) -> Engine:
    """One engine a Python worker and vocabulary: it outlives the tasks that the worker runs."""
    if (path, pattern) not in _engines:
        _engines[path, pattern] = Engine(path, pattern)
    return _engines[path, pattern]


def _with(schema: StructType, *added: StructField) -> StructType:
    names = {f.name for f in added}
    return StructType([*(f for f in schema.fields if f.name not in names), *added])


def _mapped(df: DataFrame, source: str, path: str, pattern: str, ids: str | None, decoded: str | None) -> DataFrame:
    added = [StructField(ids, ArrayType(IntegerType()))] if ids else []
    added += [StructField(decoded, BinaryType())] if decoded else []
    schema = _with(df.schema, *added)
    carried = [f.name for f in schema.fields[:len(schema) - len(added)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source))
            sizes = column if pa.types.is_string(column.type) else None
            values = column.to_pylist()
            for a, b in chunks(values, SLICE if sizes is not None else SLICE // 4):
                if ids:
                    tokens, ends = own.encode(values[a:b])
                else:
                    part = [[t for t in x or () if t is not None] for x in values[a:b]]
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in part], dtype=np.int64)])
                    tokens = np.array([t for x in part for t in x], np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))] if ids else []
                made += [pa.array(own.decode(tokens, ends), pa.binary())] if decoded else []
                kept = [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in carried]
                yield pa.RecordBatch.from_arrays([*kept, *made], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", pattern: str = BYTE_LEVEL) -> DataFrame:
    """Adds `ids`, an array of token ids of the whole text. Null and empty texts get an empty array.

    All other columns and repeated rows stay as they are; a column already named like the result is
    replaced. An empty table gives an empty table.
    """
    return _mapped(df, text, path, pattern, ids, None)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds `decoded`, the bytes that the ids stand for. Null gives no bytes, as do unknown or null ids."""
    return _mapped(df, ids, path, BYTE_LEVEL, None, decoded)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
               pattern: str = BYTE_LEVEL) -> DataFrame:
    """`encode`, then `decode` of its ids, in one pass over the rows."""
    return _mapped(df, text, path, pattern, ids, decoded)
