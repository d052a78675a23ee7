"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from shelfline.llm import mixing, sharding, vector_codes

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '')"


def _scramble(x: str) -> str:
    """A line and a square modulo the prime, twice."""
    line = f"((({x}) % 2147483647 * 1103515245 + 12345) % 2147483647)"
    square = f"(({line} * {line} % 2147483647 + 214013) % 2147483647)"
    return f"({square} * {square} % 2147483647)"


def _block_at(word: str) -> str:
    """The block of a word: the longer ones come first."""
    return (f"(CASE WHEN {word} < longer * (short + 1) THEN {word} // (short + 1) "
            f"ELSE longer + ({word} - longer * (short + 1)) // short END)")


def _rounds() -> str:
    """One common table per round of the index permutation."""
    out = []
    for r in range(1, mixing.ROUNDS + 1):
        turn = f"((rank * 69621 + {r * 48271}) * 16807 % 2147483647)"
        out.append(f"""
o{r} AS (SELECT rank, n_blocks, x, {turn} AS turn, (({turn} * {turn} - x) % n_blocks + n_blocks) % n_blocks AS other FROM p{r - 1}),
p{r} AS (SELECT rank, n_blocks, CASE WHEN ({_scramble("greatest(x, other) + turn")} >> 9) % 2 = 1 THEN other ELSE x END AS x FROM o{r})""")
    return ",".join(out)


BLOCK_MIX = f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::bigint AS size FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight FROM r),
l AS (SELECT *, (sum(source_size) OVER ()::double * 1.5::double
        - coalesce(sum(source_size) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::double * 2)
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::double AS level,
        source_size::double / weight::double AS fill
      FROM w WINDOW b AS (ORDER BY source_size::double / weight::double, rank)),
f AS (SELECT arg_min(level, (fill, rank)) AS level FROM l WHERE level * weight <= 2 * source_size),
t AS (SELECT rank, source, source_size, coalesce(least(2 * source_size::double, f.level * weight), 2 * source_size::double) AS target
      FROM l LEFT JOIN f ON true),
n AS (SELECT *, greatest(ceil(source_size / {mixing.BLOCK})::bigint, least(source_size, {mixing.PIECES})) AS n_blocks FROM t WHERE target > 0),
m AS (SELECT *, source_size // n_blocks AS short, source_size % n_blocks AS longer, target / source_size * n_blocks AS expected FROM n),
k AS (SELECT rank, n_blocks, least({mixing.MOST} * n_blocks, floor(expected)::bigint + CASE
        WHEN {_scramble("rank * 1000003 + 1")} % 1000000 < round((expected - floor(expected)) * 1000000)::bigint THEN 1 ELSE 0 END) AS n FROM m),
p0 AS (SELECT rank, n_blocks, slot % n_blocks AS x FROM (SELECT rank, n_blocks, unnest(range(n)) AS slot FROM k)
      ),{_rounds()},
times AS (SELECT rank, x AS index, count(*) AS times FROM p{mixing.ROUNDS} GROUP BY ALL),
a AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, short, longer, sum(size) OVER (
        PARTITION BY t.rank ORDER BY doc_id % {mixing.CHUNKS}, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::bigint - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN m ON m.rank = t.rank),
b AS (SELECT *, unnest(CASE WHEN size = 0 THEN [NULL] ELSE range({_block_at("start")}, {_block_at("(start + size - 1)")} + 1) END) AS index FROM a)
SELECT doc_id, size, source_size, target, coalesce(sum(times * (
         least(start + size, (index + 1) * short + least(index + 1, longer)) - greatest(start, index * short + least(index, longer)))), 0)::bigint AS taken
FROM b LEFT JOIN times USING (rank, index) GROUP BY doc_id, size, source_size, target, rank, start
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, len(g)::bigint AS n FROM g),
s AS (SELECT doc_id, unnest(g) AS x FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM n LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) ON a = doc_id
"""

INTERLEAVED_SHARDS = f"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
             lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, source, coalesce(text, '') AS text, strlen(coalesce(text, '')) + {sharding.OVERHEAD} AS size FROM documents),
b AS (SELECT *, flatten(list_transform(string_split(text, ''), lambda x: CASE
        WHEN unicode(x) < 128 THEN [greatest(unicode(x), 0)]
        WHEN unicode(x) < 2048 THEN [192 + unicode(x) // 64, 128 + unicode(x) % 64]
        WHEN unicode(x) < 65536 THEN [224 + unicode(x) // 4096, 128 + unicode(x) // 64 % 64, 128 + unicode(x) % 64]
        ELSE [240 + unicode(x) // 262144, 128 + unicode(x) // 4096 % 64, 128 + unicode(x) // 64 % 64, 128 + unicode(x) % 64]
      END))::bigint[] AS bytes FROM d),
m AS (SELECT doc_id, source, size::bigint AS size, xor(4294967295, list_reduce(list_prepend(4294967295, CASE WHEN text = '' THEN [] ELSE bytes END),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc,
        md5(concat_ws(chr(31), '{sharding.SEED}', coalesce(source, ''), coalesce(doc_id::varchar, ''), text)) AS mark FROM b, t),
o AS (SELECT *, md5(mark || ':' || (row_number() OVER (PARTITION BY source, doc_id, mark) - 1)) AS o FROM m),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY o) - 1
        + (('0x' || substr(md5(concat_ws(chr(31), '{sharding.SEED}', source)), 1, 8))::bigint + 0.5::double) / 4294967296::double)
        / count(*) OVER (PARTITION BY source)::double AS fraction FROM o),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST) - 1 AS place, count(*) OVER () AS n FROM r),
s AS (SELECT *, place * {sharding.SHARDS} // n AS shard FROM p)
SELECT doc_id, size, crc::bigint AS text_crc32, 'rows' AS law, shard::int AS shard,
  (place - (shard * n + {sharding.SHARDS - 1}) // {sharding.SHARDS})::bigint AS slot, NULL::int AS grown_shard
FROM s
"""


def _codes() -> str:
    """One assignment and one move of the entries a round, and a last assignment."""
    parts, entries, whole = vector_codes.PARTS, vector_codes.ENTRIES, []
    for r in range(vector_codes.ROUNDS + 1):
        whole.append(f"""
a{r} AS MATERIALIZED (SELECT id, vec_id, label, part, x, best % {entries} AS entry, best // {entries} AS far FROM (
  SELECT id, vec_id, label, p.part, any_value(x) AS x, min(entry + {entries} * list_sum(list_transform(range(1, len(x) + 1),
      lambda i: (x[i] - c[i]) * (x[i] - c[i])))::bigint) AS best
  FROM p JOIN c{r} c ON c.part = p.part GROUP BY ALL))""")
        if r < vector_codes.ROUNDS:
            whole.append(f"""
s{r} AS (SELECT part, entry, i, sum(x[i])::bigint AS s, count(*) AS n
         FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
  SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY ALL) m USING (part, entry))""")
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
             list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::double)::bigint) AS v
           FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS MATERIALIZED (SELECT id, vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x
                   FROM (SELECT *, unnest(range({parts})) AS part FROM k)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x AS c FROM p WHERE id <= {entries}),{",".join(whole)},
f AS (SELECT id, vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::bigint AS error
      FROM a{vector_codes.ROUNDS} GROUP BY ALL)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::bigint AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{vector_codes.ROUNDS}) AS codebooks_sha256
FROM f
"""


SLICED_CODES = _codes()

ORACLES = {
    "op7_block_mix": BLOCK_MIX, "op8_hyperminhash": NEAR_DUPLICATES, "op12_interleaved_shards": INTERLEAVED_SHARDS,
    "op13_sliced_codes": SLICED_CODES,
}
