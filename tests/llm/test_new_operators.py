"""Alignment, sharding and vector codes against plain versions, odd inputs included."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check import compare, connect
from shelfline.llm import alignment, oracle, queries, sharding, vector_codes
from shelfline.llm.token_count import byte_letters

A, B = P.path(queries.SINGLE), P.path(queries.PIECES)
ODD = [
    None, "", " ", "  two  spaces ", "x ", "a\nb\r\n\tc", "漢字かな交じり文" * 40, "it's  \n\n don't\t\tstop \x85 \x1c 12345 ½",
    "🤖🤖👩‍👩‍👧 naïve café", "a <|endoftext|> b<s> </s> <unk> <0x41>", "▁ marks ▁like▁these", "ǅ ªº ²½ Ⅷ", "same", "same",
    "word " * 900 + "end", "nospace" * 800, "tail" * 700 + " and " + "漢" * 3000 + " more words here",
]


def plain_alignment(texts):
    """Whole texts by the libraries, groups by walking along both."""
    a_of, b_of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    byte = {letter: i for i, letter in enumerate(byte_letters())}
    found = []
    for text in texts:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a_of.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        groups, own = [], ([], [])
        if text and b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            i = j = at_a = at_b = 0
            while i < len(a) or j < len(b):
                if at_a <= at_b and i < len(a):
                    own[0].append(a[i])
                    at_a, i = at_a + len(bytes_a[i]), i + 1
                else:
                    own[1].append(b[j])
                    at_b, j = at_b + len(bytes_b[j]), j + 1
                if at_a == at_b:
                    groups.append(own)
                    own = ([], [])
        found.append(groups)
    return found


def groups_of(row):
    a, b, out = row.a_ids, row.b_ids, []
    for n, m in zip(row.a_sizes, row.b_sizes):
        out.append((a[:n], b[:m]))
        a, b = a[n:], b[m:]
    assert not a and not b
    return out


@pytest.mark.parametrize("span", [alignment.SPAN, 64])
def test_alignment_like_the_libraries(spark, sf_dir, span):
    rows = [(i if i % 7 else None, t, "x", "y") for i, t in enumerate(ODD)] + [(3, ODD[3], "x", "y")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, a_ids string, row string")
    got = Counter(str((r.doc_id, r.text, r.row, groups_of(r))) for r in alignment.align(odd, A, B, span=span).collect())
    assert got == Counter(str((i, t, "y", g)) for (i, t, _, _), g in zip(rows, plain_alignment([r[1] for r in rows])))
    # Only texts with the sign that B writes for a space are not spelt by it.
    assert [t for t, g in zip(ODD, plain_alignment(ODD)) if not g] == [None, "", ODD[10]]
    assert alignment.align(odd.limit(0), A, B, span=span).count() == 0


def test_alignment_query_like_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    groups = plain_alignment(docs.text)
    counts = Counter((a[-1], b[-1]) for g in groups for a, b in g)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    want = {}
    for doc, g in zip(docs.doc_id, groups):
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        want[doc] = (
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(counts[x] == highest[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if g else "")
    got = queries.op11_fragment_alignment(spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def test_links_of_odd_texts(spark):
    odd = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, links string")
    groups = plain_alignment(ODD)
    for span in (alignment.SPAN, 64):
        rows = alignment.linked(odd, A, B, span=span).cache()
        docs = {r.row.doc_id: r for r in rows.filter("link IS NULL").collect()}
        assert {i: (r.n_a, r.n_b, r.n_groups) for i, r in docs.items()} == {
            i: (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g)) for i, g in enumerate(groups)}
        found = alignment.scored(rows, alignment.shared_counts(alignment.link_counts(rows))).collect()
        assert {r.row.doc_id: r.n_links for r in found} == {i: len(g) for i, g in enumerate(groups)} and found[0].row.links == "x"
        rows.unpersist()
    empty = alignment.linked(odd.limit(0), A, B)
    assert alignment.scored(empty, alignment.shared_counts(alignment.link_counts(empty))).count() == 0


def test_fragments_are_a_monoid():
    random.seed(3)
    own = alignment.aligner(A, B)
    text = " ".join(random.choice(["Straße", "tokenizers", "x" * 40, "漢字", "a", "unbelievable"]) for _ in range(60))
    for span in (5, 17, 64):
        parts = [p for _, _, p in own.fragments(text, 0, span)]
        whole = alignment.Fragment.compose(*parts)
        listed = lambda f: [x.tolist() for x in (f.a, f.b, f.a_cuts, f.b_cuts)]
        for _ in range(20):  # any bracketing, empty fragments anywhere
            some = list(parts)
            some.insert(random.randrange(len(some) + 1), alignment.Fragment.compose())
            while len(some) > 1:
                i = random.randrange(len(some) - 1)
                some[i:i + 2] = [alignment.Fragment.compose(some[i], some[i + 1])]
            assert listed(some[0]) == listed(whole)
        left, right = parts[0], parts[1]
        both = alignment.Fragment.compose(left, right)
        if len(left.a_cuts) and len(right.a_cuts):  # the open ends became one group
            assert len(both.closed[0]) == len(left.closed[0]) + len(right.closed[0]) + 1
            assert both.closed[0][len(left.closed[0])] == len(left.suffix[0]) + len(right.prefix[0])


def test_long_texts_are_cut_at_units():
    text = "one two  three " * 50 + "x" * 500 + " four five"
    parts = list(alignment.pieces(text, 40))
    assert " ".join(p for _, p in parts) == text and len(parts) > 10
    joined = (" " + text).encode()
    assert all(joined[at:at + len(p.encode()) + 1] == (" " + p).encode() for at, p in parts)
    assert list(alignment.pieces("", 40)) == [(0, "")]


def test_shards(spark, sf_dir):
    random.seed(4)
    rows = [(i if i % 11 else None, None if i % 13 == 0 else "é" * (i % 5), random.choice(["a", "b", None, "c"]), i % 2) for i in range(900)]
    rows += [(i, "t", "hot", 0) for i in range(900, 1500)] + [(7, "copy", "hot", 1)] * 500 + [(i, "x", f"s{i}", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mark int").repartition(5)
    got = sharding.plan(docs, shards=7).collect()
    assert len(got) == len(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    total = Counter(r[2] for r in rows)
    for source, n in total.items():
        held = Counter(r.shard for r in got if r.source == source)
        # The cuts are where the rows of all sources say; 60 sources of one row shift them a little.
        assert all(abs(held[shard] - n / 7) <= 2 + n / 50 for shard in range(7))
    assert max(Counter(r.shard for r in got if total[r.source] == 1).values()) < 25
    want = Counter((i, s, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, s, _ in rows)
    assert Counter((r.doc_id, r.source, r["size"], r.text_crc32) for r in got) == want
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, sharding.plan(docs.repartition(3), shards=7).collect())) == sorted(map(key, got))
    assert sharding.plan(docs, shards=7, seed=8).select("mark").exceptAll(sharding.plan(docs, shards=7).select("mark")).count() > 0
    # Not a stretch of the input: neighbours by id are spread over the shards.
    assert len({r.shard for r in got if r.source == "hot" and r.doc_id and 900 <= r.doc_id < 940}) >= 5


def test_sharded_rows_keep_their_columns(spark):
    rows = [(i % 40, "text %d" % (i % 3), "s", i % 2, "old") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int, shard string")
    out = sharding.sharded(docs, shards=4)
    assert out.columns == ["doc_id", "text", "source", "other", "shard", "slot"]
    got = out.collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(r[:4] for r in rows)
    assert len({(r.shard, r.slot) for r in got}) == 300
    assert sharding.plan(docs.limit(0)).count() == 0 and sharding.sharded(docs.limit(0)).count() == 0
    three = sharding.plan(docs.limit(3), shards=40).collect()
    assert sorted(r.slot for r in three) == [0, 0, 0] and len({r.shard for r in three}) == 3


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 16)
    docs = spark.range(1000).selectExpr("1L AS doc_id", "CASE WHEN id < 700 THEN 'same' ELSE 'other' END AS text", "'s' AS source")
    got = sharding.plan(docs, shards=3).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [333, 333, 334] and len({(r.shard, r.slot) for r in got}) == 1000


def test_very_long_text_in_a_shard(spark):
    docs = spark.createDataFrame([(1, "é" * 3_000_000, "s"), (2, "", "s")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in sharding.plan(docs).collect()}
    assert got[1]["size"] == 6_000_016 and got[1].text_crc32 == zlib.crc32(("é" * 3_000_000).encode()) and got[2]["size"] == 16


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Brute force over all entries; rows (key, vector, label) of whole vectors."""
    x = np.array([[int(np.floor(4096 * float(v))) for v in r[1]] for r in rows], np.int64).reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].ravel().tolist()))[:entries]
    book = x[first].transpose(1, 0, 2).copy()

    def nearest():
        far = ((x[:, :, None] - book[None]) ** 2).sum(3)
        return far.argmin(2), far.min(2)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(parts):
            for e in range(len(first)):
                own = x[code[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(0) // len(own)
    code, far = nearest()
    error = far.sum(1)
    by_label = Counter()
    for r, n in zip(rows, error):
        by_label[r[2]] += int(n)
    digest = hashlib.sha256(",".join(map(str, book.ravel())).encode()).hexdigest()
    return Counter((r[0], "".join(f"{c:02x}" for c in code[i]), int(error[i]), by_label[r[2]], digest) for i, r in enumerate(rows))


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=16).tolist(), int(i) % 3 if i % 4 else None) for i in rng.permutation(400)]
    rows += [(500, [0.25] * 16, 1)] * 200 + [(5, rows[0][1], 2), (None, rows[1][1], 2), (501, [-1e-9] * 16, 0), (502, [3000.0] * 16, 0)]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [None] * 16, 1), (-4, [float("nan")] * 16, 1), (-5, [float("inf")] + [0.0] * 15, 1), (600, [1.0] * 8, 1)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumns(
        {"code": F.lit("old"), "row": F.lit("kept"), "v": F.lit(1)}).repartition(4)
    out = vector_codes.compress(table)
    assert out.columns == ["vec_id", "embedding", "label", "row", "v", "code", "error", "label_error", "codebooks_sha256"]
    got = Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect())
    assert got == plain_codes(rows)
    few = [(i, [float(i), 1.0] * 8, 0) for i in range(5)] * 2
    small = spark.createDataFrame(few, "vec_id long, embedding array<double>, label int")
    assert Counter(tuple(r) for r in vector_codes.compress(small, keep=["vec_id"]).collect()) == plain_codes(few)
    assert vector_codes.compress(table.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e300] * 8, 0), (2, [-1e300] * 8, 0)], "vec_id long, embedding array<double>, label int")
    assert [r.error for r in vector_codes.compress(huge).collect()] == [0, 0]
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 9, 0)], small.schema))


def test_masks_name_the_entries_of_the_box():
    rng = np.random.default_rng(6)
    entries = rng.integers(-50, 50, (16, 4))
    entries[3] = entries[9]
    x, radius = rng.integers(-80, 80, (500, 4)), rng.integers(0, 60, 500)
    own = vector_codes.Slices(entries)
    inside = (abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(2)
    assert own.box(x, radius).tolist() == [sum(1 << e for e in np.flatnonzero(row)) for row in inside]
    far = ((x[:, None] - entries[None]) ** 2).sum(2)
    code, distance = own.nearest(x)
    assert code.tolist() == far.argmin(1).tolist() and distance.tolist() == far.min(1).tolist()


@pytest.mark.parametrize("name", ["op12_interleaved_shards", "op13_sliced_codes"])
def test_sql_of_the_new_queries(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert compare(got, connect(sf_dir).execute(oracle.ORACLES[name]).df()) == "ok"
