"""Near duplicates, near vectors, mixing, components and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, connect
from shelfline.llm import minhash, mixing, rabitq
from shelfline.llm.components import components
from shelfline.llm.oracle import ORACLES
from shelfline.llm.queries import QUERIES


def roots_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert compare(got, connect(sf_dir).execute(ORACLES[name]).df()) == "ok"


def test_components(spark):
    random.seed(5)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 380)]
    links += [(400, i) for i in range(401, 460)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links + [(None, 1)], "a long, b long")).collect()}
    want = roots_of(500, links)
    assert all(want[k] == v for k, v in got.items()) and {x for a, b in links if a != b for x in (a, b)} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    random.seed(7)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = [None, "", "  \t ", "one", "ONE", "one two three", "One  two\nthree", "a b c d e", "A B C D E"]
    base = [word() for _ in range(80)]
    for _ in range(60):  # edits of one text, of which some are near each other only
        copy = list(base)
        for _ in range(random.randrange(4)):
            copy[random.randrange(80)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join([*passage, *(word() for _ in range(random.randrange(3, 60)))]) for _ in range(60)]
    texts += texts[9:30]
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = roots_of(len(texts), links)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, node string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(got[i].kept == (want[i] == i) for i in range(len(texts)))
    nulls = spark.createDataFrame([(None, "x y"), (None, "x y"), (4, "x y"), (4, "x y")], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(nulls).collect()} == {4}
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 64))
    rows = [base[i % 60] + rng.standard_normal(64) * rng.uniform(0, 0.6) for i in range(900)]
    rows += [rows[0]] * 40 + [rows[1] * 3]
    bad = [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [1.0, 2.0]]
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    data = [(i, [float(v) for v in r], "c") for i, r in enumerate(rows)] + [(5000 + i, v, "c") for i, v in enumerate(bad)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in rabitq.near_vectors(df).collect()}
    found = sum(got[i].n_links for i in range(len(rows)))
    assert near.sum() > 5000 and found <= near.sum() and found >= 0.99 * near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in range(len(rows)))
    assert all(got[5000 + i].n_links == 0 and got[5000 + i].kept for i in range(len(bad)))
    assert rabitq.near_vectors(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[200:] = x[:200] + 0.48 * x[200:]  # cosines of about 0.9 to the first half
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows, cosines = rabitq.sketches(x), x @ x.T
    guess, spread, rounding = rabitq.estimates(rows, 64)
    error = guess - cosines
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.005
    bound = np.sqrt((1 - cosines**2).clip(0) * spread[:, None] ** 2 + rounding)
    assert (np.abs(error) <= rabitq.EPSILON * bound)[off].mean() > 0.9995
    own, other = np.arange(200), np.arange(200, 400)
    i, j = rabitq.likely(rows, 64, own, other, 0.9)
    near = cosines[np.ix_(own, other)] >= 0.9
    assert near.sum() > 60 and {*zip(i, j)} >= {(a, b + 200) for a, b in zip(*np.nonzero(near))}
    assert len(i) < 0.02 * near.size


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).withColumns({"n": F.lit(n).cast("bigint"), "k": F.lit(3)})
        places = [r.p for r in mixing.permuted(df, "id", "n", "k", "p").orderBy("id").collect()]
        assert sorted(places) == list(range(n)) and (n < 1000 or places != sorted(places))


def test_mixing_odd_rows(spark):
    rows = [(1, "a b c " * 400, "s"), (1, "a b c " * 400, "s"), (None, "d " * 900, None), (3, None, "t"), (4, "", "s"), (5, "e " * 500, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", F.lit("clash"))
    got = mixing.mix(df, block=16).collect()
    assert len(got) == 6 and all(0 <= r.taken <= 2 * r["size"] for r in got)
    sums = {}
    for r in got:
        have = sums.setdefault(r.source, [0, r.target, r.source_size])
        have[0] += r.taken
    assert {k: v[2] for k, v in sums.items()} == {"s": 2400, None: 900, "t": 0, "u": 500}
    assert all(abs(taken - target) <= 0.05 * target + 32 for taken, target, _ in sums.values())
    assert abs(sum(v[1] for v in sums.values()) - 1.5 * 3800) < 1e-6
    texts = mixing.mixed_texts(df, block=16).collect()
    words = lambda r: len(re.findall(r"\S+", r.text))
    assert sum(map(words, texts)) == sum(r.taken for r in got) and set(texts[0].asDict()) == set(df.columns)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_many_small_sources(spark):
    random.seed(11)
    rows, size = [], {}
    for i in range(6000):
        for _ in range(random.choice((1, 1, 2))):
            n = random.randrange(1, 300)
            rows.append((len(rows), " ".join(f"w{k}" for k in range(n)), f"s{i}"))
            size[f"s{i}"] = size.get(f"s{i}", 0) + n
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    # A source is within a block of its target, and blocks differ by a word at most.
    off = [r for r in got if abs(r.taken - r.target) > 2 * (size[r.source] // min(size[r.source], mixing.PIECES) + 1) + 0.05 * r.target]
    total, want = sum(r.taken for r in got), 1.5 * sum(size.values())
    assert not off and abs(total - want) <= 0.002 * want, (len(off), total / want)
    texts = mixing.mixed_texts(df.filter("doc_id < 500"))
    words = lambda d: d.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words(texts) == mixing.mix(df.filter("doc_id < 500")).agg(F.sum("taken")).first()[0]


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "mix", "encode"]
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "src0", 0), (-1, "", "en", "src0", 0)], docs.schema)
    kept = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        assert kept.columns == corpus_pipeline.COLUMNS
        if name == "near_duplicates":
            classes = minhash.near_duplicates(before).filter("kept").select("doc_id").distinct().count()
            assert kept.count() == classes
        if name == "secret_scan":
            assert kept.count() == before.count() and kept.filter("text RLIKE 'AKIA[A-Z0-9]{14}'").count() == 0
    coded = corpus_pipeline.encode(spark, kept, sf_dir).collect()
    assert len(coded) == kept.count() and all(len(r.ids) == r.n_tokens for r in coded)


def test_near_duplicates_without_unique_ids(spark, sf_dir):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    copy = text("a") + " more"
    rows = [(None, text("a")), (3, copy), (None, text("b")), (None, text("c")), (None, text("c") + " end"), (7, text("d")),
            (7, text("e")), (7, text("e")), (8, text("e")), (None, None), (None, ""), (9, " "), (9, " ")]
    docs = spark.createDataFrame(
        [(i, t, "en", f"src{k}", len(t or "")) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).select(*docs.columns).collect()
    again = corpus_pipeline.near_duplicates(spark, docs.repartition(5, "source"), sf_dir).select(*docs.columns).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    kept = sorted(int(r.source[3:]) for r in got)
    assert {1, 2, 5, 6, 9, 10, 11, 12} <= set(kept) and len(kept) == 9
    assert len({3, 4} & set(kept)) == 1  # of two without an id, by the hash of the text


def test_a_link_by_one_heavy_band(spark):
    rng = np.random.default_rng(4)
    draw = lambda: rng.integers(1 << 10, 1 << 14, 128).astype(np.uint16)
    rows = [draw() for _ in range(12)]
    # All share band 0. Nodes 0 and 1 share no other, but three registers of each; 2 is the hub, by bands shared with 3.
    rows[1] = np.where(np.arange(128) % 4 == 3, rows[1], rows[0])
    rows[3][4:40] = rows[2][4:40]
    for r in rows:
        r[:4] = rows[0][:4]
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(12)]
    texts[1] = texts[0] + " more"
    documents = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "key long, mark long, text string")
    nodes = spark.createDataFrame(
        [(bytes([i]), (False, i, i), 56, r.tobytes()) for i, r in enumerate(rows)],
        "node binary, rep struct<none:boolean,key:long,mark:long>, n long, registers binary")
    for cross in (0, minhash.CROSS):
        found = {(bytes(r.a), bytes(r.b)) for r in minhash.near_links(nodes, documents, cross).collect()}
        assert found == {(b"\0", b"\1")}, cross


def test_near_duplicates_by_second_bands(spark):
    random.seed(12)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(4))
    passage, texts = [word() for _ in range(40)], []
    for _ in range(30):
        base = [*passage, *(word() for _ in range(40))]
        texts += [" ".join(base), " ".join([*base, word(), word()])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = minhash.near_duplicates(df, cross=0).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i // 2 * 2) for i in range(60)]


def test_smallest_hashes():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**31, 3000)
    for size in (40, 300, 3000):  # the last is longer than what is kept
        sets = [np.unique(np.where(rng.random(size) < share, rng.integers(0, 2**31, size), base[:size]))
                for share in (0, 0, 0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.2, 0.5, 1)]
        n = np.array([len(s) for s in sets], float)
        lowest = minhash._Lowest([s[:minhash.LOWEST] for s in sets], n)
        others = np.arange(len(sets))
        for i, mine in enumerate(sets):
            true = np.array([len(np.intersect1d(mine, s)) / len(np.union1d(mine, s)) for s in sets])
            near, value = lowest.possible(i, others)
            assert near[true >= 0.75].all() and not near[true < 0.65].any()
            assert np.abs(value - true).max() < 0.07
            if size <= minhash.LOWEST:
                assert (near == (100 * true >= 75)).all() and np.allclose(value, true)
