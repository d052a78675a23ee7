import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfline.functions.text import split_entities, title_case
from shelfline.operators.entities import explode_entities
from shelfline.operators.tokens import token_counts

GOLDEN = [
    # text, loose, strict
    ("a, llc, b", ["a, llc", "b"], ["a, llc", "b"]),
    ("x, co., ltd., y", ["x, co., ltd.", "y"], ["x, co., ltd.", "y"]),
    # strict marks ", llc" first; what follows "inc." is then no comma any more
    ("p, inc., llc", ["p, inc., llc"], ["p", "inc., llc"]),
    ("q, l.l.c., r", ["q, l.l.c.", "r"], ["q, l.l.c.", "r"]),
    ("corp a, corp", ["corp a, corp"], ["corp a, corp"]),
    ("a,, b , ", ["a", "b"], ["a", "b"]),
    ("foo, incredible games", ["foo, incredible games"], ["foo", "incredible games"]),
    ("m, ltd. games", ["m, ltd. games"], ["m", "ltd. games"]),
    ("a, co., ltd.x", ["a, co., ltd.x"], ["a, co.", "ltd.x"]),
    ("dev a, dev b, llc, dev c, co., ltd.", ["dev a", "dev b, llc", "dev c, co., ltd."],
     ["dev a", "dev b, llc", "dev c, co., ltd."]),
    # the loose mark itself reads as a suffix comma
    ("a|||,b|||c", ["a,", "b, c"], ["a|||", "b|||c"]),
    ("|||", [","], ["|||"]),
    (None, [], []),
    ("", [], []),
    ("   ", [], []),
]


def split_all(spark, texts, mode):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in df.select("i", split_entities(F.col("t"), mode)).orderBy("i").collect()]


@pytest.mark.parametrize("mode, index", [("loose", 1), ("strict", 2)])
def test_golden_lists(spark, mode, index):
    assert split_all(spark, [g[0] for g in GOLDEN], mode) == [g[index] for g in GOLDEN]


def test_unknown_mode():
    with pytest.raises(ValueError):
        split_entities(F.col("t"), "other")


def loose(text):
    """By commas: a part that starts with a suffix belongs to the part before it."""
    suffix = re.compile(r"\s*(?:llc|inc|ltd|l\.l\.c|co\.|corp)", re.A)
    names = []
    for i, part in enumerate(text.split(",")):
        if i and suffix.match(part):
            names[-1] += ", " + part.lstrip(" \t\n\r\f")
        else:
            names.append(part)
    return [n.strip(" ") for n in names if n.strip(" ")]


PIECES = st.sampled_from(["a", "bee", "llc", "inc.", "ltd", "co.", "l.l.c.", "corp", "corpus", "x llc", "", " "])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(PIECES, min_size=1, max_size=7), min_size=40, max_size=60))
def test_loose_against_brute_force(spark, lists):
    texts = [sep.join(parts) for parts in lists for sep in (",", ", ")]
    assert split_all(spark, texts, "loose") == [loose(t) for t in texts]


SUFFIXES = [[r"co\.", r"ltd\.?"], [r"llc\.?"], [r"inc\.?"], [r"ltd\.?"], [r"l\.l\.c\.?"], [r"co\."], [r"corp\.?"]]


def strict(text):
    """Part by part: suffix by suffix, a part joins the one before it if it is that suffix and the
    part after the suffix has not been joined to it yet."""
    parts = text.split(",")
    joined = [False] * (len(parts) + 9)
    for suffix in SUFFIXES:
        size = len(suffix)

        def is_suffix(i):
            words = [p.strip() for p in parts[i:i + size]]
            whole = len(words) == size and all(re.fullmatch(s, w) for s, w in zip(suffix, words))
            return whole and not any(joined[i + 1:i + size + 1])

        for i in [i for i in range(1, len(parts)) if not joined[i] and is_suffix(i)]:
            joined[i] = True
    names = []
    for i, part in enumerate(parts):
        if joined[i]:
            names[-1] += ", " + part.lstrip()
        else:
            names.append(part)
    return [n.strip() for n in names if n.strip()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(PIECES, min_size=1, max_size=7), min_size=40, max_size=60))
def test_strict_against_brute_force(spark, lists):
    texts = [sep.join(parts) for parts in lists for sep in (",", ", ")]
    assert split_all(spark, texts, "strict") == [strict(t) for t in texts]


def test_explode_is_distinct_and_loses_no_list(spark):
    rows = [(1, "a, a, b", 1), (1, "a, a, b", 1), (2, " , ", 1), (3, None, 1), (4, "", 1), (5, "c, llc", 2)]
    df = spark.createDataFrame(rows, "id int, names string, pos int")
    got = explode_entities(df, "names", ["id", "pos"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, "a"), (1, 1, "b"), (5, 2, "c, llc")]
    unique = explode_entities(df.distinct(), "names", ["id", "pos"], unique_input=True)
    assert sorted(tuple(r) for r in unique.collect()) == sorted(tuple(r) for r in got.collect())


def count(spark, texts, **options):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.word: r.word_count for r in token_counts(df, "t", **options).collect()}


def test_tokens(spark):
    assert count(spark, ["Half-Life 2: Épisode  東 _x_ it's™"]) == {
        "Half": 1, "Life": 1, "Épisode": 1, "東": 1, "s™": 1,
    }
    assert count(spark, ["a1 the b2! the", None], stop_words=["a1"]) == {"the": 2, "b2": 1}
    assert count(spark, ["ab12cd é ii"], letters_only=True) == {"ab": 1, "cd": 1, "é": 1}


def test_title_case(spark):
    df = spark.createDataFrame([("  co-op   iNC ",), ("o'neil GAMES, llc",)], "t string")
    assert [r[0] for r in df.select(title_case(F.col("t"))).collect()] == ["Co-op Inc", "O'neil Games, Llc"]
