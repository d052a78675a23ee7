"""Toxicity by a linear classifier with a counterfactual penalty.

Features of a text are its words and their prefixes: those whose share differs clearly between the labels, and every
identity term that the labelled texts hold or that a swap puts there. A logistic model is fitted on a bounded sample of labelled
texts; beside the usual loss it pays for every change of score when identity terms in a labelled sentence are
swapped for others of their kind. A group that is mentioned often in toxic sentences then gains little weight of
its own, and a neutral mention isn't taken for an attack.

The sample is at most SAMPLE rows of each label, chosen by a hash of the key. Tasks make the features of its texts, however long
these are. The driver gets the chosen features' counts, for each sampled text the numbers of the chosen features it has, and
the sum over all swaps of the products of their changes, a table of features by features: that is all the
penalty needs. Every text is scored in its own task with a few thousand weights.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shelfline.llm.frames import stored

#: Labelled rows of each label that the model is fitted on, at most.
SAMPLE = 2000
#: Features kept: those whose share differs most between the labels, in standard errors.
FEATURES = 2000
LEAST_SCORE, LEAST_TEXTS = 4.0, 8
PREFIXES = (4, 5, 6)
RIDGE = 1e-4
PENALTY = 1.0
STEPS = 300

#: Terms for groups of people by kind and language; a term is swapped for the others of its kind. None is in two kinds.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("black", "white", "asian", "latino", "arab"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "foreigners", "refugees", "natives"),
    ("old", "young", "disabled"),
    ("frauen", "männer", "mädchen", "jungs"),
    ("frau", "mann"),
    ("schwarze", "weiße", "asiaten", "araber"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("muslimische", "christliche", "jüdische", "hinduistische", "buddhistische", "atheistische"),
    ("schwul", "heterosexuell", "lesbisch", "bisexuell"),
    ("einwanderer", "ausländer", "flüchtlinge", "einheimische"),
    ("alte", "junge", "behinderte"),
    ("femmes", "hommes", "filles", "garçons"),
    ("femme", "homme", "fille", "garçon"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("hétérosexuel", "homosexuel", "lesbienne", "bisexuel", "transgenre"),
    ("immigrés", "étrangers", "réfugiés", "autochtones"),
    ("vieux", "jeunes", "handicapés"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("mujer", "hombre", "niña", "niño"),
    ("negros", "blancos", "asiáticos", "árabes"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("heterosexual", "homosexual", "lesbiana", "transgénero"),
    ("inmigrantes", "extranjeros", "refugiados", "nativos"),
    ("mayores", "jóvenes", "discapacitados"),
)

_word = re.compile(r"[^\W\d_]+").findall
_sentence = re.compile(r"[^.!?\n]+").findall


def features(text: str | None) -> set[str]:
    """Words in lower case, and prefixes of them marked with a star."""
    words = set(_word((text or "").lower()))
    return words.union(*({f"{w[:n]}*" for w in words if len(w) >= n} for n in PREFIXES))


def swapped(text: str, kinds: tuple[tuple[str, ...], ...] = IDENTITY) -> Iterator[tuple[set[str], set[str]]]:
    """For each sentence with an identity term: its features, and those with its terms replaced by the next
    of their kind, then by the one after, and so on around."""
    following = {term: (kind, i) for kind in kinds for i, term in enumerate(kind)}
    for sentence in _sentence(text.lower()):
        words = _word(sentence)
        hit = [w for w in words if w in following]
        for turn in range(1, max((len(following[w][0]) for w in hit), default=1)):
            new = [following[w][0][(following[w][1] + turn) % len(following[w][0])] if w in following else w for w in words]
            yield features(" ".join(words)), features(" ".join(new))


@dataclass
class Model:
    """Weights by feature; without labels every score is 0. `pairs` counts the swapped sentences, and `moved` those
    of them that change a feature of the model: only these weigh in the penalty."""

    bias: float = -np.inf
    weights: dict[str, float] = field(default_factory=dict)
    pairs: int = 0
    moved: int = 0

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & features(text) if self.weights else ()
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[f] for f in found), -30, 30)))) if self.bias > -np.inf else 0.0


def gap(a: Column, b: Column, n0: int, n1: int) -> Column:
    """By how many standard errors a feature's share differs between n0 and n1 texts, a and b of which have it."""
    pooled = (a + b + 1) / (n0 + n1 + 2)
    return F.abs(b / n1 - a / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))


def changes(text: str, index: dict[str, int], kinds: tuple[tuple[str, ...], ...]) -> Iterator[dict[int, int]]:
    """For each swapped sentence of a text, which of the model's features it loses (1) and gains (-1); empty if none."""
    for before, after in swapped(text, kinds):
        yield {index[f]: 1 if f in before else -1 for f in before ^ after if f in index}


def loss(w: np.ndarray, bias: float, x: np.ndarray, y: np.ndarray, gram: np.ndarray, moved: int, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic loss, ridge and the mean squared change of score under swaps; and its slope by w and bias."""
    z = np.clip(x @ w + bias, -30, 30)
    p = 1 / (1 + np.exp(-z))
    value = float((np.logaddexp(0, z) - y * z).mean() + RIDGE / 2 * w @ w)
    slope = x.T @ (p - y) / len(y) + RIDGE * w
    if moved:
        pull = gram @ w
        value += penalty * float(w @ pull) / moved
        slope += 2 * penalty * pull / moved
    return value, np.concatenate([slope, [(p - y).mean()]])


def solve(x: np.ndarray, y: np.ndarray, gram: np.ndarray, moved: int, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over the whole sample."""
    w, bias = np.zeros(x.shape[1]), float(np.log(y.sum() / (len(y) - y.sum())))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        _, g = loss(w, bias, x, y, gram, moved, penalty)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def fit(sample: DataFrame, share: float, penalty: float = PENALTY, kinds: tuple[tuple[str, ...], ...] = IDENTITY) -> Model:
    """The model for a stored sample (text, label) of labels 0 and 1. `share` is the share of 1 among all labelled rows, to which the
    bias is set if the sample has another. Of one label only, the score is that share, pulled off 0 and 1. Features of equal
    gap are taken in order of name."""
    share = min(max(share, 1e-4), 1 - 1e-4)
    counted = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counted.get(0, 0), counted.get(1, 0)
    if not n0 + n1:
        return Model()
    prior = float(np.log(share / (1 - share)))
    if not n0 or not n1:
        return Model(prior)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = {t for kind in kinds for t in kind}
        for batch in batches:
            texts = batch.column(0).to_pylist()
            # Terms of the text, and those that swaps put there.
            own = [sorted({f for pair in swapped(t, kinds) for one in pair for f in one if f in terms}) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(1), pa.array([sorted(features(t)) for t in texts], pa.list_(pa.string())),
                pa.array(own, pa.list_(pa.string()))], ["label", "found", "terms"])

    said = stored(sample.select("text", "label").mapInArrow(described, "label int, found array<string>, terms array<string>"), "features")
    a, b = F.col("a"), F.col("b")
    counts = said.select("label", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("label") == 0).alias("a"), F.count_if(F.col("label") == 1).alias("b"))
    clear = counts.withColumn("gap", gap(a, b, n0, n1)).filter((a + b >= LEAST_TEXTS) & (F.col("gap") >= LEAST_SCORE))
    chosen = [r["feature"] for r in clear.orderBy(F.col("gap").desc(), "feature").limit(FEATURES).collect()]
    # As many as there are terms.
    held = sorted(r["term"] for r in said.select(F.explode("terms").alias("term")).distinct().collect())
    index = {f: k for k, f in enumerate(dict.fromkeys([*chosen, *held]))}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(index[f] for f in one if f in index) for one in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["label", "places"])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for change in changes(text.as_py(), index, kinds):
                    total[-1, 0] += 1
                    total[-1, 1] += bool(change)
                    for (i, one), (j, other) in product(change.items(), repeat=2):
                        total[i, j] += one * other
        if total:
            i, j = zip(*total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.values(), pa.int64())], ["i", "j", "n"])

    rows = said.select("label", "found").mapInArrow(placed, "label int, places array<int>").collect()
    # In one order, so that a rerun adds up the same numbers in the same way.
    rows = sorted((r["label"], tuple(r["places"])) for r in rows)
    x, y = np.zeros((len(rows), len(index)), np.float32), np.array([label for label, _ in rows], float)
    for k, (_, places) in enumerate(rows):
        x[k, list(places)] = 1
    gram, marks = np.zeros((len(index), len(index))), {0: 0, 1: 0}
    summed = sample.select("text").mapInArrow(products, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        if r["i"] < 0:
            marks[r["j"]] = r["n"]
        else:
            gram[r["i"], r["j"]] = r["n"]
    w, bias = solve(x, y, gram, marks[1], penalty)
    bias += prior - float(np.log(n1 / n0))
    return Model(float(bias), {f: float(w[k]) for f, k in index.items() if w[k]}, marks[0], marks[1])


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE, penalty: float = PENALTY, kinds: tuple[tuple[str, ...], ...] = IDENTITY) -> Model:
    """Fits on at most `sample` labelled texts of each label. Rows without key, label or text are left out;
    of repeated labels of a key the highest counts, of repeated keys the text that comes first."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.filter("key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.max("label").alias("label"))
    by_label = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(by_label.values())
    if not total:
        return Model()
    draw = lambda one: known.filter(F.col("label") == one).orderBy(F.xxhash64("key"), "key").limit(sample)
    # At most 2 * sample keys: a broadcast of proven size, so no text is shuffled.
    drawn = F.broadcast(draw(0).unionByName(draw(1)))
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL").join(drawn, "key")
    texts = stored(rows.groupBy("key").agg(F.min("text").alias("text"), F.first("label").alias("label")), "sample")
    return fit(texts, by_label.get(1, 0) / total, penalty, kinds)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score of each whole text, 0 to 1. Null and empty texts score as texts without any feature.

    Other columns and repeated rows stay; a column already named like the result is replaced, which the text
    column can't be. An empty table gives an empty table.
    """
    carried = [c for c in df.columns if c != out]
    if text not in carried:
        raise ValueError("the result can't replace the text column")
    narrow = df.select(*carried)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*carried, out])

    return narrow.mapInArrow(run, StructType([*narrow.schema.fields, StructField(out, DoubleType())]))
