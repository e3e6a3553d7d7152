"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; all other text is unlabelled, toxic text included. With the share of
toxic text (the class prior) known, the risk on clean text is the risk on unlabelled text less the toxic part of
it, and is held at zero or above, so the classifier cannot win by overfitting. The classifier is linear in a
text's words: each word brings itself and its first letters as features, and a score is the logistic of the
bias plus the weights of the words by their part of the text, so a word's weight is looked up once. One word
counts for a bounded part, so that a text repeating it is not judged by it alone.

It is fitted on the driver on bounded, documented samples (``Fit``) of documents, chosen by hash, one text for each
id; scores cover whole texts of
all rows in one pass. Null, empty and blank texts score the bias alone. Equal texts get equal scores. Labels
whose document is absent are ignored; labels for one document that disagree count as toxic.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import Remembered, fresh, per_batch, remainder, stored, utf8


#: Words whose features or weights a task remembers, and most bytes in one.
REMEMBERED, LONGEST = 150_000, 64


@dataclass(frozen=True)
class Fit:
    """Most toxic and unlabelled examples, which features to use, and how to fit."""

    positives: int = 3000
    unlabelled: int = 6000
    names: int = 20_000  # most features considered
    least: float = 0.01  # of the toxic examples that hold a feature, and three at least
    apart: float = 4.0  # standard errors by which toxic examples hold it more often than unlabelled ones
    rounds: int = 400
    rate: float = 0.1
    decay: float = 3e-4
    smooth: float = 5.0
    scale: float = 100.0
    most: float = 0.05  # of a text that one word counts for
    threshold: float = 0.3


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    smooth: float
    scale: float
    most: float

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


def features(word: str) -> list[str]:
    """A word, bare and in lower case, and its beginnings of 3 to 7 letters."""
    bare = "".join(filter(str.isalpha, word.lower()))
    return [f"={bare}"] + [bare[:n] for n in range(3, 8) if n <= len(bare)] if bare else []


class Shares:
    """Features of texts by their part of the words; features of words are remembered up to a bound."""

    def __init__(self, how: Fit, number: dict[str, int] | None = None):
        self.how, self.number = how, number
        self.known = Remembered(self._of, REMEMBERED, LONGEST)

    def _of(self, word: bytes) -> list:
        found = features(word.decode(errors="replace"))
        return found if self.number is None else [self.number[f] for f in found if f in self.number]

    def __call__(self, text: bytes | None) -> dict:
        words, shares = (text or b"").split(), {}
        each = 1 / (len(words) + self.how.smooth)
        for w, n in Counter(words).items():
            for f in self.known[w]:
                shares[f] = shares.get(f, 0.0) + min(n * each, self.how.most)
        return shares


def fit(
    row: np.ndarray, column: np.ndarray, share: np.ndarray, toxic: np.ndarray, names: list[str], prior: float, how: Fit = Fit()
) -> Model:
    """Weights that minimise the non-negative risk, by Adam on all examples.

    Example ``row`` holds feature ``column`` with ``share``; ``toxic`` tells the positives from the unlabelled.
    """
    share = how.scale * share
    w, b = np.zeros(len(names)), -1.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    pos, neg = max(1, toxic.sum()), max(1, (~toxic).sum())
    for t in range(1, how.rounds + 1):
        z = np.clip(np.bincount(row, share * w[column], len(toxic)) + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        clean = np.log1p(np.exp(z))  # logistic loss of the label clean
        risk = clean[~toxic].sum() / neg - prior * clean[toxic].sum() / pos
        as_toxic = np.where(toxic, prior * (p - 1) / pos, 0)
        as_clean = np.where(toxic, -prior * p / pos, p / neg)
        # Below zero the risk on clean text is overfitted: step back on it.
        slope = as_toxic + as_clean if risk >= 0 else -as_clean
        g = np.append(np.bincount(column, share * slope[row], len(names)) + how.decay * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = how.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    kept = {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6}
    return Model(kept, float(b), how.smooth, how.scale, how.most)


def _named(how: Fit):
    def make():
        shares = Shares(how)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([list(shares(t)) for t in utf8(batch.column("text"))], pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([found], names=["names"])

        return each

    return per_batch(make)


def _numbered(how: Fit, number: dict[str, int]):
    def make():
        shares = Shares(how, number)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shares(t) for t in utf8(batch.column("text"))]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("toxic"),
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.float32())),
                ],
                names=["key", "toxic", "number", "share"],
            )

        return each

    return per_batch(make)


def _one_text_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, text and toxic: one row for each of ``chosen``, the text with the lowest hash where an id has several."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    # No more ids than asked for; what is combined before the shuffle is one row for an id, or an id's text.
    least = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("hash").alias("hash"))
    found = texts.join(F.broadcast(least), ["doc_id", "hash"]).select("doc_id", "text", "toxic").distinct()
    return stored(found, "toxicity-examples")


def train(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Model:
    """Fit on the rows that may be learnt from: crc32 of doc_id as text modulo 4 is not 2."""
    may = remainder(F.col("doc_id"), 4) != 2
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(may)
    told = known.agg(F.avg("toxic").alias("share"), F.count("toxic").alias("n")).head()
    share = told["share"] or 0.0
    # The lower end of what the labels allow: too high a prior would take more than the risk on clean text.
    prior = min(max(share - 2 * (share * (1 - share) / max(told["n"], 1)) ** 0.5, 0.01), 0.5)
    toxic = known.filter("toxic = 1").select("doc_id")
    # Each document once, however many rows it has; unlabelled text is all of it, toxic or not.
    usable = docs.filter(may).select("doc_id").distinct()
    by_hash = (F.xxhash64(F.lit(11), "doc_id"), F.col("doc_id"))
    first = lambda rows, n, kind: rows.orderBy(*by_hash).limit(n).withColumn("toxic", F.lit(kind))
    chosen = first(usable.join(toxic, "doc_id", "left_semi"), how.positives, True).unionByName(
        first(usable, how.unlabelled, False)
    )
    examples = _one_text_each(docs, stored(chosen, "toxicity-chosen"))
    named = examples.filter("toxic").select("text").mapInArrow(_named(how), "names array<string>")
    least = max(3, how.least * examples.filter("toxic").count())
    counted = named.select(F.explode("names").alias("name")).groupBy("name").count().filter(F.col("count") >= least)
    names = sorted(r["name"] for r in counted.orderBy(F.desc("count"), "name").limit(how.names).collect())

    def numbered(names: list[str]) -> DataFrame:
        return examples.select(F.xxhash64("doc_id", "text", "toxic").alias("key"), "toxic", "text").mapInArrow(
            _numbered(how, {n: i for i, n in enumerate(names)}),
            "key long, toxic boolean, number array<int>, share array<float>",
        )

    size = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    held = np.zeros((2, len(names)))
    for r in numbered(names).select("toxic", F.explode("number").alias("n")).groupBy("toxic", "n").count().collect():
        held[int(r["toxic"]), r["n"]] = r["count"]  # two rows for each name at most
    used = _apart(held[1], held[0], size.get(True, 0), size.get(False, 0)) > how.apart
    names = [n for n, u in zip(names, used) if u]
    rows = numbered(names).toArrow().sort_by("key")  # sums in one order, so that reruns agree
    lengths = rows.column("number").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    flat = lambda c: rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    return fit(row, flat("number"), flat("share"), rows.column("toxic").to_numpy().astype(bool), names, prior, how)


def _apart(in_toxic: np.ndarray, in_rest: np.ndarray, toxic: int, rest: int) -> np.ndarray:
    """How much more often toxic examples hold each feature, in standard errors."""
    pos, neg = max(1, toxic), max(1, rest)
    pooled = (in_toxic + in_rest) / (pos + neg)
    return (in_toxic / pos - in_rest / neg) / np.sqrt(pooled * (1 - pooled) * (1 / pos + 1 / neg) + 1e-12)


class Scorer:
    """Scores of texts under a model; weights of words are remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known = Remembered(lambda w: model.word(w.decode(errors="replace")), REMEMBERED, LONGEST)

    def __call__(self, text: bytes | None) -> float:
        words, known, most = (text or b"").split(), self.known, self.model.most
        each = 1 / (len(words) + self.model.smooth)
        z = sum([known[w] * min(n * each, most) for w, n in Counter(words).items()])
        return float(1 / (1 + np.exp(-np.clip(self.model.bias + self.model.scale * z, -30, 30))))


def _scores(model: Model, passed: tuple[str, ...], name: str):
    def make():
        scorer = Scorer(model)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([scorer(t) for t in utf8(batch.column("text"))], pa.float64())
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), found], names=[*passed, name])

        return each

    return per_batch(make)


def score(docs: DataFrame, model: Model, names: tuple[str, str] = ("score", "predicted"), threshold: float = Fit.threshold) -> DataFrame:
    """The columns of ``docs``, a score (0 to 1) and what it predicts (1 from the threshold on)."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    scored = docs.mapInArrow(_scores(model, tuple(docs.columns), names[0]), ", ".join([*kinds, f"`{names[0]}` double"]))
    return scored.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic; columns as they are."""
    names = fresh(docs, "score", "predicted")
    return score(docs, model, names).filter(F.col(names[1]) == 0).drop(*names)
