"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features describe the line and its neighbours: shares of capitals, symbols,
digits and bars, repetition of words and of the line before, lengths. The weights of a label after a label are
learned. Forward-backward gives every line's probability of being good; a document's raw quality is the mean over
its lines weighted by their lengths, and a logistic curve learned on documents turns it into the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chain import Adagrad, Chain, forward_backward, label_changes
from ledgerloom.llm.common import bounded_sample, free_name, held_out, settle, ship

# Labelled documents learned from, for each label. Of a longer text so many stretches of so many characters are read,
# one from each of as many equal parts, at a place set by a hash.
FIT_DOCUMENTS = 1200
STRETCHES, STRETCH = 4, 4000
EPOCHS = 30
BATCH_DOCUMENTS = 64
BLOCK_CHARACTERS = 2_000_000
OWN = 18


@dataclass(frozen=True)
class QualityModel:
    """``weights`` and ``chain`` label lines; ``slope`` and ``middle`` turn the mean into a score."""

    weights: np.ndarray
    chain: Chain
    slope: float
    middle: float


def _character_classes() -> np.ndarray:
    """Class of each code point below 0x3000: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 symbol, 6 stop, 7 bar."""
    table = np.zeros(0x3000, np.uint8)
    for x in range(len(table)):
        c = chr(x)
        if c in ".,;:?'\"-()":
            table[x] = 6
        elif c in "|\t":
            table[x] = 7
        elif c.isspace():
            table[x] = 4
        elif c.isdigit():
            table[x] = 3
        elif c.isupper():
            table[x] = 2
        elif c.isalpha():
            table[x] = 1
        else:
            table[x] = 5
    return table


CLASSES = _character_classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the lines of each text (at least one), and the characters of each line."""
    per_text = [(t or "").split("\n") for t in texts]
    counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
    lines = [line for found in per_text for line in found]
    n = len(lines)
    sizes = np.fromiter(map(len, lines), np.int64, n)
    joined = "\n".join(lines) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.where(points < len(CLASSES), CLASSES[np.minimum(points, len(CLASSES) - 1)], 1)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    shares = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(1, 8)], axis=1).astype(float)
    shares[:, 3] -= 1  # the line break counted as space
    marks = np.maximum(sizes, 1)[:, None]
    words = [line.split() for line in lines]
    total = np.fromiter(map(len, words), np.int64, n)
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, n)
    same = np.fromiter((w[0] == w[-1] if w else False for w in words), np.float64, n)
    length = np.log1p(sizes)
    own = np.zeros((n, OWN))
    own[:, :7] = shares / marks
    own[:, 7] = distinct / np.maximum(total, 1)
    own[:, 8] = np.minimum(sizes / np.maximum(total, 1), 20) / 10
    own[:, 9] = length / 8
    own[:, 10] = (sizes == 0) * 1.0
    own[:, 11] = same
    own[:, 12] = shares[:, 1] > shares[:, 0]  # more capitals than small letters
    own[:, 13] = own[:, 4] > 0.05  # many symbols
    own[:, 14] = own[:, 6] > 0.02  # bars
    own[:, 15] = (own[:, 7] < 0.5) & (total > 4)  # words repeat
    first = np.zeros(n, bool)
    first[np.concatenate(([0], np.cumsum(counts)[:-1]))] = True
    repeat = np.fromiter((a == b and bool(a) for a, b in zip(lines, ["", *lines])), np.float64, n)
    own[:, 16] = repeat * ~first
    own[:, 17] = first
    before, after = np.zeros((n, OWN)), np.zeros((n, OWN))
    before[1:] = own[:-1] * ~first[1:, None]
    after[:-1] = own[1:] * ~first[1:, None]
    return np.concatenate([np.ones((n, 1)), own, before, after], axis=1), counts, sizes.astype(float)


def line_means(texts: list[str], weights: np.ndarray, chain: Chain) -> np.ndarray:
    """Probability of good lines in each text, weighted by their lengths (an empty line weighs as one character)."""
    out = np.zeros(len(texts))
    start = size = 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size < BLOCK_CHARACTERS and n + 1 < len(texts):
            continue
        found, counts, sizes = line_features(texts[start : n + 1])
        marginals, _ = forward_backward(found @ weights, counts, chain)
        firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        share = np.maximum(sizes, 1)
        out[start : n + 1] = np.add.reduceat(marginals[:, 1] * share, firsts) / np.add.reduceat(share, firsts)
        start, size = n + 1, 0
    return out


def train(texts: list[str], labels: list[int], seed: int = 7) -> QualityModel:
    """Fit the lines with the label of their document, then the curve on the documents."""
    rng = np.random.default_rng(seed)
    found, counts, _ = line_features(texts)
    gold = np.repeat(np.asarray(labels, np.int64), counts)
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    # Either label counts as much as the other, and a document as much as another.
    share = np.array([1 / max(1, labels.count(0)), 1 / max(1, labels.count(1))])[np.asarray(labels)]
    heft = share / share.mean() / np.maximum(counts, 1)
    weights, start, step = np.zeros((found.shape[1], 2)), np.zeros(2), np.zeros((2, 2))
    moves = [Adagrad(x.shape, rate) for x, rate in ((weights, 0.2), (start, 0.05), (step, 0.05))]
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH_DOCUMENTS):
            docs = order[at : at + BATCH_DOCUMENTS]
            rows = np.concatenate([np.arange(firsts[d], firsts[d] + counts[d]) for d in docs])
            chain = Chain(start, step)
            marginals, changes = forward_backward(found[rows] @ weights, counts[docs], chain, count=True)
            error = -marginals
            error[np.arange(len(rows)), gold[rows]] += 1
            error *= np.repeat(heft[docs], counts[docs])[:, None]
            seen = (label_changes(gold[rows], counts[docs], 2) - changes) / len(rows)
            weights = weights + moves[0].move(found[rows].T @ error / len(docs) - 1e-4 * weights)
            start = start + moves[1].move(seen[2] - 1e-3 * start)
            step = step + moves[2].move(seen[:2] - 1e-3 * step)
    chain = Chain(start, step)
    means = line_means(texts, weights, chain)
    return QualityModel(weights, chain, *curve(means, np.asarray(labels)))


def curve(means: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of label 1 over the means; the slope is never negative."""
    a, b = 4.0, 0.0
    x, moves = means - 0.5, Adagrad((2,), 0.5)
    for _ in range(500):
        error = labels - 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        da, db = moves.move(np.array([(error * x).mean() - 1e-4 * a, error.mean()]))
        a, b = max(0.1, a + da), b + db
    return a, 0.5 - b / a


def stretches_of(text: Column) -> Column:
    """A text, or stretches from all over a long one, a line break between them."""
    part = F.floor(F.char_length(text) / STRETCHES).cast("int")
    found = [
        F.substring(text, n * part + F.pmod(F.xxhash64(F.lit(n), text), part - STRETCH + 1).cast("int") + 1, F.lit(STRETCH))
        for n in range(STRETCHES)
    ]
    return F.when(F.char_length(text) > STRETCHES * STRETCH, F.concat_ws("\n", *found)).otherwise(text)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    """A model from a bounded sample of labelled documents that are not held out; None unless both labels occur."""
    settle(docs.sparkSession)
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    # A document marked both ways teaches nothing.
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    marks = marks.filter(F.col("quality") == F.col("other")).select("doc_id", "quality")
    ids = {r["doc_id"]: r["quality"] for r in bounded_sample(marks, "doc_id", "quality", FIT_DOCUMENTS).collect()}
    if set(ids.values()) != {0, 1}:
        return None
    texts = docs.filter(F.col("doc_id").isin(list(ids)) & F.col("text").isNotNull())
    # Of several texts of one id always the same.
    one = texts.select("doc_id", stretches_of(F.col("text")).alias("text"), F.xxhash64("text").alias("mark")).groupBy("doc_id")
    sample = one.agg(F.min_by("text", F.struct("mark", "text")).alias("text")).orderBy("doc_id").collect()
    marked = [ids[r["doc_id"]] for r in sample]
    return train([r["text"] for r in sample], marked) if set(marked) == {0, 1} else None


def predict(text: Column, model: QualityModel | None, spark) -> Column:
    """Score of a text, 0 to 1."""
    if model is None:
        return F.lit(0.5)
    plain = (model.weights, model.chain.start, model.chain.step, model.slope, model.middle)
    sent = spark.sparkContext.broadcast(plain)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        weights, start, step, slope, middle = sent.value
        means = line_means(list(texts), weights, Chain(start, step))
        return pd.Series(1 / (1 + np.exp(-np.clip(slope * (means - middle), -30, 30))))

    return quality(text)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.5) of every row; other columns are ignored.

    NULL and empty texts are one empty line and get the score of such a line. Without learnable rows of both
    labels every score is 0.5. Labels other than 0 and 1, and documents marked both ways, are not learned from.
    A NULL doc_id is not held out. Repeated rows are scored alike.
    """
    model = fit(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least_score``, all columns kept; all rows if nothing can be learned."""
    model = fit(docs, labels)
    name = free_name(docs.columns, "quality_score")
    return docs.withColumn(name, predict(F.col("text"), model, docs.sparkSession)).filter(F.col(name) >= least_score).drop(name)


ship("ledgerloom.llm.chain", __name__)
