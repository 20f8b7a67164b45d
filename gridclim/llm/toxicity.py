"""Toxicity by a classifier chain: linear models in a fixed order of categories, each fed the earlier ones' probabilities.

Features are the presence of words and of their beginnings, the ones that the labels of a category depend on most.
In training, the earlier probabilities are out-of-fold predictions, so a later model sees them as they will be.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, column_bytes, kept, map_arrow, read_table, release, spread

#: Bound of the labelled rows learned from, features taken for each category, and the least number of rows with one.
SAMPLE, FEATURES, LEAST_ROWS, FOLDS, L2 = 8000, 200, 4, 4, 0.1
PREFIXES = (4, 5, 6)
#: The chain: category, column of labels, value that means the category holds.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
_WORD = re.compile(r"[^\W\d_]+")
_CACHED = 300_000


def word_features(word: str) -> list[str]:
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]]


def text_words(text: bytes) -> set[str]:
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


@dataclass
class Chain:
    """names: categories in order; index: feature to column; own: for each category the columns of its own
    features; weights: for each category those features', the earlier probabilities', the constant's; threshold: of the last."""

    names: list[str]
    index: dict[str, int]
    own: list[list[int]]
    weights: list[np.ndarray]
    threshold: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A column for each category, from rows of features."""
        found = np.zeros((len(x), 0))
        for own, w in zip(self.own, self.weights, strict=True):
            found = np.column_stack([found, _probability(np.column_stack([x[:, own], found]), w)])
        return found


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, l2: float = L2, steps: int = 12) -> np.ndarray:
    """Logistic regression by Newton's method with halved steps; the constant, last, is not shrunk."""
    x = np.column_stack([x, np.ones(len(x))])
    shrink = np.full(x.shape[1], l2)
    shrink[-1] = 1e-6
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, (1 - 2 * y) * (x @ w)).sum() + 0.5 * (shrink * w * w).sum()
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (p - y) + shrink * w)
        size = 1.0
        while size > 1e-3 and (after := loss(w - size * move)) > now:
            size /= 2
        if size <= 1e-3 or now - after < 1e-6 * now:
            break
        w, now = w - size * move, after
    return w


def fit_chain(names: list[str], index: dict[str, int], own: list[list[int]], x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Chain:
    """x: rows of features; own: each category's columns; y: a column of labels for each category; fold: each row's fold."""
    weights, outside = [], np.zeros((len(x), 0))
    for k in range(len(names)):
        seen = np.column_stack([x[:, own[k]], outside])
        found = np.zeros(len(x))
        for f in np.unique(fold):
            out = fold == f
            found[out] = _probability(seen[out], fit_linear(seen[~out], y[~out, k])) if (~out).any() else 0.5
        weights.append(fit_linear(seen, y[:, k]))
        outside = np.column_stack([outside, found])
    return Chain(names, index, own, weights, best_threshold(outside[:, -1], y[:, -1]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts out-of-fold predictions best (by F1), halfway in log odds between its neighbours; of equal ones the lowest."""
    if not y.any() or y.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hit = p[order], np.cumsum(y[order])
    last = np.append(p[1:] < p[:-1], False)
    f1 = np.where(last, 2 * hit / (np.arange(1, len(p) + 1) + hit[-1]), -1.0)
    k = len(p) - 1 - int(np.argmax(f1[::-1]))
    odds = np.log(p[[k, k + 1]] / (1 - p[[k, k + 1]])) if last[k] else np.zeros(2)
    return float(1 / (1 + np.exp(-odds.mean())))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain=CHAIN, sample: int = SAMPLE) -> Chain | None:
    """A chain from at most `sample` labelled documents, lowest hash of the id first; None if there are no labels.

    Rows with a null id or label do not count; repeated ids count once, with the greatest label. Of documents that share an id one
    text is learned from, that of the lowest hash, so no more than `sample` rows come to the driver.
    """
    spark = docs.sparkSession
    columns = [c for _, c, _ in chain]
    chosen = labels.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [id_col, *columns])).groupBy(id_col).agg(*[F.max(c).alias(c) for c in columns])
    rows = chosen.orderBy(F.xxhash64(id_col), id_col).limit(sample).collect()
    if not rows:
        return None
    bounded = spark.createDataFrame(rows, chosen.schema)
    s = Scratch(spark, "toxicity")
    hit = [(F.col(c) == v).cast("int").alias(f"y{k}") for k, (_, c, v) in enumerate(chain)]
    ys = [f"y{k}" for k in range(len(chain))]
    labelled = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(bounded.select(id_col, *hit)), id_col)
    one = labelled.groupBy(id_col, *ys).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    texts = s.save(one.select(id_col, "one.text", *ys), "sample")

    def count(batches):
        release()
        total: Counter = Counter()
        by = [Counter() for _ in ys]
        for batch in batches:
            labelled = list(zip(*(batch.column(y).to_pylist() for y in ys), strict=True))
            for text, own in zip(column_bytes(batch.column("text")), labelled, strict=True):
                features = {f for w in text_words(text) for f in word_features(w)}
                total.update(features)
                for c, y in zip(by, own, strict=True):
                    if y:
                        c.update(features)
        names = list(total)
        for at in range(0, len(names), 20_000):
            part = names[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([total[f] for f in part], pa.int64())] + [pa.array([c[f] for f in part], pa.int64()) for c in by], ["feature", "n", *ys])

    sums = texts.select("text", *ys).mapInArrow(count, "feature string, n long, " + ", ".join(f"{y} long" for y in ys)).groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(y).alias(y) for y in ys])
    size, *positive = texts.agg(F.count("*"), *[F.sum(y) for y in ys]).first()
    counted = s.save(sums.where(F.col("n") >= LEAST_ROWS), "features")
    picked: dict[str, int] = {}
    own: list[list[int]] = []
    for y, p in zip(ys, positive, strict=True):
        own.append([])
        if not p or p == size:
            continue
        more = F.col(y) * float(size) - F.col("n") * float(p)
        chi2 = more * more / (F.col("n").cast("double") * F.greatest(F.lit(1e-9), size - F.col("n").cast("double")))
        for row in counted.orderBy(chi2.desc(), "feature").limit(FEATURES).select("feature").collect():
            own[-1].append(picked.setdefault(row[0], len(picked)))

    look = feature_lookup(picked)

    def present(batches):
        for batch in batches:
            found = [sorted({i for w in text_words(t) for i in look(w)}) for t in column_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), *[batch.column(y) for y in ys]], [id_col, "features", *ys])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.select(id_col, "text", *ys).mapInArrow(present, f"{id_col} {kind}, features array<int>, " + ", ".join(f"{y} int" for y in ys)).collect()
    x, y = np.zeros((len(rows), len(picked)), np.float32), np.array([[r[k] for k in ys] for r in rows], float).reshape(len(rows), len(ys))
    for i, r in enumerate(rows):
        x[i, r.features] = 1
    fold = np.array([zlib.crc32(str(r[0]).encode()) % FOLDS for r in rows])
    return fit_chain([n for n, _, _ in chain], picked, own, x, y, fold) if rows else None


def feature_lookup(index: dict[str, int]):
    """Word to the columns it sets, by a bounded cache."""
    known: dict[str, tuple[int, ...]] = {}

    def look(word: str) -> tuple[int, ...]:
        found = known.get(word)
        if found is None:
            found = tuple(index[f] for f in word_features(word) if f in index)
            if len(known) >= _CACHED:
                known.clear()
            known[word] = found
        return found

    return look


def score(docs: DataFrame, model: Chain | None, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """id, p_<category> for each category in the chain's order, and toxic: the last one's probability reaches the threshold, the model's own unless given.

    One row for each input row, repeated ones alike. A null or empty text has no features; texts of any length are read whole.
    A probability equal to the threshold is toxic. Without a model: null probabilities, not toxic. An empty table gives no
    rows; other columns do not matter.
    """
    least = threshold if threshold is not None else model.threshold if model else 0.5
    names = [f"p_{n}" for n in (model.names if model else [n for n, _, _ in CHAIN])]

    def run(batches):
        for batch in batches:
            p = probabilities(model, batch.column(1)) if model else np.full((batch.num_rows, len(names)), np.nan)
            columns = [pa.array(np.round(p[:, k], 9), pa.float64(), from_pandas=True) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(p[:, -1] >= least, pa.bool_())], [id_col, *names, "toxic"])

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, T.DoubleType()) for n in names], T.StructField("toxic", T.BooleanType())]
    return map_arrow(docs.select(id_col, text_col), run, T.StructType(fields))


def probabilities(model: Chain, texts: pa.Array) -> np.ndarray:
    """A column for each category."""
    key = zlib.crc32(repr([sorted(model.index.items()), [w.tobytes() for w in model.weights]]).encode())
    look = kept("toxicity", key, lambda: feature_lookup(model.index))
    x = np.zeros((len(texts), len(model.index)), np.float32)
    for i, text in enumerate(column_bytes(texts)):
        for w in text_words(text):
            for j in look(w):
                x[i, j] = 1
    return model.probabilities(x)


def drop_toxic(docs: DataFrame, model: Chain | None, text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """The rows, with all their columns, that score does not call toxic; all rows without a model."""
    if model is None:
        return docs
    at = docs.columns.index(text_col)
    least = model.threshold if threshold is None else threshold

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(probabilities(model, batch.column(at))[:, -1] < least, pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`score` of all documents by a chain learned from a bounded sample of the labels."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
