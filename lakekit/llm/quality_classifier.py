"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Statistics of whole texts (shares under arcsine of the root, counts under a logarithm) are computed once and kept. Class means
and covariances come from grouped sums over all labelled training rows; covariances shrink towards the pooled one and
its diagonal. Each class keeps the inverse of its Cholesky factor, so a score is the difference of two
Mahalanobis log densities, brought to a probability by a logistic curve fitted on a histogram of training differences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import chunks, find_words, fresh, hash_words, materialize
from lakekit.llm.quality_rules import per_document

FEATURES = (
    "words", "word_length", "length_spread", "symbols", "upper", "digits", "stops", "marks",
    "distinct", "again", "top_word", "pairs", "line_words", "shouts",
)
HISTOGRAM = 400  # bins of the training differences; the only training data that reaches the driver besides sums

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:", np.uint8))
_MARK = np.isin(_BYTES, np.frombuffer(b"!?", np.uint8))
_SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>{}[]\\^~=+@_", np.uint8))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics for each document."""
    w = find_words(data, offsets)
    n_docs = len(offsets) - 1
    n = w.count.astype(float)
    some = np.maximum(n, 1)
    head = (w.data & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(head)])
    length = (points[w.end] - points[w.start]).astype(float)
    chars = np.maximum(per_document(length, w.first), 1)

    def share(flags):
        return np.clip(per_document(flags.astype(np.int64), offsets) / chars, 0, 1)

    capital = _UPPER[data]
    if len(data) > 1:  # capitals of the Latin-1 block, two bytes each
        capital[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    mean = per_document(length, w.first) / some
    spread = np.sqrt(np.maximum(per_document(length**2, w.first) / some - mean**2, 0))
    h = hash_words(w)

    def groups(value, doc):
        """Distinct values and the largest group of each document."""
        by = np.lexsort((value, doc))
        new = np.ones(len(by), bool)
        new[1:] = (value[by][1:] != value[by][:-1]) | (doc[by][1:] != doc[by][:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(by)))
        top = np.zeros(n_docs)
        np.maximum.at(top, doc[by][start], size)
        return np.bincount(doc[by][start], minlength=n_docs), top

    distinct, top = groups(h, w.doc)
    inner = np.flatnonzero(w.doc[:-1] == w.doc[1:]) if len(h) > 1 else np.zeros(0, np.int64)
    again = np.bincount(w.doc[inner], weights=h[inner] == h[inner + 1], minlength=n_docs)
    two, _ = groups(h[inner] * np.uint64(31) + h[inner + 1], w.doc[inner]) if len(inner) else (np.zeros(n_docs), 0)
    lines = 1 + per_document((data == 0x0A).astype(np.int64), offsets)
    loud = per_document(_MARK[w.data[w.end - 1]].astype(np.int64) if len(h) else np.zeros(0), w.first)
    root = lambda p: np.arcsin(np.sqrt(np.clip(p, 0, 1)))
    return np.stack(
        [
            np.log1p(n),
            np.log1p(mean),
            np.log1p(spread),
            root(share(_SYMBOL[data])),
            root(share(capital)),
            root(share(_DIGIT[data])),
            root(share(_STOP[data])),
            root(share(_MARK[data])),
            root(distinct / some),
            root(again / some),
            root(top / some),
            root(two / some),
            np.log1p(n / lines),
            root(loud / some),
        ],
        1,
    )


def _measure(text: str, name: str):
    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                x = statistics(data, offsets)
                columns = {c: part.column(c) for c in part.schema.names if c != text}
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                columns[name] = pa.ListArray.from_arrays(pa.array(at), pa.array(x.reshape(-1)))
                yield pa.record_batch(columns)

    return run


@dataclass
class Discriminant:
    """Two Gaussian classes: means, inverse Cholesky factors and log volumes of standardised statistics; a + b x gives log odds."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverse: np.ndarray
    volume: np.ndarray
    a: float = 0.0
    b: float = 1.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 minus that of class 0, under a signed logarithm that tames far tails."""
        z = (x - self.centre) / self.scale
        far = [((z - m) @ inv.T) ** 2 for m, inv in zip(self.means, self.inverse)]
        d = 0.5 * (far[0].sum(1) - far[1].sum(1)) + self.volume[0] - self.volume[1]
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a + self.b * self.difference(x), -35, 35)))


def _sums(rows: DataFrame, column: str, label: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each class: rows, means and second moments, by grouped sums."""
    d = len(FEATURES)
    x = [F.col(column)[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)] + [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for row in rows.groupBy(label).agg(F.count("*").alias("n"), *sums).collect():  # two rows
        mean = np.array([row[f"s{i}"] for i in range(d)]) / row["n"]
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = row[f"p{i}_{j}"] / row["n"]
        out[row[label]] = (row["n"], mean, second)
    return out


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps on counts, with half a row of each class added everywhere for a finite fit."""
    good, bad = good + 0.5 / len(x), bad + 0.5 / len(x)
    beta = np.array([0.0, 1.0])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        weight = (good + bad) * p * (1 - p) + 1e-9
        step = np.linalg.solve(design.T @ (weight[:, None] * design) + 1e-6 * np.eye(2), design.T @ (good - (good + bad) * p))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 1e-3))


def _differences(model, column: str, label: str):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(column))
            yield pa.record_batch({"label": batch.column(label).cast(pa.int32()), "difference": model.value.difference(x)})

    return run


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(FEATURES))


def fit(rows: DataFrame, column: str, label: str, shrink: float = 0.15, ridge: float = 0.05) -> Discriminant | None:
    """The discriminant of labelled statistics (labels 0 and 1); None if either class has fewer than two rows."""
    spark = rows.sparkSession
    classes = _sums(rows, column, label)
    if any(classes.get(c, (0,))[0] < 2 for c in (0, 1)):
        return None
    n = np.array([classes[c][0] for c in (0, 1)], float)
    mean = [classes[c][1] for c in (0, 1)]
    centre = (n[0] * mean[0] + n[1] * mean[1]) / n.sum()
    total = (n[0] * classes[0][2] + n[1] * classes[1][2]) / n.sum() - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(total), 1e-8))
    within = [(classes[c][2] - np.outer(mean[c], mean[c])) / np.outer(scale, scale) for c in (0, 1)]
    pooled = (n[0] * within[0] + n[1] * within[1]) / n.sum()
    inverse, volume = [], []
    for own in within:
        blend = (1 - shrink) * own + shrink * pooled
        blend = (1 - ridge) * blend + ridge * np.diag(np.diag(pooled) + 0.02)
        factor = np.linalg.cholesky(blend)
        inverse.append(np.linalg.inv(factor))
        volume.append(np.log(np.diag(factor)).sum())
    means = np.array([(m - centre) / scale for m in mean])
    model = Discriminant(centre, scale, means, np.array(inverse), np.array(volume))
    edges = np.linspace(-25, 25, HISTOGRAM + 1)
    shared = spark.sparkContext.broadcast(model)
    found = rows.select(column, label).mapInArrow(_differences(shared, column, label), "label int, difference double")
    step = (edges[-1] - edges[0]) / HISTOGRAM
    place = F.least(F.lit(HISTOGRAM - 1), F.greatest(F.lit(0), F.floor((F.col("difference") - float(edges[0])) / step))).cast("int")
    counts = np.zeros((2, HISTOGRAM))
    for row in found.groupBy("label", place.alias("place")).count().collect():
        counts[row["label"], row["place"]] = row["count"]
    model.a, model.b = _logistic((edges[:-1] + edges[1:]) / 2, counts[1], counts[0])
    return model


def _score(model, column: str, name: str):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(column))
            columns = {c: batch.column(c) for c in batch.schema.names if c != column}
            score = model.value.score(x) if model.value is not None else np.full(len(x), 0.5)
            yield pa.record_batch(columns | {name: pa.array(score)})

    return run


def held_out(doc_id):
    """Rows kept out of training: crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3
) -> DataFrame:
    """Each row of `docs`, without its text, with held_out, score (probability of label 1) and predicted (1 if score >= threshold).

    Training takes every labelled row that is not held out; labels other than 0 and 1 count as none. Only the text's statistics
    enter a score. Null and blank texts are scored as texts without words. Rows with a null doc_id have no label and are
    not held out; repeated rows get equal scores. If either class has fewer than two training rows, each score is 0.5. Extra columns
    pass through; the new names get a suffix where `docs` has them.
    """
    spark = docs.sparkSession
    out, score, predicted, stats = fresh(docs, "held_out", "score", "predicted", "statistics")
    rest = [f for f in docs.schema.fields if f.name != text]
    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)
    measured = materialize(docs.mapInArrow(_measure(text, stats), f"{kind}{stats} array<double>"), "statistics")
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1)")
    rows = measured.where(~held_out(F.col(doc_id))).join(known, F.col(doc_id) == F.col("_id")).select(stats, "_label")
    model = spark.sparkContext.broadcast(fit(rows, stats, "_label"))
    scored = measured.mapInArrow(_score(model, stats, score), f"{kind}{score} double")
    return scored.withColumn(out, held_out(F.col(doc_id))).withColumn(predicted, (F.col(score) >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that the classifier accepts, with their own columns."""
    spark = docs.sparkSession
    stats, = fresh(docs, "statistics")
    score, = fresh(docs, "score")
    threshold = options.pop("threshold", 0.3)
    label = options.pop("label", "quality")
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1)")
    # Measured before the join, so that statistics move and texts do not.
    learning = docs.where(~held_out(F.col(doc_id))).select(F.col(doc_id).alias("_doc"), F.col(text).alias("text"))
    kind = f"_doc {docs.schema[doc_id].dataType.simpleString()}, {stats} array<double>"
    measured = learning.mapInArrow(_measure("text", stats), kind)
    rows = materialize(measured.join(known, F.col("_doc") == F.col("_id")).select(stats, "_label"), "statistics")
    model = spark.sparkContext.broadcast(fit(rows, stats, "_label", **options))
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields])

    def judge(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, text):
                x = statistics(data, offsets)
                values = model.value.score(x) if model.value is not None else np.full(len(x), 0.5)
                yield pa.record_batch({c: part.column(c) for c in part.schema.names} | {score: pa.array(values)})

    return docs.mapInArrow(judge, f"{kind}, {score} double").where(F.col(score) >= threshold).drop(score)
