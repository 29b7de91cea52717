"""Toxicity as a severity grade, by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector shared by all
ordered thresholds. Features are hashed words and word beginnings, each with
log(1 + count). The model is fitted on a bounded sample of labelled documents
(FIT_DOCUMENTS, chosen by a hash of the id, in one task whose input that bound
limits): features are screened by their association with the grade, then
weights and thresholds are learned together. Every document is scored over its
whole text; the expected severity is the sum over k of P(grade > k).

Grades come from the labels, in the order of harm: 0 sound, 1 of low quality, 2 toxic
(the highest, so its documents may be as toxic as they like). Rejected is what is
more likely toxic than not.

Defined cases: NULL and empty texts have no feature and get the intercepts'
severity; documents without a label, or with a NULL one, are scored and not
learned from; a document labelled more than once counts with its highest
grade; without any labelled document, or with one grade only, severity is that
grade (0 if none); other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txquality.llm import textkit as tk
from txquality.llm.names import refuse_taken
from txquality.session import stored

FIT_DOCUMENTS = 12_000
FEATURE_BITS = 18
PREFIX_BYTES = (4, 5, 6, 7, 8)
LEAST_DOCUMENTS = 8
SCREENED = 2048
# least chi-square of a feature against toxic or not
LEAST_STRENGTH = 40.0
STEPS = 400
RATE = 0.05
RIDGE = 5e-6
GRADES = 3
REJECT = 0.5


@dataclass
class Model:
    """Weights by feature (0 where screened out) and ascending thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray


def grade_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of labelled documents."""
    grade = F.when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, F.when(F.col("quality") == 0, 1).otherwise(0))
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every word and of its beginnings that are shorter than it."""
    starts, ends, rows = tk.spans(data, bounds, tk.ALNUM)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    shift = np.uint64(64 - FEATURE_BITS)
    hashes = tk.hash_prefixes(tk.LOWER[data], starts, ends, PREFIX_BYTES)
    size = ends - starts
    row = row.astype(np.int32)
    at, found = [row], [(hashes[0] >> shift).astype(np.int32)]
    for k, h in zip(PREFIX_BYTES, hashes[1:]):
        longer = size > k
        at.append(row[longer])
        found.append((tk.mix(h[longer] + np.uint64(k)) >> shift).astype(np.int32))
    return np.concatenate(at), np.concatenate(found)


def _counted(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, n = np.unique((row.astype(np.int64) << FEATURE_BITS) | feature, return_counts=True)
    return key >> FEATURE_BITS, key & ((1 << FEATURE_BITS) - 1), n


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tk.pieces(batches):
        row, feature, n = _counted(*features(*tk.text_bytes(piece.column(1))))
        at = np.searchsorted(row, np.arange(piece.num_rows + 1))
        part = [(tk.pack_sorted(feature[a:b]), tk.pack(n[a:b])) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([f for f, _ in part], pa.binary()), pa.array([c for _, c in part], pa.binary())], ["grade", "features", "counts"])


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, columns: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model by full-batch Adam on the ridge-penalised likelihood."""
    n = len(grade)
    share = (np.array([(grade <= k).sum() for k in range(grades - 1)]) + 0.5) / (n + 1)
    start = np.log(share / (1 - share))
    free = np.concatenate((np.zeros(columns), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    m, v = np.zeros_like(free), np.zeros_like(free)
    for t in range(1, STEPS + 1):
        w, first, gaps = free[:columns], free[columns], np.exp(free[columns + 1 :])
        thresholds = first + np.concatenate(([0.0], np.cumsum(gaps)))
        s = np.bincount(row, w[column] * value, n)
        z = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - s[:, None], -30, 30)))
        upper = np.concatenate((z, np.ones((n, 1))), 1)[np.arange(n), grade]
        lower = np.concatenate((np.zeros((n, 1)), z), 1)[np.arange(n), grade]
        p = np.maximum(upper - lower, 1e-12)
        # derivative of the log likelihood by each threshold that bounds the grade
        by_upper, by_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_score = -(by_upper - by_lower)
        by_threshold = np.array([by_upper[grade == k].sum() - by_lower[grade == k + 1].sum() for k in range(grades - 1)])
        gradient = np.empty_like(free)
        gradient[:columns] = -np.bincount(column, by_score[row] * value, columns) / n + RIDGE * w
        gradient[columns] = -by_threshold.sum() / n
        gradient[columns + 1 :] = [-by_threshold[k:].sum() * gaps[k - 1] / n for k in range(1, grades - 1)]
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        free = free - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return free[:columns], free[columns] + np.concatenate(([0.0], np.cumsum(np.exp(free[columns + 1 :]))))


def _fit(table: pa.Table) -> pa.Table:
    """One bounded group: screen the features, fit, return the features kept and the thresholds."""
    grade = table.column("grade").to_numpy().astype(np.int64)
    blobs = table.column("features").to_pylist()
    present = np.zeros((GRADES, 1 << FEATURE_BITS))
    for g, blob in zip(grade, blobs):
        present[g, tk.unpack_sorted(blob).astype(np.int64)] += 1
    levels, dense = np.unique(grade, return_inverse=True)
    kept, weights, thresholds = np.zeros(0, np.int64), np.zeros(0), np.where(np.arange(GRADES - 1) < levels[0], -30.0, 30.0)
    if len(levels) > 1:
        total, n = present.sum(0), len(grade)
        strength = np.zeros(1 << FEATURE_BITS)
        for level in levels[1:]:  # association with each split of the grades
            expected = total * (grade >= level).sum() / n
            found = (present[level:].sum(0) - expected) ** 2 / np.maximum(expected * (1 - total / (n + 1)), 1e-9)
            strength = np.maximum(strength, found)
        strength[total < min(LEAST_DOCUMENTS, max(2, n // 50))] = 0
        kept = np.sort(np.argsort(-strength, kind="stable")[:SCREENED])
        kept = kept[strength[kept] >= LEAST_STRENGTH * n / (n + 1000)]
        place = np.full(1 << FEATURE_BITS, -1)
        place[kept] = np.arange(len(kept))
        rows, columns, values = [], [], []
        for i, (blob, counts) in enumerate(zip(blobs, table.column("counts").to_pylist())):
            at = place[tk.unpack_sorted(blob).astype(np.int64)]
            rows.append(np.full((at >= 0).sum(), i))
            columns.append(at[at >= 0])
            values.append(np.log1p(tk.unpack(counts)[at >= 0]))
        weights, inner = fit_ordinal(np.concatenate(rows), np.concatenate(columns), np.concatenate(values), dense, len(kept), len(levels))
        # a grade that the sample lacks gets the threshold of the next one that it has
        thresholds = np.array([inner[i] if (i := int((levels <= k).sum()) - 1) in range(len(inner)) else (-30.0 if i < 0 else 30.0) for k in range(GRADES - 1)])
    out = {"feature": np.concatenate((kept, -1 - np.arange(GRADES - 1))), "weight": np.concatenate((weights, thresholds))}
    return pa.table({"feature": pa.array(out["feature"], pa.int64()), "weight": pa.array(out["weight"], pa.float64())})


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """The model, learned from about ``most`` labelled documents."""
    grades = grade_of(labels).withColumn("__draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    count = max(1, grades.count())
    drawn = grades.where(F.col("__draw") < int(min(1.0, most / count) * (1 << 40))).select(F.col("doc_id").alias("__id"), "grade")
    if drawn.count() <= 2 * most:  # the draw's bound; ids are unique, so a hash that favours some cannot pass it unseen
        drawn = F.broadcast(drawn)
    taken = docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("__id")).select("grade", "text")
    sample = stored(taken.mapInArrow(_sampled, "grade int, features binary, counts binary"), "toxicity-sample")
    found = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_fit, "feature long, weight double").toPandas()
    weights, thresholds = np.zeros(1 << FEATURE_BITS), np.full(GRADES - 1, 30.0)
    for feature, weight in zip(found["feature"], found["weight"]):
        if feature >= 0:
            weights[int(feature)] = weight
        else:
            thresholds[-1 - int(feature)] = weight
    return Model(weights, thresholds)


def _score(model: object, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = model.value.weights, model.value.thresholds
        used = weights != 0
        for piece in tk.pieces(batches):
            row, feature = features(*tk.text_bytes(piece.column(piece.schema.get_field_index("text"))))
            hit = used[feature]
            row, feature, n = _counted(row[hit], feature[hit])
            s = np.bincount(row, weights[feature] * np.log1p(n), piece.num_rows)
            above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - s[:, None], -500, 500)))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(above.sum(1)), pa.array(above[:, -1])], [*piece.schema.names, *names])

    return run


def scored(docs: DataFrame, model: Model, severity: str = "severity", toxic: str = "p_toxic") -> DataFrame:
    """The documents with expected severity (0 to GRADES - 1) and the probability of the highest grade, toxic."""
    from pyspark.sql import types as T

    refuse_taken(docs, severity, toxic)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(severity, T.DoubleType()), T.StructField(toxic, T.DoubleType())])
    return docs.mapInArrow(_score(shared, [severity, toxic]), schema)


def rejected(toxic: str = "p_toxic") -> Column:
    return F.col(toxic) > REJECT
