"""Toxicity as an ordinal severity: a cumulative-link model over sparse text features.

P(grade <= k | x) = sigmoid(threshold_k - w.x). All thresholds share the weights ``w``, so
what makes a text worse moves it along one scale. The result is the expected grade.

Features are words in lower case and their beginnings of four to seven letters, which meet
inflected forms; a feature counts 1 + log(number of occurrences), however long the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import work_table

SAMPLE_ROWS = 12_000  # labelled documents that the model is fitted on, at most
MAX_FEATURES = 2_000
LEAST_DOCUMENTS = 3  # of the sample that hold a feature
LEAST_Z = 4.0  # how far, in standard errors, its share of toxic documents is above the average
GRADE_HITS = (1, 3, 6)  # occurrences of toxic features from which a toxic document has grade 1, 2, 3
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5, 6, 7)
_TOGETHER = 200  # documents of the sample whose features a task holds at a time


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in _BEGINNINGS if len(word) >= n)]


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


@dataclass
class OrdinalModel:
    """Weights by feature, and ascending thresholds; without thresholds everything has grade 0."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by row."""
        bounds = np.array(self.thresholds, float)[None, :]
        return 1 / (1 + np.exp(np.clip(bounds - np.asarray(score, float)[:, None], -60, 60)))


def _selected_features(docs: DataFrame, labels: DataFrame, sample_rows: int, seed: int, id_col: str, text_col: str):
    """Features of the sample's documents that go with toxic ones, and all their occurrences."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _TOGETHER):
                part, out = batch.slice(first, _TOGETHER), []
                for text in part["text"]:
                    terms: Counter = Counter()
                    for word, n in word_counts(text.as_py()).items():
                        for feature in features_of(word):
                            terms[feature] += n
                    out.append(list(terms.items()))
                maps = pa.array(out, pa.map_(pa.string(), pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keys), maps], names=[*keys, "terms"])

    # The sample has sample_rows rows of two numbers at most, so it may be sent to every task.
    keys = ["doc_id", "hash", "toxic"]
    labelled = texts.join(F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("text"))
    sample = work_table(labelled.select(*keys, "text").mapInArrow(read, "doc_id long, hash long, toxic int, terms map<string, long>"))
    # As columns of numbers, 24 bytes a row; terms come as their places in a list.
    rows = _numbers(sample.groupBy("doc_id", "hash").agg(F.max("toxic").alias("toxic")))
    share = float(rows["toxic"].mean()) if len(rows["toxic"]) else 0.0
    if not 0 < share < 1:
        return rows, None, []
    terms = sample.select("doc_id", "hash", "toxic", F.explode("terms").alias("term", "n")).distinct()
    z = (F.avg("toxic") - share) / F.sqrt(share * (1 - share) / F.count("*"))
    top = terms.groupBy("term").agg(F.count("*").alias("docs"), z.alias("z")).where(
        (F.col("docs") >= LEAST_DOCUMENTS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "term").limit(MAX_FEATURES)
    names = [r.term for r in top.select("term").collect()]
    places = docs.sparkSession.createDataFrame(list(enumerate(names)), "place int, term string")
    return rows, _numbers(terms.join(F.broadcast(places), "term").select("doc_id", "hash", "place", "n")), names


def _numbers(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {name: table[name].to_numpy() for name in table.column_names}


def fit_ordinal(values, columns, rows, grades: np.ndarray, size: int, l1: float, l2: float, steps: int = 400):
    """Weights and thresholds by accelerated proximal gradient; the matrix is given as triplets."""
    top, n = int(grades.max()), len(grades)
    weights, raw = np.zeros(size), np.zeros(top)
    shares = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-6, 1 - 1e-6)
    start = np.log(shares / (1 - shares))
    raw[0], raw[1:] = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    reach = np.bincount(rows, np.abs(values), n).max(initial=0.0) * np.bincount(columns, np.abs(values), size).max(initial=0.0)
    step = 1.0 / (0.5 * (reach / n + 4) + l2)

    def slope(w, r):
        spread = np.exp(np.clip(r[1:], -20, 20))
        bounds = np.concatenate([[r[0]], r[0] + np.cumsum(spread)])
        score = np.bincount(rows, values * w[columns], n)
        # Cumulative probabilities below and up to the grade of each row.
        edges = np.concatenate([[-np.inf], bounds, [np.inf]])
        high, low = edges[grades + 1] - score, edges[grades] - score
        with np.errstate(over="ignore"):
            upper, lower = 1 / (1 + np.exp(-high)), 1 / (1 + np.exp(-low))
        mass = np.maximum(upper - lower, 1e-12)
        to_upper, to_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        by_score = (to_upper - to_lower) / n
        by_bound = np.zeros(top + 2)
        np.add.at(by_bound, grades + 1, -to_upper / n)
        np.add.at(by_bound, grades, to_lower / n)
        by_bound = by_bound[1:-1]
        by_raw = np.array([by_bound.sum(), *(by_bound[k:].sum() * spread[k - 1] for k in range(1, top))])
        return np.bincount(columns, values * by_score[rows], size) + l2 * w, by_raw

    ahead, ahead_raw, pace = weights, raw, 1.0
    for _ in range(steps):
        by_weight, by_raw = slope(ahead, ahead_raw)
        moved = ahead - step * by_weight
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        moved_raw = ahead_raw - step * by_raw
        quicker = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        push = (pace - 1) / quicker
        ahead, ahead_raw = moved + push * (moved - weights), moved_raw + push * (moved_raw - raw)
        weights, raw, pace = moved, moved_raw, quicker
    return weights, np.concatenate([[raw[0]], raw[0] + np.cumsum(np.exp(np.clip(raw[1:], -20, 20)))])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11, id_col: str = "doc_id", text_col: str = "text"
) -> OrdinalModel:
    """A model from ``labels`` (doc_id, toxic 0/1) and the documents they name.

    It is fitted on ``sample_rows`` labelled documents at most, those of the smallest seeded
    hashes; all driver memory is bounded by that and by ``MAX_FEATURES``. The labels know no
    grades: a toxic document is graded by its occurrences of features that go with toxic
    documents (``GRADE_HITS``), a clean one has grade 0. A first fit with an L1 penalty
    drops features that others make superfluous, a second one sets the weights of the rest.

    Labels of unknown documents, null ids and null labels are left out; of several labels of
    one id the higher counts. Without labels of both kinds the model gives grade 0 to all.
    """
    rows, terms, names = _selected_features(docs, labels, sample_rows, seed, id_col, text_col)
    if not names:
        return OrdinalModel()
    # In one order, whichever way the rows came.
    order = np.lexsort((rows["hash"], rows["doc_id"]))
    rows = {name: column[order] for name, column in rows.items()}
    keys = {key: k for k, key in enumerate(zip(rows["doc_id"].tolist(), rows["hash"].tolist(), strict=True))}
    row = np.array([keys[key] for key in zip(terms["doc_id"].tolist(), terms["hash"].tolist(), strict=True)])
    order = np.lexsort((terms["place"], row))
    row, column, times = row[order], terms["place"][order], terms["n"][order].astype(float)
    value = 1 + np.log(times)
    toxic = rows["toxic"].astype(int)

    binary, _ = fit_ordinal(value, column, row, toxic, len(names), 0.3 / len(toxic), 0.0)
    stays = binary > 1e-3
    if not stays.any():
        return OrdinalModel()
    kept = stays[column]
    # One occurrence of a word can count for several features; the most frequent feature tells how many there were.
    hits, most = np.zeros(len(toxic)), np.zeros(len(toxic))
    np.add.at(hits, row[kept], times[kept] * np.array([not n.endswith("*") for n in names])[column[kept]])
    np.maximum.at(most, row[kept], times[kept])
    hits = np.maximum(hits, most)
    grades = np.where(toxic > 0, np.maximum(1, np.searchsorted(GRADE_HITS, hits, side="right")), 0)
    used = np.unique(grades)
    grades = np.searchsorted(used, grades)  # grades that do not occur are left out
    new = np.cumsum(stays) - 1
    weights, bounds = fit_ordinal(value[kept], new[column[kept]], row[kept], grades, int(stays.sum()), 0.0, 1e-6, 1500)
    return OrdinalModel(dict(zip(np.array(names)[stays].tolist(), weights.tolist(), strict=True)), bounds.tolist())


def _scorer(model: OrdinalModel):
    weights = model.weights

    class Hits(dict):
        """The features with a weight of each word seen; most words have none."""

        def __missing__(self, word: str) -> tuple[str, ...]:
            if len(self) > 300_000:
                self.clear()
            found = self[word] = tuple(f for f in features_of(word) if f in weights)
            return found

    def score(column: pa.Array) -> pa.Array:
        hits = Hits()
        scores = []
        for text in column:
            terms: Counter = Counter()
            for word, n in word_counts(text.as_py()).items():
                for feature in hits[word]:
                    terms[feature] += n
            scores.append(sum(weights[t] * (1 + math.log(n)) for t, n in sorted(terms.items())))
        return pa.array(model.at_least(np.array(scores)).tolist(), pa.list_(pa.float64()))

    return F.arrow_udf(score, "array<double>")


def score_toxicity(docs: DataFrame, model: OrdinalModel, reject_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (the likeliest side of each threshold),
    ``toxic_probability`` (of any grade above 0) and ``toxic`` (that is at least ``reject_at``).

    Whole texts are read. Null and empty texts have no features and get what the model gives
    to such; columns of these four names are replaced; no rows give no rows.
    """
    steps = _scorer(model)(F.col(text_col)) if model.thresholds else F.array().cast("array<double>")
    rows = docs.select(F.struct("*").alias("row"), steps.alias("steps"))
    new = {
        "severity": F.aggregate("steps", F.lit(0.0), lambda a, x: a + x),
        "grade": F.size(F.filter("steps", lambda x: x >= 0.5)),
        "toxic_probability": F.coalesce(F.get("steps", F.lit(0)), F.lit(0.0)),
    }
    new["toxic"] = new["toxic_probability"] >= reject_at
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in new]
    return rows.select(*kept, *(v.alias(k) for k, v in new.items()))


def drop_toxic(docs: DataFrame, model: OrdinalModel, reject_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, columns as they are, that the model does not call toxic."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return score_toxicity(rows, model, reject_at).where(~F.col("toxic")).select("row.*")
