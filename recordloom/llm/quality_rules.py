"""Quality by learned decision lists: ordered rules of thresholds, stated as Spark conditions.

Rules for bad documents are learned by sequential covering. On two thirds of what is still
uncovered a rule grows, one threshold after the other, by information gain; on the other
third its last thresholds are pruned while that helps; what it covers is set aside and the
next rule starts, until a rule is wrong too often or covers too little. The list becomes
one CASE expression over statistics of the text, so applying it needs no model at run time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import shingle_hashes, word_hashes
from .work import work_table

SAMPLE_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_end_marks")
_HAS_WORD = re.compile(WORD)
_END_MARKS = ".!?"


def text_statistics(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``STATISTICS``, of a whole text; all zero for null."""
    if not text:
        return (0,) * len(STATISTICS)
    words = text.encode("utf-8", "surrogatepass").split()
    hashes = word_hashes(words)
    repeated = 0
    if len(words) >= 3:
        windows = shingle_hashes(hashes, 3)
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        starts = times[which] > 1
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k : k + len(starts)] |= starts
        repeated = int(covered.sum())
    lines = [line for line in text.split("\n") if _HAS_WORD.search(line)]
    return (
        len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated, len(lines), len(np.unique(hashes)), sum(map(text.count, _END_MARKS)))


_KIND = pa.struct([(n, pa.int64()) for n in STATISTICS])


def _statistics(column: pa.Array) -> pa.Array:
    return pa.array([dict(zip(STATISTICS, text_statistics(t.as_py()), strict=True)) for t in column], _KIND)


def with_statistics(docs: DataFrame, name: str = "statistics", text_col: str = "text") -> DataFrame:
    """``docs`` with a struct of the text's statistics; it replaces a column of that name."""
    kind = "struct<" + ", ".join(f"{n}: long" for n in STATISTICS) + ">"
    return docs.withColumn(name, F.arrow_udf(_statistics, kind)(text_col))


def ratios(of: str) -> dict[str, Column]:
    """What the rules look at, from a struct of statistics; null without words or lines."""
    at = lambda n: F.col(of)[n]
    words = F.nullif(at("n_words"), F.lit(0))
    return {
        "words": at("n_words").cast("double"),
        "mean_word_chars": at("word_chars") / words,
        "symbols_per_word": at("n_symbols") / words,
        "repeated_lines": at("n_dup_lines") / F.nullif(at("n_lines"), F.lit(0)),
        "repeated_words": at("n_repeat_words") / words,
        "distinct_words": at("n_distinct_words") / words,
        "end_marks_per_word": at("n_end_marks") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x >= self.threshold if self.above else x < self.threshold

    def column(self, values: dict[str, Column]) -> Column:
        x = values[self.feature]
        return x >= self.threshold if self.above else x < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    for condition in rule:
        among = among & condition.holds(values)
    return among


def _grow(values, bad, among, most_conditions: int) -> Rule:
    """Add the condition of the highest information gain until the rule covers bad rows alone."""
    rule: Rule = ()
    while len(rule) < most_conditions:
        p, n = (among & bad).sum(), (among & ~bad).sum()
        if not p or not n:
            break
        now, best, gain = np.log2(p / (p + n)), None, 1e-9
        for feature, x in values.items():
            known = among & ~np.isnan(x)
            order = np.argsort(x[known], kind="stable")
            xs, ys = x[known][order], bad[known][order]
            cuts = np.flatnonzero(np.diff(xs) > 0) + 1
            if not len(cuts):
                continue
            ones = np.concatenate([[0], np.cumsum(ys)])
            below, total = ones[cuts], ones[-1]
            for above, hit, size in ((False, below, cuts), (True, total - below, len(xs) - cuts)):
                with np.errstate(divide="ignore"):
                    gains = np.where(hit > 0, hit * (np.log2(hit / size) - now), -np.inf)
                k = int(np.argmax(gains))
                if gains[k] > gain:
                    gain, best = gains[k], Condition(feature, above, float((xs[cuts[k] - 1] + xs[cuts[k]]) / 2))
        if best is None:
            break
        rule, among = (*rule, best), among & best.holds(values)
    return rule


def _prune(rule: Rule, values, bad, among) -> Rule:
    """Drop last conditions while (right - wrong) / covered, on rows not grown on, does not fall."""

    def worth(candidate: Rule) -> float:
        hit = _covered(candidate, values, among)
        return ((hit & bad).sum() - (hit & ~bad).sum()) / hit.sum() if hit.any() else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn_rules(
    values: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.9, least_covered: int = 5,
    most_rules: int = 20, most_conditions: int = 4, seed: int = 1,
) -> list[Rule]:
    """Ordered rules for ``bad`` rows; a rule counts if, of the rows left, it is right in ``least_precision``."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    draw = np.random.default_rng(seed)
    while len(rules) < most_rules and (left & bad).any():
        grow = draw.random(len(bad)) < 2 / 3
        rule = _prune(_grow(values, bad, left & grow, most_conditions), values, bad, left & ~grow)
        hit = _covered(rule, values, left)
        # One more of either kind keeps a few lucky rows from passing for a sure rule.
        if not rule or hit.sum() < least_covered or ((hit & bad).sum() + 1) / (hit.sum() + 2) < least_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit_quality_rules(
    rows: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 1, id_col: str = "doc_id", **options
) -> list[Rule]:
    """Rules from ``rows`` (an id and ``statistics``) and ``labels`` (doc_id, quality 0/1).

    Learned on ``sample_rows`` labelled rows at most, those of the smallest seeded hashes;
    only their numbers come to the driver. Null ids and labels are left out, of several
    labels of an id the lower counts. Without labels of both kinds there are no rules.
    """
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample_rows)
    own = rows.select(F.col(id_col).cast("long").alias("doc_id"), "statistics")
    # sample_rows rows of two numbers at most, so it may be sent to every task.
    known = own.join(F.broadcast(chosen), "doc_id")
    of = {n: F.coalesce(c, F.lit(float("nan"))).alias(n) for n, c in ratios("statistics").items()}
    table = known.select("doc_id", "quality", *of.values()).orderBy("doc_id", *of).toPandas()
    values = {n: table[n].to_numpy(float) for n in of}
    return learn_rules(values, table["quality"].to_numpy() == 0, seed=seed, **options)


def apply_rules(rules: list[Rule], of: str = "statistics") -> Column:
    """The number of the first rule that holds, from 1, as a CASE expression; 0 if none does."""
    values, case = ratios(of), F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & F.coalesce(condition.column(values), F.lit(False))
        case = F.when(holds, k).otherwise(case)
    return case


def judge_quality(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
    **options,
) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``rule`` (0: none holds) and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows
    of three. Such rows are not kept, others if no learned rule holds. Whole texts are read;
    null and empty texts have no words and fail; other columns are not read; repeated rows
    are judged each; no rows give no rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = work_table(with_statistics(slim).select("doc_id", "statistics"))
    rules = fit_quality_rules(rows, labels, sample_rows, seed, **options)
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return rows.withColumn("rule", apply_rules(rules)).select("doc_id", "statistics.*", "rule").withColumn(
        "base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
