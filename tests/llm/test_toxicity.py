"""The ordinal fit on drawn grades, held-out labels, and awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm.toxicity import OrdinalModel, drop_toxic, fit_ordinal, fit_toxicity, score_toxicity

BASE = "/root/testdata/sf0.1"


def test_fit_recovers_weights_and_ordered_thresholds():
    draw = np.random.default_rng(1)
    n, true, bounds = 6000, np.array([2.0, -1.0, 0.0]), np.array([-0.5, 1.0, 2.5])
    x = draw.random((n, 3)) < 0.5
    score = x @ true + draw.logistic(size=n)
    grades = np.searchsorted(bounds, score)
    rows, columns = np.nonzero(x)
    weights, thresholds = fit_ordinal(np.ones(len(rows)), columns, rows, grades, 3, 0.0, 0.0, 1500)
    assert np.abs(weights - true).max() < 0.2 and np.abs(thresholds - bounds).max() < 0.2
    assert (np.diff(thresholds) > 0).all()


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{BASE}/{n}.parquet") for n in ("documents", "labels"))
    part = F.expr("pmod(xxhash64(doc_id, 3), 3)")
    model = fit_toxicity(docs, labels.where(part > 0))
    assert sorted(model.thresholds) == model.thresholds and len(model.thresholds) >= 2
    got = score_toxicity(docs, model).join(labels.where(part == 0).select("doc_id", F.col("toxic").alias("label")), "doc_id")
    r = got.agg(F.avg(F.expr("if(label = 1, if(toxic, 1, 0), null)")).alias("caught"),
                F.avg(F.expr("if(label = 0, if(toxic, 1, 0), null)")).alias("wrong")).first()
    assert r.caught > 0.9 and r.wrong < 0.01


def test_awkward_rows(rows, spark):
    model = OrdinalModel({"bad": 3.0, "awfu*": 2.0}, [2.0, 4.5])
    pairs = [(None, None), (1, ""), (2, "Bad!"), (2, "Bad!"), (3, "fine " * 200_000 + "bad"), (4, "awfully BAD bad"), (5, "badly fine")]
    df = rows(pairs).withColumns({n: F.lit(n) for n in ("row", "steps", "grade", "toxic")})
    got = {(r.doc_id, r.grade, r.toxic) for r in score_toxicity(df, model).collect()}
    assert got == {(None, 0, False), (1, 0, False), (2, 1, True), (3, 1, True), (4, 2, True), (5, 0, False)}
    out = score_toxicity(df, model)
    assert "steps" in out.columns and out.count() == 7
    left = drop_toxic(df, model)
    assert left.columns == df.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 5]
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    none = fit_toxicity(df, labels)
    assert none == OrdinalModel() and drop_toxic(df, none).count() == 7
    assert score_toxicity(rows([]), model).count() == 0
