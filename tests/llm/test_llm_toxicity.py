"""Toxicity (op2): gradients, held-out accuracy, defined cases."""
import numpy as np
from llm_cases import awkward, documents, prose

from tidewatch.llm import toxicity as T
from tidewatch.llm.common import fold


def test_risk_gradient_is_numeric_gradient():
    r = np.random.default_rng(1)
    for prior, shift in ((0.2, 0.0), (0.4, -4.0)):  # the second has a negative part that counts as 0
        zp, zu = r.normal(size=5) + 4, r.normal(size=7) + shift
        _, dp, du = T.nn_pu_step(zp, zu, prior)
        for z, d in ((zp, dp), (zu, du)):
            for k in range(len(z)):
                z[k] += 1e-5
                hi = T.nn_pu_step(zp, zu, prior)[0]
                z[k] -= 2e-5
                lo = T.nn_pu_step(zp, zu, prior)[0]
                z[k] += 1e-5
                assert abs((hi - lo) / 2e-5 - d[k]) < 1e-5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = T.q_op2(spark, sf).filter("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    positive = [r for r in got if r.toxic == 1]
    assert sum(r.predicted for r in positive) >= 0.8 * len(positive)
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.01 * len(got)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows = [(k, prose(k, 30) + (" awful" if k % 4 == 0 else "")) for k in range(400)]
    docs = documents(spark, rows)
    true = [(k, 1, int(k % 4 == 0)) for k in range(400)]
    flipped = [(k, q, 1 - t if fold(k, 5) == 0 else t) for k, q, t in true]
    a, b = (T.score(docs, T.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))).collect() for x in (true, flipped))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in a)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in a)


def test_awkward_rows_and_missing_labels(spark):
    rows = awkward()
    docs = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in T.score(docs, T.fit(docs, none)).collect()] == [0.0] * len(rows)
    some = spark.createDataFrame([(k, 1, t) for k, t in ((7, 1), (9, None), (9, 1), (10, 0), (11, 1), (None, 1), (13, 0))],
                                 "doc_id long, quality int, toxic int")
    got = T.score(docs, T.fit(docs, some)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert T.score(documents(spark, []), T.fit(docs, some)).count() == 0
    kept = T.keep_clean(docs, T.fit(docs, some))
    assert kept.columns == docs.columns
