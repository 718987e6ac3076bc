import zlib

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector

from stockwave.llm import quality_model as qm
from stockwave.llm.common import table

from samples import SF, sentence


@pytest.fixture(scope="module")
def fitted(spark):
    folder = "/root/testdata/sf0.1"
    return qm.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def test_held_out_accuracy(spark, fitted):
    folder = "/root/testdata/sf0.1"
    scored = qm.with_score(table(spark, folder, "documents"), fitted).join(table(spark, folder, "labels"), "doc_id").collect()
    good, bad = (np.array([r.score for r in scored if r.quality == q and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]) for q in (1, 0))
    auc = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert auc > 0.99, auc
    assert (good >= qm.THRESHOLD).mean() > 0.99 and (bad < qm.THRESHOLD).mean() > 0.9


def test_linear_time_score_equals_all_pairs(fitted):
    at, x = qm.features(sentence(3, 60) + " !!! $$$ 12", None, qm.WordSlots(), qm.class_of_byte())
    own = fitted.factors[at]
    pairs = sum(float(own[i] @ own[j]) * x[i] * x[j] for i in range(len(at)) for j in range(i + 1, len(at)))
    margin = fitted.intercept + float(fitted.linear[at] @ x) + pairs
    assert fitted.score(at, x) == pytest.approx(1 / (1 + np.exp(-margin)))


def test_odd_rows(odd_docs, no_docs, fitted):
    scored = qm.with_score(odd_docs, fitted, "_s")
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r._s <= 1 for r in rows)
    assert qm.with_score(no_docs, fitted).count() == 0


def test_labels_are_not_read_from_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    first = qm.fit(docs, labels)
    flipped = labels.withColumn("quality", qm.F.when(qm.is_held_out(), 1 - qm.F.col("quality")).otherwise(qm.F.col("quality")))
    second = qm.fit(docs, flipped)
    assert first.intercept == pytest.approx(second.intercept) and np.allclose(first.linear, second.linear)


def test_degenerate_labels(spark, odd_docs, no_docs):
    def model(rows, docs=odd_docs):
        return qm.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, text string"))

    def score(m):
        return m.score(*qm.features("a b", None, qm.WordSlots(), qm.class_of_byte()))

    assert score(model([])) == 0.5
    assert score(model([(3, 1, "x"), (4, 1, "y")])) > 0.99
    assert score(model([(3, None, "x"), (None, 1, "x"), (3, 0, "x")])) < 0.01
    assert score(model([(3, 1, "x")], no_docs)) == 0.5
    assert 0 <= score(model([(3, 0, "x"), (3, 1, "x"), (4, 0, "x"), (4, 0, "x"), (7, 1, "z")])) <= 1


def test_sparse_vectors(spark):
    rows = spark.createDataFrame([(1.0, [0, 5], [0.5, 2.0]), (0.0, [], [])], "label double, at array<int>, x array<double>")
    found = {r.label: r.features for r in qm.sparse_vectors(rows).collect()}
    assert found == {1.0: SparseVector(qm.SIZE, {0: 0.5, 5: 2.0}), 0.0: SparseVector(qm.SIZE, {})}
