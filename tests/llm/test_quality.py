import zlib

import numpy as np
import pandas as pd
import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import quality

LABEL = "doc_id bigint, quality int, toxic int"


def spoiled(rows):
    return [doc(r[0], r[1] if r[0] % 3 else " ".join(w + "###" for w in r[1].split()), r[3]) for r in rows]


def test_trees_equal_a_walk_node_by_node():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, 6)), rng.integers(0, 2, 500).astype(float)
    y[x[:, 2] > 0] = 1
    model = quality.fit(x, y, trees=7, depth=3)
    for row, score in zip(x, model.score(x), strict=True):
        total = model.start
        for t in range(7):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + (2 if row[model.feature[t, node]] > model.threshold[t, node] else 1)
            total += model.leaf[t, node - model.feature.shape[1]]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_trees_learn_an_interaction():
    x = np.random.default_rng(2).uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


def test_held_out_documents_are_told_apart(spark):
    rows = spoiled(prose(600))
    labels = [(r[0], int(r[0] % 3 != 0), 0) for r in rows] + [(None, 1, 0), (3, None, 0), (9999, 1, 0)]
    got = quality.quality_scores(with_clashes(frame(spark, rows + odd_rows()[3:6])), frame(spark, labels, LABEL)).toPandas()
    assert len(got) == len(rows) + 3 and got["score"].between(0, 1).all()
    for r in got.dropna(subset=["doc_id"]).itertuples():
        assert r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5)
    own = got[got["doc_id"].isin([r[0] for r in rows if len(r[1].split()) > 5]) & got["held_out"]]
    assert (own["predicted"] == (own["doc_id"] % 3 != 0)).mean() > 0.95


def test_held_out_labels_teach_nothing(spark):
    rows = spoiled(prose(200))
    honest = [(r[0], int(r[0] % 3 != 0), 0) for r in rows]
    lying = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in honest]
    docs = frame(spark, rows)
    a, b = (quality.quality_scores(docs, frame(spark, x, LABEL)).toPandas().sort_values("doc_id")["score"].to_numpy() for x in (honest, lying))
    assert (a == b).all()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (7, 1, 0)], [(1, 0, 0)]], ids=["none", "good only", "bad only"])
def test_poor_labels(spark, labels):
    got = quality.quality_scores(frame(spark, odd_rows()), frame(spark, labels, LABEL)).toPandas()
    assert got["score"].nunique() == 1 and len(got) == len(odd_rows())
    assert got["predicted"].iloc[0] == int(not labels or labels[0][1])


def test_rejected_rows_go(spark):
    rows = spoiled(prose(300))
    labels = frame(spark, [(r[0], int(r[0] % 3 != 0), 0) for r in rows], LABEL)
    docs = with_clashes(frame(spark, rows))
    left = quality.keep_good(docs, labels)
    good = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == good


def test_empty(spark):
    assert quality.quality_scores(spark.createDataFrame([], DOC), frame(spark, [(1, 1, 0)], LABEL)).count() == 0
    assert isinstance(quality._matrix(pd.Series([], dtype=str)), np.ndarray)
