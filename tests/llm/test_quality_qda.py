"""The discriminant against formulas, and its held-out accuracy."""
import math
import zlib

import numpy as np
import pytest

from quaybook.llm import quality_qda as Q
from quaybook.llm.queries import op3_quadratic_discriminant
from quaybook.sources.tables import read_table

SF01 = "/root/testdata/sf0.01"


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(1)
    x = [rng.normal(0, 1, (80, 4)) @ rng.normal(0, 1, (4, 4)) + c for c in (0, 2)]
    n = np.array([80.0, 80.0])
    m = Q.fit_moments(n, np.stack([v.sum(0) for v in x]), np.stack([v.T @ v for v in x]))
    z = (x[0] - m.centre) / m.scale
    logs = []
    for c in (0, 1):
        cov = m.factor[c] @ m.factor[c].T
        away = z - m.mean[c]
        logs.append(-0.5 * np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov), away) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(m.scores(x[0]), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_every_score_against_plain_numpy(spark):
    """Covariances, both shrinkages and densities worked out from the rows
    themselves, without the operator's moments or factors."""
    sf = "/root/testdata/sf0.001"
    quality = {r.doc_id: r.quality for r in read_table(spark, sf, "labels").collect()}
    x = {r.doc_id: np.array(Q.statistics(r.text or "")) for r in read_table(spark, sf, "documents").collect()}
    train = [d for d in x if zlib.crc32(str(d).encode()) % 5 and quality.get(d) is not None]
    seen = np.array([x[d] for d in train])
    middle, spread = seen.mean(axis=0), seen.std(axis=0)
    assert spread.min() > 1e-3  # so the floor under the scales plays no part
    own = [np.array([(x[d] - middle) / spread for d in train if quality[d] == c]) for c in (0, 1)]
    share = [len(a) / len(train) for a in own]
    covs = [np.cov(a, rowvar=False, bias=True) for a in own]
    both = share[0] * covs[0] + share[1] * covs[1]
    shrunk = []
    for cov in covs:
        mixed = 0.8 * cov + 0.2 * both
        shrunk.append(0.95 * mixed + 0.05 * np.trace(mixed) / len(mixed) * np.eye(len(mixed)))
    got = {r.doc_id: r.score for r in op3_quadratic_discriminant(spark, sf).collect()}
    assert set(got) == set(x)
    for d, v in x.items():
        logs = []
        for a, cov, prior in zip(own, shrunk, share, strict=True):
            away = (v - middle) / spread - a.mean(axis=0)
            logs.append(np.log(prior) - 0.5 * (away @ np.linalg.inv(cov) @ away + np.linalg.slogdet(cov)[1]))
        assert got[d] == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))), abs=1e-8)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op3_quadratic_discriminant(spark, SF01).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    labels = [r for r in read_table(spark, SF01, "labels").collect() if rows[r.doc_id].held_out]
    right = sum(rows[r.doc_id].predicted == r.quality for r in labels)
    assert right / len(labels) > 0.95


def test_nulls_empty_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, "a b c", 5), (2, None, 5), (2, "", 5), (None, "x" * 9000, 5)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit(Q.training_rows(Q.vectors(docs), none))
    assert [r.score for r in Q.score(Q.vectors(docs), model).collect()] == [0.5] * 4
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (1, 1)], "doc_id long, quality int")
    assert Q.fit(Q.training_rows(Q.vectors(docs), one)).prior == 1.0
    both = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    model = Q.fit(Q.training_rows(Q.vectors(docs), both))
    scores = [r.score for r in Q.score(Q.vectors(docs), model).collect()]
    assert len(scores) == 4 and all(math.isfinite(s) for s in scores) and scores[1] == scores[2]
    assert Q.score(Q.vectors(docs.limit(0)), model).collect() == []
    kept = Q.accepted(docs, model)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("text", ["", " ", "\n\n", "\ud83d", "a" * 10, "a a a", "é%%% $$", "1\t2\n3"])
def test_statistics_are_finite(text):
    v = Q.statistics(text)
    assert len(v) == len(Q.FEATURES) and all(map(math.isfinite, v))
