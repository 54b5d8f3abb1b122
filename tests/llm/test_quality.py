import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltworks.llm import quality
from smeltworks.llm.quality import NAMES, best_bin, class_prior, fit, risk_gradient, statistics


def drawn(rng, good, n):
    return rng.normal(0.0 if good else 2.5, 1.0, (n, len(NAMES)))


def mixed(prior, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    bad = rng.random(n) >= prior
    rows = drawn(rng, True, n)
    rows[bad] = drawn(rng, False, bad.sum())
    return drawn(rng, True, n // 2), rows, bad


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_classes_come_out_of_unlabelled_rows(prior):
    positives, unlabelled, bad = mixed(prior)
    model = fit(positives, unlabelled)
    assert abs(model.prior - prior) < 0.06
    z = (unlabelled - np.array(model.mean)) / np.array(model.scale) @ np.array(model.weights) + model.bias
    good = 1 / (1 + np.exp(-z)) >= quality.CUT
    assert np.mean(good == ~bad) > 0.97


def test_gradient_is_that_of_the_risk():
    positives, unlabelled, _ = mixed(0.5, n=200)
    rng = np.random.default_rng(3)
    for prior in (0.2, 0.95):
        w = rng.normal(0, 0.3, len(NAMES))

        def risk(w, prior=prior):
            lose = lambda rows, sign: np.logaddexp(0, -sign * (rows @ w)).mean()
            bad = lose(unlabelled, -1) - prior * lose(positives, -1)
            return prior * lose(positives, 1) + bad if bad >= 0 else -bad

        steps = np.eye(len(w)) * 1e-6
        slopes = [(risk(w + s) - risk(w - s)) / 2e-6 for s in steps]
        assert np.allclose(risk_gradient(w, positives, unlabelled, prior), slopes, atol=1e-5)


def test_best_bin_of_separable_scores():
    assert best_bin(np.linspace(1, 2, 500), np.r_[np.linspace(1, 2, 500), np.linspace(-2, -1, 500)]) == pytest.approx(0.5, abs=0.05)
    assert 0.02 <= class_prior(np.zeros((1, 3)), np.zeros((5, 3))) <= 0.98


def test_statistics_by_hand():
    got = dict(zip(NAMES, statistics("Ab cd, cd,\n\n12 é"), strict=True))
    assert got["letters"] == pytest.approx(8 / 17) and got["capitals"] == pytest.approx(1 / 8) and got["digits"] == pytest.approx(2 / 17)
    assert (got["repeats"], got["distinct"], got["commonest"], got["wordless"]) == (0.25, 0.8, 0.4, 0.0)
    assert statistics(None) == statistics("") and statistics(" \n")[NAMES.index("wordless")] == 1.0
    assert all(np.isfinite(statistics("x" * 3_000_000)))


def test_held_out_quality_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out and 0 <= r.score <= 1 for r in got)
    right = [r.predicted == r.quality for r in got]
    assert len(right) > 50 and np.mean(right) >= 0.95 and np.mean([r.predicted == 0 for r in got if r.quality == 0]) >= 0.8
    # The score orders nearly all pairs of a good and a bad document rightly.
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_labels_of_held_out_documents_change_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((r.doc_id, round(r.score, 9)) for r in quality.quality(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, None), (None, 1), (8, 1), (12, 0), (99, 1)], "doc_id bigint, quality int")
    assert sorted(r.doc_id for r in quality.trusted(labels).collect()) == [2, 8, 99]
    clashing = docs.withColumns({c: F.lit("x") for c in ("words", "held_out", "quality", "predicted")})
    got = quality.quality(clashing, labels.withColumn("text", F.lit("y"))).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[8]) == 1 and by_id[3] == by_id[4] and not any(r.held_out for r in got if r.doc_id is None)
    assert {r.score for r in quality.quality(docs, labels.where("false")).collect()} == {0.5}
    assert quality.quality(no_docs, labels).isEmpty()
