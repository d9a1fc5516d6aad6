"""Classifiers: held-out accuracy on the driver's tables, and their parts on small cases."""

from __future__ import annotations

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkgrain.llm import line_quality, toxicity

SF = "/root/testdata/sf0.1"


def test_forward_backward():
    rnd = np.random.default_rng(1)
    scores, table, sizes = rnd.normal(size=7), rnd.normal(size=(2, 2)), np.array([3, 1, 3])
    marginal, pairs, total = line_quality.forward_backward(scores, sizes, table)
    at, expected, expected_pairs, logs = 0, np.zeros(7), np.zeros((2, 2)), 0.0
    for n in sizes:
        weights = {y: np.exp(sum(scores[at + k] * y[k] for k in range(n)) + sum(table[a, b] for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(weights.values())
        for y, w in weights.items():
            for k in range(n):
                expected[at + k] += w / z * y[k]
            for a, b in zip(y, y[1:]):
                expected_pairs[a, b] += w / z
        logs, at = logs + np.log(z), at + n
    assert np.allclose(marginal, expected) and np.allclose(pairs, expected_pairs) and np.isclose(total, logs)


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 0, 1, 0, 1, 1]))
    assert (np.diff(y) >= 0).all() and y[0] < 0.1 and y[-1] > 0.9 and np.interp(3.5, x, y) == pytest.approx(0.5, abs=0.05)


def test_trees():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    margin = toxicity.Trees.fit(x[:1500], y[:1500]).margin(x[1500:])
    assert ((margin > 0) == y[1500:]).mean() > 0.95


@pytest.fixture(scope="module")
def small(spark):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        said = [rnd.choice(words) for _ in range(30)]
        toxic, bad = k % 4 == 0, k % 5 == 0
        if toxic:
            said[5:5] = ["you", rnd.choice(["grimble", "grimbly", "snark"]), rnd.choice(["grimble", "snark"])]
        rows.append((k, (" ".join(said).upper() + "!!!") if bad else ".\n".join((" ".join(said[:12]), " ".join(said[12:]))) + "."))
        labels.append((k, 0 if bad else 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "text of nobody"), (1002, "w " * 20_000), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("score"), F.lit(2).alias("_text"), F.lit(3).alias("label"))
    return docs, spark.createDataFrame([*labels, (7, None, None), (None, 1, 1), (8, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int"), len(rows)


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (line_quality, "quality")])
def test_small_models(small, module, label):
    docs, labels, n = small
    rows = module.score(docs, module.train(docs, labels)).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.85
    assert module.score(docs.limit(0), module.train(docs.limit(0), labels)).count() == 0
    assert {r.score for r in module.score(docs, module.train(docs, labels.limit(0))).collect()} == {0.0}


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize(("module", "label", "least"), [(toxicity, "toxic", 0.97), (line_quality, "quality", 0.95)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = module.score(docs, module.train(docs, labels)).where("held_out").join(labels, "doc_id")
    right, n = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 100 and right >= least
