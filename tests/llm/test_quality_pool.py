"""Co-training over all unlabelled documents on Spark."""

import numpy as np
from pyspark.sql import functions as F

from layerwright.llm import quality


def test_every_unlabelled_document_takes_part(spark):
    """More unlabelled documents than the former pool of 8000; the model is that of the arrays."""
    number = F.col("id")
    good = number % 2 == 0
    docs = spark.range(0, 9300, 1, 6).select(
        number.alias("doc_id"),
        F.concat(F.when(good, "fine prose words ").otherwise("JUNK 77 !!!! "), F.hex(F.xxhash64("id"))).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.xxhash64("id") % 10 == 0, "both").when(good, "books").otherwise("spam").alias("source"),
        F.lit(30).alias("n_chars"),
    )
    labels = docs.where("doc_id < 200").select("doc_id", F.expr("1 - doc_id % 2").alias("quality"))
    model = quality.train(docs, labels)
    cells = quality.Cells()
    rows = docs.collect()
    views = [
        np.array([quality.text_features(r["text"], cells) for r in rows]),
        np.array([quality.metadata_features(r["lang"], r["source"], r["n_chars"]) for r in rows]),
    ]
    marks = np.array([1 - r["doc_id"] % 2 if r["doc_id"] < 200 else -1 for r in rows])
    order = np.lexsort([*views[0].T[: quality.STYLE], marks])
    expected = quality.co_train(views[0][order], views[1][order], marks[order])
    assert np.allclose(model.text.middle, expected.text.middle, atol=1e-9)
    assert np.allclose(model.text.weights, expected.text.weights, atol=1e-5)
    assert np.allclose(model.metadata.weights, expected.metadata.weights, atol=1e-5)
    free = docs.where("doc_id >= 200").select("text", "lang", "source", "n_chars")
    sure = [(model.metadata, quality.Linear(np.zeros(1), np.ones(1), np.zeros(1), 9.0))]
    assert quality.spark_pool(free)([(0, sure, None)])[0] == 9100


def test_repeated_ids_and_labels(spark):
    """Rows under one labelled id are no matter of chance, and are not unlabelled ones."""
    rows = [(i, f"words {'fine' if i % 2 else 'JUNK !!'} {i}", "en", "s", 9) for i in range(60)]
    rows += [(i, f"other row {k} of {i}", "en", "s", 9) for i in range(8) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    models = [quality.train(docs.repartition(n), labels) for n in (1, 5)]
    assert np.allclose(models[0].text.weights, models[1].text.weights, atol=1e-6)
    marks = labels.select("doc_id")
    sure = [(models[0].metadata, quality.Linear(np.zeros(1), np.ones(1), np.zeros(1), 9.0))]
    assert quality.spark_pool(docs, marks)([(0, sure, None)])[0] == 40


def plain_fit(features, labels, ridge=1.0):
    """Penalised logistic regression by coordinate steps, another solver than that of the operator."""
    middle, scale = features.mean(0), features.std(0)
    scale = np.where(scale < 1e-7, 1.0, scale)
    given = (features - middle) / scale
    weights, offset = np.zeros(given.shape[1]), 0.0
    logits = np.zeros(len(given))
    for _ in range(400):
        moved = 0.0
        for j in [*range(given.shape[1]), -1]:
            column = given[:, j] if j >= 0 else np.ones(len(given))
            chance = 1 / (1 + np.exp(-logits))
            pull = ridge if j >= 0 else 1e-6
            at = weights[j] if j >= 0 else offset
            step = -(column @ (chance - labels) + pull * at) / ((column**2) @ (chance * (1 - chance) + 1e-6) + pull)
            logits += step * column
            if j >= 0:
                weights[j] += step
            else:
                offset += step
            moved = max(moved, abs(step))
        if moved < 1e-9:
            break
    return lambda x: ((x - middle) / scale) @ weights + offset


def plain_co_training(views, labels, rounds):
    """The rounds spelled out over arrays: labelled documents, every fourth of each kind apart."""
    apart = np.concatenate([np.flatnonzero(labels == kind)[::4] for kind in (0, 1)])
    learned = np.setdiff1d(np.flatnonzero(labels >= 0), apart)
    free = np.flatnonzero(labels < 0)

    def calibrated(model, view):
        curve = plain_fit(model(view[apart])[:, None], labels[apart], 0.1)
        return lambda x: curve(model(x)[:, None])

    models = [calibrated(plain_fit(v[learned], labels[learned]), v) for v in views]
    given = [np.full(len(free), -1), np.full(len(free), -1)]
    for _ in range(rounds):
        for teacher, pupil in ((0, 1), (1, 0)):
            chance = 1 / (1 + np.exp(-models[teacher](views[teacher][free])))
            fresh = given[pupil] < 0
            given[pupil][fresh & (chance >= 0.95)] = 1
            given[pupil][fresh & (chance <= 0.05)] = 0
        models = [
            calibrated(
                plain_fit(np.concatenate([v[learned], v[free][g >= 0]]), np.concatenate([labels[learned], g[g >= 0]])), v
            )
            for v, g in zip(views, given)
        ]
    both = lambda rows: np.stack([m(v[rows]) for m, v in zip(models, views)], 1)
    joint = plain_fit(both(apart), labels[apart], 0.1)
    return 1 / (1 + np.exp(-joint(both(np.arange(len(labels))))))


def test_scores_against_another_co_training():
    rng = np.random.default_rng(8)
    kind = rng.integers(0, 2, 700)
    views = [rng.normal(size=(700, n)) + kind[:, None] * np.linspace(1.2, 0.1, n) for n in (6, 4)]
    labels = np.where(np.arange(700) < 120, kind, -1)
    model = quality.co_train(*views, labels, rounds=1)
    found = model.scores(*views)[:, 0]
    assert np.allclose(found, plain_co_training(views, labels, 1), atol=2e-3)
