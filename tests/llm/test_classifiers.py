from __future__ import annotations

import numpy as np
import pytest

from wayfare.llm import features, quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(positive, negative) -> float:
    p, n = np.array(positive)[:, None], np.array(negative)[None, :]
    return float((p > n).mean() + 0.5 * (p == n).mean())


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.95), (toxicity, "toxic", 0.75)])
def test_held_out_accuracy(spark, module, label, least):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = module.score(documents, module.fit(documents, labels)).join(labels, "doc_id").where("held_out")
    rows = scored.select(label, "score", "predicted").collect()
    assert auc([r.score for r in rows if r[0] == 1], [r.score for r in rows if r[0] == 0]) >= least
    assert all(r.predicted == int(r.score >= module.THRESHOLD) for r in rows)


@pytest.mark.parametrize(("module", "label", "parts", "out"), [(quality, "quality", 5, 0), (toxicity, "toxic", 3, 1)])
def test_odd_rows_and_held_out_fold(spark, make_documents, odd_rows, module, label, parts, out):
    documents = make_documents(odd_rows)
    labels = spark.createDataFrame([(6, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = module.score(documents, module.fit(documents, labels)).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and features.remainder_of(r.doc_id, parts) == out) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in got if r.doc_id in (6, 7)}) == 1
    none = documents.limit(0)
    assert module.score(none, module.fit(none, labels.limit(0))).collect() == []


def test_held_out_labels_are_not_learned(spark, make_documents):
    rows = [(i, "bad!! text" if i % 2 else "plain text") for i in range(60)]
    documents = make_documents(rows)
    labels = [(i, 1 - i % 2, 0) for i in range(60)]
    flipped = [(i, q if features.remainder_of(i, 5) else 1 - q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    scores = [
        {r.doc_id: r.score for r in quality.score(documents, quality.fit(documents, spark.createDataFrame(x, schema))).collect()}
        for x in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(60_000) < 0.2
    toxic, clean = [0.8, 0.7, 0.6, 0.7, 0.5, 0.6], [0.05, 0.02, 0.1, 0.05, 0.02, 0.03]
    votes = np.stack([np.where(y, rng.random(len(y)) < a, rng.random(len(y)) < b) for a, b in zip(toxic, clean)], axis=1).astype(int)
    # Voter 1 copies voter 0: as many votes, but no more evidence.
    votes[:, 1] = votes[:, 0]
    full = np.concatenate([votes, np.ones((len(votes), 1), int)], axis=1)
    model = toxicity.fit_label_model((full.T @ full).astype(float), 0.2)
    assert np.allclose(model.toxic_rate[2:], toxic[2:], atol=0.06)
    assert np.allclose(model.clean_rate[2:], clean[2:], atol=0.03)
    assert model.evidence[0] < 0.7 < model.evidence[4]
    posterior = model.posterior(votes)
    assert auc(posterior[y], posterior[~y]) > 0.9


def test_ftrl_equals_plain_updates():
    """Against the textbook form of the updates, coordinate by coordinate."""
    vectors = [(np.array([0, 2]), np.array([1.0, 0.5], np.float32)), (np.array([1]), np.array([1.0], np.float32))] * 6
    labels = np.array([1, 0] * 6, float)
    model = features.fit_ftrl(vectors, labels, 2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2, passes=2, seed=1)
    z, n = {}, {}
    order = np.random.Generator(np.random.PCG64(1))

    def weight(i):
        own = z.get(i, 0.0)
        return 0.0 if abs(own) <= 0.1 else -(own - np.sign(own) * 0.1) / ((1 + np.sqrt(n.get(i, 0.0))) / 0.5 + 0.2)

    for _ in range(2):
        for k in order.permutation(len(vectors)):
            x = dict(zip(vectors[k][0].tolist(), vectors[k][1].tolist())) | {4: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - labels[k]) * v
                z[i] = z.get(i, 0.0) + g - (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / 0.5 * w[i]
                n[i] = n.get(i, 0.0) + g * g
    assert np.allclose(model.dense(), [weight(i) for i in range(4)], atol=1e-6)
    assert np.isclose(model.bias, weight(4))
