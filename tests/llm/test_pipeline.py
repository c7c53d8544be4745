from __future__ import annotations

import random

import pytest

import corpus_pipeline
from wayfare.llm import mixing, toxicity
from wayfare.runtime import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents with planted toxic ones, repeated passages, near copies and benchmark items."""
    rng = random.Random(11)
    words = [f"plain{i}" for i in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{text(25)}. {text(6)}.") for i in range(6)]
    passage = text(60)
    rows: dict[int, str | None] = {i: f"{text(60)}\n{text(15)}" for i in range(240)}
    toxic = set(range(0, 240, 6))
    for i in toxic:
        at = rows[i].split()
        at[5:5] = rng.sample(["zzinsultone", "zzinsulttwo", "idiot", "moron", "scum"], 4)
        rows[i] = " ".join(at)
    repeats = [1000, 1001, 1002]
    rows |= {i: f"{text(30)}\n{passage}\n{text(30)}" for i in repeats}
    copies = [1100, 1101, 1102]
    rows |= {i: rows[1].replace("\n", " ") + f" tail{i}" for i in copies}
    leaks = [1200 + i for i in range(6)]
    rows |= {i: f"{text(30)} {items[i - 1200][1]} {text(30)}" for i in leaks}
    rows |= {1300: None, 1301: "", 1302: rows[3]}
    path = str(tmp_path_factory.mktemp("corpus"))
    data = [(i, t, "en", f"s{i % 4}" if i % 50 else None, None if t is None else len(t)) for i, t in rows.items()]
    data.append((None, text(50), "en", "s0", 1))
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, {"toxic": toxic, "repeats": repeats, "copies": copies, "leaks": leaks, "passage": passage}


def test_each_stage_does_its_part(spark, corpus):
    path, rows, planted = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
    ]
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path))
        seen.append({r.doc_id: r for r in docs.collect()})
    for stage in seen[:4]:
        assert all(list(r.asDict()) == COLUMNS for r in stage.values())
    clean = set(range(240)) - planted["toxic"]
    accepted, cut, single, free, mixed = seen
    assert len(planted["toxic"] - set(accepted)) >= 0.95 * len(planted["toxic"])
    assert clean | {1300, 1301, None} <= set(accepted)
    # The passage stays where it is first, the rest of the later texts stays as well.
    assert [planted["passage"] in cut[i].text for i in planted["repeats"]] == [True, False, False]
    assert all(cut[i].n_chars == len(cut[i].text) for i in planted["repeats"][1:])
    assert 1302 not in cut and all(cut[i].text == rows[i] for i in clean)
    assert len({1, *planted["copies"]} & set(single)) == 1 and 1 in single
    assert set(cut) - set(single) == set(planted["copies"])
    assert set(single) - set(free) == set(planted["leaks"])
    # The last stage is the mix of what is left.
    left = spark.createDataFrame([tuple(r) for r in free.values()], "doc_id long, text string, lang string, source string, n_chars long")
    expected = {r.doc_id: r.taken for r in mixing.mix(left).collect() if r.taken}
    assert {i: r.taken for i, r in mixed.items()} == expected
    assert all(mixed[i].text == free[i].text for i in mixed)
    # run() is the same chain.
    assert {r.doc_id: r.taken for r in corpus_pipeline.run(spark, path).collect()} == expected


def test_toxicity_stage_equals_the_classifier(spark, corpus):
    path, _, _ = corpus
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rejected = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    kept = {r.doc_id for r in corpus_pipeline.without_toxic(spark, docs, path).collect()}
    assert kept.isdisjoint(rejected)
    assert kept | rejected == {r.doc_id for r in docs.collect()}


def test_stages_take_an_empty_table(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path))
    assert docs.collect() == []
