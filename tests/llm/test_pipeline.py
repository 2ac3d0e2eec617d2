"""The stages on planted documents, and the registration of the queries."""

import random

import corpus_pipeline
import pytest

import __spark_entry__ as entry_points
from ledgermill.llm.queries import QUERIES

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(2)
    folder = tmp_path_factory.mktemp("planted")
    vocabulary = [f"w{k}" for k in range(900)]

    def prose(n=120):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [prose(30) for _ in range(5)]
    kinds, rows, labels = {}, [], []

    def add(kind, text):
        kinds.setdefault(kind, []).append(len(rows))
        rows.append((len(rows), text, "en", "s", None if text is None else len(text)))

    for k in range(500):
        bad = k % 4 == 0
        words = prose().split()
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty"]))
        labels.append((len(rows), 0, int(bad)))
        add("toxic" if bad else "clean", " ".join(words))
    for k in range(10):
        copied = rows[kinds["clean"][k]][1]
        add("copy", copied)
        add("near", copied.replace(copied.split()[60], "edited", 1))
        add("leak", f"{prose()} {items[k % 5]} {prose(40)}")
        add("secret", f"{prose()} password = hunter2hunter2 {prose(10)}")
    add("clean", "")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), kinds, rows


def test_every_stage_takes_effect(spark, planted, tmp_path):
    folder, kinds, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == NAMES
    assert len(set(kinds["toxic"]) & set(left["toxicity"])) <= 0.05 * len(kinds["toxic"])
    assert len(set(kinds["clean"]) & set(left["toxicity"])) >= 0.97 * len(kinds["clean"])
    kept = left["near_copies"]
    assert not set(kinds["copy"] + kinds["near"]) & set(kept) and set(left["toxicity"]) - set(kept) == set(
        kinds["copy"] + kinds["near"]
    ) & set(left["toxicity"])
    assert set(kept) - set(left["decontamination"]) == set(kinds["leak"]) & set(kept)
    cleaned = [left["secrets"][k] for k in kinds["secret"] if k in left["secrets"]]
    assert cleaned and all("[assign]" in r.text and "hunter2" not in r.text and r.n_chars == len(r.text) for r in cleaned)
    assert set(left["secrets"]) == set(left["decontamination"]) == set(left["packing"])


def test_run_gives_the_pieces_of_the_last_stage(spark, planted):
    folder, _, rows = planted
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 100


def test_all_queries_are_registered():
    names = set(entry_points.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q != "pack_conversations"} and {*QUERIES, "pipeline"} <= names
