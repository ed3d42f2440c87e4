"""The stages one after the other, against the operators' brute-force versions."""

from pathlib import Path

import numpy as np

import corpus_pipeline
from keelson.llm import simhash, toxicity
from keelson.llm.common import components, held_out, stored
from keelson.session import work_dir
from tests.llm.test_texts import brute_components, brute_lines

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_whole_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        steps[name] = docs
        assert name == "packing" or docs.columns == names
    pairs = {k: [(r.doc_id, r.text) for r in v.orderBy("doc_id").collect()] for k, v in steps.items() if k != "packing"}

    first = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = toxicity.judge(first, labels, held_out(5, 0)).where("predicted = 0").collect()
    assert [d for d, _ in pairs["toxicity"]] == sorted(r.doc_id for r in judged)

    cut = brute_lines(pairs["toxicity"], 48)
    assert pairs["line_dedup"] == [(d, cut[False, d, t]) for d, t in pairs["toxicity"]]

    kept = {d for d, _, least in brute_components(pairs["line_dedup"]) if d == least}
    assert pairs["near_dedup"] == [(d, t) for d, t in pairs["line_dedup"] if d in kept]

    grams = lambda t: [" ".join(w[i : i + 5]) for w in [words(t)] for i in range(len(w) - 4)]
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    items = [set(grams(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = [
        (d, t) for d, t in pairs["near_dedup"] for own in [set(grams(t))]
        if not any(x and len(x & own) >= 0.8 * len(x) for x in items)
    ]
    assert pairs["decontamination"] == clean and len(clean) < len(pairs["near_dedup"])

    rows = steps["packing"].toPandas()
    assert set(rows.doc_id) == {d for d, _ in clean}
    assert (rows.groupby("doc_id").length.sum() == rows.groupby("doc_id").doc_tokens.first()).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 1024


def test_stages_on_odd_and_empty_rows(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, FOLDER)
            assert name == "packing" or found.columns == docs.columns
            assert found.count() <= (docs.count() if name != "packing" else np.inf)


def test_a_changed_text_has_its_length(spark, odd):
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    rows = stage(spark, odd, FOLDER).select("text", "n_chars").collect()
    assert all((r.n_chars is None) if r.text is None else r.n_chars == len(r.text) for r in rows)
    assert simhash.keep_one(odd).count() < odd.count()


def shared(spark):
    return Path(work_dir(spark, "probe").removeprefix("file:")).parent


def test_only_the_result_of_a_run_stays_on_disk(spark):
    before = set(shared(spark).iterdir())
    found = corpus_pipeline.run(spark, FOLDER)
    (left,) = set(shared(spark).iterdir()) - before
    assert left.name.startswith("pipeline-") and len(list(left.iterdir())) == 1
    assert found.count() > 0


def test_rounds_of_components_leave_one_table(spark):
    before = set(shared(spark).iterdir())
    edges = spark.range(300).selectExpr("id AS u", "id + 1 AS v")
    found = components(edges, "path")
    (left,) = set(shared(spark).iterdir()) - before
    assert len(list(left.iterdir())) == 1
    assert found.where("root = 0").count() == 301
