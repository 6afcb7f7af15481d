"""The pipeline against its stages' brute-force decisions on a small table."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airwave.llm import curriculum_mix, decontaminate, quality_rules, secret_scan
from airwave.llm.common import scratch_dir
from tests.conftest import SF


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF).collect()
        out.append((docs, rows))
        docs = spark.createDataFrame(rows, docs.schema) if len(out) < len(corpus_pipeline.STAGES) else None
    return out


def least_of_groups(texts):
    """The least id of each group of texts that are linked by a five-word Jaccard similarity of 0.8 or more."""
    sets = {}
    for d, t in texts.items():
        ws = [w.lower() for w in (t or "").encode().split()]
        sets[d] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}
    root = {d: d for d in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in itertools.combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if 5 * small >= 4 * large and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {find(d) for d in sets}


def test_stages_keep_columns_and_decide(spark, stages):
    for docs, rows in stages[:-1]:
        assert set(rows[0].asDict()) == set(docs.columns)
    docs, rows = stages[0]
    assert {r.doc_id for r in rows} == {r.doc_id for r in quality_rules.op1_quality_rules(docs).where("kept").collect()}
    docs, rows = stages[1]
    before = docs.collect()
    assert {r.doc_id for r in rows} == least_of_groups({r.doc_id: r.text for r in before})
    docs, rows = stages[2]
    bad = {r.doc_id for r in decontaminate.op7_decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert bad and {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} - bad
    docs, rows = stages[3]
    assert len(rows) == docs.count()
    again = secret_scan.secrets(spark.createDataFrame(rows, docs.schema)).where(F.exists("spans", lambda s: s["kind"] != "random"))
    assert not again.count()
    docs, rows = stages[4]
    taken = {r.doc_id: r.taken for r in curriculum_mix.op10_curriculum_mix(docs).collect()}
    words = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    for d, n in taken.items():
        assert n == words[d] * sum(r.doc_id == d for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.copy) for r in got.select("doc_id", "copy").collect()) == sorted((r.doc_id, r.copy) for r in stages[-1][1])


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, kept string, size string, removed string, spans string, copy string, position string"
    body = " ".join(f"word{i} and{i % 7}" for i in range(80))
    texts = [None, "", "\n \t", body, body, body + " more", body.replace("word3 ", "other "), "x" * 50_000, "tok " * 30_000, body + " password=Abcdefgh12345678"]
    rows = [(i, t, None, "s" if i % 2 else None, None, *"abcdefg") for i, t in enumerate(texts)] + [(None, body + " without id", None, None, None, *"abcdefg")] * 2
    rows += [rows[3], (None,) * 12]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        got = made.collect()
        if name == "mixing":
            assert {"copy", "position"} <= set(made.columns) and got
            assert [r.position for r in got] == sorted(r.position for r in got)
        else:
            assert made.columns == docs.columns
        if name in ("decontamination", "secrets"):
            assert len(got) == len(rows)
        if name == "near_duplicates":
            assert len({r.doc_id for r in got}) == len([r for r in got if r.doc_id is not None]) + (None in {r.doc_id for r in got})
        if name == "secrets":
            assert not any("Abcdefgh12345678" in (r.text or "") for r in got)
    for name, stage in corpus_pipeline.STAGES:
        assert not stage(spark, docs.limit(0), SF).count(), name


def test_run_leaves_its_last_result_only(spark):
    """Tables that stages wrote, and results that the next stage has read, are deleted."""
    folder = f"{scratch_dir(spark)}/airwave"
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, SF).count()
    left = [p for p in os.listdir(folder) if p not in before]
    assert rows and len(left) == 1 and left[0].startswith("pipeline-mixing"), left
