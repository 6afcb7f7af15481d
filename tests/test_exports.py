"""Exports in order, and extractors that are saved."""

import uuid

import pytest
from pyspark.sql import functions as F

from airwave.operators import exports, features


@pytest.mark.parametrize("part_rows", [7, 1000])
def test_order_places_and_pointers(spark, part_rows):
    rows = [(k, " ".join("x" * (k % 5))) for k in range(200, 0, -3)] + [(999, "")]
    lines = spark.createDataFrame(rows, "id int, line string").repartition(5)
    n = F.when(F.col("line") == "", 0).otherwise(F.size(F.split("line", " ")))
    got = {r.id: (r.line, r.row, r.pointer) for r in exports.ordered_export(lines, "id", n, part_rows).collect()}
    at, want = 0, {}
    for place, (k, line) in enumerate(sorted(rows)):
        want[k] = (line, place, at)
        at += len(line.split())
    assert got == want


def test_part_files_one_after_the_other_are_the_export(spark, tmp_path):
    lines = spark.createDataFrame([(k, f"line {k}") for k in range(100)], "id int, line string").repartition(7)
    exports.write_ordered(lines, "id", str(tmp_path), part_rows=16)
    parts = sorted((tmp_path / "lines").glob("part=*"), key=lambda p: int(p.name[5:]))
    files = [list(p.glob("*.txt")) for p in parts]
    assert [len(f) for f in files] == [1] * 7
    assert "".join(f[0].read_text() for f in files).splitlines() == [f"line {k}" for k in range(100)]


def test_empty_export(spark):
    lines = spark.createDataFrame([], "id int, line string")
    assert exports.ordered_export(lines, "id").collect() == []


def test_saved_extractor_gives_the_same_rows_and_serves_unseen_items(spark):
    known = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "a"), (3, "d")], "item int, name string")
    weights = spark.createDataFrame([(0, 0, 2.0), (1, 0, 3.0), (2, 1, 5.0)], "idx int, k int, w double")
    fitted = features.Extractor.fitted(known, drop=(1,), normalise=True, coefficients=weights)
    loaded = fitted.save(f"test-{uuid.uuid4().hex}")
    rows = lambda e, pairs: sorted((r.id, r.idx, round(r.value, 6)) for r in e.transform(pairs).collect())
    assert sorted((r.idx, r["name"]) for r in loaded.vocabulary.collect()) == [(0, "a"), (1, "c"), (2, "d")]
    assert rows(loaded, known) == rows(fitted, known)
    unseen = spark.createDataFrame([(9, "a"), (9, "c"), (9, "new"), (8, "new"), (7, "b")], "item int, name string")
    half = 2**-0.5
    assert rows(loaded, unseen) == [(9, 0, round(half, 6)), (9, 1, round(half, 6)), (9, 3, round(5 * half, 6))]
