"""JSON documents cut into objects by many tasks."""

import json

import numpy as np
import pytest
from pyspark.errors import PySparkException

from quarrystone.sources import files, objects


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("700", "1", "3")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def made(rng, n):
    """Objects with nested parts and with braces, quotes and backslashes in their texts; some longer than a split."""
    letters = list('ab{}[]",\\: é\n')
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(n)]
    texts[n // 2] = '}{"' * 900
    return [{"id": i, "text": t, "deep": {"list": [{"x": i}, {"y": t[:3]}], "none": None}} for i, t in enumerate(texts)]


def read(spark, path, **options):
    rows = objects.read_objects(spark, str(path), **options).collect()
    return sorted((json.loads(r["value"]) for r in rows), key=lambda r: r["id"])


@pytest.mark.parametrize("indent", [None, 1])
def test_array_over_many_splits(spark, tmp_path, small_splits, indent):
    rows = made(np.random.default_rng(3), 120)
    (tmp_path / "a.json").write_text(json.dumps(rows[:100], indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("\n " + json.dumps(rows[100:], indent=indent) + "\n")
    assert read(spark, tmp_path) == rows
    splits = {(r["file"], r["start"]) for r in objects.read_objects(spark, str(tmp_path)).collect()}
    assert len(splits) > 15
    table = files.load_json(spark, str(tmp_path), schema="id bigint, text string, deep struct<list:array<struct<x:bigint,y:string>>>")
    assert {r["id"]: r["text"] for r in table.collect()} == {r["id"]: r["text"] for r in rows}


def test_single_objects_and_other_encodings(spark, tmp_path, small_splits):
    rows = made(np.random.default_rng(4), 6)
    folder = tmp_path / "each"
    folder.mkdir()
    for row in rows:
        (folder / f"{row['id']}.json").write_text(json.dumps(row) + "\n" * (row["id"] % 2))
    assert read(spark, folder) == rows
    (tmp_path / "wide.json").write_bytes(json.dumps(rows, ensure_ascii=False).encode("utf-16"))
    assert read(spark, tmp_path / "wide.json", encoding="utf-16") == rows
    (tmp_path / "marked.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(rows).encode())
    assert read(spark, tmp_path / "marked.json") == rows


def test_empty_arrays_and_broken_documents(spark, tmp_path):
    (tmp_path / "none.json").write_text("[ ]\n")
    assert files.load_json(spark, str(tmp_path / "none.json")).collect() == []
    for name, text in {"cut": '[{"a": 1}, {"a": {"b": 2}', "open": '[{"a": "x}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(ValueError, match="whole JSON"):
            files.load_json(spark, str(tmp_path / f"{name}.json"))
    (tmp_path / "plain.json").write_text('[1, 2, {"a": 1}]')
    with pytest.raises(PySparkException, match="something else"):
        objects.read_objects(spark, str(tmp_path / "plain.json")).collect()


@pytest.mark.parametrize("text, quotes", [('{"a":"b"}', 4), (r'{"\"":"\\"}', 4), (r'{"\\\"{":1}', 2), ('{}', 0)])
def test_structure(text, quotes):
    at, step, seen = objects.structure(np.frombuffer(text.encode(), np.uint8))
    assert (seen[-1] if len(seen) else 0) == quotes
    assert step[seen % 2 == 0].sum() == 0
