"""Array files read by many tasks give what the whole-file reader gives."""

import json
import random

import pytest

from mercato.sources import arrays, raw

PARTS = ["{", "}", "[", "]", '"', "\\", ",", ":", "é", "\n", "a", "},{", '\\"', "]}", " ", " ", "😀"]


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.3 or depth > 3:
        return "".join(rng.choices(PARTS, k=rng.randrange(8)))
    if kind < 0.45:
        return rng.choice([None, True, 0, -1.5, 10**12, "x"])
    if kind < 0.7:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"".join(rng.choices(PARTS, k=rng.randrange(1, 4))): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def rows(df):
    return sorted(((r["file_name"], r["row_number"], r["raw"]) for r in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_same_rows_as_the_whole_file_reader(spark, tmp_path, small_splits):
    rng = random.Random(4)
    for n in range(6):
        objects = [{"id": i, "v": value(rng)} for i in range(rng.randrange(30))]
        mixed = [rng.choice([value(rng), o, 7, "}"]) for o in objects] if n % 2 else objects
        (tmp_path / f"{n}.json").write_text(json.dumps(mixed, indent=rng.choice([None, 1]), ensure_ascii=n % 3 == 0))
    for name, text in {"empty": "[]", "blank": " [ \n ] \n", "scalars": "[1, 2, \"}\", null]", "one": '[{"a":"\\\\"}]', "bom": '﻿[{"a":1}]',
                       "deep": '[{"a":{"b":[{"c":"}{"},{"d":"\\"}"}]}}, [[{"e":1}],{"f":2}], {"g":{}}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got, want = rows(arrays.split_array_records(spark, str(tmp_path))), rows(raw.array_records(spark, str(tmp_path)))
    # a byte order mark stops only the whole-file reader
    assert got == sorted([w for w in want if w[0] != "bom.json"] + [("bom.json", 0, '{"a":1}')], key=repr)
    assert len(got) > 60


def test_one_file_in_many_tasks(spark, tmp_path, small_splits):
    data = [{"id": i, "text": "}" * (i % 7) + '"' * (i % 3), "in": {"n": [{"x": i}]}} for i in range(500)]
    (tmp_path / "big.json").write_text(json.dumps(data))
    assert arrays._fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 50
    got = rows(arrays.split_array_records(spark, str(tmp_path)))
    assert [(n, json.loads(x)) for _, n, x in got] == sorted(((i, d) for i, d in enumerate(data)), key=lambda x: repr(("big.json", x[0])))
    plan = arrays.split_array_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_an_element_longer_than_many_splits(spark, tmp_path, small_splits):
    data = [{"a": 1}, {"long": ["{}" * 50, {"x": "y" * 3000}] * 5}, {"b": 2}]
    (tmp_path / "long.json").write_text(json.dumps(data))
    assert [json.loads(x) for _, _, x in rows(arrays.split_array_records(spark, str(tmp_path)))] == data


def test_large_arrays_are_split_by_the_feed_reader(spark, tmp_path, small_splits):
    from mercato.schemas import SOURCES
    for name, n in (("large", 200), ("small", 3)):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"order_id": f"{name}{i}"} for i in range(n)]))
    got = raw.raw_records(spark, str(tmp_path), SOURCES["orders"], split_above=1000)
    assert [json.loads(x)["order_id"] for _, _, x in sorted((r["file_name"], r["row_number"], r["raw"]) for r in got.collect())] == [
        *[f"large{i}" for i in range(200)], *[f"small{i}" for i in range(3)]]


def test_a_broken_file_loses_no_readable_piece(spark, tmp_path):
    (tmp_path / "broken.json").write_text('[{"a":1}, {"b":2 3}, {"c":3}')
    got = rows(arrays.split_array_records(spark, str(tmp_path)))
    assert sorted((x for _, _, x in got), key=repr) == ['{"a":1}', None, None]
