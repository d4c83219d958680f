"""Staging of lines whose fields change."""

import json

import pytest

from martflow.sources.drift import drift_report, extract, fields_seen, json_path, stage_variant

SCHEMA = "id bigint, v double, t date, gone string"
LINES = [
    {"id": 1, "v": 1.5, "t": "2024-01-01"}, {"id": "x", "v": 2, "new": {"a": 1}}, "broken {", [1, 2], 7, None, {}, {"id": None, "it's": True},
    {"id": 10**30, "v": 1e3, "t": "no date", "gone": None}, {"id": 3, "body": "b", "new": {"a": "z"}},
]


@pytest.fixture
def staged(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in LINES))
    return stage_variant(spark, str(folder), SCHEMA)


def test_typed_columns_and_whole_lines(staged):
    found = [tuple(map(str, r)) for r in staged.drop("body").collect()]
    nothing = ("None",) * 4
    assert found == [
        ("1", "1.5", "2024-01-01", "None"), ("None", "2.0", "None", "None"), nothing, nothing, nothing, nothing, nothing, nothing,
        ("None", "1000.0", "None", "None"), ("3", "None", "None", "None"),
    ]
    assert staged.where("body IS NULL").count() == 1


def test_fields_found_later(staged, spark, tmp_path):
    staged.write.parquet(str(tmp_path / "out"))
    again = spark.read.parquet(str(tmp_path / "out"))
    found = extract(again, {"it's": "boolean", "new": "struct<a: int>"}).collect()
    assert [r["it's"] for r in found].count(True) == 1
    assert sorted(r["new"]["a"] for r in found if r["new"] is not None and r["new"]["a"] is not None) == [1]
    with pytest.raises(ValueError, match="no path"):
        json_path("""a'b"c""")


def test_report(staged):
    found = {r.field: (r.declared, r.lines, r.nulls, r.status) for r in drift_report(staged, SCHEMA).collect()}
    assert found == {
        "id": ("bigint", 5, 1, "changed"), "v": ("double", 3, 0, "as declared"), "t": ("date", 2, 0, "as declared"),
        "gone": ("string", 1, 1, "missing"), "new": (None, 2, 0, "new"), "it's": (None, 1, 0, "new"), "body": (None, 1, 0, "new"),
    }


def test_nothing(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    staged = stage_variant(spark, str(tmp_path / "none.json"), SCHEMA)
    assert staged.count() == fields_seen(staged).count() == 0
    assert {r.status for r in drift_report(staged, SCHEMA).collect()} == {"missing"}
