from datetime import date, datetime

import pytest

from martflow.schemas import LOG_FILE
from martflow.sources import lookups, readers, staging


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_json_glob_with_schema(spark, tmp_path, rows):
    put(tmp_path / "A/B/C/one.json", '{"id": 1, "x": 2.5}')
    put(tmp_path / "A/B/D/two.json", '{"id": 2}', '{"id": 3, "other": true}')
    df = readers.read_json(spark, f"{tmp_path}/*/*/*/*.json", "id int, x double")
    assert rows(df) == [(1, 2.5), (2, None), (3, None)]


def test_tree_takes_only_the_suffix(spark, tmp_path, rows):
    put(tmp_path / "a/x.json", '{"id": 1}')
    put(tmp_path / "a/b/c/y.json", '{"id": 2}')
    put(tmp_path / "a/z.txt", "not json")
    assert rows(readers.read_tree(spark, str(tmp_path), ".json", "json")) == [(1,), (2,)]


def test_csv_directory_with_quotes_and_commas(spark, tmp_path, rows):
    put(tmp_path / "1.csv", "song,n", '"One, ""Two""",1')
    put(tmp_path / "2.csv", "song,n", "Three,2")
    assert rows(readers.read_csv(spark, str(tmp_path), "song string, n int")) == [('One, "Two"', 1), ("Three", 2)]


def test_typed_csv_finds_columns_by_name_and_nulls_bad_text(spark, tmp_path, rows):
    path = put(tmp_path / "t.csv", "b,a", "x,1", "y,oops", "z, 3 ")
    assert rows(readers.read_csv_typed(spark, path, {"a": "int"}).select("a", "b")) == [(None, "y"), (1, "x"), (3, "z")]


def test_semicolons(spark, tmp_path, rows):
    path = put(tmp_path / "t.csv", "City;State Code", "A, B;CA")
    df = readers.read_csv(spark, path, sep=";")
    assert df.columns == ["City", "State Code"]
    assert rows(df) == [("A, B", "CA")]


def test_partition_text_stays_text(spark, tmp_path, rows):
    spark.createDataFrame([(1, "01"), (2, "10")], "id int, month string").write.partitionBy("month").parquet(
        str(tmp_path / "p")
    )
    df = readers.read_partitioned(spark, str(tmp_path / "p"), "id int, month string")
    assert rows(df) == [(1, "01"), (2, "10")]


def test_inventory_lists_every_file_once(spark, tmp_path):
    put(tmp_path / "a/1.json", "{}")
    put(tmp_path / "b/c/2.json", "{}", "{}")
    put(tmp_path / "b/3.csv", "x")
    assert readers.list_files(spark, str(tmp_path)).count() == 3
    found = readers.list_files(spark, str(tmp_path), "*.json")
    assert sorted(r["length"] for r in found.collect()) == [3, 6]
    assert "content" not in found.columns


def test_json_paths_with_times_and_blank_ids(spark, tmp_path, rows):
    path = put(
        tmp_path / "log.json",
        '{"ts": 1541106000796, "user": {"id": "39"}, "page": "NextSong"}',
        '{"ts": 1541106000000, "user": {"id": ""}, "page": "Home"}',
        '{"page": "About"}',
    )
    df = staging.stage_json_paths(
        spark, path, "start timestamp_ntz, user_id int, page string",
        {"start": "$.ts", "user_id": "$.user.id", "page": "$.page"}, epoch_ms=["start"],
    )
    assert rows(df) == [
        (None, None, "About"),
        (datetime(2018, 11, 1, 21, 0, 0), None, "Home"),
        (datetime(2018, 11, 1, 21, 0, 0, 796000), 39, "NextSong"),
    ]


def test_json_auto_ignores_case_and_fills_nulls(spark, tmp_path, rows):
    path = put(tmp_path / "a.json", '{"SongId": "a", "YEAR": 1999, "x": [1]}', '{"songid": "b", "Year": "?"}')
    df = staging.stage_json_auto(spark, path, "songId string, year int, title string")
    assert rows(df) == [("a", 1999, None), ("b", None, None)]


def test_json_auto_stages_a_log_line(spark, tmp_path):
    path = put(tmp_path / "l.json", '{"userId":"8","itemInSession":3,"ts":1541106000796,"length":1.5,"page":"NextSong"}')
    staged = staging.stage_json_auto(spark, path, LOG_FILE.replace("ts bigint", "ts timestamp_ntz"), epoch_ms=["ts"])
    row = staged.first()
    assert (row.userId, row.itemInSession, row.length, row.artist) == ("8", 3, 1.5, None)
    assert row.ts == datetime(2018, 11, 1, 21, 0, 0, 796000)


def test_csv_binds_by_position(spark, tmp_path, rows):
    path = put(tmp_path / "t.csv", "whatever|names", "1|a", "2|b")
    assert rows(staging.stage_csv(spark, path, "id int, label string", sep="|")) == [(1, "a"), (2, "b")]
    assert staging.stage_csv(spark, path, "id int, label string", sep="|", ignore_header=0).count() == 3
    with pytest.raises(ValueError):
        staging.stage_csv(spark, path, "id int", ignore_header=2)


def test_templated_path():
    assert staging.templated("log/{day:%Y/%m}/{name}.json", day=date(2018, 11, 5), name="x") == "log/2018/11/x.json"


def test_code_names_are_cut_at_the_first_comma(spark, tmp_path, rows):
    path = put(
        tmp_path / "c.csv",
        "country_code,country",
        "5,ATLANTIS, by sea (form 7, not land)",
        "68,UTOPIA ",
        "0=UNUSABLE: NOWHERE",
        "",
    )
    assert rows(lookups.read_code_names(spark, path, "country_code", "country")) == [
        (None, "0=UNUSABLE: NOWHERE"),
        (5, "ATLANTIS, by sea (form 7, not land)"),
        (68, "UTOPIA"),
    ]


def test_code_name_tail_keeps_commas_in_the_middle(spark, tmp_path, rows):
    path = put(
        tmp_path / "a.csv",
        "airport_code,airport_name,state_code",
        "ZZA,SOMEWHERE, ZZ ",
        " XX ,NO STATE",
        "QAB,PORT, NORTH, QA",
    )
    df = lookups.read_code_name_tail(spark, path, "airport_code", "airport_name", "state_code")
    assert rows(df) == [("QAB", "PORT, NORTH", "QA"), ("XX", "NO STATE", None), ("ZZA", "SOMEWHERE", "ZZ")]


def test_unlike_headers_are_refused(spark, tmp_path):
    for name, lines in (("a", "a,b\n1,2\n"), ("b", "b,a\n2,1\n")):
        (tmp_path / f"{name}.csv").write_text(lines)
    with pytest.raises(Exception, match="header"):
        readers.read_csv_typed(spark, str(tmp_path), {"a": "int"}).collect()


def test_json_rejects_and_strict_staging(spark, tmp_path, rows):
    from martflow.sources.staging import json_rejects, stage_json_auto

    (tmp_path / "a.json").write_text('{"ID": 1, "name": "a"}\n{broken\n{"id": "x", "name": null}\n')
    args = (spark, str(tmp_path), "id int, name string")
    assert rows(json_rejects(*args)) == [('{"id": "x", "name": null}', "id"), ("{broken", "no object")]
    assert stage_json_auto(*args).where("id = 1 AND name = 'a'").count() == 1
    with pytest.raises(Exception, match="no object|id"):
        stage_json_auto(*args, strict=True).collect()
