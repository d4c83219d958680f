"""Work that must not be done again for each line, table or moment."""

import datetime as dt
import random

from martflow.operators.aggregates import one_row_per_key
from martflow.operators.buckets import even
from martflow.operators.history import time_buckets, versions
from martflow.plans import star_upsert
from martflow.queries import standins

START = dt.datetime(1996, 1, 1)


def history_by_hand(rows):
    found = []
    for k in {r[0] for r in rows}:
        seen = {}
        for _, at, level in sorted(r for r in rows if r[0] == k):
            seen[at] = level
        before = None
        for at, level in sorted(seen.items()):
            if level != before:
                found.append((k, level, at))
            before = level
    return sorted(found)


def test_versions_of_even_and_crowded_moments(spark):
    rng = random.Random(3)
    spread = [(rng.choice("ab"), START + dt.timedelta(seconds=rng.randrange(3000)), rng.choice("xyz")) for _ in range(2000)]
    crowded = spread + [("a", START + dt.timedelta(seconds=77), rng.choice("xyz")) for _ in range(4000)]
    for lines, is_even in ((spread, True), (crowded, False)):
        rows = spark.createDataFrame(lines, "k string, at timestamp_ntz, level string")
        assert even(time_buckets(rows, "at", 6)) is is_even
        found = versions(rows, ["k"], "at", ["level"], buckets=6).select("k", "level", "valid_from").collect()
        assert sorted(map(tuple, found)) == history_by_hand(lines)


def test_names_are_made_before_lines_are_joined(spark, capsys):
    standins.log(spark, "/root/testdata/sf0.001").explain(True)
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "split_part" not in optimized[: optimized.index("Join")].lower() and "upper(" not in optimized[: optimized.index("Join")]


def test_keys_alone_need_no_sort(spark, capsys):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    first = one_row_per_key(rows, ["k"], [])
    assert sorted((r.k or "") for r in first.collect()) == ["", "a"]
    capsys.readouterr()
    first.explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_a_load_reads_no_other_columns(spark):
    """And its new plays are joined with the fact once, not again for the sample of the range sort."""
    columns = "page string, ts timestamp_ntz, userId string, sessionId int, level string, location string, userAgent string, "
    columns += "firstName string, lastName string, gender string, song string, artist string, length double"
    assert set(star_upsert.LOG_COLUMNS) == {c.split()[0] for c in columns.split(", ")}
    log = spark.createDataFrame([("NextSong", START, "1", 1, "free", "here", "x", "A", "B", "F", None, None, None)] * 2, columns)
    known = spark.createDataFrame([], "start_time timestamp_ntz, user_id string, session_id int, level string, location string, user_agent string")
    songs = spark.createDataFrame([], "song_id string, title string, duration double, artist_id string")
    artists = spark.createDataFrame([], "artist_id string, name string")
    plays = star_upsert.songplays(log, songs, artists, 5, known=known)
    assert [r.songplay_id for r in plays.orderBy("songplay_id").collect()] == [5, 6]
    again = star_upsert.songplays(log, songs, artists, 7, known=plays)
    assert again.count() == 0
