"""What reaches the scans, and how joins and aggregates are planned."""

import pytest
from conftest import SMALL

from martflow.queries import QUERIES


@pytest.fixture
def plan(spark, capsys):
    def explained(name, mode="simple"):
        capsys.readouterr()
        QUERIES[name](spark, SMALL).explain(mode=mode)
        return capsys.readouterr().out

    return explained


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_event_type", "EqualTo(event_type,purchase)"),
        ("filter_after_date", "GreaterThan(o_orderdate,2000-01-01T00:00)"),
        ("filter_conjunction", "GreaterThan(l_quantity,10.0)"),
        ("point_lookup_pair", "EqualTo(l_linenumber,3)"),
        ("point_lookup_value", "EqualTo(p_name,blue bolt)"),
    ],
)
def test_filters_reach_the_scan(plan, name, pushed):
    assert pushed in plan(name, "formatted")


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("project_subset", "struct<o_orderkey:bigint,o_orderstatus:string>"),
        ("agg_count", "struct<>"),
        ("agg_time_interval", "struct<ts:timestamp_ntz>"),
        ("union_dates", "struct<o_orderstatus:string,o_orderdate:timestamp_ntz>"),
        ("dq_foreign_key", "struct<l_orderkey:bigint>"),
        ("join_left_then_agg", "struct<o_custkey:bigint,o_totalprice:double>"),
    ],
)
def test_scans_read_only_what_is_used(plan, name, columns):
    assert f"ReadSchema: {columns}" in plan(name)


@pytest.mark.parametrize("name", ["join_lookup_decode", "join_role_playing", "join_enrich_chain", "imm_fact"])
def test_lookups_are_broadcast_by_size(plan, name):
    text = plan(name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["distinct_rows", "dedupe_by_key_latest", "agg_first", "pivot_first", "agg_mixed"])
def test_groups_are_reduced_before_the_one_shuffle(plan, name):
    text = plan(name)
    assert text.count("Exchange ") == 1
    assert "Window" not in text
    below = text[text.index("Exchange "):]
    assert "Aggregate" in below


def test_topk_never_sorts_all_groups(plan):
    text = plan("topk_groups_5")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_map_only_queries_do_not_shuffle(plan):
    for name in ("fn_date_parts", "fn_sas_date", "bulk_cast_int", "hash_key_md5", "join_lookup_decode"):
        assert "Exchange hashpartitioning" not in plan(name)


@pytest.mark.parametrize("name", ["upsert_do_nothing", "upsert_last_write_wins", "star_dw_time", "imm_dates"])
def test_no_data_sized_single_partition(plan, name):
    assert "SinglePartition" not in plan(name)
