"""Plans: what reaches the scan, and which joins must not appear."""

import pytest

from groundhold import operators as op
from groundhold import plans
from groundhold import sources as src
from groundhold.schemas import RAW_FLIGHTS
from groundhold.session import scratch_root


@pytest.fixture(scope="module")
def table(spark, make_flights, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "flights")
    src.append_raw(make_flights([{}, {"flightdate": "2025-10-16"}, {"origin": "EWR", "dest": "ORD"}]), path, "flightdate")
    return src.read_raw(spark, path, RAW_FLIGHTS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(table):
    text = plan(plans.day_month_heatmap(table))
    assert "ReadSchema: struct<month:int,dayofweek:int,depdelayminutes:double,depdel15:double>" in text


def test_dates_prune_partitions_and_hubs_reach_the_scan(table):
    text = plan(plans.rolling_delay_trend(table))
    assert "PartitionFilters: [isnotnull(flightdate" in text and "PushedFilters: [In(origin" in text
    text = plan(op.cascade_impact(table, [90], hubs=["ORD"], dates=["2025-10-15"]))
    assert "PushedFilters: [EqualTo(dest,ORD)" in text.replace("IsNotNull(dest), ", "") or "EqualTo(dest,ORD)" in text
    assert "flightdate" in text.split("PartitionFilters: [")[1][:60]


def test_cascades_have_no_nested_loops(table):
    for df in (
        op.cascade_matches(table),
        op.cascade_impact(table, [15, 90]),
        op.cascade_by_destination(table),
        op.cascade_chain(table, hub=None, date=None),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_matches_do_not_sort_the_flights(table):
    text = plan(op.cascade_matches(table))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_impact_counts_flights_alike_before_their_tiers(table):
    text = plan(op.cascade_impact(table, range(15, 241, 15)))
    keys = [line.split("functions=")[0] for line in text.splitlines() if "Aggregate(keys=" in line]
    assert any("longest_gap" in k for k in keys)


def test_tasks_of_derived_tables_grow_with_the_rows(spark, tmp_path, monkeypatch):
    from workload import frames

    rows = spark.range(95).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "1.0D as l_extendedprice",
        "timestamp'1995-01-01' as l_shipdate",
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(frames, "ROWS_PER_TASK", 10)
    df = frames.derive(spark, str(tmp_path), "raw_flights")
    assert df.rdd.getNumPartitions() == 10 and df.count() == 95


def test_cascades_scan_the_flights_once_per_use(spark, table):
    pruning = "spark.sql.optimizer.dynamicPartitionPruning.enabled"  # shows the join's other side a second time
    spark.conf.set(pruning, "false")
    scans = {
        "impact": (op.cascade_impact(table, range(15, 241, 15)), 1),
        "matches": (op.cascade_matches(table), 2),
        "chain": (op.cascade_chain(table, hub=None, date=None), 2),
    }
    try:
        for name, (df, most) in scans.items():
            assert plan(df).count("FileScan parquet") <= most, name
    finally:
        spark.conf.unset(pruning)


def test_staging_does_not_shuffle(table):
    assert "Exchange" not in plan(op.stg_flights(table))


def test_top_lists_do_not_sort_everything(table):
    routes = plans.mart_route_economics(op.int_route_performance(op.stg_flights(table), 1))
    assert "TakeOrderedAndProject" in plan(plans.costliest_routes(routes))


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
