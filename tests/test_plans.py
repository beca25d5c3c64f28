"""Physical-plan checks: pushdown, pruning, no Cartesian products, bounded broadcasts."""

import pytest

from cordon.plans.registry import registry

from conftest import SF_SMALL


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_cartesian_product(spark, name):
    p = plan(registry()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns_and_pushes_time_filter(spark):
    df = registry()["surcharge_leakage"](spark, SF_SMALL)
    p = plan(df)
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")]
    assert any("EqualTo(l_linestatus,O)" in line for line in pushed)
    assert all("GreaterThan(l_shipdate" in line and "LessThan(l_shipdate" in line for line in pushed)
    # total_amount is not used by this report, so l_tax is never read
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("l_tax" not in line for line in schemas)


def test_zone_list_is_a_hash_set(spark):
    assert "INSET" in optimized(registry()["surcharge_leakage"](spark, SF_SMALL)).upper()


def test_border_join_is_broadcast_after_aggregation(spark):
    df = registry()["border_effect"](spark, SF_SMALL)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_top_k_is_take_ordered(spark):
    p = plan(registry()["suspicious_vendors"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_single_shuffle_for_flag_stats(spark):
    p = plan(registry()["flag_stats"](spark, SF_SMALL))
    assert p.count("Arguments: hashpartitioning(") == 1
    assert "partial_count" in p


def test_reports_read_the_written_tables(spark, scratch):
    from cordon.plans.audit_run import build_reports, materialise_flags
    from cordon.plans.registry import Inputs

    i = Inputs(spark, SF_SMALL)
    _, _, audited = materialise_flags(spark, i.trips, f"{scratch}/audit", layout="by_flag")
    reports, _ = build_reports(audited, i.baseline, i.weather, i.spec, work_path=f"{scratch}/cube")
    # clean-trip reports read the small cube table, never the trips
    for name in ("leakage", "tips", "velocity_after"):
        locations = [line for line in plan(reports[name]).splitlines() if line.startswith("Location:")]
        assert len(locations) == 1 and "/cube" in locations[0], name
    # the vendor report reads only the flagged partitions of the audit table
    p = plan(reports["vendors"])
    assert "PartitionFilters: [isnotnull(forensic_flag" in p


def test_sorted_layout_gives_same_reports_and_pushes_null_filters(spark, scratch):
    from cordon.plans.audit_run import build_reports, materialise_flags
    from cordon.plans.registry import Inputs

    i = Inputs(spark, SF_SMALL)
    _, counts_a, by_flag = materialise_flags(spark, i.trips, f"{scratch}/a", layout="by_flag")
    _, counts_b, by_sort = materialise_flags(spark, i.trips, f"{scratch}/b", layout="sorted")
    assert counts_a == counts_b
    ra, _ = build_reports(by_flag, i.baseline, i.weather, i.spec, work_path=f"{scratch}/ca")
    rb, _ = build_reports(by_sort, i.baseline, i.weather, i.spec, work_path=f"{scratch}/cb")
    for name in ("leakage", "vendors", "tips", "volumes", "border", "velocity_after", "flag_stats"):
        a = sorted(map(tuple, ra[name].collect()), key=str)
        b = sorted(map(tuple, rb[name].collect()), key=str)
        assert a == b, name
    p = plan(rb["vendors"])
    assert any("IsNotNull(forensic_flag)" in line for line in p.splitlines() if line.startswith("PushedFilters"))


def test_a_run_reads_baseline_and_weather_once(spark, scratch):
    """Counted as plans are executed: only the cube writes scan the sources."""
    from cordon.plans.audit_run import run_audit
    from cordon.plans.registry import Inputs

    i = Inputs(spark, SF_SMALL)
    for name in ("trips", "base", "weather"):
        frame = {"trips": i.feed_year("yellow", 2000), "base": i.baseline_raw, "weather": i.weather}[name]
        frame.write.parquet(f"{scratch}/{name}")
    read = lambda name: spark.read.parquet(f"{scratch}/{name}")
    seen = {"trips": 0, "base": 0, "weather": 0}
    result = run_audit(spark, {"yellow": read("trips")}, read("base"), read("weather"), i.spec, f"{scratch}/out")
    for df in result.reports.values():  # the published reports read written tables only
        for name in seen:
            seen[name] += plan(df).count(f"{scratch}/{name}]")
    assert seen == {"trips": 0, "base": 0, "weather": 0}


def test_final_aggregates_keep_their_partitions(spark):
    from cordon.operators import tip_crowding, velocity_before, velocity_grid
    from cordon.plans.registry import Inputs

    i = Inputs(spark, SF_SMALL)
    for df in (tip_crowding(i.clean, i.spec), velocity_grid(velocity_before(i.baseline, i.spec))):
        assert "Coalesce" not in plan(df).replace("coalesce", "")
