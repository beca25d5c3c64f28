"""SQL over registered views gives the same reports as the DataFrame operators."""

from cordon.operators import surcharge_leakage
from cordon.plans.registry import Inputs
from cordon.plans.views import register_leakage_view, register_views

from conftest import SF_MID


def test_sql_views_match_dataframe_reports(spark):
    i = Inputs(spark, SF_MID)
    register_views(spark, i.raw_feeds, i.baseline_raw)
    register_leakage_view(spark, i.spec)
    via_sql = spark.sql("SELECT * FROM leakage_report").collect()
    via_df = surcharge_leakage(i.clean, i.spec).collect()
    assert [tuple(r) for r in via_sql] == [tuple(r) for r in via_df]
    assert [(r.pickup_loc, r.trip_count, r.missing_surcharge_hits) for r in via_sql] == \
        [(15, 8, 4), (154, 9, 4), (185, 9, 4)]
    n = spark.sql("SELECT count(*) FROM audit_log").first()[0]
    m = spark.sql("SELECT count(*) FROM clean_trips").first()[0]
    assert n + m == spark.sql("SELECT count(*) FROM trips_raw").first()[0] == 8762
    cols = spark.sql("SELECT * EXCEPT (duration_sec, avg_speed_mph, forensic_flag) FROM audit_results").columns
    assert cols == spark.table("clean_trips").columns
