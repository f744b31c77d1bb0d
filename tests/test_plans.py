"""Physical-plan properties the scale design relies on."""

import datetime as dt
import io
import re
from contextlib import redirect_stdout

from tessera.operators import cleaning as cl
from tessera.operators import periods as pe
from tessera.operators import windows as W
from tessera.plans import reports
from tessera.sources import tables as tb
from tests.conftest import SF


def nodes(p: str, name: str) -> int:
    """Number of physical nodes called ``name`` (detail lines ``(n) name``)."""
    return sum(1 for line in p.splitlines() if re.match(rf"\(\d+\) {name}\b", line))


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_report_prunes_columns_and_pushes_null_filter(spark):
    p = plan(reports.daily_sales(tb.sales(spark, SF)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double," \
           "l_shipdate:timestamp_ntz>" in p
    # drop-nulls is planned as a not-null filter on the join output, below the dedup aggregate
    assert "atleastnnonnulls(9" in p


def test_period_filter_reaches_scan(spark):
    ev = tb.table(spark, SF, "events")
    p = plan(pe.filter_period(ev, "ts", "this_week", dt.date(2024, 1, 17)))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in p and "LessThan(ts,2024-01-22T00:00)" in p


def test_dedup_is_partially_aggregated_before_shuffle(spark):
    ev = tb.table(spark, SF, "events")
    p = plan(cl.remove_duplicates(ev, ["user_id", "event_type"], "first", order_by=["ts", "event_id"]))
    assert "partial_min_by" in p                                   # map-side combine per key


def test_only_fixed_size_dimensions_are_hinted(spark):
    p = plan(tb.sales(spark, SF))
    # nation/region are hinted; part/orders/customer are left to AQE's size check
    assert nodes(p, "BroadcastExchange") >= 2


def test_two_pass_window_has_no_single_partition_fact_exchange(spark):
    o = tb.table(spark, SF, "orders")
    df = W.cumulative_sum(o, "o_totalprice", ["o_orderdate", "o_orderkey"], two_pass=True, n_buckets=4)
    p = plan(df)
    single = [line for line in p.splitlines() if "SinglePartition" in line]
    # the only single-partition exchange feeds the one-row-per-bucket prefix window
    assert len(single) <= 1
    assert "hashpartitioning(__bucket" in p


def test_windows_have_one_form(spark):
    o = tb.table(spark, SF, "orders")
    for df in (W.cumulative_sum(o, "o_totalprice", ["o_orderdate", "o_orderkey"]),
               W.rank(o, "o_totalprice"), W.row_number(o, "o_orderkey", "o_orderstatus")):
        p = plan(df)
        assert "__bucket" in p and "Scan parquet" not in p        # whatever the size; reads the checkpoint only


def test_monthly_prunes_orders_and_reads_lineitem_once(spark):
    p = plan(reports.monthly_kpis(tb.monthly(spark, SF, dt.datetime(2001, 6, 1), dt.datetime(2001, 8, 1)), dt.date(2001, 7, 15)))
    assert "GreaterThanOrEqual(o_orderdate,2001-06-01T00:00)" in p and "LessThan(o_orderdate,2001-08-01T00:00)" in p
    assert nodes(plan(tb.monthly(spark, SF)), "Expand") == 0
    assert len(re.findall(r"Location: .*lineitem", p)) == 1


def test_kpis_are_one_aggregate(spark):
    from tessera.operators import kpi as K
    perf = tb.performance(spark, SF)
    kpis = [K.average_handling_time("avg_handling_time"), K.first_call_resolution("first_call_resolution"),
            K.customer_satisfaction_score("customer_satisfaction"), K.total_revenue("sales_amount")]
    p = plan(K.kpi_frame(perf, kpis))
    assert nodes(p, "Scan parquet") == 1 and nodes(p, "HashAggregate") == 2    # one scan, partial + final


def test_no_local_folder_for_remote_sessions():
    import pytest
    from tessera.session import ensure_checkpoint_dir

    class Remote:                              # a session without a SparkContext
        class conf:                            # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        @property
        def sparkContext(self):                # noqa: N802
            raise RuntimeError("not supported")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Remote())
