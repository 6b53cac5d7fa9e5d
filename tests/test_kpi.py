"""KPI derivation, drift and win-back arithmetic."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import kpi, winback
from tallyloom.sources import baselines


def primitives(spark, revenue="100.10", profit="30.00", orders=4):
    return spark.createDataFrame(
        [(Decimal(revenue), Decimal(profit), 3, orders, 0)],
        "total_revenue decimal(18,2), total_profit decimal(18,2), distinct_customers bigint, distinct_orders bigint, grain_parity bigint")


def table(spark, values):
    return spark.createDataFrame([(k, Decimal(str(v))) for k, v in values.items()], "name string, value decimal(28,4)")


def drifted(spark, baseline, current):
    return {r.name for r in kpi.kpi_drift(table(spark, baseline), table(spark, current)).collect() if r.drift}


def test_derived_round_half_up(spark):
    row = kpi.kpi_derived(primitives(spark)).first()
    assert (float(row.aov), float(row.margin_pct)) == (25.03, 29.97)


@pytest.mark.parametrize("kw", [{"revenue": "0"}, {"orders": 0}])
def test_zero_denominator_is_an_error(spark, kw):
    with pytest.raises(Exception, match="cannot compute"):
        kpi.kpi_derived(primitives(spark, **kw)).collect()


def test_identical_has_no_drift(spark):
    long = kpi.as_long(primitives(spark))
    assert kpi.kpi_drift(long, long).filter("drift").count() == 0 and long.count() == 7


def test_money_to_the_cent_counts_exact_missing_is_drift(spark):
    assert drifted(spark, {"total_revenue": 100.00}, {"total_revenue": 100.004}) == set()
    assert drifted(spark, {"total_revenue": 100.00}, {"total_revenue": 100.01}) == {"total_revenue"}
    assert drifted(spark, {"distinct_orders": 4}, {"distinct_orders": 5}) == {"distinct_orders"}
    assert drifted(spark, {"grain_parity": 0}, {"grain_parity": 1}) == {"grain_parity"}
    assert drifted(spark, {"total_profit": 1, "aov": 2}, {"aov": 2}) == {"total_profit"}


def test_grain_parity_sees_both_sides(spark):
    curated = spark.createDataFrame([("A", "c", Decimal(1), Decimal(1)), ("B", "c", Decimal(1), Decimal(1))], "order_id string, customer_id string, order_value decimal(18,2), order_profit decimal(18,2)")
    lines = spark.createDataFrame([("B",), ("B",), ("X",)], "order_id string")
    assert kpi.kpi_primitives(curated, lines).first().grain_parity == 2


def test_contribution_per_euro(spark):
    df = spark.createDataFrame([(0.519711, 0.15), (0.466905, 0.20)], "m double, r double")
    got = [round(r[0], 4) for r in df.select(winback.kept_per_euro(F.col("m"), F.col("r"))).collect()]
    assert got == [2.4647, 1.3345]


def test_playbook_labels(spark):
    rows = {r.segment: r for r in winback.playbook(spark).collect()}
    assert {s: (r.discount_rate, r.budget_share_pct) for s, r in rows.items()} == {"At Risk": (0.15, 7), "Hibernating": (0.2, 3)}


def test_stored_baselines_are_versions(spark, tmp_path):
    stored = baselines.Baselines(spark, str(tmp_path))
    assert stored.accept("kpis", table(spark, {"total_revenue": 100.00, "distinct_orders": 4}), "first") == 1
    assert stored.accept("kpis", table(spark, {"total_revenue": 100.00, "distinct_orders": 5, "aov": 2}), "second") == 2
    again = baselines.Baselines(spark, str(tmp_path))  # another session knows the folder only
    current = table(spark, {"total_revenue": 100.00, "distinct_orders": 5, "aov": 2})
    assert kpi.kpi_drift(again.read("kpis"), current).filter("drift").count() == 0
    assert {r.name for r in kpi.kpi_drift(again.read("kpis", 1), current).collect() if r.drift} == {"distinct_orders", "aov"}
    rows = {(r.version, r.name): r.drift for r in kpi.drift_history(again.history("kpis")).collect()}
    assert {k for k, drift in rows.items() if drift} == {(2, "distinct_orders"), (2, "aov")} and len(rows) == 6
    assert again.history("none").count() == 0
    for wrong in (0, 3):
        with pytest.raises(LookupError):
            again.read("kpis", wrong)


def test_a_refused_baseline_leaves_the_last_one(spark, tmp_path):
    stored = baselines.Baselines(spark, str(tmp_path))
    stored.accept("kpis", table(spark, {"aov": 1}), "first")
    with pytest.raises(ValueError):
        stored.accept("kpis", table(spark, {"aov": 2}), " ")
    with pytest.raises(ValueError):
        stored.accept("kpis", table(spark, {"aov": 2}).union(table(spark, {"aov": 3})), "twice")
    assert [(r.name, float(r.value)) for r in stored.read("kpis").collect()] == [("aov", 1.0)]


def test_baseline_files(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"schema_version": 1, "other": 1,\n "primitives": {"distinct_orders": 7, "total_revenue": 12.34}, "derived": {"aov": 1.76}}')
    got = {r.name: float(r.value) for r in baselines.read_file(spark, str(path)).collect()}
    assert got == {"distinct_orders": 7, "total_revenue": 12.34, "aov": 1.76}
    (tmp_path / "old.json").write_text('{"schema_version": 9, "primitives": {"aov": 1}}')
    with pytest.raises(Exception, match="unknown baseline version 9"):
        baselines.read_file(spark, str(tmp_path / "old.json")).collect()
