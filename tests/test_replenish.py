import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.operators import replenish, requests
from stockwave.params import Scenario

ITEM = (
    "category string, forecast_demand double, forecast_std double, current_stock double, unit_cost double, "
    "selling_price double, lead_time_days int, storage_per_unit double"
)
# Published sample: five categories with known plan.
SAMPLE = [
    ("bed_bath_table", 120.0, 20.0, 50.0, 45.0, 75.0, 7, 1.0),
    ("health_beauty", 85.0, 15.0, 40.0, 55.0, 90.0, 7, 0.8),
    ("sports_leisure", 60.0, 12.0, 30.0, 65.0, 100.0, 7, 1.2),
    ("furniture_decor", 40.0, 10.0, 25.0, 80.0, 130.0, 14, 2.0),
    ("computers_accessories", 95.0, 18.0, 60.0, 200.0, 350.0, 5, 0.5),
]
MORE = [
    ("toys", 50.0, 12.0, 35.0, 30.0, 55.0, 7, 0.6),
    ("garden_tools", 30.0, 8.0, 20.0, 70.0, 110.0, 10, 1.5),
    ("books", 70.0, 15.0, 45.0, 25.0, 45.0, 5, 0.3),
]


def solve(spark, rows, *scenarios, low=False):
    items = spark.createDataFrame(rows, ITEM)
    return replenish.solve_plan(replenish.with_scenarios(items, scenarios or (Scenario(),)), low_service=low, n_keys=max(1, len(scenarios)))


def test_published_sample(spark):
    plan = solve(spark, SAMPLE).cache()
    rows = {r.category: r for r in replenish.plan_report(plan).collect()}
    want = {
        "bed_bath_table": (86, 16, 1247.52), "health_beauty": (57, 12, 1057.62), "sports_leisure": (40, 10, 886.19),
        "furniture_decor": (26, 11, 774.73), "computers_accessories": (47, 12, 3854.36),
    }
    assert {c: (r.reorder_quantity, r.safety_stock, r.holding_cost) for c, r in rows.items()} == want
    totals = replenish.plan_totals(plan).first()
    assert totals.total_cost == 7820.42 and totals.status == "Optimal"
    naive = replenish.naive_comparison(plan).first()
    assert (naive.naive_cost, naive.saving_pct) == (14143.75, 44.7)


def test_eight_items_under_limits_and_sweep(spark):
    plan = solve(spark, SAMPLE + MORE, Scenario("w", storage_capacity=5000, budget=300000))
    assert replenish.plan_totals(plan).first().status == "Optimal"
    levels = [Scenario(f"{v:.2f}", service_level=v) for v in (0.85, 0.90, 0.95, 0.99)]
    costs = [r.total_cost for r in replenish.plan_totals(solve(spark, SAMPLE + MORE, *levels)).orderBy("scenario").collect()]
    assert costs == sorted(costs) and len(set(costs)) == 4


@pytest.mark.parametrize("limits", [{"budget": 100.0}, {"storage_capacity": 5.0}])
def test_limits_below_the_needs_are_infeasible(spark, limits):
    plan = solve(spark, SAMPLE, Scenario("tight", **limits))
    assert {r.status for r in plan.collect()} == {"Infeasible"}


def test_stock_above_demand_orders_nothing(spark):
    row = solve(spark, [("full", 10.0, 1.0, 500.0, 5.0, 8.0, 7, 1.0)]).first()
    assert row.reorder_quantity == 0.0 and row.shortage == 0.0


def test_zero_parameters_mean_defaults(spark):
    a = replenish.plan_totals(solve(spark, SAMPLE, Scenario("x", 0, 0, 0, 0, 0))).first().total_cost
    assert a == 7820.42
    with pytest.raises(ValueError):
        solve(spark, SAMPLE, Scenario("x", service_level=1.0))


def best_by_vertices(rows, storage, budget, z, h, s):
    """Optimum of the small linear program by enumerating vertices of the extra quantities."""
    d, sd, i, c, lead, w = (np.array([r[k] for r in rows], float) for k in (1, 2, 3, 4, 6, 7))
    need = np.maximum(0, d + z * sd * np.sqrt(lead / 30) - i)
    if (w * need).sum() > storage or (c * need).sum() > budget:
        return None
    room = np.maximum(0, np.maximum(0, d - i) - need)
    b, v = budget - (c * need).sum(), storage - (w * need).sum()

    def cost(x):
        q = need + x
        return (h * c * (i / 2 + q) + s * c * np.maximum(0, d - i - q)).sum()

    best, n = cost(np.zeros(len(rows))), len(rows)
    bounds = [(0.0, r) for r in room]
    for free in range(3):  # at a vertex at most two quantities lie strictly inside their bounds
        for chosen in itertools.combinations(range(n), free):
            rest = [k for k in range(n) if k not in chosen]
            for ends in itertools.product(*[bounds[k] for k in rest]):
                x = np.zeros(n)
                x[rest] = ends
                tight = [(c, b)] if free == 1 else [(c, b), (w, v)]
                options = [[(c, b)], [(w, v)]] if free == 1 else [tight]
                for rows_ in options if free else [[]]:
                    y = x.copy()
                    if free:
                        a = np.array([[k[j] for j in chosen] for k, _ in rows_])
                        rhs = np.array([lim - k[rest] @ x[rest] for k, lim in rows_])
                        if abs(np.linalg.det(a)) < 1e-9:
                            continue
                        y[list(chosen)] = np.linalg.solve(a, rhs)
                    if (y >= -1e-9).all() and (y <= room + 1e-9).all() and c @ y <= b + 1e-6 and w @ y <= v + 1e-6:
                        best = min(best, cost(y))
    return best


def test_low_service_plans_are_optimal(spark):
    rng = np.random.default_rng(7)
    rows, scenarios, want = [], [], {}
    for case in range(12):
        n = 4
        items = [
            (f"i{k}", float(rng.integers(20, 90)), float(rng.integers(5, 40)), float(rng.integers(0, 20)),
             float(rng.integers(0, 12)), 1.0, int(rng.integers(1, 30)), float(rng.integers(0, 4)))
            for k in range(n)
        ]
        if case % 3 == 0:  # many items of one density
            items = [(*r[:4], 6.0, 1.0, r[6], 2.0) for r in items]
        z = float(rng.uniform(0.05, 0.45))
        scenario = Scenario(f"s{case}", float(rng.integers(100, 500)), float(rng.integers(300, 2000)), z)
        rows += [(scenario.name, *r) for r in items]
        scenarios.append(scenario)
        zed = replenish.normal_quantile_scalar(z)
        want[scenario.name] = best_by_vertices(items, scenario.storage_capacity, scenario.budget, zed, 0.25, 0.4)
    limits = spark.createDataFrame(
        [(s.name, s.storage_capacity, s.budget, s.service_level) for s in scenarios],
        "scenario string, storage_capacity double, budget double, service_level double",
    )
    items = spark.createDataFrame(rows, "scenario string, " + ITEM).join(replenish.with_request_limits(limits), "scenario")
    plan = replenish.solve_plan(items, low_service=True).cache()
    costs = {r.scenario: (r.status, r.cost) for r in plan.groupBy("scenario").agg(
        F.max("status").alias("status"), F.sum(F.col("holding_cost") + F.col("stockout_cost")).alias("cost")).collect()}
    assert sum(v is not None for v in want.values()) >= 6
    for name, best in want.items():
        status, cost = costs[name]
        assert (status == "Infeasible") == (best is None)
        if best is not None:
            assert cost == pytest.approx(best, abs=1e-6)
    used = plan.where("status = 'Optimal'").groupBy("scenario", "budget", "storage_capacity").agg(
        F.sum(F.col("unit_cost") * F.col("reorder_quantity")).alias("money"),
        F.sum(F.col("storage_per_unit") * F.col("reorder_quantity")).alias("volume"))
    assert used.where("money > budget + 1e-6 or volume > storage_capacity + 1e-6").isEmpty()


def test_items_get_defaults_for_absent_fields(spark):
    df = spark.createDataFrame([("a", 10), ("b", None)], "product_category_name_english string, order_count int")
    a, b = replenish.items_from_forecast(df).orderBy("category").collect()
    assert a[1:] == (10.0, 3.0, 100.0, 50.0, 80.0, 7, 1.0) and b.forecast_demand == 0.0


def test_profile_items(spark):
    config = spark.createDataFrame([("a", 9.99), ("b", 5.0)], "category string, unit_cost double").selectExpr(
        "*", "16.0 as selling_price", "100.0 as current_stock", "1.0 as storage_per_unit")
    profile = spark.createDataFrame([("a", 30.0, None)], "category string, monthly_forecast double, demand_std double")
    a, b = replenish.items_from_profile(config, profile, 9).orderBy("category").collect()
    assert (a.forecast_demand, a.forecast_std, a.lead_time_days) == (30.0, 1.0, 9)
    assert (b.forecast_demand, b.forecast_std) == (100.0, 30.0)


def test_cost_config_defaults(spark, panel):
    categories = spark.createDataFrame([("books",), ("never_sold",)], "category string")
    got = {r.category: r for r in replenish.cost_config(categories, panel).collect()}
    assert (got["never_sold"].unit_cost, got["never_sold"].selling_price) == (50.0, 80.0)
    assert got["books"].selling_price == pytest.approx(got["books"].unit_cost * 1.6, abs=0.006)


def test_request_validation(spark):
    asked = spark.createDataFrame([(1, "a", None), (2, "a", 0), (3, None, 366), (4, "b", 365)], "request_id int, category string, days int")
    got = {r.request_id: (r.days, r.errors, r.valid) for r in requests.validate_forecast_requests(asked).collect()}
    assert got == {1: (30, "", True), 2: (0, "days", False), 3: (366, "category,days", False), 4: (365, "", True)}
    plans = spark.createDataFrame([(1, 5.0, -1.0, None), (2, None, None, 1.0)], "request_id int, storage_capacity double, budget double, service_level double")
    got = {r.request_id: (r.service_level, r.errors) for r in requests.validate_plan_requests(plans).collect()}
    assert got == {1: (0.95, "budget"), 2: (1.0, "service_level")}
    items = spark.createDataFrame([(1, -2.0, 3.0)], "request_id int, current_stock double, unit_cost double")
    assert requests.validate_items(items).first().errors == "current_stock"


def test_batch_equals_single_plans(spark):
    items = spark.createDataFrame([(1, *r) for r in SAMPLE] + [(2, *r) for r in SAMPLE + MORE], "request_id int, " + ITEM)
    asked = spark.createDataFrame([(1, None, None, None), (2, 5000.0, 300000.0, 0.9), (3, -1.0, None, None)],
                                  "request_id int, storage_capacity double, budget double, service_level double")
    totals = {r.request_id: r.total_cost for r in replenish.plan_totals(requests.reorder_batch(asked, items), "request_id").collect()}
    single = replenish.plan_totals(solve(spark, SAMPLE + MORE, Scenario("x", 5000, 300000, 0.9))).first().total_cost
    assert totals == {1: 7820.42, 2: single}


def test_forecast_requests_filter_a_stored_forecast(spark):
    ahead = spark.createDataFrame([("a", k, k * 10) for k in range(1, 6)], "category string, days_ahead int, predicted_orders int")
    asked = spark.createDataFrame([(1, "a", 2), (2, "a", 400), (3, "zz", 2)], "request_id int, category string, days int")
    got = requests.answer_forecast_requests(asked, ahead).collect()
    assert sorted((r.request_id, r.days_ahead) for r in got) == [(1, 1), (1, 2)]


def test_requests_are_answered_for_all_their_days(spark):
    ahead = spark.createDataFrame([("a", k, k) for k in range(1, requests.MAX_DAYS + 1)], "category string, days_ahead int, predicted_orders int")
    asked = spark.createDataFrame([(k, "a", k) for k in (1, 31, 200, 365)], "request_id int, category string, days int")
    answers = requests.answer_forecast_requests(asked, ahead)
    assert {r.request_id: r["count"] for r in answers.groupBy("request_id").count().collect()} == {1: 1, 31: 31, 200: 200, 365: 365}
    assert requests.unanswered_days(asked, answers).isEmpty()
    short = requests.answer_forecast_requests(asked, ahead.where("days_ahead <= 30"))
    assert {(r.request_id, r.n) for r in requests.unanswered_days(asked, short).collect()} == {(31, 30), (200, 30), (365, 30)}


def test_rejected_plan_requests(spark):
    good, bad = SAMPLE[0], (*SAMPLE[1][:4], -5.0, 90.0, 7, -3.0)
    items = spark.createDataFrame([(1, *good), (1, *bad), (2, *bad), (9, *good)], "request_id int, " + ITEM)
    asked = spark.createDataFrame([(1, None, None, None), (2, None, None, None), (3, -1.0, None, 1.5), (4, 5.0, 5.0, 0.5)],
                                  "request_id int, storage_capacity double, budget double, service_level double")
    got = {(r.request_id, r.category, r.errors) for r in requests.rejected_plan_requests(asked, items).collect()}
    assert got == {
        (1, bad[0], "unit_cost,storage_per_unit"), (2, bad[0], "unit_cost,storage_per_unit"), (2, None, "no items"),
        (3, None, "storage_capacity,service_level"), (4, None, "no items"), (9, good[0], "unknown request"),
    }
    assert {(r.request_id, r.category) for r in requests.reorder_batch(asked, items).collect()} == {(1, good[0])}


def test_items_are_not_shuffled_by_scenario(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = solve(spark, SAMPLE, Scenario("a"), Scenario("b"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
