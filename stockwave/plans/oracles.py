"""Independent SQL for the registered queries, written for DuckDB on the same Parquet tables.

The SQL states each result from its definition (global row order, distinct counts, plain running
sums), not from the way the Spark operators compute it.
"""

from __future__ import annotations

from statistics import NormalDist

from stockwave.params import EXOGENOUS, EXOGENOUS_LAGS, LAGS, ROLLING_WINDOWS, yearly_holidays

HORIZON = 30
HOLIDAY_LIST = ", ".join(f"date '{h}'" for h in yearly_holidays(1995, 2001))
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def r(expr: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"(round_even(cast({expr} as double)*{scale}, 0)/{scale} + 0e0)"


def r0(expr: str) -> str:
    return f"(round_even(cast({expr} as double), 0) + 0e0)"


def whole(expr: str) -> str:
    return f"cast({r0(expr)} as bigint)"


def d(expr: str) -> str:
    return f"cast(cast({expr} as date) as varchar)"


def moment(expr: str) -> str:
    return f"strftime(cast({expr} as timestamp), '%Y-%m-%d %H:%M:%S')"


# --- shared tables ---------------------------------------------------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "f_orders": ((), """select o_orderkey as order_id, o_custkey as customer_id,
        case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as order_status,
        o_orderdate as order_purchase_timestamp from orders"""),
    "f_items": ((), """select l_orderkey as order_id, l_partkey as product_id, l_suppkey as seller_id,
        cast(l_extendedprice as decimal(12,2)) as price,
        cast(l_extendedprice as decimal(12,2))*cast(l_tax as decimal(4,2)) as freight_value from lineitem"""),
    "f_products": ((), "select p_partkey as product_id, p_type as product_category_name from part"),
    "f_translation": ((), """select distinct p_type as product_category_name,
        lower(p_type) as product_category_name_english from part where p_type <> 'PROMO'"""),
    "f_payments": ((), """select l_orderkey as order_id, l_linenumber as payment_sequential,
        cast(l_quantity as int) as payment_installments, cast(l_extendedprice as decimal(12,2)) as payment_value,
        case l_returnflag when 'R' then 'credit_card' when 'A' then 'boleto' else 'voucher' end as payment_type
        from lineitem"""),
    "f_reviews": ((), """select l_orderkey as order_id, cast(1 + l_suppkey % 5 as int) as review_score
        from lineitem where l_linestatus = 'F'"""),
    "clean": (("f_orders",), """select * exclude (rn) from (select *, row_number() over (partition by order_id
        order by order_purchase_timestamp, customer_id) as rn from f_orders
        where order_status = 'delivered' and order_purchase_timestamp is not null) where rn = 1"""),
    "pay": (("f_payments",), """select order_id, max(payment_sequential) as payment_sequential_max,
        max(payment_installments) as payment_installments_max, sum(payment_value) as payment_value_sum,
        count(distinct payment_type) as payment_method_count,
        count(*) filter (where payment_type = 'credit_card') as payment_type_credit_card
        from f_payments group by order_id"""),
    "rev": (("f_reviews",), """select order_id, avg(review_score) as review_score_mean,
        count(review_score) as review_score_count from f_reviews group by order_id"""),
    "unified": (("clean", "f_items", "f_products", "f_translation", "pay", "rev"), """select i.order_id, i.product_id,
        i.seller_id, i.price, i.freight_value, c.order_purchase_timestamp, p.product_category_name,
        t.product_category_name_english, pay.* exclude (order_id), rev.* exclude (order_id)
        from clean c join f_items i on c.order_id = i.order_id
        left join f_products p on i.product_id = p.product_id
        left join f_translation t on p.product_category_name = t.product_category_name
        left join customer cu on cu.c_custkey = c.customer_id
        left join supplier su on su.s_suppkey = i.seller_id
        left join pay on pay.order_id = c.order_id left join rev on rev.order_id = c.order_id"""),
    "daily": (("unified",), """select cast(order_purchase_timestamp as date) as date,
        coalesce(product_category_name_english, 'unknown') as category,
        count(distinct order_id) as order_count,
        cast(sum(price) as double)/count(price) as avg_price, cast(sum(price) as double) as total_revenue,
        cast(sum(freight_value) as double)/count(freight_value) as avg_freight,
        avg(review_score_mean) as avg_review_score, avg(payment_installments_max) as avg_installments
        from unified group by 1, 2"""),
    "lagged": (("daily",), "select date, category, order_count, " + ", ".join(
        f"lag(order_count, {k}) over w as order_count_lag_{k}" for k in LAGS
    ) + ", " + ", ".join(
        f"avg(order_count) over (partition by category order by date rows between {w} preceding and 1 preceding) as order_count_rolling_mean_{w}d, "
        f"coalesce(stddev_samp(order_count) over (partition by category order by date rows between {w} preceding and 1 preceding), 0) as order_count_rolling_std_{w}d"
        for w in ROLLING_WINDOWS
    ) + " from daily window w as (partition by category order by date)"),
    "cal": (("daily",), "select date, category, cast(isodow(date) - 1 as int) as day_of_week, "
        "cast(month(date) as int) as month, cast(quarter(date) as int) as quarter, cast(day(date) as int) as day_of_month, "
        "cast(week(date) as int) as week_of_year, cast(isodow(date) >= 6 as int) as is_weekend, "
        "cast(day(date) = 1 as int) as is_month_start, cast(date = last_day(date) as int) as is_month_end from daily"),
    "onehot": (("daily",), "select date, category, "
        + ", ".join(f"cast(isodow(date) - 1 = {k} as int) as dow_{k}" for k in range(1, 7)) + ", "
        + ", ".join(f"cast(month(date) = {k} as int) as month_{k}" for k in range(2, 13)) + " from daily"),
    "hol": (("daily",), f"""select date, category, cast(date in ({HOLIDAY_LIST}) as int) as is_holiday,
        cast(coalesce(lead(date) over (order by date, category) in ({HOLIDAY_LIST}), false) as int) as pre_holiday,
        cast(coalesce(lag(date) over (order by date, category) in ({HOLIDAY_LIST}), false) as int) as post_holiday
        from daily"""),
    "filled": (("daily",), "select date, category, " + ", ".join(
        f"coalesce(last_value({c} ignore nulls) over (partition by category order by date rows between unbounded preceding and current row), "
        f"first_value({c} ignore nulls) over (partition by category order by date rows between current row and unbounded following)) as {c}"
        for c in EXOGENOUS
    ) + " from daily"),
    "exog": (("filled",), "select *, " + ", ".join(
        f"lag({c}, {k}) over (partition by category order by date) as {c}_lag_{k}" for c in EXOGENOUS for k in EXOGENOUS_LAGS
    ) + " from filled"),
    "spans": ((), """select * from (values ('train', date '1995-01-01', date '1999-12-31'),
        ('val', date '2000-01-01', date '2000-12-31'), ('test', date '2001-01-01', date '2001-07-31')) t(split, lo, hi)"""),
    "labelled": (("daily", "spans"), "select daily.*, spans.split from daily join spans on date between lo and hi"),
    "train_mean": (("labelled",), "select category, avg(order_count) as train_mean from labelled where split = 'train' group by 1"),
    "preds": (("lagged", "spans", "train_mean"), """
        select category, date, split, 'mean_baseline' as model, cast(order_count as double) as y, train_mean as yhat
        from lagged join spans on date between lo and hi join train_mean using (category)
        union all select category, date, split, 'lag1', order_count, coalesce(order_count_lag_1, 0)
        from lagged join spans on date between lo and hi
        union all select category, date, split, 'ma7', order_count, coalesce(order_count_rolling_mean_7d, 0)
        from lagged join spans on date between lo and hi"""),
    "scores": (("preds",), f"""select category, model, split,
        {r("coalesce(avg(case when y <> 0 then abs((y-yhat)/y) end)*100, 0)", 2)} as mape,
        {r("sqrt(avg((y-yhat)*(y-yhat)))", 2)} as rmse, {r("avg(abs(y-yhat))", 2)} as mae
        from preds group by all"""),
    "weights": (("scores",), """select category, model, rmse, (1e0/greatest(rmse, 0.001))
        / sum(1e0/greatest(rmse, 0.001)) over (partition by category) as weight from scores where split = 'val'"""),
    "ends": (("daily",), "select category, max(date) as last_date from daily group by 1"),
    "spine": (("ends",), f"""select category, cast(last_date + cast(k as int) as date) as date, last_date, cast(k as int) as k
        from ends, generate_series(1, {HORIZON}) g(k)"""),
    "newest": (("daily",), "select *, row_number() over (partition by category order by date desc) as rn from daily"),
    "snapshot": (("newest",), "select category, " + ", ".join(
        f"coalesce(max(order_count) filter (where rn = {k}), 0) as order_count_lag_{k}" for k in (1, 2, 3, 7)
    ) + ", " + ", ".join(
        f"case when count(*) >= {w} then avg(order_count) filter (where rn <= {w}) else 0 end as order_count_rolling_mean_{w}d, "
        f"case when count(*) >= {w} then stddev_samp(order_count) filter (where rn <= {w}) else 0 end as order_count_rolling_std_{w}d"
        for w in ROLLING_WINDOWS
    ) + " from newest group by category"),
    "ahead": (("spine", "snapshot", "train_mean"), """
        select category, date, 'mean_baseline' as model, train_mean as yhat from spine join train_mean using (category)
        union all select category, date, 'lag1', order_count_lag_1 from spine join snapshot using (category)
        union all select category, date, 'ma7', order_count_rolling_mean_7d from spine join snapshot using (category)"""),
    "mixed": (("ahead", "weights"), """select category, date, greatest(sum(weight*yhat)/sum(weight), 0) as blended,
        max(yhat) filter (where model = 'lag1') as lag1, max(yhat) filter (where model = 'ma7') as ma7,
        max(yhat) filter (where model = 'mean_baseline') as mean_baseline
        from ahead join weights using (category, model) group by 1, 2"""),
    "band": (("mixed",), f"""select category, date, blended, {whole("blended")} as predicted_orders,
        greatest({whole("blended*0.85e0")}, 0) as predicted_lower, {whole("blended*1.15e0")} as predicted_upper,
        {whole("lag1")} as lag1_prediction, {whole("ma7")} as ma7_prediction,
        {whole("mean_baseline")} as mean_baseline_prediction from mixed"""),
    "recent": (("daily",), "select * from daily where date >= (select max(date) from daily) - 30"),
    "profile": (("recent",), f"""select category, {r("avg(order_count)", 1)} as avg_daily_demand,
        {r("stddev_samp(order_count)", 1)} as demand_std, {r0("avg(order_count)*30")} as monthly_forecast,
        sum(order_count) as total from recent group by 1"""),
    "costs": (("daily",), f"""select category, unit_cost, {r("unit_cost*1.6e0", 2)} as selling_price, 100e0 as current_stock,
        1e0 as storage_per_unit from (select category, {r("coalesce(avg(avg_price), 50)", 2)} as unit_cost from daily group by 1)"""),
    "sku": ((), """select 'sku-' || p_partkey as category, coalesce(dem, 0) as forecast_demand,
        coalesce(dem, 0)*0.3e0 as forecast_std, p_size*10e0 as current_stock, p_retailprice as unit_cost,
        p_size % 14 + 1 as lead_time_days, case when p_size % 10 = 0 then 0e0 else p_size/10e0 end as storage_per_unit
        from part left join (select l_partkey, sum(l_quantity) as dem from lineitem group by 1) on l_partkey = p_partkey"""),
}


def sql(select: str, *tables: str) -> str:
    """A query over the shared tables it names, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][0]:
            add(parent)
        if name not in order:
            order.append(name)

    for t in tables:
        add(t)
    parts = ",\n".join(f"{n} as materialized ({CTES[n][1]})" for n in order)
    return f"with {parts}\n{select}" if order else select


def scenario_values(rows: list[tuple[str, float, float, float, float, float]]) -> str:
    """(name, storage, budget, service level, holding, stockout) with the normal quantile added."""
    body = ", ".join(
        f"('{n}', {w!r}::double, {b!r}::double, {NormalDist().inv_cdf(sl)!r}::double, {h!r}::double, {s!r}::double)"
        for n, w, b, sl, h, s in rows
    )
    return f"(values {body}) s(scenario, storage_capacity, budget, z, holding_rate, stockout_rate)"


def plan_ctes(items: str, keyed: str) -> str:
    """Plan tables from items joined with limits (``keyed``), following the stated linear program."""
    return f"""
    base as materialized (select *, z*forecast_std*sqrt(lead_time_days/30e0) as ss from {items} {keyed}),
    need as materialized (select *, greatest(0e0, forecast_demand + ss - current_stock) as lb from base),
    tot as materialized (select scenario, sum(storage_per_unit*lb) as wl, sum(unit_cost*lb) as cl from need group by 1),
    lim as materialized (select need.*, wl, cl, case when wl <= storage_capacity and cl <= budget then 'Optimal' else 'Infeasible' end as status,
        case when z < 0 and stockout_rate > holding_rate and unit_cost > 0 and wl <= storage_capacity and cl <= budget
          then greatest(0e0, greatest(0e0, forecast_demand - current_stock) - lb) else 0e0 end as room,
        case when storage_per_unit > 0 then unit_cost/storage_per_unit else 'inf'::double end as dens
        from need join tot using (scenario)),
    grp as materialized (select scenario, dens, sum(unit_cost*room) as gc, sum(storage_per_unit*room) as gw,
        max(budget - cl) as b, max(storage_capacity - wl) as w from lim where room > 0 group by 1, 2),
    run as materialized (select *, coalesce(sum(gc) over e, 0) as pc, coalesce(sum(gw) over e, 0) as pw from grp
        window e as (partition by scenario order by dens desc rows between unbounded preceding and 1 preceding)),
    shr as materialized (select scenario, dens, greatest(0e0, least(1e0, (b - pc)/gc, case when gw > 0 then (w - pw)/gw else 1e0 end)) as f from run),
    plan as materialized (select lim.*, lb + room*coalesce(f, 0) as q from lim left join shr using (scenario, dens)),
    cost as materialized (select *, holding_rate*unit_cost*(current_stock/2e0 + q) as hold,
        stockout_rate*unit_cost*greatest(0e0, forecast_demand - current_stock - q) as stockout,
        greatest(0e0, forecast_demand - current_stock - q) as shortage from plan)"""


def plan_sql(select: str, item_table: str, scenarios: list, *tables: str, limit_sql: str = "") -> str:
    head = sql("", *tables)
    keyed = limit_sql or f"cross join {scenario_values(scenarios)}"
    return f"{head.rstrip()},\n{plan_ctes(item_table, keyed)}\n{select}"


REPORT = f"""select scenario, category, status, {r0("current_stock")} as current_stock,
    {r0("forecast_demand")} as forecast_demand, {r0("q")} as reorder_quantity, {r0("forecast_demand + ss")} as reorder_point,
    {r0("ss")} as safety_stock, {r("forecast_std", 1)} as forecast_std,
    {r0("current_stock + q")} as total_inventory_after_order, {r("unit_cost", 2)} as unit_cost, {r("hold", 2)} as holding_cost
    from cost"""
TOTALS = f"""select scenario, max(status) as status, count(*) as n_items, sum({r0("q")}) as total_reorder,
    sum({r0("current_stock + q")}) as total_inventory_after_order, {r("sum(hold)", 2)} as total_holding_cost,
    {r("sum(stockout)", 2)} as total_stockout_cost, {r("sum(hold + stockout)", 2)} as total_cost from cost group by 1"""

PLAN_SCENARIOS = [
    ("roomy", 1e12, 1e13, 0.95, 0.25, 0.4),
    ("default", 10000.0, 500000.0, 0.95, 0.25, 0.4),
    ("costly", 1e12, 1e13, 0.99, 0.4, 0.6),
]
LOW_SCENARIOS = [
    ("budget_bound", 1e12, 9e8, 0.3, 0.25, 0.4),
    ("storage_bound", 1.8e6, 1e13, 0.3, 0.25, 0.4),
    ("unbound", 1e12, 1e13, 0.2, 0.25, 0.4),
    ("no_gain", 1e12, 1e13, 0.3, 0.5, 0.4),
    ("normal", 1e12, 1e13, 0.9, 0.25, 0.4),
]
SWEEP = [(f"sl_{int(v * 100)}", 1e12, 1e13, v, 0.25, 0.4) for v in (0.85, 0.90, 0.95, 0.99)]

PANEL = (
    f"select {d('date')} as date, category, order_count, {r('avg_price')} as avg_price, {r('total_revenue')} as total_revenue, "
    f"{r('avg_freight')} as avg_freight, {r('avg_review_score')} as avg_review_score, "
    f"{r('avg_installments')} as avg_installments from daily"
)
LAG_NAMES = [f"order_count_lag_{k}" for k in LAGS]
ROLL_NAMES = [f"order_count_rolling_{s}_{w}d" for w in ROLLING_WINDOWS for s in ("mean", "std")]
CAL_NAMES = ["day_of_week", "month", "quarter", "day_of_month", "week_of_year", "is_weekend", "is_month_start", "is_month_end"]
HOT_NAMES = [f"dow_{k}" for k in range(1, 7)] + [f"month_{k}" for k in range(2, 13)]
HOL_NAMES = ["is_holiday", "pre_holiday", "post_holiday"]
EXOG_LAGS = [f"{c}_lag_{k}" for c in EXOGENOUS for k in EXOGENOUS_LAGS]
EXOG_ALL = [*EXOGENOUS, *EXOG_LAGS]
ALL_FEATURES = [*EXOGENOUS, *LAG_NAMES, *ROLL_NAMES, *CAL_NAMES, *HOT_NAMES, *HOL_NAMES, *EXOG_LAGS]


def cast_double(names: list[str], fill: bool = False) -> str:
    wrap = (lambda n: f"coalesce({n}, 0)") if fill else (lambda n: n)
    return ", ".join(f"{r(wrap(n))} as {n}" for n in names)


MATRIX = (
    "select date, category, order_count, "
    + ", ".join(f"coalesce({n}, 0) as {n}" for n in ALL_FEATURES)
    + " from lagged join cal using (date, category) join onehot using (date, category)"
    " join hol using (date, category) join exog using (date, category)"
)
MATRIX_TABLES = ("lagged", "cal", "onehot", "hol", "exog")
CORR = "(covar_pop({a}, {b}) / nullif(stddev_pop({a})*stddev_pop({b}), 0))"
CORR_NAMES = ["order_count", *[n for n in ALL_FEATURES if "lag" in n or "rolling" in n][:10]]
TRAIN_ROWS = "date between date '1995-01-01' and date '1999-12-31'"
UNIFIED_COLUMNS = (
    "order_id", "product_id", "seller_id", "price", "freight_value", "order_purchase_timestamp", "product_category_name",
    "product_category_name_english", "payment_sequential_max", "payment_installments_max", "payment_value_sum",
    "payment_method_count", "payment_type_credit_card", "review_score_mean", "review_score_count",
)


def moving(strict: bool) -> str:
    cols = []
    for w in (7, 14):
        over = f"over (partition by category order by date rows between {w - 1} preceding and current row)"
        mean = f"avg(order_count) {over}"
        cols.append(f"{r(f'case when count(*) {over} = {w} then {mean} end' if strict else mean)} as ma_{w}")
    return (
        f"select {d('date')} as date, category, order_count, {', '.join(cols)} from (select date, category, order_count from daily "
        "union all select date, '*', cast(sum(order_count) as bigint) from daily group by date)"
    )


def histogram(source: str, column: str, bins: int, keys: str) -> str:
    return f""", src as materialized ({source}),
    ext as materialized (select {keys}, min({column}) as mn, max({column}) as mx from src group by all),
    bnd as materialized (select {keys}, case when mn = mx then mn - 0.5 else mn end as lo, case when mn = mx then mx + 0.5 else mx end as hi from ext),
    cnt as materialized (select {keys}, least(cast(floor({bins}e0*({column} - lo)/(hi - lo)) as int) + 1, {bins}) as bin, count(*) as n
        from src join bnd using ({keys}) group by all)
    select {keys}, cast(g.bin as int) as bin, {r(f"lo + (g.bin - 1)*((hi - lo)/{bins}e0)")} as lower,
        {r(f"lo + g.bin*((hi - lo)/{bins}e0)")} as upper, coalesce(n, 0) as n
    from bnd cross join generate_series(1, {bins}) g(bin) left join cnt using ({keys}, bin)"""


#: The forecast of a category is the same on every day ahead, so an answer is that level on each day asked.
LEVEL = """level as (select category, greatest(sum(weight*yhat)/sum(weight), 0) as blended from (
    select category, 'mean_baseline' as model, train_mean as yhat from train_mean
    union all select category, 'lag1', order_count_lag_1 from snapshot
    union all select category, 'ma7', order_count_rolling_mean_7d from snapshot) join weights using (category, model) group by 1),
    asked_days as (select *, unnest(generate_series(1, days)) as k from a where days between 1 and 365)"""

ASKED = """a as (select s_suppkey as request_id, case s_suppkey % 3 when 0 then 'economy' when 1 then 'small' else 'toys' end as category,
    cast(s_suppkey*37 % 380 - 2 as int) as days from supplier)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    orders_cols = f"order_id, customer_id, order_status, {moment('order_purchase_timestamp')} as order_purchase_timestamp"
    q["csv_roundtrip"] = sql(f"select {orders_cols} from f_orders", "f_orders")
    counts = (
        ("orders", "orders", 4), ("order_items", "lineitem", 5), ("products", "part", 2),
        ("category_translation", "f_translation", 2), ("customers", "customer", 3), ("sellers", "supplier", 2),
        ("payments", "lineitem", 5), ("reviews", "f_reviews", 2), ("geolocation", "nation", 3),
    )
    q["catalog_row_counts"] = sql(
        " union all ".join(f"select '{n}' as table_name, count(*) as n_rows, {c} as n_columns from {t}" for n, t, c in counts),
        "f_translation", "f_reviews",
    )
    q["catalog_from_csv"] = q["catalog_row_counts"]
    q["csv_rejects"] = """select 'order_id' as column_name, 0::bigint as n_rejected union all select 'freight_value', 0
        union all select 'price', count(*) filter (where l_orderkey % 7 = 0 or l_orderkey % 11 = 0) from lineitem"""
    q["absent_table"] = q["late_days_refresh"] = q["parquet_roundtrip"] = q["daily_category_demand"] = q["daily_from_unified"] = sql(PANEL, "daily")
    q["metrics_json_explode"] = sql(
        "select category, mape, rmse, mae, model from scores where split = 'test'", "scores"
    )
    q["forecast_csv"] = sql(
        f"select {d('date')} as date, category, predicted_orders, predicted_lower, predicted_upper from band", "band"
    )
    q["trained_categories"] = sql("select category from train_mean", "train_mean")
    q["clean_orders"] = sql(f"select {orders_cols} from clean", "clean")
    q["payments_per_order"] = sql(
        "select * replace (cast(payment_value_sum as double) as payment_value_sum) from pay", "pay"
    )
    q["reviews_per_order"] = sql(f"select * replace ({r('review_score_mean')} as review_score_mean) from rev", "rev")
    money = ", ".join(f"cast({c} as double) as {c}" for c in ("price", "freight_value", "payment_value_sum"))
    q["unified_orders"] = sql(
        f"""select * replace ({money}, {moment("order_purchase_timestamp")} as order_purchase_timestamp,
        {r("review_score_mean")} as review_score_mean, cast(review_score_count as double) as review_score_count)
        from unified""", "unified",
    )
    nulls = " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as n_null from unified" for c in UNIFIED_COLUMNS
    )
    q["null_profile"] = sql(f"select * from ({nulls}) where n_null > 0 order by n_null desc, column_name limit 20", "unified")

    key = f"{d('date')} as date, category"
    q["lag_features"] = sql(f"select {key}, order_count, {cast_double(LAG_NAMES)} from lagged", "lagged")
    q["rolling_features"] = sql(f"select {key}, order_count, {cast_double(ROLL_NAMES)} from lagged", "lagged")
    q["calendar_features"] = sql(f"select {key}, {', '.join(CAL_NAMES)} from cal", "cal")
    q["onehot_calendar"] = sql(f"select {key}, {', '.join(HOT_NAMES)} from onehot", "onehot")
    q["holiday_flags"] = sql(f"select {key}, {', '.join(HOL_NAMES)} from hol", "hol")
    q["holiday_flags_calendar"] = sql(
        f"""select {key}, cast(date in ({HOLIDAY_LIST}) as int) as is_holiday,
        cast(date + 1 in ({HOLIDAY_LIST}) as int) as pre_holiday, cast(date - 1 in ({HOLIDAY_LIST}) as int) as post_holiday
        from daily""", "daily",
    )
    q["exogenous_features"] = sql(f"select {key}, {cast_double(EXOG_ALL)} from exog", "exog")
    as_is = [*CAL_NAMES, *HOT_NAMES, *HOL_NAMES]
    q["feature_matrix"] = sql(
        f"select {key}, order_count, {', '.join(as_is)}, {cast_double([n for n in ALL_FEATURES if n not in as_is])} from ({MATRIX})",
        *MATRIX_TABLES,
    )
    q["chrono_split"] = sql(
        f"select split, count(*) as n_rows, {d('min(date)')} as first_date, {d('max(date)')} as last_date from labelled group by 1",
        "labelled",
    )
    q["train_val_union"] = sql(f"select {key}, order_count from labelled where split in ('train', 'val')", "labelled")
    q["walk_forward_folds"] = sql(
        f"""select fold, role, count(*) as n_rows, {d("min(date)")} as first_date, {d("max(date)")} as last_date,
        cast(sum(order_count) as bigint) as orders from (
          select cast(k as int) as fold, order_count, date, case when date <= date '1999-12-31' + cast(90*k as int) then 'train' else 'val' end as role
          from daily, generate_series(0, 4) g(k) where date <= date '1999-12-31' + cast(90*k + 60 as int)) group by 1, 2""", "daily",
    )

    # folds of the linear models: rows with the inputs of one line or two, training and validation rows per fold
    x = """x as materialized (select category, date, cast(order_count as double) as y, cast(coalesce(order_count_lag_1, 0) as double) as a,
        cast(coalesce(order_count_lag_7, 0) as double) as b from lagged),
      f as (select cast(k as int) as fold, date '1999-12-31' + cast(90*k as int) as cut from generate_series(0, 4) g(k))"""
    q["walk_forward_scores"] = (
        sql("", "lagged").rstrip()
        + f""", {x},
      m as (select category, fold, cut, count(*) as n_train, avg(y) as mean, coalesce(regr_slope(y, a), 0) as slope,
        coalesce(regr_intercept(y, a), avg(y)) as level from x join f on date <= cut group by all),
      p as (select category, fold, n_train, y, unnest(['linear', 'mean_baseline']) as model,
        unnest([greatest(level + slope*a, 0), mean]) as yhat from m join x using (category) where date > cut and date <= cut + 60)
      select category, fold, model, n_train, {r("coalesce(avg(case when y <> 0 then abs((y-yhat)/y) end)*100, 0)", 2)} as mape,
        {r("sqrt(avg((y-yhat)*(y-yhat)))", 2)} as rmse, {r("avg(abs(y-yhat))", 2)} as mae, count(*) as n_val from p group by all"""
    )
    two = """n_train, (sbb*say - sab*sby) / (saa*sbb - sab*sab) as first, (saa*sby - sab*say) / (saa*sbb - sab*sab) as second, ma, mb, my"""
    sums = """count(*) as n_train, regr_sxx(y, a) as saa, regr_sxx(y, b) as sbb, regr_sxy(y, a) as say, regr_sxy(y, b) as sby,
        regr_sxy(b, a) as sab, avg(a) as ma, avg(b) as mb, avg(y) as my"""
    q["walk_forward_models"] = (
        sql("", "lagged").rstrip()
        + f""", {x},
      s as (select category, fold, {sums} from x join f on date <= cut group by all),
      m as (select category, fold, {two} from s)
      select category, fold, n_train, {r("my - first*ma - second*mb")} as constant, {r("first")} as first, {r("second")} as second from m"""
    )
    q["tuning_checked"] = sql(
        """select * from (values (0, 1, 4, 0, 4), (1, 2, 2, 0, 2), (2, 4, 1, 0, 1), (3, 5, 2, 1, 2)) t(rung, folds, n_trials, n_best, n_scored),
        (select cast(count(*) as bigint) as n_refit from daily)""", "daily",
    )
    q["recursive_forecast"] = (
        sql("", "lagged", "ends").replace("with ", "with recursive ", 1).rstrip()
        + f""", {x},
      s as (select category, {sums} from x group by all),
      m as (select category, {two} from s),
      past as (select category, list(y order by date) as ys from x group by 1),
      walk as (
        select category, 0 as days_ahead, list_slice(ys, len(ys) - 6, len(ys)) as ys, cast(null as double) as yhat from past
        union all
        select category, days_ahead + 1, list_append(ys[2:], v), v from (
          select walk.category, days_ahead, ys, greatest(my - first*ma - second*mb + first*ys[7] + second*ys[1], 0) as v
          from walk join m on walk.category = m.category where days_ahead < {HORIZON}) t)
      select category, {d("last_date + cast(days_ahead as int)")} as date, cast(days_ahead as int) as days_ahead, {r("yhat")} as yhat
      from walk join ends using (category) where days_ahead > 0"""
    )
    q["seasonal_fit_checked"] = sql(
        f"""select category, count(*) as n_train, {r("stddev_pop(order_count)")} as mean_rmse, true as seasonal_is_below
        from labelled where split = 'train' group by 1""", "labelled",
    )
    q["conformal_band"] = (
        sql("", "daily", "spans").rstrip()
        + f""", dense as materialized (
          select s.category, s.date, cast(coalesce(order_count, 0) as double) as y
          from (select category, unnest(generate_series(min(date), max(date), interval 1 day))::date as date from daily group by 1) s
          left join daily using (category, date)),
      origin as (select category, date as origin, avg(y) over (partition by category order by date rows between 6 preceding and current row) as yhat from dense),
      p as materialized (
        select o.category, cast(h as int) as days_ahead, split, y, yhat, abs(y - yhat) as e
        from origin o cross join generate_series(1, 14) g(h) join dense t on t.category = o.category and t.date = o.origin + cast(h as int)
        join spans on t.date between lo and hi),
      spanned as (
        select category, 'day' as span, days_ahead as ahead, split, y, yhat, e from p
        union all select category, 'week', cast(ceil(days_ahead / 7.0) as int), split, y, yhat, e from p),
      q as (
        select category, span, ahead, list_sort(list(e))[cast(ceil((count(*) + 1) * 0.9e0) as bigint)] as radius
        from spanned where split = 'val' group by all)
      select category, span, ahead, count(*) as n,
        {r("avg(case when y between greatest(yhat - radius, 0) and yhat + radius then 1e0 else 0e0 end)")} as coverage, {r("avg(radius)")} as radius
      from spanned join q using (category, span, ahead) where split = 'test' group by all"""
    )
    q["distinct_orders"] = sql(
        """select level, key, count(distinct order_id) as n_orders, true as sketch_is_near from (
          select order_id, unnest(['all', 'category', 'year', 'month']) as level,
            unnest(['all', coalesce(product_category_name_english, 'unknown'), strftime(order_purchase_timestamp, '%Y'), strftime(order_purchase_timestamp, '%Y-%m')]) as key
          from unified) group by all""", "unified",
    )
    q["daily_total"] = sql(f"select {d('date')} as date, cast(sum(order_count) as bigint) as order_count from daily group by date", "daily")
    q["top_categories"] = sql(
        "select category, cast(sum(order_count) as bigint) as order_count from daily group by 1 order by 2 desc, 1 limit 4", "daily"
    )
    q["top_revenue"] = sql(
        f"select category, {r('t')} as total_revenue from (select category, sum(total_revenue) as t from daily group by 1) order by t desc, category limit 4",
        "daily",
    )
    q["topn_semijoin"] = sql(
        f"""select {key}, order_count from daily where category in (select category from daily group by 1
        order by sum(order_count) desc, category limit 3)""", "daily",
    )
    q["kpi_panel"] = sql(
        f"""select (select count(distinct category) from daily) as n_categories, cast(sum(t) as bigint) as total_orders,
        {r("avg(t)")} as avg_daily_orders, cast(max(t) as bigint) as peak_daily_orders, {d("min(date)")} as first_date,
        {d("max(date)")} as last_date from (select date, sum(order_count) as t from daily group by 1)""", "daily",
    )
    names = "case dow " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(DAYS)) + " end"
    q["dow_profile"] = sql(
        f"""select category, dow as day_of_week, {names} as day_name, {r("m")} as avg_orders from
        (select distinct category from daily) cross join (select cast(k as int) as dow from generate_series(0, 6) g(k))
        left join (select category, cast(isodow(date) - 1 as int) as dow, avg(order_count) as m from daily group by 1, 2) using (category, dow)""",
        "daily",
    )
    q["month_profile"] = sql(
        f"select cast(month(date) as int) as month, {r('avg(order_count)')} as avg_orders from daily group by 1", "daily"
    )
    pivot = ", ".join(f"{r(f'avg(order_count) filter (where month(date) = {i})')} as {m}" for i, m in enumerate(MONTHS, 1))
    q["seasonality_pivot"] = sql(f"select category, cast(isodow(date) - 1 as int) as day_of_week, {pivot} from daily group by 1, 2", "daily")
    q["monthly_volume"] = sql(
        "select category, strftime(date, '%Y-%m') as year_month, cast(sum(order_count) as bigint) as order_count from daily group by 1, 2",
        "daily",
    )
    q["category_scatter"] = sql(
        f"""select category, cast(sum(order_count) as bigint) as order_count, {r("avg(avg_review_score)")} as avg_review_score,
        {r("sum(total_revenue)")} as total_revenue from daily group by 1""", "daily",
    )
    fences = """fence as (select category, quantile_cont(order_count, 0.25) as q1, quantile_cont(order_count, 0.75) as q3 from daily group by 1),
        outl as (select date, category, order_count, order_count < q1 - (q3 - q1)*1.5 or order_count > q3 + (q3 - q1)*1.5 as flag
        from daily join fence using (category))"""
    head = sql("", "daily").rstrip() + ", " + fences
    q["outlier_rows"] = f"{head} select {key}, order_count from outl where flag"
    q["outlier_summary"] = (
        f"{head} select category, count(*) filter (where flag) as n_outliers, count(*) as n_rows, "
        f"{r('count(*) filter (where flag)*100e0/count(*)')} as outlier_pct from outl group by 1 having n_outliers > 0 "
        "order by n_outliers desc, category limit 10"
    )
    quart = ", ".join(f"{r(f'quantile_cont(order_count, {p})')} as q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    q["category_describe"] = sql(
        f"""select category, count(order_count) as n, {r("avg(order_count)")} as mean, {r("stddev_samp(order_count)")} as std,
        min(order_count) as min, {quart}, max(order_count) as max from daily group by 1""", "daily",
    )
    train = f"train as materialized (select * from ({MATRIX}) where {TRAIN_ROWS})"
    head = sql("", *MATRIX_TABLES).rstrip() + ", " + train
    pairs = [(a, b) for a in CORR_NAMES for b in CORR_NAMES]
    agg = ", ".join(f"{CORR.format(a=a, b=b)} as c{i}" for i, (a, b) in enumerate(pairs))
    rows = " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, {r(f'c{i}')} as corr from agg" for i, (a, b) in enumerate(pairs)
    )
    q["corr_matrix"] = f"{head}, agg as materialized (select {agg} from train) {rows}"
    agg = ", ".join(f"{CORR.format(a=n, b='order_count')} as c{i}" for i, n in enumerate(ALL_FEATURES))
    rows = " union all ".join(f"select '{n}' as feature, {r(f'c{i}')} as corr from agg" for i, n in enumerate(ALL_FEATURES))
    q["target_corr"] = f"""{head}, agg as materialized (select {agg} from train),
        ranked as materialized (select * from ({rows}) where corr is not null)
        select * from (select feature, corr, 'top' as side from ranked order by corr desc, feature limit 10)
        union all select * from (select feature, corr, 'bottom' as side from ranked order by corr, feature limit 5)"""
    modal = "select category, count(*) as n_rows from daily group by 1 order by 2 desc, 1 limit 1"
    q["modal_category"] = sql(modal, "daily")
    values = ["order_count", *EXOGENOUS]
    cells = " union all ".join(
        f"select '{c}' as feature, " + ", ".join(
            f"{r(f'max(cast({c} as double)) filter (where rn = {i})')} as row_{i}" for i in range(1, 6)
        ) + " from first_rows" for c in values
    )
    q["modal_head_transposed"] = (
        sql("", "daily").rstrip()
        + f""", first_rows as materialized (select *, row_number() over (order by date) as rn from daily
        where category = (select category from ({modal})) qualify rn <= 5) {cells}"""
    )
    q["recent_window"] = sql(
        f"""select {key}, order_count, 'panel' as scope from daily where date >= (select max(date) from daily) - 30
        union all select {key}, order_count, 'category' from daily join ends using (category) where date >= last_date - 30""",
        "daily", "ends",
    )
    q["demand_profile_30d"] = sql(
        "select category, avg_daily_demand, demand_std, monthly_forecast from profile order by total desc, category limit 4", "profile"
    )
    latest = ", ".join(
        (f"arg_max({c}, date) filter (where {c} is not null) as {c}" if c == "order_count"
         else f"{r(f'arg_max({c}, date) filter (where {c} is not null)')} as {c}")
        for c in values
    )
    q["latest_per_category"] = sql(f"select category, {d('max(date)')} as date, {latest} from daily group by 1", "daily")
    q["moving_average"] = sql(moving(False), "daily")
    q["moving_average_strict"] = sql(moving(True), "daily")
    q["ma_baseline_mae"] = (
        sql("", "newest").rstrip()
        + f""", t as (select category, order_count, row_number() over (partition by category order by date) as i,
        avg(order_count) over (partition by category order by date rows between 7 preceding and 1 preceding) as b
        from newest where rn <= 60)
        select category, {r("avg(abs(order_count - b))")} as baseline_mae, count(*) as n_rows from t where i > 7 group by 1"""
    )
    q["tail_history"] = sql(f"select {key}, order_count, cast(rn as int) as row_from_end from newest where rn <= 90", "newest")

    pred_cols = f"category, {d('date')} as date, model, {r('y')} as y, {r('yhat')} as yhat"
    q["mean_baseline"] = sql(f"select {pred_cols} from preds where split = 'val' and model = 'mean_baseline'", "preds")
    score_cols = "category, model, mape, rmse, mae"
    q["forecast_metrics"] = sql(f"select {score_cols} from scores where split = 'val'", "scores")
    q["metrics_macro"] = sql(
        f"""select model, count(*) as n_categories, {r("avg(mape)")} as avg_mape, {r("avg(rmse)")} as avg_rmse, {r("avg(mae)")} as avg_mae
        from scores where split = 'val' group by 1""", "scores",
    )
    q["metrics_leaderboard"] = sql(f"select {score_cols}, mape < 45 as meets_target from scores where split = 'test'", "scores")
    q["naive_lag1_mape"] = sql(f"select {score_cols} from scores where split = 'val' and model = 'lag1'", "scores")
    q["improvement_over_naive"] = (
        sql("", "scores").rstrip()
        + f""", m as (select model, avg(mape) as a from scores where split = 'val' group by 1)
        select model, {r("a")} as avg_mape, {r("(n - a)/n*100", 2)} as improvement_pct
        from m, (select a as n from m where model = 'lag1')"""
    )
    q["residuals"] = sql(f"select {pred_cols}, {r('y - yhat')} as residual from preds where split = 'test'", "preds")
    q["residual_stats"] = sql(
        f"""select category, model, {r("avg(y - yhat)")} as residual_mean, {r("stddev_pop(y - yhat)")} as residual_std
        from preds where split = 'test' group by 1, 2""", "preds",
    )
    q["residual_histogram"] = sql("", "preds").rstrip() + histogram(
        "select category, model, y - yhat as residual from preds where split = 'test'", "residual", 30, "category, model"
    )
    q["mape_histogram"] = sql("", "scores").rstrip() + histogram(
        "select model, mape from scores where split = 'val'", "mape", 20, "model"
    )
    q["ensemble_weights"] = sql(f"select category, model, rmse, {r('weight')} as weight from weights", "weights")
    q["ensemble_blend"] = sql(
        f"""select category, {d("date")} as date, 'blend' as model, {r("max(y)")} as y,
        {r("greatest(sum(weight*yhat)/sum(weight), 0)")} as yhat from preds join weights using (category, model)
        where split = 'test' group by category, date""", "preds", "weights",
    )
    q["minmax_scale"] = (
        sql("", "labelled").rstrip()
        + f""", b as (select category, min(order_count) as a0, max(order_count) as a1, min(avg_price) as p0, max(avg_price) as p1
        from labelled where split = 'train' group by 1)
        select {key}, {r("(order_count - a0)/case when a1 = a0 then 1e0 else cast(a1 - a0 as double) end")} as order_count,
        {r("(avg_price - p0)/case when p1 = p0 then 1e0 else p1 - p0 end")} as avg_price, {r("order_count")} as restored
        from labelled join b using (category) where split in ('train', 'val')"""
    )
    q["sequence_windows"] = (
        sql("", "daily").rstrip()
        + f""", s as (select date, category, order_count, list(order_count) over
        (partition by category order by date rows between 30 preceding and 1 preceding) as l from daily)
        select {key}, array_to_string(l, ',') as "window", order_count as next_value from s where len(l) = 30"""
    )
    q["sequence_future"] = (
        sql("", "newest", "ends").rstrip()
        + f""", t as (select category, list(order_count order by date) as l from newest where rn <= 30 group by 1)
        select category, {d("last_date + cast(k as int)")} as date, cast(k as int) as days_ahead,
        array_to_string(list_concat(l[k:30], list_resize(cast([] as bigint[]), k - 1, 0)), ',') as "window"
        from t join ends using (category), generate_series(1, 7) g(k) where len(l) = 30"""
    )
    q["sequence_eligibility"] = (
        sql("", "daily", "labelled").rstrip()
        + """, n as (select category, count(*) filter (where split = 'train') as tr, count(*) filter (where split = 'val') as va
        from (select category, (select split from spans where daily.date between lo and hi) as split from daily) group by 1)
        select category, greatest(tr - 30, 0) as train_windows, va as val_windows, tr - 30 >= 10 and va >= 5 as eligible from n"""
    )
    eligible = """, n as (select category, count(*) filter (where split = 'train') as tr, count(*) filter (where split = 'val') as va
        from (select category, (select split from spans where daily.date between lo and hi) as split from daily) group by 1),
        e as (select *, tr - 30 >= 10 and va >= 5 as eligible from n)"""
    q["train_report"] = (
        sql("", "daily", "labelled").rstrip()
        + eligible
        + """ select category, case when tr = 0 then 'unseen' when eligible then 'trained' else 'skipped' end as status,
        greatest(tr - 30, 0) as train_windows, va as val_windows,
        case when va > 0 then 'boosted,mean_baseline' || case when eligible then ',sequence' else '' end else '' end as scored,
        true as best_of_several_rounds from e"""
    )
    tested = f"""select category, {d('date')} as date, 'boosted' as model, cast(order_count as double) as y, true as is_finite
        from labelled where split = 'test'"""
    q["gbt_forecast_checked"] = sql(tested, "labelled")
    q["boosted_errors"] = sql(
        f"""select split, {r("sqrt(avg(power(y - yhat, 2)) filter (model = 'lag1'))")} as lag1,
        {r("sqrt(avg(power(y - yhat, 2)) filter (model = 'mean_baseline'))")} as mean_baseline,
        true as boosted_is_below, true as several_trees from preds where split in ('val', 'test') group by 1""", "preds",
    )
    q["models_per_category"] = sql(
        """select category, case when category = 'economy' then 'failed' else 'trained' end as status,
        case when category <> 'economy' then true end as several_trees, case when category <> 'economy' then true end as has_error,
        category = 'economy' as has_detail, category <> 'economy' as has_model from train_mean""", "train_mean",
    )
    q["category_registry"] = sql(
        """select m.category, count(l.category) as n_test, true as best_of_rounds, case when count(l.category) > 0 then true end as same_error
        from train_mean m left join (select * from labelled where split = 'test') l on l.category = m.category group by 1""",
        "labelled", "train_mean",
    )
    q["category_forecast"] = sql(
        f"""select category, {d("last_date + cast(k as int)")} as date, true as band_fits
        from ends join train_mean using (category), generate_series(1, 30) g(k)""", "ends", "train_mean",
    )
    q["boosted_model_roundtrip"] = sql(f"select category, {d('date')} as date, true as same from labelled where split = 'test'", "labelled")
    q["sequence_regression_checked"] = (
        sql("", "daily", "labelled").rstrip()
        + f""", w as (select category, date, order_count, row_number() over (partition by category order by date) as place from daily)
        select category, {d("date")} as date, 'sequence' as model, cast(order_count as double) as y, true as sound
        from w where place > 30 and date between date '2000-01-01' and date '2000-12-31'
          and category in (select category from labelled where split = 'train')"""
    )
    q["ensemble_forecast_checked"] = (
        sql("", "daily", "labelled", "ends").rstrip()
        + f""" select category, {d("last_date + cast(k as int)")} as date, true as blended_between, true as band_fits
        from ends, generate_series(1, 30) g(k)"""
    )
    q["ensemble_weights_fallback"] = (
        sql("", "preds").rstrip()
        + f""", one as (select category, model, 1e0/greatest({r("sqrt(avg((y-yhat)*(y-yhat)))", 2)}, 0.001) as inverse
        from preds where date = date '2000-02-01' group by all)
        select category, model, {r("inverse/sum(inverse) over (partition by category)")} as weight from one
        union all select category, model, weight from (select distinct category from daily),
        (values ('mean_baseline', 0.25e0), ('lag1', 0.4e0), ('ma7', 0.35e0)) s(model, weight)
        where category not in (select category from one)"""
    )
    q["mean_baseline_unseen"] = (
        sql("", "labelled").rstrip()
        + f""", t as (select * from labelled where split = 'train' and category <> 'economy')
        select category, {d("date")} as date, 'mean_baseline' as model, cast(order_count as double) as y,
        {r("coalesce((select avg(order_count) from t where t.category = x.category), (select avg(order_count) from t))")} as yhat
        from labelled x where split = 'test'"""
    )
    q["absent_model"] = sql(
        f"select category, {d('date')} as date, 'sequence' as model, cast(order_count as double) as y, 100e0 as yhat from daily", "daily"
    )
    q["densified_panel"] = sql(
        f"""select {d("s.date")} as date, category, coalesce(daily.order_count, 0) as order_count from
        (select category, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from daily group by 1) s
        left join daily using (category, date)""", "daily",
    )
    q["feature_counts"] = sql(
        "select leak_free, cast(n as int) as n_features, (select count(*) from daily) as n_rows from (values (false, 61), (true, 56)) t(leak_free, n)", "daily"
    )
    q["model_roundtrip"] = sql(
        f"""select {key}, {r("a + b*month(date)")} as yhat from daily,
        (select regr_intercept(order_count, month(date)) as a, regr_slope(order_count, month(date)) as b from daily)""", "daily",
    )

    q["future_spine"] = sql(
        f"select category, {d('last_date + cast(k as int)')} as date from ends, generate_series(1, 90) g(k)", "ends"
    )
    future_hot = ", ".join(
        [f"cast(isodow(date) - 1 = {k} as int) as dow_{k}" for k in range(1, 7)]
        + [f"cast(month(date) = {k} as int) as month_{k}" for k in range(2, 13)]
    )
    snap = [f"order_count_lag_{k}" for k in (1, 2, 3, 7)] + ROLL_NAMES
    absent = ", ".join(f"0e0 as {n}" for n in [f"order_count_lag_{k}" for k in (14, 21, 30)] + list(EXOGENOUS))
    q["future_features"] = sql(
        f"""select {key}, cast(0 as bigint) as order_count, cast(isodow(date) - 1 as int) as day_of_week,
        cast(month(date) as int) as month, cast(quarter(date) as int) as quarter, cast(day(date) as int) as day_of_month,
        cast(week(date) as int) as week_of_year, cast(isodow(date) >= 6 as int) as is_weekend,
        cast(day(date) = 1 as int) as is_month_start, cast(date = last_day(date) as int) as is_month_end, {future_hot},
        cast(date in ({HOLIDAY_LIST}) as int) as is_holiday,
        cast(coalesce(lead(date) over (partition by category order by date) in ({HOLIDAY_LIST}), false) as int) as pre_holiday,
        cast(coalesce(lag(date) over (partition by category order by date) in ({HOLIDAY_LIST}), false) as int) as post_holiday,
        {cast_double(snap)}, {absent} from spine join snapshot using (category)""", "spine", "snapshot",
    )
    band_cols = "predicted_orders, predicted_lower, predicted_upper"
    q["forecast_band"] = sql(
        f"select {key}, {r('blended')} as blended, {band_cols}, lag1_prediction, ma7_prediction, mean_baseline_prediction from band", "band"
    )
    hist = f"""h as (select category, {r("avg(order_count)", 1)} as avg_historical_daily, max(date) as ld
        from daily join ends using (category) where date >= last_date - 30 group by 1),
        a as (select category, count(*) as forecast_days, cast(trunc(sum(blended)) as bigint) as total_forecast_orders,
        {r("avg(blended)", 1)} as avg_daily_forecast from band group by 1)"""
    q["forecast_summary"] = (
        sql("", "band", "ends").rstrip()
        + f""", {hist} select category, forecast_days, total_forecast_orders, avg_daily_forecast, avg_historical_daily,
        {d("ld")} as last_training_date,
        {r("(avg_daily_forecast - avg_historical_daily)/greatest(avg_historical_daily, 0.01)*100", 1)} as trend_pct
        from a join h using (category)"""
    )
    q["forecast_series"] = sql(
        f"""select {key}, {band_cols}, 'forecast' as kind from band union all select {key}, order_count, order_count, order_count, 'actual'
        from newest where rn = 1""", "band", "newest",
    )
    q["request_validation"] = """
        select request_id, 'forecast' as kind, concat_ws(',', case when category is null then 'category' end,
          case when coalesce(days, 30) < 1 or days > 365 then 'days' end) as errors, errors = '' as valid from
          (select c_custkey as request_id, nullif(c_mktsegment, 'FURNITURE') as category,
           case when c_custkey % 5 <> 0 then c_custkey % 400 - 10 end as days from customer)
        union all select request_id, 'plan', concat_ws(',', case when st < 0 then 'storage_capacity' end,
          case when bu < 0 then 'budget' end, case when sl < 0 or sl >= 1 then 'service_level' end) as errors, errors = '' from
          (select c_custkey as request_id, c_acctbal as st, c_acctbal + 500 as bu,
           coalesce(case when c_custkey % 3 <> 0 then (c_custkey % 110)/100e0 end, 0.95) as sl from customer)"""
    asked_tables = ("train_mean", "snapshot", "weights", "ends")
    q["forecast_requests"] = (
        sql("", *asked_tables).rstrip()
        + f""", {ASKED}, {LEVEL} select request_id, category, days, {d("last_date + cast(k as int)")} as date,
        {whole("blended")} as predicted_orders, cast(k as int) as days_ahead
        from asked_days join level using (category) join ends using (category)"""
    )
    q["forecast_requests_short"] = "select s_suppkey as request_id, '' as category, 0::int as days, 0::bigint as n from supplier where false"
    q["forecast_request_summary"] = (
        sql("", *asked_tables).rstrip()
        + f""", {ASKED}, {LEVEL} select request_id, category, count(*) as forecast_days,
        cast(trunc(sum(blended)) as bigint) as total_forecast_orders, {r("avg(blended)", 1)} as avg_daily_forecast
        from asked_days join level using (category) group by 1, 2"""
    )
    q["forecast_requests_rejected"] = (
        sql("", "ends").rstrip()
        + f""", {ASKED} select request_id, category, days,
        case when days not between 1 and 365 then 'days' else 'unknown category' end as errors from a
        where days not between 1 and 365 or category not in (select category from ends)"""
    )

    q["cost_config"] = sql("select * from costs", "costs")
    q["inventory_items_defaulted"] = (
        sql("", "costs", "profile", "newest").rstrip()
        + f""", top4 as (select * from profile order by total desc, category limit 4)
        select category, coalesce(monthly_forecast, 100e0) as forecast_demand,
        {r("greatest(case when monthly_forecast is null then 100e0*0.3e0 else coalesce(demand_std, 1) end, 1)")} as forecast_std,
        current_stock, unit_cost, selling_price, 7 as lead_time_days, storage_per_unit, 'profile' as origin
        from costs left join top4 using (category)
        union all select category, cast(order_count as double), {r("order_count*0.3e0")}, 100e0, 50e0, 80e0, 7, 1e0, 'forecast' from newest where rn = 1"""
    )
    q["safety_stock"] = sql(
        f"""select scenario, category, {r("z*forecast_std*sqrt(lead_time_days/30e0)")} as safety_stock,
        {r("forecast_demand + z*forecast_std*sqrt(lead_time_days/30e0)")} as reorder_point
        from sku cross join {scenario_values(PLAN_SCENARIOS)}""", "sku",
    )
    q["reorder_plan"] = plan_sql(REPORT, "sku", PLAN_SCENARIOS, "sku")
    q["reorder_plan_low_service"] = plan_sql(
        f"""select scenario, category, status, {r("q", 3)} as reorder_quantity, {r("shortage", 3)} as shortage,
        {r("hold", 3)} as holding_cost, {r("stockout", 3)} as stockout_cost from cost""", "sku", LOW_SCENARIOS, "sku",
    )
    q["reorder_totals"] = plan_sql(TOTALS, "sku", PLAN_SCENARIOS, "sku")
    q["service_level_sweep"] = plan_sql(TOTALS, "sku", SWEEP, "sku")
    q["naive_vs_optimal_cost"] = plan_sql(
        f"""select scenario, {r("n", 2)} as naive_cost, {r("o", 2)} as optimal_cost, {r("(n - o)/n*100", 1)} as saving_pct from
        (select scenario, sum(holding_rate*unit_cost*(current_stock + forecast_demand)) as n, sum(hold + stockout) as o from cost group by 1)""",
        "sku", PLAN_SCENARIOS, "sku",
    )
    latest_items = """(select category, cast(order_count as double) as forecast_demand, order_count*0.3e0 as forecast_std,
        100e0 as current_stock, 50e0 as unit_cost, 7 as lead_time_days, 1e0 as storage_per_unit from newest where rn = 1)"""
    q["reorder_from_latest"] = plan_sql(REPORT, latest_items, [("latest", 10000.0, 500000.0, 0.95, 0.25, 0.4)], "newest")
    profile_items = """(select category, monthly_forecast as forecast_demand, greatest(coalesce(demand_std, 1), 1) as forecast_std,
        current_stock, unit_cost, 7 as lead_time_days, storage_per_unit
        from (select * from profile order by total desc, category limit 10) join costs using (category))"""
    q["reorder_from_profile"] = plan_sql(
        REPORT, profile_items, [("profile", 1e12, 1e13, 0.95, 0.25, 0.4)], "costs", "profile"
    )
    levels = sorted({0.3} | {round(0.8 + k / 100, 2) for k in range(20)})
    z_rows = ", ".join(f"({v!r}::double, {NormalDist().inv_cdf(v)!r}::double)" for v in levels)
    batch_items = """(select l_suppkey as scenario, p_brand as category, cast(count(*) as double) as forecast_demand,
        count(*)*0.3e0 as forecast_std, cast(max(p_size) as double) as unit_cost, cast(min(p_size) % 9 - 1 as double) as current_stock,
        7 as lead_time_days, cast(count(*) % 5 as double) as storage_per_unit
        from lineitem join part on l_partkey = p_partkey where l_suppkey % 9 <> 0 group by 1, 2)"""
    batch_limits = f"""join (select s_suppkey as scenario,
        coalesce(nullif(case when s_suppkey % 4 <> 0 then 200e0*(s_suppkey % 50) end, 0), 10000e0) as storage_capacity,
        coalesce(nullif(case when s_suppkey % 13 = 0 then -1 else abs(s_acctbal)*100 end, 0), 500000e0) as budget, zt.z, 0.25e0 as holding_rate, 0.4e0 as stockout_rate
        from supplier join (values {z_rows}) zt(level, z) on abs(zt.level - case when s_suppkey % 7 = 0 then 0.3e0
          when s_suppkey % 7 <> 1 then 0.8e0 + (s_suppkey % 21)/100e0 else 0.95e0 end) < 1e-9) using (scenario)"""
    q["plan_requests_rejected"] = f"""with items as {batch_items}, asked as (select s_suppkey as request_id,
          concat_ws(',', case when s_suppkey % 13 = 0 then 'budget' end,
            case when s_suppkey % 7 not in (0, 1) and s_suppkey % 21 = 20 then 'service_level' end) as broken from supplier)
        select request_id, null::varchar as category, broken as errors from asked where broken <> ''
        union all select request_id, null, 'no items' from asked where broken = '' and request_id not in (select scenario from items where current_stock >= 0)
        union all select scenario, category, 'current_stock' from items where current_stock < 0
        union all select scenario, category, 'unknown request' from items where current_stock >= 0 and scenario not in (select request_id from asked)"""
    q["reorder_batch"] = "with " + plan_ctes(f"(select * from {batch_items} where current_stock >= 0 and scenario % 13 <> 0)", batch_limits).lstrip() + f"""
        select scenario as request_id, category, status, {r("ss", 3)} as safety_stock, {r("q", 3)} as reorder_quantity,
        {r("hold", 3)} as holding_cost, {r("stockout", 3)} as stockout_cost from cost"""
    return q
