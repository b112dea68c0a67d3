"""Hand-made raw tables -> features -> star -> measures, RLS, windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators import analytics as an
from salescast.operators import forecast as fc
from salescast.operators import joins, measures as me, security as sec
from salescast.operators import star as starmod
from salescast.operators import timeseries as ts


def d(s):
    return dt.date.fromisoformat(s)


def day(n):
    return dt.date(2016, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def raw(spark):
    # series (1, A) 20 days, (1, B) 8 days with one gap, (2, A) 5 days
    train = [(day(i), 1, "GROCERY I", float(10 + i), i % 2) for i in range(20)]
    train += [(day(i), 1, "LIQUOR,WINE,BEER", float(i), 0) for i in range(9) if i != 4]
    train += [(day(i), 2, "GROCERY I", -1.0 if i == 0 else 5.0, 0) for i in range(5)]
    stores = [(1, "Quito", "Pichincha", "D", 13), (2, "Guayaquil", "Guayas", "A", 1)]
    oil = [(day(0), None), (day(1), 40.0), (day(4), 44.0), (day(5), 45.0), (day(11), 51.0), (day(19), None)]
    hol = [(day(3), False), (day(3), True), (day(10), True)]
    tx = [(day(i), 1, 100 + i) for i in range(20)]
    return {
        "train": spark.createDataFrame(train, "date date, store_nbr int, family string, sales double, onpromotion int"),
        "stores": spark.createDataFrame(stores, "store_nbr int, city string, state string, type string, cluster int"),
        "oil": spark.createDataFrame(oil, "date date, dcoilwtico double"),
        "holidays": spark.createDataFrame(hol, "date date, transferred boolean"),
        "transactions": spark.createDataFrame(tx, "date date, store_nbr int, transactions int"),
    }


@pytest.fixture(scope="module")
def feats(raw):
    return starmod.features(starmod.load_raw(raw)).cache()


@pytest.fixture(scope="module")
def star(feats):
    s = starmod.build_star(feats)
    frame = fc.scoring_frame(s, feats, horizon=10)
    ff = fc.fact_forecasts(fc.demo_forecast(frame, noise=0.0), s.dim_product)
    return s.replace(fact_forecasts=ff)


def test_oil_gaps_ffill_then_bfill(raw):
    oil = starmod.load_raw(raw)["oil"].orderBy("date").collect()
    vals = {r.date: r.oil_price for r in oil}
    assert vals[day(0)] == 40.0          # leading NULL back-filled
    assert vals[day(2)] == 40.0 and vals[day(3)] == 40.0   # gap forward-filled
    assert vals[day(12)] == 51.0 and vals[day(19)] == 51.0  # trailing NULL forward-filled
    assert len(oil) == 20                # widened to every sales date


def test_features_shape_and_joins(feats):
    assert feats.columns == starmod.FEATURE_ORDER
    rows = {(r.store_nbr, r.family, r.date): r for r in feats.collect()}
    r = rows[(2, "GROCERY I", day(0))]
    assert r.sales == 0.0 and r.transactions == 0.0 and r.city == "Guayaquil"
    assert rows[(1, "GROCERY I", day(3))].is_holiday == 1
    assert rows[(1, "GROCERY I", day(10))].is_holiday == 0


def test_series_short_lag_does_not_cross_series(feats):
    rows = {(r.store_nbr, r.family, r.date): r.oil_price_lag7 for r in feats.collect()}
    oil = {r.date: r.oil_price for r in feats.select("date", "oil_price").distinct().collect()}
    # 5-row series: no row has 7 predecessors -> stays NULL (never borrows)
    assert all(rows[(2, "GROCERY I", day(i))] is None for i in range(5))
    # 8-row series with a gap: lag counts rows, leading rows take row 1's oil
    dates_b = [day(i) for i in range(9) if i != 4]
    assert rows[(1, "LIQUOR,WINE,BEER", dates_b[7])] == oil[dates_b[0]]
    assert all(rows[(1, "LIQUOR,WINE,BEER", x)] == oil[dates_b[0]] for x in dates_b[:7])
    # 20-row series: row 8 onwards = oil 7 rows earlier
    assert rows[(1, "GROCERY I", day(12))] == oil[day(5)]


def test_star_dims(star):
    ds = {r.store_nbr: r for r in star.dim_store.collect()}
    assert ds[1].region == "Highland" and ds[2].region == "Coastal" and ds[1].store_key == 1
    dp = {r.family: (r.product_key, r.category) for r in star.dim_product.collect()}
    assert dp == {"GROCERY I": (1, "Grocery"), "LIQUOR,WINE,BEER": (2, "Beverages")}
    dd = star.dim_date.collect()
    assert len(dd) == 20 and dd[0].date_key == 20160101 and len(star.dim_date.columns) == 15


def test_orphans_report(star):
    rep = {(r.fact, r.key): r.orphans for r in starmod.integrity(star).collect()}
    assert rep[("fact_sales", "date_key")] == 0
    assert rep[("fact_forecasts", "date_key")] == 10   # forecast dates are past the calendar
    assert rep[("fact_forecasts", "store_key")] == 0


def test_pct_of_total_sums_to_one(star):
    rows = me.pct_of_total(star, ["family"]).collect()
    assert abs(sum(r.pct_of_total for r in rows) - 1.0) < 1e-5


def test_ytd_at_year_end_equals_year_total(star):
    ytd = me.to_date_total(star, "year").orderBy(F.desc("date")).first().revenue_ytd
    tot = me.total(star, "revenue").first().revenue
    assert abs(ytd - tot) < 1e-6


def test_rls_regions_partition_total(star):
    tot = an.kpis(star).first().total_revenue
    parts = [an.kpis(sec.secure(star, r)).first().total_revenue or 0.0 for r in ("Highland", "Coastal", "Amazon")]
    assert abs(sum(parts) - tot) < 1e-6
    assert an.kpis(sec.secure(star, "Amazon")).first().total_revenue is None
    assert sec.secure(star, "All") is star


def test_rls_users(spark, star):
    grants = spark.createDataFrame([("ana", "Highland"), ("ana", "Coastal"), ("bo", "All"), ("cy", "Amazon")],
                                   "user string, role string")
    roles = sec.roles_frame(spark)
    seen = {}
    for u in ["ana", "bo", "cy", "dee"]:
        s = sec.secure_for(star, u, grants, roles)
        seen[u] = sorted(r.store_key for r in s.dim_store.collect())
    assert seen == {"ana": [1, 2], "bo": [1, 2], "cy": [], "dee": []}


def test_yoy_gap_blank_vs_minus_one(spark):
    # prior year present, current missing -> -1; prior missing -> NULL; prior 0 -> NULL
    fact = spark.createDataFrame([
        (d("2015-01-10"), 20150110, 1, 1, 100.0), (d("2016-01-10"), 20160110, 1, 1, 150.0),
        (d("2015-02-28"), 20150228, 1, 1, 10.0), (d("2015-03-01"), 20150301, 1, 1, 0.0),
        (d("2016-03-05"), 20160305, 1, 1, 5.0)],
        "date date, date_key int, store_key int, product_key int, revenue double")
    dates = fact.select("date")
    dim_date = (ts.date_spine(dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")),
                              F.col("lo"), F.col("hi"))
                .select("date", (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).alias("date_key"),
                        F.year("date").alias("year"), F.month("date").alias("month")))
    s = starmod.Star(dim_date=dim_date, dim_store=None, dim_product=None, fact_sales=fact)
    m = {(r.year, r.month): r for r in me.yoy(s, "month").collect()}
    assert m[(2016, 1)].yoy_growth == 0.5
    assert m[(2016, 2)].yoy_growth == -1.0 and m[(2016, 2)].current is None
    assert m[(2016, 3)].yoy_growth is None          # prior March is 0 -> BLANK
    assert m[(2015, 1)].yoy_growth is None          # no prior year
    dd = {r.date: r for r in me.yoy(s, "date").collect()}
    # 29 Feb 2016 and 28 Feb 2016 both compare with 28 Feb 2015
    assert dd[d("2016-02-29")].prior_year == 10.0 and dd[d("2016-02-28")].prior_year == 10.0


def test_mape_zero_actuals_counted(spark):
    k = "date_key int, store_key int, product_key int"
    fact = spark.createDataFrame([(1, 1, 1, 10.0), (2, 1, 1, 0.0), (3, 1, 1, 5.0)], k + ", sales double")
    fcst = spark.createDataFrame([(1, 1, 1, 12.0), (2, 1, 1, 3.0), (9, 1, 1, 1.0)], k + ", predicted_sales double")
    s = starmod.Star(dim_date=None, dim_store=None, dim_product=None, fact_sales=fact, fact_forecasts=fcst)
    r = me.mape_bi(s).first()
    # matched rows: key 1 (|10-12|/10 = 0.2) and key 2 (actual 0 adds nothing); / 2 rows
    assert r.matched_rows == 2 and abs(r.mape - 10.0) < 1e-9
    none = starmod.Star(dim_date=None, dim_store=None, dim_product=None, fact_sales=fact,
                        fact_forecasts=fcst.where(F.col("date_key") == 9))
    assert me.mape_bi(none).first() is None or me.mape_bi(none).first().mape is None


def test_weekly_rollup_fills_empty_weeks(spark):
    ff = spark.createDataFrame([(d("2017-01-02"), 1.0, 2.0, 3.0), (d("2017-01-20"), 4.0, 5.0, 6.0)],
                               "date date, predicted_sales double, predicted_revenue double, predicted_margin double")
    w = fc.weekly_rollup(ff).orderBy("date").collect()
    assert [r.date.isoformat() for r in w] == ["2017-01-08", "2017-01-15", "2017-01-22"]
    assert [r.predicted_sales for r in w] == [1.0, 0.0, 4.0]


def test_scoring_grid_without_cartesian_join(spark, star, feats):
    frame = fc.scoring_frame(star, feats, horizon=10)
    assert frame.count() == 3 * 10
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_semi_join_filters_fact(star):
    hi = joins.apply_context(star, {"dim_store": F.col("region") == "Coastal"})
    assert {r.store_key for r in hi.fact_sales.select("store_key").distinct().collect()} == {2}
    assert {r.store_key for r in hi.fact_forecasts.select("store_key").distinct().collect()} == {2}


def test_role_kpis_equal_secure_per_role(star):
    grouped = {r.role: r for r in sec.role_kpis(star).collect()}
    for role in ("Highland", "Coastal", "Amazon"):
        k = an.kpis(sec.secure(star, role)).first()
        g = grouped[role]
        assert (g.total_revenue, g.total_units, g.forecast_revenue, g.forecast_units, g.forecast_margin) == \
               (k.total_revenue, k.total_units, k.forecast_revenue, k.forecast_units, k.forecast_margin)


def test_selected_metric_table_matches_single(star):
    t = {(r.metric, r.category): r.selected_metric for r in me.selected_metric_table(star, ["category"]).collect()}
    for sel in ("Revenue", "Units", "Margin", None):
        single = {r.category: r.selected_metric for r in me.selected_metric(star, sel, ["category"]).collect()}
        for cat, v in single.items():
            assert abs(t[(sel or "(none)", cat)] - float(v)) < 1e-9


def test_pct_of_total_filters_and_unknown_key(spark, star, feats):
    where = {"dim_store": F.col("region") == "Coastal"}
    ignore = me.pct_of_total(star, ["family"], where=where).collect()
    keep = me.pct_of_total(star, ["family"], where=where, respect_filters=True).collect()
    assert sum(r.pct_of_total for r in ignore) < 0.999
    assert abs(sum(r.pct_of_total for r in keep) - 1.0) < 1e-5
    preds = spark.createDataFrame([(day(30), 1, "NEW FAMILY", 3.0)],
                                  "date date, store_nbr int, family string, predicted_sales double")
    assert fc.fact_forecasts(preds, star.dim_product).first().product_key is None
    r = fc.fact_forecasts(preds, star.dim_product, unknown_product_key=1).first()
    assert r.product_key == 1 and float(r.predicted_revenue) == 15.0   # "Other" price 5.00


def test_describe_exact_and_sketch(feats):
    ex = {r.column: r for r in an.describe(feats, ["sales", "transactions"]).collect()}
    ap = {r.column: r for r in an.describe(feats, ["sales", "transactions"], exact=False).collect()}
    import numpy as np
    sales = np.array([r.sales for r in feats.select("sales").collect()])
    assert abs(ex["sales"].p50 - float(np.percentile(sales, 50))) < 1e-9
    assert ap["sales"]["count"] == ex["sales"]["count"] and ap["sales"].p50 in set(sales.tolist())


def test_forecast_variance_grand_total_without_keyless_join(star):
    v = me.forecast_variance(star, [])
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    r = v.first()
    k = an.kpis(star).first()
    assert r.actual_revenue == k.total_revenue and r.forecast_revenue == k.forecast_revenue
    assert abs(r.variance - round((k.forecast_revenue - k.total_revenue) / k.total_revenue, 6)) < 1e-9


def test_holiday_filter_option(spark, raw):
    from salescast.operators import star as sm
    events = raw["holidays"].withColumn("locale", F.when(F.col("date") == day(3), "Local").otherwise("National"))
    r = dict(raw, holidays=events)
    all_flags = {x.date: x.is_holiday for x in sm.load_raw(r)["holidays"].collect()}
    national = {x.date: x.is_holiday for x in sm.load_raw(r, F.col("locale") == "National")["holidays"].collect()}
    assert all_flags[day(3)] == 1 and day(3) not in national
