import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salescast.functions import calendar as cal
from salescast.functions import fixed
from salescast.operators import clean


def d(s):
    return dt.date.fromisoformat(s)


def test_sales_negative_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (2.5,)], "sales double")
    out = [r.sales for r in clean.clip_lower(df, "sales", 0.0).collect()]
    assert out == [0.0, 0.0, None, 2.5]


def test_paydays_month_end_and_15th(spark):
    days = ["2016-02-14", "2016-02-15", "2016-02-27", "2016-02-28", "2016-02-29", "2017-02-28",
            "2016-04-30", "2016-05-30", "2016-05-31"]
    df = spark.createDataFrame([(d(x),) for x in days], "date date")
    got = {r.date.isoformat(): r.p for r in df.select("date", cal.is_payday("date").alias("p")).collect()}
    assert got == {"2016-02-14": 0, "2016-02-15": 1, "2016-02-27": 0, "2016-02-28": 0, "2016-02-29": 1,
                   "2017-02-28": 1, "2016-04-30": 1, "2016-05-30": 0, "2016-05-31": 1}


def test_iso_weeks_and_monday_zero(spark):
    df = spark.createDataFrame([(d("2016-01-01"),), (d("2017-01-01"),), (d("2018-12-31"),)], "date date")
    rows = df.select(cal.week_of_year("date").alias("w"), cal.day_of_week("date").alias("dow"),
                     cal.is_weekend("date").alias("we")).collect()
    assert [(r.w, r.dow, r.we) for r in rows] == [(53, 4, 0), (52, 6, 1), (1, 0, 0)]


def test_calendar_names_and_keys(spark):
    df = spark.createDataFrame([(d("2017-03-05"),)], "date date")
    r = df.select(cal.month_name("date").alias("m"), cal.day_name("date").alias("n"),
                  cal.year_month("date").alias("ym"), cal.year_quarter("date").alias("yq"),
                  cal.date_key("date").alias("k"), cal.from_date_key(cal.date_key("date")).alias("back"),
                  cal.week_ending("date").alias("sun"), cal.is_month_start("date").alias("ms")).first()
    assert (r.m, r.n, r.ym, r.yq, r.k) == ("March", "Sunday", "2017-03", "2017Q1", 20170305)
    assert r.back == d("2017-03-05") and r.sun == d("2017-03-05") and r.ms == 1


def test_lookup_unknown_defaults(spark):
    df = spark.createDataFrame([("HOME APPLIANCES", "Nowhere"), ("LIQUOR,WINE,BEER", "Pichincha"),
                                ("BEVERAGES", "Guayas"), (None, None)], "family string, state string")
    out = (df.withColumn("category", clean.category_col("family"))
             .withColumn("price", clean.price_col("category"))
             .withColumn("rate", clean.margin_rate_col("category"))
             .withColumn("region", clean.lookup("state", fixed.STATE_TO_REGION, fixed.DEFAULT_REGION))
             .collect())
    assert [(r.category, r.price, r.rate, r.region) for r in out] == [
        ("Other", Decimal("5.00"), Decimal("0.25"), "Other"),
        ("Beverages", Decimal("3.50"), Decimal("0.32"), "Highland"),
        ("Grocery", Decimal("2.50"), Decimal("0.22"), "Coastal"),
        ("Other", Decimal("5.00"), Decimal("0.25"), "Other")]


def test_horizon_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0, 30, 31, 60, 61, 89, 90, 91]], "days int")
    got = [r.h for r in df.select(cal.horizon_label("days").alias("h")).collect()]
    assert got == ["30-Day", "30-Day", "60-Day", "60-Day", "90-Day", "90-Day", "90-Day", None]


def test_rounding_ties_half_even_and_clip(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,), (None,)], "p double")
    got = [r.p for r in clean.post_process(df, "p").collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, None]


def test_holidays_dup_max_per_date(spark):
    rows = [(d("2017-01-01"), False), (d("2017-01-01"), True), (d("2017-02-01"), True), (d("2017-02-01"), True)]
    df = spark.createDataFrame(rows, "date date, transferred boolean")
    got = {r.date.isoformat(): r.is_holiday for r in clean.holiday_flags(df).collect()}
    assert got == {"2017-01-01": 1, "2017-02-01": 0}


def test_revenue_margin_decimal(spark):
    df = spark.createDataFrame([(3.0, "Apparel"), (1.0, "Unknown")], "sales double, category string")
    r = clean.add_revenue_margin(df).collect()
    assert [(x.revenue, x.margin) for x in r] == [(Decimal("45.0000"), Decimal("22.5000")),
                                                 (Decimal("5.0000"), Decimal("1.2500"))]


def test_safe_divide_and_status(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    got = [r.x for r in df.select(cal.safe_divide("a", "b").alias("x")).collect()]
    assert got == [None, None, 1.5]
    m = spark.createDataFrame([(None,), (5.0,), (15.0,), (25.0,), (35.0,)], "mape double")
    s1 = [r.s for r in m.select(cal.mape_status("mape", blank_as_zero=True).alias("s")).collect()]
    s2 = [r.s for r in m.select(cal.mape_status("mape").alias("s")).collect()]
    assert s1 == ["Excellent", "Excellent", "Good", "Acceptable", "Needs Improvement"]
    assert s2[0] is None and s2[1:] == s1[1:]
    g = spark.createDataFrame([(0.06,), (-0.06,), (0.0,), (None,)], "g double")
    assert [r.c for r in g.select(cal.yoy_colour("g").alias("c")).collect()] == [
        fixed.YOY_GREEN, fixed.YOY_RED, fixed.YOY_GREY, fixed.YOY_GREY]


def test_align_columns_and_where_eq(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, city string")
    assert clean.align_columns(df, ["x", "y"]).columns == ["x", "city", "y"]
    assert clean.where_eq(df, "city", "All").count() == 2
    assert clean.where_eq(df, "city", "a").count() == 1


def test_golden_lookups_have_reference_shape():
    # 33 families map onto 11 categories; only three states fall outside the
    # 17-state region table in the committed store dimension.
    assert len(fixed.FAMILY_TO_CATEGORY) == 32
    assert set(fixed.FAMILY_TO_CATEGORY.values()) == set(fixed.AVG_PRICES) == set(fixed.MARGIN_RATES)
    assert fixed.FAMILY_TO_CATEGORY["BEVERAGES"] == "Grocery"
    assert "HOME APPLIANCES" not in fixed.FAMILY_TO_CATEGORY
    assert sorted(set(fixed.STATE_TO_REGION.values())) == ["Amazon", "Coastal", "Highland"]


def test_money_text(spark):
    df = spark.createDataFrame([(1234567890.0,)], "x double")
    r = df.select(cal.money_text("x", "B", 2).alias("t"), cal.percent_text(F.lit(0.2635)).alias("p")).first()
    assert r.t == "$1.23B" and r.p == "26.35%"


def test_revenue_and_margin_are_not_rounded(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(0.123456, "Grocery")], "sales double, category string")
    r = clean.add_revenue_margin(df, prices={"Grocery": 3.37}, rates={"Grocery": 0.19}).first()
    assert r.revenue == Decimal("0.123456") * Decimal("3.37") and r.margin == r.revenue * Decimal("0.19")
