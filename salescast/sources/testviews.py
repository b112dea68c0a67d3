"""Raw retail tables derived from the driver's TPC-H-like tables.

The raw retail CSVs are not available, so the five raw inputs are made out of
the driver tables with Spark jobs; their work grows with the tables:

    train         lineitem ⨝ orders ⨝ supplier ⨝ part, aggregated to
                  (date = order date, store_nbr = supplier nation,
                   family = part brand): sales = Σ quantity,
                  onpromotion = #lines with discount ≥ 0.05
    stores        nation ⨝ region: city = nation name, state = region name
    oil           max order total per weekday / 10,000 (weekend gaps remain)
    holidays      one event per order placed on the 1st of a month or on
                  25 December; an event is "transferred" when the order has
                  priority 5-LOW (several events per date, some dates all
                  transferred)
    transactions  distinct orders per (date, store)

The same definitions, in SQL, are the oracle's base views
(``salescast.plans.oracle``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.session import materialize

# Categories in the order of the price table; the test view assigns brands to
# them by rule, leaving the last two brands unmapped (they fall to "Other").
CATEGORIES = ["Grocery", "Fresh", "Frozen", "Bakery", "Household", "Personal Care",
              "Apparel", "Seasonal", "Electronics", "Beverages", "Other"]
N_MAPPED_BRANDS = 23
STORE_TYPES = ["A", "B", "C", "D", "E"]
PROMO_DISCOUNT = 0.05
OIL_SCALE = 10000.0

# Region of each driver "state" (= TPC-H region name); MIDDLE EAST is left
# unmapped on purpose so the "Other" default is exercised.
TEST_STATE_TO_REGION = {
    "AFRICA": "Amazon",
    "AMERICA": "Coastal",
    "ASIA": "Highland",
    "EUROPE": "Highland",
}


def test_family_to_category() -> dict[str, str]:
    return {f"Brand#{n}": CATEGORIES[(n - 1) % len(CATEGORIES)]
            for n in range(1, N_MAPPED_BRANDS + 1)}


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class RawTables:
    train: DataFrame
    stores: DataFrame
    oil: DataFrame
    holidays: DataFrame
    transactions: DataFrame
    family_to_category: dict = field(default_factory=test_family_to_category)
    state_to_region: dict = field(default_factory=lambda: dict(TEST_STATE_TO_REGION))

    def as_dict(self) -> dict[str, DataFrame]:
        return {"train": self.train, "stores": self.stores, "oil": self.oil,
                "holidays": self.holidays, "transactions": self.transactions}


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order date and store (supplier nation)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("date"))
    supplier = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("store_nbr"))
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(supplier, li.l_suppkey == supplier.s_suppkey))


def raw_train(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("family"))
    lines = _order_lines(spark, sf_dir) if lines is None else lines
    lines = lines.join(part, lines.l_partkey == part.p_partkey)
    return (lines.groupBy("date", "store_nbr", "family")
                 .agg(F.sum("l_quantity").alias("sales"),
                      F.count_if(F.col("l_discount") >= PROMO_DISCOUNT).cast("int").alias("onpromotion")))


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    types = F.array(*[F.lit(t) for t in STORE_TYPES])
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
                  .select(F.col("n_nationkey").cast("int").alias("store_nbr"),
                          F.col("n_name").alias("city"),
                          F.col("r_name").alias("state"),
                          F.element_at(types, (F.col("n_nationkey") % len(STORE_TYPES) + 1).cast("int")).alias("type"),
                          (F.col("n_regionkey") + 1).cast("int").alias("cluster")))


def raw_oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return (orders.where(F.weekday(d) < 5)
                  .groupBy(d.alias("date"))
                  .agg((F.max("o_totalprice") / OIL_SCALE).alias("dcoilwtico")))


def raw_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    is_event = (F.dayofmonth(d) == 1) | ((F.month(d) == 12) & (F.dayofmonth(d) == 25))
    return (orders.where(is_event)
                  .select(d.alias("date"),
                          (F.col("o_orderpriority") == "5-LOW").alias("transferred")))


def raw_transactions(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = _order_lines(spark, sf_dir) if lines is None else lines
    return (lines.groupBy("date", "store_nbr")
                 .agg(F.countDistinct("o_orderkey").cast("int").alias("transactions")))


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    lines = materialize(_order_lines(spark, sf_dir).drop("l_suppkey", "s_suppkey"), spark, "order-lines")
    return RawTables(train=raw_train(spark, sf_dir, lines), stores=raw_stores(spark, sf_dir),
                     oil=raw_oil(spark, sf_dir), holidays=raw_holidays(spark, sf_dir),
                     transactions=raw_transactions(spark, sf_dir, lines))
