"""Retail views over the driver's TPC-H-like tables (FIXTURES.md part 2).

Every view is a lazy DataFrame over the parquet files, so filters and column
pruning reach the scans. The same definitions exist as DuckDB CTEs in
``pricewise.plans.oracle_views`` for the SQL oracle.

Join strategy: lineitem x orders and lineitem x part are fact x large-dimension
joins; their sides grow with the data, so no broadcast is forced and Spark/AQE
choose from measured sizes. Only calendar-bounded dimensions (type codes,
calendars) are broadcast explicitly. The joined lines are a stage by month, written
once an application: all views of sales read it, so the lines are joined once whatever
a query asks of them, and a file's lines share their days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewise.sources import stages

# Fixed values of the fixture definition.
# Store (order priority) -> platform dictionary (P-16), unmapped names pass through.
STORE_PLATFORM = {
    "1-URGENT": "MAIN",
    "2-HIGH": "MAIN",
    "3-MEDIUM": "MAIN",
    "4-NOT SPECIFIED": "SIDE",
    "5-LOW": "MAIN",
}
# Season prefix by calendar quarter 1..4.
SEASON_PREFIXES = ["SP", "SU", "FA", "HO"]
# Retail moments, every year: (name, first month-day, number of days).
RM_EVENTS = [("618", "06-16", 3), ("99", "09-09", 2), ("1111", "11-11", 1), ("1212", "12-12", 1)]
# Division of the promo product type; all other types are footwear.
PROMO_TYPE = "PROMO"

TABLES = ["lineitem", "orders", "part"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def season_of(date_col) -> F.Column:
    prefixes = F.array(*[F.lit(p) for p in SEASON_PREFIXES])
    return F.concat(F.element_at(prefixes, F.quarter(date_col)), F.year(date_col).cast("string"))


def map_column(c, mapping: dict) -> F.Column:
    """P-16: replace by dictionary, unmapped values unchanged."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c)


def part_sku(part: DataFrame) -> DataFrame:
    """part -> SKU keys. Type code = 100 x alphabetical position of p_type;
    the distinct type set is tiny (bounded by the type vocabulary), so the
    numbering window and the broadcast run on that set only."""
    types = part.select("p_type").distinct()
    codes = types.withColumn(
        "type_code", (F.dense_rank().over(Window.orderBy("p_type")) * 100).cast("int"))
    brand_txt = F.substring_index("p_brand", "#", -1)
    return (part.join(F.broadcast(codes), "p_type")
            .select("p_partkey", "p_name", "p_type", "p_size",
                    brand_txt.cast("int").alias("brand_no"),
                    F.lpad(brand_txt, 6, "0").alias("style_cd"),
                    F.concat(F.lpad(brand_txt, 6, "0"), F.lit("-"),
                             F.col("type_code").cast("string")).alias("prod_code")))


def _sales_columns(lines: DataFrame) -> DataFrame:
    """The columns of ``sales_trans`` from joined lines dealt by month."""
    sales_date = F.col("sales_date")
    md_pct = F.lit(100.0) - F.lit(5.0) * F.col("discount_pct")
    msrp = (F.col("p_size") * 50).cast("double")
    off = (F.col("brand_no") + F.quarter(sales_date)) % 3 == 0
    return lines.select(
        F.col("o_orderpriority").alias("store_nm"),
        map_column(F.col("o_orderpriority"), STORE_PLATFORM).alias("platform"),
        "sales_date",
        # out-of-season rows sell goods of the season before
        F.when(off, season_of(F.add_months(sales_date, -3))).otherwise(season_of(sales_date)).alias("season1"),
        F.when(off, F.lit("N")).otherwise(F.lit("Y")).alias("inseason_flag1"),
        "style_cd", "prod_code",
        F.col("p_size").cast("string").alias("size_cd"),
        msrp.alias("MSRP"),
        (md_pct / 100.0).alias("md_line"),
        F.col("l_quantity").alias("sales_qty"),
        (msrp * md_pct * F.col("l_quantity") / 100.0).alias("sales_amt"),
        F.col("l_linenumber").alias("line_no"),
        stages.MONTH,
    )


@dataclass
class RetailViews:
    spark: SparkSession
    sf_dir: str

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def inputs(self) -> list[str]:
        """The files that the sales are made from."""
        return [f for t in TABLES for f in self._t(t).inputFiles()]

    # ---------------------------------------------------------------- sales
    def sales_trans(self) -> DataFrame:
        """One row per line: store, platform, date, season, flag, SKU, size,
        MSRP, line md, qty, amount. md = (100 - 5 x round(100 x discount)) / 100;
        amount = MSRP x md x qty, computed through integers so it is exact."""
        return self.stored_sales().drop(stages.MONTH)

    def stored_sales(self) -> DataFrame:
        """:meth:`sales_trans` as a stage by month of sale. The joins and the deal by
        month carry the lines' own numbers; texts are made of them after it."""
        return stages.stored(self.spark, "sales", self.inputs(), self._lines, "sales_date", _sales_columns)

    def _lines(self) -> DataFrame:
        li = self._t("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.to_date("l_shipdate").alias("sales_date"),
            F.round(F.col("l_discount") * 100.0).alias("discount_pct"))
        orders = self._t("orders").select("o_orderkey", "o_orderpriority")
        sku = part_sku(self._t("part")).select("p_partkey", "p_size", "brand_no", "style_cd", "prod_code")
        return (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(sku, li.l_partkey == sku.p_partkey)
                .select("o_orderpriority", "sales_date", "brand_no", "style_cd", "prod_code", "p_size",
                        "discount_pct", "l_quantity", "l_linenumber"))

    # ----------------------------------------------------------- attributes
    def attributes(self) -> DataFrame:
        """One row per SKU: division, gender, category, model, platform class,
        power item (NULL for brand mod 4 = 0), colour description."""
        sku = part_sku(self._t("part"))
        b = F.col("brand_no")
        return (sku.groupBy("prod_code", "style_cd", "brand_no", "p_type")
                .agg(F.min("p_name").alias("min_name"))
                .select(
                    "prod_code",
                    F.col("style_cd").alias("style_number"),
                    F.when(F.col("p_type") == PROMO_TYPE, F.lit("OTHER"))
                     .otherwise(F.lit("FOOTWEAR")).alias("division"),
                    F.concat(F.lit("G"), (b % 2).cast("string")).alias("gender_group"),
                    F.when(b != 23, F.concat(F.lit("C"), (b % 3).cast("string"))).alias("gc_category"),
                    F.concat(F.lit("M"), (b % 5).cast("string")).alias("model"),
                    F.col("p_type").alias("class_platform"),
                    F.when(b % 4 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("P"), (b % 4).cast("string"))).alias("power_item"),
                    F.concat(F.col("min_name"), F.lit("/"), F.col("p_type")).alias("color_desc"),
                ))

    # ------------------------------------------------------------ inventory
    def inventory(self) -> DataFrame:
        """Per (store, SKU, EOP_DT = sales_date - 1): end-of-day stock and
        transit quantities."""
        s = self.sales_trans()
        return (s.groupBy("store_nm", "prod_code", F.date_sub("sales_date", 1).alias("eop_dt"))
                .agg(F.sum(100.0 - F.col("sales_qty")).alias("eop_qty"),
                     F.sum("line_no").cast("double").alias("in_transit_qty"),
                     (2 * F.sum("line_no")).cast("double").alias("warehouse_transit_qty")))

    # ------------------------------------------------------------ calendars
    def _date_bounds(self) -> DataFrame:
        li = self._t("lineitem")
        return li.agg(F.to_date(F.min("l_shipdate")).alias("lo"),
                      F.to_date(F.max("l_shipdate")).alias("hi"))

    def season_calendar(self) -> DataFrame:
        """One row per calendar day between the first and last sale date
        (bounded by the calendar, so safe to broadcast)."""
        days = self._date_bounds().select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))
        return days.select("cal_date", season_of(F.col("cal_date")).alias("season"))

    def rm_calendar(self) -> DataFrame:
        """Retail-moment days of every year in the data: name, running event
        number, day number inside the event."""
        years = self._date_bounds().select(
            F.year("lo").alias("y0"), F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("yr"))
        events = self.spark.createDataFrame(
            [(i, name, md, n) for i, (name, md, n) in enumerate(RM_EVENTS)],
            "ev_idx int, rm_name string, first_md string, n_days int")
        rows = (years.crossJoin(F.broadcast(events))  # years x 4 events: calendar-bounded
                .withColumn("number", ((F.col("yr") - F.col("y0")) * len(RM_EVENTS)
                                       + F.col("ev_idx") + 1).cast("int"))
                .withColumn("day_number", F.explode(F.sequence(F.lit(1), F.col("n_days")))))
        start = F.to_date(F.concat(F.col("yr").cast("string"), F.lit("-"), F.col("first_md")))
        return rows.select(F.date_add(start, F.col("day_number") - 1).alias("sales_date"),
                           "rm_name", "number", "day_number")

    def traffic(self) -> DataFrame:
        o = self._t("orders")
        return (o.groupBy(F.col("o_orderpriority").alias("store_nm"),
                          F.to_date("o_orderdate").alias("sales_date"))
                .agg((F.count(F.lit(1)) * 1000).alias("site_traffic")))

    def color_lexicon(self) -> DataFrame:
        p = self._t("part")
        return p.select(F.split("p_name", " ").getItem(0).alias("color")).distinct()
