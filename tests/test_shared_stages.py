"""The fact tables are joined once an application; a table that is ordered twice is computed once."""
import pytest
from pyspark.sql import functions as F

from pricewise.operators import reports as rp
from pricewise.plans import base, catalog
from pricewise.sources import stages


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Two orders, three parts, lines with a missing date, a missing part and a repeated row."""
    top = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "1-URGENT", "2000-09-01"), (2, "4-NOT SPECIFIED", "2000-09-02")],
                          "o_orderkey long, o_orderpriority string, o_orderdate string") \
        .withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{top}/orders.parquet")
    spark.createDataFrame([(1, "red shoe", "Brand#11", "PROMO", 7), (2, "blue shoe", "Brand#12", "SMALL", 50), (3, None, "Brand#12", "SMALL", None)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{top}/part.parquet")
    lines = [(1, 2, 1, 3.0, 0.05, "2000-09-09"), (1, 2, 2, 1.5, 0.1, "2000-09-10"), (1, 1, 3, 2.0, None, "2000-11-11"), (2, 2, 1, 4.0, 0.0, "1999-09-09"),
             (1, 2, 1, 3.0, 0.05, "2000-09-09"), (1, 3, 4, None, 0.07, "2000-12-12"), (2, None, 2, 1.0, 0.0, "2000-09-09"), (2, 2, 3, 6.0, 0.02, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate string") \
        .withColumn("l_shipdate", F.to_timestamp("l_shipdate")).write.parquet(f"{top}/lineitem.parquet")
    return top


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sales_rows(spark, sf):
    rows = base.views(spark, sf).sales_trans().orderBy("sales_date", "prod_code", "line_no").collect()
    got = [(r.store_nm, r.platform, r.sales_date and r.sales_date.isoformat(), r.season1, r.inseason_flag1, r.prod_code, r.size_cd, r.MSRP, r.md_line,
            r.sales_qty, r.sales_amt, r.line_no) for r in rows]
    side, main = ("4-NOT SPECIFIED", "SIDE"), ("1-URGENT", "MAIN")
    assert got == [
        (*side, None, None, "Y", "000012-200", "50", 2500.0, 0.9, 6.0, 13500.0, 3),
        (*side, "1999-09-09", "SU1999", "N", "000012-200", "50", 2500.0, 1.0, 4.0, 10000.0, 1),
        (*main, "2000-09-09", "SU2000", "N", "000012-200", "50", 2500.0, 0.75, 3.0, 5625.0, 1),
        (*main, "2000-09-09", "SU2000", "N", "000012-200", "50", 2500.0, 0.75, 3.0, 5625.0, 1),
        (*main, "2000-09-10", "SU2000", "N", "000012-200", "50", 2500.0, 0.5, 1.5, 1875.0, 2),
        (*main, "2000-11-11", "FA2000", "N", "000011-100", "7", 350.0, None, 2.0, None, 3),
        (*main, "2000-12-12", "HO2000", "Y", "000012-200", None, None, 0.65, None, None, 4)]


@pytest.mark.parametrize("name", ["previous_moment", "moment_history", "modeling_features_style"])
def test_lines_are_joined_once(spark, sf, name):
    assert "Join Inner, (l_" not in _plan(catalog.plans()[name](spark, sf))


def test_master_reads_joined_lines(spark, sf):
    assert "Join Inner, (l_" not in _plan(base.master(base.views(spark, sf)))


def test_base_rows_are_read_from_their_stage(spark, sf):
    plan = _plan(base.sku_base(base.views(spark, sf)))
    assert "Join" not in plan and "Aggregate" not in plan
    assert stages.MONTH not in base.sku_base(base.views(spark, sf)).columns


def test_top_share_computes_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    rows = [(f"s{i % 7}", i, float(i % 5 + 1), float(i % 3), abs(i % 3 / (i % 5 + 1) - 1)) for i in range(60)]
    metrics = spark.createDataFrame(rows, f"style_cd string, day int, sales_qty double, {rp.PRED} double, MAPE double")
    metrics = metrics.mapInPandas(counted, metrics.schema)
    got = {r.grain: r.n_rows for r in rp.top_share_medians(metrics, "style_cd", ["style_cd", "day"]).collect()}
    assert read.value == 60
    assert got["row"] > 0 and got["product"] > 0
