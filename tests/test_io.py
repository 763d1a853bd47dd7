"""Sources and sinks: GBK round trip, header aliases, code conformance on read,
report sinks, replace-table, streaming ingestion of period extracts."""

import os

from profitlens.plans.publish import publish_reports, publish_tables, stage_extracts
from profitlens.sources.facts import load_extracts
from profitlens.sources.files import (
    read_extract, read_raw, reject_report, replace_table, write_csv, write_report, write_sheets,
)
from profitlens.streaming.extracts import completeness, ingest_extracts


def _write_text(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_gbk_extract_with_business_headers(spark, scratch_dir):
    text = ("大类编码,门店DC编码,渠道,商品编码,商品名称,供应商业务码,销售净额,销售成本\n"
            "001, 002\t,到店,0100,苹果,9,10.50,8.00\n"
            ",003,到家,0200,香蕉,9,nan,1\n")
    path = os.path.join(scratch_dir, "sales_gbk.csv")
    _write_text(path, text, "gbk")
    df = read_extract(spark, path, "sales", encoding="GBK")
    rows = sorted(df.collect(), key=lambda r: r.sku_id)
    assert rows[0].category_id == "001" and rows[0].store_id == "002" and rows[0].sku_name == "苹果"
    assert float(rows[0].net_sales) == 10.5 and rows[0].supplier_id == "9"
    assert rows[1].category_id == "__NA__" and rows[1].net_sales is None
    assert dict(df.dtypes)["net_sales"] == "decimal(18,4)"


def test_gbk_sink_round_trip(spark, scratch_dir):
    df = spark.createDataFrame([("001", "苹果", 1.5)], "sku_id string, sku_name string, net_sales double")
    out = os.path.join(scratch_dir, "out_gbk")
    write_csv(df, out, encoding="GBK")
    back = read_extract(spark, out, "sales", encoding="GBK").collect()[0]
    assert back.sku_id == "001" and back.sku_name == "苹果" and float(back.net_sales) == 1.5


def test_report_and_sheets(spark, scratch_dir):
    df = spark.createDataFrame([("c", "2024-01", 1.0)], "company string, period string, v double")
    p = write_report(df, scratch_dir, "margin", partition_by=("company", "period"))
    assert spark.read.parquet(p).where("company = 'c' and period = '2024-01'").count() == 1
    paths = write_sheets({"summary": df, "detail": df}, scratch_dir, "abnormal")
    assert set(paths) == {"summary", "detail"}
    assert all(spark.read.parquet(x).count() == 1 for x in paths.values())


def test_replace_table_zeroes_undefined_ratios(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.5)], "k string, rate double")
    replace_table(df, "pl_test_publish")
    replace_table(df, "pl_test_publish")  # replaces, does not append
    got = {r.k: r.rate for r in spark.table("pl_test_publish").collect()}
    assert got == {"a": 0.0, "b": 0.5}
    try:
        replace_table(df, "bad; drop table x")
        raise AssertionError("expected rejection")
    except ValueError:
        pass


COUPON = "category_id,store_id,channel,sku_id,supplier_id,sku_name,supplier_name,department,coupon_type_id,biz_date,coupon_cost\n"
# the same columns in another order, by their business headers
COUPON_BUSINESS = "万家承担金额,日期,大类编码,门店编码,渠道,商品编码,供应商编码,商品名称,供应商名称,部门名称,券类型编码\n"


def _coupons(df):
    cols = ["category_id", "store_id", "channel", "sku_id", "supplier_id", "sku_name", "supplier_name", "department",
            "coupon_type_id", "biz_date", "coupon_cost"]
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


WANT = [("c1", "1", "a", "01", "9", "x", "s", "d", "t", "2024-01-01", "1.2500"),
        ("c1", "1", "a", "01", "9", "x", "s", "d", "t", "2024-01-03", "2.0000")]


def test_streaming_ingest_and_completeness(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    _write_text(os.path.join(landing, "p1.csv"), COUPON + "c1,1,a,01,9,x,s,d,t,2024-01-01,1.25\n", "utf-8")
    _write_text(os.path.join(landing, "p2.csv"), COUPON_BUSINESS + "2.00,2024-01-03,c1,1,a,01,9,x,s,d,t\n", "utf-8")
    out = os.path.join(scratch_dir, "coupon_fact")
    q = ingest_extracts(spark, landing, "coupon", out, checkpoint=os.path.join(scratch_dir, "ck"))
    q.awaitTermination()
    assert _coupons(spark.read.parquet(out)) == WANT
    comp = [(str(r.biz_date), r.n_rows, r.is_missing) for r in completeness(spark, out).collect()]
    assert comp == [("2024-01-01", 1, False), ("2024-01-02", 0, True), ("2024-01-03", 1, False)]
    # a restart takes only new files
    _write_text(os.path.join(landing, "p3.csv"), COUPON + "c1,1,a,01,9,x,s,d,t,2024-01-02,3.00\n", "utf-8")
    q = ingest_extracts(spark, landing, "coupon", out, checkpoint=os.path.join(scratch_dir, "ck"))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_streaming_ingest_of_an_undated_table(spark, scratch_dir):
    landing, out = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "oi_fact")
    _write_text(os.path.join(landing, "oi.csv"), "金额,供应商编码,大类编码,门店编码,扣项类型\n7.5,s1,c1,1,返利\n", "utf-8")
    ingest_extracts(spark, landing, "oi", out, checkpoint=os.path.join(scratch_dir, "ck")).awaitTermination()
    r = spark.read.parquet(out).first()
    assert (r.supplier_id, r.category_id, r.store_id, r.deduction_type, float(r.oi_amount)) == ("s1", "c1", "1", "返利", 7.5)


def test_folder_of_extracts_with_other_column_orders(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "coupons")
    _write_text(os.path.join(folder, "a.csv"), COUPON + "c1,1,a,01,9,x,s,d,t,2024-01-01,1.25\n", "utf-8")
    _write_text(os.path.join(folder, "b.csv"), COUPON_BUSINESS + "2.00,2024-01-03,c1,1,a,01,9,x,s,d,t\n", "utf-8")
    assert _coupons(read_extract(spark, folder, "coupon")) == WANT


def test_rows_before_the_header(spark, scratch_dir):
    path = os.path.join(scratch_dir, "titled.csv")
    _write_text(path, "coupon report\n2024-01\n" + COUPON + '"c1",1,a,01,9,x,s,d,t,2024-01-01,1.25\n'
                + "c1,1,a,01,9,x,s,d,t,2024-01-03,2.00\n", "utf-8")
    assert _coupons(read_extract(spark, path, "coupon", skip_rows=2)) == WANT


def test_money_is_exact_and_rejects_are_counted(spark, scratch_dir):
    from decimal import Decimal

    path = os.path.join(scratch_dir, "oi.csv")
    _write_text(path, '供应商编码,大类编码,金额\ns1,c1,12345678901234.5678\ns2,c1,"1,234.50"\ns3,c1,nan\ns4,c1,\n', "utf-8")
    got = {r.supplier_id: r.oi_amount for r in read_extract(spark, path, "oi").collect()}
    assert got == {"s1": Decimal("12345678901234.5678"), "s2": None, "s3": None, "s4": None}
    report = {r.column: (r.rejected, r.rows) for r in reject_report(read_raw(spark, path), "oi").collect()}
    assert report == {"oi_amount": (1, 4)}


def test_utf8_sink_round_trip(spark, scratch_dir):
    df = spark.createDataFrame([("001", "苹果", 1.5)], "sku_id string, sku_name string, net_sales double")
    out = os.path.join(scratch_dir, "out_utf8")
    write_csv(df, out)
    back = read_extract(spark, out, "sales").collect()[0]
    assert back.sku_id == "001" and back.sku_name == "苹果" and float(back.net_sales) == 1.5


def test_other_periods_of_a_report_stay(spark, scratch_dir):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    for period, factor in (("2024-01", 1), ("2024-02", 2), ("2024-02", 3)):
        paths = publish_reports({"margin": df.withColumn("v", df.v * factor)}, scratch_dir, "c1", period)
    got = {r.period: r.v for r in spark.read.parquet(paths["margin"]).collect()}
    assert got == {"2024-01": 1.0, "2024-02": 3.0}


def test_loader_bundle_runs_a_report_and_publishes_it(spark, scratch_dir):
    from profitlens.plans.margin import chain_margin

    sales, coupons = os.path.join(scratch_dir, "sales"), os.path.join(scratch_dir, "coupons")
    _write_text(os.path.join(sales, "1.csv"), "大类编码,渠道,商品编码,销售净额,毛利额\nc1,a,01,10.5,2\nc1,a,02,1,1\n", "gbk")
    _write_text(os.path.join(sales, "2.csv"), "毛利额,销售净额,商品编码,渠道,大类编码\n3,20,01,a,c1\n", "gbk")
    _write_text(os.path.join(coupons, "1.csv"), "大类编码,渠道,商品编码,万家承担金额\nc1,a,01,0.5\nc1,a,03,9\n", "utf-8")
    facts = load_extracts(spark, {"sales": sales, "coupon": coupons}, encodings={"sales": "GBK"})
    report = chain_margin(facts.sales, facts.coupon)
    got = {r.sku_id: (float(r.net_sales), float(r.gross_margin), float(r.coupon_cost)) for r in report.collect()}
    assert got == {"01": (30.5, 5.0, 0.5), "02": (1.0, 1.0, 0.0)}
    assert facts.stock.count() == 0
    assert publish_tables({"margin": report}, "pl_test_") == ["pl_test_margin"]
    assert spark.table("pl_test_margin").count() == 2
    stage_extracts(facts, prefix="pl_test_stage_")
    assert spark.table("pl_test_stage_coupon").count() == 2


def test_sql_source_and_partition_pruning(spark, scratch_dir):
    import contextlib
    import io

    from profitlens.sources.files import read_query
    df = spark.createDataFrame([("c1", "2024-01", 1.0), ("c2", "2024-01", 2.0), ("c1", "2024-02", 4.0)],
                               "company string, period string, v double")
    p = write_report(df, scratch_dir, "facts", partition_by=("company", "period"))
    spark.read.parquet(p).createOrReplaceTempView("pl_facts")
    q = read_query(spark, "SELECT period, sum(v) AS v FROM pl_facts WHERE company = 'c1' GROUP BY period")
    assert {r.period: r.v for r in q.collect()} == {"2024-01": 1.0, "2024-02": 4.0}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(company" in buf.getvalue()  # only c1 folders are listed
