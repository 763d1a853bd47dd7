"""Reports are made once, and what they stage or shuffle carries no column that nothing later needs."""

import tempfile

from pyspark.sql import functions as F

from profitlens.operators import dims, realloc
from profitlens.operators.allocate import Level
from profitlens.operators.dims import enrich
from profitlens.plans import margin, stock as stock_plans
from profitlens.session import _STAGED, SHUFFLE_CLEANUP, release_materialized, stage
from profitlens.sources.testdata import line_base

JOIN_KEYS = {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey", "p_partkey", "s_suppkey"}


def _tables(spark):
    root = tempfile.mkdtemp(prefix="profitlens-case-")
    rows = {
        "lineitem": (spark.range(24).select(
            F.when(F.col("id") != 23, F.col("id") % 7).alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"),
            (F.col("id") % 4).alias("l_suppkey"), F.col("id").cast("int").alias("l_linenumber"),
            *[F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
            F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit("1995-01-01").alias("l_shipdate"))),
        # order 1 twice, order 2 without a customer, order 6 of an unknown one
        "orders": spark.createDataFrame([(0, 10), (1, 11), (1, 12), (2, None), (3, 10), (4, 11), (6, 99)],
                                        "o_orderkey long, o_custkey long").withColumn("o_orderpriority", F.lit("1")),
        "customer": spark.createDataFrame([(10, 1, "A"), (11, 2, "B"), (12, 3, "A"), (12, 4, "B"), (None, 5, "C")],
                                          "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": spark.createDataFrame([(k, f"p{k}", "Brand#11", 1.0, 1) for k in (0, 1, 2, 3, 3, None)],
                                      "p_partkey long, p_name string, p_brand string, p_retailprice double, p_size int"),
        "supplier": spark.createDataFrame([(0, "s0"), (1, "s1"), (1, "s1b"), (None, "none")], "s_suppkey long, s_name string"),
    }
    for name, df in rows.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_lines_drop_the_keys_of_their_joins(spark):
    root = _tables(spark)
    t = {n: spark.read.parquet(f"{root}/{n}.parquet") for n in ("lineitem", "orders", "customer", "part", "supplier")}
    want = (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
            .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    got = line_base(spark, root)
    assert not JOIN_KEYS & set(got.columns)
    assert set(got.columns) == set(want.columns) - JOIN_KEYS
    rows = sorted(map(str, want.select(*got.columns).collect()))
    assert rows and sorted(map(str, got.collect())) == rows


def test_an_enriched_report_is_made_once(spark):
    path = tempfile.mkdtemp(prefix="profitlens-case-") + "/rows"
    spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).write.parquet(path)
    report = spark.read.parquet(path).groupBy("k").agg(F.sum("v").alias("v"))
    names = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    got = enrich(report, names, "k")
    assert not [f for f in got.inputFiles() if path in f]  # neither its hot keys nor its rows are computed from the lines
    want = report.join(names, "k", "left").collect()
    assert sorted(map(str, got.collect())) == sorted(map(str, want))


def test_derived_measures_are_taken_after_the_names(spark, monkeypatch):
    keyed = spark.createDataFrame([("c1", "s1", "x", "k1", 100, 30, 5), ("c1", "s2", "x", "k2", 0, 0, 0), ("c2", "s1", "y", "k1", 7, 7, 0)],
                                  "category_id string, store_id string, channel string, sku_id string, net_sales int, "
                                  "gross_margin int, coupon_cost int")
    m = margin.with_margin_measures(keyed.select(*margin.SKU_KEYS, *[F.col(c).cast("decimal(28,4)").alias(c) for c in keyed.columns[4:]]))
    masters = [(spark.createDataFrame([("c1", "one")], "category_id string, category_name string"), "category_id"),
               (spark.createDataFrame([("k1", "sku one")], "sku_id string, sku_name string"), "sku_id")]
    want = m
    for dim, on in masters:
        want = want.join(dim, on, "left")
    staged, keep = [], dims.materialize
    monkeypatch.setattr(dims, "materialize", lambda df, **kw: staged.append(df.columns) or keep(df, **kw))
    got = margin._enriched_margin(m, masters)
    assert len(staged) == 1 and not set(margin.DERIVED) & set(staged[0])
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_touched_lines_are_staged_for_their_branches(spark, monkeypatch):
    levels = (Level(("sup", "cat"), ("sku",)), Level(("cat",), ("sku",)))
    stored = realloc.StoredWaterfall(tempfile.mkdtemp(prefix="profitlens-case-"), "w", levels, "w", "amt", buckets=4)
    lines = spark.createDataFrame([("s1", "c1", "k1", 3), ("s1", "c1", "k2", 1), ("s2", "c2", "k1", 5)],
                                  "sup string, cat string, sku string, w int").withColumn("w", F.col("w").cast("decimal(18,4)"))
    pool = spark.createDataFrame([("s1", "c1", 8), ("s9", "c2", 4)], "sup string, cat string, amt int").withColumn(
        "amt", F.col("amt").cast("decimal(18,4)"))
    made, keep = [], realloc.materialize
    monkeypatch.setattr(realloc, "materialize", lambda df, **kw: made.append(set(df.columns)) or keep(df, **kw))
    realloc.update_waterfall(stored, lines, pool)
    assert made.count(set(lines.columns)) == 3  # the late lines, all lines, those of touched groups
    got = {(r.sup, r.cat, r.sku): float(r.alloc_amount) for r in realloc.read_waterfall(spark, stored)[0].collect()}
    assert got[("s1", "c1", "k1")] == 6.0 and got[("s1", "c1", "k2")] == 2.0 and sum(got.values()) == 12.0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _facts(spark):
    codes = "category_id string, store_id string, channel string, sku_id string, "
    sold = [("c1", "s1", "x", "k1", "p1", 10), ("c1", "s1", "x", "k1", "p1", 6), ("c1", "s1", "y", "k1", "p2", 4),
            ("c1", "s2", "x", "k2", "p1", 0), ("c1", "s1", None, "k1", "p1", 5), ("c2", "s1", "x", None, "p1", 3),
            ("c2", "s2", "y", "k3", None, 8), ("c1", "s2", "x", "k2", "p1", None)]
    money = lambda df, c: df.withColumn(c, F.col(c).cast("decimal(18,4)"))
    sales = money(spark.createDataFrame(sold, codes + "supplier_id string, net_sales int"), "net_sales")
    sales = sales.select("*", *[(F.col("net_sales") * n).cast("decimal(18,4)").alias(m)
                                for n, m in enumerate(margin.SALES_MEASURES) if m != "net_sales"])
    coupon = money(spark.createDataFrame([("c1", "s1", "x", "k1", 2), ("c1", "s1", "z", "k1", 9), ("c9", "s1", "x", "k1", 7),
                                          ("c1", "s1", None, "k1", 1), ("c2", "s2", "y", "k3", None)],
                                         codes + "coupon_cost int"), "coupon_cost")
    oi = money(spark.createDataFrame([("p1", "c1", "s1", 12), ("p7", "c1", "s9", 5), ("p7", "c8", "s1", 3), (None, "c1", "s1", 1)],
                                     "supplier_id string, category_id string, store_id string, oi_amount int"), "oi_amount")
    category = spark.createDataFrame([("c1", "1", "one"), ("c2", "2", "two"), ("c8", "9", "x")],
                                     "category_id string, module_id string, category_name string")
    stock = spark.createDataFrame([("c1", "s1", "k1", 2, 3, 4), ("c1", "s1", "k9", 0, 1, 1), (None, "s1", "k1", 1, 1, 1)],
                                  "category_id string, store_id string, sku_id string, own_cost int, stock_qty int, stock_value int")
    for c in ("own_cost", "stock_qty", "stock_value"):
        stock = money(stock, c)
    return sales, coupon, oi.withColumn("deduction_type", F.lit(None).cast("string")), category, stock


def test_allocated_amounts_are_summed_by_the_report_only(spark):
    sales, coupon, oi, category, _ = _facts(spark)
    got = margin.partial_sku_margin(sales, coupon, oi, category)
    on = "Exchange hashpartitioning(category_id#"
    assert sum(on in x and x.count("channel#") == 1 and "sku_id#" in x for x in _plan(got)) == 1
    alloc, _ = margin.oi_store_category(sales, oi, category)
    o = margin.rollup(margin.realloc_to_sku(sales, alloc), margin.SKU_KEYS, ["alloc_share", "alloc_amount"])
    want = margin.sales_coupon_margin(sales, coupon, margin.SKU_KEYS, extra={"oi": (o, ["alloc_share", "alloc_amount"])})
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_turnover_sums_its_measures_once(spark):
    sales, coupon, oi, category, stock = _facts(spark)
    got = stock_plans.store_turnover(sales, coupon, oi, stock, category, ("1", "2"), 31)
    assert not [x for x in _plan(got) if "Aggregate" in x and "channel#" in x and "discount_net" in x]
    m = margin.sku_margin_with_oi(sales, coupon, oi, category, ("1", "2"))
    want = stock_plans._turnover(m, stock, ["store_id", "category_id", "sku_id"], 31)
    assert got.dtypes == want.dtypes and len(want.collect()) > 4
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getPath() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, conf = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    got = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")), "case")
    assert not _shuffle_files(spark) - before and spark.conf.get(SHUFFLE_CLEANUP, None) == conf
    assert got.count() == 7 and got.agg(F.sum("s")).first()[0] == 499500


def test_kept_coupon_cost_is_staged_before_the_turnover(spark):
    sales, coupon, oi, category, stock = _facts(spark)
    got = stock_plans.store_turnover(sales, coupon, oi, stock, category, ("1", "2"), 31)
    assert not [x for x in _plan(got) if "Exchange hashpartitioning" in x and "channel#" in x]


def test_an_enriched_report_reads_no_table_of_its_waterfall(spark):
    sales, coupon, oi, category, _ = _facts(spark)
    sales = sales.withColumn("sku_name", F.concat("sku_id", F.lit("n")))
    coupon = coupon.withColumn("sku_name", F.lit("c"))
    category = category.withColumn("module_name", F.lit("m"))
    store = spark.createDataFrame([("s1", "f", "one")], "store_id string, store_format string, store_name string")
    m = margin.sku_margin_with_oi(sales, coupon, oi, category, ("1", "2"))
    want = m
    for dim, on in ((margin.category_names(category), "category_id"), (margin.store_names(store), "store_id"),
                    (margin.sku_master(sales, coupon), "sku_id")):
        want = want.join(dim, on, "left")
    rows = sorted(map(str, want.collect()))
    release_materialized()
    got = margin.enriched_sku_margin(sales, coupon, oi, category, store, ("1", "2"))
    assert len(_STAGED) == 4  # three masters and the report
    assert "Aggregate" not in "".join(x for x in _plan(got) if "_name#" in x)
    assert got.dtypes == want.dtypes and len(rows) > 4 and sorted(map(str, got.collect())) == rows
