"""Facts stored by their report keys: the same sums as ``combine``, without a shuffle of lines."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from profitlens.operators.rollup import combine
from profitlens.sources import layout
from profitlens.sources.layout import combine_stored, read_stored, store_by_keys
from profitlens.sources.versions import manifest

SALES = "cat string, store string, sku int, net decimal(18,4), cost decimal(18,4)"
COUPON = "cat string, store string, sku int, coupon decimal(18,4), note string"
KEYS = ("cat", "store")
MEASURES = {"sales": ["net", "cost"], "coupon": ["coupon"]}


def _facts(spark, seed=1, n=3000):
    r = random.Random(seed)

    def key():  # a third of the rows has one key, some lack one
        if r.random() < 1 / 3:
            return "hot", "s1", r.randint(0, 5)
        return r.choice([*"abcdefgh", None]), r.choice(["s1", "s2", "s3", None]), r.choice([None, 1, 2, 3])

    money = lambda: None if r.random() < .1 else Decimal(r.randint(-10**8, 10**8)) / 10000
    sales = [(*key(), money(), money()) for _ in range(n)]
    coupon = [(*key(), money(), "x") for _ in range(n // 3)] + [("only coupon", "s9", 1, Decimal(7), None)] * 2
    return {"sales": spark.createDataFrame(sales, SALES), "coupon": spark.createDataFrame(coupon, COUPON)}


def _rows(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def _exchanges(df):
    """The plan and the number of its hash exchanges."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, plan.count("Exchange hashpartitioning")


@pytest.mark.parametrize("keys", [("cat", "store"), ("cat", "store", "sku"), ("cat",), ("store", "sku")])
@pytest.mark.parametrize("keep", ["any", "sales"])
def test_same_rows_as_combine(spark, scratch_dir, keys, keep):
    facts = _facts(spark)
    store_by_keys(facts, KEYS, scratch_dir, "f", buckets=6)
    got = combine_stored(spark, scratch_dir, "f", keys, MEASURES, keep)
    want = combine(facts, keys, MEASURES, keep)
    assert _rows(got) == _rows(want)
    assert [(f.name, f.dataType.typeName()) for f in got.schema] == [(f.name, f.dataType.typeName()) for f in want.schema]


def test_lines_of_ordinary_keys_are_not_shuffled(spark, scratch_dir):
    facts = _facts(spark)
    store_by_keys(facts, KEYS, scratch_dir, "f", buckets=6)
    for keys in (KEYS, (*KEYS, "sku")):
        # one exchange, of the partial sums of dealt keys; combine sends its lines through one
        plan, n = _exchanges(combine_stored(spark, scratch_dir, "f", keys, MEASURES))
        assert n == 1 and "Bucketed: true" in plan
        dealt_part = plan[plan.index("Exchange hashpartitioning"):]
        # the branch below the exchange starts from sums that are finished within the scan's tasks
        assert dealt_part.count("HashAggregate") >= 3 and "_dealt" in dealt_part
        assert "_dealt" in plan[:plan.index("Exchange hashpartitioning")]


def test_hot_key_lies_in_several_buckets(spark, scratch_dir):
    store_by_keys(_facts(spark, n=6000), KEYS, scratch_dir, "f", buckets=24)
    part = manifest(spark, scratch_dir)["tables"]["f"][0]
    table = layout._registered(spark, f"{scratch_dir}/{part['folder']}", part["layout"])
    by_file = (table.where("cat = 'hot'").groupBy(F.input_file_name()).count().select("count")
               .toPandas()["count"])
    assert len(by_file) >= 8 and by_file.max() < 0.35 * by_file.sum()
    assert table.where("cat = 'a' AND store = 's1' AND _fact = 'sales'").select(F.input_file_name()).distinct().count() == 1


def test_lines_come_back_whole(spark, scratch_dir):
    facts = _facts(spark)
    store_by_keys(facts, KEYS, scratch_dir, "f", buckets=6)
    for tag, df in facts.items():
        assert _rows(read_stored(spark, scratch_dir, "f", tag).select(*df.columns)) == _rows(df)


def test_late_extract_replaces_its_period(spark, scratch_dir):
    one, two, late = (_facts(spark, seed) for seed in (1, 2, 3))
    store_by_keys(one, KEYS, scratch_dir, "f", 6, {"period": "1"})
    store_by_keys(two, KEYS, scratch_dir, "f", 4, {"period": "2"})
    first = manifest(spark, scratch_dir)["tables"]["f"]
    store_by_keys(late, KEYS, scratch_dir, "f", 6, {"period": "2"})
    now = manifest(spark, scratch_dir)["tables"]["f"]
    assert first[0] in now and first[1] not in now and len(now) == 2
    both = {tag: one[tag].unionByName(late[tag]) for tag in one}
    assert _rows(combine_stored(spark, scratch_dir, "f", KEYS, MEASURES)) == _rows(combine(both, KEYS, MEASURES))


def test_a_write_that_dies_leaves_the_old_store(spark, scratch_dir):
    facts = _facts(spark)
    store_by_keys(facts, KEYS, scratch_dir, "f", 6)
    want = _rows(combine_stored(spark, scratch_dir, "f", KEYS, MEASURES))
    bad = {**facts, "sales": facts["sales"].withColumn("net", F.raise_error(F.lit("gone")).cast("decimal(18,4)"))}
    with pytest.raises(Exception, match="gone"):
        store_by_keys(bad, KEYS, scratch_dir, "f", 6)
    assert _rows(combine_stored(spark, scratch_dir, "f", KEYS, MEASURES)) == want


def test_another_session_reads_the_buckets(spark, scratch_dir):
    store_by_keys(_facts(spark), KEYS, scratch_dir, "f", buckets=6)
    want = _rows(combine_stored(spark, scratch_dir, "f", KEYS, MEASURES))
    for t in spark.catalog.listTables():
        if t.name.startswith("profitlens_layout_"):
            spark.sql(f"DROP TABLE {t.name}")
    again = combine_stored(spark, scratch_dir, "f", KEYS, MEASURES)
    assert _rows(again) == want and "Bucketed: true" in _exchanges(again)[0]


def test_empty_facts_and_names(spark, scratch_dir):
    facts = {tag: df.limit(0) for tag, df in _facts(spark).items()}
    store_by_keys(facts, KEYS, scratch_dir, "f", 3)
    assert combine_stored(spark, scratch_dir, "f", KEYS, MEASURES).collect() == []
    assert combine_stored(spark, scratch_dir, "f", KEYS, {"sales": ["net"]}).columns == ["cat", "store", "net"]
    with pytest.raises(ValueError, match="_part"):
        store_by_keys({"sales": facts["sales"].withColumn("_part", F.lit(1))}, KEYS, scratch_dir, "g")
    with pytest.raises(ValueError, match="another type"):
        store_by_keys({**facts, "coupon": facts["coupon"].withColumn("sku", F.lit("1"))}, KEYS, scratch_dir, "g")
    with pytest.raises(ValueError, match="not stored"):
        combine_stored(spark, scratch_dir, "missing", KEYS, MEASURES)
    with pytest.raises(ValueError, match="unique"):
        combine_stored(spark, scratch_dir, "f", KEYS, {"sales": ["net"], "coupon": ["net"]})
