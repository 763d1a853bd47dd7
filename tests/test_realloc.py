"""A stored waterfall after late extracts equals the waterfall over all rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from profitlens.operators.allocate import Level, waterfall
from profitlens.operators.realloc import StoredWaterfall, read_waterfall, update_waterfall
from profitlens.sources.versions import manifest

LINES = "sup string, cat string, store string, sku string, w decimal(18,4)"
POOL = "sup string, cat string, store string, amt decimal(18,4)"
LEVELS = (Level(("sup", "cat", "store"), ("sku",)), Level(("cat",), ("sku",)))


def _rows(seed, n, cats):
    r = random.Random(seed)
    pick = lambda: (f"s{r.randint(0, 3)}", r.choice(cats), f"t{r.randint(0, 2)}")
    money = lambda: Decimal(r.randint(-2000, 90000)) / 100
    lines = [(*pick(), f"k{r.randint(0, 5)}", money()) for _ in range(n)]
    pools = [(*pick(), money()) for _ in range(n // 3)]
    # a supplier and a category without lines, a pool without a key
    pools += [("none", cats[0], "t0", money()), ("s0", "nolines", "t0", money()), (None, cats[0], "t1", money())]
    return lines, pools


def _set(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _check(spark, stored, lines, pools, scope):
    a, u = read_waterfall(spark, stored, scope)
    wa, wu = waterfall(spark.createDataFrame(lines, LINES), spark.createDataFrame(pools, POOL), LEVELS, "w", "amt", scope=scope)
    assert a.columns == wa.columns
    assert _set(a) == _set(wa.select(a.columns))
    assert _set(u.select(wu.columns)) == _set(wu)
    return a


def test_equals_the_full_waterfall(spark, scratch_dir):
    cats = ["c0", "c1", "c2", "c3", "c4", "off"]
    scope = spark.createDataFrame([(c,) for c in cats if c != "off"], "cat string")
    stored = StoredWaterfall(scratch_dir, "oi", LEVELS, "w", "amt", buckets=32)
    lines, pools = _rows(1, 60, cats)
    update_waterfall(stored, spark.createDataFrame(lines, LINES), spark.createDataFrame(pools, POOL), scope)
    _check(spark, stored, lines, pools, scope)
    before = manifest(spark, scratch_dir)["tables"]
    late_l, late_p = _rows(2, 8, ["c1"])
    late_p = [p for p in late_p if p[1] != "nolines"]
    hit = update_waterfall(stored, spark.createDataFrame(late_l, LINES), spark.createDataFrame(late_p, POOL), scope)
    assert len(hit) == 1  # one category, one bucket
    after = manifest(spark, scratch_dir)["tables"]
    for t, parts in before.items():  # the parts of all other buckets are still the same files
        assert [p for p in parts if p["partition"]["bucket"] != str(hit[0])] == \
            [p for p in after[t] if p["partition"]["bucket"] != str(hit[0])]
    _check(spark, stored, lines + late_l, pools + late_p, scope)


def test_residuals_come_and_go(spark, scratch_dir):
    """Late lines for a pool that went to the second level take it back; a correction sends it down again."""
    stored = StoredWaterfall(scratch_dir, "oi", LEVELS, "w", "amt", buckets=4)
    lines = [("s1", "c", "t", "k1", Decimal(10)), ("s1", "c", "t", "k2", Decimal(30))]
    pools = [("s9", "c", "t", Decimal(12)), ("s1", "c", "t", Decimal(40)), ("s9", "d", "t", Decimal(7))]
    none_l, none_p = spark.createDataFrame([], LINES), spark.createDataFrame([], POOL)
    update_waterfall(stored, spark.createDataFrame(lines, LINES), spark.createDataFrame(pools, POOL))
    a = _check(spark, stored, lines, pools, None)
    assert a.where("alloc_level = 2").agg(F.sum("alloc_amount")).first()[0] == 12
    for late in ([("s9", "c", "t", "k3", Decimal(5))], [("s9", "c", "t", "k3", Decimal(-5))]):
        lines = lines + late
        update_waterfall(stored, spark.createDataFrame(late, LINES), none_p)
        a = _check(spark, stored, lines, pools, None)
    more = [("s9", "d", "t", Decimal(-7)), ("s2", "d", "t", None)]
    update_waterfall(stored, none_l, spark.createDataFrame(more, POOL))
    _check(spark, stored, lines, pools + more, None)
    assert update_waterfall(stored, none_l, none_p) == []


def test_levels_must_share_a_key(spark, scratch_dir):
    with pytest.raises(ValueError):
        StoredWaterfall(scratch_dir, "x", (Level(("sup",)), Level(("cat",))), "w", "amt")
    with pytest.raises(ValueError):
        read_waterfall(spark, StoredWaterfall(scratch_dir, "x", LEVELS, "w", "amt"))
