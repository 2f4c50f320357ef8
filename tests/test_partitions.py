from __future__ import annotations

import datetime
import time
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from tablelift.operators.partitions import (
    DEFAULT,
    MAXVALUE,
    CompositePartitions,
    HashPartitions,
    IntervalPartitions,
    ListPartitions,
    RangePartitions,
    assign,
    assign_by_reference,
    with_chunk,
)


def names(df, method):
    rows = with_chunk(df, method).select("v", "chunk").collect()
    return {r.v: r.chunk for r in rows}


def test_range_bounds_are_exclusive_and_null_goes_last(spark):
    df = spark.createDataFrame([(1,), (10,), (19,), (20,), (99,), (None,)], "v int")
    method = RangePartitions("v", [("A", 10), ("B", 20), ("M", MAXVALUE)])
    assert names(df, method) == {
        1: "partition-00001-A", 10: "partition-00002-B", 19: "partition-00002-B",
        20: "partition-00003-M", 99: "partition-00003-M", None: "partition-00003-M",
    }


def test_range_without_maxvalue_leaves_rows_out(spark):
    df = spark.createDataFrame([(1,), (20,), (None,)], "v int")
    method = RangePartitions("v", [("A", 10), ("B", 20)])
    assert names(df, method) == {1: "partition-00001-A", 20: None, None: None}


def test_many_bounds_against_bisect(spark):
    bounds = list(range(0, 3000, 7))
    parts = [(f"P{i}", b) for i, b in enumerate(bounds)] + [("PMAX", MAXVALUE)]
    method = RangePartitions("v", parts)
    df = spark.range(-20, 3100).select(F.col("id").cast("int").alias("v"))
    df = df.union(spark.sql("SELECT cast(null AS int)"))
    for r in assign(df, method).collect():
        at = len(bounds) if r.v is None else bisect_right(bounds, r.v)
        assert (r.partition_position, r.partition_name) == (at + 1, parts[at][0])


def test_list_default_and_null(spark):
    df = spark.createDataFrame([("n",), ("s",), ("x",), (None,)], "v string")
    with_default = ListPartitions("v", [("N", ["n"]), ("S", ["s", None]), ("R", None)])
    assert names(df, with_default) == {
        "n": "partition-00001-N", "s": "partition-00002-S", "x": "partition-00003-R",
        None: "partition-00002-S",
    }
    without = ListPartitions("v", [("N", ["n"]), ("S", ["s"])])
    assert names(df, without)["x"] is None
    assert names(df, without)[None] is None


def test_hash_is_stable_total_and_disjoint(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("v"))
    method = HashPartitions(["v"], ["H1", "H2", "H3", "H4"])
    first, second = names(df, method), names(df.repartition(7), method)
    assert first == second
    assert set(first.values()) == {f"partition-0000{i}-H{i}" for i in range(1, 5)}


def test_interval_months(spark):
    day = datetime.date
    df = spark.createDataFrame(
        [(day(2023, 12, 31),), (day(2024, 1, 1),), (day(2024, 3, 5),), (day(2025, 1, 1),)], "v date"
    )
    method = IntervalPartitions("v", "P_INITIAL", day(2024, 1, 1))
    assert list(names(df, method).values()) == [
        "partition-00001-P_INITIAL", "partition-00002-SYS_P202401", "partition-00004-SYS_P202403",
        "partition-00014-SYS_P202501",
    ]


def test_composite_has_every_pair(spark):
    method = CompositePartitions(
        RangePartitions("v", [("A", 40), ("B", 70), ("M", MAXVALUE)]),
        HashPartitions(["v"], ["H1", "H2", "H3", "H4"], integer_key=True),
    )
    got = names(spark.range(100).select(F.col("id").alias("v")), method)
    assert set(got.values()) == set(method.labels())
    assert len(method.labels()) == 12
    assert got[41] == "subpartition-00002-00002-B-H2"


def test_reference_by_join_and_without(spark):
    parent = spark.createDataFrame([(1, 5), (2, 15)], "pid int, v int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "cid int, fk int")
    method = RangePartitions("v", [("A", 10), ("M", MAXVALUE)])
    joined = assign_by_reference(child, parent, [("fk", "pid")], method)
    assert {r.cid: r.chunk for r in joined.collect()} == {
        10: "partition-00001-A", 11: "partition-00002-M", 12: "partition-00002-M",
    }
    wide = child.withColumn("fv", F.lit(3))
    local = assign_by_reference(wide, parent, [("fk", "pid"), ("fv", "v")], method)
    assert "Join" not in local._jdf.queryExecution().toString()
    assert {r.chunk for r in local.collect()} == {"partition-00001-A"}


def test_bounds_do_not_depend_on_the_zone_of_the_machine(spark, monkeypatch):
    df = spark.sql("SELECT timestamp_ntz'2019-12-31 23:59:59' AS v UNION ALL "
                   "SELECT timestamp_ntz'2020-01-01 00:00:00'")
    bound = datetime.datetime(2020, 1, 1)
    many = [(f"P{i}", datetime.datetime(1900 + i, 1, 1)) for i in range(120)]
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        few = assign(df, RangePartitions("v", [("A", bound), ("M", MAXVALUE)]))
        assert [r.partition_name for r in few.collect()] == ["A", "M"]
        more = assign(df, RangePartitions("v", [*many, ("A", bound), ("M", MAXVALUE)]))
        assert [r.partition_name for r in more.collect()] == ["A", "M"]
        listed = assign(df, ListPartitions("v", [("L", [bound]), ("R", None)]))
        assert [r.partition_name for r in listed.collect()] == ["R", "L"]
    finally:
        monkeypatch.undo()
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_two_thousand_listed_partitions(spark):
    method = ListPartitions("k", [(f"P{i}", [2 * i]) for i in range(2000)] + [("REST", DEFAULT)])
    rows = spark.range(4100).select(F.col("id").alias("k")).select("k", method.name().alias("p"))
    for r in rows.collect():
        assert r["p"] == (f"P{r['k'] // 2}" if r["k"] % 2 == 0 and r["k"] < 4000 else "REST")


def test_intervals_start_on_the_first_of_a_month():
    with pytest.raises(ValueError, match="first of a month"):
        IntervalPartitions("d", "P0", datetime.date(2024, 7, 15))


def test_lists_of_many_values_are_looked_up(spark):
    """As the comparison value by value, without a case per list; NULL, values named twice and no default too."""

    from tablelift.operators import partitions as p

    lists = [(f"L{i}", [i, i + 3000]) for i in range(2000)] + [("N", [None, 7])]
    df = spark.range(0, 8000, 1, 3).select(F.when(F.col("id") != 11, F.col("id").cast("int")).alias("v"), (F.col("id") % 90).alias("w"), F.lit("old").alias("chunk"))
    for parts in (lists, [*lists, ("REST", None)]):
        made = with_chunk(df.drop("chunk"), ListPartitions("v", parts))
        assert made.columns == ["v", "w", "chunk"]
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("CASE") <= 1
        rest = "partition-02002-REST" if len(parts) > 2001 else None
        where = {v: f"partition-{i + 1:05d}-{n}" for i, (n, values) in enumerate(parts) if values is not None for v in values}
        got = made.collect()
        assert len(got) == 8000 and all(r["chunk"] == where.get(r["v"], rest) for r in got)
    days = [datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i) for i in range(100)]
    stamps = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    named = p.assign(stamps, ListPartitions("d", [(f"D{i}", [d]) for i, d in enumerate(days)]))
    assert [(r["partition_position"], r["partition_name"]) for r in named.orderBy("d").collect()] == [(i + 1, f"D{i}") for i in range(100)]
    both = p.CompositePartitions(ListPartitions("w", [("A", range(70)), ("B", None)]), HashPartitions(["v"], ["H1", "H2"], integer_key=True))
    for r in with_chunk(df, both).where("v < 400").collect():
        first = (1, "A") if r["w"] < 70 else (2, "B")
        assert r["chunk"] == f"subpartition-0000{first[0]}-0000{1 + r['v'] % 2}-{first[1]}-H{1 + r['v'] % 2}"
