import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardamom import operators as op
from cardamom.session import _MADE


def test_semi_and_anti(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(op.keep_matching(left, right, "k"), "v") == [("a",), ("b",)]
    assert rows(op.keep_unmatched(left, right, "k"), "v") == [("c",), ("d",)]


def test_left_with_default(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5)], "k int, n int")
    assert rows(op.left_with_default(left, right, "k", {"n": 0})) == [(1, 5), (2, 0)]


def test_lookup_policies(spark, rows):
    table = op.lookup_table(spark, [(0, "low", 1.5), (1, None, 2.5)], "code int, label string, f double")
    good = spark.createDataFrame([(1, 0), (2, 1)], "id int, code int")
    bad = good.unionAll(spark.createDataFrame([(3, 9)], "id int, code int"))
    assert rows(op.lookup(good, table, "code"), "id", "label", "f") == [(1, "low", 1.5), (2, None, 2.5)]
    with pytest.raises(Exception, match="no entry in lookup for code = 9"):
        op.lookup(bad, table, "code").collect()
    filled = op.lookup(bad, table, "code", on_missing="default", defaults={"f": 0.0})
    assert rows(filled, "id", "f") == [(1, 1.5), (2, 2.5), (3, 0.0)]
    assert rows(op.lookup(bad, table, "code", on_missing="reject"), "id") == [(1,), (2,)]
    assert rows(op.keep_unmatched(bad, table, "code"), "id") == [(3,)]
    with pytest.raises(ValueError, match="on_missing"):
        op.lookup(good, table, "code", on_missing="skip")


def test_lookup_stops_whatever_is_read(spark):
    table = op.lookup_table(spark, [(i, i) for i in range(3000)], "code int, f int")
    bad = spark.createDataFrame([(1, 1), (2, 9999)], "id int, code int")
    for read in (lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="no entry in lookup for code = 9999"):
            read(op.lookup(bad, table, "code"))


def test_defaults_leave_matched_nulls(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "code int")
    right = spark.createDataFrame([(1, None)], "code int, n int")
    assert rows(op.left_with_default(left, right, "code", {"n": 0})) == [(1, None), (2, 0)]


def test_many_new_rows_are_one_relation(spark):
    table = spark.createDataFrame([(1, 1.5, True)], "id int, lat float, declined boolean")
    added = op.insert_rows(table, [{"id": i, "declined": i % 2 == 0} for i in range(50)])
    assert added.count() == 51 and added.filter("declined").count() == 26
    assert added._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2


def test_first_n_per_key_with_ties(spark, rows):
    data = [("a", 1, 10), ("a", 1, 11), ("a", 2, 12), ("a", 2, 13), ("b", 5, 14)]
    frame = spark.createDataFrame(data, "k string, t int, id int")
    newest = op.first_n_per_key(frame, ["k"], [F.col("t").desc(), F.col("id").desc()], 3)
    assert rows(newest, "k", "id", "rn") == [("a", 11, 3), ("a", 12, 2), ("a", 13, 1), ("b", 14, 1)]


def test_previous_and_running(spark, rows):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 5)]
    frame = spark.createDataFrame(list(zip(days, [1, 2, 3])), "day date, x int")
    got = rows(op.previous_value(frame, "day", "x", "before"), "day", "before")
    assert got == [(days[0], None), (days[1], 1), (days[2], 2)]
    got = rows(op.running_total(frame, [F.year("day")], "day", "x", "ytd"), "day", "ytd")
    assert got == [(days[0], 1), (days[1], 2), (days[2], 5)]


def test_top_and_nth(spark):
    frame = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, g int")
    order = [F.col("g").desc(), F.col("id")]
    assert [r["id"] for r in op.top_k(frame, order, 4).collect()] == [2, 5, 8, 1]
    assert op.top_row(frame, order).first()["id"] == 2
    assert [r["id"] for r in op.nth_row(frame, order, 4).collect()] == [1]
    assert op.nth_row(frame, order, 0).count() == 0
    assert op.nth_row(frame, order, 11).count() == 0
    assert op.last_value_row(frame, "id").first()["id"] == 9
    assert op.preview(frame, 3).count() == 3
    assert op.preview(frame, 50).count() == 10


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_numbering_matches_a_plain_sort(spark, n):
    rnd = random.Random(n)
    data = [(i, rnd.choice([0, 0, 0, 1, 2])) for i in range(n)]
    frame = spark.createDataFrame(data, "id int, score int").repartition(7)
    numbered = op.number_rows(frame, [F.col("score").desc(), F.col("id")], key="id")
    got = {r["id"]: r["position"] for r in numbered.collect()}
    want = sorted(data, key=lambda r: (-r[1], r[0]))
    assert got == {row[0]: i for i, row in enumerate(want, start=1)}


def test_numbering_spreads_one_hot_value(spark):
    """All rows share the leading sort value; the unique key still splits them.  No job runs and nothing is written first."""
    frame = spark.range(20000).withColumn("hot", F.lit(1)).withColumn("payload", F.col("id") * 2).repartition(8)
    sc, made = spark.sparkContext, len(_MADE)
    sc.setJobGroup("plan", "plan")
    numbered = op.number_rows(frame, [F.col("hot"), F.col("id")], key="id")
    assert not sc.statusTracker().getJobIdsForGroup("plan") and len(_MADE) == made
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert numbered.filter((F.col("position") != F.col("id") + 1) | (F.col("payload") != F.col("id") * 2)).count() == 0
    assert numbered.count() == 20000
    numbered.collect()
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") >= 1 and "ReusedExchange" in plan
    final = plan.split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "Exchange rangepartitioning" in line and "Reused" not in line]
    assert len(dealt) == 1 and "payload" not in dealt[0]


def test_numbering_never_deals_ranges_twice(spark):
    frame = spark.range(5000).withColumn("score", F.hash("id") % 50).repartition(6)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        numbered = op.number_rows(frame, [F.col("score").desc(), F.col("id")], key="id")
        try:
            got = numbered.select("id", "position").collect()
        except Exception as e:
            assert "dealt twice" in str(e)
        else:
            assert sorted(r["position"] for r in got) == list(range(1, 5001))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_literal_lookups_do_not_shuffle_the_table(spark, rows):
    table = op.lookup_table(spark, [(1, "low", 1.5), (2, None, 2)], "code int, label string, f double")
    assert rows(table) == [(1, "low", 1.5), (2, None, 2.0)] and table.schema.simpleString() == "struct<code:int,label:string,f:double>"
    assert op.lookup_table(spark, [], "code int").count() == 0
    facts = spark.range(1000).withColumn("code", (F.col("id") % 2 + 1).cast("int"))
    plan = op.lookup(facts, table, "code")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "LocalTableScan" in plan


def test_union_keeps_repeats(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    got = rows(op.tagged_union({"A": a, "B": b}, "src"), "id", "v", "src")
    assert got == [(1, "x", "A"), (1, "x", "A"), (2, "y", "B")]


def test_chunk_records(spark, rows):
    flat = spark.createDataFrame([(i, c) for i, c in enumerate("abcdefgh")], "pos int, value string")
    got = rows(op.chunk_records(flat, ["p", "q", "r"]), "seq", "p", "q", "r")
    assert got == [(0, "a", "b", "c"), (1, "d", "e", "f"), (2, "g", "h", None)]


def test_key_reports(spark, rows):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(op.duplicate_keys(frame, ["a", "b"])) == [(1, 1, 2)]
    assert op.missing_keys(frame, ["a", "b"]).count() == 2
    assert tuple(op.key_counts(frame, ["a", "b"]).first()) == (1, 2)
    parent = spark.createDataFrame([(1,)], "id int")
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    assert rows(op.orphans(child, "fk", parent, "id")) == [(2, 2)]
    checks = op.row_count_check({"child": child, "parent": parent}, {"child": 3, "parent": 1})
    assert rows(checks) == [("child", 4, 3, False), ("parent", 1, 1, True)]


def test_first_broken_rule_wins(spark, rows):
    frame = spark.createDataFrame([(1, "ok", 5), (2, "", -1), (3, None, 5), (4, "it's", 11)], "id int, t string, n int")
    rules = [
        op.Rule("t", "t <> ''", "it's empty"),
        op.Rule("n", "n >= 0", "negative"),
        op.Rule("n", "n <= 10", r"back\slash"),
    ]
    good, bad = op.split_valid(frame, rules)
    assert rows(good, "id") == [(1,)]
    assert rows(bad.select("id", "error.*")) == [
        (2, "t", "", "it's empty"),
        (3, "t", None, "it's empty"),
        (4, "n", "11", r"back\slash"),
    ]


CARDS = [("c1", "old"), ("c1", None), ("c2", "old"), (None, "old")]


def test_guarded_update(spark, rows):
    cards = spark.createDataFrame(CARDS, "id string, iban string")
    both = (F.col("id") == "c1") & (F.col("iban") == "old")
    got = rows(op.set_where(cards, both, {"iban": "new"}))
    assert got == sorted([("c1", "new"), ("c1", None), ("c2", "old"), (None, "old")], key=repr)


def test_delete_keeps_null_keys(spark, rows):
    cards = spark.createDataFrame(CARDS, "id string, iban string")
    assert rows(op.delete_where(cards, F.col("id") == "c1"), "id") == sorted([("c2",), (None,)], key=repr)


def test_insert_casts_and_fills(spark, rows):
    table = spark.createDataFrame([(1, 1.5, True, "x")], "id int, lat float, declined boolean, note string")
    added = op.insert_rows(table, [{"id": "9999", "lat": "829.5", "declined": "0"}])
    assert added.schema == table.schema
    assert rows(added) == [(1, 1.5, True, "x"), (9999, 829.5, False, None)]
    with pytest.raises(ValueError, match="no such column"):
        op.insert_rows(table, [{"di": 1}])


def test_column_changes(spark):
    table = spark.createDataFrame([("1", "a")], "id string, pan string")
    assert op.retype(table, {"id": "int"}).schema["id"].dataType.simpleString() == "int"
    assert op.drop_columns(table, "pan").columns == ["id"]
    with pytest.raises(ValueError, match="no such column"):
        op.drop_columns(table, "pin")
    assert op.create_empty(spark, table.schema).count() == 0
