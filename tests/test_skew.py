"""One key holds a third of all rows: results stay whole, shuffles stay small."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cardamom import operators as op
from cardamom.plans import baskets, customers, league, sales

N = 6000
DAY0 = dt.datetime(2024, 1, 1)


def key(i):
    """0 for every third row, else one of 50 keys."""
    return 0 if i % 3 == 0 else 1 + i % 50


DATA = [
    (i, key(i), key(i), key(i), DAY0 + dt.timedelta(minutes=i), float(i % 97), i % 5 == 0, [key(i), i % 7])
    for i in range(N)
]
SCHEMA = (
    "transaction_id int, business_id int, card_id int, user_id int, timestamp timestamp_ntz, "
    "amount double, declined boolean, product_ids array<bigint>"
)


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(DATA, SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def companies(spark):
    rows = [(i, f"co{i}", f"+{i}", f"land{i % 4}") for i in range(60)]
    return spark.createDataFrame(rows, "company_id int, company_name string, phone string, country string")


@pytest.fixture(autouse=True)
def shuffle_joins(spark):
    """Neither side small enough to broadcast, and AQE told to split early."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024b",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_hot_company_volume(tx, companies, rows):
    counts = Counter(r[1] for r in DATA)
    got = {c: n for c, n, _ in rows(sales.volume_band(tx, companies, 400))}
    assert got == {f"co{k}": n for k, n in counts.items()}


def test_hot_company_transactions(tx, companies):
    got = sales.country_transactions(tx, companies, "land0").count()
    assert got == sum(1 for r in DATA if r[1] % 4 == 0 and not r[6])


def test_hot_card_status(tx, rows):
    by_card = defaultdict(list)
    for r in DATA:
        by_card[r[2]].append((r[4], r[0], r[6]))
    want = []
    for card, seen in by_card.items():
        n = sum(flag for _, _, flag in sorted(seen, reverse=True)[:3])
        want.append((card, "inactive" if n == 3 else "active", n))
    assert rows(customers.card_status(tx)) == sorted(want, key=repr)


def test_hot_product_ranking(spark, tx, rows):
    products = spark.createDataFrame([(i, f"p{i}", 1.0, "#0") for i in range(40)], "product_id bigint, name string, price double, colour string")
    counts = Counter(p for r in DATA if not r[6] for p in r[7])
    ranking = baskets.sales_ranking(tx, products)
    assert {p: n for p, n in rows(ranking, "product_id", "total_sold")} == {p: counts[p] for p in range(40)}


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_hot_product_in_the_flat_join(spark, tx, broadcast):
    """The flat join keeps every row and splits the hot product, without any help of the session."""
    products = spark.createDataFrame([(i, f"p{i}", 1.0, "#0") for i in range(40)], "product_id bigint, name string, price double, colour string")
    settings = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": broadcast, "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        flat = baskets.flat_sales(tx, products).withColumn("task", F.spark_partition_id())
        rows = flat.select("transaction_id", "product_sku", "task").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    counts = Counter(p if p < 40 else None for r in DATA for p in r[7])
    assert Counter(r["product_sku"] for r in rows) == counts and max(counts.values()) > len(rows) / 5
    assert Counter(r["transaction_id"] for r in rows) == {i: 2 for i in range(N)}
    # The rows of the hot product, and those without one, are in all tasks in like numbers.
    for sku in (0, None):
        tasks = Counter(r["task"] for r in rows if r["product_sku"] == sku)
        assert len(tasks) >= 4 and max(tasks.values()) < 1.6 * counts[sku] / len(tasks)


def test_hot_and_missing_keys_of_a_left_join(spark, rows):
    left = spark.createDataFrame([(i, None if i % 4 == 1 else "hot" if i % 4 == 2 else "gone" if i % 4 == 3 else f"k{i % 9}") for i in range(2000)], "id int, k string")
    right = spark.createDataFrame([("hot", 1, None), ("k0", None, "a"), ("k4", 4, "b")], "k string, n int, `a.b` string")
    got = op.left_join_unique(left, right, "k")
    assert got.columns == ["id", "k", "n", "a.b"]
    want = {"hot": (1, None), "k0": (None, "a"), "k4": (4, "b")}
    assert rows(got) == sorted(((i, k, *want.get(k, (None, None))) for i, k in rows(left)), key=repr)
    assert op.left_join_unique(left.where("false"), right, "k").isEmpty() and op.left_join_unique(left, right.where("false"), "k").count() == 2000


def test_hot_team(spark, rows):
    matches = [("t0" if i % 3 == 0 else f"t{i % 9}", f"{i % 4}-{i % 3}", "x") for i in range(900)]
    frame = spark.createDataFrame(matches, "home string, result string, away string")
    table = {t: (p, pts) for t, p, pts in rows(league.league_table(frame), "team", "played", "points")}
    played = Counter(h for h, _, _ in matches)
    points = Counter()
    for home, result, _ in matches:
        a, b = map(int, result.split("-"))
        points[home] += 3 if a > b else 1 if a == b else 0
    assert {t: v for t, v in table.items() if t != "x"} == {t: (n, points[t]) for t, n in played.items()}
    assert table["x"][0] == len(matches)


def test_aggregates_shuffle_one_row_per_key_and_task(tx):
    """Partial aggregation: the hot key crosses the shuffle once per map task."""
    plan = sales.company_means(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
