"""Files, silver cleaning, star load, partitioned facts and the daily table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardamom import operators as op
from cardamom import sources as src
from cardamom.operators import create_empty, duplicate_keys, orphans
from cardamom.plans import baskets, customers, daily_table, lake, sales, timeseries
from cardamom.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from cardamom.streaming import follow_fact_table, start_after

USERS = """id,name,surname,phone,email,birth_date,country,city,postal_code,address,signup_date,user_segment,income_band
1,Ann,"Lee, Jr",1,a@x,"Nov 7, 1985",US,NY,1,"A ""B"" st",2020-01-31,s,b
2,Bob,Ray,2,b@x,"Nov 17, 1999",US,LA,2,,2021-12-01,s,b
"""
TRANSACTIONS = """id;card_id;business_id;timestamp;amount;declined;product_ids;user_id;lat;longitude
t1;c1;b1;2022-03-12 08:30:00;10.50;false;1, 2, 2;1;1.23456789;2.5
t2;c1;b1;2022-03-12 08:30:00;oops;true;3;1;1.0;2.0
t3;c1;b2;2022-03-13 00:00:00;5.25;false;;2;x;
t4;c2;b2;2022-03-13 10:00:00;1.00;true;1,bad;2;1.0;2.0
t5;c2;b1;2022-03-14 10:00:00;2.00;true;99;2;1.0;2.0
t6;c2;b1;2022-03-15 10:00:00;3.00;true;1;2;1.0;2.0
t7;c3;b1;2022-03-15 11:00:00;4.00;;2;3;1.0;2.0
"""


@pytest.fixture
def raw(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(TRANSACTIONS, encoding="utf-8")
    return src.read_csv(spark, str(path), sep=";")


@pytest.fixture
def clean(raw):
    return lake.clean_transactions(raw, on_bad_item="drop")


PRODUCTS = [(1, "one", 9.99, "#1"), (2, "two", 5.0, "#2"), (3, "three", 1.0, "#3"), (4, "four", 2.0, "#4")]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCTS, "product_id bigint, name string, price double, colour string")


def test_declared_csv_over_two_files(spark, tmp_path, rows):
    for name in ("american", "european"):
        (tmp_path / f"{name}.csv").write_text(USERS, encoding="utf-8")
    paths = [str(tmp_path / f"{n}.csv") for n in ("american", "european")]
    staged = src.read_csv(spark, paths, "staging_users")
    assert staged.count() == 4
    users = lake.load_users(staged).distinct()
    assert users.schema == SCHEMAS["dim_users"]
    assert rows(users, "id", "surname", "birth_date", "address", "signup_date") == [
        (1, "Lee, Jr", dt.date(1985, 11, 7), 'A "B" st', dt.date(2020, 1, 31)),
        (2, "Ray", dt.date(1999, 11, 17), None, dt.date(2021, 12, 1)),
    ]


def test_declared_type_that_does_not_fit_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,x\nnot-a-number,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        src.read_csv(spark, str(path), "id int, x int").collect()


def test_union_of_users_keeps_origin(spark, rows):
    schema = "id int, " + ", ".join(f"{c} string" for c in lake.USER_COLUMNS)
    one = spark.createDataFrame([(1, *["v"] * len(lake.USER_COLUMNS))], schema)
    assert rows(lake.combine_users(one, one), "user_id", "origin") == [(1, "American"), (1, "Europe")]


def test_silver_transactions(clean):
    got = {r["transaction_id"]: r for r in clean.collect()}
    assert got["t1"]["amount"] == 10.5 and got["t1"]["product_ids"] == [1, 2, 2]
    assert got["t2"]["amount"] == 0.0
    assert got["t3"]["product_ids"] == [] and got["t3"]["lat"] is None
    assert got["t4"]["product_ids"] == [1]
    assert clean.schema["product_ids"].dataType.simpleString() == "array<bigint>"


def test_silver_products_and_cards(spark, rows):
    staged = spark.createDataFrame(
        [("7", "lamp", "$161.11", "#7c7c7c", 1.5, "WH-4", "home", "acme", "$63.84", dt.date(2014, 11, 1))],
        "id string, product_name string, price string, colour string, weight double, "
        "warehouse_id string, category string, brand string, cost string, launch_date date",
    )
    assert rows(lake.clean_products(staged), "product_id", "warehouse_id", "price") == [(7, 4, 161.11)]
    star = lake.load_products(staged.withColumn("weight", F.col("weight").cast("decimal(10,2)")))
    assert star.schema == SCHEMAS["dim_products"]
    assert [str(v) for v in star.select("price", "cost").first()] == ["161.11", "63.84"]
    cards = create_empty(spark, SCHEMAS["staging_credit_cards"])
    assert lake.clean_cards(cards).columns[0] == "card_id"
    assert lake.load_cards(cards).schema == SCHEMAS["dim_credit_card"]


def test_fact_splits_time_and_narrows_coordinates(spark):
    row = create_empty(spark, SCHEMAS["staging_transactions"])
    staged = spark.sql(
        "SELECT 't1' id, 'c' card_id, 'b' business_id, timestamp'2022-03-12 08:30:07' timestamp, "
        "1.5BD amount, '0' declined, '1' product_ids, 1 user_id, 1.2345675BD lat, -1.2345675BD longitude"
    )
    fact = lake.load_fact(row.unionByName(staged, allowMissingColumns=True))
    assert fact.schema == SCHEMAS["fact_transactions"]
    got = fact.first()
    assert got["tr_date"] == dt.date(2022, 3, 12) and got["tr_time"] == "08:30:07"
    assert (str(got["lat"]), str(got["longitude"])) == ("1.234568", "-1.234568")


def test_key_registry_is_consistent():
    for table, keys in PRIMARY_KEYS.items():
        assert set(keys) <= set(SCHEMAS[table].fieldNames())
    for child, column, parent, key in FOREIGN_KEYS:
        assert column in SCHEMAS[child].fieldNames() and PRIMARY_KEYS[parent] == [key]


def test_baskets(clean, products, rows):
    ranking = baskets.sales_ranking(clean, products)
    # t1 counts 1 and 2 twice; t7 has a NULL flag and does not count.
    assert [(r["product_id"], r["total_sold"]) for r in ranking.collect()] == [(2, 2), (1, 1), (3, 0), (4, 0)]
    assert ranking.columns == ["product_id", "name", "price", "total_sold", "colour"]
    flat = baskets.flat_sales(clean, products)
    assert rows(flat, "transaction_id", "product_sku", "product_price_tax_inc") == sorted(
        [
            ("t1", 1, 12.09),
            ("t1", 2, 6.05),
            ("t1", 2, 6.05),
            ("t2", 3, 1.21),
            ("t4", 1, 12.09),
            ("t5", None, None),
            ("t6", 1, 12.09),
            ("t7", 2, 6.05),
        ],
        key=repr,
    )
    best = baskets.top_products(clean, products, 2).collect()
    assert [tuple(r) for r in best] == [("one", 3), ("two", 3)]


def test_null_items_stay_when_asked_for(raw, products):
    kept = lake.clean_transactions(raw, on_bad_item="null")
    flat = baskets.flat_sales(kept, products).filter("transaction_id = 't4'")
    assert flat.count() == 2


def test_bridge_and_its_keys(raw, products, rows):
    tx = raw.withColumnRenamed("id", "transaction_id")
    bridge = baskets.bridge_from_text(tx)
    assert rows(baskets.malformed_lists(tx)) == [("t4", "1,bad")]
    assert rows(duplicate_keys(bridge, PRIMARY_KEYS["transaction_products"])) == [("t1", 2, 2)]
    assert duplicate_keys(baskets.dedupe_bridge(bridge), ["transaction_id", "product_id"]).count() == 0
    assert rows(orphans(bridge, "product_id", products, "product_id")) == [(99, 1)]
    assert rows(baskets.units_per_product(bridge, products), "product_id", "n_sales") == [(1, 2), (2, 3), (3, 1)]


def test_card_status(clean, rows):
    # c1 has a tie at 08:30, c2 three declined, c3 a single NULL flag.
    assert rows(customers.card_status(clean)) == [("c1", "active", 1), ("c2", "inactive", 3), ("c3", "active", None)]
    two = customers.card_status(clean.filter("transaction_id IN ('t5', 't6')"))
    assert rows(two) == [("c2", "active", 2)]
    assert customers.active_cards(customers.card_status(clean)).first()[0] == 2


def test_third_purchase_with_a_double_profile(spark, rows):
    tx = spark.sql(
        "SELECT id AS transaction_id, 1 AS user_id, id * 1.0D AS amount, false AS declined, "
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id / 2 AS int)) AS timestamp "
        "FROM range(1, 6)"
    )
    users = spark.createDataFrame(
        [(1, "A", "B", "x"), (1, "A", None, "y")], "user_id int, name string, surname string, email string"
    )
    got = rows(customers.third_purchase(tx, users), "full_name", "email", "nth_amount", "avg_first")
    assert got == sorted([("A B", "x", 3.0, 2.0), (None, "y", 3.0, 2.0)], key=repr)
    assert customers.third_purchase(tx.filter("transaction_id < 3"), users).count() == 0


def test_vip_threshold_is_strict(spark, rows):
    tx = spark.createDataFrame(
        [(1, 1, 250.0, False), (2, 1, 250.0, False), (3, 2, 500.01, False), (4, 2, 9.0, True), (5, 3, 900.0, None)],
        "transaction_id int, user_id int, amount double, declined boolean",
    )
    users = spark.createDataFrame([(i, "n", "s", "e") for i in (1, 2, 3)], "user_id int, name string, surname string, email string")
    assert rows(customers.vip_users(tx, users), "user_id", "n_purchases", "total_spent") == [(2, 1, 500.01)]


def test_volume_band_at_the_threshold(spark, rows):
    tx = spark.createDataFrame([(b,) for b in ["x"] * 3 + ["y"] * 2], "business_id string")
    companies = spark.createDataFrame([("x", "X"), ("y", "Y")], "company_id string, company_name string")
    assert rows(sales.volume_band(tx, companies, 3)) == [("X", 3, ">= 3"), ("Y", 2, "< 3")]
    assert rows(sales.volume_band(tx, companies, 3, inclusive=False)) == [("X", 3, "< 3"), ("Y", 2, "< 3")]


def test_companies_without_and_its_literal_form(spark, clean, rows):
    companies = spark.createDataFrame([("b1", "B1"), ("b9", "B9")], "company_id string, company_name string")
    assert rows(sales.companies_without(clean, companies)) == [("B9",)]
    assert rows(sales.companies_if_no_transactions(clean, companies)) == []
    assert rows(sales.companies_if_no_transactions(clean.limit(0), companies)) == [("B1",), ("B9",)]


def test_day_over_day_with_a_zero_day(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    daily = spark.createDataFrame(list(zip(days, ["0.00", "5.00", "7.50"])), "day date, s string")
    daily = daily.select("day", F.col("s").cast("decimal(20,2)").alias("sales"))
    got = [r["diff_pct"] for r in timeseries.day_over_day(daily).collect()]
    assert got == [None, None, 50.0]


AS_OF = dt.datetime(2024, 3, 1)


def fact_rows(spark, n, days):
    return spark.range(n).selectExpr(
        "id AS transaction_id",
        "id % 7 AS business_id",
        f"timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(cast(id % {days} AS int)) AS timestamp",
        "cast(id AS double) AS amount",
        "id % 5 = 0 AS declined",
    )


def expected_daily(fact):
    kept = fact.filter("NOT declined").groupBy(F.to_date("timestamp").alias("day"))
    return {r["day"]: r["s"] for r in kept.agg(F.sum("amount").alias("s")).collect()}


def stored_daily(spark, path):
    return {r["day"]: float(r["sales"]) for r in daily_table.read_daily_table(spark, path).collect()}


def test_partitioned_fact_prunes_days(spark, tmp_path):
    fact = fact_rows(spark, 600, 60)
    stored = src.write_partitioned_fact(fact, str(tmp_path / "fact"))
    recent = lake.recent(stored, AS_OF, days=5, day="tr_date")
    assert recent.count() == lake.recent(fact, AS_OF, days=5).count() > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tr_date" in plan


def test_hot_day_is_spread_over_files(spark, tmp_path):
    hot = fact_rows(spark, 40_000, 1).withColumn("amount", F.rand(1))
    rest = fact_rows(spark, 400, 20).withColumn("transaction_id", F.col("transaction_id") + 100_000)
    sc = spark.sparkContext
    sc.setJobGroup("fact", "write")
    try:
        stored = src.write_partitioned_fact(hot.unionByName(rest), str(tmp_path / "fact"), file_bytes=100_000)
        # One job for each side of the shuffle: the input is neither counted nor sampled first.
        assert len(sc.statusTracker().getJobIdsForGroup("fact")) <= 2
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(128 << 20)
    files = sorted((tmp_path / "fact" / "tr_date=2024-01-01").glob("*.parquet"))
    assert len(files) > 2 and stored.count() == 40_400
    for f in files:
        keys = [r[0] for r in spark.read.parquet(str(f)).select("business_id").collect()]
        assert keys == sorted(keys)


def test_daily_table_refresh(spark, tmp_path):
    fact_path, table_path = str(tmp_path / "fact"), str(tmp_path / "daily")
    src.write_partitioned_fact(fact_rows(spark, 200, 10), fact_path)
    daily_table.build_daily_table(spark, fact_path, table_path)
    full = expected_daily(spark.read.parquet(fact_path))
    assert stored_daily(spark, table_path) == full

    # Two days change: one gains rows, one loses all its sales.
    gain, loss = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    day = lambda d: spark.read.parquet(fact_path).filter(F.col("tr_date") == F.lit(d))
    more = day(gain).withColumn("amount", F.col("amount") + 1).cache()
    more.count()
    declined = day(loss).withColumn("declined", F.lit(True)).cache()
    declined.count()
    more.write.mode("append").partitionBy("tr_date").parquet(fact_path)
    src.overwrite_partitions(declined, fact_path, "tr_date")
    changed = spark.createDataFrame([(gain,), (loss,)], "tr_date date")
    for _ in range(2):  # running it again changes nothing
        daily_table.refresh_daily_table(spark, fact_path, table_path, changed)
        got = stored_daily(spark, table_path)
        assert got == expected_daily(spark.read.parquet(fact_path))
    assert loss not in got and got[gain] > full[gain]


def test_refresh_reads_changed_days_only(spark, tmp_path):
    fact_path = str(tmp_path / "fact")
    src.write_partitioned_fact(fact_rows(spark, 200, 10), fact_path)
    spark.createDataFrame([(dt.date(2024, 1, 2),)], "tr_date date").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    touched = src.of_partitions(daily_table.with_file(spark.read.parquet(fact_path)), days, "tr_date")
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString().lower()


def test_stream_follows_the_fact_table(spark, tmp_path):
    fact_path, table_path = str(tmp_path / "fact"), str(tmp_path / "daily")
    checkpoint = str(tmp_path / "checkpoint")
    src.write_partitioned_fact(fact_rows(spark, 100, 5), fact_path)
    daily_table.build_daily_table(spark, fact_path, table_path)
    follow_fact_table(spark, fact_path, table_path, checkpoint).awaitTermination()
    late = fact_rows(spark, 140, 7).filter("transaction_id >= 100").withColumn("tr_date", F.to_date("timestamp"))
    late.write.mode("append").partitionBy("tr_date").parquet(fact_path)
    follow_fact_table(spark, fact_path, table_path, checkpoint, max_files_per_batch=2).awaitTermination()
    assert stored_daily(spark, table_path) == expected_daily(spark.read.parquet(fact_path))


def test_append_casts_to_the_target(spark, tmp_path, rows):
    path = str(tmp_path / "status")
    create_empty(spark, SCHEMAS["card_status"]).write.parquet(path)
    new = spark.createDataFrame([("active", 5, 1.0)], "status string, card_id int, extra double")
    src.append_rows(new, path)
    assert rows(spark.read.parquet(path), "card_id", "status") == [("5", "active")]


def test_table_as_select_and_views(spark, tmp_path, rows):
    src.create_namespace(spark, "gold_test")
    for value in (1, 2):  # create or replace
        frame = spark.createDataFrame([(value,)], "x int")
        src.create_table_as(frame, "gold_test.t", str(tmp_path / "t"))
    assert rows(spark.table("gold_test.t")) == [(2,)]
    assert rows(src.publish_view(spark.table("gold_test.t"), "v_test")) == [(2,)]


def test_export_is_ordered(spark, tmp_path, clean, products):
    path = str(tmp_path / "out")
    src.export_csv(
        baskets.sales_ranking(clean, products), path, [F.col("total_sold").desc(), F.col("product_id")]
    )
    files = sorted((tmp_path / "out").glob("*.csv"))
    header, *lines = [line for f in files for line in f.read_text().splitlines()]
    assert header == "product_id;name;price;total_sold;colour"
    assert [int(line.split(";")[0]) for line in lines] == [2, 1, 3, 4]


def test_session_documents(spark, tmp_path, rows):
    path = tmp_path / "sessions.json"
    path.write_text('{"_id":{"$oid":"abc"},"user_id":"u1","jwt":"a.b.c"}\n', encoding="utf-8")
    docs = src.read_json_documents(spark, str(path))
    assert docs.columns == ["session_id", "user_id"]
    assert rows(docs) == [("abc", "u1")]


def test_records_and_random_redating(spark):
    tx = src.records(spark, [{"transaction_id": i} for i in range(500)], "transaction_id int").withColumn(
        "timestamp", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    )
    moved = lake.redate_randomly(tx, AS_OF)
    first, last = moved.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert AS_OF - dt.timedelta(days=50) <= first < last <= AS_OF
    assert moved.columns == ["transaction_id", "timestamp"] and moved.count() == 500


def test_external_table_and_append(spark, tmp_path, rows):
    src.write_csv(spark.createDataFrame([(1, 'a "b"')], "id int, name string"), str(tmp_path / "csv"))
    table = src.external_csv_table(spark, "ext_test", str(tmp_path / "csv"), "id int, name string")
    assert rows(table) == [(1, 'a "b"')]
    spark.sql("DROP TABLE ext_test")
    assert (tmp_path / "csv").exists()
    path = str(tmp_path / "fact")
    src.write_partitioned_fact(fact_rows(spark, 100, 5), path)
    stored = src.write_partitioned_fact(fact_rows(spark, 40, 8), path, mode="append")
    assert stored.count() == 140 and stored.select("tr_date").distinct().count() == 8


def test_rewrite_moves_rows_between_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = fact_rows(spark, 300, 3)
    src.write_partitioned_fact(fact.withColumn("timestamp", F.when(F.col("transaction_id") % 10 != 9, F.col("timestamp"))), path)
    before = spark.read.parquet(path)
    kinds = before.dtypes
    days = sorted(r[0] for r in before.select("tr_date").distinct().collect() if r[0])
    moved = F.col("tr_date") == F.lit(days[0])
    n_moved, n_there = before.filter(moved).count(), before.filter(F.col("tr_date") == F.lit(days[1])).count()
    later = {"tr_date": F.lit(days[1])}
    touched = src.rewrite_partitions(spark, path, "tr_date", moved, lambda df: op.set_where(df, moved, later))
    assert sorted(r[0] for r in touched.collect()) == days[:2]
    after = spark.read.parquet(path)
    assert after.count() == 300 and after.dtypes == kinds
    assert after.filter(F.col("tr_date") == F.lit(days[1])).count() == n_moved + n_there
    gone = F.col("tr_date").isNull() & (F.col("transaction_id") < 150)
    touched = src.rewrite_partitions(spark, path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    assert [r[0] for r in touched.collect()] == [None]
    after = spark.read.parquet(path)
    assert after.dtypes == kinds and after.count() == 285 and after.filter("tr_date IS NULL").count() == 15
    everything = F.lit(True)
    src.rewrite_partitions(spark, path, "tr_date", everything, lambda df: df.filter("transaction_id = 0"))
    assert spark.read.parquet(path).count() == 1


def test_follow_rewrites_only_new_days(spark, tmp_path):
    fact_path, table_path, marks = (str(tmp_path / x) for x in ("fact", "daily", "marks"))
    src.write_partitioned_fact(fact_rows(spark, 200, 10), fact_path)
    start_after(spark, fact_path, marks)
    daily_table.build_daily_table(spark, fact_path, table_path)

    def files():
        return {str(f.parent.name): f.name for f in (tmp_path / "daily").glob("day=*/*.parquet")}

    def follow():
        before = files()
        follow_fact_table(spark, fact_path, table_path, marks).awaitTermination()
        return {d for d, f in files().items() if before.get(d) != f}

    assert follow() == set()
    day = spark.read.parquet(fact_path).agg(F.min("tr_date")).first()[0]
    late = fact_rows(spark, 200, 10).filter(F.to_date("timestamp") == F.lit(day)).limit(1)
    src.write_partitioned_fact(late, fact_path, mode="append")
    assert follow() == {f"day={day}"}
    # A rewrite: its files are new, the old ones are gone, and emptied days come from the rewrite itself.
    gone = F.col("tr_date") == F.lit(day)
    touched = src.rewrite_partitions(spark, fact_path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    assert follow() == set()
    daily_table.refresh_daily_table(spark, fact_path, table_path, touched)
    assert stored_daily(spark, table_path) == pytest.approx(expected_daily(spark.read.parquet(fact_path)))


def test_rejected_items_and_tsv(spark, tmp_path, rows):
    raw = spark.createDataFrame([(1, "1, x,2"), (2, None), (3, ""), (4, "a,,b")], "id int, product_ids string")
    assert rows(lake.rejected_items(raw)) == [(1, " x"), (4, ""), (4, "a"), (4, "b")]
    path = tmp_path / "m.tsv"
    path.write_text('"A"\t1-0\tC d \n\n  B \t2-2\t\tX\n'.replace("\t\tX", "\tE"), encoding="utf-8")
    assert rows(src.read_tsv_matches(spark, str(path))) == [('"A"', "1-0", "C d"), ("B ", "2-2", "E")]
    path.write_text("A\t1-0\n", encoding="utf-8")
    with pytest.raises(Exception, match="three parts"):
        src.read_tsv_matches(spark, str(path)).count()
    short = spark.createDataFrame([("a|1",)], "line string")
    with pytest.raises(Exception, match="three parts"):
        src.read_pipe_lines(short).count()


def test_rewrites_read_only_the_partitions_concerned(spark, tmp_path):
    path = str(tmp_path / "fact")
    src.write_partitioned_fact(fact_rows(spark, 300, 30), path)
    table = spark.read.parquet(path)
    days = table.filter(F.dayofmonth("tr_date") == 3).select("tr_date").distinct()
    days.write.parquet(str(tmp_path / "days"))
    some = src.of_partitions(table, spark.read.parquet(str(tmp_path / "days")), "tr_date")
    assert some.count() == table.filter(F.dayofmonth("tr_date") == 3).count() > 0
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()


ODD = ["a:b/c", "%", "", "01", "it's \\ one", "x=y", "line\nbreak", "é 漢"]


@pytest.mark.parametrize("external", [False, True])
def test_partitions_are_named_by_their_values(spark, tmp_path, rows, external):
    name = f"odd_partitions_{external}".lower()
    frame = spark.createDataFrame([(i, k) for i, k in enumerate(ODD * 2)] + [(99, None)], "id int, k string")
    table = src.create_partitioned_table(frame, name, "k", str(tmp_path / "t") if external else None)
    kinds = table.dtypes
    gone = F.col("k").isin(ODD) & ~F.col("k").isin("x=y", "é 漢") | F.col("k").isNull()
    touched = src.rewrite_table(spark, name, "k", gone, lambda df: op.delete_where(df, gone))
    assert {r[0] for r in touched.collect()} == {*ODD, None} - {"", "x=y", "é 漢"}
    assert set(rows(spark.table(name))) == {(5, "x=y"), (7, "é 漢"), (13, "x=y"), (15, "é 漢")} and spark.table(name).dtypes == kinds
    if external:
        assert not [p for p in (tmp_path / "t").rglob("*.parquet") if p.parent.name not in ("k=x%3Dy", "k=é 漢")]
    # An update that moves rows into a partition that is there, and into a new one.
    moved = F.col("id") == 5
    src.rewrite_table(spark, name, "k", moved, lambda df: op.set_where(df, moved, {"k": "é 漢"}))
    moved = F.col("id") == 13
    src.rewrite_table(spark, name, "k", moved, lambda df: op.set_where(df, moved, {"k": "new: 100%"}))
    assert set(rows(spark.table(name))) == {(13, "new: 100%"), (15, "é 漢"), (5, "é 漢"), (7, "é 漢")}
    src.rewrite_table(spark, name, "k", F.lit(True), lambda df: df.filter("false"))
    assert spark.table(name).isEmpty() and spark.sql(f"SHOW PARTITIONS {name}").isEmpty()
    spark.sql(f"DROP TABLE {name}")


def test_text_partitions_of_a_folder_keep_their_type(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "01"), (2, "1"), (3, "a:b/c"), (4, "%")], "id int, k string")
    frame.write.partitionBy("k").parquet(path)
    gone = F.col("k").isin("a:b/c", "01")
    src.rewrite_partitions(spark, path, "k", gone, lambda df: op.delete_where(df, gone), schema=frame.schema)
    assert rows(spark.read.schema(frame.schema).parquet(path)) == [(2, "1"), (4, "%")]
    tables = {t.name for t in spark.catalog.listTables()}
    assert not any(t.startswith("cardamom_") and len(t) > 30 for t in tables)


def test_a_rewrite_that_stops_in_its_last_step_is_finished_later(spark, tmp_path, monkeypatch, rows):
    from cardamom.sources import partitions

    frame = spark.createDataFrame([(i, f"p{i % 3}", float(i)) for i in range(30)], "id int, k string, x double")
    src.create_partitioned_table(frame.select("id", "x", "k"), "stopped", "k", str(tmp_path / "t"))
    where = F.col("k") == "p0"
    double = lambda df: op.set_where(op.set_where(df, where, {"x": F.col("x") * 2}), where, {"k": "p1"})
    want = sorted((i, 2.0 * i if i % 3 == 0 else float(i), "p1" if i % 3 == 0 else f"p{i % 3}") for i in range(30))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(partitions, "replace_partitions", fails)
        with pytest.raises(RuntimeError):
            src.rewrite_table(spark, "stopped", "k", where, double)
    assert rows(spark.table("stopped")) == sorted(((r[0], r[2], r[1]) for r in frame.collect()), key=repr)  # as it was
    with monkeypatch.context() as m:
        m.setattr(partitions, "drop_partition", fails)
        with pytest.raises(RuntimeError):
            src.finish_rewrite(spark, "stopped", "k")
    assert src.finish_rewrite(spark, "stopped", "k")
    assert sorted(tuple(r) for r in spark.table("stopped").collect()) == want
    assert not src.finish_rewrite(spark, "stopped", "k") and not (tmp_path / "t" / "_rewrite").exists()
    spark.sql("DROP TABLE stopped")


def dated_rows(spark, rows):
    return spark.createDataFrame(rows, "transaction_id int, business_id int, timestamp timestamp_ntz, amount decimal(20,2), declined boolean")


def test_daily_state_follows_late_rows_replays_and_days_that_are_missing(spark, tmp_path, monkeypatch):
    from decimal import Decimal

    from cardamom.streaming import daily_sales
    from cardamom.plans.daily_table import merge_files, with_file
    from cardamom.session import _MADE

    fact, table, marks = (str(tmp_path / x) for x in ("fact", "daily", "marks"))
    at = lambda day: dt.datetime(2024, 1, day, 12)
    big = Decimal("12345678901234567.89")
    src.write_partitioned_fact(dated_rows(spark, [(1, 1, at(1), big, False), (2, 1, at(2), Decimal(5), True), (3, 2, None, Decimal(7), False)]), fact)
    start_after(spark, fact, marks)
    daily_table.build_daily_table(spark, fact, table)

    def stored():
        return {r["day"]: r["sales"] for r in daily_table.read_daily_table(spark, table).collect()}

    assert stored() == {dt.date(2024, 1, 1): big, None: Decimal(7)}
    old = {f for f in (tmp_path / "fact").rglob("*.parquet")}
    late = [(4, 1, at(1), Decimal("0.11"), False), (5, 1, None, Decimal(1), False), (6, 1, at(3), Decimal(2), False), (7, 1, at(2), Decimal(3), False)]
    src.write_partitioned_fact(dated_rows(spark, late), fact, mode="append")
    new = [str(f) for f in (tmp_path / "fact").rglob("*.parquet") if f not in old]
    scratch, read = len(_MADE), []

    def recorded(session, path, batch):
        read.extend(r[0] for r in batch.select("_file").collect())
        merge_files(session, path, batch)

    monkeypatch.setattr(daily_sales, "merge_files", recorded)
    follow_fact_table(spark, fact, table, marks).awaitTermination()
    # Late rows read their own files only.
    names = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in new], "name string").select(F.xxhash64("name"))
    assert len(read) == len(late) and set(read) == {r[0] for r in names.collect()}
    want = {dt.date(2024, 1, 1): big + Decimal("0.11"), dt.date(2024, 1, 2): Decimal(3), dt.date(2024, 1, 3): Decimal(2), None: Decimal(8)}
    assert stored() == want and len(_MADE) == scratch
    # The same files again, in part or as a whole: a replayed batch changes nothing.
    schema = spark.read.parquet(new[0]).schema
    for files in (new, new[:1]):
        reader = spark.read.schema(daily_table_schema(schema)).option("basePath", fact)
        merge_files(spark, table, with_file(reader.parquet(*files)))
        assert stored() == want


def daily_table_schema(schema):
    from pyspark.sql.types import DateType, StructField

    return schema.add(StructField("tr_date", DateType()))


def test_the_day_that_is_missing_follows_deletes(spark, tmp_path):
    fact, table = str(tmp_path / "fact"), str(tmp_path / "daily")
    rows = fact_rows(spark, 60, 3).withColumn("timestamp", F.when(F.col("transaction_id") % 4 != 1, F.col("timestamp")))
    src.write_partitioned_fact(rows, fact)
    daily_table.build_daily_table(spark, fact, table)
    assert None in stored_daily(spark, table) and len(stored_daily(spark, table)) == 4
    for gone in (F.col("tr_date").isNull() & (F.col("transaction_id") < 30), F.col("tr_date").isNull()):
        touched = src.rewrite_partitions(spark, fact, "tr_date", gone, lambda df: op.delete_where(df, gone))
        daily_table.refresh_daily_table(spark, fact, table, touched)
        left = spark.read.parquet(fact).filter("NOT declined").groupBy("tr_date").agg(F.sum("amount")).collect()
        assert stored_daily(spark, table) == {r[0]: r[1] for r in left}
    assert None not in stored_daily(spark, table)


def test_a_stream_passes_over_files_of_a_refreshed_rewrite(spark, tmp_path):
    fact, table, marks = (str(tmp_path / x) for x in ("fact", "daily", "marks"))
    src.write_partitioned_fact(fact_rows(spark, 100, 5), fact)
    daily_table.build_daily_table(spark, fact, table)
    # Without start_after the stream reads all files once more, and adds nothing.
    follow_fact_table(spark, fact, table, marks).awaitTermination()
    assert stored_daily(spark, table) == expected_daily(spark.read.parquet(fact))
    gone = F.col("transaction_id") < 20
    touched = src.rewrite_partitions(spark, fact, "tr_date", gone, lambda df: op.delete_where(df, gone))
    daily_table.refresh_daily_table(spark, fact, table, touched)
    follow_fact_table(spark, fact, table, marks).awaitTermination()
    assert stored_daily(spark, table) == expected_daily(spark.read.parquet(fact))


def test_inserts_check_keys_and_columns_change_in_place(spark, rows):
    names = {"company": "ins_company", "credit_card": "ins_card", "transaction": "ins_tx"}
    src.create_table_as(spark.createDataFrame([("b1", "Acme")], "id string, company_name string"), names["company"])
    src.create_table_as(spark.createDataFrame([("c1", "ES1", "p")], "id string, iban string, pan string"), names["credit_card"])
    tx = spark.createDataFrame([("t1", "c1", "b1", 1.5)], "id string, credit_card_id string, company_id string, amount double")
    src.create_table_as(tx, names["transaction"])
    row = lambda *x: spark.createDataFrame([x], "id string, credit_card_id string, company_id string, amount string")
    add = lambda table, df: src.insert_checked(spark, names, table, df)
    for bad, why in (
        (row("t2", "c9", "b9", "1"), "credit_card_id not in credit_card"),
        (row("t2", "c9", "b9", "1"), "company_id not in company"),
        (row("t1", "c1", "b1", "1"), "already"),
        (row(None, "c1", "b1", "1"), "no id"),
        (row("t3", "c1", "b1", "1").unionAll(row("t3", "c1", "b1", "2")), "twice"),
    ):
        with pytest.raises(src.KeyViolation, match=why):
            add("transaction", bad)
    with pytest.raises(ValueError, match="no such column"):
        add("company", spark.createDataFrame([("x", 1)], "id string, size int"))
    assert spark.table(names["transaction"]).count() == 1
    add("company", spark.createDataFrame([("b9",)], "id string"))
    add("credit_card", spark.createDataFrame([("c9", "IB")], "id string, iban string"))
    add("transaction", row("t2", "c9", "b9", "111.11").unionAll(row("t3", None, "b1", None)))
    assert rows(spark.table(names["transaction"])) == [("t1", "c1", "b1", 1.5), ("t2", "c9", "b9", 111.11), ("t3", None, "b1", None)]
    assert rows(spark.table(names["company"])) == [("b1", "Acme"), ("b9", None)]
    src.change_columns(spark, names["credit_card"], lambda df: op.drop_columns(df, "pan"))
    changed = src.change_columns(spark, names["credit_card"], lambda df: op.retype(df, {"iban": F.length("iban")}))
    assert rows(changed) == [("c1", 3), ("c9", 2)] and changed.dtypes == [("id", "string"), ("iban", "int")]
    with pytest.raises(Exception):  # a change that fails leaves the table
        src.change_columns(spark, names["credit_card"], lambda df: df.withColumn("x", F.raise_error(F.lit("no"))))
    assert rows(spark.table(names["credit_card"])) == [("c1", 3), ("c9", 2)]
    src.create_partitioned_table(tx, "ins_parts", "company_id")
    parts = src.change_columns(spark, "ins_parts", lambda df: df.withColumn("amount", F.col("amount").cast("string")), by="company_id")
    assert parts.columns == ["id", "credit_card_id", "amount", "company_id"] and not spark.sql("SHOW PARTITIONS ins_parts").isEmpty()
    for name in (*names.values(), "ins_parts"):
        spark.sql(f"DROP TABLE {name}")


def test_stored_tables_of_a_call_are_its_own(spark, rows):
    """Files of an earlier program lie in the warehouse, and no result is replaced by what is called after it."""
    from urllib.parse import urlparse

    from cardamom.workload import queries as workload

    sf = "/root/testdata/sf0.001"
    warehouse = urlparse(spark.conf.get("spark.sql.warehouse.dir")).path
    for name in ("company", "credit_card", "transaction"):
        spark.sql(f"DROP TABLE IF EXISTS cardamom_stored_{name}")
        spark.range(1).write.mode("overwrite").parquet(f"{warehouse}/cardamom_stored_{name}")
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    first = workload.dml_insert_checked(spark, sf)
    changed = workload.dml_stored_columns(spark, sf)
    second = workload.dml_insert_checked(spark, sf)
    assert len(rows(first)) == orders + 1 and rows(first) == rows(second)
    assert changed.columns == ["id", "iban", "expiring_date"]
    assert changed.count() == spark.read.parquet(f"{sf}/customer.parquet").count()
