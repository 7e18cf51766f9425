"""One entry per business question and operator group, on the test tables.

Every entry reads whole tables.  Those that exercise files write them to the
session's shared folder first and read them back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom import functions as fn
from cardamom import operators as op
from cardamom import sources as src
from cardamom.plans import (
    baskets,
    candidates,
    customers,
    daily_table,
    documents,
    jobs,
    lake,
    league,
    sales,
    scoring,
    timeseries,
)
from cardamom.schemas import SCHEMAS
from cardamom.session import scratch_namespace, shared_dir
from cardamom.streaming import follow_fact_table, start_after
from cardamom.workload import roles

Query = Callable[[SparkSession, str], DataFrame]

COUNTRY = "NATION_7"
DAY = "1997-05-28"
YEAR = 1997
DATES = ["1995-04-29", "1998-07-20", "2000-03-13"]
AMOUNTS = (100000, 200000)
VOLUME = 10
PREMIUM_OVER = 260000
VIP_OVER = 2500000
AS_OF = dt.datetime(2024, 3, 1)
LOAD_BEFORE = dt.date(2024, 1, 20)

_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return lake.clean_transactions(roles.raw_transactions(spark, sf), on_bad_item="drop")


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return lake.clean_products(roles.staging_products(spark, sf))


def _list_text(df: DataFrame, column: str = "product_ids") -> DataFrame:
    """Arrays as text, so results compare as plain values."""
    return df.withColumn(column, F.array_join(column, ","))


# ---- sales ------------------------------------------------------------------


@query
def p01_selling_countries(spark, sf):
    return sales.selling_countries(
        roles.orders_as_transactions(spark, sf), roles.companies(spark, sf)
    )


@query
def p02_n_countries(spark, sf):
    return sales.number_of_selling_countries(
        roles.orders_as_transactions(spark, sf), roles.companies(spark, sf)
    )


@query
def p03_top_company(spark, sf):
    return sales.top_company(roles.orders_as_transactions(spark, sf), roles.company_names(spark, sf))


@query
def p04_country_tx_semi(spark, sf):
    return sales.country_transactions(
        roles.orders_as_transactions(spark, sf), roles.companies(spark, sf), COUNTRY
    )


@query
def p05_above_avg(spark, sf):
    return sales.above_average_companies(
        roles.orders_as_transactions(spark, sf), roles.company_names(spark, sf)
    )


@query
def p06_global_avg(spark, sf):
    return sales.overall_mean(roles.orders_as_transactions(spark, sf))


@query
def p07_no_tx_anti(spark, sf):
    """Companies without a declined transaction (all of them have some transaction)."""
    declined = roles.orders_as_transactions(spark, sf).filter("declined")
    return sales.companies_without(declined, roles.companies(spark, sf))


@query
def p09_heavy_users(spark, sf):
    return sales.heavy_users(
        roles.events_as_transactions(spark, sf), roles.users(spark, sf), more_than=80
    )


@query
def p10_avg_per_account(spark, sf):
    return sales.mean_per_account(
        roles.events_as_transactions(spark, sf),
        roles.cards(spark, sf),
        roles.event_companies(spark, sf),
        "Supplier#000000007",
    )


@query
def p11_top_days(spark, sf):
    """The star form: only sales of a listed company count."""
    companies = roles.company_names(spark, sf)
    return sales.top_days(roles.orders_as_transactions(spark, sf), companies=companies)


@query
def p11y_top_days_year(spark, sf):
    return sales.top_days(roles.orders_as_transactions(spark, sf), year=YEAR)


@query
def p12_range_dates(spark, sf):
    return sales.transactions_in_range(
        roles.orders_as_transactions(spark, sf), roles.companies(spark, sf), *AMOUNTS, DATES
    )


@query
def p13_volume_band(spark, sf):
    return sales.volume_band(
        roles.orders_as_transactions(spark, sf), roles.company_names(spark, sf), VOLUME
    )


@query
def p13_volume_band_strict(spark, sf):
    """The literal test ``>`` under the label ``>=``."""
    return sales.volume_band(
        roles.orders_as_transactions(spark, sf),
        roles.company_names(spark, sf),
        VOLUME,
        inclusive=False,
    )


@query
def p14_marketing_kpis(spark, sf):
    view = src.publish_view(
        sales.marketing_view(
            roles.orders_as_transactions(spark, sf), roles.companies(spark, sf), PREMIUM_OVER
        ),
        "v_marketing_kpis",
    )
    return sales.marketing_report(view)


@query
def p14v_marketing_view_sql(spark, sf):
    """The same view read with SQL, where the alias shadows the view's column."""
    src.publish_view(
        sales.marketing_view(
            roles.orders_as_transactions(spark, sf), roles.companies(spark, sf), PREMIUM_OVER
        ),
        "v_marketing",
    )
    return spark.sql(
        "SELECT company, phone, country, CAST(round(avg_amount, 2) AS double) AS avg_amount "
        "FROM v_marketing ORDER BY avg_amount DESC"
    )


@query
def p19_country_day(spark, sf):
    return sales.country_day(
        roles.orders_as_transactions(spark, sf), roles.companies(spark, sf), COUNTRY, DAY
    )


# ---- cards, users, series ---------------------------------------------------


@query
def p15_card_status(spark, sf):
    return customers.card_status(roles.orders_as_transactions(spark, sf))


@query
def p15c_active_count(spark, sf):
    return customers.active_cards(p15_card_status(spark, sf))


@query
def p21_daily_sales(spark, sf):
    return timeseries.daily_report(
        timeseries.daily_sales(roles.orders_as_transactions(spark, sf))
    )


@query
def p22_vip(spark, sf):
    return customers.vip_users(
        roles.orders_as_transactions(spark, sf), roles.users(spark, sf), VIP_OVER
    )


@query
def p23_day_over_day(spark, sf):
    return timeseries.day_over_day(
        timeseries.daily_sales(roles.orders_as_transactions(spark, sf))
    )


@query
def p24_ytd(spark, sf):
    return timeseries.year_to_date(
        timeseries.daily_sales(roles.orders_as_transactions(spark, sf))
    )


@query
def p25_third_purchase(spark, sf):
    return customers.third_purchase(
        roles.orders_as_transactions(spark, sf), roles.users(spark, sf)
    )


# ---- star load, silver, baskets ---------------------------------------------


@query
def p08_star_load(spark, sf):
    fact = lake.load_fact(roles.staging_transactions(spark, sf))
    return fact.select(
        "id",
        "company_id",
        "card_id",
        "user_id",
        "product_ids",
        "tr_date",
        "tr_time",
        F.col("amount").cast("double").alias("amount"),
        "declined",
        F.col("lat").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("longitude"),
        "channel",
        "decline_reason",
    )


@query
def p08_dim_users(spark, sf):
    return lake.load_users(roles.staging_users(spark, sf)).select(
        "id", "name", "surname", "birth_date", "country", "signup_date", "user_segment"
    )


@query
def p08_dim_companies(spark, sf):
    return lake.load_companies(roles.staging_companies(spark, sf))


@query
def p08_dim_credit_card(spark, sf):
    return lake.load_cards(roles.staging_cards(spark, sf)).select(
        "id", "user_id", "iban", "expiring_date", "card_type", "card_renewal_flag"
    )


@query
def p08_dim_products(spark, sf):
    return lake.load_products(roles.staging_products(spark, sf)).select(
        "id",
        "product_name",
        F.col("price").cast("double").alias("price"),
        "colour",
        F.col("weight").cast("double").alias("weight"),
        "warehouse_id",
        F.col("cost").cast("double").alias("cost"),
        "launch_date",
    )


@query
def p16_bridge(spark, sf):
    raw = roles.raw_transactions(spark, sf).withColumnRenamed("id", "transaction_id")
    return baskets.bridge_from_text(raw)


@query
def p16_malformed_lists(spark, sf):
    raw = roles.raw_transactions(spark, sf).withColumnRenamed("id", "transaction_id")
    return baskets.malformed_lists(raw)


@query
def p16_units_per_product(spark, sf):
    return baskets.units_per_product(roles.lineitem_as_bridge(spark, sf), _products(spark, sf))


@query
def p17_products_clean(spark, sf):
    return _products(spark, sf).withColumn("weight", F.col("weight").cast("double"))


@query
def p17_tx_clean(spark, sf):
    return _list_text(_clean(spark, sf))


@query
def p17_users_combined(spark, sf):
    return lake.combine_users(
        roles.staging_users_of(spark, sf, "AMERICA"), roles.staging_users_of(spark, sf, "EUROPE")
    )


@query
def p17_companies_clean(spark, sf):
    return lake.clean_companies(roles.staging_companies(spark, sf))


@query
def p17_cards_clean(spark, sf):
    return lake.clean_cards(roles.staging_cards(spark, sf)).select(
        "card_id", "user_id", "iban", "expiring_date"
    )


@query
def p18_sales_ranking(spark, sf):
    return baskets.sales_ranking(_clean(spark, sf), _products(spark, sf))


@query
def p26_flat_tax(spark, sf):
    return _list_text(baskets.flat_sales(_clean(spark, sf), _products(spark, sf)))


@query
def p27_top_products(spark, sf):
    return baskets.top_products(_clean(spark, sf), _products(spark, sf))


# ---- re-dating and layout ---------------------------------------------------


def _redated(spark, sf):
    tx = roles.orders_as_transactions(spark, sf)
    return lake.redate(tx, AS_OF, lake.hashed_offset(F.col("transaction_id")))


@query
def p20_recent_30d(spark, sf):
    return lake.recent(_redated(spark, sf), AS_OF)


@query
def p20_recent_random(spark, sf):
    """Random re-dating.  Which rows are recent is chance; these facts about all of them are not."""
    tx = lake.redate_randomly(roles.orders_as_transactions(spark, sf), AS_OF)
    offset = F.datediff(F.lit(AS_OF.date()), F.to_date("timestamp"))
    recent = F.col("timestamp") >= F.lit(AS_OF - dt.timedelta(days=30))
    return tx.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("transaction_id").alias("n_transactions"),
        (F.min(offset) >= 0).alias("none_before"),
        (F.max(offset) <= 50).alias("none_after"),
        (F.abs(F.avg(recent.cast("int")) - 0.61) < 0.05).alias("recent_share_as_expected"),
        F.sum("amount").cast("decimal(20,2)").cast("double").alias("amounts"),
        F.lit(",".join(sorted(tx.columns))).alias("columns"),
    )


@query
def snk4_partitioned_fact(spark, sf):
    """Re-dated fact written by day, clustered by company; 30 days read back."""
    fact = src.write_partitioned_fact(_redated(spark, sf), shared_dir(spark, "fact"))
    return lake.recent(fact, AS_OF, day="tr_date").drop("tr_date")


@query
def vw3_daily_table(spark, sf):
    """Daily table built from the first load, then kept fresh by the stream."""
    tx = roles.events_as_transactions(spark, sf)
    fact_path, table_path = shared_dir(spark, "fact"), shared_dir(spark, "daily")
    early = F.to_date("timestamp") < F.lit(LOAD_BEFORE)
    src.write_partitioned_fact(tx.filter(early), fact_path)
    checkpoint = shared_dir(spark, "follow")
    start_after(spark, fact_path, checkpoint)
    daily_table.build_daily_table(spark, fact_path, table_path)
    src.write_partitioned_fact(tx.filter(~early), fact_path, mode="append")
    follow_fact_table(spark, fact_path, table_path, checkpoint).awaitTermination()
    return timeseries.daily_report(daily_table.read_daily_table(spark, table_path))


# ---- record jobs ------------------------------------------------------------


@query
def p28_candidates_ok(spark, sf):
    accepted, _ = candidates.intake(roles.candidates(spark, sf))
    return accepted


@query
def p28_candidates_rejects(spark, sf):
    _, rejects = candidates.intake(roles.candidates(spark, sf))
    return rejects


@query
def p28_report(spark, sf):
    accepted, _ = candidates.intake(roles.candidates(spark, sf))
    return candidates.report(accepted)


@query
def p28_first_ten(spark, sf):
    """Intake that stops at ten accepted candidates."""
    accepted, _ = candidates.intake(roles.candidates(spark, sf), max_accepted=10)
    return accepted.select("seq", "name", "phone", "score", "band")


@query
def p28_first_ten_rejects(spark, sf):
    _, rejects = candidates.intake(roles.candidates(spark, sf), max_accepted=10)
    return rejects


@query
def p28_last_candidate(spark, sf):
    accepted, _ = candidates.intake(roles.candidates(spark, sf))
    return op.last_value_row(accepted, "seq").select("seq", "name", "phone", "score", "band")


@query
def p28_nth_candidate(spark, sf):
    accepted, _ = candidates.intake(roles.candidates(spark, sf))
    return op.nth_row(accepted, [F.col("seq")], 7).select("seq", "name", "phone", "score", "band")


@query
def src9_chunk_records(spark, sf):
    """The candidate fields as one flat list, cut back into records of six."""
    rows = roles.candidates(spark, sf)
    items = F.posexplode(F.array(*candidates.FIELDS)).alias("slot", "value")
    flat = rows.select("seq", items).select(
        (F.col("seq") * len(candidates.FIELDS) + F.col("slot")).alias("pos"), "value"
    )
    return op.chunk_records(flat, candidates.FIELDS)


@query
def p29_risk(spark, sf):
    return scoring.risk_report(scoring.abandonment_risk(roles.clients(spark, sf, 5)))


@query
def p29_contact_first(spark, sf):
    return scoring.contact_first(scoring.abandonment_risk(roles.clients(spark, sf, 5)))


@query
def p29_low_interest(spark, sf):
    return scoring.low_interest(scoring.abandonment_risk(roles.clients(spark, sf, 5)))


@query
def p29_most_profitable(spark, sf):
    return scoring.most_profitable(scoring.abandonment_risk(roles.clients(spark, sf, 5)))


@query
def p30_triage(spark, sf):
    patients = scoring.triage(roles.symptom_lines(spark, sf), roles.WORD_SEVERITIES)
    return scoring.triage_report(_list_text(patients, "symptoms"))


@query
def p31_insurance(spark, sf):
    return scoring.insurance_report(scoring.insurance_prices(roles.clients(spark, sf, 4)))


@query
def p31_findings(spark, sf):
    return scoring.insurance_findings(scoring.insurance_prices(roles.clients(spark, sf, 4)))


@query
def p32_league(spark, sf):
    return league.league_table(roles.matches(spark, sf))


# ---- maintenance ------------------------------------------------------------


@query
def p33_update(spark, sf):
    """Account corrected where both the id and the old value match."""
    wrong = (F.col("card_id") == 42) & (F.col("iban") == "IBAN21")
    return op.set_where(roles.cards(spark, sf), wrong, {"iban": "IBAN-corrected"})


@query
def p33_retype_date(spark, sf):
    """Expiry text to a date, over the whole column."""
    card = roles.staging_cards(spark, sf).select("id", "expiring_date")
    return op.retype(card, {"expiring_date": fn.parse_short_us_date("expiring_date")})


@query
def p33_insert(spark, sf):
    """A new transaction given as text; absent columns are NULL."""
    new = {"transaction_id": "-9999", "user_id": "9999", "amount": "111.11", "declined": "0"}
    return op.insert_rows(roles.orders_as_transactions(spark, sf), [new])


@query
def p33_delete(spark, sf):
    return op.delete_where(roles.orders_as_transactions(spark, sf), F.col("transaction_id") == 7)


@query
def p33_drop_column(spark, sf):
    return op.drop_columns(roles.table(spark, sf, "customer"), "c_acctbal")


@query
def p34_docs_json(spark, sf):
    events = roles.table(spark, sf, "events").select("event_id", "props")
    return documents.flatten_json(events, "props", "k bigint", {"k": "k"})


@query
def dml_rewrite_table(spark, sf):
    """Deletes and an update on a day-partitioned table, touching few partitions.

    Day 3 loses all rows, day 5 loses the errors, one row of day 7 is corrected.
    """
    path = shared_dir(spark, "fact")
    src.write_partitioned_fact(roles.events_as_transactions(spark, sf), path)
    day = F.dayofmonth("tr_date")
    gone = (day == 3) | ((day == 5) & F.col("declined"))
    src.rewrite_partitions(spark, path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    wrong = (day == 7) & (F.col("user_id") == 7)
    src.rewrite_partitions(
        spark, path, "tr_date", wrong, lambda df: op.set_where(df, wrong, {"amount": 0.0})
    )
    return spark.read.parquet(path)


@query
def dml_move_partition(spark, sf):
    """An update that moves rows of one user from day 7 of a month to day 8, where others are."""
    path = shared_dir(spark, "fact")
    src.write_partitioned_fact(roles.events_as_transactions(spark, sf), path)
    moved = (F.dayofmonth("tr_date") == 7) & (F.col("user_id") % 10 == 7)
    later = {"timestamp": F.col("timestamp") + F.expr("interval 1 day"), "tr_date": F.date_add("tr_date", 1)}
    src.rewrite_partitions(spark, path, "tr_date", moved, lambda df: op.set_where(df, moved, later))
    return spark.read.parquet(path)


@query
def dml_delete_null_day(spark, sf):
    """Rows without a day are a partition of their own: some are deleted, some stay."""
    path = shared_dir(spark, "fact")
    lost = F.when(F.col("user_id") % 10 != 3, F.col("timestamp"))
    src.write_partitioned_fact(roles.events_as_transactions(spark, sf).withColumn("timestamp", lost), path)
    gone = F.col("tr_date").isNull() & F.col("declined")
    src.rewrite_partitions(spark, path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    return spark.read.parquet(path)


def _stored_star(spark, sf) -> dict[str, str]:
    """Companies, cards and transactions as catalog tables, by their declared names, in a namespace of this call alone."""
    customer = roles.table(spark, sf, "customer")
    orders = roles.table(spark, sf, "orders")
    frames = {
        "company": customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("company_name")),
        "credit_card": customer.select(F.concat(F.lit("CcU-"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("iban"), F.col("c_nationkey").cast("string").alias("pan"), F.lit("10/30/22").alias("expiring_date")),
        "transaction": orders.select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.concat(F.lit("CcU-"), "o_custkey").alias("credit_card_id"),
            F.col("o_custkey").cast("string").alias("company_id"),
            F.col("o_totalprice").alias("amount"),
            (F.col("o_orderstatus") == "F").alias("declined"),
        ),
    }
    space = scratch_namespace(spark, "cardamom_stored")
    names = {name: f"{space}.{name}" for name in frames}
    for name, df in frames.items():
        src.create_table_as(df, names[name])
    return names


@query
def dml_insert_checked(spark, sf):
    """A transaction of a company and a card that are not there yet: refused, then added after its parents."""
    names = _stored_star(spark, sf)
    new = src.records(spark, [{"id": "108B1D1D", "credit_card_id": "CcU-none", "company_id": "b-9999", "amount": "111.11", "declined": "0"}], "id string, credit_card_id string, company_id string, amount string, declined string")
    try:
        src.insert_checked(spark, names, "transaction", new)
    except src.KeyViolation:
        src.insert_checked(spark, names, "company", new.select(F.col("company_id").alias("id")))
        src.insert_checked(spark, names, "credit_card", new.select(F.col("credit_card_id").alias("id"), F.col("id").alias("iban")))
        src.insert_checked(spark, names, "transaction", new)
    return spark.table(names["transaction"])


@query
def dml_stored_columns(spark, sf):
    """A stored table whose expiry texts become dates and which loses a column."""
    card = _stored_star(spark, sf)["credit_card"]
    src.change_columns(spark, card, lambda df: op.retype(df, {"expiring_date": fn.parse_short_us_date("expiring_date")}))
    return src.change_columns(spark, card, lambda df: op.drop_columns(df, "pan"))


@query
def dml_delete_text_partition(spark, sf):
    """A table with a partition for each of some awkward texts: three of them, and the one without, lose all rows; one changes its text."""
    names = F.create_map(*(F.lit(x) for x in ("1-URGENT", "a:b/c", "2-HIGH", "100%", "3-MEDIUM", "", "4-NOT SPECIFIED", "01", "5-LOW", "it's x=y")))
    orders = roles.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", names[F.col("o_orderpriority")].alias("k"))
    name = "cardamom_text_partitions"
    src.create_partitioned_table(orders, name, "k", shared_dir(spark, "text_partitions"))
    gone = F.col("k").isin("a:b/c", "100%") | F.col("k").isNull()
    src.rewrite_table(spark, name, "k", gone, lambda df: op.delete_where(df, gone))
    moved = (F.col("k") == "01") & (F.col("o_totalprice") < 100000)
    src.rewrite_table(spark, name, "k", moved, lambda df: op.set_where(df, moved, {"k": "new/one"}))
    return spark.table(name)


@query
def vw3_null_day(spark, sf):
    """The daily table with a day for rows that have none: built, followed, and after a delete among those rows."""
    tx = roles.events_as_transactions(spark, sf)
    tx = tx.withColumn("timestamp", F.when(F.col("user_id") % 10 != 3, F.col("timestamp")))
    fact_path, table_path, checkpoint = (shared_dir(spark, x) for x in ("fact", "daily", "follow"))
    late = F.col("transaction_id") % 4 == 0
    src.write_partitioned_fact(tx.filter(~late), fact_path)
    start_after(spark, fact_path, checkpoint)
    daily_table.build_daily_table(spark, fact_path, table_path)
    src.write_partitioned_fact(tx.filter(late), fact_path, mode="append")
    follow_fact_table(spark, fact_path, table_path, checkpoint).awaitTermination()
    gone = F.col("tr_date").isNull() & (F.col("transaction_id") % 3 == 0)
    touched = src.rewrite_partitions(spark, fact_path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    daily_table.refresh_daily_table(spark, fact_path, table_path, touched)
    return timeseries.daily_report(daily_table.read_daily_table(spark, table_path))


@query
def p06_large_decimals(spark, sf):
    """Sums of decimals with more digits than a double has."""
    amount = (F.col("l_orderkey").cast("decimal(14,0)") * 1000000007 + F.col("l_linenumber") / F.lit(100).cast("decimal(3,0)")).cast("decimal(20,2)")
    lines = roles.table(spark, sf, "lineitem").select("l_returnflag", amount.alias("amount"))
    total = fn.exact_sum("amount").cast("string").alias("total")
    return lines.groupBy("l_returnflag").agg(total, F.count("*").alias("n"))


@query
def vw3_after_delete(spark, sf):
    """The daily table after all rows of some days were deleted from the fact."""
    fact_path, table_path = shared_dir(spark, "fact"), shared_dir(spark, "daily")
    src.write_partitioned_fact(roles.events_as_transactions(spark, sf), fact_path)
    daily_table.build_daily_table(spark, fact_path, table_path)
    gone = F.dayofmonth("tr_date") == 3
    touched = src.rewrite_partitions(spark, fact_path, "tr_date", gone, lambda df: op.delete_where(df, gone))
    daily_table.refresh_daily_table(spark, fact_path, table_path, touched)
    return timeseries.daily_report(daily_table.read_daily_table(spark, table_path))


@query
def p21_subcent_days(spark, sf):
    """Days of amounts with fractions of a cent: rounded once, at the end."""
    return timeseries.daily_report(timeseries.daily_sales(roles.lines_as_transactions(spark, sf)))


@query
def p06_subcent_mean(spark, sf):
    accepted = sales.sold(roles.lines_as_transactions(spark, sf))
    return accepted.agg(fn.rounded_mean("amount").alias("avg_sale"), fn.rounded_sum("amount").alias("total_sale"))


@query
def p22_subcent_vip(spark, sf):
    tx, users = roles.lines_as_transactions(spark, sf), roles.suppliers_as_users(spark, sf)
    return customers.vip_users(tx, users, spent_over=100)


@query
def p16_units_from_text(spark, sf):
    """List texts to the bridge, and the bridge to units per product."""
    tx = roles.raw_transactions(spark, sf).withColumnRenamed("id", "transaction_id")
    return baskets.units_per_product(baskets.bridge_from_text(tx), _products(spark, sf))


@query
def p18_ranking_from_lines(spark, sf):
    """The ranking over the order lines themselves."""
    tx, lines = roles.orders_as_transactions(spark, sf), roles.lineitem_as_bridge(spark, sf)
    return baskets.ranking_from_lines(lines, tx, _products(spark, sf))


@query
def udf1_tax_sql(spark, sf):
    """The tax function called from SQL."""
    fn.register_sql_functions(spark)
    src.publish_view(roles.table(spark, sf, "part"), "part_prices")
    return spark.sql(
        "SELECT p_partkey, CAST(calculate_tax(p_retailprice, 0.21, 2) AS double) AS tax, "
        "CAST(calculate_tax(p_retailprice, 0.21, 0) AS double) AS whole_tax FROM part_prices"
    )


@query
def flt2_point_lookup(spark, sf):
    return roles.orders_as_transactions(spark, sf).filter(F.col("transaction_id") == 7)


# ---- integrity --------------------------------------------------------------


@query
def dq1_pk(spark, sf):
    return op.duplicate_keys(roles.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq2_composite_pk(spark, sf):
    bridge = roles.lineitem_as_bridge(spark, sf)
    return op.duplicate_keys(bridge, ["transaction_id", "product_id"])


@query
def dq2_deduped_bridge(spark, sf):
    return baskets.dedupe_bridge(roles.lineitem_as_bridge(spark, sf))


@query
def dq3_fk(spark, sf):
    """Basket items that name no known product."""
    items = baskets.basket_items(_clean(spark, sf)).select("product_id")
    return op.orphans(items, "product_id", _products(spark, sf), "product_id")


@query
def dq_key_report(spark, sf):
    """All declared keys of the star built from the test tables, violations counted."""
    items = baskets.bridge_from_text(
        roles.raw_transactions(spark, sf).withColumnRenamed("id", "transaction_id")
    )
    return jobs.key_report(
        {
            "dim_users": lake.load_users(roles.staging_users(spark, sf)),
            "dim_companies": lake.load_companies(roles.staging_companies(spark, sf)),
            "dim_credit_card": lake.load_cards(roles.staging_cards(spark, sf)),
            "dim_products": lake.load_products(roles.staging_products(spark, sf)),
            "fact_transactions": lake.load_fact(roles.staging_transactions(spark, sf)),
            "transaction_products": items,
        }
    )


@query
def dq4_row_count(spark, sf):
    """Rows written by a load against the rows of its source."""
    staged = {n: roles.table(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    loaded = {n: src.write_parquet(df, shared_dir(spark, n)) for n, df in staged.items()}
    return op.row_count_check(loaded, staged)


# ---- files ------------------------------------------------------------------


def _csv_copy(df: DataFrame, label: str, sep: str = ",", header: bool = True) -> str:
    path = shared_dir(df.sparkSession, label)
    src.write_csv(df, path, sep=sep, header=header)
    return path


@query
def src1_csv_load(spark, sf):
    """Comma CSV with a declared schema, straight into the star dimension."""
    path = _csv_copy(roles.staging_cards(spark, sf), "cards")
    card = lake.load_cards(src.read_csv(spark, path, "staging_credit_cards"))
    return card.select("id", "user_id", "iban", "expiring_date", "card_type", "card_renewal_flag")


@query
def src2_csv_semicolon(spark, sf):
    staged = roles.staging_transactions(spark, sf)
    columns = SCHEMAS["staging_transactions"].fieldNames()
    path = _csv_copy(staged.select(columns), "transactions", sep=";")
    read = src.read_csv(spark, path, "staging_transactions", sep=";")
    return read.select(
        "id",
        "card_id",
        "business_id",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.col("amount").cast("double").alias("amount"),
        fn.to_flag("declined").alias("declined"),
        "user_id",
    )


@query
def src2_flags_01(spark, sf):
    """Flags written as 0 and 1, read with the declared schema and loaded into the fact."""
    columns = SCHEMAS["staging_transactions"].fieldNames()
    staged = roles.staging_transactions(spark, sf).withColumn("declined", F.col("declined").cast("int"))
    path = _csv_copy(staged.select(columns), "transactions", sep=";")
    fact = lake.load_fact(src.read_csv(spark, path, "staging_transactions", sep=";"))
    return fact.select("id", "card_id", "company_id", F.col("amount").cast("double").alias("amount"), "declined")


@query
def src4_flags_01(spark, sf):
    """Flags written as 0 and 1, types inferred, cleaned into the lake."""
    raw = roles.raw_transactions(spark, sf)
    path = _csv_copy(raw.withColumn("declined", F.col("declined").cast("int")), "raw", sep=";")
    clean = lake.clean_transactions(src.read_csv(spark, path, sep=";"), on_bad_item="drop")
    ids = {c: F.col(c).cast("bigint") for c in ("transaction_id", "business_id", "card_id", "user_id")}
    return _list_text(clean.withColumns(ids))


@query
def load_star_rejects(spark, sf):
    """Baskets that the star load could not read: each has its text and no bridge rows."""
    star = _load_star(spark, sf)
    bridged = star["transaction_products"].select("transaction_id")
    return op.keep_unmatched(star["rejected_baskets"], bridged, "transaction_id")


def _load_star(spark, sf):
    staged = {
        "users": roles.staging_users(spark, sf),
        "companies": roles.staging_companies(spark, sf),
        "credit_cards": roles.staging_cards(spark, sf),
        "products": roles.staging_products(spark, sf),
        "transactions": roles.staging_baskets(spark, sf),
    }
    files = {
        name: _csv_copy(
            df.select(SCHEMAS[f"staging_{name}"].fieldNames()), name, ";" if name == "transactions" else ","
        )
        for name, df in staged.items()
    }
    return jobs.load_star(spark, files, shared_dir(spark, "star"))


@query
def src3_two_files(spark, sf):
    """Two user files appended into one staging table."""
    columns = SCHEMAS["staging_users"].fieldNames()
    paths = [
        _csv_copy(roles.staging_users_of(spark, sf, region).select(columns), region.lower())
        for region in ("AMERICA", "EUROPE")
    ]
    both = lake.load_users(src.read_csv(spark, paths, "staging_users"))
    return both.select("id", "name", "birth_date", "country", "signup_date")


@query
def src4_csv_inferred(spark, sf):
    path = _csv_copy(roles.table(spark, sf, "part"), "part")
    return src.read_csv(spark, path)


@query
def src5_csv_declared(spark, sf):
    columns = SCHEMAS["companies_raw"].fieldNames()
    path = _csv_copy(roles.staging_companies(spark, sf).select(columns), "companies")
    return lake.clean_companies(src.read_csv(spark, path, "companies_raw"))


@query
def src6_json_documents(spark, sf):
    docs = roles.table(spark, sf, "customer").select(
        F.struct(F.concat(F.lit("id"), "c_custkey").alias("$oid")).alias("_id"),
        F.col("c_name").alias("user_id"),
        F.lit("opaque").alias("jwt"),
    )
    path = shared_dir(spark, "sessions")
    docs.write.json(path)
    return src.read_json_documents(spark, path)


def _lines_with_bad_ones(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Customers as CSV lines, some of which are cut short, too long, or have a word for a number."""
    customer = roles.table(spark, sf, "customer")
    plain = F.concat_ws(",", "c_custkey", "c_name", "c_nationkey")
    line = (
        F.when(F.col("c_custkey") % 7 == 1, F.concat_ws(",", "c_custkey", "c_name"))
        .when(F.col("c_custkey") % 7 == 2, F.concat_ws(",", plain, F.lit("more")))
        .when(F.col("c_custkey") % 7 == 3, F.concat_ws(",", F.lit("none"), "c_name", "c_nationkey"))
        .otherwise(plain)
    )
    path = shared_dir(spark, "bad_lines")
    customer.select(line.alias("value")).write.text(path)
    return src.read_csv_lines(spark, path, "id bigint, name string, nation int", header=False)


@query
def src1_lines_kept(spark, sf):
    """Rows of a load in which some lines do not fit."""
    return _lines_with_bad_ones(spark, sf)[0]


@query
def src1_rejected_lines(spark, sf):
    """The lines that did not fit, as they are in their file."""
    return _lines_with_bad_ones(spark, sf)[1].select("line")


@query
def src4_external_inferred(spark, sf):
    """A catalog table over CSV files, with the types that their values have."""
    orders = roles.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_day"), "o_orderstatus", (F.col("o_custkey") * 10_000_000_000).alias("o_long"))
    path = _csv_copy(orders, "inferred")
    table = src.external_csv_table(spark, "cardamom_inferred", path)
    kinds = F.lit(", ".join(f.dataType.simpleString() for f in table.schema.fields))
    return table.withColumn("kinds", kinds)


@query
def src7_tsv_league(spark, sf):
    path = _csv_copy(roles.matches(spark, sf), "matches", sep="\t", header=False)
    return league.league_table(src.read_tsv_matches(spark, path))


@query
def src8_pipe_lines(spark, sf):
    return src.read_pipe_lines(roles.symptom_lines(spark, sf))


@query
def src10_records(spark, sf):
    """Records given in the code, with a declared schema, looked up in a table."""
    wanted = src.records(spark, [{"r_name": "ASIA", "note": "x"}, {"r_name": "EUROPE", "note": None}], "r_name string, note string")
    return roles.table(spark, sf, "region").join(wanted, "r_name").select("r_regionkey", "r_name", "note")


@query
def src11_external_table(spark, sf):
    """A catalog table over CSV files that stay where they are."""
    customer = roles.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = _csv_copy(customer, "external")
    return src.external_csv_table(spark, "cardamom_external", path, "c_custkey bigint, c_name string, c_nationkey int")


@query
def srt7_preview(spark, sf):
    """Any ten orders: how many came, and how many of them are orders."""
    orders = roles.orders_as_transactions(spark, sf)
    some = op.preview(orders, 10)
    known = op.keep_matching(some, orders, "transaction_id", unique=True)
    return op.row_count_check({"preview": known}, {"preview": 10})


@query
def dml8_namespace(spark, sf):
    """A namespace, created twice without harm, and a table in it."""
    for _ in range(2):
        src.create_namespace(spark, "cardamom_layer")
    nations = roles.table(spark, sf, "nation")
    return src.create_table_as(nations, "cardamom_layer.nations", shared_dir(spark, "nations"))


@query
def snk1_create_table(spark, sf):
    """Create-or-replace a catalog table from a query, then read it."""
    return src.create_table_as(
        _list_text(_clean(spark, sf)), "cardamom_tx_clean", shared_dir(spark, "tx_clean")
    )


@query
def snk2_native_copy(spark, sf):
    """CSV source copied to parquet; only the id is read back."""
    path = _csv_copy(roles.raw_transactions(spark, sf), "raw")
    copy = src.write_parquet(src.read_csv(spark, path), shared_dir(spark, "native"))
    return copy.select("id")


@query
def snk3_insert_select(spark, sf):
    """An empty typed table filled by an insert that casts to its columns."""
    path = shared_dir(spark, "card_status")
    op.create_empty(spark, SCHEMAS["card_status"]).write.parquet(path)
    src.append_rows(p15_card_status(spark, sf), path)
    return spark.read.schema(SCHEMAS["card_status"]).parquet(path)


@query
def snk5_ranking_export(spark, sf):
    path = shared_dir(spark, "ranking")
    ranking = baskets.sales_ranking(_clean(spark, sf), _products(spark, sf))
    src.export_csv(ranking, path, [F.col("total_sold").desc(), F.col("product_id")])
    schema = "product_id bigint, name string, price double, total_sold bigint, colour string"
    return src.read_export(spark, path, schema)
