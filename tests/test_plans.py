"""What the physical plans must and must not contain."""

import pytest

from cardamom.workload.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
# One task over a bounded input: a global total, a count, or one row per day.
SINGLE = {
    "p02_n_countries",
    "p05_above_avg",
    "p06_global_avg",
    "p06_subcent_mean",
    "p20_recent_random",
    "srt7_preview",
    "p15c_active_count",
    "p23_day_over_day",
    "p26_flat_tax",  # sketches of the frequent keys, one for each task
    "p28_report",
    "p31_findings",
    "dq4_row_count",
    "dq_key_report",
}
# These write files while the plan is built, which the other tests cover.
LAZY = sorted(
    k for k in QUERIES if not k.startswith(("src", "snk", "vw")) or k == "src8_pipe_lines"
)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_product_join_no_python_no_funnel(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in text
    objects = [line for line in text.splitlines() if "ObjectHashAggregate" in line]
    assert all("keys=[], functions=[" in line and "approx_top_k" in line for line in objects)
    if name not in SINGLE:
        assert "SinglePartition" not in text


@pytest.mark.parametrize(
    ("name", "parts"),
    [
        ("p11y_top_days_year", ["GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)", "LessThan(o_orderdate,1998-01-01T00:00)"]),
        ("p19_country_day", ["GreaterThanOrEqual(o_orderdate,1997-05-28T00:00)", "EqualTo(n_name,NATION_7)"]),
        ("p12_range_dates", ["GreaterThanOrEqual(o_totalprice,100000.0)", "LessThan(o_orderdate,1998-07-21T00:00)"]),
        ("flt2_point_lookup", ["EqualTo(o_orderkey,7)"]),
    ],
)
def test_filters_reach_the_scan(spark, name, parts):
    text = plan(QUERIES[name](spark, SF_DIR))
    for part in parts:
        assert part in text


@pytest.mark.parametrize(
    ("name", "schema"),
    [
        ("p06_global_avg", "struct<o_orderstatus:string,o_totalprice:double>"),
        ("p15_card_status", "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>"),
        ("p16_units_per_product", "struct<l_partkey:bigint>"),
    ],
)
def test_scans_read_only_needed_columns(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["p15_card_status", "p25_third_purchase"])
def test_hot_keys_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    exchange = text.index("Exchange hashpartitioning")
    assert "Partial" in text[exchange:]
    assert "WindowGroupLimit" in text[exchange:]


def test_list_text_is_parsed_once(spark):
    assert plan(QUERIES["p18_sales_ranking"](spark, SF_DIR)).count("split(") == 1


def test_only_bounded_sides_are_hinted(spark):
    """A broadcast hint appears where a bound on its size is known: a row per range, or fewer than a hundred keys."""
    for name in LAZY:
        logical = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().logical().toString()
        hinted = "strategy=broadcast" in logical
        assert hinted == (name in ("p28_report", "p26_flat_tax")), name
