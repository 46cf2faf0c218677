"""Plan checks (survey section 5.2, "Scale"): what the physical plans of the
registered queries may and may not contain."""

import collections
import re

import pytest

from paths import SF_SMALL
from pyspark.sql import functions as F

from larder.operators.align import price_counts, summarise_prices
from larder.operators.dedup import first_of_each, keep_first
from larder.operators.peers import percentile_table
from larder.plans.audits import alignment_counters, preprocess_counters
from larder.plans.fixture_spec import FIXTURE_SPEC, fixture_prices
from larder.plans.products import build_products
from larder.registry import REGISTRY
from larder.sources.fixtures import load_fixtures, whole_rows
from larder.sources.io import stage

SOURCE = re.compile(r"Location: InMemoryFileIndex\([0-9]+ paths\)\[file:[^\],]*/([a-z_]+)\.parquet")


def _plan(df, run=False):
    if run:
        df.write.mode("overwrite").format("noop").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["products_analysis", "price_summary", "robust_z"])
def test_plans_have_no_whole_group_step(spark, name):
    plan = _plan(REGISTRY[name](spark, SF_SMALL))
    assert "SinglePartition" not in plan
    assert not re.search(r"\b(percentile|median)\(", plan)


def _folders(df):
    """Names of the written tables that a DataFrame reads."""
    return {re.sub(r"-[0-9a-f]{12}$", "", f.split("/")[-2]) for f in df.inputFiles()}


def test_profiles_read_their_frequency_table_only(spark):
    # min, mean, max and quantiles all come from the table that one scan made
    for name in ("numeric_profile", "price_summary", "price_currency_medians"):
        assert _folders(REGISTRY[name](spark, SF_SMALL)) == {"stage-freq"}, name


def test_price_summary_is_one_shuffle_of_the_aligned_rows(spark):
    aligned = fixture_prices(spark, SF_SMALL, stage_summary=False)[3]
    assert _plan(price_counts(aligned)).count("Exchange") == 1
    plan = _plan(summarise_prices(aligned))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_summary_read_once_writes_no_rows(spark):
    products, aligned, summary = fixture_prices(spark, SF_SMALL, stage_summary=False, stage_aligned=False)[2:]
    assert not _folders(summary) & {"stage-prices-aligned", "stage-freq"}
    # one exchange by product serves the summary and the choice of one row per product
    assert _plan(summary, run=True).count("REPARTITION_BY_COL") >= 1
    written = fixture_prices(spark, SF_SMALL)[4]
    assert sorted(map(tuple, summary.collect()), key=str) == sorted(map(tuple, written.collect()), key=str)


def test_summary_of_rows_is_the_summary_of_their_counts(spark):
    import datetime
    days = [None, datetime.date(2020, 1, 2), datetime.date(2021, 1, 2)]
    rows = [(i // 3, f"p{i % 4}" if i % 11 else None, "t" if i % 5 else None, "c", "g", f"N{i % 2}" if i % 7 else None,
             "E" if i % 3 else None, None if i % 13 == 0 else float(i % 6), None if i % 4 == 0 else i % 8 == 1, days[i % 3])
            for i in range(200)] + [(None, "alone", "t", "c", "g", "N1", "E", None, None, None)] * 2
    df = spark.createDataFrame(rows, "id long, product_code string, analysis_country_tag string, "
                               "analysis_country_code string, analysis_category_tag string, "
                               "location_osm_address_country_code string, currency string, price_value double, "
                               "same_market_as_analysis_country boolean, date date")
    want = sorted(map(tuple, summarise_prices(df).collect()), key=str)
    for limit in (None, 60, 2):
        got = summarise_prices(df, range_rows=limit, from_rows=True)
        assert sorted(map(tuple, got.collect()), key=str) == want, limit


def test_counters_scan_no_table_that_was_just_written(spark):
    known = {}
    raw, _, products, aligned, summary = fixture_prices(spark, SF_SMALL, known=known)
    assert _folders(alignment_counters(products, aligned, summary, known)) == {"stage-price-summary"}
    assert _folders(preprocess_counters(raw, products, summary, known)) == {"stage-price-summary"}
    assert alignment_counters(products, aligned, summary).collect() == alignment_counters(
        products, aligned, summary, known).collect()
    assert known["product_rows"] == products.count() and known["price_summary_rows"] == summary.count()


def test_unique_rows_pass_keep_first_untouched(spark):
    rows = [(k % 90 if k < 100 else k, k, f"t{k}") for k in range(300)] + [(None, 400, "x"), (None, 401, "y")]
    df = stage(spark.createDataFrame(rows, "code long, seq long, t string"), "rows")
    out = keep_first(df, ["code"], ["seq"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, first_of_each(df, ["code"], ["seq"]).collect()),
                                                                key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the first child of the union: rows of unique keys, told by an aggregate of the keys alone
    unique = "\n".join(x for x in plan.split("\n") if x.startswith(":"))
    assert "LeftAnti" in unique and "min_by" not in unique and plan.count("min_by") == 1, plan


def test_coverage_audit_is_one_scan_per_table(spark):
    plan = _plan(REGISTRY["field_coverage"](spark, SF_SMALL))
    assert collections.Counter(SOURCE.findall(plan)) == {"part": 1, "lineitem": 1}


def test_readiness_takes_counts_and_codes_in_one_scan_each(spark):
    plan = _plan(REGISTRY["task_readiness"](spark, SF_SMALL))
    assert collections.Counter(SOURCE.findall(plan)) == {"part": 2, "lineitem": 2}
    assert "Expand" not in plan


def test_presence_tests_stay_in_codegen(spark):
    raw, _ = load_fixtures(spark, SF_SMALL)
    for df in (REGISTRY["filter_ladder"](spark, SF_SMALL),
               build_products(raw, ["nation_1"], ["size-1"], FIXTURE_SPEC, dedup=False)):
        assert "exists(" not in _plan(df)


def test_named_values_share_one_list_pass(spark):
    raw, _ = load_fixtures(spark, SF_SMALL)
    plan = _plan(build_products(raw, ["nation_1"], ["size-1"], FIXTURE_SPEC, dedup=False))
    assert plan.count("filter(") == 1, plan.count("filter(")


def test_catalogue_columns_are_made_once_for_each_row(spark):
    rows = whole_rows(load_fixtures(spark, SF_SMALL)[0])
    plan = build_products(rows, ["nation_1"], ["size-1"], FIXTURE_SPEC, dedup=False)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("struct(name, carbohydrates, 100g") == 1


def test_ranks_take_one_window(spark):
    rows = stage(spark.createDataFrame([(i, i % 2, float(i % 5)) for i in range(20)], "code long, g long, x double"), "r",
                 count=True)
    table = percentile_table(rows, {"x": F.col("x"), "y": -F.col("x")}, ["g"])
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1, plan


def test_analysis_writes_its_wide_rows_once(spark):
    table = REGISTRY["products_analysis"](spark, SF_SMALL)
    assert {"stage-analysis-base", "stage-analysis-percentiles", "stage-analysis-score-pct"} <= _folders(table)
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(table.select("code", "price_nutrition_value_index")))
    assert read and not any("..." in r or "product_name" in r or "fiber_100g" in r for r in read), read
