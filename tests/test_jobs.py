"""Whole jobs (J1-J7) on the smallest tables: the reference's published
invariants, plus metamorphic checks (partition count must not matter)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from larder.functions import predicates as P
from larder.plans import audits as J
from larder.plans.analysis import build_analysis
from larder.plans.fixture_spec import FIXTURE_SPEC, fixture_prices
from larder.plans.products import select_allow_lists
from larder.sources.io import write_report

from paths import SF_SMALL


@pytest.fixture(scope="module")
def chain(spark):
    return fixture_prices(spark, SF_SMALL)


def test_ladder_is_nested(spark, chain):
    raw, prices, *_ = chain
    ladder = {r.level: r for r in J.audit_filters(raw, prices)["ladder"].collect()}
    order = ["base_identity_geo_category", "core_nutrition_ready", "broad_health_ready",
             "full_health_ready", "brand_full_health_ready", "strict_quality_ready",
             "full_nutrient_detail_ready"]
    counts = [ladder[n]["count"] for n in order]
    assert counts == sorted(counts, reverse=True)
    assert ladder["base_with_any_nutriments"]["count"] <= ladder["base_identity_geo_category"]["count"]
    for r in ladder.values():
        assert r.price_matched_count <= r["count"]


def test_attribution_sums_to_table(spark, chain):
    raw, _, products, _, _ = chain
    n = products.count()
    for col in ("analysis_country_tag", "analysis_category_tag"):
        assert products.groupBy(col).count().agg(F.sum("count")).first()[0] == n
    assert products.select("code").distinct().count() == n
    countries, categories = select_allow_lists(raw, FIXTURE_SPEC)
    assert products.filter(~F.col("analysis_country_tag").isin(countries)).count() == 0
    assert products.filter(~F.col("analysis_category_tag").isin(categories)).count() == 0


def test_alignment_invariants(spark, chain):
    _, _, products, aligned, summary = chain
    c = J.alignment_counters(products, aligned, summary).first()
    assert c.aligned_price_rows >= c.same_market_rows >= c.same_market_non_null_currency_rows
    assert c.price_summary_rows >= c.unique_products_with_price
    assert summary.agg(F.sum("price_record_count")).first()[0] == c.aligned_price_rows


def test_analysis_invariants(spark, chain):
    _, _, products, _, summary = chain
    an = build_analysis(products, summary)
    assert an.count() == an.select("code").distinct().count() == products.count()
    pcts = [c for c in an.columns if c.endswith("_percentile")]
    for c in pcts:
        bad = an.filter(F.col(c).isNotNull() & ((F.col(c) <= 0) | (F.col(c) > 1))).count()
        assert bad == 0, c
    for c in ("health_score_composite", "data_completeness_score"):
        assert an.filter((F.col(c) < 0) | (F.col(c) > 1)).count() == 0
    # pct(x) + pct(-x) = (n_nonnull + 1) / n_all within each peer group
    keys = ["analysis_country_tag", "analysis_category_tag"]
    g = an.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("sugars_100g").alias("nn"))
    j = an.join(g, on=keys).filter(F.col("sugars_100g").isNotNull())
    diff = j.select(F.abs(F.col("sugars_percentile") + F.col("sugars_good_percentile")
                          - (F.col("nn") + 1) / F.col("n")).alias("d")).agg(F.max("d")).first()[0]
    assert diff < 1e-12


def test_partition_count_does_not_matter(spark, chain):
    _, _, products, _, summary = chain
    cols = ["code", "sugars_percentile", "price_median_percentile", "peer_anomaly_score"]
    base = sorted(build_analysis(products, summary).select(*cols).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        again = sorted(build_analysis(products, summary).select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == again


def test_audit_jobs_write_reports(spark, chain):
    raw, prices, products, aligned, summary = chain
    countries, categories = select_allow_lists(raw, FIXTURE_SPEC)
    tables = {**J.audit_datasets(raw, prices),
              **J.audit_alignment(raw, products, aligned, summary,
                                  {"analysis_country_tag": countries, "analysis_category_tag": categories})}
    out = tempfile.mkdtemp(prefix="larder-report-")
    write_report(tables, out)
    for name in tables:
        assert os.path.isdir(os.path.join(out, name))
    req = {(r.group, r.field): r.present for r in tables["product_required_fields"].collect()}
    assert req[("identity", "code")] and not req[("geography", "main_countries_tags")]
    sel = tables["selected_tags"].collect()
    assert sum(r.rows for r in sel if r.column == "analysis_country_tag") == products.count()


def test_file_jobs_end_to_end(spark):
    from larder.plans import jobs
    from larder.sources.fixtures import load_fixtures
    raw, prices = load_fixtures(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-jobs-")
    cat, pr = os.path.join(root, "catalogue"), os.path.join(root, "prices")
    raw.write.parquet(cat)
    prices.write.parquet(pr)
    out = jobs.preprocess(spark, cat, pr, os.path.join(root, "pre"), FIXTURE_SPEC)
    n = out.products_main.count()
    assert n > 0 and out.price_summary.count() > 0
    an = jobs.analysis_table(spark, os.path.join(root, "pre", "products_main"),
                             os.path.join(root, "pre", "price_summary_by_product"),
                             os.path.join(root, "analysis"))
    assert an.count() == n and len(an.columns) == 69
    jobs.export_analysis_csv(spark, os.path.join(root, "analysis"), os.path.join(root, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(root, "csv")).count() == n
    audit = jobs.dataset_audit(spark, cat, pr, os.path.join(root, "audit"))
    assert audit["join_coverage"].count() == 1
    fa = jobs.filter_audit(spark, cat, pr, os.path.join(root, "filters"))
    assert fa["ladder"].count() == 8
    # the narrow read keeps only name and 100g of the nutriment structs
    assert "src_seq" not in jobs.read_catalogue(spark, cat).columns
