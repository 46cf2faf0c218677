"""Parameters that bind the generic plans to the fixture views.

The plans take every column name and list as a parameter; this module holds
the values used when they run over ``products_fx`` / ``prices_fx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.operators.align import align_prices, summarise_prices
from larder.plans.audits import aligned_metrics, row_metrics
from larder.plans.products import ProductSpec, build_products, select_allow_lists
from larder.sources.fixtures import FIXTURE_COUNTRY_CODES, load_fixtures, whole_rows
from larder.sources.io import observed, stage

# Fixed values for the fixture run: "nation_0" plays the catch-all country
# tag that the reference excludes ("en:world"), so the exclusion is exercised.
FIXTURE_SPEC = ProductSpec(
    exclude_countries=("nation_0",),
    country_codes=FIXTURE_COUNTRY_CODES,
    order_by=("src_seq",),
)


def _staged(df: DataFrame, name: str, metrics: dict, known: dict[str, int] | None) -> DataFrame:
    """``df`` written and read back; with ``known``, its metrics are taken
    while it is written."""
    if known is None:
        return stage(df, name)
    df, seen = observed(df, metrics)
    out = stage(df, name)
    known.update(seen.get)
    return out


def fixture_products_main(spark: SparkSession, sf_dir: str, materialize: bool = True,
                          known: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products_fx, prices_fx, products_main) for one scale-factor dir.

    ``products_main`` is written and read back (the reference sinks it too):
    every later stage reads the table instead of re-running the filter,
    the allow-list selection and the nested extraction."""
    raw, prices = load_fixtures(spark, sf_dir)
    rows = whole_rows(raw)
    countries, categories = select_allow_lists(rows, FIXTURE_SPEC)
    products = build_products(rows, countries, categories, FIXTURE_SPEC)
    if materialize:
        products = _staged(products, "products-main", row_metrics("product_rows"), known)
    return raw, prices, products


def fixture_prices(spark: SparkSession, sf_dir: str, materialize: bool = True,
                   stage_summary: bool = True, known: dict[str, int] | None = None, stage_aligned: bool = True):
    """(products_fx, prices_fx, products_main, prices_aligned, summary); the
    aligned table is written once and the summary reads the written copy, so
    the join is not evaluated twice.  ``stage_summary=False`` leaves the
    summary as a plan (for a caller that reads it once), ``stage_aligned=False``
    the aligned table (for one that reads nothing but the summary or a few of its
    columns, which then are all that the join carries).  ``known`` is filled
    with the counts of the written tables."""
    raw, prices, products = fixture_products_main(spark, sf_dir, materialize, known)
    aligned = align_prices(prices, products)
    if materialize and stage_aligned:
        aligned = _staged(aligned, "prices-aligned", aligned_metrics(), known)
    summary = summarise_prices(aligned, from_rows=not stage_aligned)
    if materialize and stage_summary:
        summary = _staged(summary, "price-summary", row_metrics("price_summary_rows"), known)
    return raw, prices, products, aligned, summary
