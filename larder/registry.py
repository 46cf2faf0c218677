"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the survey, each over the whole given tables.

Every query reads ``part`` / ``lineitem`` through the fixture views, runs
the library's operators and returns a DataFrame with aliased columns that
match ``larder.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import nested as N
from larder.functions import predicates as P
from larder.functions import scalars as S
from larder.plans.fixture_spec import FIXTURE_SPEC, fixture_prices, fixture_products_main
from larder.sources.fixtures import load_fixtures

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


@query("price_summary")
def q_price_summary(spark, sf_dir):
    """B13, B17, D1, E1 (J2 -> J3)."""
    return fixture_prices(spark, sf_dir, stage_summary=False)[4]


@query("prices_aligned")
def q_prices_aligned(spark, sf_dir):
    """Every aligned price row, all 31 columns."""
    return fixture_prices(spark, sf_dir, stage_summary=False)[3]


@query("products_main")
def q_products_main(spark, sf_dir):
    """J1 (B10, B11, G4, C1-C12, G7)."""
    return fixture_products_main(spark, sf_dir, materialize=False)[2]


@query("nested_extract")
def q_nested_extract(spark, sf_dir):
    """C1-C6 over every catalogue row (no filter)."""
    raw, _ = load_fixtures(spark, sf_dir)
    allowed = ["nation_1", "nation_3", "nation_7"]
    return raw.withColumn("_valued", N.with_values("nutriments")).select(
        "code", "src_seq",
        N.named_value("_valued", "fat").alias("fat_100g"),
        N.named_value("_valued", "sodium").alias("sodium_100g"),
        N.first_match("countries_tags", allowed).alias("first_country"),
        N.last_match("countries_tags", allowed).alias("last_country"),
        N.first_text("product_name").alias("first_name"),
        N.first_tag("brands_tags").alias("first_brand"),
        N.size_or_zero("labels_tags").alias("labels_count"),
        N.size_or_zero("data_quality_errors_tags").alias("error_count"),
    )


# ----------------------------------------------------------------- helpers

from larder.operators import audit as A  # noqa: E402
from larder.operators import rollups as R  # noqa: E402
from larder.operators import scores as SC  # noqa: E402
from larder.operators.align import align_prices  # noqa: E402
from larder.operators.dedup import keep_first  # noqa: E402
from larder.operators.ladder import ladder_counts, level_profile  # noqa: E402
from larder.operators.peers import peer_percentiles, robust_z  # noqa: E402
from larder.plans import audits as J  # noqa: E402
from larder.plans.analysis import AnalysisSpec, base_table, build_analysis, primary_price  # noqa: E402
from larder.plans.products import select_allow_lists  # noqa: E402
from larder.sources.fixtures import FIXTURE_COUNTRY_CODES  # noqa: E402
from larder.sources.io import stage  # noqa: E402


def _summary(spark, sf_dir):
    return fixture_prices(spark, sf_dir)


def _summary_once(spark, sf_dir):
    """Products and their price summary, which is read once: neither it nor
    the aligned rows are written."""
    _, _, products, _, summary = fixture_prices(spark, sf_dir, stage_summary=False, stage_aligned=False)
    return products, summary


def _analysis(spark, sf_dir, spec: AnalysisSpec = AnalysisSpec(), reused: bool = False):
    """The analysis table; written once when the caller reads it more than
    once (roll-ups with several aggregates over it)."""
    products, summary = _summary_once(spark, sf_dir)
    an = build_analysis(products, summary, spec)
    return stage(an, "analysis") if reused else an


def _base(spark, sf_dir):
    """The base table, written once: the statistics read it several times."""
    products, summary = _summary_once(spark, sf_dir)
    return stage(base_table(products, summary), "base", count=True)


def _tagged(df, **cols):
    return df.select(*[F.lit(v).alias(k) for k, v in cols.items()], "*")


# ----------------------------------------------------------------- audits

@query("field_coverage")
def q_field_coverage(spark, sf_dir):
    """B1, B2, E2 over both datasets (absent fields skipped)."""
    raw, prices = load_fixtures(spark, sf_dir)
    return A.stack_metrics([
        _tagged(A.field_coverage(raw, J.PRODUCT_CORE_FIELDS), dataset="products"),
        _tagged(A.field_coverage(prices, J.PRICE_CORE_FIELDS), dataset="prices")])


@query("named_entry_coverage")
def q_named_entry_coverage(spark, sf_dir):
    """B3, E3."""
    raw, _ = load_fixtures(spark, sf_dir)
    return A.named_entry_coverage(raw, J.NUTRIENTS_OF_INTEREST)


@query("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    """Min, exact median, mean, nearest-rank p95/p99, max."""
    raw, prices = load_fixtures(spark, sf_dir)
    return A.stack_metrics([
        _tagged(A.numeric_profile(raw, J.PRODUCT_NUMERIC), dataset="products"),
        _tagged(A.numeric_profile(prices, J.PRICE_NUMERIC), dataset="prices")])


@query("derived_quality")
def q_derived_quality(spark, sf_dir):
    """B15, B16, E5, E6."""
    raw, prices = load_fixtures(spark, sf_dir)
    return J.derived_quality(raw, prices)


@query("date_profile")
def q_date_profile(spark, sf_dir):
    """E7."""
    _, prices = load_fixtures(spark, sf_dir)
    return A.date_profile(prices, "date")


@query("join_coverage")
def q_join_coverage(spark, sf_dir):
    """D4, D5, E14, H1."""
    raw, prices = load_fixtures(spark, sf_dir)
    return A.join_coverage(raw, prices)


@query("top_array_values")
def q_top_array_values(spark, sf_dir):
    """G1: top-20 tags (null elements dropped) of the strict level."""
    raw, _ = load_fixtures(spark, sf_dir)
    strict = raw.filter(P.filter_ladder(raw.schema)["strict_quality_ready"])
    return J.top_table(strict, J.PRODUCT_TOP_LISTS, 20, explode=True)


@query("top_array_values_nullkeep")
def q_top_array_values_nullkeep(spark, sf_dir):
    """Top-20 tags with null elements kept, whole catalogue."""
    raw, _ = load_fixtures(spark, sf_dir)
    return J.top_table(raw, J.PRODUCT_TOP_LISTS, 20, explode=True, keep_null=True)


@query("top_scalar_values")
def q_top_scalar_values(spark, sf_dir):
    """Top-20 non-null values of scalar columns of both datasets."""
    raw, prices = load_fixtures(spark, sf_dir)
    return A.stack_metrics([
        _tagged(J.top_table(raw, J.PRODUCT_TOP_SCALARS, 20, explode=False), dataset="products"),
        _tagged(J.top_table(prices, J.PRICE_TOP_SCALARS, 20, explode=False), dataset="prices")])


@query("allow_list_selection")
def q_allow_list_selection(spark, sf_dir):
    """Top countries (exclusion applied) and categories among the
    rows passing the product filter."""
    raw, _ = load_fixtures(spark, sf_dir)
    where = P.product_filter(raw.schema)
    spec = FIXTURE_SPEC
    return A.top_values_multi(raw, {spec.country_col: (spec.top_countries, spec.exclude_countries),
                                    spec.category_col: (spec.top_categories, spec.exclude_categories)},
                              explode=True, where=where)


@query("filter_ladder")
def q_filter_ladder(spark, sf_dir):
    """Eight levels in one pass with price matches."""
    raw, prices = load_fixtures(spark, sf_dir)
    return ladder_counts(raw, prices, P.filter_ladder(raw.schema))


@query("level_profile")
def q_level_profile(spark, sf_dir):
    """E9 of the strict level."""
    raw, _ = load_fixtures(spark, sf_dir)
    return level_profile(raw, P.filter_ladder(raw.schema)["strict_quality_ready"])


@query("value_distribution")
def q_value_distribution(spark, sf_dir):
    """Value counts (null kept) of six columns across the outputs."""
    raw, _, products, aligned, _ = _summary(spark, sf_dir)
    strict = raw.filter(P.filter_ladder(raw.schema)["strict_quality_ready"])
    parts = [
        (strict, "strict", "nutriscore_grade"), (strict, "strict", "nova_group"),
        (products, "products_main", "analysis_country_tag"),
        (products, "products_main", "analysis_category_tag"),
        (aligned, "prices_aligned", "currency"),
        (aligned, "prices_aligned", "location_osm_address_country_code"),
    ]
    return A.stack_metrics([
        A.value_distribution(df, col).select(F.lit(src).alias("source"), F.lit(col).alias("column"),
                                             F.col("value").cast("string").alias("value"), "count")
        for df, src, col in parts])


@query("price_currency_medians")
def q_price_currency_medians(spark, sf_dir):
    """E11."""
    _, prices, products = fixture_products_main(spark, sf_dir)
    return R.currency_medians(align_prices(prices, products))


@query("alignment_counters")
def q_alignment_counters(spark, sf_dir):
    """B14, E12."""
    known: dict[str, int] = {}
    _, _, products, aligned, summary = fixture_prices(spark, sf_dir, known=known)
    return J.alignment_counters(products, aligned, summary, known)


@query("preprocess_counters")
def q_preprocess_counters(spark, sf_dir):
    """E13 (counters)."""
    known: dict[str, int] = {}
    raw, _, products, _, summary = fixture_prices(spark, sf_dir, known=known)
    return J.preprocess_counters(raw, products, summary, known)


@query("selected_tag_counts")
def q_selected_tag_counts(spark, sf_dir):
    """E13 (selected tags with attributed rows, missing -> 0)."""
    raw, _ = load_fixtures(spark, sf_dir)
    countries, categories = select_allow_lists(raw, FIXTURE_SPEC)
    _, _, products = fixture_products_main(spark, sf_dir)
    return J.selected_tag_counts(products, {"analysis_country_tag": countries,
                                            "analysis_category_tag": categories})


@query("schema_required")
def q_schema_required(spark, sf_dir):
    """A3: required-field spec against both fixture tables (presence in the
    schema and non-null rows)."""
    raw, prices = load_fixtures(spark, sf_dir)
    return A.stack_metrics([
        _tagged(A.required_field_matrix(raw, J.PRODUCT_REQUIRED), dataset="products"),
        _tagged(A.required_field_matrix(prices, J.PRICE_REQUIRED), dataset="prices")])


@query("schema_columns")
def q_schema_columns(spark, sf_dir):
    """A2 (engine-neutral part): column names in schema order with the row
    count and each column's non-null count."""
    raw, prices = load_fixtures(spark, sf_dir)
    cols = ["position", "column", "rows", "non_null_rows"]
    return A.stack_metrics([
        _tagged(A.schema_profile(raw).select(*cols), dataset="products"),
        _tagged(A.schema_profile(prices).select(*cols), dataset="prices")])


# ------------------------------------------------------- row-level scalars

@query("energy_fallback")
def q_energy_fallback(spark, sf_dir):
    """C9, C10 over every catalogue row."""
    raw, _ = load_fixtures(spark, sf_dir)
    raw = raw.withColumn("_valued", N.with_values("nutriments"))
    x = raw.select("code", "src_seq",
                   N.named_value("_valued", "energy-kcal").alias("kcal_raw"),
                   N.named_value("_valued", "energy-kj").alias("kj_raw"),
                   N.named_value("_valued", "energy").alias("energy_raw"))
    return x.withColumns({"energy_kcal_100g": S.energy_kcal("kcal_raw", "kj_raw", "energy_raw"),
                          "energy_kj_100g": S.energy_kj("kcal_raw", "kj_raw", "energy_raw")})


@query("country_code_map")
def q_country_code_map(spark, sf_dir):
    """C11: first country tag -> code through the map, unmapped -> null."""
    raw, _ = load_fixtures(spark, sf_dir)
    x = raw.select("code", "src_seq", N.first_tag("countries_tags").alias("country_tag"))
    return x.withColumn("country_code", S.map_code("country_tag", FIXTURE_COUNTRY_CODES))


@query("present_count")
def q_present_count(spark, sf_dir):
    """C12, C13."""
    raw, _ = load_fixtures(spark, sf_dir)
    names = {"fat_100g": "fat", "saturated_fat_100g": "saturated-fat",
             "carbohydrates_100g": "carbohydrates", "sugars_100g": "sugars",
             "proteins_100g": "proteins", "salt_100g": "salt", "sodium_100g": "sodium",
             "fiber_100g": "fiber"}
    raw = raw.withColumn("_valued", N.with_values("nutriments"))
    x = raw.select("code", "src_seq",
                   N.named_value("_valued", "energy-kcal").alias("energy_kcal_100g"),
                   *[N.named_value("_valued", n).alias(c) for c, n in names.items()])
    cnt = S.count_present(["energy_kcal_100g", "fat_100g", "saturated_fat_100g",
                           "carbohydrates_100g", "sugars_100g", "proteins_100g",
                           ("salt_100g", "sodium_100g"), "fiber_100g"])
    return (x.select("code", "src_seq", cnt.alias("nutrition_fields_present_count"))
            .withColumn("nutrient_field_fill_rate", S.fill_rate("nutrition_fields_present_count")))


@query("clip_safe_div")
def q_clip_safe_div(spark, sf_dir):
    """Safe division, null-preserving clip, |x| with null -> 0,
    weighted sum, exact half-up percentage."""
    raw, _ = load_fixtures(spark, sf_dir)
    x = raw.select(
        "code", "src_seq",
        S.safe_div(F.col("nutriscore_score"), F.col("nova_group") - F.lit(4)).alias("ratio"),
        S.clip(F.col("nutriscore_score") / F.lit(10.0), 0.0, 1.0).alias("clipped"),
        S.pct(N.size_or_zero("labels_tags"), N.size_or_zero("data_quality_warnings_tags"),
              zero=None).alias("labels_per_warning_pct"),
        S.pct(F.col("unique_scans_n"), F.col("scans_n") * F.lit(3)).alias("scan_pct"),
    )
    return x.withColumn("weighted", S.weighted_abs_sum({"ratio": 0.5, "clipped": 0.25}))


@query("dedup_keep_first")
def q_dedup_keep_first(spark, sf_dir):
    """One row per code, the first by src_seq."""
    raw, _ = load_fixtures(spark, sf_dir)
    return keep_first(raw.select("code", "src_seq", "completeness", "brands"), ["code"], ["src_seq"])


@query("primary_price")
def q_primary_price(spark, sf_dir):
    """Top-1 summary row per product."""
    return primary_price(_summary_once(spark, sf_dir)[1])


@query("products_left_price")
def q_products_left_price(spark, sf_dir):
    """Every product with its primary price."""
    return _base(spark, sf_dir).select(
        "code", "currency", "location_osm_address_country_code", "price_median",
        "price_record_count", "has_price", "any_same_market_match", "nutrient_field_fill_rate",
        "has_quality_warning", "has_quality_error", "nova_scaled")


@query("salt_clean_price")
def q_salt_clean_price(spark, sf_dir):
    """C14-C16."""
    return _base(spark, sf_dir).select("code", "salt_equivalent_100g", "price_median_clean",
                                       "nutriscore_good_direction")


# ----------------------------------------------------------------- peers

def peer_measures():
    return {
    "nutriscore_good_percentile": F.col("nutriscore_good_direction"),
    "nova_good_percentile": -F.col("nova_group"),
    "sugars_good_percentile": -F.col("sugars_100g"),
    "salt_good_percentile": -F.col("salt_equivalent_100g"),
    "proteins_good_percentile": F.col("proteins_100g"),
    "sugars_percentile": F.col("sugars_100g"),
    "salt_percentile": F.col("salt_equivalent_100g"),
    "fat_percentile": F.col("fat_100g"),
    "saturated_fat_percentile": F.col("saturated_fat_100g"),
    "energy_percentile": F.col("energy_kcal_100g"),
    "price_percentile_within_peer": F.col("price_median_clean"),
    }


GROUP_KEYS = ["analysis_country_tag", "analysis_category_tag"]


@query("peer_percentiles")
def q_peer_percentiles(spark, sf_dir):
    """eleven average-rank percentiles per peer group."""
    measures = peer_measures()
    base = _base(spark, sf_dir)
    df = peer_percentiles(base, measures, GROUP_KEYS)
    return df.select("code", *measures)


@query("price_percentile")
def q_price_percentile(spark, sf_dir):
    """price percentile on (country code, currency, category)."""
    base = _base(spark, sf_dir)
    df = peer_percentiles(base, {"price_median_percentile": F.col("price_median_clean")},
                          ["analysis_country_code", "currency", "analysis_category_tag"])
    return df.select("code", "price_median_percentile")


@query("robust_z")
def q_robust_z(spark, sf_dir):
    """Robust z of seven measures per peer group."""
    base = _base(spark, sf_dir)
    base = base.withColumn("data_completeness_score", SC.completeness_score())
    measures = {
        "price_robust_z": F.col("price_median_clean"),
        "sugars_robust_z": F.col("sugars_100g"),
        "salt_robust_z": F.col("salt_equivalent_100g"),
        "saturated_fat_robust_z": F.col("saturated_fat_100g"),
        "nutriscore_robust_z": F.col("nutriscore_score"),
        "nova_robust_z": F.col("nova_group").cast("double"),
        "data_completeness_robust_z": F.col("data_completeness_score"),
    }
    return robust_z(base, measures, GROUP_KEYS).select("code", *measures)


@query("completeness_score")
def q_completeness_score(spark, sf_dir):
    """I2, F4."""
    base = _base(spark, sf_dir)
    base = base.withColumn("data_completeness_score", SC.completeness_score())
    df = peer_percentiles(base, {"data_completeness_percentile": F.col("data_completeness_score")},
                          GROUP_KEYS)
    return df.select("code", "data_completeness_score", "data_completeness_percentile")


# -------------------------------------------------------- analysis table

@query("products_analysis")
def q_products_analysis(spark, sf_dir):
    """The 69-column analysis table."""
    return _analysis(spark, sf_dir)


@query("health_score")
def q_health_score(spark, sf_dir):
    """I1, F4."""
    return _analysis(spark, sf_dir).select("code", "health_score_composite", "health_score_percentile")


@query("value_index")
def q_value_index(spark, sf_dir):
    """I3."""
    return _analysis(spark, sf_dir).select("code", "health_score_percentile", "price_median_percentile",
                                           "price_nutrition_value_index")


@query("anomaly_score")
def q_anomaly_score(spark, sf_dir):
    """I4."""
    return _analysis(spark, sf_dir).select("code", "peer_anomaly_score")


@query("flags")
def q_flags(spark, sf_dir):
    """I5-I7."""
    return _analysis(spark, sf_dir).select("code", "flag_high_price_low_health",
                                           "flag_high_sugar_high_nova",
                                           "flag_low_completeness_many_warnings")


@query("analysis_design_variant")
def q_analysis_design_variant(spark, sf_dir):
    """K7: the design-note formulas (1 - nova_scaled, 1 - percentile; value
    index keyed by location country)."""
    df = _analysis(spark, sf_dir, AnalysisSpec(health="design"))
    return df.select("code", "health_score_composite", "price_median_percentile",
                     "price_nutrition_value_index")


# ---------------------------------------------------------------- rollups

@query("brand_concentration")
def q_brand_concentration(spark, sf_dir):
    """K1 on products_main."""
    return R.brand_concentration(fixture_products_main(spark, sf_dir)[2])


@query("brand_shares")
def q_brand_shares(spark, sf_dir):
    """K1 detail: every brand's share of its market."""
    return R.brand_shares(fixture_products_main(spark, sf_dir)[2])


@query("country_overview")
def q_country_overview(spark, sf_dir):
    """K2."""
    return R.country_overview(_analysis(spark, sf_dir))


@query("nutrition_structure")
def q_nutrition_structure(spark, sf_dir):
    """K3 by (country, category) and (country, brand)."""
    return R.nutrition_structure(_analysis(spark, sf_dir))


@query("anomaly_feed")
def q_anomaly_feed(spark, sf_dir):
    """K4: every product of the scatter plot."""
    return R.anomaly_feed(_analysis(spark, sf_dir))


@query("currency_feed")
def q_currency_feed(spark, sf_dir):
    """K5."""
    return R.currency_feed(_analysis(spark, sf_dir))


@query("product_detail")
def q_product_detail(spark, sf_dir):
    """K6: full rows of every flagged product (code list derived by Spark)."""
    an = _analysis(spark, sf_dir, reused=True)
    codes = an.filter(F.col("flag_high_price_low_health") | F.col("flag_high_sugar_high_nova")
                      | F.col("flag_low_completeness_many_warnings")).select("code")
    return R.product_detail(an, codes)


@query("task_readiness")
def q_task_readiness(spark, sf_dir):
    """The audited figures behind each analysis task."""
    raw, prices = load_fixtures(spark, sf_dir)
    return J.task_readiness(raw, prices)


# ------------------------------------------------------------------- jobs
# The jobs read files and write files, so the fixture tables are written first.

from larder.plans import jobs as W  # noqa: E402
from larder.sources import io  # noqa: E402


def _files(spark, sf_dir) -> tuple[str, str]:
    """Paths of the catalogue and the price log as files."""
    raw, prices = load_fixtures(spark, sf_dir)
    paths = io.new_folder(spark, "catalogue"), io.new_folder(spark, "prices")
    io.write_table(raw, paths[0])
    io.write_table(prices, paths[1])
    return paths


@query("job_dataset_audit")
def q_job_dataset_audit(spark, sf_dir):
    """J5 (A2-A4, A7, E2-E7, E14, E16, G2, G3): the whole job from files to
    written reports, with an optional third input that is absent, read back."""
    out = io.new_folder(spark, "dataset-audit")
    tables = W.dataset_audit(spark, *_files(spark, sf_dir), out, optional_path=io.new_folder(spark, "absent"))
    return W.written_report(spark, tables, out, W.DATASET_AUDIT_LAYOUT)


@query("job_filter_audit")
def q_job_filter_audit(spark, sf_dir):
    """J6 (A7, B12, E8-E10, G1): the whole job, its written reports read back."""
    out = io.new_folder(spark, "filter-audit")
    tables = W.filter_audit(spark, *_files(spark, sf_dir), out)
    return W.written_report(spark, tables, out, W.FILTER_AUDIT_LAYOUT)


@query("job_preprocess")
def q_job_preprocess(spark, sf_dir):
    """J1-J3 and J7 (A5, A7, A8, E10-E13): the whole job, its written reports
    read back."""
    out = io.new_folder(spark, "preprocess")
    done = W.preprocess(spark, *_files(spark, sf_dir), out, FIXTURE_SPEC)
    return W.written_report(spark, done.reports, f"{out}/reports/preprocessing", W.PREPROCESSING_LAYOUT)


@query("job_analysis_csv")
def q_job_analysis_csv(spark, sf_dir):
    """Preprocess files, build the analysis table, export it as CSV
    with row numbers in code order, and read the CSV back."""
    base = io.new_folder(spark, "analysis-job")
    W.preprocess(spark, *_files(spark, sf_dir), base, FIXTURE_SPEC)
    table = W.analysis_table(spark, f"{base}/products_main", f"{base}/price_summary_by_product", f"{base}/analysis")
    W.export_analysis_csv(spark, f"{base}/analysis", f"{base}/csv", index=True)
    kinds = ", ".join(["index bigint", *(f"{n} {t}" for n, t in table.dtypes)])
    return (spark.read.schema(kinds).option("header", True).option("escape", '"').csv(f"{base}/csv"))


@query("parquet_round_trip")
def q_parquet_round_trip(spark, sf_dir):
    """A1, A5: products_main written in code order and read with a narrow
    schema."""
    _, _, products = fixture_products_main(spark, sf_dir, materialize=False)
    path = io.new_folder(spark, "round-trip")
    io.write_table(products, path, sort_within=["code"])
    return io.read_table(spark, path, "code string, brands_tags array<string>, fat_100g double, labels_count int",
                         ["code", "brands_tags", "fat_100g", "labels_count"])


@query("row_counts")
def q_row_counts(spark, sf_dir):
    """A4: row counts of both files and of an optional input that is absent."""
    paths = {"products": None, "prices": None, "absent": io.new_folder(spark, "absent")}
    paths["products"], paths["prices"] = _files(spark, sf_dir)
    return A.stack_metrics([_tagged(io.optional_row_count(spark, p), dataset=d) for d, p in paths.items()])
