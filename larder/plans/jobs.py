"""End-to-end jobs over real files: what the reference's scripts do, as
Spark jobs (preprocess, analysis table, dataset audit, filter audit, CSV
export).

Each job reads Parquet with a narrow schema (only the columns it uses; the
nutriment structs trimmed to ``name`` and ``100g``), writes its tables to
the given output folder and returns the written tables' DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from larder.operators.align import align_prices, summarise_prices
from larder.plans import audits as J
from larder.plans.analysis import AnalysisSpec, build_analysis
from larder.plans.products import ProductSpec, build_products, select_allow_lists
from larder.sources import io

# Columns of the raw catalogue read by the jobs, and the struct fields kept
# of each list-of-struct column.
CATALOGUE_COLUMNS = [
    "code", "product_name", "brands", "brands_tags", "countries_tags", "categories_tags",
    "food_groups_tags", "ingredients_text", "nutriscore_grade", "nutriscore_score", "nova_group",
    "completeness", "labels_tags", "data_quality_warnings_tags", "data_quality_errors_tags",
    "scans_n", "unique_scans_n", "nutriments",
]
NARROW_STRUCTS = {"nutriments": ("name", "100g")}


def catalogue_schema(available: StructType, extra: tuple[str, ...] = (),
                     columns: Sequence[str] = CATALOGUE_COLUMNS,
                     structs: Mapping[str, Sequence[str]] = NARROW_STRUCTS) -> StructType:
    """The narrow read schema: the needed columns (plus ``extra``, e.g. the
    dedup order columns) with the file's own types, list-of-struct columns
    trimmed to the fields that are read; columns absent from the file are
    skipped (as the reference's audits do)."""
    fields = []
    for name in dict.fromkeys([*columns, *extra]):
        if name not in available.fieldNames():
            continue
        f = available[name]
        keep = structs.get(name)
        if keep and isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
            elem = StructType([e for e in f.dataType.elementType.fields if e.name in keep])
            f = StructField(f.name, ArrayType(elem, f.dataType.containsNull), f.nullable)
        fields.append(f)
    return StructType(fields)


def read_catalogue(spark: SparkSession, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A1 for the catalogue: narrow nested read (``ReadSchema`` holds only
    the needed columns and struct fields)."""
    available = spark.read.parquet(path).schema
    return io.read_table(spark, path, schema=catalogue_schema(available, tuple(extra)))


@dataclass(frozen=True)
class PreprocessOutputs:
    products_main: DataFrame
    prices_aligned: DataFrame
    price_summary: DataFrame
    reports: dict[str, DataFrame]


def preprocess(spark: SparkSession, catalogue_path: str, prices_path: str, out_dir: str,
               spec: ProductSpec = ProductSpec()) -> PreprocessOutputs:
    """J1 -> J2 -> J3 (+ J7 reports).  Each table is written and the next
    stage reads the written copy (the summary reads the aligned table, so
    the join runs once).  What the reports count of them is counted while they
    are written."""
    out = out_dir.rstrip("/")
    known: dict[str, int] = {}

    def written(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> DataFrame:
        df, seen = io.observed(df, metrics)
        io.write_table(df, f"{out}/{name}")
        known.update(seen.get)
        return spark.read.parquet(f"{out}/{name}")

    raw = read_catalogue(spark, catalogue_path, tuple(spec.order_by))
    prices = spark.read.parquet(prices_path)
    countries, categories = select_allow_lists(raw, spec)
    products = written(build_products(raw, countries, categories, spec), "products_main", J.row_metrics("product_rows"))
    aligned = written(align_prices(prices, products), "prices_aligned", J.aligned_metrics())
    summary = written(summarise_prices(aligned, from_rows=True), "price_summary_by_product", J.row_metrics("price_summary_rows"))
    reports = J.audit_alignment(raw, products, aligned, summary,
                                {"analysis_country_tag": countries, "analysis_category_tag": categories}, known)
    io.write_report(reports, f"{out}/reports/preprocessing")
    return PreprocessOutputs(products, aligned, summary, reports)


def analysis_table(spark: SparkSession, products_path: str, summary_path: str, out_path: str,
                   spec: AnalysisSpec = AnalysisSpec()) -> DataFrame:
    """J4 from the written preprocess outputs; the table is written
    clustered by code so detail lookups (K6) prune files."""
    products = spark.read.parquet(products_path)
    summary = spark.read.parquet(summary_path)
    io.write_clustered(build_analysis(products, summary, spec), out_path, "code")
    return spark.read.parquet(out_path)


# Columns that J5 reads of each table; of the nutriment structs only the name.
AUDITED = {
    "products": [*J.PRODUCT_CORE_FIELDS, *J.PRODUCT_NUMERIC, *J.PRODUCT_TOP_LISTS, *J.PRODUCT_TOP_SCALARS,
                 *[f for fields in J.PRODUCT_REQUIRED.values() for f in fields]],
    "prices": [*J.PRICE_CORE_FIELDS, *J.PRICE_NUMERIC, *J.PRICE_TOP_SCALARS,
               *[f for fields in J.PRICE_REQUIRED.values() for f in fields]],
}


def dataset_audit(spark: SparkSession, catalogue_path: str, prices_path: str, out_dir: str,
                  optional_path: str | None = None) -> dict[str, DataFrame]:
    """J5 over the audited columns of both files, with the files' whole
    schemas and sizes, and the row count of an optional third input."""
    paths = {"products": catalogue_path, "prices": prices_path}
    whole = {d: spark.read.parquet(p) for d, p in paths.items()}
    read = {d: io.read_table(spark, p, catalogue_schema(whole[d].schema, columns=AUDITED[d],
                                                        structs={"nutriments": ("name",)}))
            for d, p in paths.items()}
    tables = J.audit_datasets(read["products"], read["prices"])
    tables["schema_columns"] = J.schema_columns(whole)
    tables["file_sizes"] = J.A.stack_metrics([
        io.file_sizes(df).select(F.lit(d).alias("dataset"), "*") for d, df in whole.items()])
    if optional_path is not None:
        tables["optional_rows"] = io.optional_row_count(spark, optional_path)
    io.write_report(tables, out_dir)
    return tables


def filter_audit(spark: SparkSession, catalogue_path: str, prices_path: str,
                 out_dir: str) -> dict[str, DataFrame]:
    """J6."""
    tables = J.audit_filters(read_catalogue(spark, catalogue_path), spark.read.parquet(prices_path))
    io.write_report(tables, out_dir)
    return tables


def export_analysis_csv(spark: SparkSession, analysis_path: str, out_path: str, index: bool = False) -> None:
    """A6 for the analysis table, optionally with a first column of row
    numbers in order of the code."""
    io.export_csv(spark.read.parquet(analysis_path), out_path, index="code" if index else None)


# Key columns and figures of the jobs' reports, for one table of them all.
DATASET_AUDIT_LAYOUT = {
    "row_counts": (["dataset"], ["rows"]),
    "field_coverage": (["dataset", "field"], ["present_rows", "coverage_pct"]),
    "derived_quality": (["dataset", "metric"], ["present_rows", "coverage_pct"]),
    "nutrient_coverage": (["nutrient"], ["present_rows", "coverage_pct"]),
    "product_required_fields": (["group", "field"], ["present", "present_rows"]),
    "price_required_fields": (["group", "field"], ["present", "present_rows"]),
    "numeric_profile": (["dataset", "column"], ["min", "median", "mean", "p95", "p99", "max"]),
    "date_profile": (["min", "max"], ["present_rows"]),
    "top_product_lists": (["column", "value"], ["count"]),
    "top_scalars": (["dataset", "column", "value"], ["count"]),
    "join_coverage": ([], ["unique_product_codes", "unique_price_product_codes", "matched_unique_product_codes",
                           "price_rows_with_product_code", "matched_price_rows", "matched_unique_price_code_pct",
                           "matched_price_rows_pct"]),
    "task_readiness": (["task", "source", "dataset", "metric"], ["position", "value"]),
    "optional_rows": ([], ["rows"]),
}
FILTER_AUDIT_LAYOUT = {
    "ladder": (["level"], ["count", "pct", "price_matched_count", "price_matched_pct_total",
                           "price_matched_pct_filter"]),
    "level_profile": ([], ["rows", "unique_codes", "nutriscore_score_median", "nova_group_median",
                           "completeness_median", "completeness_mean"]),
    "level_top_lists": (["column", "value"], ["count"]),
    "level_nutriscore_dist": (["value"], ["count"]),
    "level_nova_dist": (["value"], ["count"]),
}
PREPROCESSING_LAYOUT = {
    "preprocess_counters": ([], ["total_raw_product_rows", "preprocessed_product_rows",
                                 "preprocessed_product_pct_total", "products_with_price", "products_with_price_pct"]),
    "selected_tags": (["column", "tag"], ["position", "rows"]),
    "alignment_counters": ([], ["aligned_price_rows", "unique_products_with_price", "products_with_price_pct",
                                "same_market_rows", "same_market_rows_pct", "same_market_non_null_currency_rows",
                                "same_market_non_null_currency_rows_pct", "unique_products_with_same_market_price",
                                "unique_products_with_same_market_price_pct", "price_summary_rows"]),
    "aligned_currencies": (["value"], ["count"]),
    "aligned_price_countries": (["value"], ["count"]),
    "product_countries": (["value"], ["count"]),
    "product_categories": (["value"], ["count"]),
    "median_price_by_currency": (["currency"], ["rows", "median_price", "mean_price"]),
}


def written_report(spark: SparkSession, tables: Mapping[str, DataFrame], base: str,
                   layout: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """A7 read back: the JSON tables that a job wrote under ``base`` as one
    table (report, item, figure, value)."""
    read = {name: spark.read.schema(tables[name].schema).json(f"{base.rstrip('/')}/{name}") for name in layout}
    return io.tidy_report(read, layout)
