"""Independent DuckDB SQL for every registered query (the correctness gate).

Each statement starts with the same fixture views as
``larder.sources.fixtures`` written in DuckDB's dialect, then computes the
operator with plain SQL (windows, joins, list functions).  Nothing here is
shared with the Spark code path except the column names.

DuckDB notes: lists are 1-based and out-of-range gives NULL; ``sum``/``count_if``
are HUGEINT, so counts are cast to BIGINT; ascending order is NULLS LAST.
Medians are written as ``0.5*lower + 0.5*upper`` middle values, the
interpolation Spark's ``percentile`` uses.
"""

from __future__ import annotations

PRODUCTS_FX = """
products_src AS (
  SELECT p_partkey AS p, p_name, p_brand, p_type, p_size, 0 AS dup FROM part
  UNION ALL
  SELECT p_partkey AS p, p_name, p_brand, p_type, p_size, 1 AS dup FROM part WHERE p_partkey % 50 = 0
),
products_fx AS (
  SELECT
    CAST(p AS VARCHAR) AS code,
    p * 2 + dup AS src_seq,
    CASE WHEN p % 31 = 0 THEN NULL ELSE [
      {'lang': 'main', 'text': CASE WHEN p % 37 = 0 THEN NULL ELSE p_name END},
      {'lang': 'en', 'text': upper(p_name)}] END AS product_name,
    CASE WHEN p % 27 = 0 THEN NULL ELSE p_brand END AS brands,
    CASE WHEN p % 27 = 0 THEN []::VARCHAR[] ELSE [NULL, lower(p_brand)]::VARCHAR[] END AS brands_tags,
    CASE WHEN p % 41 = 0 THEN NULL
         WHEN p % 43 = 0 THEN []::VARCHAR[]
         ELSE ['nation_' || CAST(p % 25 AS VARCHAR), 'nation_' || CAST((p * 7) % 10 AS VARCHAR)] END AS countries_tags,
    CASE WHEN p % 47 = 0 THEN []::VARCHAR[]
         ELSE [lower(p_type), 'size-' || CAST(p_size % 5 AS VARCHAR)] END AS categories_tags,
    CASE WHEN p % 19 = 0 THEN NULL ELSE ['group-' || CAST(p_size % 3 AS VARCHAR)] END AS food_groups_tags,
    CASE WHEN p % 5 = 0 THEN NULL ELSE [{'lang': 'main', 'text': p_name}] END AS ingredients_text,
    CASE WHEN p % 4 = 0 THEN NULL WHEN p % 4 = 1 THEN []::VARCHAR[] ELSE [p_type, 'x'] END AS labels_tags,
    CASE WHEN p % 53 = 0 THEN NULL WHEN p % 6 = 0 THEN []::VARCHAR[]
         WHEN p % 6 < 4 THEN ['w1'] ELSE ['w1', 'w2', 'w3'] END AS data_quality_warnings_tags,
    CASE WHEN p % 9 = 0 THEN ['e1'] ELSE NULL END AS data_quality_errors_tags,
    CAST(CASE WHEN p % 29 = 0 THEN NULL ELSE p_size % 60 - 15 END AS INTEGER) AS nutriscore_score,
    CASE WHEN p % 29 = 0 AND p % 2 = 0 THEN NULL WHEN p % 29 = 0 THEN 'unknown'
         ELSE substr('abcde', CAST(p % 5 + 1 AS INTEGER), 1) END AS nutriscore_grade,
    CAST(CASE WHEN p % 33 = 0 THEN NULL WHEN p % 3 = 0 THEN p_size % 4 + 1 ELSE 4 END AS INTEGER) AS nova_group,
    CAST((p + dup) % 23 AS DOUBLE) / 20.0 AS completeness,
    CAST(p_size AS INTEGER) AS scans_n,
    CAST(p_size - 1 AS INTEGER) AS unique_scans_n,
    CASE WHEN p % 23 = 0 THEN NULL ELSE [
      {'name': CASE p % 3 WHEN 0 THEN 'energy-kcal' WHEN 1 THEN 'energy-kj' ELSE 'energy' END,
       '100g': CAST(p_size * 10 AS DOUBLE)},
      {'name': 'fat', '100g': CAST(CASE WHEN p % 17 = 0 THEN NULL ELSE p_size END AS DOUBLE)},
      {'name': 'saturated-fat', '100g': CAST(p_size AS DOUBLE)},
      {'name': 'carbohydrates', '100g': CAST(p_size + 5 AS DOUBLE)},
      {'name': 'sugars', '100g': CAST(p % 40 AS DOUBLE)},
      {'name': 'proteins', '100g': CAST(p % 25 AS DOUBLE)},
      {'name': CASE WHEN p % 3 = 0 THEN 'sodium' ELSE 'salt' END, '100g': CAST(p % 7 AS DOUBLE)},
      {'name': 'fiber', '100g': CAST(CASE WHEN p % 2 = 0 THEN NULL ELSE p % 11 END AS DOUBLE)}
    ] END AS nutriments
  FROM products_src
)"""

PRICES_FX = """
prices_fx AS (
  SELECT
    l_orderkey * 8 + l_linenumber AS id,
    CASE WHEN l_orderkey % 97 = 0 THEN 'CATEGORY' ELSE 'PRODUCT' END AS type,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         ELSE CAST(l_partkey + CASE WHEN l_orderkey % 89 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) END AS product_code,
    'item ' || CAST(l_partkey AS VARCHAR) AS product_name,
    CASE WHEN l_orderkey % 97 = 0 THEN 'en:unknown' END AS category_tag,
    CAST(CASE WHEN l_orderkey % 101 = 0 THEN 0.0 ELSE l_extendedprice END AS DECIMAL(10,3)) AS price,
    l_discount > 0.05 AS price_is_discounted,
    CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(10,3)) END AS price_without_discount,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'UNIT' END AS price_per,
    CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_returnflag END AS currency,
    CASE WHEN l_orderkey % 103 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
    CASE WHEN l_linestatus = 'O' THEN 'RECEIPT' ELSE 'PRICE_TAG' END AS proof_type,
    CASE WHEN l_suppkey % 2 = 0 THEN 'web' ELSE 'app' END AS source,
    CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE 'nation ' || CAST(l_suppkey % 10 AS VARCHAR) END AS location_osm_address_country,
    CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE 'N' || CAST(l_suppkey % 10 AS VARCHAR) END AS location_osm_address_country_code,
    'city-' || CAST(l_suppkey % 20 AS VARCHAR) AS location_osm_address_city,
    CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE CAST(l_suppkey % 90 AS DOUBLE) END AS location_osm_lat,
    CAST(l_partkey % 180 AS DOUBLE) AS location_osm_lon,
    l_orderkey,
    l_linenumber
  FROM lineitem
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def med(x: str) -> str:
    """Spark-style interpolated median of x (lower/upper middle values)."""
    return f"(0.5 * quantile_disc({x}, 0.5) + 0.5 * (-quantile_disc(-({x}), 0.5)))"


def mean(x: str) -> str:
    """Exact decimal sum / count (same as the Spark side's exact_mean): the
    decimal prints exactly and the text parses to the correctly rounded
    double."""
    return (f"(CAST(CAST(sum(CAST({x} AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE)"
            f" / CAST(count({x}) AS DOUBLE))")


def pct(part: str, whole: str, zero: str = "0.0") -> str:
    """Percentage with 2 decimals, exact ties to the even hundredth."""
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    floor, rest = f"(10000 * {p}) // {w}", f"(10000 * {p}) % {w}"
    up = f"CASE WHEN 2 * ({rest}) > {w} OR (2 * ({rest}) = {w} AND ({floor}) % 2 = 1) THEN 1 ELSE 0 END"
    return f"COALESCE(CASE WHEN ({whole}) <> 0 THEN CAST(({floor}) + {up} AS DOUBLE) / 100.0 END, {zero})"


# ---------------------------------------------------------------- fragments

def has_list(c: str) -> str:
    return f"({c} IS NOT NULL AND len({c}) > 0)"


def has_nut(name: str, c: str = "nutriments") -> str:
    return f"COALESCE(len(list_filter({c}, lambda e: e.name = '{name}')) > 0, false)"


def nut(name: str, c: str = "nutriments") -> str:
    return f"CAST(list_filter({c}, lambda e: e.name = '{name}' AND e['100g'] IS NOT NULL)[1]['100g'] AS DOUBLE)"


def first_text(c: str) -> str:
    return f"list_filter(list_transform({c}, lambda e: e.text), lambda t: t IS NOT NULL)[1]"


def size0(c: str) -> str:
    return f"CAST(COALESCE(len({c}), 0) AS INTEGER)"


PRED = {
    "has_code": "code IS NOT NULL",
    "has_name": has_list("product_name"),
    "has_country": has_list("countries_tags"),
    "has_category": has_list("categories_tags"),
    "has_brand": f"(brands IS NOT NULL OR {has_list('brands_tags')})",
    "has_nutriments": has_list("nutriments"),
    "has_energy": f"({has_nut('energy-kcal')} OR {has_nut('energy-kj')} OR {has_nut('energy')})",
    "has_fat": has_nut("fat"),
    "has_satfat": has_nut("saturated-fat"),
    "has_carbs": has_nut("carbohydrates"),
    "has_sugars": has_nut("sugars"),
    "has_proteins": has_nut("proteins"),
    "has_salt": f"({has_nut('salt')} OR {has_nut('sodium')})",
    "valid_nutriscore": "(nutriscore_score IS NOT NULL OR nutriscore_grade IN ('a','b','c','d','e'))",
    "valid_nova": "(nova_group IN (1, 2, 3, 4))",
    "quality_ready": "(completeness IS NOT NULL AND data_quality_warnings_tags IS NOT NULL)",
    "high_complete": "(COALESCE(completeness, 0.0) >= 0.5)",
}

PRODUCT_FILTER = " AND ".join(PRED[k] for k in (
    "has_code", "has_name", "has_country", "has_category", "has_brand", "has_energy", "has_fat",
    "has_satfat", "has_carbs", "has_sugars", "has_proteins", "has_salt", "valid_nutriscore",
    "valid_nova", "quality_ready", "high_complete"))

_base = f"({PRED['has_code']} AND {PRED['has_name']} AND {PRED['has_country']} AND {PRED['has_category']})"
_core = f"({_base} AND {PRED['has_energy']} AND {PRED['has_fat']} AND {PRED['has_sugars']} AND {PRED['has_salt']} AND {PRED['has_proteins']})"
_full = f"({_core} AND {PRED['valid_nutriscore']} AND {PRED['valid_nova']})"
_brand = f"({_full} AND {PRED['has_brand']})"
_strict = f"({_brand} AND {PRED['quality_ready']} AND {PRED['high_complete']})"
LADDER = {
    "base_identity_geo_category": _base,
    "base_with_any_nutriments": f"({_base} AND {PRED['has_nutriments']})",
    "core_nutrition_ready": _core,
    "broad_health_ready": f"({_core} AND ({PRED['valid_nutriscore']} OR {PRED['valid_nova']}))",
    "full_health_ready": _full,
    "brand_full_health_ready": _brand,
    "strict_quality_ready": _strict,
    "full_nutrient_detail_ready": f"({_strict} AND {PRED['has_satfat']} AND {PRED['has_carbs']})",
}

COUNTRY_CODE_CASE = ("CASE analysis_country_tag "
                     + " ".join(f"WHEN 'nation_{k}' THEN 'N{k}'" for k in range(9)) + " END")


def top_tags_cte(name: str, col: str, exclude: str | None) -> str:
    excl = f" AND tag NOT IN ({exclude})" if exclude else ""
    return f"""
{name} AS (
  SELECT tag, count(*) AS n FROM (
    SELECT unnest({col}) AS tag FROM products_fx WHERE {PRODUCT_FILTER} AND {has_list(col)}
  ) t WHERE tag IS NOT NULL{excl}
  GROUP BY tag ORDER BY n DESC, tag ASC LIMIT 10
)"""


PRODUCTS_MAIN = f"""
{top_tags_cte('top_countries', 'countries_tags', "'nation_0'").strip()},
{top_tags_cte('top_categories', 'categories_tags', None).strip()},
allow AS (
  SELECT (SELECT list(tag) FROM top_countries) AS ac, (SELECT list(tag) FROM top_categories) AS ag
),
pm_sel AS (
  SELECT f.*, allow.ac, allow.ag FROM products_fx f, allow
  WHERE {PRODUCT_FILTER} AND list_has_any(f.countries_tags, allow.ac) AND list_has_any(f.categories_tags, allow.ag)
),
pm_x AS (
  SELECT
    code, src_seq,
    {first_text('product_name')} AS product_name,
    brands, brands_tags,
    list_filter(brands_tags, lambda t: t IS NOT NULL)[1] AS primary_brand_tag,
    countries_tags, categories_tags, food_groups_tags,
    list_filter(countries_tags, lambda t: list_contains(ac, t))[1] AS analysis_country_tag,
    list_filter(categories_tags, lambda t: list_contains(ag, t))[-1] AS analysis_category_tag,
    {first_text('ingredients_text')} AS ingredients_text,
    nutriscore_grade,
    CAST(nutriscore_score AS DOUBLE) AS nutriscore_score,
    CAST(nova_group AS INTEGER) AS nova_group,
    CAST(completeness AS DOUBLE) AS completeness,
    {size0('labels_tags')} AS labels_count,
    {size0('data_quality_warnings_tags')} AS quality_warning_count,
    {size0('data_quality_errors_tags')} AS quality_error_count,
    COALESCE({has_list('ingredients_text')}, false) AS has_ingredients_text,
    COALESCE({has_list('labels_tags')}, false) AS has_labels_tags,
    scans_n, unique_scans_n,
    {nut('energy-kcal')} AS kcal_raw, {nut('energy-kj')} AS kj_raw, {nut('energy')} AS energy_raw,
    {nut('fat')} AS fat_100g, {nut('saturated-fat')} AS saturated_fat_100g,
    {nut('carbohydrates')} AS carbohydrates_100g, {nut('sugars')} AS sugars_100g,
    {nut('proteins')} AS proteins_100g, {nut('salt')} AS salt_100g,
    {nut('sodium')} AS sodium_100g, {nut('fiber')} AS fiber_100g
  FROM pm_sel
),
pm_y AS (
  SELECT *,
    CASE WHEN kcal_raw IS NOT NULL THEN kcal_raw WHEN kj_raw IS NOT NULL THEN kj_raw / 4.184
         WHEN energy_raw IS NOT NULL THEN energy_raw / 4.184 END AS energy_kcal_100g,
    CASE WHEN kj_raw IS NOT NULL THEN kj_raw WHEN kcal_raw IS NOT NULL THEN kcal_raw * 4.184
         WHEN energy_raw IS NOT NULL THEN energy_raw END AS energy_kj_100g,
    {COUNTRY_CODE_CASE} AS analysis_country_code
  FROM pm_x
),
pm_z AS (
  SELECT *,
    CAST((CASE WHEN energy_kcal_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN fat_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN saturated_fat_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN carbohydrates_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN sugars_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN proteins_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN salt_100g IS NOT NULL OR sodium_100g IS NOT NULL THEN 1 ELSE 0 END)
       + (CASE WHEN fiber_100g IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS nutrition_fields_present_count,
    row_number() OVER (PARTITION BY code ORDER BY src_seq) AS rn
  FROM pm_y
),
products_main AS (
  SELECT code, product_name, brands, brands_tags, primary_brand_tag, countries_tags,
    categories_tags, food_groups_tags, analysis_country_tag, analysis_category_tag,
    ingredients_text, nutriscore_grade, nutriscore_score, nova_group, completeness,
    labels_count, quality_warning_count, quality_error_count, has_ingredients_text,
    has_labels_tags, scans_n, unique_scans_n, fat_100g, saturated_fat_100g,
    carbohydrates_100g, sugars_100g, proteins_100g, salt_100g, sodium_100g,
    fiber_100g, energy_kcal_100g, energy_kj_100g, analysis_country_code,
    nutrition_fields_present_count
  FROM pm_z WHERE rn = 1
)"""

ALIGNED = """
aligned AS (
  SELECT pr.id, pr.product_code, pr.product_name, pm.analysis_country_tag, pm.analysis_country_code,
    pm.analysis_category_tag, pr.location_osm_address_country_code, pr.location_osm_address_country,
    pr.location_osm_address_city, pr.currency,
    CAST(pr.price AS DOUBLE) AS price_value,
    CAST(pr.price_without_discount AS DOUBLE) AS price_without_discount_value,
    pr.price_is_discounted, pr.date, pr.proof_type, pr.source,
    pr.location_osm_address_country_code = pm.analysis_country_code AS same_market_as_analysis_country,
    pm.nutriscore_grade, pm.nutriscore_score, pm.nova_group, pm.completeness,
    pm.quality_warning_count, pm.quality_error_count, pm.energy_kcal_100g, pm.fat_100g,
    pm.saturated_fat_100g, pm.carbohydrates_100g, pm.sugars_100g, pm.proteins_100g,
    pm.salt_100g, pm.fiber_100g
  FROM prices_fx pr JOIN products_main pm ON pr.product_code = pm.code
  WHERE pr.product_code IS NOT NULL AND CAST(pr.price AS DOUBLE) > 0
)"""

SUMMARY = f"""
summary AS (
  SELECT product_code, analysis_country_tag, analysis_country_code, analysis_category_tag,
    location_osm_address_country_code, currency,
    CAST(count(*) AS INTEGER) AS price_record_count,
    min(price_value) AS price_min,
    {med('price_value')} AS price_median,
    {mean('price_value')} AS price_mean,
    max(price_value) AS price_max,
    COALESCE(bool_or(same_market_as_analysis_country), false) AS any_same_market_match,
    min(date) AS first_price_date,
    max(date) AS last_price_date
  FROM aligned
  GROUP BY product_code, analysis_country_tag, analysis_country_code, analysis_category_tag,
    location_osm_address_country_code, currency
)"""

PM_CHAIN = (PRODUCTS_FX, PRODUCTS_MAIN)
SUMMARY_CHAIN = (PRODUCTS_FX, PRICES_FX, PRODUCTS_MAIN, ALIGNED, SUMMARY)

ORACLE: dict[str, str] = {}

ORACLE["price_summary"] = _with(*SUMMARY_CHAIN) + "\nSELECT * FROM summary"
ORACLE["products_main"] = _with(*PM_CHAIN) + "\nSELECT * FROM products_main"
ORACLE["nested_extract"] = _with(PRODUCTS_FX) + f"""
SELECT code, src_seq,
  {nut('fat')} AS fat_100g,
  {nut('sodium')} AS sodium_100g,
  list_filter(countries_tags, lambda t: t IN ('nation_1', 'nation_3', 'nation_7'))[1] AS first_country,
  list_filter(countries_tags, lambda t: t IN ('nation_1', 'nation_3', 'nation_7'))[-1] AS last_country,
  {first_text('product_name')} AS first_name,
  list_filter(brands_tags, lambda t: t IS NOT NULL)[1] AS first_brand,
  {size0('labels_tags')} AS labels_count,
  {size0('data_quality_errors_tags')} AS error_count
FROM products_fx"""


# ------------------------------------------------------------ audit queries

PRODUCT_FIELDS_FX = [  # (field, is_list) present in products_fx, in audit order
    ("code", False), ("product_name", True), ("brands", False), ("brands_tags", True),
    ("countries_tags", True), ("categories_tags", True), ("food_groups_tags", True),
    ("nutriscore_grade", False), ("nutriscore_score", False), ("nova_group", False),
    ("nutriments", True), ("labels_tags", True), ("ingredients_text", True),
    ("completeness", False), ("data_quality_warnings_tags", True),
    ("data_quality_errors_tags", True), ("scans_n", False), ("unique_scans_n", False),
]
PRICE_FIELDS_FX = [
    "id", "type", "product_code", "product_name", "category_tag", "price", "price_is_discounted",
    "price_without_discount", "price_per", "currency", "date", "location_osm_address_country",
    "location_osm_address_country_code", "location_osm_address_city", "location_osm_lat",
    "location_osm_lon", "proof_type", "source",
]


def _count_rows(dataset: str | None, name_col: str, src: str, preds: list[tuple[str, str]],
                zero: str = "NULL") -> str:
    """Union of (name, present_rows, coverage_pct) rows from one aggregate."""
    aggs = ", ".join(f"count_if({p}) AS c{i}" for i, (_, p) in enumerate(preds))
    head = f"'{dataset}' AS dataset, " if dataset else ""
    rows = [f"SELECT {head}'{n}' AS {name_col}, CAST(c{i} AS BIGINT) AS present_rows, "
            f"{pct(f'c{i}', 'total', zero)} AS coverage_pct FROM (SELECT count(*) AS total, {aggs} FROM {src})"
            for i, (n, _) in enumerate(preds)]
    return "\nUNION ALL ".join(rows)


def _present(f: str, is_list: bool) -> str:
    return has_list(f) if is_list else f"{f} IS NOT NULL"


ORACLE["field_coverage"] = _with(PRODUCTS_FX, PRICES_FX) + "\n" + _count_rows(
    "products", "field", "products_fx", [(f, _present(f, l)) for f, l in PRODUCT_FIELDS_FX]
) + "\nUNION ALL " + _count_rows(
    "prices", "field", "prices_fx", [(f, f"{f} IS NOT NULL") for f in PRICE_FIELDS_FX])

NUTRIENTS = ["energy-kcal", "energy-kj", "fat", "saturated-fat", "carbohydrates", "sugars", "fiber",
             "proteins", "salt", "sodium", "nova-group", "nutrition-score-fr"]
ORACLE["named_entry_coverage"] = _with(PRODUCTS_FX) + "\n" + _count_rows(
    None, "nutrient", "products_fx", [(n, has_nut(n)) for n in NUTRIENTS])

ORACLE["derived_quality"] = _with(PRODUCTS_FX, PRICES_FX) + "\n" + _count_rows(
    "products", "metric", "products_fx", [
        ("valid_nutriscore_grade_a_to_e", "nutriscore_grade IN ('a','b','c','d','e')"),
        ("usable_nutrition_score", "(nutriscore_grade IN ('a','b','c','d','e') OR nutriscore_score IS NOT NULL)"),
        ("has_country_and_category", f"({has_list('countries_tags')} AND {has_list('categories_tags')})"),
        ("has_country_category_and_brand", f"({has_list('countries_tags')} AND {has_list('categories_tags')} "
                                           f"AND (brands IS NOT NULL OR {has_list('brands_tags')}))"),
        ("completeness_at_least_0_5", "completeness >= 0.5"),
    ]) + "\nUNION ALL " + _count_rows(
    "prices", "metric", "prices_fx", [
        ("positive_price", "price > 0"),
        ("price_currency_date_geo_ready", "(price > 0 AND currency IS NOT NULL AND date IS NOT NULL "
                                          "AND location_osm_lat IS NOT NULL AND location_osm_lon IS NOT NULL)"),
        ("barcode_price_ready", "(price > 0 AND currency IS NOT NULL AND date IS NOT NULL "
                                "AND location_osm_lat IS NOT NULL AND location_osm_lon IS NOT NULL "
                                "AND product_code IS NOT NULL)"),
    ])


def _nearest(v: str, q: float) -> str:
    idx = f"CAST(floor(CAST(count({v}) - 1 AS DOUBLE) * CAST({q!r} AS DOUBLE) + 0.5) AS BIGINT) + 1"
    return f"list_sort(list({v}) FILTER (WHERE {v} IS NOT NULL))[{idx}]"


def _profile(dataset: str, src: str, col: str) -> str:
    return (f"SELECT '{dataset}' AS dataset, '{col}' AS column, min(v) AS min, {med('v')} AS median, "
            f"{mean('v')} AS mean, {_nearest('v', 0.95)} AS p95, {_nearest('v', 0.99)} AS p99, max(v) AS max "
            f"FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {src})")


ORACLE["numeric_profile"] = _with(PRODUCTS_FX, PRICES_FX) + "\n" + "\nUNION ALL ".join(
    [_profile("products", "products_fx", c)
     for c in ["completeness", "nutriscore_score", "nova_group", "scans_n", "unique_scans_n"]]
    + [_profile("prices", "prices_fx", c) for c in ["price", "price_without_discount"]])

ORACLE["date_profile"] = _with(PRICES_FX) + """
SELECT min(date) AS min, max(date) AS max, count(date) AS present_rows FROM prices_fx"""

ORACLE["join_coverage"] = _with(PRODUCTS_FX, PRICES_FX) + f""",
pcodes AS (SELECT DISTINCT code FROM products_fx WHERE code IS NOT NULL),
c AS (SELECT
  CAST((SELECT count(*) FROM pcodes) AS BIGINT) AS unique_product_codes,
  CAST((SELECT count(DISTINCT product_code) FROM prices_fx) AS BIGINT) AS unique_price_product_codes,
  CAST((SELECT count(DISTINCT product_code) FROM prices_fx WHERE product_code IN (SELECT code FROM pcodes)) AS BIGINT)
    AS matched_unique_product_codes,
  CAST((SELECT count(product_code) FROM prices_fx) AS BIGINT) AS price_rows_with_product_code,
  CAST((SELECT count(*) FROM prices_fx WHERE product_code IN (SELECT code FROM pcodes)) AS BIGINT) AS matched_price_rows)
SELECT *,
  {pct('matched_unique_product_codes', 'unique_price_product_codes', 'NULL')} AS matched_unique_price_code_pct,
  {pct('matched_price_rows', 'price_rows_with_product_code', 'NULL')} AS matched_price_rows_pct
FROM c"""


def _top_list(src: str, col: str, k: int, keep_null: bool, where: str = "TRUE",
              exclude: str | None = None, head: str = "") -> str:
    conds = [] if keep_null else ["value IS NOT NULL"]
    if exclude:
        conds.append(f"value NOT IN ({exclude})")
    cond = " AND ".join(conds) or "TRUE"
    return (f"SELECT * FROM (SELECT {head}'{col}' AS column, CAST(value AS VARCHAR) AS value, count FROM ("
            f"SELECT value, count(*) AS count FROM (SELECT unnest({col}) AS value FROM {src} "
            f"WHERE {where} AND {has_list(col)}) t WHERE {cond} "
            f"GROUP BY value ORDER BY count DESC, value ASC NULLS LAST LIMIT {k}))")


def _top_scalar(src: str, col: str, k: int, head: str = "") -> str:
    return (f"SELECT * FROM (SELECT {head}'{col}' AS column, CAST(value AS VARCHAR) AS value, count FROM ("
            f"SELECT {col} AS value, count(*) AS count FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY count DESC, value ASC NULLS LAST LIMIT {k}))")


STRICT = LADDER["strict_quality_ready"]
LISTS = ["countries_tags", "categories_tags", "brands_tags"]

ORACLE["top_array_values"] = _with(PRODUCTS_FX) + "\n" + "\nUNION ALL ".join(
    _top_list("products_fx", c, 20, False, STRICT) for c in LISTS)
ORACLE["top_array_values_nullkeep"] = _with(PRODUCTS_FX) + "\n" + "\nUNION ALL ".join(
    _top_list("products_fx", c, 20, True) for c in LISTS)
ORACLE["top_scalar_values"] = _with(PRODUCTS_FX, PRICES_FX) + "\n" + "\nUNION ALL ".join(
    [_top_scalar("products_fx", c, 20, "'products' AS dataset, ") for c in ["nutriscore_grade", "nova_group"]]
    + [_top_scalar("prices_fx", c, 20, "'prices' AS dataset, ")
       for c in ["currency", "price_per", "location_osm_address_country_code", "proof_type"]])
ORACLE["allow_list_selection"] = _with(PRODUCTS_FX) + "\n" + "\nUNION ALL ".join([
    _top_list("products_fx", "countries_tags", 10, False, PRODUCT_FILTER, "'nation_0'"),
    _top_list("products_fx", "categories_tags", 10, False, PRODUCT_FILTER)])

_ladder_names = list(LADDER)
ORACLE["filter_ladder"] = _with(PRODUCTS_FX, PRICES_FX) + ",\n" + """
pcodes AS (SELECT DISTINCT product_code AS code FROM prices_fx WHERE product_code IS NOT NULL),
fl AS (SELECT p.*, (pc.code IS NOT NULL) AS has_price FROM products_fx p LEFT JOIN pcodes pc ON p.code = pc.code),
agg AS (SELECT count(*) AS total, """ + ", ".join(
    f"count_if({LADDER[n]}) AS n{i}, count_if({LADDER[n]} AND has_price) AS p{i}"
    for i, n in enumerate(_ladder_names)) + " FROM fl)\n" + "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS level, CAST(n{i} AS BIGINT) AS count, {pct(f'n{i}', 'total')} AS pct, "
    f"CAST(p{i} AS BIGINT) AS price_matched_count, {pct(f'p{i}', 'total')} AS price_matched_pct_total, "
    f"{pct(f'p{i}', f'n{i}')} AS price_matched_pct_filter FROM agg"
    for i, n in enumerate(_ladder_names))

ORACLE["level_profile"] = _with(PRODUCTS_FX) + f"""
SELECT count(*) AS rows,
  CAST(count(DISTINCT code) + max(CASE WHEN code IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_codes,
  {med('CAST(nutriscore_score AS DOUBLE)')} AS nutriscore_score_median,
  {med('CAST(nova_group AS DOUBLE)')} AS nova_group_median,
  {med('completeness')} AS completeness_median,
  {mean('completeness')} AS completeness_mean
FROM products_fx WHERE {STRICT}"""


def _dist(src: str, source: str, col: str) -> str:
    return (f"SELECT '{source}' AS source, '{col}' AS column, CAST({col} AS VARCHAR) AS value, "
            f"count(*) AS count FROM {src} GROUP BY {col}")


ORACLE["value_distribution"] = _with(*SUMMARY_CHAIN) + f""",
strict AS (SELECT * FROM products_fx WHERE {STRICT})
""" + "\nUNION ALL ".join([
    _dist("strict", "strict", "nutriscore_grade"), _dist("strict", "strict", "nova_group"),
    _dist("products_main", "products_main", "analysis_country_tag"),
    _dist("products_main", "products_main", "analysis_category_tag"),
    _dist("aligned", "prices_aligned", "currency"),
    _dist("aligned", "prices_aligned", "location_osm_address_country_code")])

ORACLE["prices_aligned"] = _with(PRODUCTS_FX, PRICES_FX, PRODUCTS_MAIN, ALIGNED) + """
SELECT * FROM aligned"""

ORACLE["price_currency_medians"] = _with(*SUMMARY_CHAIN) + f"""
SELECT currency, count(*) AS rows, {med('price_value')} AS median_price, {mean('price_value')} AS mean_price
FROM aligned GROUP BY currency"""

ORACLE["alignment_counters"] = _with(*SUMMARY_CHAIN) + f""",
a AS (SELECT
  CAST(count(*) AS BIGINT) AS aligned_price_rows,
  CAST(count_if(same_market_as_analysis_country) AS BIGINT) AS same_market_rows,
  CAST(count_if(same_market_as_analysis_country AND currency IS NOT NULL) AS BIGINT) AS same_market_non_null_currency_rows,
  CAST(count(DISTINCT CASE WHEN same_market_as_analysis_country AND currency IS NOT NULL THEN product_code END) AS BIGINT)
    AS unique_products_with_same_market_price
  FROM aligned),
s AS (SELECT CAST(count(DISTINCT product_code) AS BIGINT) AS unique_products_with_price,
             CAST(count(*) AS BIGINT) AS price_summary_rows FROM summary),
p AS (SELECT CAST(count(*) AS BIGINT) AS product_rows FROM products_main)
SELECT aligned_price_rows, unique_products_with_price,
  {pct('unique_products_with_price', 'product_rows')} AS products_with_price_pct,
  same_market_rows, {pct('same_market_rows', 'aligned_price_rows')} AS same_market_rows_pct,
  same_market_non_null_currency_rows,
  {pct('same_market_non_null_currency_rows', 'aligned_price_rows')} AS same_market_non_null_currency_rows_pct,
  unique_products_with_same_market_price,
  {pct('unique_products_with_same_market_price', 'product_rows')} AS unique_products_with_same_market_price_pct,
  price_summary_rows
FROM a, s, p"""

ORACLE["preprocess_counters"] = _with(*SUMMARY_CHAIN) + f""",
r AS (SELECT CAST(count(*) AS BIGINT) AS total_raw_product_rows FROM products_fx),
k AS (SELECT CAST(count(*) AS BIGINT) AS preprocessed_product_rows FROM products_main),
s AS (SELECT CAST(count(DISTINCT product_code) AS BIGINT) AS products_with_price FROM summary)
SELECT total_raw_product_rows, preprocessed_product_rows,
  {pct('preprocessed_product_rows', 'total_raw_product_rows')} AS preprocessed_product_pct_total,
  products_with_price, {pct('products_with_price', 'preprocessed_product_rows')} AS products_with_price_pct
FROM r, k, s"""

ORACLE["selected_tag_counts"] = _with(*PM_CHAIN) + """,
sel AS (
  SELECT 'analysis_country_tag' AS column, CAST(row_number() OVER (ORDER BY n DESC, tag ASC) - 1 AS INTEGER) AS position, tag
  FROM top_countries
  UNION ALL
  SELECT 'analysis_category_tag' AS column, CAST(row_number() OVER (ORDER BY n DESC, tag ASC) - 1 AS INTEGER) AS position, tag
  FROM top_categories),
cc AS (SELECT analysis_country_tag AS tag, count(*) AS rows FROM products_main GROUP BY 1),
gc AS (SELECT analysis_category_tag AS tag, count(*) AS rows FROM products_main GROUP BY 1)
SELECT s.column, s.position, s.tag,
  CAST(COALESCE(CASE WHEN s.column = 'analysis_country_tag' THEN cc.rows ELSE gc.rows END, 0) AS BIGINT) AS rows
FROM sel s LEFT JOIN cc ON s.tag = cc.tag LEFT JOIN gc ON s.tag = gc.tag"""

_PRODUCT_REQ = {
    "identity": ["code", "product_name", "brands", "brands_tags"],
    "geography": ["countries_tags", "main_countries_tags"],
    "category": ["categories", "categories_tags", "food_groups_tags"],
    "health": ["nutriscore_grade", "nutriscore_score", "nova_group", "nova_groups_tags",
               "nutrient_levels_tags", "nutriments"],
    "label_transparency": ["labels_tags", "ingredients_text", "completeness",
                           "data_quality_warnings_tags", "data_quality_errors_tags"],
    "popularity": ["scans_n", "unique_scans_n", "popularity_tags"],
}
_PRICE_REQ = {
    "identity": ["id", "product_code", "product_name", "category_tag"],
    "price": ["price", "price_without_discount", "price_is_discounted", "price_per", "currency", "date"],
    "geography": ["location_osm_lat", "location_osm_lon", "location_osm_address_country",
                  "location_osm_address_country_code", "location_osm_address_city",
                  "location_osm_display_name"],
    "provenance": ["proof_type", "source", "created", "updated"],
}


def _schema_cols(src: str) -> str:
    return (f"(SELECT unnest(k) AS field, CAST(unnest(range(len(k))) AS INTEGER) AS position FROM "
            f"(SELECT json_keys(to_json(t)) AS k FROM (SELECT * FROM {src} LIMIT 1) t))")


_spec_rows = ", ".join(f"('products', '{g}', '{f}')" for g, fs in _PRODUCT_REQ.items() for f in fs) + ", " + \
    ", ".join(f"('prices', '{g}', '{f}')" for g, fs in _PRICE_REQ.items() for f in fs)
def _non_null(src: str) -> str:
    """(field, non_null_rows) for every column of ``src``."""
    return (f"(UNPIVOT (SELECT count(COLUMNS(*)) FROM {src}) "
            f"ON COLUMNS(*) INTO NAME field VALUE non_null_rows)")


ORACLE["schema_required"] = _with(PRODUCTS_FX, PRICES_FX) + f""",
spec(dataset, "group", field) AS (VALUES {_spec_rows}),
cols AS (SELECT 'products' AS dataset, field, non_null_rows FROM {_non_null('products_fx')}
         UNION ALL SELECT 'prices' AS dataset, field, non_null_rows FROM {_non_null('prices_fx')})
SELECT s.dataset, s."group", s.field, (c.field IS NOT NULL) AS present,
       CAST(c.non_null_rows AS BIGINT) AS present_rows
FROM spec s LEFT JOIN cols c ON s.dataset = c.dataset AND s.field = c.field"""

ORACLE["schema_columns"] = _with(PRODUCTS_FX, PRICES_FX) + f"""
SELECT 'products' AS dataset, p.position, p.field AS column,
       (SELECT count(*) FROM products_fx) AS rows, CAST(n.non_null_rows AS BIGINT) AS non_null_rows
FROM {_schema_cols('products_fx')} p JOIN {_non_null('products_fx')} n ON p.field = n.field
UNION ALL
SELECT 'prices' AS dataset, p.position, p.field AS column,
       (SELECT count(*) FROM prices_fx) AS rows, CAST(n.non_null_rows AS BIGINT) AS non_null_rows
FROM {_schema_cols('prices_fx')} p JOIN {_non_null('prices_fx')} n ON p.field = n.field"""


# -------------------------------------------------------- row-level scalars

ORACLE["energy_fallback"] = _with(PRODUCTS_FX) + f"""
SELECT code, src_seq, kcal_raw, kj_raw, energy_raw,
  CASE WHEN kcal_raw IS NOT NULL THEN kcal_raw WHEN kj_raw IS NOT NULL THEN kj_raw / 4.184
       WHEN energy_raw IS NOT NULL THEN energy_raw / 4.184 END AS energy_kcal_100g,
  CASE WHEN kj_raw IS NOT NULL THEN kj_raw WHEN kcal_raw IS NOT NULL THEN kcal_raw * 4.184
       WHEN energy_raw IS NOT NULL THEN energy_raw END AS energy_kj_100g
FROM (SELECT code, src_seq, {nut('energy-kcal')} AS kcal_raw, {nut('energy-kj')} AS kj_raw,
             {nut('energy')} AS energy_raw FROM products_fx)"""

ORACLE["country_code_map"] = _with(PRODUCTS_FX) + f"""
SELECT code, src_seq, analysis_country_tag AS country_tag, {COUNTRY_CODE_CASE} AS country_code
FROM (SELECT code, src_seq, list_filter(countries_tags, lambda t: t IS NOT NULL)[1] AS analysis_country_tag
      FROM products_fx)"""

ORACLE["present_count"] = _with(PRODUCTS_FX) + f"""
SELECT code, src_seq, n AS nutrition_fields_present_count, CAST(n AS DOUBLE) / 8.0 AS nutrient_field_fill_rate
FROM (SELECT code, src_seq, CAST(
    (CASE WHEN {nut('energy-kcal')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('fat')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('saturated-fat')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('carbohydrates')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('sugars')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('proteins')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('salt')} IS NOT NULL OR {nut('sodium')} IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN {nut('fiber')} IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS n
  FROM products_fx)"""

ORACLE["clip_safe_div"] = _with(PRODUCTS_FX) + f"""
SELECT *, 0.5 * COALESCE(abs(ratio), 0.0) + 0.25 * COALESCE(abs(clipped), 0.0) AS weighted
FROM (SELECT code, src_seq,
  CASE WHEN nova_group - 4 <> 0 THEN CAST(nutriscore_score AS DOUBLE) / CAST(nova_group - 4 AS DOUBLE) END AS ratio,
  CASE WHEN nutriscore_score IS NOT NULL
       THEN least(greatest(CAST(nutriscore_score AS DOUBLE) / 10.0, 0.0), 1.0) END AS clipped,
  {pct(size0('labels_tags'), size0('data_quality_warnings_tags'), 'NULL')} AS labels_per_warning_pct,
  {pct('unique_scans_n', 'scans_n * 3')} AS scan_pct
  FROM products_fx)"""

ORACLE["dedup_keep_first"] = _with(PRODUCTS_FX) + """
SELECT code, src_seq, completeness, brands FROM (
  SELECT code, src_seq, completeness, brands, row_number() OVER (PARTITION BY code ORDER BY src_seq) AS rn
  FROM products_fx) WHERE rn = 1"""

PRIMARY = """
primary_price AS (
  SELECT product_code, location_osm_address_country_code, currency, price_record_count, price_min,
    price_median, price_mean, price_max, any_same_market_match, first_price_date, last_price_date
  FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY
          CASE WHEN any_same_market_match THEN 100000 ELSE 0 END + price_record_count DESC, price_record_count DESC, location_osm_address_country_code ASC NULLS LAST, currency ASC NULLS LAST) AS rn
        FROM summary) WHERE rn = 1
)"""

BASE = """
base AS (
  SELECT pm.*,
    pp.location_osm_address_country_code, pp.currency, pp.price_min, pp.price_median, pp.price_mean,
    pp.price_max, pp.first_price_date, pp.last_price_date,
    CAST(pm.nutrition_fields_present_count AS DOUBLE) / 8.0 AS nutrient_field_fill_rate,
    COALESCE(pp.price_record_count, 0) > 0 AS has_price,
    CAST(COALESCE(pp.price_record_count, 0) AS INTEGER) AS price_record_count,
    COALESCE(pp.any_same_market_match, false) AS any_same_market_match,
    COALESCE(pm.quality_warning_count > 0, false) AS has_quality_warning,
    COALESCE(pm.quality_error_count > 0, false) AS has_quality_error,
    -pm.nutriscore_score AS nutriscore_good_direction,
    (CAST(pm.nova_group AS DOUBLE) - 1.0) / 3.0 AS nova_scaled,
    CASE WHEN pm.salt_100g IS NOT NULL THEN pm.salt_100g ELSE pm.sodium_100g * 2.5 END AS salt_equivalent_100g,
    CASE WHEN pp.price_median IS NOT NULL AND pp.price_median > 0 THEN pp.price_median END AS price_median_clean
  FROM products_main pm LEFT JOIN primary_price pp ON pm.code = pp.product_code
)"""

BASE_CHAIN = (*SUMMARY_CHAIN, PRIMARY, BASE)

ORACLE["primary_price"] = _with(*SUMMARY_CHAIN, PRIMARY) + "\nSELECT * FROM primary_price"
ORACLE["products_left_price"] = _with(*BASE_CHAIN) + """
SELECT code, currency, location_osm_address_country_code, price_median, price_record_count, has_price,
  any_same_market_match, nutrient_field_fill_rate, has_quality_warning, has_quality_error, nova_scaled
FROM base"""
ORACLE["salt_clean_price"] = _with(*BASE_CHAIN) + """
SELECT code, salt_equivalent_100g, price_median_clean, nutriscore_good_direction FROM base"""


def prank(x: str, keys: str) -> str:
    """Average rank of x among its peers' non-nulls / all peer rows."""
    return (f"CASE WHEN ({x}) IS NOT NULL THEN (CAST(rank() OVER (PARTITION BY {keys} ORDER BY ({x}) ASC NULLS LAST) AS DOUBLE)"
            f" + CAST(count(*) OVER (PARTITION BY {keys}, ({x})) - 1 AS DOUBLE) / 2.0)"
            f" / CAST(count(*) OVER (PARTITION BY {keys}) AS DOUBLE) END")


GK = "analysis_country_tag, analysis_category_tag"
PK = "analysis_country_code, currency, analysis_category_tag"
PEER = {
    "nutriscore_good_percentile": "nutriscore_good_direction",
    "nova_good_percentile": "-CAST(nova_group AS DOUBLE)",
    "sugars_good_percentile": "-sugars_100g",
    "salt_good_percentile": "-salt_equivalent_100g",
    "proteins_good_percentile": "proteins_100g",
    "sugars_percentile": "sugars_100g",
    "salt_percentile": "salt_equivalent_100g",
    "fat_percentile": "fat_100g",
    "saturated_fat_percentile": "saturated_fat_100g",
    "energy_percentile": "energy_kcal_100g",
    "price_percentile_within_peer": "price_median_clean",
}

ORACLE["peer_percentiles"] = _with(*BASE_CHAIN) + "\nSELECT code, " + ",\n  ".join(
    f"{prank(x, GK)} AS {n}" for n, x in PEER.items()) + "\nFROM base"
ORACLE["price_percentile"] = _with(*BASE_CHAIN) + f"""
SELECT code, {prank('price_median_clean', PK)} AS price_median_percentile FROM base"""


def wmed(x: str, keys: str) -> str:
    return (f"(0.5 * quantile_disc({x}, 0.5) OVER (PARTITION BY {keys})"
            f" + 0.5 * (-quantile_disc(-({x}), 0.5) OVER (PARTITION BY {keys})))")


COMPLETENESS = """CASE WHEN s IS NOT NULL THEN least(greatest(s, 0.0), 1.0) END"""
COMPLETENESS_RAW = """(0.50 * completeness + 0.15 * nutrient_field_fill_rate
      + 0.10 * CAST(has_ingredients_text AS DOUBLE) + 0.05 * CAST(has_labels_tags AS DOUBLE)
      - 0.12 * least(greatest(CAST(quality_warning_count AS DOUBLE), 0.0), 5.0) / 5.0
      - 0.08 * least(greatest(CAST(quality_error_count AS DOUBLE), 0.0), 3.0) / 3.0)"""
SCORED = f"""
scored AS (
  SELECT *, CASE WHEN cs IS NOT NULL THEN least(greatest(cs, 0.0), 1.0) END AS data_completeness_score
  FROM (SELECT *, {COMPLETENESS_RAW} AS cs FROM base)
)"""

Z = {
    "price_robust_z": "price_median_clean",
    "sugars_robust_z": "sugars_100g",
    "salt_robust_z": "salt_equivalent_100g",
    "saturated_fat_robust_z": "saturated_fat_100g",
    "nutriscore_robust_z": "nutriscore_score",
    "nova_robust_z": "CAST(nova_group AS DOUBLE)",
    "data_completeness_robust_z": "data_completeness_score",
}


def z_ctes(src: str, out: str) -> str:
    """Median, then MAD, then z for every measure of Z over GROUP keys."""
    meds = ",\n    ".join(f"{wmed(x, GK)} AS {n}__med" for n, x in Z.items())
    devs = ",\n    ".join(f"abs(({x}) - {n}__med) AS {n}__dev" for n, x in Z.items())
    mads = ",\n    ".join(f"{wmed(f'{n}__dev', GK)} AS {n}__mad" for n in Z)
    zs = ",\n    ".join(f"(({x}) - {n}__med) / ({n}__mad + 1e-6) AS {n}" for n, x in Z.items())
    return f"""
{out}_m AS (SELECT *, {meds} FROM {src}),
{out}_d AS (SELECT *, {devs} FROM {out}_m),
{out}_a AS (SELECT *, {mads} FROM {out}_d),
{out} AS (SELECT *, {zs} FROM {out}_a)"""


ORACLE["robust_z"] = _with(*BASE_CHAIN, SCORED, z_ctes("scored", "zt")) + "\nSELECT code, " + \
    ", ".join(Z) + " FROM zt"
ORACLE["completeness_score"] = _with(*BASE_CHAIN, SCORED) + f"""
SELECT code, data_completeness_score, {prank('data_completeness_score', GK)} AS data_completeness_percentile
FROM scored"""


def analysis_ctes(design: bool = False) -> str:
    pk = "location_osm_address_country_code, currency, analysis_category_tag" if design else PK
    if design:
        health = ("(0.45 * nutriscore_good_percentile + 0.25 * (1.0 - nova_scaled)"
                  " + 0.15 * (1.0 - sugars_percentile) + 0.10 * (1.0 - salt_percentile)"
                  " + 0.05 * proteins_good_percentile)")
    else:
        health = ("(0.45 * nutriscore_good_percentile + 0.25 * nova_good_percentile"
                  " + 0.15 * sugars_good_percentile + 0.10 * salt_good_percentile"
                  " + 0.05 * proteins_good_percentile)")
    pcts = ",\n    ".join(f"{prank(x, GK)} AS {n}" for n, x in PEER.items())
    return f"""
an_p AS (SELECT *, {pcts},
    {prank('price_median_clean', pk)} AS price_median_percentile FROM base),
an_s AS (SELECT *, CASE WHEN hs IS NOT NULL THEN least(greatest(hs, 0.0), 1.0) END AS health_score_composite,
    CASE WHEN cs IS NOT NULL THEN least(greatest(cs, 0.0), 1.0) END AS data_completeness_score
  FROM (SELECT *, {health} AS hs, {COMPLETENESS_RAW} AS cs FROM an_p)),
an_q AS (SELECT *, {prank('health_score_composite', GK)} AS health_score_percentile,
    {prank('data_completeness_score', GK)} AS data_completeness_percentile FROM an_s),
an_v AS (SELECT *, health_score_percentile - price_median_percentile AS price_nutrition_value_index FROM an_q),
{z_ctes('an_v', 'an_z').strip()},
analysis AS (
  SELECT code, product_name, brands, primary_brand_tag, analysis_country_tag,
    analysis_country_code, analysis_category_tag, nutriscore_grade, nutriscore_score,
    nova_group, energy_kcal_100g, energy_kj_100g, fat_100g, saturated_fat_100g,
    carbohydrates_100g, sugars_100g, proteins_100g, salt_100g, salt_equivalent_100g,
    fiber_100g, completeness, has_ingredients_text, has_labels_tags, labels_count,
    quality_warning_count, quality_error_count, nutrition_fields_present_count,
    nutrient_field_fill_rate, data_completeness_score, data_completeness_percentile,
    scans_n, unique_scans_n, currency, location_osm_address_country_code,
    price_record_count, price_min, price_median, price_mean, price_max,
    first_price_date, last_price_date, any_same_market_match, has_price,
    nutriscore_good_percentile, nova_good_percentile, sugars_good_percentile,
    salt_good_percentile, proteins_good_percentile, sugars_percentile, salt_percentile,
    fat_percentile, saturated_fat_percentile, energy_percentile, price_median_percentile,
    price_percentile_within_peer, health_score_composite, health_score_percentile,
    price_nutrition_value_index, price_robust_z, sugars_robust_z, salt_robust_z,
    saturated_fat_robust_z, nutriscore_robust_z, nova_robust_z,
    data_completeness_robust_z,
    0.20 * COALESCE(abs(price_robust_z), 0.0) + 0.20 * COALESCE(abs(sugars_robust_z), 0.0)
      + 0.15 * COALESCE(abs(salt_robust_z), 0.0) + 0.15 * COALESCE(abs(saturated_fat_robust_z), 0.0)
      + 0.10 * COALESCE(abs(nutriscore_robust_z), 0.0) + 0.10 * COALESCE(abs(nova_robust_z), 0.0)
      + 0.10 * COALESCE(abs(data_completeness_robust_z), 0.0) AS peer_anomaly_score,
    has_price AND price_median_percentile > 0.75 AND health_score_percentile < 0.25 AS flag_high_price_low_health,
    sugars_percentile > 0.80 AND nova_group >= 4 AS flag_high_sugar_high_nova,
    data_completeness_percentile < 0.20 AND quality_warning_count >= 2 AS flag_low_completeness_many_warnings
  FROM an_z
)"""


ANALYSIS_CHAIN = (*BASE_CHAIN, analysis_ctes())

ORACLE["products_analysis"] = _with(*ANALYSIS_CHAIN) + "\nSELECT * FROM analysis"
ORACLE["health_score"] = _with(*ANALYSIS_CHAIN) + \
    "\nSELECT code, health_score_composite, health_score_percentile FROM analysis"
ORACLE["value_index"] = _with(*ANALYSIS_CHAIN) + \
    "\nSELECT code, health_score_percentile, price_median_percentile, price_nutrition_value_index FROM analysis"
ORACLE["anomaly_score"] = _with(*ANALYSIS_CHAIN) + "\nSELECT code, peer_anomaly_score FROM analysis"
ORACLE["flags"] = _with(*ANALYSIS_CHAIN) + """
SELECT code, flag_high_price_low_health, flag_high_sugar_high_nova, flag_low_completeness_many_warnings
FROM analysis"""
ORACLE["analysis_design_variant"] = _with(*BASE_CHAIN, analysis_ctes(design=True)) + """
SELECT code, health_score_composite, price_median_percentile, price_nutrition_value_index FROM analysis"""

# ----------------------------------------------------------------- rollups

ORACLE["brand_concentration"] = _with(*PM_CHAIN) + """,
pb AS (SELECT analysis_country_tag, analysis_category_tag, primary_brand_tag, count(*) AS n
       FROM products_main WHERE primary_brand_tag IS NOT NULL GROUP BY ALL)
SELECT analysis_country_tag, analysis_category_tag,
  CAST(sum(n) AS BIGINT) AS branded_products, count(*) AS brands,
  CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS top_brand_share,
  CAST(sum(n * n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS hhi
FROM pb GROUP BY analysis_country_tag, analysis_category_tag"""

ORACLE["brand_shares"] = _with(*PM_CHAIN) + """
SELECT analysis_country_tag, analysis_category_tag, primary_brand_tag, count(*) AS n,
  CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY analysis_country_tag, analysis_category_tag) AS share
FROM products_main WHERE primary_brand_tag IS NOT NULL
GROUP BY analysis_country_tag, analysis_category_tag, primary_brand_tag"""

ORACLE["country_overview"] = _with(*ANALYSIS_CHAIN) + f"""
SELECT analysis_country_tag, count(code) AS products, {mean('health_score_composite')} AS avg_health_score,
  {mean('data_completeness_score')} AS avg_data_completeness_score,
  {mean('nutriscore_score')} AS avg_nutriscore_score, {mean('nova_group')} AS avg_nova_group
FROM analysis GROUP BY analysis_country_tag"""

_STRUCT = ["sugars_100g", "salt_equivalent_100g", "fat_100g", "energy_kcal_100g", "nutriscore_score", "nova_group"]


def _structure(view: str, member: str) -> str:
    parts = [f"SELECT '{view}' AS view, analysis_country_tag, {member} AS member, '{m}' AS measure, "
             f"count(v) AS n, {mean('v')} AS mean, {med('v')} AS median, {_nearest('v', 0.25)} AS p25, "
             f"{_nearest('v', 0.75)} AS p75, {_nearest('v', 0.95)} AS p95 "
             f"FROM (SELECT analysis_country_tag, {member}, CAST({m} AS DOUBLE) AS v FROM analysis) "
             f"GROUP BY analysis_country_tag, {member}" for m in _STRUCT]
    return "\nUNION ALL ".join(parts)


ORACLE["nutrition_structure"] = _with(*ANALYSIS_CHAIN) + "\n" + _structure(
    "category", "analysis_category_tag") + "\nUNION ALL " + _structure("brand", "primary_brand_tag")

ORACLE["anomaly_feed"] = _with(*ANALYSIS_CHAIN) + """
SELECT code, analysis_country_tag, analysis_category_tag, primary_brand_tag, price_median, sugars_100g,
  salt_equivalent_100g, health_score_composite, data_completeness_score, peer_anomaly_score,
  price_record_count, unique_scans_n
FROM analysis"""

ORACLE["currency_feed"] = _with(*ANALYSIS_CHAIN) + """
SELECT currency, code, analysis_country_tag, analysis_category_tag, any_same_market_match, price_median,
  price_median_percentile, health_score_composite, health_score_percentile, price_nutrition_value_index
FROM analysis WHERE has_price"""

ORACLE["product_detail"] = _with(*ANALYSIS_CHAIN) + """
SELECT * FROM analysis
WHERE code IN (SELECT code FROM analysis WHERE flag_high_price_low_health OR flag_high_sugar_high_nova
               OR flag_low_completeness_many_warnings)"""


# (task, position, source, dataset, metric), written out.
_TASKS = [
    ("T1_global_nutrition_structure", [
        ("rows", "products", "food_rows"), ("derived", "products", "valid_nutriscore_grade_a_to_e"),
        ("coverage", "products", "nutriscore_score"), ("coverage", "products", "nova_group"),
        ("nutrient", "products", "sugars"), ("nutrient", "products", "salt"), ("nutrient", "products", "fat")]),
    ("T2_price_health_relationship", [
        ("rows", "prices", "price_rows"), ("coverage", "prices", "price"), ("coverage", "prices", "currency"),
        ("coverage", "prices", "date"), ("derived", "prices", "price_currency_date_geo_ready"),
        ("join", "prices", "matched_price_rows_pct")]),
    ("T3_label_transparency", [
        ("coverage", "products", "completeness"), ("coverage", "products", "labels_tags"),
        ("coverage", "products", "ingredients_text")]),
    ("T4_peer_comparison_and_anomalies", [
        ("derived", "products", "has_country_category_and_brand"), ("join", "prices", "matched_price_rows_pct")]),
]
_TASK_VALUES = ", ".join(f"('{t}', {i}, '{s}', '{d}', '{m}')"
                         for t, ms in _TASKS for i, (s, d, m) in enumerate(ms))
ORACLE["task_readiness"] = _with(PRODUCTS_FX, PRICES_FX) + f""",
found AS (
  SELECT 'coverage' AS source, dataset, field AS metric, coverage_pct AS value FROM ({ORACLE["field_coverage"]})
  UNION ALL SELECT 'derived', dataset, metric, coverage_pct FROM ({ORACLE["derived_quality"]})
  UNION ALL SELECT 'nutrient', 'products', nutrient, coverage_pct FROM ({ORACLE["named_entry_coverage"]})
  UNION ALL SELECT 'join', 'prices', 'matched_price_rows_pct', matched_price_rows_pct FROM ({ORACLE["join_coverage"]})
  UNION ALL SELECT 'rows', 'products', 'food_rows', CAST(count(*) AS DOUBLE) FROM products_fx
  UNION ALL SELECT 'rows', 'prices', 'price_rows', CAST(count(*) AS DOUBLE) FROM prices_fx
)
SELECT w.task, CAST(w.position AS INTEGER) AS position, w.source, w.dataset, w.metric, f.value
FROM (VALUES {_TASK_VALUES}) w(task, position, source, dataset, metric)
LEFT JOIN found f ON f.source = w.source AND f.dataset = w.dataset AND f.metric = w.metric"""


# ------------------------------------------------------------------- jobs

def _tidy(report: str, source: str, keys: list[str], figures: list[str]) -> str:
    """One report as (report, item, figure, value) rows."""
    item = " || '/' || ".join(f"COALESCE(CAST(\"{k}\" AS VARCHAR), 'null')" for k in keys) or "''"
    return "\nUNION ALL\n".join(
        f"SELECT '{report}' AS report, {item} AS item, '{f}' AS figure, CAST(\"{f}\" AS DOUBLE) AS value FROM ({source})"
        for f in figures)


def _report(*parts: tuple[str, str, list[str], list[str]]) -> str:
    return "\nUNION ALL\n".join(_tidy(*p) for p in parts)


def _column_dist(chain: tuple[str, ...], src: str, col: str, where: str = "TRUE") -> str:
    return _with(*chain) + f"\nSELECT {col} AS value, count(*) AS count FROM {src} WHERE {where} GROUP BY 1"


_JOINED = ["unique_product_codes", "unique_price_product_codes", "matched_unique_product_codes",
           "price_rows_with_product_code", "matched_price_rows", "matched_unique_price_code_pct",
           "matched_price_rows_pct"]
_COUNTERS = ["aligned_price_rows", "unique_products_with_price", "products_with_price_pct", "same_market_rows",
             "same_market_rows_pct", "same_market_non_null_currency_rows", "same_market_non_null_currency_rows_pct",
             "unique_products_with_same_market_price", "unique_products_with_same_market_price_pct",
             "price_summary_rows"]
_KEPT = ["total_raw_product_rows", "preprocessed_product_rows", "preprocessed_product_pct_total",
         "products_with_price", "products_with_price_pct"]

ORACLE["row_counts"] = _with(PRODUCTS_FX, PRICES_FX) + """
SELECT 'products' AS dataset, count(*) AS rows FROM products_fx
UNION ALL SELECT 'prices', count(*) FROM prices_fx
UNION ALL SELECT 'absent', NULL"""

ORACLE["parquet_round_trip"] = _with(*PM_CHAIN) + """
SELECT code, brands_tags, fat_100g, labels_count FROM products_main"""

ORACLE["job_dataset_audit"] = _report(
    ("row_counts", f"SELECT * FROM ({ORACLE['row_counts']}) WHERE dataset <> 'absent'", ["dataset"], ["rows"]),
    ("field_coverage", ORACLE["field_coverage"], ["dataset", "field"], ["present_rows", "coverage_pct"]),
    ("derived_quality", ORACLE["derived_quality"], ["dataset", "metric"], ["present_rows", "coverage_pct"]),
    ("nutrient_coverage", ORACLE["named_entry_coverage"], ["nutrient"], ["present_rows", "coverage_pct"]),
    ("product_required_fields", f"SELECT * FROM ({ORACLE['schema_required']}) WHERE dataset = 'products'",
     ["group", "field"], ["present", "present_rows"]),
    ("price_required_fields", f"SELECT * FROM ({ORACLE['schema_required']}) WHERE dataset = 'prices'",
     ["group", "field"], ["present", "present_rows"]),
    ("numeric_profile", ORACLE["numeric_profile"], ["dataset", "column"], ["min", "median", "mean", "p95", "p99", "max"]),
    ("date_profile", ORACLE["date_profile"], ["min", "max"], ["present_rows"]),
    ("top_product_lists", ORACLE["top_array_values_nullkeep"], ["column", "value"], ["count"]),
    ("top_scalars", ORACLE["top_scalar_values"], ["dataset", "column", "value"], ["count"]),
    ("join_coverage", ORACLE["join_coverage"], [], _JOINED),
    ("task_readiness", ORACLE["task_readiness"], ["task", "source", "dataset", "metric"], ["position", "value"]),
    ("optional_rows", f"SELECT * FROM ({ORACLE['row_counts']}) WHERE dataset = 'absent'", [], ["rows"]))

ORACLE["job_filter_audit"] = _report(
    ("ladder", ORACLE["filter_ladder"], ["level"],
     ["count", "pct", "price_matched_count", "price_matched_pct_total", "price_matched_pct_filter"]),
    ("level_profile", ORACLE["level_profile"], [],
     ["rows", "unique_codes", "nutriscore_score_median", "nova_group_median", "completeness_median",
      "completeness_mean"]),
    ("level_top_lists", ORACLE["top_array_values"], ["column", "value"], ["count"]),
    ("level_nutriscore_dist", _column_dist((PRODUCTS_FX,), "products_fx", "nutriscore_grade", STRICT), ["value"], ["count"]),
    ("level_nova_dist", _column_dist((PRODUCTS_FX,), "products_fx", "nova_group", STRICT), ["value"], ["count"]))

ORACLE["job_preprocess"] = _report(
    ("preprocess_counters", ORACLE["preprocess_counters"], [], _KEPT),
    ("selected_tags", ORACLE["selected_tag_counts"], ["column", "tag"], ["position", "rows"]),
    ("alignment_counters", ORACLE["alignment_counters"], [], _COUNTERS),
    ("aligned_currencies", _column_dist(SUMMARY_CHAIN, "aligned", "currency"), ["value"], ["count"]),
    ("aligned_price_countries", _column_dist(SUMMARY_CHAIN, "aligned", "location_osm_address_country_code"),
     ["value"], ["count"]),
    ("product_countries", _column_dist(PM_CHAIN, "products_main", "analysis_country_tag"), ["value"], ["count"]),
    ("product_categories", _column_dist(PM_CHAIN, "products_main", "analysis_category_tag"), ["value"], ["count"]),
    ("median_price_by_currency", ORACLE["price_currency_medians"], ["currency"], ["rows", "median_price", "mean_price"]))

ORACLE["job_analysis_csv"] = f"""
SELECT row_number() OVER (ORDER BY code) - 1 AS index, * FROM ({ORACLE['products_analysis']})"""
