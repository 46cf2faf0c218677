"""Catalogue-shaped and price-shaped views over the given test tables.

The reference reads a nested product catalogue and a price-observation
table; the test data has neither, so both are derived, row for row, from
``part`` (products) and ``lineitem`` (prices).  Every rule is a pure
function of one input row, so the views scale with their tables and can be
written identically in DuckDB (see ``larder.oracle``).  The moduli only
choose which rows carry a null, an empty list, a duplicate code or an
unmatched barcode; no row is ever dropped.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The country-code map used with the fixture (k = 0..8 map to
# "Nk"; nation_9 is left out on purpose so the null default is exercised).
FIXTURE_COUNTRY_CODES = {f"nation_{k}": f"N{k}" for k in range(9)}


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(c: Column) -> Column:
    return c.cast("string")


def _empty_str_array() -> Column:
    return F.array().cast("array<string>")


def _text_struct(lang: str, text: Column) -> Column:
    return F.struct(F.lit(lang).alias("lang"), text.cast("string").alias("text"))


def _nutrient(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.cast("double").alias("100g"))


def _thousandths(x: Column) -> Column:
    """``x.cast("decimal(10,3)")`` of a double.  Spark's cast goes through the
    number's text; a number whose thousandths are far from a tie rounds to the
    same decimal as a whole number, which takes a fraction of the time."""
    scaled = x * F.lit(1000.0)
    whole = F.rint(scaled)
    plain = (F.abs(x) < F.lit(1e6)) & (F.abs(scaled - whole) < F.lit(0.49))
    by_thousand = whole.cast("int").cast("decimal(10,0)") * F.lit(Decimal("0.001"))
    return F.when(plain, by_thousand.cast("decimal(10,3)")).otherwise(x.cast("decimal(10,3)"))


def whole_rows(view: DataFrame) -> DataFrame:
    """``view`` with every column made once for each row.  A filter over many
    columns of a view is otherwise rewritten in terms of the table below it, and
    each mention of a column builds that column's lists again."""
    return view.select(F.inline(F.array(F.struct(*[F.col(c) for c in view.columns]))))


def products_view(part: DataFrame) -> DataFrame:
    """``products_fx``: one catalogue row per part, plus a second copy of every
    50th part (``dup = 1``) so that keep-first dedup has work to do."""
    p = F.col("p_partkey")
    copies = F.when(p % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    src = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", F.explode(copies).alias("dup"))
    size = F.col("p_size")

    energy_name = (
        F.when(p % 3 == 0, F.lit("energy-kcal"))
        .when(p % 3 == 1, F.lit("energy-kj"))
        .otherwise(F.lit("energy"))
    )
    nutriments = F.array(
        _nutrient(energy_name, size * 10),
        _nutrient(F.lit("fat"), F.when(p % 17 != 0, size)),
        _nutrient(F.lit("saturated-fat"), size),
        _nutrient(F.lit("carbohydrates"), size + 5),
        _nutrient(F.lit("sugars"), p % 40),
        _nutrient(F.lit("proteins"), p % 25),
        _nutrient(F.when(p % 3 == 0, F.lit("sodium")).otherwise(F.lit("salt")), p % 7),
        _nutrient(F.lit("fiber"), F.when(p % 2 != 0, p % 11)),
    )

    return src.select(
        _str(p).alias("code"),
        (p * 2 + F.col("dup")).alias("src_seq"),
        F.when(
            p % 31 != 0,
            F.array(
                _text_struct("main", F.when(p % 37 != 0, F.col("p_name"))),
                _text_struct("en", F.upper("p_name")),
            ),
        ).alias("product_name"),
        F.when(p % 27 != 0, F.col("p_brand")).alias("brands"),
        F.when(p % 27 == 0, _empty_str_array())
        .otherwise(F.array(F.lit(None).cast("string"), F.lower("p_brand")))
        .alias("brands_tags"),
        F.when(p % 41 == 0, F.lit(None).cast("array<string>"))
        .when(p % 43 == 0, _empty_str_array())
        .otherwise(F.array(F.concat(F.lit("nation_"), _str(p % 25)),
                           F.concat(F.lit("nation_"), _str((p * 7) % 10))))
        .alias("countries_tags"),
        F.when(p % 47 == 0, _empty_str_array())
        .otherwise(F.array(F.lower("p_type"), F.concat(F.lit("size-"), _str(size % 5))))
        .alias("categories_tags"),
        F.when(p % 19 != 0, F.array(F.concat(F.lit("group-"), _str(size % 3))))
        .alias("food_groups_tags"),
        F.when(p % 5 != 0, F.array(_text_struct("main", F.col("p_name")))).alias("ingredients_text"),
        F.when(p % 4 == 0, F.lit(None).cast("array<string>"))
        .when(p % 4 == 1, _empty_str_array())
        .otherwise(F.array(F.col("p_type"), F.lit("x")))
        .alias("labels_tags"),
        F.when(p % 53 == 0, F.lit(None).cast("array<string>"))
        .when(p % 6 == 0, _empty_str_array())
        .when(p % 6 < 4, F.array(F.lit("w1")))
        .otherwise(F.array(F.lit("w1"), F.lit("w2"), F.lit("w3")))
        .alias("data_quality_warnings_tags"),
        F.when(p % 9 == 0, F.array(F.lit("e1"))).alias("data_quality_errors_tags"),
        F.when(p % 29 != 0, (size % 60 - 15)).cast("int").alias("nutriscore_score"),
        F.when((p % 29 == 0) & (p % 2 == 0), F.lit(None).cast("string"))
        .when(p % 29 == 0, F.lit("unknown"))
        .otherwise(F.substring(F.lit("abcde"), (p % 5 + 1).cast("int"), 1))
        .alias("nutriscore_grade"),
        F.when(p % 33 == 0, F.lit(None).cast("int"))
        .when(p % 3 == 0, (size % 4 + 1).cast("int"))
        .otherwise(F.lit(4))
        .alias("nova_group"),
        (((p + F.col("dup")) % 23).cast("double") / F.lit(20.0)).alias("completeness"),
        size.cast("int").alias("scans_n"),
        (size - 1).cast("int").alias("unique_scans_n"),
        F.when(p % 23 != 0, nutriments).alias("nutriments"),
    )


def prices_view(lineitem: DataFrame) -> DataFrame:
    """``prices_fx``: one price observation per line item."""
    ok = F.col("l_orderkey")
    pk = F.col("l_partkey")
    sk = F.col("l_suppkey")
    code = F.when(
        ok % 97 != 0,
        _str(pk + F.when(ok % 89 == 0, F.lit(1000000)).otherwise(F.lit(0))),
    )
    loc_code = F.when(sk % 31 != 0, F.concat(F.lit("N"), _str(sk % 10)))
    discounted = F.col("l_discount") > 0.05
    return lineitem.select(
        (ok * 8 + F.col("l_linenumber")).alias("id"),
        F.when(code.isNotNull(), F.lit("PRODUCT")).otherwise(F.lit("CATEGORY")).alias("type"),
        code.alias("product_code"),
        F.concat(F.lit("item "), _str(pk)).alias("product_name"),
        F.when(code.isNull(), F.lit("en:unknown")).alias("category_tag"),
        _thousandths(F.when(ok % 101 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))).alias("price"),
        discounted.alias("price_is_discounted"),
        F.when(discounted, _thousandths(F.col("l_extendedprice"))).alias("price_without_discount"),
        F.when(pk % 3 != 0, F.lit("UNIT")).alias("price_per"),
        F.when(ok % 37 != 0, F.col("l_returnflag")).alias("currency"),
        F.when(ok % 103 != 0, F.col("l_shipdate").cast("date")).alias("date"),
        F.when(F.col("l_linestatus") == "O", F.lit("RECEIPT")).otherwise(F.lit("PRICE_TAG")).alias("proof_type"),
        F.when(sk % 2 == 0, F.lit("web")).otherwise(F.lit("app")).alias("source"),
        F.when(loc_code.isNotNull(), F.concat(F.lit("nation "), _str(sk % 10))).alias("location_osm_address_country"),
        loc_code.alias("location_osm_address_country_code"),
        F.concat(F.lit("city-"), _str(sk % 20)).alias("location_osm_address_city"),
        F.when(sk % 29 != 0, (sk % 90).cast("double")).alias("location_osm_lat"),
        (pk % 180).cast("double").alias("location_osm_lon"),
        "l_orderkey",
        "l_linenumber",
    )


def load_fixtures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(products_fx, prices_fx) for one scale-factor directory."""
    return (products_view(read_given(spark, sf_dir, "part")),
            prices_view(read_given(spark, sf_dir, "lineitem")))
