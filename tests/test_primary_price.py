"""The priority of a same-market match is a number of records."""

from larder.plans.analysis import primary_price


def test_many_records_outweigh_a_same_market_match(spark):
    rows = [("p", "FR", "EUR", 10, True), ("p", "DE", "EUR", 150_000, False),
            ("q", "FR", "EUR", 10, True), ("q", "DE", "EUR", 90_000, False),
            ("r", "FR", "EUR", 10, True), ("r", "DE", "EUR", 100_010, False)]
    summary = spark.createDataFrame(rows, "product_code string, location_osm_address_country_code string, "
                                          "currency string, price_record_count int, any_same_market_match boolean")
    for c in ("analysis_country_tag", "analysis_country_code", "analysis_category_tag"):
        summary = summary.withColumn(c, summary.product_code)
    got = {r.product_code: r.location_osm_address_country_code for r in primary_price(summary).collect()}
    # "r" has equal priorities: then the most records
    assert got == {"p": "DE", "q": "FR", "r": "DE"}
