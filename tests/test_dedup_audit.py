"""Keep-first, top-1, top-k ties, coverage and the ladder on hand rows."""

from pyspark.sql import functions as F

from larder.operators import audit as A
from larder.operators.dedup import asc, desc, keep_first, top_one


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m")],
                               "code string, seq int, v string")
    got = {r.code: r.v for r in keep_first(df, ["code"], ["seq"]).collect()}
    assert got == {"a": "y", "b": "z", None: "m"}


def test_top_one_priority_and_ties(spark):
    df = spark.createDataFrame(
        [("p", True, 1, "B", "EUR"), ("p", False, 9, "A", "EUR"), ("p", True, 1, "A", None),
         ("p", True, 1, "A", "USD"), ("q", False, 2, None, "X"), ("q", False, 2, "Z", "X")],
        "k string, same boolean, n int, loc string, cur string")
    order = [*desc(F.col("same").cast("int")), *desc(F.col("n")), *asc("loc"), *asc("cur")]
    got = {r.k: (r.loc, r.cur) for r in top_one(df, ["k"], order).collect()}
    assert got == {"p": ("A", "USD"), "q": ("Z", "X")}


def test_top_values_tie_break_and_nulls(spark):
    df = spark.createDataFrame([(["b", "a", None],), (["a", "c"],), (None,), ([],), (["c", None],)],
                               "t array<string>")
    def top(limit, **kw):
        return {(r.value, r["count"]) for r in A.top_values_multi(df, {"t": (limit, ())}, explode=True, **kw).collect()}

    assert top(2) == {("a", 2), ("c", 2)}
    assert top(3, keep_null=True) == {("a", 2), ("c", 2), (None, 2)}
    assert top(5, keep_null=True) == {("a", 2), ("c", 2), (None, 2), ("b", 1)}


def test_field_coverage_skips_absent_and_empty_lists(spark):
    df = spark.createDataFrame([("x", []), (None, ["a"]), ("", None)], "s string, l array<string>")
    got = {r.field: (r.present_rows, r.coverage_pct) for r in A.field_coverage(df, ["s", "l", "nope"]).collect()}
    assert got == {"s": (2, 66.67), "l": (1, 33.33)}


def test_join_coverage(spark):
    products = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "code string")
    prices = spark.createDataFrame([("1",), ("1",), ("3",), (None,)], "product_code string")
    r = A.join_coverage(products, prices).first().asDict()
    assert r["unique_product_codes"] == 2
    assert r["unique_price_product_codes"] == 2
    assert r["matched_unique_product_codes"] == 1
    assert r["price_rows_with_product_code"] == 3
    assert r["matched_price_rows"] == 2
    assert r["matched_price_rows_pct"] == 66.67


def test_schema_profile_and_required_fields_count_rows(spark):
    rows = [(1, None, ["a"]), (2, "x", None), (3, "y", [])]
    df = spark.createDataFrame(rows, "id int, name string, tags array<string>")
    prof = {r.column: r for r in A.schema_profile(df).collect()}
    assert [prof[c].position for c in ("id", "name", "tags")] == [0, 1, 2]
    assert {c: (r.rows, r.non_null_rows) for c, r in prof.items()} == {
        "id": (3, 3), "name": (3, 2), "tags": (3, 2)}
    assert prof["tags"].is_list and not prof["name"].is_list
    req = {(r.group, r.field): (r.present, r.present_rows)
           for r in A.required_field_matrix(df, {"g": ["name", "missing"]}).collect()}
    assert req == {("g", "name"): (True, 2), ("g", "missing"): (False, None)}
