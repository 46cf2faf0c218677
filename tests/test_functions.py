"""Unit rows for the column functions."""

from pyspark.sql import functions as F

from larder.functions import nested as N
from larder.functions import predicates as P
from larder.functions import scalars as S

NUT = "array<struct<name:string,`100g`:double>>"


def test_has_list_and_named_entry(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, [], []), (3, [None], [{"name": None, "100g": None}]),
         (4, ["a"], [{"name": "fat", "100g": None}])],
        f"id int, tags array<string>, nut {NUT}")
    out = {r.id: r for r in df.select(
        "id", P.has_list("tags").alias("hl"), P.has_named_entry("fat", "nut").alias("hn")).collect()}
    assert [out[i].hl for i in (1, 2, 3, 4)] == [False, False, True, True]
    # false on null / empty / null name; true when present even with a null value
    assert [out[i].hn for i in (1, 2, 3, 4)] == [False, False, False, True]


def test_named_value_first_non_null(spark):
    df = spark.createDataFrame(
        [(1, [{"name": "fat", "100g": None}, {"name": "fat", "100g": 5.0}]),
         (2, [{"name": "salt", "100g": 1.0}]), (3, None), (4, [])],
        f"id int, nut {NUT}")
    got = {r.id: r.v for r in df.select("id", N.named_value(N.with_values("nut"), "fat").alias("v")).collect()}
    assert got == {1: 5.0, 2: None, 3: None, 4: None}


def test_first_last_match_and_first_text(spark):
    df = spark.createDataFrame(
        [(1, ["x", "a", "b", "a"]), (2, ["x"]), (3, None), (4, [None, "b"])], "id int, t array<string>")
    rows = {r.id: r for r in df.select(
        "id", N.first_match("t", ["a", "b"]).alias("f"), N.last_match("t", ["a", "b"]).alias("l"),
        N.first_tag("t").alias("ft"), N.size_or_zero("t").alias("n")).collect()}
    assert (rows[1].f, rows[1].l, rows[1].ft, rows[1].n) == ("a", "a", "x", 4)
    assert (rows[2].f, rows[2].l) == (None, None)
    assert (rows[3].f, rows[3].l, rows[3].ft, rows[3].n) == (None, None, None, 0)
    assert (rows[4].f, rows[4].l, rows[4].ft, rows[4].n) == ("b", "b", "b", 2)
    t = spark.createDataFrame([([{"lang": "de", "text": None}, {"lang": "en", "text": "Hi"}],)],
                              "p array<struct<lang:string,text:string>>")
    assert t.select(N.first_text("p")).first()[0] == "Hi"


def test_clip_safe_div_pct(spark):
    df = spark.createDataFrame([(-1.0, 0), (0.5, 2), (2.0, 0), (None, None)], "x double, d int")
    rows = df.select(S.clip("x", 0.0, 1.0).alias("c"), S.safe_div(F.lit(1.0), F.col("d")).alias("q")).collect()
    assert [r.c for r in rows] == [0.0, 0.5, 1.0, None]
    assert [r.q for r in rows] == [None, 0.5, None, None]
    ties = spark.createDataFrame([(1, 800), (1, 32), (3, 800)], "n long, t long")
    assert [r[0] for r in ties.select(S.pct("n", "t")).collect()] == [0.12, 3.12, 0.38]
    p = spark.createDataFrame([(1, 8), (3, 600), (203, 20000), (0, 0)], "n long, t long")
    got = [r[0] for r in p.select(S.pct("n", "t", zero=None)).collect()]
    # exact ratios, ties to even: 12.5, 0.5, 1.015 -> 1.02 (a binary double would give 1.01), 0 -> None
    assert got == [12.5, 0.5, 1.02, None]


def test_map_code_and_fallbacks(spark):
    df = spark.createDataFrame([("a", 1.0, None, None), ("z", None, 4.184, None), (None, None, None, 8.368)],
                               "t string, kcal double, kj double, gen double")
    rows = df.select(S.map_code("t", {"a": "A"}).alias("m"),
                     S.energy_kcal("kcal", "kj", "gen").alias("kc"),
                     S.energy_kj("kcal", "kj", "gen").alias("kj")).collect()
    assert [r.m for r in rows] == ["A", None, None]
    assert [round(r.kc, 9) for r in rows] == [1.0, 1.0, 2.0]
    assert [round(r.kj, 9) for r in rows] == [4.184, 4.184, 8.368]


def test_count_present_salt_or_sodium(spark):
    df = spark.createDataFrame([(1.0, None, None), (None, 2.0, 3.0), (None, None, None)],
                               "a double, salt double, sodium double")
    got = [r[0] for r in df.select(S.count_present(["a", ("salt", "sodium")])).collect()]
    assert got == [1, 1, 0]
