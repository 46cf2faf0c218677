"""Exact order statistics: freq/split method against windows and built-ins,
including a skewed group, ties, nulls and all-null groups."""

import random

from pyspark.sql import functions as F

from larder.operators.peers import peer_percentiles, robust_z
from window_checks import peer_percentiles_window, robust_z_window

from larder.operators.ranks import describe, group_median, median_and_mad, nearest_rank, value_counts, with_group


def _rows(seed=7, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # group "hot" holds most rows; "tiny" one row; "nulls" only null values
        g = "hot" if i % 10 < 7 else ("b" if i % 10 < 9 else None)
        x = None if i % 13 == 0 else float(rnd.randint(0, 40))
        y = float(rnd.random() * 100) if i % 17 else None
        rows.append((f"c{i}", g, x, y))
    rows.append(("tiny", "tiny", 3.0, 1.0))
    rows.append(("n1", "nulls", None, None))
    rows.append(("n2", "nulls", None, None))
    return rows


def test_percentiles_freq_equals_window(spark):
    df = spark.createDataFrame(_rows(), "code string, g string, x double, y double")
    m = {"px": F.col("x"), "pneg": -F.col("x"), "py": F.col("y")}
    a = {r.code: r for r in peer_percentiles(df, m, ["g"], range_rows=4).collect()}
    b = {r.code: r for r in peer_percentiles_window(df, m, ["g"]).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in m:
            assert a[k][c] == b[k][c], (k, c, a[k][c], b[k][c])
    # average rank / all rows: pct(x) + pct(-x) = (n_nonnull + 1) / n_all
    assert a["tiny"]["px"] == 1.0
    assert a["n1"]["px"] is None


def test_cutting_groups_does_not_change_the_result(spark):
    df = spark.createDataFrame(_rows(3), "code string, g string, x double, y double")
    m = {"py": F.col("y")}
    base = {r.code: r.py for r in peer_percentiles(df, m, ["g"], range_rows=10_000).collect()}
    for s in (1, 5, 32, 300):
        got = {r.code: r.py for r in peer_percentiles(df, m, ["g"], range_rows=s).collect()}
        assert got == base


def test_median_matches_builtin(spark):
    df = spark.createDataFrame(_rows(11), "code string, g string, x double, y double")
    base = with_group(df, ["g"])
    for col in ("x", "y"):
        got = {r["_g"]["g"]: r["median"] for r in group_median(value_counts(base, col), col, range_rows=4).collect()}
        exp = {r.g: r.m for r in df.groupBy("g").agg(F.median(col).alias("m")).collect() }
        assert got == exp


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 13)], "v double")
    base = with_group(df, [])
    r = nearest_rank(value_counts(base, "v"), "v", {"p95": 0.95, "p50": 0.5}, range_rows=3).first()
    # 0-based index floor((n-1)q + .5): n=12 -> 11 (value 12)?  (11*0.95=10.45 -> 10 -> value 11)
    assert r.p95 == 11.0
    assert r.p50 == 7.0   # 11*0.5 = 5.5 -> 6 -> value 7


def test_robust_z_freq_equals_window(spark):
    df = spark.createDataFrame(_rows(5), "code string, g string, x double, y double")
    m = {"zx": F.col("x"), "zy": F.col("y")}
    a = {r.code: r for r in robust_z(df, m, ["g"], range_rows=4).collect()}
    b = {r.code: r for r in robust_z_window(df, m, ["g"]).collect()}
    for k in a:
        for c in m:
            assert a[k][c] == b[k][c], (k, c)


def test_zero_mad_group(spark):
    rows = [(f"c{i}", "g", 4.0) for i in range(5)] + [("out", "g", 5.0)]
    df = spark.createDataFrame(rows, "code string, g string, x double")
    z = {r.code: r.z for r in robust_z(df, {"z": F.col("x")}, ["g"]).collect()}
    assert z["c0"] == 0.0
    assert abs(z["out"] - 1e6) < 1e-3
    capped = {r.code: r.z for r in robust_z(df, {"z": F.col("x")}, ["g"], z_cap=10.0).collect()}
    assert capped["out"] == 10.0


def test_analysis_does_not_depend_on_the_ranges(spark):
    from larder.plans.analysis import AnalysisSpec, build_analysis
    from larder.plans.fixture_spec import fixture_prices
    from paths import SF_SMALL
    _, _, products, _, summary = fixture_prices(spark, SF_SMALL)
    cols = ["code", "nutriscore_good_percentile", "price_median_percentile", "health_score_percentile",
            "data_completeness_percentile", "price_robust_z", "nova_robust_z", "peer_anomaly_score"]
    a = {r.code: r for r in build_analysis(products, summary, AnalysisSpec(range_rows=4))
         .select(*cols).collect()}
    b = {r.code: r for r in build_analysis(products, summary, AnalysisSpec())
         .select(*cols).collect()}
    assert a == b and len(a) > 0


def test_per_measure_keys_share_one_pass(spark):
    rows = [(f"c{i}", "a" if i % 3 else None, "u" if i % 2 else "v", float(i % 7) if i % 5 else None)
            for i in range(120)]
    df = spark.createDataFrame(rows, "code string, g string, h string, x double")
    m = {"by_g": F.col("x"), "by_gh": (F.col("x"), ["g", "h"]), "by_h": (-F.col("x"), ["h"])}
    a = {r.code: r for r in peer_percentiles(df, m, ["g"], range_rows=3).collect()}
    b = {r.code: r for r in peer_percentiles_window(df, m, ["g"]).collect()}
    assert a == b


def test_prefix_counts_of_a_hot_group(spark):
    from larder.operators.ranks import prefix_counts
    rows = [("hot", float(i % 997)) for i in range(5000)] + [(f"g{i}", float(i)) for i in range(300)]
    rows += [("hot", None)] * 40
    freq = value_counts(with_group(spark.createDataFrame(rows, "g string, v double"), ["g"]), "v")
    exp = {}
    for g, v in rows:
        exp.setdefault(g, []).append(v)
    for limit, cut in ((None, False), (50, True), (900, True), (5000, False)):
        pref, was_cut = prefix_counts(freq, "v", range_rows=limit)
        assert was_cut == cut
        for r in pref.collect():
            own = [x for x in exp[r["_g"]["g"]] if x is not None]
            if r["v"] is not None:
                assert (r["below"], r["n"], r["c"]) == (sum(x < r["v"] for x in own), len(own), own.count(r["v"]))


def test_one_value_with_a_third_of_all_rows(spark):
    """A very frequent value of a group that is cut is a range of its own."""
    rnd = random.Random(2)
    rows = [(f"c{i}", "hot" if i % 5 else "b", 4.0 if i % 3 == 0 else None if i % 11 == 0 else float(rnd.randint(0, 9)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "code string, g string, x double")
    m = {"p": F.col("x"), "q": -F.col("x")}
    b = {r.code: r for r in peer_percentiles_window(df, m, ["g"]).collect()}
    for limit in (None, 100, 5):
        assert {r.code: r for r in peer_percentiles(df, m, ["g"], range_rows=limit).collect()} == b


def test_ranks_take_one_exchange_of_the_stacked_rows(spark):
    df = spark.createDataFrame(_rows(), "code string, g string, x double, y double")
    out = peer_percentiles(df, {"px": F.col("x"), "py": F.col("y")}, ["g"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # by (group, measure), and back by id; the other one is the wide side of the last join
    assert plan.count("Exchange hashpartitioning") == 3, plan
    assert plan.count("Exchange hashpartitioning(_g") == 1


def test_median_and_mad_read_one_written_table(spark):
    df = with_group(spark.createDataFrame(_rows(9), "code string, g string, x double, y double"), ["g"])
    stats = median_and_mad(value_counts(df, "y"), "y")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1, plan
    cut = median_and_mad(value_counts(df, "y"), "y", range_rows=7)
    assert sorted(stats.collect(), key=str) == sorted(cut.collect(), key=str) != []


def test_counts_of_batches_add_up(spark):
    from larder.operators.ranks import add_counts
    df = with_group(spark.createDataFrame(_rows(13), "code string, g string, x double, y double"), ["g"])
    carry = {"least": (F.min("code"), F.min), "some": (F.bool_or(F.col("y") > 90), F.bool_or)}
    def out(freq):
        got = describe(freq, "x", median="median", mean="mean", qs={"p9": 0.9}, carry=carry)
        return sorted(got.collect(), key=str)
    whole = out(value_counts(df, "x", carry=carry, mean=True))
    parts = [value_counts(df.filter(F.col("code").rlike(p)), "x", carry=carry, mean=True) for p in ("[0-4]$", "[^0-4]$")]
    assert out(add_counts(parts, "x", carry=carry)) == whole


def test_sums_of_equal_values_are_exact(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from larder.operators.ranks import times, value_counts
    pairs = [(0.1, 3), (-2.5, 10**9), (99999999.123, 7 * 10**9 + 5), (9e16, 999_999_999), (0.00000000015, 2), (None, 4)]
    got = spark.createDataFrame(pairs, "v double, c long").select(times(F.col("v"), F.col("c")).alias("s")).collect()
    step = Decimal(1).scaleb(-10)
    want = [None if v is None else Decimal(repr(v)).quantize(step, "ROUND_HALF_UP") * c for v, c in pairs]
    assert [r.s for r in got] == want
    rows = [(v,) for v in (1.1, 1.1, None, 2e17, 2e17, 3.3333333333333) for _ in range(3)]
    counts = value_counts(spark.createDataFrame(rows, "v double"), "v", by=[], mean=True)
    assert {r.v: (r.c, r._sum) for r in counts.collect()} == {
        1.1: (6, Decimal("6.6")), None: (3, None), 2e17: (6, Decimal("1.2e18")), 3.3333333333333: (3, Decimal("9.9999999999"))}


def test_thousandths_are_the_cast(spark):
    import random

    from pyspark.sql import functions as F

    from larder.sources.fixtures import _thousandths
    random.seed(5)
    x = [0.0, -0.0, 1.0005, 2.0015, -1.0005, 0.0005, 999999.9995, 1e6 + 0.0005, 9999999.999, None, 1e-9]
    x += [random.uniform(-1e6, 1e6) for _ in range(3000)] + [random.randrange(10**9) / 10**4 + 0.00005 for _ in range(3000)]
    x += [round(random.uniform(0, 2000), 4) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    far = df.filter(~_thousandths(F.col("x")).eqNullSafe(F.col("x").cast("decimal(10,3)")))
    assert _thousandths(F.col("x")) is not None and far.collect() == []
    assert df.select(_thousandths(F.col("x")).alias("p")).schema["p"].dataType.simpleString() == "decimal(10,3)"
