"""File-stream alignment and the sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from larder.operators.align import align_prices
from larder.plans.fixture_spec import fixture_products_main
from larder.sources import io
from larder.streaming.prices import price_stream, start_alignment, summary_of_sink

from paths import SF_SMALL


def _sorted(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_stream_alignment_equals_batch(spark):
    raw, prices, products = fixture_products_main(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-stream-")
    src, sink = os.path.join(root, "in"), os.path.join(root, "out")
    # two arrivals of price files
    prices.filter(F.col("l_orderkey") % 2 == 0).write.parquet(os.path.join(src, "a"))
    prices.filter(F.col("l_orderkey") % 2 == 1).write.parquet(os.path.join(src, "b"))
    stream = price_stream(spark, os.path.join(src, "*"), prices.schema)
    q = start_alignment(stream, products, sink, checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    cols = ["id", "product_code", "price_value", "currency", "same_market_as_analysis_country"]
    assert _sorted(spark.read.parquet(sink), cols) == _sorted(align_prices(prices, products), cols)
    assert summary_of_sink(spark, sink).count() > 0


def test_summary_over_a_stream(spark):
    """Every batch reads its own price rows only, and the summary none."""
    from larder.operators import align
    from larder.streaming import prices as P
    _, prices, products = fixture_products_main(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-stream-")
    src, sink, state = (os.path.join(root, d) for d in ("in", "out", "state"))
    parts = 7
    read = []
    counted = P.price_counts

    def counts(aligned, keys):
        read.append({f.split("/out/")[1].split("/")[0] for f in aligned.inputFiles()})
        return counted(aligned, keys)

    P.price_counts = counts
    try:
        for k in range(parts):      # one arrival after the other, each run of the query resumes
            prices.filter(F.col("l_orderkey") % parts == k).coalesce(1).write.mode("append").parquet(src)
            q = P.start_summary(P.price_stream(spark, src, prices.schema), products, sink, state,
                                checkpoint=os.path.join(root, "ckpt"), compact_every=3)
            q.awaitTermination(120)
            assert q.exception() is None
    finally:
        P.price_counts = counted
    assert read == [{f"batch={k}"} for k in range(parts)]
    got = P.summary_of_state(spark, state, parts - 1, compact_every=3)
    want = align.summarise_prices(align_prices(prices, products))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)
    assert P._tables_up_to(parts - 1, 3) == ["upto=5", "batch=6"]
    plan = P.add_counts(P._read(spark, state, P._tables_up_to(parts - 1, 3)), "price_value", carry=align.price_carried())
    assert {f.split("/state/")[1].split("/")[0] for f in plan.inputFiles()} == {"upto=5", "batch=6"}


def test_csv_row_numbers(spark):
    rows = [(f"k{i * 7919 % 1000:04d}", 'a "quoted", text\\' if i % 3 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "code string, t string, v int").repartition(6)
    out = io.with_row_numbers(df, "code")
    assert [(r["index"], r["code"]) for r in out.orderBy("index").collect()] == [
        *enumerate(sorted(r[0] for r in rows))]
    path = os.path.join(tempfile.mkdtemp(prefix="larder-csv-"), "csv")
    io.export_csv(df, path, index="code")
    back = spark.read.schema("index long, code string, t string, v int").option("header", True).option(
        "escape", '"').csv(path)
    assert sorted(map(tuple, back.collect())) == sorted((r["index"], r["code"], r["t"], r["v"]) for r in out.collect())


def _scanned(df):
    """Rows that the scans of an executed DataFrame gave to the rest of the plan."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("Scan", "FileScan")):
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        nodes += [kids.apply(k) for k in range(kids.size())]
    return total


def test_a_lookup_reads_few_row_groups(spark):
    rows = spark.range(200_000).select(F.format_string("%08d", F.col("id") * 3).alias("code"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("rest"))
    root = tempfile.mkdtemp(prefix="larder-lookup-")
    plain, clustered = os.path.join(root, "plain"), os.path.join(root, "clustered")
    rows.repartition(4).write.option("parquet.block.size", str(1 << 20)).parquet(plain)
    io.write_clustered(rows, clustered, "code", row_group_bytes=1 << 20, page_rows=1000)
    found, missing = (F.col("code") == "00300000"), (F.col("code") == "00300001")
    old = {p: [_scanned(spark.read.parquet(p).filter(c)) for c in (found, missing)] for p in (plain, clustered)}
    assert spark.read.parquet(clustered).filter(found).count() == 1
    assert min(old[plain]) >= 50_000, old
    # the pages that may hold it; and nothing at all of a code that isn't there
    assert old[clustered][0] <= 2000 and old[clustered][1] == 0, old


def test_bucketed_tables_are_joined_where_they_are(spark):
    from larder.operators.align import summarise_prices
    from larder.plans.analysis import base_table
    _, prices, products = fixture_products_main(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-bucket-")
    bucketed = io.write_bucketed(products, "larder_products_test", "code", os.path.join(root, "products"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        aligned = align_prices(prices, bucketed)
        summary = io.stage(summarise_prices(aligned), "bucket-summary")
        base = base_table(bucketed, summary)
        for df, key in ((aligned, "product_code"), (base, "product_code")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            moved = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
            # only the prices move; the catalogue is read in its buckets
            assert moved and all(key in x for x in moved), plan
            assert "Bucketed: true" in plan
        want = base_table(products, summary)
        assert _sorted(base, want.columns) == _sorted(want, want.columns)
        assert aligned.count() == align_prices(prices, products).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS larder_products_test")


def test_sinks_roundtrip(spark):
    raw, prices, products = fixture_products_main(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-sink-")
    io.write_table(products, os.path.join(root, "pm"), sort_within=["code"])
    back = io.read_table(spark, os.path.join(root, "pm"), columns=["code", "brands"])
    assert back.count() == products.count()
    io.export_csv(products, os.path.join(root, "csv"))
    csv = spark.read.option("header", True).option("escape", '"').csv(os.path.join(root, "csv"))
    assert csv.count() == products.count()
    assert set(csv.columns) == set(products.columns)
    staged = io.stage(products.select("code"), "t")
    assert staged.count() == products.count()
    sizes = io.file_sizes(spark.read.parquet(f"{SF_SMALL}/part.parquet")).collect()
    assert len(sizes) == 1 and sizes[0].file_size > 0
    assert io.optional_row_count(spark, os.path.join(root, "missing")).first().rows is None


def test_narrow_nested_read_prunes_struct_fields(spark):
    root = tempfile.mkdtemp(prefix="larder-narrow-")
    path = os.path.join(root, "p")
    spark.createDataFrame(
        [("1", [{"name": "fat", "100g": 1.0, "unit": "g", "serving": 2.0}])],
        "code string, nutriments array<struct<name:string,`100g`:double,unit:string,serving:double>>"
    ).write.parquet(path)
    narrow = f"code string, nutriments {io.NARROW_NUTRIMENTS}"
    df = io.read_table(spark, path, schema=narrow)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "unit" not in plan and "serving" not in plan
    from larder.functions.nested import named_value, with_values
    assert df.select(named_value(with_values("nutriments"), "fat")).first()[0] == 1.0


def test_clustered_and_partitioned_writes(spark):
    from larder.operators.rollups import write_currency_feed
    _, _, products = fixture_products_main(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="larder-cluster-")
    io.write_clustered(products, os.path.join(root, "by_code"), "code")
    assert spark.read.parquet(os.path.join(root, "by_code")).count() == products.count()
    fake = products.select("code", "analysis_country_tag", "analysis_category_tag").withColumns({
        "has_price": F.lit(True), "currency": F.lit("A"), "any_same_market_match": F.lit(False),
        "price_median": F.lit(1.0), "price_median_percentile": F.lit(0.5),
        "health_score_composite": F.lit(0.5), "health_score_percentile": F.lit(0.5),
        "price_nutrition_value_index": F.lit(0.0)})
    write_currency_feed(fake, os.path.join(root, "feed"))
    assert os.path.isdir(os.path.join(root, "feed", "currency=A"))
