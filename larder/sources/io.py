"""Reading and writing tables.

* Reads take an optional narrow schema: for list-of-struct columns Spark does
  not prune struct fields through lambdas, so reading ``nutriments`` as
  ``array<struct<name,100g>>`` is what keeps 7 of 9 fields off the wire.
* Writes are plain DataFrame writes (task-at-a-time, overwrite), optionally
  partitioned or sorted within partitions so file statistics prune later
  lookups.
* Counts of a table that is being written are taken while it is written
  (``observed``), so that no report scans it again.
* Stage hand-off (A8) goes through a written table in the session's
  checkpoint folder, which on a cluster is a shared location, so a lost
  executor never loses a stage that later stages read.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.session import ensure_checkpoint_dir

# The nutriment fields the operators read (of the nine in the raw schema).
NARROW_NUTRIMENTS = "array<struct<name:string,`100g`:double>>"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A1: lazy Parquet scan; ``schema`` narrows nested reads, ``columns``
    projects (Catalyst prunes the rest from ``ReadSchema``)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def row_count(df: DataFrame | None) -> DataFrame:
    """A4: one-row total; an absent optional input gives a null count."""
    if df is None:
        raise ValueError("pass the DataFrame; use optional_row_count for absent inputs")
    return df.agg(F.count(F.lit(1)).alias("rows"))


def optional_row_count(spark: SparkSession, path: str) -> DataFrame:
    """A4 for an optional input: null rows when the path does not exist."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([(None,)], "rows bigint")
    return row_count(found)


def file_sizes(df: DataFrame) -> DataFrame:
    """A2 (size part): bytes per input file from the scan's ``_metadata``."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .distinct())


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    """A5: streamed write, one file set per task."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_clustered(df: DataFrame, path: str, key: str, mode: str = "overwrite",
                    row_group_bytes: int | None = None, page_rows: int = 2000) -> None:
    """A5 for lookup tables (K6): range-partition and sort by ``key`` so each
    file covers a narrow key range, and write a Bloom filter and a page index
    of the key: a lookup skips files and row groups by their least and largest
    key or by the filter, and reads only the pages that hold the key."""
    writer = (df.repartitionByRange(key).sortWithinPartitions(key).write.mode(mode)
              .option(f"parquet.bloom.filter.enabled#{key}", "true")
              .option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
              .option("parquet.page.row.count.limit", str(page_rows)))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int | None = None) -> DataFrame:
    """A5 for tables that are joined by ``key`` again and again: bucketed and
    sorted by it, so a later join moves only its other side.  The buckets are
    known through the session's catalog under the name ``table`` (Spark's
    in-memory catalog will do, no metastore is needed; another session sees
    the files in ``path`` without the buckets)."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    # dealt by the bucket's own hash first, so that a bucket is one file
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are taken while it is written: ask the
    observation for them after the write.  It stands directly under the write,
    whose tasks count once each however often they are tried."""
    seen = Observation(f"counts-{uuid.uuid4().hex[:12]}")
    return df.observe(seen, *[agg.alias(name) for name, agg in metrics.items()]), seen


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def with_row_numbers(df: DataFrame, order: str, name: str = "index") -> DataFrame:
    """``df`` in order of ``order`` with row numbers from 0: dealt by ranges
    and sorted inside of them, written, and numbered from the ranges' row
    counts (one number for each partition reaches the driver), so no task
    holds more than its range.  ``order`` must be unique for a definite
    result."""
    spot = "_spot"
    dealt = stage(df.repartitionByRange(order).sortWithinPartitions(order)
                  .withColumn(spot, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(spot), 33)
    sizes = sorted((r["part"], r["rows"]) for r in
                   dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect())
    first = dict(zip((p for p, _ in sizes), itertools.accumulate((n for _, n in sizes), initial=0)))
    offsets = df.sparkSession.createDataFrame([*first.items()], "part long, first long")
    within = F.col(spot).bitwiseAND(F.lit((1 << 33) - 1))
    return (dealt.join(offsets, part == offsets["part"]).withColumn(name, (F.col("first") + within).cast("long"))
            .select(name, *[F.col(f"`{c}`") for c in df.columns]))


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", index: str | None = None) -> None:
    """CSV with a header, minimal quoting, embedded quotes doubled,
    nulls as empty fields.  Lists and structs are written as JSON text (CSV
    has no nested types).  ``index`` names a column: the rows are numbered from
    0 in its order, in a first column ``index`` (the reference's default)."""
    if index:
        df = with_row_numbers(df, index)
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("array", "struct", "map"):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    (df.select(*cols).write.mode(mode)
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").csv(path))


def write_report(tables: dict[str, DataFrame], base: str, fmt: str = "json") -> None:
    """Each audit table written as its own JSON (or Parquet) table, with
    the partitioning it has (no funnel through one task)."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{base.rstrip('/')}/{name}")


def tidy_report(tables: Mapping[str, DataFrame], layout: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Reports as one table (report, item, figure, value): ``layout`` names
    each report's key columns, joined by "/" into ``item`` (a null key reads
    "null"), and its numeric columns, one row each."""
    parts = []
    for name, (keys, figures) in layout.items():
        item = F.concat_ws("/", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys])
        entries = [F.struct(F.lit(f).alias("figure"), F.col(f"`{f}`").cast("double").alias("value")) for f in figures]
        parts.append(tables[name].select(F.lit(name).alias("report"), item.alias("item"), F.inline(F.array(*entries))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stage(df: DataFrame, name: str, base: str | None = None, count: bool = False) -> DataFrame:
    """Persist a stage as Parquet and continue from the written copy.
    ``count`` also counts its rows while they are written (:func:`rows_of`).

    ``base`` defaults to the session's checkpoint folder (shared storage on a
    cluster), so downstream stages read files instead of recomputing the
    lineage, and survive executor loss."""
    spark = df.sparkSession
    root = base or ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"
    schema, seen = df.schema, None
    if count:
        df, seen = observed(df, {"rows": F.count(F.lit(1))})
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading it back needs no footer-scanning job
    out = spark.read.schema(schema).parquet(path)
    out.__dict__["_larder_staged"] = True
    out.__dict__["_larder_rows"] = seen.get["rows"] if seen else None
    return out


def rows_of(df: DataFrame) -> int | None:
    """The rows of a table that :func:`stage` counted (None of any other)."""
    return df.__dict__.get("_larder_rows")


def is_staged(df: DataFrame) -> bool:
    """True for the DataFrame returned by :func:`stage` itself (not for
    frames derived from it)."""
    return bool(df.__dict__.get("_larder_staged", False))
