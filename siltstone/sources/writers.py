"""File and table writers.

A table is a catalog table over Parquet. A job never overwrites files it is still reading: a whole-table
rewrite goes to a new version folder and the table is then pointed at it; a partition rewrite is staged by
Spark's dynamic partition overwrite. A lost executor only repeats tasks, and a failed job leaves the old
version in place: a new definition is complete before it takes the table's name.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import with_md5_key
from ..operators.merge import assert_unique, delete_where, merge_upsert
from ..operators.quality import Failing, observed, observed_report

FORMATS = ("parquet", "csv")


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    key_columns: Sequence[str] = (),
    key_name: str = "md5_key",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write Parquet or CSV, optionally with an md5 key column, partitioned into directories."""
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}")
    rows = with_md5_key(df, key_columns, key_name) if key_columns else df
    writer = rows.write.mode(mode).partitionBy(*partition_by) if partition_by else rows.write.mode(mode)
    writer.parquet(path) if file_format == "parquet" else writer.option("header", True).csv(path)


def stamped(df: DataFrame, run_date: dt.date, name: str = "run_date_bq") -> DataFrame:
    return df.withColumn(name, F.lit(run_date))


_RANK_BITS = 6


def _ordinal(df: DataFrame, column: str, skip: int = 0) -> Column:
    """A number in the order of the column's values; of texts, of the six bytes after the first `skip` ones."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        digits = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), skip + 1, 6)), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _common_prefixes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Bytes with which all values of each text column begin: those that the least and the greatest share."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType | T.BinaryType)]
    if not texts:
        return {}
    ends = df.agg(*(f(F.col(c).cast("binary")).alias(f"{f.__name__}_{c}") for c in texts for f in (F.min, F.max))).first()
    return {c: len(os.path.commonprefix([bytes(ends[f"min_{c}"] or b""), bytes(ends[f"max_{c}"] or b"")])) for c in texts}


def _cuts_below(cuts: Sequence[float], value: Column) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = _RANK_BITS) -> Column:
    """A number in which rows near in all columns are near: the bits of each value's rank among 2**bits quantiles, by turns.

    The quantiles are those of all rows, from one aggregate; its result is of fixed size. NULL ranks lowest.
    """
    prefixes = _common_prefixes(df, columns)
    values = {c: _ordinal(df, c, prefixes.get(c, 0)) for c in columns}
    shares = F.array(*(F.lit(k / 2**bits) for k in range(1, 2**bits)))
    cuts = df.agg(*(F.percentile_approx(v, shares, F.lit(100 * 2**bits)).alias(c) for c, v in values.items())).first()
    key = F.lit(0).cast("bigint")
    for place, (c, value) in enumerate(values.items()):
        known = sorted(set(cuts[c] or ()))
        if not known:
            continue
        rank = F.when(F.col(c).isNull(), 0).otherwise(_cuts_below(known, value)).cast("bigint")
        for bit in range(bits):
            key = key + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(values) + place)
    return key


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows laid out for writing: by partition, and within one by ranges of the clustering columns.

    Without clustering columns the rebalance hint lets AQE split a partition value that holds much of the data (a hot month)
    over several tasks and merge the small ones. With them, rows are range partitioned by the partition columns and the interleaved
    clustering columns, from sampled bounds: a hot partition becomes several files, each with a small part of every
    column's range, and a filter on any of the columns skips the others by their statistics. This reads `df` up to four
    times (ends of texts, quantiles, sample, rows).
    """
    if not cluster_by:
        grouped = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
        return grouped.sortWithinPartitions(*partition_by) if partition_by else grouped
    keyed = df.withColumn("_layout", interleaved(df, cluster_by))
    ordered = keyed.repartitionByRange(*partition_by, "_layout").sortWithinPartitions(*partition_by, "_layout", *cluster_by)
    return ordered.drop("_layout")


@contextmanager
def laid_out(df: DataFrame, root: str, partition_by: Sequence[str], cluster_by: Sequence[str]) -> Iterator[DataFrame]:
    """The rows as `clustered`, from a staging folder where they are read several times."""
    if not cluster_by:
        yield clustered(df, partition_by, cluster_by)
        return
    with staged(df, root) as rows:
        yield clustered(rows, partition_by, cluster_by)


def _remove(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged(df: DataFrame, root: str) -> Iterator[DataFrame]:
    """The rows, written once to a staging folder under the table's root and read back; the folder goes at the end.

    A merge uses its source several times (uniqueness, matching, union); this computes it once and cuts
    its lineage with files that outlive any executor, in the store that holds the table.
    """
    spark = df.sparkSession
    location = f"{root}/staging_{uuid.uuid4().hex}"
    try:
        df.write.parquet(location)
        yield spark.read.schema(df.schema).parquet(location)
    finally:
        _remove(spark, location)


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _quoted(schema: T.StructType) -> str:
    parts = []
    for f in schema:
        comment = f.metadata.get("comment", "").replace("'", "\\'")
        required = "" if f.nullable else " NOT NULL"
        parts.append(f"`{f.name}` {f.dataType.simpleString()}{required}" + (f" COMMENT '{comment}'" if comment else ""))
    return ", ".join(parts)


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _define(
    spark: SparkSession, table: str, schema: T.StructType, location: str | None, partition_by: Sequence[str],
    absent: bool = False, bucket_by: Sequence[str] = (), buckets: int = 0,
) -> None:
    layout = f" PARTITIONED BY ({_names(partition_by)})" if partition_by else ""
    if buckets:
        layout += f" CLUSTERED BY ({_names(bucket_by)}) SORTED BY ({_names(bucket_by)}) INTO {buckets} BUCKETS"
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if absent else ''}{table} ({_quoted(schema)}) USING parquet{layout}{place}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    root: str | None = None,
    partition_by: Sequence[str] = (),
    run_date_column: str | None = "run_date_bq",
) -> None:
    """Create the table if absent, adding the run date column. With `root`, its files live there."""
    if run_date_column and run_date_column not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(run_date_column, T.DateType(), False)])
    _define(spark, table, schema, f"{root}/{_version()}" if root else None, partition_by, absent=True)


def _version() -> str:
    return f"v_{uuid.uuid4().hex}"


def append_rows(df: DataFrame, table: str, run_date: dt.date | None = None, run_date_column: str = "run_date_bq") -> None:
    """Append to an existing table, columns matched by name."""
    rows = stamped(df, run_date, run_date_column) if run_date else df
    columns = df.sparkSession.table(table).columns
    rows.select(*columns).write.mode("append").insertInto(table)


def _kept_definition(spark: SparkSession, table: str, schema: T.StructType) -> T.StructType:
    """The frame's fields, with nullability and comments of equally named and typed fields of the table."""
    if not exists(spark, table):
        return schema
    declared = {f.name: f for f in spark.table(table).schema}
    return T.StructType([declared[f.name] if f.name in declared and declared[f.name].dataType == f.dataType else f for f in schema])


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; 0 and none without."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = told.get("Bucket Columns", "").strip("[]").replace("`", "")
    return int(told.get("Num Buckets", 0)), [c.strip() for c in columns.split(",") if c.strip()]


def _same_definition(spark: SparkSession, table: str, schema: T.StructType, bucket_by: Sequence[str], buckets: int) -> bool:
    if any(c.isPartition for c in spark.catalog.listColumns(table)) or bucketing(spark, table) != (buckets, list(bucket_by)):
        return False
    return [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]


def _remove_versions(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Delete all but the current version and the `keep` newest before it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(f.getModificationTime(), f.getPath()) for f in system.listStatus(path) if f.isDirectory() and f.getPath().getName().startswith("v_")]
    older = sorted((x for x in found if x[1].getName() != current), key=lambda x: (x[0], x[1].getName()), reverse=True)
    for _, folder in older[keep:]:
        system.delete(folder, True)


def replace_table(
    df: DataFrame, table: str, root: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (), buckets: int = 0, keep_versions: int = 1,
) -> None:
    """Write a new version of the table and point the catalog at it.

    The new version is defined with the frame's own types under a name of its own. Where the table has that definition
    already and no partitions, it is pointed at the new files in one step; a table with another definition, or
    with partitions, whose places the catalog holds one by one, gives its name to the new one by two renames, between which
    the name is missing. `keep_versions` earlier versions stay, so running readers are not cut off; older ones are removed.
    With `buckets`, rows are dealt by a hash of `bucket_by` and sorted by it within files, so that joins and merges on
    these columns read the table without moving it.
    """
    spark = df.sparkSession
    version = _version()
    location = f"{root}/{version}"
    new, old = (f"{table}_{kind}_{uuid.uuid4().hex[:8]}" for kind in ("new", "old"))
    fields = [f for f in _kept_definition(spark, table, df.schema) if f.name not in partition_by]
    fields += [df.schema[c] for c in partition_by]
    schema = T.StructType(fields)
    if buckets:
        _define(spark, new, schema, location, partition_by, bucket_by=bucket_by, buckets=buckets)
        df.select(*schema.names).write.insertInto(new)
    else:
        with laid_out(df, root, partition_by, cluster_by) as rows:
            (rows.write.partitionBy(*partition_by) if partition_by else rows.write).parquet(location)
        _define(spark, new, schema, location, partition_by)
    if partition_by:
        spark.catalog.recoverPartitions(new)
    if not exists(spark, table):
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    elif not partition_by and _same_definition(spark, table, schema, bucket_by, buckets):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.sql(f"DROP TABLE {new}")
    else:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)
    _remove_versions(spark, root, version, keep_versions)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in `df`; needs dynamic partition overwrite."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def replace_day(df: DataFrame, table: str, run_date: dt.date, run_date_column: str = "run_date_bq") -> None:
    """Idempotent daily load: the day's rows are replaced, all other days stay."""
    overwrite_partitions(stamped(df, run_date, run_date_column), table)


def delete_rows(spark: SparkSession, table: str, root: str, condition: str, partition_by: Sequence[str] = ()) -> None:
    """DELETE FROM table WHERE condition, as a new version without those rows."""
    replace_table(delete_where(spark.table(table), condition), table, root, partition_by)


def _touched_partitions(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows of the partitions that occur in the source.

    The span of each partition column goes into the plan as literals, which prune partitions before the
    scan; the semi join then leaves out untouched partitions inside the span.
    """
    spans = source.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in partition_by for f in (F.min, F.max)]).first()
    within = target
    for c in partition_by:
        span = F.col(c).between(F.lit(spans[f"{c}_min"]), F.lit(spans[f"{c}_max"]))
        within = within.where(span | F.col(c).isNull())
    touched = source.select(*[F.col(c).alias(f"_{c}") for c in partition_by]).distinct()
    # Null-safe: rows without a partition value share a partition that is rewritten like any other.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by]
    return within.join(touched, reduce(lambda a, b: a & b, same), "left_semi")


def merged_into_buckets(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int, newer_by: str | None = None) -> DataFrame:
    """The merge of a source into a target that is bucketed by the keys.

    Only the source is shuffled, by the same hash into as many partitions: the join reads the target bucket by bucket, and
    every task of the result holds rows of one bucket, so writing it back moves nothing either.
    """
    return merge_upsert(target, source.repartition(buckets, *keys), keys, newer_by=newer_by, check_unique=False)


def materialize(
    df: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    full_refresh: bool = False,
    key_fixes_partition: bool = False,
    null_safe: bool = False,
    newer_by: str | None = None,
    buckets: int = 0,
    checks: Failing | None = None,
) -> DataFrame | None:
    """Persist a model.

    Without `keys`, on the first run, or with `full_refresh`, the table is replaced. Otherwise `df` is
    merged on `keys`; see `merge_upsert` for `null_safe` and `newer_by`. `key_fixes_partition` promises that a key never moves to
    another partition (a key that contains the event time); then only partitions present in `df` are read and rewritten. With
    `buckets`, the table is bucketed by its keys and a merge moves the source only; a table that is not bucketed so yet is laid out
    anew by its next merge. Rows without a complete key are in no bucket of their own, so `null_safe` excludes `buckets`.

    With `checks` (see `quality.failing`), the rows of `df` are checked while they are staged, and the report is returned.
    """
    spark = df.sparkSession
    if checks:
        rows, seen = observed(df, checks)
        with staged(rows, root) as source:
            materialize(source, table, root, keys, partition_by, cluster_by, full_refresh, key_fixes_partition, null_safe, newer_by, buckets)
        return observed_report(spark, table, checks, seen)
    if buckets and (null_safe or partition_by):
        raise ValueError("buckets need complete keys and a table without partitions")
    bucket_by = list(keys) if buckets else []
    if full_refresh or not keys or not exists(spark, table):
        rows = df.repartition(buckets, *keys) if buckets and keys else df
        replace_table(rows, table, root, partition_by, cluster_by, bucket_by, buckets if keys else 0)
        return None
    with staged(df, root) as source:
        target = spark.table(table)
        options = {"null_safe": null_safe, "newer_by": newer_by}
        if buckets:
            assert_unique(source, keys)
            if bucketing(spark, table) == (buckets, bucket_by):
                merged = merged_into_buckets(target, source, keys, buckets, newer_by)
            else:
                merged = merge_upsert(target, source, keys, newer_by=newer_by, check_unique=False).repartition(buckets, *keys)
            replace_table(merged, table, root, partition_by, cluster_by, bucket_by, buckets)
        elif key_fixes_partition and partition_by:
            merged = merge_upsert(_touched_partitions(target, source, partition_by), source, keys, **options)
            with laid_out(merged, root, partition_by, cluster_by) as rows:
                overwrite_partitions(rows, table)
            spark.catalog.refreshTable(table)
        else:
            replace_table(merge_upsert(target, source, keys, **options), table, root, partition_by, cluster_by)
    return None


def write_relational(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Append over JDBC in batches; resolve key conflicts beforehand with `operators.merge`."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)
