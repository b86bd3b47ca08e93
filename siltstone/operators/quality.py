"""Data-quality checks. Each returns rows (table, check, column, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityError(ValueError):
    """Checks that must hold reported violations."""


def _counted(df: DataFrame, table: str, check: str, failing: Mapping[str, Column]) -> DataFrame:
    """Count failing rows of many predicates in one pass over the table."""
    counts = df.agg(
        *[F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias(f"v{i}") for i, bad in enumerate(failing.values())]
    )
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"v{i}").alias("violations")) for i, name in enumerate(failing)])
    return counts.select(F.explode(rows).alias("r")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "r.column", "r.violations"
    )


def _one(df: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(check).alias("check"), F.lit(column).alias("column"), "violations")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL, for all columns in one pass."""
    return _counted(df, table, "not_null", {c: F.col(c).isNull() for c in columns})


def declared_not_null(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """`not_null` for the columns a schema declares as required."""
    return not_null(df, table, [f.name for f in schema if not f.nullable])


def unique(df: DataFrame, table: str, columns: str | Sequence[str]) -> DataFrame:
    """Number of non-NULL values that occur more than once, for all columns in one pass over the table.

    Values are counted per column and value; text is exact for comparing the values of one column.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    if len(names) == 1:
        values = df.select(F.lit(names[0]).alias("column"), F.col(names[0]).alias("value"))
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names])
        values = df.select(F.inline(pairs))
    counts = values.where(F.col("value").isNotNull()).groupBy("column", "value").count()
    repeated = counts.groupBy("column").agg(F.count(F.when(F.col("count") > 1, 1)).alias("violations"))
    # The declared columns are few: a map from the small result keeps those without any value.
    found = repeated.agg(F.map_from_entries(F.collect_list(F.struct("column", "violations"))).alias("found"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.try_element_at("found", F.lit(c)), F.lit(0)).cast("bigint").alias("violations")) for c in names])
    rows = found.select(F.inline(each))
    return rows.select(F.lit(table).alias("table"), F.lit("unique").alias("check"), "column", "violations")


def relationships(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent.

    References are counted per value first, so a value holding most of the rows crosses the join once
    per map task.
    """
    references = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).count()
    orphans = references.join(
        parent.select(F.col(parent_column).alias("_pk")), F.col("_ref") == F.col("_pk"), "left_anti"
    )
    total = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
    return _one(total, table, "relationships", column)


def references(child: DataFrame, table: str, parents: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(table, column, parent, value, rows): the non-NULL references of a child, all columns in one pass.

    `parents` gives by child column the parent's name, rows and key. The columns are of one type; references are counted per value.
    """
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(f"{p}.{k}").alias("parent"), F.col(c).alias("value")) for c, (p, _, k) in parents.items()])
    rows = child.select(F.inline(each)).where(F.col("value").isNotNull()).groupBy("column", "parent", "value").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(table).alias("table"), "column", "parent", "value", "rows")


def all_relationships(children: Mapping[str, DataFrame], parents: Mapping[str, Mapping[str, tuple[str, DataFrame, str]]]) -> DataFrame:
    """`relationships` of many children, each read once, and one join with the keys of all parents."""
    declared = [(table, column) for table, given in parents.items() for column in given]
    kinds = {children[t].schema[c].dataType for t, c in declared} | {p.schema[k].dataType for g in parents.values() for _, p, k in g.values()}
    if not all(isinstance(k, T.IntegralType) for k in kinds):
        return report(*[relationships(children[t], t, c, parents[t][c][1], parents[t][c][2]) for t, c in declared])
    found = report(*[references(children[t].select(*[F.col(c).cast("bigint").alias(c) for c in given]), t, given) for t, given in parents.items()])
    keyed = {f"{p}.{k}": rows.select(F.lit(f"{p}.{k}").alias("_parent"), F.col(k).cast("bigint").alias("_pk")) for g in parents.values() for p, rows, k in g.values()}
    keys = report(*keyed.values())
    orphans = found.join(keys, (F.col("parent") == F.col("_parent")) & (F.col("value") == F.col("_pk")), "left_anti")
    counts = orphans.groupBy("table", "column").agg(F.sum("rows").alias("violations"))
    # The declared references are few: a map from the small result keeps those without orphans.
    held = counts.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(".", "table", "column"), "violations"))).alias("held"))
    rows = F.array(*[
        F.struct(F.lit(t).alias("table"), F.lit("relationships").alias("check"), F.lit(c).alias("column"),
                 F.coalesce(F.try_element_at("held", F.lit(f"{t}.{c}")), F.lit(0)).cast("bigint").alias("violations"))
        for t, c in declared
    ])
    return held.select(F.inline(rows))


def accepted_values(df: DataFrame, table: str, allowed: Mapping[str, Sequence]) -> DataFrame:
    """Non-NULL values outside the allowed list."""
    return _counted(df, table, "accepted_values", {c: ~F.col(c).isin(list(values)) for c, values in allowed.items()})


def in_range(df: DataFrame, table: str, valid: Mapping[str, Column]) -> DataFrame:
    """Rows failing a CHECK predicate; as in SQL, a NULL result passes."""
    return _counted(df, table, "range", {c: ~predicate for c, predicate in valid.items()})


# ---- checks of rows while they are written ---------------------------------------------------------

Failing = dict[tuple[str, str], Column]

CHECK_ROWS = "table string, check string, column string, violations bigint, checked bigint"


def failing(not_null: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None, valid: Mapping[str, Column] | None = None) -> Failing:
    """Predicates of failing rows by (check, column), as the reports above count them."""
    out: Failing = {("not_null", c): F.col(c).isNull() for c in not_null}
    out |= {("accepted_values", c): ~F.col(c).isin(list(values)) for c, values in (accepted or {}).items()}
    return out | {("range", c): ~predicate for c, predicate in (valid or {}).items()}


def observed(df: DataFrame, checks: Failing) -> tuple[DataFrame, Observation]:
    """The same rows, counted on their way: the counts come with the job that writes them, without a second scan.

    The write has to follow directly (no exchange in between), so that the counting is part of the job's last stage, whose tasks
    count once however often executors are lost.
    """
    metrics = [F.count(F.lit(1)).alias("checked")]
    metrics += [F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias(f"v{k}") for k, bad in enumerate(checks.values())]
    seen = Observation()
    return df.observe(seen, *metrics), seen


def observed_report(spark: SparkSession, table: str, checks: Failing, seen: Observation) -> DataFrame:
    """(table, check, column, violations, checked) of an observed write; one row per declared check."""
    found = seen.get
    rows = [(table, check, column, int(found[f"v{k}"]), int(found["checked"])) for k, (check, column) in enumerate(checks)]
    return spark.createDataFrame(rows, CHECK_ROWS)


def merged_reports(reports: DataFrame) -> DataFrame:
    """Reports of several writes added up: those of appended parts give that of the whole."""
    return reports.groupBy("table", "check", "column").agg(F.sum("violations").alias("violations"), F.sum("checked").alias("checked"))


def reconcile_counts(
    collected: DataFrame, declared: DataFrame, keys: Sequence[str], declared_total: str = "declared_total"
) -> DataFrame:
    """Rows collected per key beside the number the source declares; a key missing on one side counts 0."""
    counts = collected.groupBy(*keys).agg(F.count(F.lit(1)).alias("collected_total"))
    joined = counts.join(declared.select(*keys, declared_total), list(keys), "full_outer").fillna(
        0, ["collected_total", declared_total]
    )
    return joined.withColumn("difference", F.col(declared_total) - F.col("collected_total"))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def raise_on_violations(checks: DataFrame) -> None:
    """Fail fast. The report has one row per declared check, so collecting it is bounded."""
    failed = [f"{r['table']}.{r['column']} {r['check']}: {r['violations']}" for r in checks.where("violations > 0").collect()]
    if failed:
        raise QualityError("; ".join(sorted(failed)))
