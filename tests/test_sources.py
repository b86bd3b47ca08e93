from __future__ import annotations

import datetime as dt
import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from support import values
from pyspark.sql import types as T

from siltstone.operators import merge
from siltstone.sources import readers, schemas, writers


# ---- schemas ---------------------------------------------------------------------------------------


def test_declared_schemas():
    assert schemas.YELLOW_TRIPS["airport_fee"].dataType == T.DoubleType()
    assert "airport_fee" not in schemas.GREEN_TRIPS.names
    assert len(schemas.LOAN_STATISTICS) == 10
    assert schemas.required_columns(schemas.DECISION_LINKS) == ["no_putusan", "tgl_putusan", "link_page_putusan"]


def test_schema_from_json(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(
        json.dumps([{"name": "a", "type": "integer", "mode": "REQUIRED"}, {"name": "b", "type": "STRING", "description": "text"}])
    )
    schema = schemas.schema_from_json(path)
    assert schema["a"] == T.StructField("a", T.LongType(), False)
    assert schema["b"].metadata == {"comment": "text"}
    assert schemas.type_names_from_json(path) == {"a": "INTEGER", "b": "STRING"}


def test_relational_types(spark):
    columns = spark.createDataFrame(
        [
            ("t", "id", "integer", 1),
            ("t", "name", "character varying(100)", 2),
            ("t", "price", "numeric(10,2)", 3),
            ("t", "gap", "interval", 4),
            ("t", "spot", "point", 5),
            ("t", "at", "timestamp without time zone", 6),
            ("t", "ok", "BOOLEAN", 7),
        ],
        "table_name string, column_name string, data_type string, ordinal_position int",
    )
    keys = spark.createDataFrame([("t", "id")], "table_name string, column_name string")
    mapped = schemas.map_catalog_types(columns, keys)
    got = {r["column_name"]: (r["type"], r["mode"]) for r in mapped.collect()}
    assert got == {
        "id": ("INTEGER", "REQUIRED"),
        "name": ("STRING", "NULLABLE"),
        "price": ("NUMERIC", "NULLABLE"),
        "gap": ("STRING", "NULLABLE"),
        "spot": ("STRING", "NULLABLE"),
        "at": ("TIMESTAMP", "NULLABLE"),
        "ok": ("BOOL", "NULLABLE"),
    }
    assert schemas.struct_of(mapped.collect()).names == ["id", "name", "price", "gap", "spot", "at", "ok"]


# ---- readers ---------------------------------------------------------------------------------------


def test_trip_files(spark, tmp_path):
    path = tmp_path / "yellow_tripdata_2024-03.parquet"
    spark.createDataFrame([(1,)], ["VendorID"]).write.parquet(str(path))
    assert readers.read_trips(spark, str(tmp_path), "yellow", 2024, 3).columns == ["vendorid"]
    with pytest.raises(ValueError):
        readers.read_trips(spark, str(tmp_path), "blue", 2024, 3)


def test_csv(spark, tmp_path):
    zones = tmp_path / "zones.csv"
    zones.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n')
    got = readers.read_zones(spark, str(zones))
    assert got.columns == ["locationid", "borough", "zone", "service_zone"]
    assert tuple(got.first()) == (1, "EWR", "Newark Airport", "EWR")
    months = tmp_path / "m.csv"
    months.write_text("y,m,v\n2024,1,a\n2024,2,b\n2023,1,c\n")
    assert values(readers.read_csv_month(spark, str(months), "y", "m", 2024, 1), "v") == [("a",)]
    assert readers.read_csv_month(spark, str(months), "y", "m", 2020, 1).count() == 0


def test_read_with_schema_ignores_unknown_columns(spark, tmp_path):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType()), T.StructField("x", T.DateType())])
    rows = spark.createDataFrame([(1, "s", 2.0)], "a long, b string, extra double")
    rows.write.parquet(str(tmp_path / "p"))
    rows.write.option("header", True).csv(str(tmp_path / "c"))
    for path, file_format in (("p", "parquet"), ("c", "csv")):
        got = readers.read_with_schema(spark, str(tmp_path / path), schema, file_format)
        assert got.columns == ["b", "a", "x"]
        assert tuple(got.first()) == ("s", 1, None)
    with pytest.raises(ValueError):
        readers.read_with_schema(spark, str(tmp_path / "p"), schema, "orc")


def test_day_slices():
    assert readers.day_slices("created_at", dt.date(2024, 2, 28), dt.date(2024, 2, 29)) == [
        "created_at >= '2024-02-28' AND created_at < '2024-02-29'",
        "created_at >= '2024-02-29' AND created_at < '2024-03-01'",
    ]


# ---- writers ---------------------------------------------------------------------------------------


def test_write_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "yellow"), (2, "b", "green")], "a long, b string, taxi_type string")
    path = str(tmp_path / "out")
    writers.write_files(rows, path, key_columns=["a", "b"], partition_by=["taxi_type"])
    back = spark.read.parquet(path)
    assert dict(values(back, "a", "md5_key"))[1] == hashlib.md5(b"1|").hexdigest()
    assert spark.read.parquet(f"{path}/taxi_type=green").count() == 1
    writers.write_files(rows, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    with pytest.raises(ValueError):
        writers.write_files(rows, path, "orc")


@pytest.fixture
def name(request):
    return f"t_{request.node.name.replace('[', '_').replace(']', '')}"


def test_create_append_and_replace_day(spark, tmp_path, name):
    schema = T.StructType([schemas.field("id", "INTEGER", True, "the id"), schemas.field("v", "STRING")])
    root = str(tmp_path / name)
    writers.create_table(spark, name, schema, root, ["run_date_bq"])
    writers.create_table(spark, name, schema, root, ["run_date_bq"])
    assert spark.table(name).columns == ["id", "v", "run_date_bq"]
    rows = spark.createDataFrame([(1, "a")], "id long, v string")
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    writers.append_rows(rows, name, first)
    writers.replace_day(rows, name, second)
    writers.replace_day(rows.withColumn("v", F.lit("b")), name, second)
    assert values(spark.table(name)) == [(1, "a", first), (1, "b", second)]


def test_replace_and_delete(spark, tmp_path, name):
    root = str(tmp_path / name)
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    writers.replace_table(rows, name, root)
    # The new content is computed from the old: the files being read are not the ones written.
    writers.replace_table(spark.table(name).withColumn("id", F.col("id") + 10), name, root)
    assert values(spark.table(name)) == [(11, "a"), (12, None)]
    writers.delete_rows(spark, name, root, "v = 'a'")
    assert values(spark.table(name)) == [(12, None)]


def test_materialize_merges_and_refreshes(spark, tmp_path, name):
    root = str(tmp_path / name)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    writers.materialize(rows, name, root, ["id"])
    changed = spark.createDataFrame([(2, "B"), (3, "C")], "id long, v string")
    for _ in range(2):
        writers.materialize(changed, name, root, ["id"])
        assert values(spark.table(name)) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(merge.DuplicateKeyError):
        writers.materialize(changed.union(changed), name, root, ["id"])
    writers.materialize(changed, name, root, ["id"], full_refresh=True)
    assert values(spark.table(name)) == [(2, "B"), (3, "C")]


def test_materialize_rewrites_only_touched_partitions(spark, tmp_path, name):
    root = str(tmp_path / name)
    d = dt.date
    rows = spark.createDataFrame([("x", 1, d(2024, 1, 1)), ("y", 2, d(2024, 2, 1)), ("z", 3, d(2024, 2, 1))], "k string, v long, m date")
    options = {"partition_by": ["m"], "cluster_by": ["k"], "key_fixes_partition": True}
    writers.materialize(rows, name, root, ["k"], **options)
    before = {r[0] for r in spark.table(name).where("m = '2024-01-01'").select(F.input_file_name()).collect()}
    changed = spark.createDataFrame([("y", 20, d(2024, 2, 1)), ("w", 4, d(2024, 3, 1))], "k string, v long, m date")
    writers.materialize(changed, name, root, ["k"], **options)
    assert values(spark.table(name).select("k", "v")) == [("w", 4), ("x", 1), ("y", 20), ("z", 3)]
    after = {r[0] for r in spark.table(name).where("m = '2024-01-01'").select(F.input_file_name()).collect()}
    assert before == after
    # Without the promise the whole table is rewritten, to the same content.
    writers.materialize(changed, name, root, ["k"], partition_by=["m"])
    assert values(spark.table(name).select("k", "v")) == [("w", 4), ("x", 1), ("y", 20), ("z", 3)]


def test_materialize_keeps_rows_without_partition_value(spark, tmp_path, name):
    root = str(tmp_path / name)
    schema = "k string, v long, m date"
    options = {"partition_by": ["m"], "key_fixes_partition": True}
    writers.materialize(spark.createDataFrame([("x", 1, None), ("y", 2, dt.date(2024, 1, 1))], schema), name, root, ["k"], **options)
    writers.materialize(spark.createDataFrame([("z", 3, None)], schema), name, root, ["k"], **options)
    assert values(spark.table(name).select("k", "v")) == [("x", 1), ("y", 2), ("z", 3)]


def test_staging_folder_goes_after_the_merge(spark, tmp_path, name):
    root = tmp_path / name
    rows = spark.createDataFrame([(1, "a")], "id long, v string")
    for _ in range(3):
        writers.materialize(rows, name, str(root), ["id"])
    assert not list(root.glob("staging_*"))
    with pytest.raises(merge.DuplicateKeyError):
        writers.materialize(rows.union(rows), name, str(root), ["id"])
    assert not list(root.glob("staging_*"))
    assert values(spark.table(name)) == [(1, "a")]


def test_partition_values_keep_their_type(spark, tmp_path, name):
    root = str(tmp_path / name)
    rows = spark.createDataFrame([("007", 1), ("012", 2), (None, 3)], "code string, v long")
    for _ in range(2):
        writers.replace_table(rows, name, root, ["code"])
        assert values(spark.table(name).select("code", "v")) == [("007", 1), ("012", 2), (None, 3)]
    writers.materialize(spark.createDataFrame([("007", 1, "x")], "code string, v long, w string"), name, root, ["v"], ["code"], full_refresh=True)
    assert spark.table(name).schema["code"].dataType == T.StringType()


def test_replacement_keeps_declared_comments(spark, tmp_path, name):
    root = str(tmp_path / name)
    writers.create_table(spark, name, T.StructType([schemas.field("id", "INTEGER", True, "the id"), schemas.field("v", "STRING")]), root, run_date_column=None)
    writers.replace_table(spark.createDataFrame([(1, "a")], "id long, v string"), name, root)
    assert spark.table(name).schema["id"].metadata["comment"] == "the id"
    assert values(spark.table(name)) == [(1, "a")]


def test_crash_before_the_swap_leaves_the_old_version(spark, tmp_path, name, monkeypatch):
    root = str(tmp_path / name)
    writers.replace_table(spark.createDataFrame([(1, "a")], "id long, m string"), name, root, ["m"])
    changed = spark.createDataFrame([(2, "b")], "id long, m string")

    def broken(*_args, **_kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(writers, "_define", broken)
        with pytest.raises(OSError):
            writers.replace_table(changed, name, root, ["m"])
    assert values(spark.table(name)) == [(1, "a")]
    writers.replace_table(changed, name, root, ["m"])
    assert values(spark.table(name)) == [(2, "b")]


def test_null_safe_and_newer_rows_through_materialize(spark, tmp_path, name):
    root = str(tmp_path / name)
    rows = spark.createDataFrame([("a", None, 5), (None, None, 5), ("b", "c", 5)], "k string, j string, v long")
    for _ in range(3):
        writers.materialize(rows, name, root, ["k", "j"], null_safe=True)
    assert values(spark.table(name)) == values(rows)
    mixed = spark.createDataFrame([("a", None, 4), ("b", "c", 6)], "k string, j string, v long")
    writers.materialize(mixed, name, root, ["k", "j"], null_safe=True, newer_by="v")
    assert values(spark.table(name)) == sorted([("a", None, 5), (None, None, 5), ("b", "c", 6)], key=repr)
    # The default matches no NULL: such rows are inserted again.
    writers.materialize(rows, name, root, ["k", "j"])
    assert spark.table(name).count() == 5


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_into_buckets_moves_the_source_only(spark, tmp_path, name):
    root = str(tmp_path / name)
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    writers.materialize(rows, name, root, ["k"], buckets=8)
    assert writers.bucketing(spark, name) == (8, ["k"])
    changed = spark.range(4990, 5020).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = writers.merged_into_buckets(spark.table(name), changed, ["k"], 8)
        # The one kind of exchange is the stated one of the source; the join asks for none.
        assert "Bucketed: true" in plan_of(merged) and "REPARTITION_BY_NUM" in plan_of(merged)
        assert "ENSURE_REQUIREMENTS" not in plan_of(merged)
        other = writers.merge_upsert(spark.table(name), changed.withColumn("v", F.col("k") % 7), ["v"], check_unique=False)
        assert "ENSURE_REQUIREMENTS" in plan_of(other)  # another key has to move the table
        for _ in range(2):
            writers.materialize(changed, name, root, ["k"], buckets=8)
            assert writers.bucketing(spark, name) == (8, ["k"])
            assert spark.table(name).count() == 5020
            assert spark.table(name).where("v = -1").count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Every file holds one bucket: the merge wrote its rows where they were.
    folder = max((tmp_path / name).glob("v_*"), key=lambda p: p.stat().st_mtime_ns)
    assert len(list(folder.glob("part-*.parquet"))) <= 2 * 8


def test_bucketed_merge_keeps_newer_rows_and_incomplete_keys(spark, tmp_path, name):
    root = str(tmp_path / name)
    schema = "k long, at long, v string"
    writers.materialize(spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (None, 1, "n")], schema), name, root, ["k"], buckets=4)
    writers.materialize(spark.createDataFrame([(1, 4, "old"), (2, 6, "new"), (3, 1, "c"), (None, 2, "m")], schema), name, root, ["k"], buckets=4, newer_by="at")
    assert values(spark.table(name)) == sorted([(1, 5, "a"), (2, 6, "new"), (3, 1, "c"), (None, 1, "n"), (None, 2, "m")], key=repr)
    with pytest.raises(merge.DuplicateKeyError):
        writers.materialize(spark.createDataFrame([(7, 1, "x"), (7, 2, "y")], schema), name, root, ["k"], buckets=4)
    with pytest.raises(ValueError, match="buckets"):
        writers.materialize(spark.createDataFrame([(7, 1, "x")], schema), name, root, ["k"], buckets=4, null_safe=True)


def test_plain_table_is_bucketed_by_its_next_merge(spark, tmp_path, name):
    root = str(tmp_path / name)
    writers.materialize(spark.range(10).withColumn("v", F.lit("a")), name, root, ["id"])
    writers.materialize(spark.range(5, 15).withColumn("v", F.lit("b")), name, root, ["id"], buckets=4)
    assert writers.bucketing(spark, name) == (4, ["id"])
    assert values(spark.table(name).groupBy("v").count()) == [("a", 5), ("b", 10)]


def test_same_definition_is_swapped_in_one_step(spark, tmp_path, name, monkeypatch):
    """No rename, so the name is never missing; old versions go, but the one before stays for running readers."""
    root = str(tmp_path / name)
    spark.createDataFrame([(0, "x")], "id long, v string").createOrReplaceTempView("unused")
    writers.replace_table(spark.createDataFrame([(0, "x")], "id long, v string"), name, root)
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (said.append(text), sql(self, text, *a, **b))[1])
    for k in range(1, 4):
        reader = spark.table(name)
        writers.replace_table(spark.createDataFrame([(k, "y")], "id long, v string"), name, root)
        assert reader.collect()[0][0] == k - 1  # planned before the swap
        assert values(spark.table(name)) == [(k, "y")]
    assert not any("RENAME" in text for text in said)
    assert len(list((tmp_path / name).glob("v_*"))) == 2


def groups_read(folder, **wanted):
    """(row groups whose statistics allow the values, all row groups) of the Parquet files under a folder."""
    hit = total = 0
    for path in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            total += 1
            stats = {c: meta.row_group(g).column(at[c]).statistics for c in wanted}
            hit += all(stats[c].min <= v <= stats[c].max for c, v in wanted.items())
    return hit, total


def test_clustered_files_have_narrow_ranges(spark, tmp_path, name):
    """A filter on either clustering column skips most files of a month; a hot month is several files."""
    rows = spark.range(60_000).select(
        F.col("id"), (F.xxhash64("id") % 260).alias("pulocationid"), F.concat(F.lit("zone"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90)).cast("string"), 3, "0")).alias("zone"),
        F.when(F.col("id") % 10 < 8, F.lit(dt.date(2024, 1, 1))).otherwise(F.lit(dt.date(2024, 2, 1))).alias("month"),
    )
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        root = tmp_path / name
        writers.materialize(rows, name, str(root), ["id"], ["month"], ["pulocationid", "zone"], key_fixes_partition=True)
        (version,) = root.glob("v_*")
        assert not list(root.glob("staging_*"))
        january = version / "month=2024-01-01"
        assert len(list(january.glob("*.parquet"))) > 20
        for wanted in ({"pulocationid": 7}, {"zone": "zone041"}):
            hit, total = groups_read(january, **wanted)
            assert 0 < hit <= total / 2
        hit, total = groups_read(january, pulocationid=7, zone="zone041")
        assert 0 < hit <= total / 8
        # Unclustered, every file has every value.
        writers.replace_table(rows.repartition(20), f"{name}_flat", str(tmp_path / "flat"), ["month"])
        hit, total = groups_read(tmp_path / "flat", pulocationid=7)
        assert hit == total
        # A merge keeps the layout of the month it touches.
        writers.materialize(rows.where("id % 10 < 8 and id < 500").withColumn("zone", F.lit("zone000")), name, str(root), ["id"], ["month"], ["pulocationid", "zone"], key_fixes_partition=True)
        hit, total = groups_read(january, pulocationid=7, zone="zone041")
        assert 0 < hit <= total / 8
        assert spark.table(name).count() == 60_000 and spark.table(name).where("zone = 'zone000'").count() > 390
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_interleaving_orders_and_takes_nulls(spark):
    df = spark.createDataFrame([(k, None if k % 9 == 0 else f"t{k % 7}", dt.date(2024, 1, 1 + k % 28), float(k % 5)) for k in range(200)], "a long, b string, c date, d double")
    keyed = df.withColumn("z", writers.interleaved(df, ["a"]))
    assert [r["a"] for r in keyed.orderBy("z", "a").collect()] == list(range(200))
    assert keyed.select("z").distinct().count() > 32
    four = df.withColumn("z", writers.interleaved(df, ["a", "b", "c", "d"]))
    assert four.where("z is null or z < 0").count() == 0
    empty = df.limit(0)
    assert empty.withColumn("z", writers.interleaved(empty, ["a", "b"])).count() == 0
