"""Declared schemas, and schemas derived from JSON files or a relational catalog."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamps are UTC wall-clock values.
_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 2),
    "DECIMAL": T.DecimalType(38, 2),
    "BIGNUMERIC": T.DecimalType(38, 2),
    "BIGDECIMAL": T.DecimalType(38, 2),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIME": T.StringType(),
}


def warehouse_type(name: str) -> T.DataType:
    """Spark type of a warehouse column type; unknown names are strings."""
    return _TYPES.get(name.upper(), T.StringType())


def field(name: str, type_name: str, required: bool = False, description: str | None = None) -> T.StructField:
    metadata = {"comment": description} if description else {}
    return T.StructField(name, warehouse_type(type_name), not required, metadata)


def required_columns(schema: T.StructType) -> list[str]:
    """Columns a not-null check has to cover: Spark does not enforce nullability on read."""
    return [f.name for f in schema if not f.nullable]


# The published tables' columns, in their order.

PLAYBACK_EVENTS = T.StructType(
    [
        field("event_id", "INTEGER"),
        field("session_id", "INTEGER", required=True),
        field("user_id", "INTEGER", required=True),
        field("movie_id", "INTEGER", required=True),
        field("event_type", "STRING", required=True, description="start, buffer, error, resume, stop"),
        field("event_timestamp", "TIMESTAMP", required=True),
        field("buffer_duration_ms", "INTEGER"),
        field("bitrate_kbps", "INTEGER"),
        field("city", "STRING"),
        field("isp", "STRING"),
        field("country", "STRING"),
        field("run_date", "DATE", description="Ingestion date (added by pipeline)"),
    ]
)

YELLOW_TRIPS = T.StructType(
    [
        field("taxi_type", "STRING", required=True),
        field("vendorid", "INTEGER", required=True),
        field("pickup_datetime", "TIMESTAMP", required=True),
        field("dropoff_datetime", "TIMESTAMP", required=True),
        field("trip_distance", "FLOAT", required=True),
        field("pulocationid", "INTEGER", required=True),
        field("dolocationid", "INTEGER", required=True),
        field("payment_type", "INTEGER"),
        field("total_amount", "FLOAT", required=True),
        field("passenger_count", "FLOAT"),
        field("ratecodeid", "FLOAT"),
        field("store_and_fwd_flag", "STRING"),
        field("fare_amount", "FLOAT"),
        field("extra", "FLOAT"),
        field("mta_tax", "FLOAT"),
        field("tip_amount", "FLOAT"),
        field("tolls_amount", "FLOAT"),
        field("improvement_surcharge", "FLOAT"),
        field("congestion_surcharge", "FLOAT"),
        field("airport_fee", "FLOAT"),
        field("cbd_congestion_fee", "FLOAT"),
        field("md5_key", "STRING"),
        field("run_date_bq", "DATE", required=True),
    ]
)

GREEN_TRIPS = T.StructType(
    [
        field("taxi_type", "STRING", required=True),
        field("vendorid", "INTEGER", required=True),
        field("pickup_datetime", "TIMESTAMP", required=True),
        field("dropoff_datetime", "TIMESTAMP", required=True),
        field("trip_distance", "FLOAT", required=True),
        field("pulocationid", "INTEGER", required=True),
        field("dolocationid", "INTEGER", required=True),
        field("payment_type", "INTEGER"),
        field("total_amount", "FLOAT", required=True),
        field("passenger_count", "FLOAT"),
        field("ratecodeid", "FLOAT"),
        field("store_and_fwd_flag", "STRING"),
        field("fare_amount", "FLOAT"),
        field("extra", "FLOAT"),
        field("mta_tax", "FLOAT"),
        field("tip_amount", "FLOAT"),
        field("tolls_amount", "FLOAT"),
        field("improvement_surcharge", "FLOAT"),
        field("congestion_surcharge", "FLOAT"),
        field("cbd_congestion_fee", "FLOAT"),
        field("md5_key", "STRING"),
        field("run_date_bq", "DATE", required=True),
    ]
)

TAXI_ZONES = T.StructType(
    [
        field("locationid", "INTEGER", required=True),
        field("borough", "STRING"),
        field("zone", "STRING"),
        field("service_zone", "STRING"),
        field("run_date_bq", "DATE", required=True),
    ]
)

DECISION_LINKS = T.StructType(
    [
        field("no_putusan", "STRING", required=True),
        field("tgl_putusan", "DATE", required=True),
        field("link_page_putusan", "STRING", required=True),
        field("run_date", "DATE"),
    ]
)

DECISION_DETAILS = T.StructType(
    [
        field("no_putusan", "STRING", required=True),
        field("tgl_putusan", "DATE", required=True),
        field("nama_terdakwa", "STRING"),
        field("link_page_putusan", "STRING", required=True),
        field("link_pdf_putusan", "STRING"),
        field("gcs_pdf_path", "STRING"),
        field("tingkat_proses", "STRING"),
        field("klasifikasi", "STRING"),
        field("kata_kunci", "STRING"),
        field("tahun", "INT64"),
        field("tgl_register", "DATE"),
        field("lembaga_pengadilan", "STRING"),
        field("hakim_ketua", "STRING"),
        field("hakim_anggota", "STRING"),
        field("panitera", "STRING"),
        field("amar", "STRING"),
        field("amar_lainnya", "STRING"),
        field("catatan_amar", "STRING"),
        field("tgl_musyawarah", "DATE"),
        field("tgl_dibacakan", "DATE"),
        field("run_date", "DATE"),
    ]
)

DECISION_EXTRACTS = T.StructType(
    [
        field("no_putusan", "STRING", required=True),
        field("tgl_putusan", "DATE", required=True),
        field("gcs_extract_pdf_path", "STRING"),
        field("summary_extractive_short", "STRING"),
        field("nama_terdakwa", "STRING"),
        field("tempat_lahir_terdakwa", "STRING"),
        field("tanggal_lahir_terdakwa", "DATE"),
        field("jenis_kelamin_terdakwa", "STRING"),
        field("kebangsaan_terdakwa", "STRING"),
        field("tempat_tinggal_terdakwa", "STRING"),
        field("agama_terdakwa", "STRING"),
        field("pekerjaan_terdakwa", "STRING"),
        field("barang_bukti", "STRING"),
        field("rujukan_hukum", "STRING"),
        field("amar_putusan", "STRING"),
        field("run_date", "DATE"),
    ]
)

LOAN_STATISTICS = T.StructType(
    [
        field("penerima_dana_total", "INTEGER", required=True),
        field("penerima_dana_tahun_berjalan", "INTEGER", required=True),
        field("penerima_dana_posisi_akhir", "INTEGER", required=True),
        field("pemberi_dana_total", "INTEGER", required=True),
        field("pemberi_dana_tahun_berjalan", "INTEGER", required=True),
        field("pemberi_dana_posisi_akhir", "INTEGER", required=True),
        field("dana_tersalurkan_total", "INTEGER", required=True),
        field("dana_tersalurkan_tahun_berjalan", "INTEGER", required=True),
        field("dana_tersalurkan_posisi_akhir", "INTEGER", required=True),
        field("run_date_bq", "DATE", required=True),
    ]
)


def schema_from_json(path: str | Path) -> T.StructType:
    """Schema file: a list of {name, type, mode?, description?}; mode REQUIRED means not nullable."""
    entries = json.loads(Path(path).read_text())
    return T.StructType(
        [field(e["name"], e["type"], e.get("mode") == "REQUIRED", e.get("description")) for e in entries]
    )


def type_names_from_json(path: str | Path) -> dict[str, str]:
    """Column name to upper-case type name of a schema file."""
    return {e["name"]: e["type"].upper() for e in json.loads(Path(path).read_text())}


# Relational column types and the warehouse type each one loads into.
RELATIONAL_TYPES = {
    "character varying": "STRING",
    "varchar": "STRING",
    "character": "STRING",
    "char": "STRING",
    "text": "STRING",
    "smallint": "INTEGER",
    "integer": "INTEGER",
    "int": "INTEGER",
    "bigint": "INTEGER",
    "serial": "INTEGER",
    "bigserial": "INTEGER",
    "numeric": "NUMERIC",
    "decimal": "NUMERIC",
    "double precision": "FLOAT",
    "real": "FLOAT",
    "boolean": "BOOL",
    "bool": "BOOL",
    "date": "DATE",
    "time": "TIME",
    "timestamp": "TIMESTAMP",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMP",
}


def relational_type(type_name: Column) -> Column:
    """Warehouse type of a relational type, length and precision ignored; STRING when unknown.

    An exact table: matching substrings would turn `interval` and `point` into integers.
    """
    base = F.lower(F.trim(F.regexp_replace(type_name, r"\s*\([^)]*\)", "")))
    pairs = [F.lit(x) for pair in RELATIONAL_TYPES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), base), F.lit("STRING"))


def map_catalog_types(columns: DataFrame, primary_keys: DataFrame) -> DataFrame:
    """Warehouse schema of relational tables.

    `columns` has (table_name, column_name, data_type, ordinal_position), `primary_keys` (table_name,
    column_name); primary key columns are REQUIRED.
    """
    keys = primary_keys.select("table_name", "column_name", F.lit(True).alias("is_key")).distinct()
    return columns.join(keys, ["table_name", "column_name"], "left").select(
        "table_name",
        "column_name",
        "ordinal_position",
        relational_type(F.col("data_type")).alias("type"),
        F.when(F.coalesce("is_key", F.lit(False)), "REQUIRED").otherwise("NULLABLE").alias("mode"),
    )


def struct_of(rows: Iterable) -> T.StructType:
    """StructType of one table's rows of `map_catalog_types` (as many rows as the table has columns)."""
    ordered = sorted(rows, key=lambda r: r["ordinal_position"])
    return T.StructType([field(r["column_name"], r["type"], r["mode"] == "REQUIRED") for r in ordered])
