"""Daily loan platform statistics from ten counters shown as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import amount_from_text

# Which counter (by position) fills which measure; the counter at position 6 is not used.
COUNTERS = {
    "penerima_dana_total": 0,
    "penerima_dana_tahun_berjalan": 1,
    "penerima_dana_posisi_akhir": 2,
    "dana_tersalurkan_total": 3,
    "dana_tersalurkan_tahun_berjalan": 4,
    "dana_tersalurkan_posisi_akhir": 5,
    "pemberi_dana_total": 7,
    "pemberi_dana_tahun_berjalan": 8,
    "pemberi_dana_posisi_akhir": 9,
}
COUNTERS_PER_SNAPSHOT = 10


def normalized_amounts(counters: DataFrame, text: str = "amount_text") -> DataFrame:
    return counters.withColumn("amount", amount_from_text(F.col(text)))


def snapshots(counters: DataFrame) -> DataFrame:
    """One row per snapshot with its nine measures and `is_complete`.

    The measures are conditional aggregates, so a snapshot with far too many counters costs no more
    memory than a proper one. A snapshot is complete with exactly ten readable counters at ten positions.
    """
    picked = [
        F.max(F.when(F.col("position") == position, F.col("amount"))).alias(name) for name, position in COUNTERS.items()
    ]
    in_place = [F.max((F.col("position") == p).cast("int")) for p in range(COUNTERS_PER_SNAPSHOT)]
    placed = sum(in_place[1:], in_place[0])
    return (
        normalized_amounts(counters)
        .groupBy("snapshot_id")
        .agg(*picked, F.count("amount").alias("_readable"), F.count(F.lit(1)).alias("_all"), placed.alias("_placed"))
        .withColumn(
            "is_complete",
            (F.col("_all") == COUNTERS_PER_SNAPSHOT)
            & (F.col("_readable") == COUNTERS_PER_SNAPSHOT)
            & (F.col("_placed") == COUNTERS_PER_SNAPSHOT),
        )
        .drop("_readable", "_all", "_placed")
    )


def loan_statistics(counters: DataFrame, run_date: dt.date) -> DataFrame:
    """Complete snapshots, stamped with the run date; the others are the quarantine."""
    return snapshots(counters).where("is_complete").drop("is_complete").withColumn("run_date_bq", F.lit(run_date))


def incomplete_snapshots(counters: DataFrame) -> DataFrame:
    return snapshots(counters).where("not is_complete").drop("is_complete")


def _grouped(amount: str) -> Column:
    return F.format_number(F.col(amount), 0)


def daily_report(statistics: DataFrame) -> DataFrame:
    """The report text of each snapshot row."""
    return statistics.select(
        "snapshot_id",
        F.concat(
            F.lit("date "),
            F.col("run_date_bq").cast("string"),
            F.lit("\n**Penerima Dana** - Posisi Akhir: "),
            _grouped("penerima_dana_posisi_akhir"),
            F.lit("\n**Pemberi Dana** - Posisi Akhir: "),
            _grouped("pemberi_dana_posisi_akhir"),
            F.lit("\n**Dana Tersalurkan** - Posisi Akhir: "),
            _grouped("dana_tersalurkan_posisi_akhir"),
        ).alias("message"),
    )
