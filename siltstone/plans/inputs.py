"""Adapters: the supplied test tables seen as the jobs' source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_NAMES = (
    "Januari",
    "Februari",
    "Maret",
    "April",
    "Mei",
    "Juni",
    "Juli",
    "Agustus",
    "September",
    "Oktober",
    "Nopember",
    "Desember",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _after(start: Column, hours: Column | None = None, minutes: Column | None = None, seconds: Column | None = None) -> Column:
    zero = F.lit(0)

    def whole(part: Column | None) -> Column:
        return zero if part is None else part.cast("int")

    return start + F.make_dt_interval(zero, whole(hours), whole(minutes), F.coalesce(seconds, zero) if seconds is not None else zero)


def _pick(index: Column, *choices) -> Column:
    """The choice at a 0-based index."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (index + 1).cast("int"))


# ---- trips -----------------------------------------------------------------------------------------


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Both taxi types in raw columns, with unified time names."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    pickup = _after(F.col("l_shipdate"), hours=F.col("l_suppkey") % 24, minutes=F.col("l_linenumber") * 7)
    return joined.select(
        F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green").alias("taxi_type"),
        (F.col("l_suppkey") % 2 + 1).alias("vendorid"),
        pickup.alias("pickup_datetime"),
        _after(pickup, minutes=F.col("l_quantity") - 2).alias("dropoff_datetime"),
        F.col("s_nationkey").cast("bigint").alias("pulocationid"),
        F.col("c_nationkey").cast("bigint").alias("dolocationid"),
        (F.col("l_orderkey") % 7).cast("double").alias("payment_type"),
        (F.col("l_linenumber") - 1).cast("double").alias("passenger_count"),
        F.round(F.col("l_discount") * 100, 1).alias("trip_distance"),
        _money("l_extendedprice").cast("double").alias("fare_amount"),
        _money("l_quantity").cast("double").alias("tip_amount"),
        (_money("l_extendedprice") + _money("l_quantity")).cast("double").alias("total_amount"),
    )


def raw_trips(spark: SparkSession, folder: str, taxi_type: str) -> DataFrame:
    """One type as the monthly source files name it: mixed case, times prefixed, no type column."""
    prefix = {"yellow": "tpep", "green": "lpep"}[taxi_type]
    rows = trips(spark, folder).where(F.col("taxi_type") == taxi_type)
    return rows.drop("taxi_type").withColumnsRenamed(
        {
            "vendorid": "VendorID",
            "pickup_datetime": f"{prefix}_pickup_datetime",
            "dropoff_datetime": f"{prefix}_dropoff_datetime",
            "pulocationid": "PULocationID",
            "dolocationid": "DOLocationID",
        }
    )


def delivered_trips(spark: SparkSession, folder: str, taxi_type: str) -> list[DataFrame]:
    """The type's raw files: all trips, and the trips of March 1998 once more, as after a repeated load."""
    raw = raw_trips(spark, folder, taxi_type)
    pickup = F.col({"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}[taxi_type])
    again = (pickup >= F.lit("1998-03-01").cast("timestamp_ntz")) & (pickup < F.lit("1998-04-01").cast("timestamp_ntz"))
    return [raw, raw.where(again)]


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.col("n_nationkey").cast("bigint").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_nationkey") % 2 == 0, "Boro").otherwise("Yellow").alias("service_zone"),
    )


# ---- subscription video ----------------------------------------------------------------------------

def _start() -> Column:
    return F.lit("1995-01-01").cast("timestamp_ntz")


def users(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("name"),
        F.concat(F.upper(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@EXAMPLE.COM")).alias("email"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("city"),
        _start().alias("join_date"),
        F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("subscription_status"),
        _start().alias("created_at"),
        F.to_date(_start()).alias("run_date_bq"),
    )


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    days = (F.lit(30) + key % 336).cast("int")
    return table(spark, folder, "customer").select(
        key.alias("subscription_id"),
        key.alias("user_id"),
        _pick(key % 3, "Basic", "Standard", "Premium").alias("plan_type"),
        _start().alias("start_date"),
        (_start() + F.make_dt_interval(days)).alias("end_date"),
        _pick(key % 3, "4.99", "9.99", "14.99").cast("decimal(10,2)").alias("price"),
        F.when(F.col("c_acctbal") >= 0, "active").otherwise("expired").alias("status"),
        _start().alias("created_at"),
        F.to_date(_start()).alias("run_date_bq"),
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 2 == 0, "sci-fi").otherwise(F.lower("p_type")).alias("genre"),
        (F.lit(1990) + F.col("p_size") % 30).cast("bigint").alias("release_year"),
        (F.lit(60) + F.col("p_size")).cast("bigint").alias("duration_min"),
        F.lower("p_brand").alias("language"),
        _start().alias("created_at"),
        F.to_date(_start()).alias("run_date_bq"),
    )


def _lines_with_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def watch_sessions(spark: SparkSession, folder: str) -> DataFrame:
    start = _after(F.col("l_shipdate"), hours=F.col("l_suppkey") % 24)
    return _lines_with_customer(spark, folder).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("session_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_returnflag").alias("device_type"),
        start.alias("start_time"),
        _after(start, minutes=F.lit(10) + F.col("l_quantity") * 3, seconds=F.col("l_linenumber") * 17).alias("end_time"),
        F.round(F.col("l_discount") * 10, 2).cast("decimal(5,2)").alias("completion_rate"),
        F.col("l_shipdate").alias("created_at"),
        F.to_date("l_shipdate").alias("run_date_bq"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "pending")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("subscription_id"),
        _money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
        F.col("o_orderpriority").alias("method"),
        status.otherwise("failed").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.to_date("o_orderdate").alias("run_date_bq"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_with_customer(spark, folder).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rating_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_partkey") % 5 + 1).alias("rating_score"),
        F.col("l_shipdate").alias("rating_date"),
        F.concat("l_returnflag", "l_linestatus").alias("review_text"),
        F.col("l_shipdate").alias("created_at"),
        F.to_date("l_shipdate").alias("run_date_bq"),
    )


# ---- playback events -------------------------------------------------------------------------------


def playback_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        (F.col("event_id") % 100 + 1).alias("session_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("movie_id"),
        F.when(kind == "view", "buffer")
        .when(kind == "click", "start")
        .when(kind == "purchase", "resume")
        .when(kind == "signup", "stop")
        .otherwise(kind)
        .alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.floor(F.col("value") * 20).cast("bigint").alias("buffer_duration_ms"),
    )


# ---- loan counters ---------------------------------------------------------------------------------


def loan_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Ten counters per snapshot as text; now and then one that cannot be read."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    unit = _pick(key % 8, "rb", "jt", "m", "t", "Ribu", "Juta", "Milyar", "Triliun")
    text = (
        F.when(key % 97 == 5, "n/a")
        .when(key % 10 == 8, F.concat(size, F.lit(",250 orang")))
        .when(key % 10 == 9, F.concat(size, F.lit(",125.75")))
        .otherwise(F.concat(size, F.lit(".5 "), unit))
    )
    return table(spark, folder, "part").select(
        F.floor(key / 10).alias("snapshot_id"), (key % 10).alias("position"), text.alias("amount_text")
    )


# ---- court decisions -------------------------------------------------------------------------------


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The facts that the generated pages and documents below are written from.

    A customer row is some thirty times narrower than the text written from it, so the rows are spread
    before: a customer file that is one split would otherwise put all the text work into one task.
    """
    key = F.col("c_custkey")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    rows = customers.repartition(partitions, "c_custkey").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    year, month, day = F.lit(2020) + key % 5, F.lit(1) + key % 12, F.lit(1) + key % 28
    return rows.select(
        key.alias("doc_id"),
        F.concat(key.cast("string"), F.lit("/Pid.B/"), year.cast("string"), F.lit("/PN "), "n_name").alias("number"),
        F.make_date(year.cast("int"), month.cast("int"), day.cast("int")).alias("decided"),
        F.lower("c_name").alias("person"),
        F.lower("n_name").alias("place"),
        F.concat(day.cast("string"), F.lit(" "), _pick(key % 12, *MONTH_NAMES), F.lit(" "), (F.lit(1960) + key % 40).cast("string")).alias("born"),
        _pick(key % 2, "Laki-laki", "Perempuan").alias("gender"),
        F.concat(F.lit("Jalan "), key.cast("string"), F.lit(" "), F.lower("c_mktsegment")).alias("address"),
        _pick(key % 4, "Islam", "Kristen", "Hindu", "Budha").alias("religion"),
        _pick(key % 3, "Swasta", "Petani", "Nelayan").alias("job"),
        (F.lit(300) + key % 90).cast("string").alias("article"),
        (F.lit(10) + key % 30).cast("string").alias("law"),
        F.concat((F.lit(1) + key % 9).cast("string"), F.lit(" (satu) buah "), F.lower("c_mktsegment")).alias("evidence"),
        F.concat(F.lit("https://decisions.example.org/direktori/putusan/"), F.md5(key.cast("string")), F.lit(".html")).alias("link"),
    )


def _written(*parts) -> Column:
    """Concatenate text pieces; names of columns are written as `Column`s."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def decision_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Decision texts with header, furniture, biodata, references, evidence and ruling.

    Texts of `documents` stand before the number and between number and biodata, so that neither is near the start.
    """
    c = F.col
    prose = table(spark, folder, "documents").select(c("doc_id").alias("prose_id"), c("text").alias("prose"))
    rows = decisions(spark, folder).join(prose, c("doc_id") == c("prose_id"), "left").withColumn("prose", F.coalesce("prose", F.lit("")))
    text = _written(
        "Direktori Putusan\nputusan.mahkamahagung.go.id\nP U T U S A N\n",
        c("prose"),
        "\nNomor : ",
        c("number"),
        "\nDEMI KEADILAN BERDASARKAN KETUHANAN YANG MAHA ESA\n",
        c("prose"),
        "\n1. Nama lengkap : ",
        c("person"),
        ";\n2. Tempat lahir : ",
        c("place"),
        ";\n3. Umur/Tanggal lahir : 44 tahun/",
        c("born"),
        ";\n4. Jenis kelamin : ",
        c("gender"),
        ";\n5. Kebangsaan : Indonesia;\n6. Tempat tinggal : ",
        c("address"),
        ";\n7. Agama : ",
        c("religion"),
        ";\n8. Pekerjaan : ",
        c("job"),
        ";\nTerdakwa ditahan oleh penyidik.\nHalaman 1\n\nDisclaimer\nKepaniteraan 021-384 3348 (ext.318)\n\n"
        "Menimbang, bahwa perbuatan ",
        c("person"),
        " diatur dalam Pasal ",
        c("article"),
        " ayat (1) KUHP. Menimbang, bahwa pidana dijatuhkan menurut Undang-Undang Nomor ",
        c("law"),
        "  Tahun 2009, jo. Undang-Undang Nomor ",
        c("law"),
        " Tahun 2009. Barang bukti berupa: ",
        c("evidence"),
        ";\n  dan satu lembar surat;\nDirampas untuk dimusnahkan. Saksi di ",
        c("place"),
        " melihat perbuatan itu! Apakah putusan itu adil?\nM E N G A D I L I :\nMenjatuhkan pidana kepada ",
        c("person"),
        ".\nDemikianlah diputuskan dalam rapat.",
    )
    return rows.select("doc_id", text.alias("text"))


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A listing page per decision: the entry itself, an entry without a date, and the month badges."""
    c = F.col
    month = _pick(F.month("decided") - 1, *MONTH_NAMES)
    html = _written(
        '<html><body><div class="spost clearfix"><div class="small">Register : 01-01-2019</div>'
        '<div class="small">Putus : ',
        F.date_format("decided", "dd-MM-yyyy"),
        ' &mdash; Upload</div><strong><a href="',
        c("link"),
        '">Putusan PN Nomor ',
        c("number"),
        '</a></strong></div><div class="spost clearfix"><div class="small">Belum putus</div><a href="',
        c("link"),
        '?x=1">Putusan Nomor 0</a></div><p class="card-text">',
        month,
        ' <span class="badge badge-secondary">',
        (c("doc_id") % 3).cast("string"),
        '</span></p><p class="card-text">Semua <span class="badge badge-secondary">99</span></p></body></html>',
    )
    return decisions(spark, folder).select(c("doc_id").alias("page_id"), c("link").alias("url"), html.alias("html"))


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A detail page per decision; every third one has no document."""
    c = F.col
    registered = _written(
        F.dayofmonth("decided").cast("string"), " ", _pick(F.month("decided") - 1, *MONTH_NAMES), " ", F.year("decided").cast("string")
    )
    card = F.when(
        c("doc_id") % 3 != 0,
        _written(
            '<div class="card-body bg-white"><a href="/zip/',
            c("doc_id").cast("string"),
            '">Zip</a> <a href="/pdf/',
            c("doc_id").cast("string"),
            '">Pdf</a></div>',
        ),
    ).otherwise("")
    html = _written(
        '<html><body><span id="title_pihak">Penuntut Umum:<br>X<br/>Terdakwa:<br/> ',
        c("person"),
        "</span><table><tr><td>Nomor</td><td> ",
        c("number"),
        "</td></tr><tr><td>Tingkat Proses</td><td>Pertama</td></tr><tr><td>Klasifikasi</td><td><a>Pidana</a> \n <a>Umum</a></td></tr>"
        "<tr><td>Kata Kunci</td><td>",
        c("evidence"),
        "</td></tr><tr><td>Tahun</td><td>",
        F.year("decided").cast("string"),
        "</td></tr><tr><td>Tanggal Register</td><td>",
        registered,
        "</td></tr><tr><td>Lembaga Peradilan</td><td>PN ",
        c("place"),
        "</td></tr><tr><td>Hakim Ketua</td><td>A &amp; B</td></tr><tr><td>Hakim Anggota</td><td>C;D</td></tr>"
        "<tr><td>Amar</td><td>Lain-lain</td></tr><tr><td>Tanggal Musyawarah</td><td>&mdash;</td></tr>"
        "<tr><td>Tanggal Dibacakan</td><td>",
        registered,
        "</td></tr></table>",
        card,
        "</body></html>",
    )
    return decisions(spark, folder).select(c("doc_id").alias("page_id"), c("link").alias("url"), html.alias("html"))


def decision_links(spark: SparkSession, folder: str) -> DataFrame:
    return decisions(spark, folder).select(
        F.col("number").alias("no_putusan"), F.col("decided").alias("tgl_putusan"), F.col("link").alias("link_page_putusan")
    )
