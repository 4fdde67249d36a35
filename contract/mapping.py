"""Price reports, stations, archives and run results derived from the given tables by Spark.

``events`` gives one year of reports (hourly times, so some conflict), ``orders`` gives seven years,
``customer`` the stations. All rows of the tables are used.
"""

from __future__ import annotations

import datetime as dt
import mmap
import tempfile
import zipfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.plans.lake import PriceLake
from tarifa.schemas import ARCHIVES, PRICE_COLUMNS

# Fuel code of each event type; code 6 is left out on purpose.
EVENT_FUELS = {"click": "1", "view": "2", "error": "3", "purchase": "4", "signup": "5"}
YEARS = range(1995, 2002)
LOADED_AT = "2024-12-31 06:00:00"
ARCHIVE_EVENTS = 5000
RUN_EVENTS = 500
SETTINGS = Settings()


# Declared, so that no job reads file footers before a query starts.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_suppkey bigint, l_linenumber int, l_discount double, l_tax double, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(number: Column) -> Column:
    return number.cast("string")


def loaded_at() -> Column:
    return F.lit(f"{LOADED_AT}Z").cast("timestamp")


def _lineage(year: Column, label: str) -> list[Column]:
    return [
        year.cast("smallint").alias("_source_year"),
        F.concat(F.lit(f"{label}_annuel_"), _text(year), F.lit("_telecharge_20241231.zip")).alias(
            "_source_file"
        ),
        F.sha2(F.concat(F.lit(label), _text(year)), 256).alias("_source_sha256"),
        loaded_at().alias("_loaded_at"),
    ]


def _place(key: str, nation: Column) -> list[Column]:
    """Coordinates inside the box, postcode and road type from a key."""
    k = F.col(key)
    return [
        _text(k % 100 * 10000 + 4100000).alias("latitude"),
        _text(k % 15 * 100000 - 500000).alias("longitude"),
        F.concat(F.lpad(_text(nation % 5 + 1), 2, "0"), F.lit("000")).alias("cp"),
        F.when(k % 5 == 0, "A").otherwise("R").alias("pop"),
    ]


def second_text(ts: Column) -> Column:
    return F.translate(F.left(_text(ts), F.lit(19)), " ", "T")


def hour_text(ts: Column, days: int) -> Column:
    shifted = ts + F.expr(f"interval {days} days")
    return F.concat(F.translate(F.left(_text(shifted), F.lit(13)), " ", "T"), F.lit(":00:00"))


def silent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an event."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return table(spark, sf_dir, "customer").join(users, "c_custkey", "left_anti")


def _event_report(days: int = 0) -> list[Column]:
    """The report columns as expressions over ``events``."""
    codes = F.create_map(*[F.lit(x) for pair in EVENT_FUELS.items() for x in pair])
    tenths = F.floor(F.col("value") / 50) + 12
    price = F.concat(_text(F.floor(tenths / 10)), F.lit("."), _text(tenths % 10), F.lit("00"))
    return [
        F.element_at(codes, F.col("event_type")).alias("prix_id"),
        F.col("event_type").alias("prix_nom"),
        hour_text(F.col("ts"), days).alias("maj"),
        price.alias("valeur"),
    ]


def event_reports(events: DataFrame, days: int = 0) -> DataFrame:
    return events.select(
        _text(F.col("user_id") + 1).alias("pdv_id"),
        *_place("user_id", F.col("user_id")),
        *_event_report(days),
        *_lineage(F.lit(2024), "events"),
        "ts",
    )


def event_prices(spark: SparkSession, sf_dir: str, days: int = 0) -> DataFrame:
    """Raw reports of 2024 from ``events``, plus an empty tag for each customer without an event."""
    reports = event_reports(table(spark, sf_dir, "events"), days).drop("ts")
    nothing = F.lit(None).cast("string")
    empty = silent_customers(spark, sf_dir).select(
        _text(F.col("c_custkey") + 1).alias("pdv_id"),
        *_place("c_custkey", F.col("c_custkey")),
        *[nothing.alias(name) for name in PRICE_COLUMNS[5:]],
        *_lineage(F.lit(2024), "events"),
    )
    return reports.unionByName(empty)


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stations of 2024, one per customer."""
    return (
        table(spark, sf_dir, "customer")
        .select(
            _text(F.col("c_custkey") + 1).alias("pdv_id"),
            *_place("c_custkey", F.col("c_nationkey")),
            F.concat(F.col("c_name"), F.lit(" ")).alias("adresse"),
            F.col("c_mktsegment").alias("ville"),
            *_lineage(F.lit(2024), "events"),
        )
    )


def event_lake(spark: SparkSession, sf_dir: str, days: int = 0) -> PriceLake:
    return PriceLake(
        event_prices(spark, sf_dir, days), customer_stations(spark, sf_dir), SETTINGS
    )


def clean_lake(spark: SparkSession, sf_dir: str) -> PriceLake:
    """Reports at their own second, so that none conflicts, and two conflicts added: every check passes."""
    reports = event_reports(table(spark, sf_dir, "events")).withColumn("maj", second_text(F.col("ts")))
    reports = reports.drop("ts")
    first = reports.orderBy("pdv_id", "prix_id", "maj").limit(2)
    conflicts = first.withColumn("valeur", F.lit("1.000"))
    return PriceLake(reports.unionByName(conflicts), customer_stations(spark, sf_dir), SETTINGS)


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reports of seven years from ``orders``."""
    thousandths = F.floor(F.col("o_totalprice") / 100)
    price = F.concat(
        _text(F.floor(thousandths / 1000)), F.lit("."), F.lpad(_text(thousandths % 1000), 3, "0")
    )
    day = F.to_date("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .select(
            _text(F.col("o_custkey") + 1).alias("pdv_id"),
            *_place("o_custkey", F.col("o_custkey")),
            F.left(F.col("o_orderpriority"), F.lit(1)).alias("prix_id"),
            F.substring("o_orderpriority", 3, 20).alias("prix_nom"),
            F.concat(_text(day), F.lit("T00:00:00")).alias("maj"),
            price.alias("valeur"),
            *_lineage(F.year(day), "orders"),
        )
    )


def yearly_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stations of seven years: every customer is listed every year."""
    years = F.explode(F.array(*[F.lit(y) for y in YEARS]))
    customers = table(spark, sf_dir, "customer").withColumn("y", years)
    return customers.select(
        _text(F.col("c_custkey") + 1).alias("pdv_id"),
        *_place("c_custkey", F.col("c_nationkey")),
        F.concat_ws(" ", "c_name", _text(F.col("y"))).alias("adresse"),
        F.col("c_mktsegment").alias("ville"),
        *_lineage(F.col("y"), "orders"),
    )


def order_lake(spark: SparkSession, sf_dir: str) -> PriceLake:
    return PriceLake(order_prices(spark, sf_dir), yearly_stations(spark, sf_dir), SETTINGS)


# --- archives --------------------------------------------------------------------------------------


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives from rows (path, element) sorted by path, made one at a time, whatever a batch or a task holds.

    An archive is made in an unnamed file and handed over as a map of it, so that memory holds none whole.
    """
    stamp = pa.scalar(dt.datetime.fromisoformat(f"{LOADED_AT}+00:00"), pa.timestamp("us", "UTC"))
    rows = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    for path, elements in groupby(rows, key=itemgetter(0)):
        with tempfile.TemporaryFile() as file:
            with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(zipfile.ZipInfo("prices.xml"), "w") as document:
                    document.write(b'<?xml version="1.0" encoding="ISO-8859-1"?>\n<pdv_liste>\n')
                    document.writelines(element.encode("ISO-8859-1") for _, element in elements if element is not None)
                    document.write(b"</pdv_liste>\n")
            file.flush()
            mapped = pa.py_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        bounds = pa.array([0, mapped.size], pa.int32()).buffers()[1]
        content = pa.Array.from_buffers(pa.binary(), 1, [None, bounds, mapped])
        columns = [pa.array([path], pa.string()), pa.array([stamp]), pa.array([mapped.size]), content]
        yield pa.RecordBatch.from_arrays(columns, names=ARCHIVES.names)


def _attribute(name: str, value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(f' {name}="'), column, F.lit('"'))


def event_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZIP archives with the reports of ``events``, shaped like a listing of binary files.

    An archive holds a fixed number of consecutive events (and customers), so that more data makes more
    archives and no archive, station element or task grows.
    """
    customers = table(spark, sf_dir, "customer")
    shaped = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / ARCHIVE_EVENTS).alias("lot"),
        F.col("event_id").alias("rang"),
        F.col("user_id").alias("c_custkey"),
        *_event_report(),
    )
    tag = F.concat(
        F.lit("<prix"),
        _attribute("nom", "prix_nom"),
        _attribute("id", "prix_id"),
        _attribute("maj", "maj"),
        _attribute("valeur", "valeur"),
        F.lit("/>"),
    )
    tags = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("rang", tag.alias("t")))), lambda t: t["t"]), ""
    )
    priced = shaped.groupBy("lot", "c_custkey").agg(tags.alias("tags")).join(customers, "c_custkey")
    empty = silent_customers(spark, sf_dir).select(
        "*", F.floor(F.col("c_custkey") / ARCHIVE_EVENTS).alias("lot"), F.lit("<prix/>").alias("tags")
    )
    places = dict(zip(["latitude", "longitude", "cp", "pop"], _place("c_custkey", F.col("c_nationkey"))))
    element = F.concat(
        F.lit("<pdv"),
        _attribute("id", _text(F.col("c_custkey") + 1)),
        *[_attribute(name, value) for name, value in places.items()],
        F.lit("><adresse>Allée &#xC9;té &amp; "),
        F.col("c_name"),
        F.lit(" </adresse><ville>"),
        F.col("c_mktsegment"),
        F.lit("</ville>"),
        F.col("tags"),
        F.lit("</pdv>\n"),
    )
    columns = ["lot", "c_custkey", "c_nationkey", "c_name", "c_mktsegment", "tags"]
    stations = priced.select(*columns).unionByName(empty.select(*columns))
    path = F.concat(F.lit("archives/lot"), _text(F.col("lot")), F.lit("_annuel_2024_telecharge_20241231.zip"))
    elements = stations.select(path.alias("path"), "c_custkey", element.alias("element"))
    ordered = elements.repartition("path").sortWithinPartitions("path", "c_custkey", "element")
    return ordered.select("path", "element").mapInArrow(_zip, ARCHIVES)


# --- run results, manifest, damaged text -------------------------------------------------------------


def write_run_results(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Result documents, each with a fixed number of nodes taken from ``events``."""
    kind = F.when(F.col("event_type") == "signup", "model").otherwise("test")
    status = F.when(F.col("value") > 450, "fail").when(F.col("event_type") == "signup", "success").otherwise("pass")
    node = F.struct(
        F.concat(kind, F.lit(".prices."), F.col("event_type"), F.lit("_"), _text(F.col("event_id"))).alias("unique_id"),
        status.alias("status"),
    )
    documents = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / RUN_EVENTS).alias("lot"))
        .agg(F.collect_list(node).alias("results"))
        .select(
            F.struct(F.lit("build").alias("which")).alias("args"),
            F.struct(F.lit("2024-12-31T06:00:00Z").alias("generated_at")).alias("metadata"),
            (F.col("lot") + 0.26).cast("double").alias("elapsed_time"),
            "results",
        )
    )
    documents.write.mode("overwrite").json(folder)


def order_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily archive copies: a series of 200 days per block of order keys, whose content is the
    order's status and priority, so that copies with the same content occur."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(key / 200).cast("int").alias("annee"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (key % 200).cast("int")).alias("jour"),
        F.sha2(F.concat("o_orderstatus", "o_orderpriority"), 256).alias("sha256"),
        F.floor("o_totalprice").cast("bigint").alias("octets"),
    )


def published_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names already published: the content of every order of low priority that is finished."""
    done = table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    )
    key = F.col("o_orderkey")
    digest = F.sha2(F.concat("o_orderstatus", "o_orderpriority"), 256)
    name = F.concat(F.lit("x_annuel_2024_telecharge_20241231_"), F.substring(digest, 1, 12), F.lit(".zip"))
    return done.select(F.floor(key / 200).cast("int").alias("annee"), name.alias("nom"))

