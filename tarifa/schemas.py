"""Declared schemas. The raw layer keeps every source value as text; types are given in staging."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw layer, in source order.
STATION_ATTRIBUTES = ["pdv_id", "latitude", "longitude", "cp", "pop"]
PRICE_COLUMNS = [*STATION_ATTRIBUTES, "prix_id", "prix_nom", "maj", "valeur"]
STATION_COLUMNS = [*STATION_ATTRIBUTES, "adresse", "ville"]

LINEAGE = T.StructType(
    [
        T.StructField("_source_year", T.ShortType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_source_sha256", T.StringType()),
        T.StructField("_loaded_at", T.TimestampType()),
    ]
)
LINEAGE_COLUMNS = LINEAGE.fieldNames()


def _text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_PRICES = T.StructType(_text(PRICE_COLUMNS).fields + LINEAGE.fields)
RAW_STATIONS = T.StructType(_text(STATION_COLUMNS).fields + LINEAGE.fields)

# One <pdv> element: attributes get the prefix "_", <prix> repeats.
PDV_ELEMENT = T.StructType(
    [
        *_text(["_id", "_latitude", "_longitude", "_cp", "_pop", "adresse", "ville"]).fields,
        T.StructField("prix", T.ArrayType(_text(["_id", "_nom", "_maj", "_valeur"]))),
    ]
)

ARCHIVES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

RUN_RESULTS = T.StructType(
    [
        T.StructField(
            "args",
            T.StructType(
                [
                    T.StructField("which", T.StringType()),
                    T.StructField("select", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("metadata", T.StructType([T.StructField("generated_at", T.StringType())])),
        T.StructField("elapsed_time", T.DoubleType()),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("unique_id", T.StringType()),
                        T.StructField("status", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
