import datetime as dt
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions import numbers, text, time

SETTINGS = Settings()


def column(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1.569", "1.570"], "1.569"),
        (["1.569", "1.572"], "1.570"),
        (["-0.002", "-0.001"], "-0.001"),
        (["-0.001", "0.000"], "0.000"),
        (["1.500", None], "1.500"),
    ],
)
def test_median_is_cut_toward_zero(spark, values, expected):
    rows = [(Decimal(v) if v else None,) for v in values]
    found = column(spark, rows, "v decimal(8,3)", numbers.decimal_percentile(F.col("v"), 0.5))
    assert found == [Decimal(expected)]


def test_weighted_percentile_equals_repeated_values(spark):
    rows = [(Decimal("1.100"), 3), (Decimal("1.101"), 2), (Decimal("1.900"), 1), (Decimal("0.9"), 2)]
    frame = spark.createDataFrame(rows, "v decimal(8,3), n bigint")
    spread = frame.select("v", F.explode(F.sequence(F.lit(1), "n")))
    for share in (0.25, 0.5, 0.75):
        weighted = frame.select(numbers.decimal_percentile(F.col("v"), share, F.col("n"))).first()[0]
        assert weighted == spread.select(numbers.decimal_percentile(F.col("v"), share)).first()[0]


def test_suspect_prices(spark):
    rows = [
        (3, Decimal("1.50")), (3, Decimal("1.51")), (4, Decimal("1.80")), (4, Decimal("1.81")),
        (1, Decimal("9")), (3, None),
    ]
    flag = numbers.is_suspect(F.col("f"), F.col("p"), SETTINGS)
    assert column(spark, rows, "f smallint, p decimal(8,3)", flag) == [False, True, False, True, False, None]


def utc_texts(spark, clocks):
    frame = spark.createDataFrame([(c,) for c in clocks], "t string")
    instant = time.clock_to_instant(time.read_clock(F.col("t")), "Europe/Paris")
    return [r[0] for r in frame.select(time.utc_clock(instant).cast("string")).collect()]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_local_clock_to_instant(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = {
            "2025-10-26T02:30:00": "2025-10-26 01:30:00",
            "2025-10-26T03:00:00": "2025-10-26 02:00:00",
            "2025-03-30T02:30:00": "2025-03-30 01:30:00",
            "2025-07-01T02:30:00": "2025-07-01 00:30:00",
            "2025-03-09T03:30:00": "2025-03-09 02:30:00",
            "2025-07-01": "2025-06-30 22:00:00",
            " 2025-01-02 00:37:00.5": "2025-01-01 23:37:00.5",
        }
        assert utc_texts(spark, pairs) == list(pairs.values())
        frame = spark.createDataFrame([("2025-03-09T03:30:00",), ("1969-12-31T23:30:00",)], "t string")
        clock = time.read_clock(F.col("t"))
        instant = time.clock_to_instant(clock, "Europe/Paris")
        row = frame.select(time.utc_minute_text(instant), time.clock_day(clock)).collect()
        assert [tuple(r) for r in row] == [
            ("2025-03-09T02:30Z", dt.date(2025, 3, 9)), ("1969-12-31T22:30Z", dt.date(1969, 12, 31)),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_every_quarter_hour_around_the_clock_changes(spark):
    """Against Python's own zone rules, with the second pass in autumn and the shifted hour in spring."""
    paris, step = ZoneInfo("Europe/Paris"), dt.timedelta(minutes=15)
    clocks = [
        dt.datetime(year, month, 24) + i * step
        for year in (2024, 2025, 2026) for month in (3, 10) for i in range(8 * 96)
    ]
    for clock, value in zip(clocks, utc_texts(spark, [c.isoformat() for c in clocks])):
        late = clock.replace(tzinfo=paris, fold=1).astimezone(dt.timezone.utc)
        early = clock.replace(tzinfo=paris, fold=0).astimezone(dt.timezone.utc)
        exists = early.astimezone(paris).replace(tzinfo=None) == clock
        assert value == (late if exists else early).strftime("%Y-%m-%d %H:%M:%S"), clock


def test_unreadable_time(spark):
    rows = [("2024-02-30T08:61:00",), ("2025-01-02T00:37:00",)]
    found = column(spark, rows, "t string", time.try_clock(F.col("t")))
    assert found == [None, dt.datetime(2025, 1, 2, 0, 37)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        utc_texts(spark, ["2024-02-30T08:61:00"])


def test_repair_double_encoding(spark):
    pairs = [
        ("Ã\u0089douard", "Édouard"), ("Ã  la", "à la"), ("SÃO PAULO", "SÃO PAULO"),
        ("Ã\u0089 €", "Ã\u0089 €"), ("Ã\u0089 é", "Ã\u0089 é"), ("plain", "plain"), (None, None),
    ]
    found = column(spark, [(p[0],) for p in pairs], "t string", text.repair_double_encoding(F.col("t")))
    assert found == [p[1] for p in pairs]


def test_trim_strips_unicode_spaces_only(spark):
    rows = [(" a ",), ("\ta ",), (" 　x y ",)]
    assert column(spark, rows, "t string", text.trim_spaces(F.col("t"))) == ["a", "\ta", "x y"]


def test_json_fragments(spark):
    rows = [('a"é\n\\',), (None,)]
    assert column(spark, rows, "t string", text.json_string(F.col("t"))) == ['"a\\"é\\n\\\\"', "null"]
    numbers_ = [(1.5,), (2.0,), (0.0005,), (-0.001,), (None,)]
    found = column(spark, numbers_, "x double", text.json_number(F.col("x"), 4))
    assert found == ["1.5", "2.0", "0.0005", "-0.001", "null"]
