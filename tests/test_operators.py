"""Operators against plain Python on small random data."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.time import clock_day, utc_minute_text
from tarifa.operators import in_force, retention, staging
from tarifa.operators.changes import end_state, price_changes
from tests.lakes import lake, prices, report, station

SETTINGS = Settings()


def staged_frame(spark, rows):
    """(station, fuel, name, instant, price) rows shaped like staging."""
    schema = "station_id int, fuel_id smallint, fuel string, maj_at timestamp, prix_litre decimal(8,3)"
    return spark.createDataFrame(rows, schema).withColumn("jour_releve", clock_day(F.col("maj_at")))


def random_history(seed, pairs=6, reports=150, hot=1500):
    """Reports over three years; the first pair holds most of them."""
    draw = random.Random(seed)
    start, rows = dt.datetime(2024, 1, 1), []
    for pair in range(pairs):
        seen = set()
        for _ in range(hot if pair == 0 else reports):
            at = start + dt.timedelta(minutes=draw.randrange(3 * 365 * 24 * 60))
            if at not in seen:
                seen.add(at)
                price = None if draw.random() < 0.05 else Decimal(draw.choice(["1.500", "1.510", "1.520"]))
                rows.append((pair // 2, pair % 2 + 3, "x", at, price))
    # Long silences and months whose first report repeats the last price.
    for month in range(1, 13):
        rows.append((99, 1, "x", dt.datetime(2025, month, 3), Decimal("1.400" if month < 9 else "1.450")))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_price_changes(spark, seed):
    rows = random_history(seed)
    expected = []
    by_pair = defaultdict(list)
    for row in rows:
        by_pair[row[:2]].append(row)
    for pair, history in by_pair.items():
        before, changed_at = None, None
        for row in sorted(history, key=lambda r: r[3]):
            if row[4] != before:
                expected.append((*pair, row[3], row[4], before, before is None, changed_at))
                changed_at = row[3]
            before = row[4]
    found = price_changes(staged_frame(spark, rows), SETTINGS).select(
        "station_id", "fuel_id", "maj_at", "prix_litre", "prix_precedent", "est_premier_releve",
        "changement_precedent_at",
    )
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("cut", [dt.datetime(2025, 1, 1), dt.datetime(2025, 6, 17, 12)])
def test_price_changes_in_two_parts(spark, cut):
    """What a state tells of the first part makes the second part go on as if it had seen all."""
    rows = random_history(7)
    first, second = (staged_frame(spark, [r for r in rows if (r[3] >= cut) == late]) for late in (False, True))
    state = end_state(first)
    parts = price_changes(first, SETTINGS).unionByName(price_changes(second, SETTINGS, state))
    whole = staged_frame(spark, rows)
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, price_changes(whole, SETTINGS).collect()))
    assert sorted(map(repr, end_state(second, state).collect())) == sorted(map(repr, end_state(whole).collect()))


def test_repeats_are_not_changes(spark):
    days = [dt.datetime(2025, 1, d) for d in (1, 2, 3, 4)]
    rows = [(1, 1, "x", d, Decimal(p)) for d, p in zip(days, ["1.5", "1.5", "1.6", "1.5"])]
    found = price_changes(staged_frame(spark, rows), SETTINGS).orderBy("maj_at").collect()
    assert [(str(r["prix_litre"]), r["prix_precedent"] and str(r["prix_precedent"])) for r in found] == [
        ("1.500", None), ("1.600", "1.500"), ("1.500", "1.600"),
    ]
    assert [r["changement_precedent_at"] for r in found] == [None, days[0], days[2]]


@pytest.mark.parametrize("seed", range(2))
def test_prices_in_force(spark, seed):
    rows = [r for r in random_history(seed, reports=40, hot=400)]
    daily = {}
    for station_id, fuel, _, at, price in sorted(rows, key=lambda r: r[3]):
        key = (station_id, fuel, at.date())
        if price is not None or key not in daily:
            daily[key] = price
    last_day = max(key[2] for key in daily)
    expected = []
    for station_id, fuel in {key[:2] for key in daily}:
        days = sorted(k[2] for k in daily if k[:2] == (station_id, fuel))
        for i, day in enumerate(days):
            stop = days[i + 1] if i + 1 < len(days) else last_day + dt.timedelta(days=1)
            for age in range(8):
                current = day + dt.timedelta(days=age)
                if current < stop and current <= last_day:
                    expected.append((station_id, fuel, current, daily[station_id, fuel, day], day))
    found = in_force.prices_in_force(staged_frame(spark, rows), SETTINGS).select(
        "station_id", "fuel_id", "jour", "prix_litre", "releve_le"
    )
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_days_in_force_of_two_reports(spark):
    first, second, end = (dt.datetime(2025, 1, d) for d in (1, 20, 25))
    rows = [(1, 1, "x", first, Decimal("1")), (1, 1, "x", second, Decimal("2")), (2, 1, "x", end, Decimal("3"))]
    found = in_force.prices_in_force(staged_frame(spark, rows), SETTINGS).where("station_id = 1")
    assert sorted(r["jour"].day for r in found.collect()) == [*range(1, 9), *range(20, 26)]


def test_two_fuel_names_on_one_day(spark):
    """The period that would end before it starts gives no row instead of an error."""
    day = dt.datetime(2025, 1, 1)
    rows = [(1, 1, name, day + dt.timedelta(hours=h), Decimal("1")) for h, name in enumerate("ab")]
    found = in_force.prices_in_force(staged_frame(spark, rows), SETTINGS).collect()
    assert [r["fuel"] for r in found] == ["b"]


def test_conflicts_keep_the_highest_price(spark):
    raw = [
        report(1, 1, "2025-01-02T08:00:00", "1.500"),
        report(1, 1, "2025-01-02T08:00:00", "1.700"),
        report(1, 1, "2025-01-02T08:00:00", None),
        report(1, 1, "2025-01-02T08:00:00", "1.700"),
        report(1, None, None, None, 2025),
        report(2, 1, "2025-01-02T08:00:00", "9876"),
    ]
    staged = staging.staged_prices(prices(spark, raw), SETTINGS).orderBy("station_id")
    found = staged.select("*", utc_minute_text(F.col("maj_at")).alias("t")).collect()
    assert [(r["station_id"], str(r["prix_litre"])) for r in found] == [(1, "1.700"), (2, "9876.000")]
    assert found[0]["t"] == "2025-01-02T07:00Z"


def test_current_prices_before_and_after_conflict_resolution(spark):
    raw = [
        report(1, 1, "2025-10-26T02:30:00", "1.500"),
        report(1, 1, "2025-10-26T02:30:00", "1.600", name="Gazole+"),
        report(1, 1, "2025-10-26T01:59:00", "1.900"),
        report(1, 3, "2025-10-20T23:59:00", "1.600"),
        report(2, 1, "2025-10-27T00:10:00", "1.400"),
    ]
    found = lake(spark, raw)
    direct = {tuple(r) for r in found.current_prices.collect()}
    staged = found.with_relations(staged_prices=found.staged_prices)
    assert direct == {tuple(r) for r in staged.current_prices.collect()}
    rows = {(r["station_id"], r["fuel_id"]): r for r in found.current_prices.collect()}
    assert (rows[1, 1]["fuel"], str(rows[1, 1]["prix_litre"])) == ("Gazole+", "1.600")
    assert [rows[k]["nombre_jours_depuis_maj"] for k in [(1, 1), (1, 3), (2, 1)]] == [1, 7, 0]
    assert rows[1, 3]["est_prix_suspect"]


def test_station_dimension_takes_the_newest_priced_version(spark):
    raw = [report(1, 1, "2025-05-01T08:00:00", "1.5"), report(1, 2, "2025-06-01T08:00:00", "1.6")]
    versions = [station(1, 2025, adresse="old"), station(1, 2026, adresse="new"), station(2, 2026)]
    row = lake(spark, raw, versions).stations.collect()
    assert [(r["adresse"], r["annee_version"], r["nombre_fuels"], r["nombre_releves"]) for r in row] == [
        ("old", 2025, 2, 2)
    ]


@pytest.mark.parametrize("zone", ["Europe/Paris", "America/New_York"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    raw = [
        report(s, f, f"2025-{m:02d}-{d:02d}T{h:02d}:30:00", f"1.{s}{f}{d % 10}")
        for s in (1, 2) for f in (1, 3) for m, d in [(3, 9), (3, 29), (3, 30), (10, 25), (10, 26), (11, 2)]
        for h in (0, 1, 3, 23)
    ]

    def results():
        whole = lake(spark, raw)
        frames = [whole.current_prices, whole.price_changes, whole.daily_medians, whole.stations]
        return [sorted(map(repr, f.collect())) for f in frames]

    expected = results()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert results() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def keep_one_by_one(copies):
    """The retention rule as it is told: newest to oldest, the last of each week unless its content is kept."""
    weeks, hashes, kept = set(), set(), set()
    for day, digest in sorted(copies, reverse=True):
        week = day.isocalendar()[:2]
        if week not in weeks and digest not in hashes:
            kept.add(day)
            hashes.add(digest)
        weeks.add(week)
    return kept


def test_retention_against_the_sequential_rule(spark):
    draw, rows, expected = random.Random(5), [], set()
    for year in range(60):
        start = dt.date(2018, 12, 1) + dt.timedelta(days=draw.randrange(800))
        days = sorted({start + dt.timedelta(days=draw.randrange(60)) for _ in range(draw.randrange(1, 40))})
        copies = [(day, draw.choice("abcde")) for day in days]
        rows += [(year, day, digest, 10 + i) for i, (day, digest) in enumerate(copies)]
        expected |= {(year, day) for day in keep_one_by_one(copies)}
    manifest = spark.createDataFrame(rows, "annee int, jour date, sha256 string, octets bigint")
    kept = retention.kept_archives(manifest)
    assert {(r["annee"], r["jour"]) for r in kept.collect()} == expected
    assert retention.dropped_archives(manifest).count() == len(rows) - len(expected)
    summary = retention.retention_summary(manifest).agg(F.sum("gardes"), F.sum("octets_liberes")).first()
    freed = sum(r[3] for r in rows if (r[0], r[1]) not in expected)
    assert tuple(summary) == (len(expected), freed)


@pytest.mark.parametrize(
    "today, force, expected",
    [
        (dt.date(2026, 9, 28), False, {2025: "past_year", 2026: "not_sunday"}),
        (dt.date(2026, 9, 28), True, {2025: "past_year", 2026: "forced"}),
        (dt.date(2026, 9, 27), False, {2025: "past_year", 2026: "end_of_week"}),
    ],
)
def test_publish_decisions(spark, today, force, expected):
    digest = {year: f"{year}".ljust(64, "a") for year in (2024, 2025, 2026)}
    manifest = spark.createDataFrame(
        [(y, today, d) for y, d in digest.items()], "annee int, jour date, sha256 string"
    )
    published = spark.createDataFrame(
        [(2024, f"x_20260101_{digest[2024][:12]}.zip"), (2025, f"x_{digest[2026][:12]}.zip"), (2026, "y.zip")],
        "annee int, nom string",
    )
    found = retention.publish_decisions(manifest, published, today, force).collect()
    assert {r["annee"]: r["raison"] for r in found} == {2024: "already_published", **expected}
    assert {r["annee"]: r["publier"] for r in found} == {
        2024: False, 2025: True, 2026: expected[2026] != "not_sunday",
    }


def test_publish_newest_copy_of_a_content_or_copies_of_a_day(spark):
    """Two copies of one content from different days: one decision; on a given day only its copies are judged."""
    days = [dt.date(2025, 3, 1), dt.date(2025, 3, 9), dt.date(2025, 3, 9)]
    rows = [(2025, days[0], "a" * 64), (2025, days[1], "a" * 64), (2025, days[2], "b" * 64)]
    manifest = spark.createDataFrame(rows, "annee int, jour date, sha256 string")
    none = spark.createDataFrame([], "annee int, nom string")
    found = retention.publish_decisions(manifest, none, dt.date(2025, 3, 9))
    assert sorted((r["sha256"][0], r["jour"], r["publier"]) for r in found.collect()) == [("a", days[1], True), ("b", days[1], True)]
    found = retention.publish_decisions(manifest, none, dt.date(2025, 3, 9), of_day=days[0])
    assert [(r["sha256"][0], r["jour"]) for r in found.collect()] == [("a", days[0])]


def test_dropped_copies_agree_with_the_summary(spark):
    rows = [(2025, dt.date(2025, 3, 5), "a", 1), (2025, dt.date(2025, 3, 5), "b", 2), (2025, dt.date(2025, 2, 5), "c", 4)]
    manifest = spark.createDataFrame(rows, "annee int, jour date, sha256 string, octets bigint")
    summary = retention.retention_summary(manifest).first()
    dropped = retention.dropped_archives(manifest).collect()
    assert summary["supprimes"] == len(dropped) == 1 and summary["octets_liberes"] == dropped[0]["octets"] == 1
