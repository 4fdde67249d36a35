"""The physical plans keep the properties the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from tarifa.operators.in_force import day_blocks
from tarifa.plans.lake import PriceLake


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A lake on Parquet files, large enough to have several files."""
    from tests.lakes import sample_lake

    folder = tmp_path_factory.mktemp("raw")
    source = sample_lake(spark)
    source.raw_prices.write.parquet(f"{folder}/prix")
    source.raw_stations.write.parquet(f"{folder}/stations")
    return PriceLake(spark.read.parquet(f"{folder}/prix"), spark.read.parquet(f"{folder}/stations"))


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def lines(frame, word) -> list[str]:
    return [line for line in plan(frame).splitlines() if word in line]


def test_conflicts_are_limited_before_the_shuffle(stored):
    limits = lines(stored.staged_prices, "WindowGroupLimit")
    assert [bool(re.search(r", 1, Partial$", line.strip())) for line in limits] == [False, True]


def executed(frame) -> str:
    """The final plan of adaptive execution, in which exchanges are reused."""
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return plan(frame).split("== Initial Plan ==")[0]


def test_scan_reads_only_what_is_needed(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    (scan,) = [line for line in executed(stored.price_changes).splitlines() if "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = scan.split("ReadSchema: ")[1]
    assert "PushedFilters: [IsNotNull(prix_id)]" in scan
    assert set(re.findall(r"(\w+):", read)) == {
        "pdv_id", "prix_id", "prix_nom", "maj", "valeur", "_source_year", "_source_file",
    }


def test_reports_are_shuffled_twice_and_summaries_once(stored):
    """A change history costs one exchange for conflicts and one for months; what goes to a pair is one row a month."""
    found = executed(stored.price_changes).splitlines()
    exchanges = [i for i, line in enumerate(found) if "+- Exchange hashpartitioning" in line]
    keys = [re.sub(r"#\d+L?", "", re.findall(r"hashpartitioning\((.*?), \d+\)", found[i])[0]) for i in exchanges]
    assert sorted(keys) == ["_station, _fuel", "_station, _fuel, _mois", "maj_at, _pdv_id, _prix_id, _maj"]
    assert sum("ReusedExchange" in line for line in found) == 1
    to_pair = exchanges[keys.index("_station, _fuel")]
    assert next("HashAggregate" in line for line in found[to_pair + 1 :] if "Codegen" not in line)


def test_current_prices_read_reports_once_with_hash_tables(stored):
    """Reports go into hash tables and are not joined back; only the few names of a pair are compared by sorting."""
    found = executed(stored.current_prices).splitlines()
    assert sum("FileScan" in line for line in found) == 1
    partial = [line for line in found if "partial_max(" in line and "fuel#" in line.split("functions")[0]]
    assert partial and all("HashAggregate" in line for line in partial)
    assert not [line for line in found if "SemiJoin" in line or "SortMergeJoin" in line]


def test_price_stats_scan_once(stored):
    from tarifa.sources import raw

    frame = raw.price_stats(stored.raw_prices)
    assert not lines(frame, "SortAggregate") and len(lines(frame, "Scan ")) <= 1


def test_only_single_rows_are_crossed(stored):
    """A cross join has a global aggregate, hence one row, on its broadcast side."""
    for name in ("current_prices", "daily_medians", "motorway_gap", "prices_in_force"):
        text = plan(getattr(stored, name))
        assert "CartesianProduct" not in text
        assert text.count("BroadcastNestedLoopJoin") == text.count("IdentityBroadcastMode")
        assert text.count("keys=[], functions=[m") >= text.count("IdentityBroadcastMode")


@pytest.mark.parametrize("name", ["daily_medians", "motorway_gap"])
def test_medians_never_expand_reports_to_days(stored, name):
    """A report is at most two rows (blocks of days); days appear above the last aggregate only."""
    text = plan(getattr(stored, name)).splitlines()
    generates = [i for i, line in enumerate(text) if "Generate explode" in line]
    assert len(generates) == 1 and "floor" in text[generates[0]].lower()
    days = [i for i, line in enumerate(text) if "Generate inline" in line]
    assert days and days[0] < min(i for i, line in enumerate(text) if "Aggregate" in line)
    blocks = day_blocks(stored.validity_periods, stored.settings.days_in_force + 1)
    assert blocks.count() <= 2 * stored.validity_periods.count()


def test_no_python_in_the_tables(stored):
    for name in ("staged_prices", "price_changes", "stations", "motorway_gap"):
        assert "Python" not in plan(getattr(stored, name))


def test_a_busy_pair_is_split(spark, stored):
    """One pair with a third of all rows: its months land in different partitions."""
    busy = stored.staged_prices.where("station_id = 1 and fuel_id = 1")
    months = busy.withColumn("mois", F.trunc(F.to_date("maj_at"), "month"))
    parts = months.repartition(64, "station_id", "fuel_id", "mois")
    assert parts.select(F.spark_partition_id()).distinct().count() > 1
