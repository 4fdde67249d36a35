import pytest
from pyspark.sql import functions as F

from tarifa.plans.lake import write_tables
from tarifa.quality.proofs import BREAKS, run_proofs, run_scenarios
from tarifa.quality.checks import CHECKS, REQUIRED, ROW_RULES, rules_by_relation, run_checks
from tarifa.quality.defects import SCENARIOS, replaced
from tests.lakes import lake, report, sample_lake, station


@pytest.fixture(scope="module")
def clean(spark):
    return sample_lake(spark)


def test_inventory():
    """52 generic rules and 20 single ones."""
    assert sum(map(len, REQUIRED.values())) == 44
    assert len(CHECKS) == 20 + 4
    assert set(BREAKS) == set(CHECKS)


def test_every_check_passes_on_clean_data(clean):
    report_ = {r["controle"]: r for r in run_checks(clean).collect()}
    assert {name: r["violations"] for name, r in report_.items()} == dict.fromkeys(CHECKS, 0)
    assert {r["statut"] for r in report_.values()} == {"pass"}


def test_each_check_notices_its_counterexample(clean, tmp_path):
    rows = run_proofs(write_tables(clean, str(tmp_path))).collect()
    assert [r["controle"] for r in rows] == list(CHECKS)
    assert {r["controle"]: (r["temoin"], r["detecte"]) for r in rows} == dict.fromkeys(CHECKS, (0, True))
    assert {r["controle"] for r in rows if r["statut"] == "warn"} == {"suspect_share"}


def test_each_defect_is_noticed_after_what_it_changes_is_derived_anew(clean, tmp_path):
    """Twenty defects of data and of derivations; on written tables they count the same as on a lake that is derived as a whole."""
    assert [s.check for s in SCENARIOS[:3]] == ["maj_parsable", "maj_in_file_year", "empty_tags_alone"]
    assert {s.check for s in SCENARIOS} == set(list(CHECKS)[:20]) and len(SCENARIOS) == 20
    stored = write_tables(clean, str(tmp_path), rules_by_relation(clean.settings))
    rows = {r["controle"]: (r["temoin"], r["violations"], r["statut"], r["detecte"]) for r in run_scenarios(stored).collect()}
    assert {name: (r[0], r[3]) for name, r in rows.items()} == dict.fromkeys(rows, (0, True)) and len(rows) == 20
    assert rows["suspect_share"][2] == "warn"
    some = ["price_range", "mart_stations_in_bounds", "medians_station_bound", "suspect_share", "unique_current"]
    whole = {r["controle"]: r["violations"] for r in run_scenarios(clean, some).collect()}
    assert whole == {name: rows[name][1] for name in some}


def test_row_rules_are_counted_while_writing(spark, clean, tmp_path):
    """What is observed equals what a scan finds, and a report of these checks reads no table."""
    hit = (F.col("pdv_id") == "1") & (F.col("prix_id") == "1")
    places = replaced(clean.raw_stations, F.col("pdv_id") == "2", latitude=F.lit("9900000"))
    broken = clean.with_relations(raw_prices=replaced(clean.raw_prices, hit, valeur=F.lit("7.5")), raw_stations=places)
    stored = write_tables(broken, str(tmp_path), rules_by_relation(clean.settings))
    assert set(stored.observed) == set(ROW_RULES)
    assert stored.observed == {name: CHECKS[name].find(broken).count() for name in ROW_RULES}
    assert stored.observed["price_range"] > 0 and stored.observed["mart_stations_in_bounds"] > 0
    results = run_checks(stored, list(ROW_RULES))
    assert "Scan parquet" not in results._jdf.queryExecution().executedPlan().toString()
    assert {r["controle"]: r["violations"] for r in results.collect()} == stored.observed


def test_generic_checks_fire(spark):
    rows = [
        report(1, 1, "2025-01-02T08:00:00", None),
        report(1, 9, "2025-01-02T08:00:00", "1.5", name="Fuel"),
        report(7, 1, "2025-01-02T08:00:00", "1.5"),
    ]
    places = [station(1, 2025, pop="Z", adresse=None), station(1, 2025, lat="")]
    broken = lake(spark, rows, places)
    nulls = {(r["relation"], r["colonne"]) for r in CHECKS["not_null"].find(broken).collect()}
    assert {("staged_prices", "prix_litre"), ("current_prices", "prix_litre")} <= nulls
    values = {(r["relation"], r["colonne"], r["valeur"]) for r in CHECKS["accepted_values"].find(broken).collect()}
    assert values == {
        ("raw_prices", "prix_id", "9"), ("raw_stations", "pop", "Z"),
        ("staged_prices", "fuel_id", "9"), ("staged_prices", "fuel", "Fuel"),
    }
    orphans = {(r["relation"], r["cle"]) for r in CHECKS["relationships"].find(broken).collect()}
    assert orphans == {(name, 7) for name in ("staged_prices", "price_changes", "current_prices")}
