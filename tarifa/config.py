"""Settings that every job shares; a job receives them as an argument and never reads globals."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Fuel codes of the source data and their names.
FUELS = {1: "Gazole", 2: "SP95", 3: "E85", 4: "GPLc", 5: "E10", 6: "SP98"}

# Road types of a station in the source data.
ROAD_TYPES = ("R", "A", "N")


@dataclass(frozen=True)
class Settings:
    """Business parameters of the pipeline."""

    zone: str = "Europe/Paris"
    # Above these prices an E85 (3) or GPLc (4) report looks like a petrol price.
    suspect_above: dict[int, Decimal] = field(
        default_factory=lambda: {3: Decimal("1.50"), 4: Decimal("1.80")}
    )
    # A report stays in force at most this many days after its own day.
    days_in_force: int = 7
    recent_days: int = 7
    first_year: int = 2025
    # In January the previous year's archive may still change.
    january_days: int = 15
    max_delay_days: int = 2
    # Plausible price per litre, and bounding box of the stations (degrees).
    price_range: tuple[Decimal, Decimal] = (Decimal("0.30"), Decimal("4"))
    latitude_range: tuple[float, float] = (41.0, 51.5)
    longitude_range: tuple[float, float] = (-5.5, 10.0)
    max_conflicts: int = 10
    max_suspect_share: Decimal = Decimal("0.01")
    fuels: dict[int, str] = field(default_factory=lambda: dict(FUELS))
    # The gap series of this fuel may skip a day: some days no area has both kinds of stations.
    gap_series_exempt: tuple[int, ...] = (2,)
