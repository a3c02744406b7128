"""Default rules. Every operator takes its rules as arguments; these are only the defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# --- Fixed values: results depend on these exact labels, amounts and dates. ---

EXCLUDED_TYPES = ("DO NOT USE/TESTING",)

FEE_SCHEDULE = {
    "Area Not Designed For Parking": 50,
    "Boot Fee": 60,
    "Failed To Pay At Visitor Lot": 35,
    "Fire Lane - Blocking/Impeding": 60,
    "No Valid Permit": 50,
    "Parked In Dedicated Space": 50,
    "Parked In Loading Zone": 35,
    "Parked In Tow Zone": 50,
    "Parked In Wrong Direction": 35,
    "Tow Fee": 60,
    "Unauthorized Use of Permit": 60,
    "Not Parked Between Lines": 50,
    "Not In Assigned Area": 50,
    "Parking For Clinic Patients Only": 50,
    "Abandoned Vehicle": 50,
    "Backed In/Pulled Through Space": 35,
    "Expired Permit": 50,
    "Expired Hourly Parking": 35,
    "No License Plate Displayed": 35,
    "Parked In Visitor Space": 50,
}

ZERO_FINE_STATUSES = ("Transfer", "Zero Balance", "Inactive")

SEMESTERS = (
    ("Fall 2025", "2025-08-01", "2025-12-31"),
    ("Spring 2026", "2026-01-01", "2026-05-31"),
)

CAMPUSES = ("Kennesaw", "Marietta")

WEATHER_CODE_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Icy fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Heavy drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Violent showers",
    95: "Thunderstorm",
    96: "Thunderstorm w/ hail",
    99: "Thunderstorm w/ heavy hail",
}

DRY_LABEL = "None"
PRECIP_UPPER_BOUNDS = ((5.0, "Light"), (15.0, "Moderate"))
WETTEST_LABEL = "Heavy"

UNKNOWN = "Unknown"

# --- End of fixed values. ---


@dataclass(frozen=True)
class CitationRules:
    excluded_types: Sequence[str] = EXCLUDED_TYPES
    schedule: Mapping[str, int] = field(default_factory=lambda: FEE_SCHEDULE)
    zero_fine_statuses: Sequence[str] = ZERO_FINE_STATUSES
    semesters: Sequence[tuple[str, str, str]] = SEMESTERS
    # False: a range ends at midnight of its last day. True: at the end of that day.
    whole_last_day: bool = False


@dataclass(frozen=True)
class WeatherRules:
    code_labels: Mapping[int, str] = field(default_factory=lambda: WEATHER_CODE_LABELS)
    dry_label: str = DRY_LABEL
    upper_bounds: Sequence[tuple[float, str]] = PRECIP_UPPER_BOUNDS
    wettest_label: str = WETTEST_LABEL

    @property
    def buckets(self) -> list[str]:
        return [self.dry_label, *(label for _, label in self.upper_bounds), self.wettest_label]
