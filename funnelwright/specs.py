"""Declarative table specifications: which raw columns to keep, how to type them, what to call them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from funnelwright.functions.text import snake_case


@dataclass(frozen=True)
class Field:
    """One column. ``names`` are the raw headers it may have; the first one present is used.

    ``type`` is date, timestamp, integer or boolean; anything else means string. ``format`` is a datetime
    pattern for dates and timestamps, and for integers and strings a regular expression to be found.
    """

    names: tuple[str, ...]
    type: str = "string"
    new_name: str | None = None
    format: str | None = None

    def source_in(self, columns: Iterable[str]) -> str | None:
        present = set(columns)
        return next((name for name in self.names if name in present), None)

    def target_for(self, source: str) -> str:
        return self.new_name or snake_case(source)


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]


def specs_from_json(text: str) -> dict[str, TableSpec]:
    """Read specifications written as ``{"input_schemas": [{"name", "entries": [{"name", "type", ...}]}]}``."""
    return {
        table["name"]: TableSpec(table["name"], tuple(_field(entry) for entry in table.get("entries", [])))
        for table in json.loads(text).get("input_schemas", [])
    }


def _field(entry: Mapping) -> Field:
    names = (entry["name"],) if isinstance(entry["name"], str) else tuple(entry["name"])
    return Field(names, entry["type"], entry.get("new_name"), entry.get("format"))


# The established date pattern reads the first two digits as minutes, so every month comes out as January.
# It stays available for comparison with older tables.
VERBATIM_ENTRY_DATE = "mm/dd/yyy"


def report_spec(entry_date: str = "M/d/yyyy") -> TableSpec:
    """The partner report. Patterns take one- or two-digit months, days and hours.

    Fixed values: headers, types and regular expressions.
    """
    return TableSpec(
        "reports",
        (
            Field(("ENTRYDATE",), "date", "entry_date", entry_date),
            Field(("LEADNUMBER",), "integer", "lead_number"),
            Field(("phone_hash",)),
            Field(("email_hash",)),
            Field(("STATE",), "string", format="[a-zA-Z]{2}"),
            Field(("ZIP",), "integer", format="[0-9]{5}"),
            Field(("Appt Date",), "timestamp", format="M/d/yyyy h:mma"),
            Field(("Demo",), "boolean"),
            Field(("Set",), "boolean"),
            Field(("Dispo",)),
            Field(("Job Status",)),
            Field(("CITY", "CityName"), "string", "city_name"),
        ),
    )


# Headers of the delivered leads.
LEADS = TableSpec("leads", (Field(("lead_UUID",), new_name="lead_uuid"), Field(("phone_hash",)), Field(("email_hash",))))

SPECS = {"leads": LEADS, "reports": report_spec()}

# The report's filler for "nothing known", and the conformed columns it occurs in.
SENTINELS = ("-----",)
SENTINEL_COLUMNS = ("email_hash", "phone_hash", "dispo", "job_status", "city_name")


def get_spec(name: str, specs: Mapping[str, TableSpec] = SPECS) -> TableSpec:
    if name not in specs:
        raise ValueError(f"no table specification named {name!r}; known are {sorted(specs)}")
    return specs[name]
