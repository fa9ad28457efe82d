"""The hand-made planning case: seven materials, three months, worked out on paper."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from shelfcast.sources.contracts import SCHEMAS
from shelfcast.sources.tables import INPUTS, PlanningTables

M1, M2, M3 = dt.date(2026, 9, 1), dt.date(2026, 10, 1), dt.date(2026, 11, 1)
AS_OF = dt.date(2026, 8, 31)

# material: site, opening, forecast per month, lead time, price, prior forecast per month (None: as the forecast)
MATERIALS = {
    "A": ("S1", 100, [50, 50, 50], 30, "1.00", None),
    "B": ("S1", 10, [20, 20, 20], 31, "1.00", None),
    "C": ("S2", 0, [10, 10, 10], 60, "20.50", None),
    "D": ("S2", 5, [30, 30, 30], 61, "10.00", 24),
    "E": (None, None, [9, 9, 9], 90, "1.00", None),
    "F": ("S3", 0, [7], None, None, 0),
    "H": ("S3", 0, [5], 91, "3.35", 4),
}
SUPPLY = [
    ("A", M1, "Confirmed", 50),
    ("B", M2, "Confirmed", 20),
    ("B", M3, "Confirmed", 20),
    ("B", M1, "Planned", 15),
    ("C", M1, "Confirmed", 10),
    ("C", M2, "Planned", 5),
    ("C", M2, "At Risk", 5),
    ("C", M3, "At Risk", 10),
    ("D", M1, "Confirmed", 10),
    ("D", M2, "Confirmed", 10),
    ("D", M3, "Confirmed", 10),
    ("D", M3, "Planned", 5),
    ("D", M3, "At Risk", 5),
    ("D", M1, None, 100),
    ("F", M3, "Confirmed", 50),
    ("H", M1, "confirmed", 100),
]


def rows() -> dict[str, list[tuple]]:
    materials, forecast, inventory = [], [], []
    for name, (site, opening, monthly, lead_time, price, prior) in MATERIALS.items():
        materials.append((name, *[None] * 8, lead_time, price and Decimal(price)))
        for month, units in zip((M1, M2, M3), monthly, strict=False):
            forecast.append((month, "C1", name, units, units - 2, units if prior is None else prior))
        if site:
            inventory.append((AS_OF, name, site, opening, 0, opening, 0))
    supply = [
        (f"SUP-{i}", name, MATERIALS[name][0], month, units, status, "Purchase")
        for i, (name, month, status, units) in enumerate(SUPPLY)
    ]
    return {
        "materials": materials,
        "customers": [("C1",)],
        "actuals": [],
        "forecast": forecast,
        "inventory": inventory,
        "supply": supply,
    }


def tables(spark, **replaced: list[tuple]) -> PlanningTables:
    data = {**rows(), **replaced}
    return PlanningTables(lambda field: spark.createDataFrame(data[field], SCHEMAS[INPUTS[field]]))
