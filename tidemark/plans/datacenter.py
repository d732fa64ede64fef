"""The data-center operations schema: two migration versions, their
contract, key columns, ranges and seed rows.

This is the domain the toolkit was built around; tests use it end to end
(create -> seed -> evolve -> record history -> validate).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from tidemark.operators.checks import RangeRule, TableRules


def _f(name, dtype, comment):
    return T.StructField(name, dtype, True, {"comment": comment})


S, D, I, DATE, TS, B = (T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType(),
                        T.TimestampType(), T.BooleanType())

SITES = T.StructType([
    _f("dc_id", S, "site key"), _f("dc_name", S, "display name"), _f("region", S, "sales region"),
    _f("city", S, "city"), _f("country", S, "country"), _f("total_capacity_kw", D, "contracted power"),
    _f("commissioned_date", DATE, "first day in service"), _f("tier_level", I, "uptime tier 1-4"),
    _f("status", S, "active / maintenance / retired"),
])
POWER_V1 = T.StructType([
    _f("record_id", S, "reading key"), _f("dc_id", S, "site key"),
    _f("measurement_timestamp", TS, "reading time"), _f("total_power_kw", D, "facility draw"),
    _f("it_load_kw", D, "IT draw"), _f("cooling_load_kw", D, "cooling draw"),
    _f("lighting_load_kw", D, "lighting draw"), _f("pue_ratio", D, "total / IT"),
])
POWER_V2 = T.StructType(POWER_V1.fields + [
    _f("renewable_pct", D, "share from renewables"), _f("carbon_intensity_kg", D, "kg CO2 per kWh"),
])
COOLING = T.StructType([
    _f("record_id", S, "reading key"), _f("dc_id", S, "site key"),
    _f("measurement_timestamp", TS, "reading time"), _f("supply_temp_celsius", D, "supply air"),
    _f("return_temp_celsius", D, "return air"), _f("humidity_pct", D, "relative humidity"),
    _f("chiller_efficiency", D, "chiller efficiency"), _f("cooling_method", S, "air / liquid / hybrid"),
])
CAPACITY = T.StructType([
    _f("record_id", S, "reading key"), _f("dc_id", S, "site key"), _f("measurement_date", DATE, "day"),
    _f("total_racks", I, "racks installed"), _f("occupied_racks", I, "racks in use"),
    _f("utilization_pct", D, "occupied share"), _f("reserved_racks", I, "racks held"),
    _f("available_power_kw", D, "power headroom"),
])
INCIDENTS = T.StructType([
    _f("incident_id", S, "incident key"), _f("dc_id", S, "site key"), _f("incident_start", TS, "start"),
    _f("incident_end", TS, "end"), _f("severity", S, "minor / major / critical"),
    _f("affected_systems", S, "systems"), _f("root_cause", S, "cause"), _f("resolution_notes", S, "notes"),
    _f("downtime_minutes", D, "minutes down"), _f("sla_breached", B, "SLA breached"),
])

# version -> {table: schema at that version}
VERSIONS = {
    1: {"data_centers": SITES, "power_consumption": POWER_V1, "cooling_metrics": COOLING},
    2: {"data_centers": SITES, "power_consumption": POWER_V2, "cooling_metrics": COOLING,
        "capacity_utilization": CAPACITY, "sla_incidents": INCIDENTS},
}


def contract_rows() -> list[tuple]:
    """``(table, column, type, since_version)`` for every column."""
    rows, seen = [], set()
    for v in sorted(VERSIONS):
        for table, schema in VERSIONS[v].items():
            for f in schema.fields:
                if (table, f.name) not in seen:
                    seen.add((table, f.name))
                    rows.append((table, f.name, f.dataType.simpleString(), v))
    return rows


RULES = [
    TableRules("data_centers", ("dc_id",), (RangeRule("tier_level", 1, 4),)),
    TableRules("power_consumption", ("record_id", "dc_id"), (RangeRule("pue_ratio", 1.0, 3.0),)),
    TableRules("cooling_metrics", ("record_id", "dc_id")),
    TableRules("capacity_utilization", ("record_id", "dc_id"), (RangeRule("utilization_pct", 0, 100),)),
    TableRules("sla_incidents", ("incident_id", "dc_id")),
]

# Declared but unchecked by the original contract (column comments): parts of
# the power draw add up to the total, PUE is total over IT load, downtime is
# the incident's length.  (name, left, right, tolerance) per table.
AGREEMENT = {
    "power_consumption": [
        ("parts_sum_to_total", "it_load_kw + cooling_load_kw + lighting_load_kw", "total_power_kw", 0.5),
        ("pue_is_total_over_it", "total_power_kw / nullif(it_load_kw, 0)", "pue_ratio", 0.01),
    ],
    "sla_incidents": [
        ("downtime_is_duration",
         "(unix_timestamp(incident_end) - unix_timestamp(incident_start)) / 60.0", "downtime_minutes", 0.5),
    ],
}

def _seed_rows() -> dict[str, list[tuple]]:
    """Invented rows that keep the rules, by formula; the parts of the last
    power reading do not add up, which a cross-column rule must find."""
    cities = [("Turku", "FI"), ("Porto", "PT"), ("Quito", "EC"), ("Hobart", "AU"), ("Gander", "CA")]
    n, day = len(cities), dt.date(2026, 5, 4)
    at = dt.datetime(2026, 5, 4, 6, 30)
    sites, power, cooling, capacity = [], [], [], []
    for i, (city, country) in enumerate(cities, start=1):
        key = f"site-{i:02d}"
        sites.append((key, f"{city} hall", f"zone {i % 3}", city, country, 5000.0 + 750 * i,
                      dt.date(2010 + 2 * i, i, 3 * i), 1 + i % 4, "maintenance" if i == n else "active"))
        it, cool, light = 2000.0 + 300 * i, 640.0 + 80 * i, 60.0
        total = it + cool + light + (500.0 if i == n else 0.0)
        power.append((f"pw-{i:03d}", key, at + dt.timedelta(minutes=i), total, it, cool, light, total / it))
        cooling.append((f"cl-{i:03d}", key, at, 17.0 + i / 4, 25.0 + i / 2, 40.0 + i, 0.8 + i / 50,
                        ("air", "liquid", "hybrid")[i % 3]))
        racks, used = 200 * i, 150 * i + 10
        capacity.append((f"ca-{i:03d}", key, day, racks, used, 100.0 * used / racks, 5 * i, 120.0 * i))
    incidents = []
    for i, (minutes, severity) in enumerate([(12, "minor"), (35, "minor"), (48, "major"), (200, "critical")], start=1):
        start = dt.datetime(2026, i, 7 * i, 3 * i, 20)
        incidents.append((f"in-{i:03d}", f"site-{i:02d}", start, start + dt.timedelta(minutes=minutes), severity,
                          f"loop {i}", "worn part", "part exchanged", float(minutes), minutes > 60))
    return {"data_centers": sites, "power_consumption": power, "cooling_metrics": cooling,
            "capacity_utilization": capacity, "sla_incidents": incidents}


SEEDS = _seed_rows()
SEED_SCHEMA = {"data_centers": SITES, "power_consumption": POWER_V1, "cooling_metrics": COOLING,
               "capacity_utilization": CAPACITY, "sla_incidents": INCIDENTS}


def apply_version(spark, version: int) -> list[str]:
    """Bring the session's tables to ``version``: create missing tables,
    add missing columns, seed empty tables.  Returns the touched tables."""
    from tidemark.operators.migrations import add_missing_columns_table, ensure_table, seed_if_empty
    touched = []
    for table, schema in VERSIONS[version].items():
        if spark.catalog.tableExists(table):
            if add_missing_columns_table(spark, table, schema):
                touched.append(table)
        else:
            ensure_table(spark, table, schema)
            touched.append(table)
        rows = spark.createDataFrame(SEEDS[table], SEED_SCHEMA[table])
        seed_if_empty(spark, table, rows)
    return touched
