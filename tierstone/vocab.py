"""Fixed values of the canonical model.

Every list and table here is a fixed value that results depend on: technology names, the
free-text map, colours and thresholds.
"""

# Canonical technology names, in output-column order.
TECHNOLOGIES = (
    "SolarPV", "EnergyStorageSystem", "Wind", "MicroTurbine", "SynchronousGenerator",
    "InductionGenerator", "FarmWaste", "FuelCell", "CombinedHeatandPower", "GasTurbine",
    "Hydro", "InternalCombustionEngine", "SteamTurbine", "Other",
)

# Free text (trimmed, lower case) to canonical technology name.
TECHNOLOGY_SYNONYMS = {
    "solar": "SolarPV",
    "solar pv": "SolarPV",
    "wind": "Wind",
    "storage": "EnergyStorageSystem",
    "energy storage": "EnergyStorageSystem",
    "battery": "EnergyStorageSystem",
    "microturbine": "MicroTurbine",
    "synchronous generator": "SynchronousGenerator",
    "induction generator": "InductionGenerator",
    "farm waste": "FarmWaste",
    "fuel cell": "FuelCell",
    "combined heat and power": "CombinedHeatandPower",
    "chp": "CombinedHeatandPower",
    "gas turbine": "GasTurbine",
    "hydro": "Hydro",
    "hydroelectric": "Hydro",
    "internal combustion engine": "InternalCombustionEngine",
    "ice": "InternalCombustionEngine",
    "steam turbine": "SteamTurbine",
    "other": "Other",
}

# Colour name (trimmed, lower case) to map colour, and the colour of the rest.
COLOUR_HEX = {
    "blue": "#0070C0",
    "brown": "#953736",
    "dark blue": "#003366",
    "green": "#13B157",
    "light blue": "#13AFED",
    "red": "#F6130F",
    "turquoise": "#40E0D0",
    "yellow": "#FFF525",
}
UNKNOWN_COLOUR_HEX = "#808080"

# Texts that stand for a missing value (compared case-exactly after trimming).
NULL_SENTINELS = ("NULL", "null", "N/A", "n/a", "NA", "")

# Rescued keys that carry no business data, and casing variants to recover.
RESCUED_ARTIFACTS = ("_c0", "_file_path")
CASE_VARIANTS = {"shape_length": "Shape_Length"}

# Columns of the raw layer that stop there.
RAW_TRACKING_COLUMNS = ("_index_col_dropped", "_rescued_data")
LINEAGE_COLUMNS = ("ingestion_timestamp", "ingestion_date", "pipeline_update_id")

# Rolling baseline and alert thresholds.
BASELINE_ROWS = 30
BASELINE_MIN_RUNS = 3
BASELINE_SIGMA = 2
STALE_DAYS = 45
AGING_DAYS = 30
UNRESOLVED_MEDIUM = 1000
UNRESOLVED_LOW = 500
Z_SIGNIFICANT = 2
Z_EXTREME = 3

# Validity columns of history tables.
START_AT = "__START_AT"
END_AT = "__END_AT"
