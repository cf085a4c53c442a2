"""Air-quality index as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# National air-quality bands per pollutant,
# (index low, index high, concentration low, concentration high).
BREAKPOINTS: dict[str, list[tuple[float, float, float, float]]] = {
    "pm25": [
        (0, 50, 0, 30),
        (51, 100, 31, 60),
        (101, 200, 61, 90),
        (201, 300, 91, 120),
        (301, 400, 121, 250),
        (401, 500, 251, 500),
    ],
    "pm10": [
        (0, 50, 0, 50),
        (51, 100, 51, 100),
        (101, 200, 101, 250),
        (201, 300, 251, 350),
        (301, 400, 351, 430),
        (401, 500, 431, 600),
    ],
    "no2": [
        (0, 50, 0, 40),
        (51, 100, 41, 80),
        (101, 200, 81, 180),
        (201, 300, 181, 280),
        (301, 400, 281, 400),
        (401, 500, 401, 500),
    ],
    "so2": [
        (0, 50, 0, 40),
        (51, 100, 41, 80),
        (101, 200, 81, 380),
        (201, 300, 381, 800),
        (301, 400, 801, 1600),
        (401, 500, 1601, 2000),
    ],
    "co": [
        (0, 50, 0, 1.0),
        (51, 100, 1.1, 2.0),
        (101, 200, 2.1, 10.0),
        (201, 300, 10.1, 17.0),
        (301, 400, 17.1, 34.0),
        (401, 500, 34.1, 50.0),
    ],
    "o3": [
        (0, 50, 0, 50),
        (51, 100, 51, 100),
        (101, 200, 101, 168),
        (201, 300, 169, 208),
        (301, 400, 209, 748),
        (401, 500, 749, 1000),
    ],
}
POLLUTANTS = list(BREAKPOINTS)
AQI_MAX = 500.0

# Category names, their colours on the map and in the service,
# and the advice shown with them.
CATEGORIES = ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]
MAP_COLORS = {
    "Good": "#00E400",
    "Satisfactory": "#92D050",
    "Moderate": "#FFFF00",
    "Poor": "#FF7E00",
    "Very Poor": "#FF0000",
    "Severe": "#7E0023",
}
SERVICE_COLORS = {
    "Good": "#00E400",
    "Satisfactory": "#92D050",
    "Moderate": "#FFFF00",
    "Poor": "#FF7E00",
    "Very Poor": "#FF0000",
    "Severe": "#8F3F97",
}
ADVISORIES = {
    "Good": "Air quality is satisfactory. Enjoy outdoor activities!",
    "Satisfactory": "Air quality is acceptable. Sensitive individuals should limit prolonged outdoor exertion.",
    "Moderate": "May cause breathing discomfort to sensitive people. Reduce prolonged outdoor activities.",
    "Poor": "May cause breathing discomfort to people on prolonged exposure. Avoid outdoor activities.",
    "Very Poor": "May cause respiratory illness on prolonged exposure. Avoid outdoor activities, stay indoors.",
    "Severe": "Health alert! May affect healthy people. Avoid all outdoor activities, use air purifiers.",
}
DEFAULT_ADVISORY = "Check air quality before outdoor activities."
# First index of categories 1 to 5; last index of categories
# 0 to 4; closed integer bands of the service.
INDEX_CUTS = [51, 101, 201, 301, 401]
LABEL_CUTS = [50, 100, 200, 300, 400]
SERVICE_BANDS = [(0, 50), (51, 100), (101, 200), (201, 300), (301, 400), (401, 500)]


# Arguments called ``c`` are a column name or any SQL expression. The long CASE
# chains go to Spark as one SQL text each.


def _number(x: float) -> str:
    """SQL literal of the very double that ``x`` is."""
    return f"{float(x)!r}D"


def _cases(cases: Iterable[tuple[str, str]], default: str = "NULL") -> Column:
    return F.expr("CASE " + " ".join(f"WHEN {i} THEN {t}" for i, t in cases) + f" ELSE {default} END")


def clamp_sql(c: str) -> str:
    return f"(CASE WHEN isnan({c}) THEN NULL WHEN ({c}) < 0 THEN 0D WHEN ({c}) > {AQI_MAX}D THEN {AQI_MAX}D ELSE ({c}) END)"


def clamp_aqi(c: str) -> Column:
    """Clip to [0, 500]; NULL stays NULL, and NaN becomes it."""
    return F.expr(clamp_sql(c))


def sub_index_sql(c: str, pollutant: str, none: str = "NULL") -> str:
    """CASE over the bands from the top down; ``none`` where there is no index."""
    bands = BREAKPOINTS.get(pollutant.lower())
    if bands is None:
        return "CAST(NULL AS DOUBLE)"
    cases = [f"WHEN ({c}) > {_number(bands[-1][3])} THEN {AQI_MAX}D"]
    for i, (low, high, c_low, c_high) in reversed(list(enumerate(bands))):
        slope = _number((high - low) / (c_high - c_low))
        line = f"{slope} * (({c}) - {_number(c_low)}) + {_number(low)}"
        cases.append(f"WHEN ({c}) >= {_number(c_low)} THEN {line}")
        if i > 0:  # between the band below and this one
            cases.append(f"WHEN ({c}) > {_number(bands[i - 1][3])} THEN {none}")
    return f"(CASE {' '.join(cases)} ELSE {none} END)"


def sub_index(c: str, pollutant: str) -> Column:
    """Index of one pollutant.

    NULL for NULL, NaN, negative, unknown pollutant and for values that lie between
    two bands; 500 above the last band.
    """
    return F.expr(sub_index_sql(f"nanvl({c}, -1D)", pollutant))


def _present(columns: list[str] | None) -> list[str]:
    return POLLUTANTS if columns is None else [p for p in POLLUTANTS if p in columns]


def aqi_sql(columns: list[str] | None = None) -> str:
    """Largest sub-index, or -1 when there is none.

    Sub-indices lie in [0, 500] by their bands, so the largest needs no clipping.
    With -1 in place of NULL no branch tracks NULLs, which halves the generated
    method: above 8000 bytes the JVM would leave it uncompiled.
    """
    subs = [sub_index_sql(f"nanvl(coalesce({p}, -1D), -1D)", p, "-1D") for p in _present(columns)]
    return f"greatest({', '.join(subs + ['-1D'] * max(1, 2 - len(subs)))})"


def aqi(columns: list[str] | None = None) -> Column:
    """Largest non-NULL sub-index of the pollutant columns present."""
    return F.expr(f"nullif({aqi_sql(columns)}, -1D)")


def dominant_pollutant(columns: list[str] | None = None) -> Column:
    """Pollutant with the largest sub-index; the first in table order on a tie."""
    # array_max orders structs field by field: value first, then the rank. The
    # nameless entry wins when no pollutant has an index.
    ranked = ["struct(-1D AS sub, 1 AS rank, CAST(NULL AS STRING) AS name)"]
    for i, p in enumerate(_present(columns)):
        score = sub_index_sql(f"nanvl(coalesce({p}, -1D), -1D)", p, "-1D")
        ranked.append(f"struct({score} AS sub, {-i} AS rank, '{p}' AS name)")
    return F.expr(f"array_max(array({', '.join(ranked)})).name")


def category_index_sql(c: str) -> str:
    cases = " ".join(f"WHEN ({c}) < {cut} THEN {i}" for i, cut in enumerate(INDEX_CUTS))
    return f"(CASE {cases} WHEN ({c}) IS NOT NULL AND NOT isnan({c}) THEN {len(INDEX_CUTS)} END)"


def category_index(c: str) -> Column:
    """0 to 5, cut at 51, 101, 201, 301 and 401, so 50.5 is still 0."""
    return F.expr(category_index_sql(c))


def category(c: str) -> Column:
    """Label for the map, cut at 50, 100, 200, 300 and 400 inclusive."""
    cases = [(f"({c}) <= {cut}", f"'{name}'") for cut, name in zip(LABEL_CUTS, CATEGORIES)]
    return _cases([*cases, (f"({c}) IS NOT NULL AND NOT isnan({c})", f"'{CATEGORIES[-1]}'")])


def category_banded(c: str) -> Column:
    """Label for the service: closed integer bands, anything else is Severe."""
    cases = [
        (f"({c}) BETWEEN {low} AND {high}", f"'{name}'")
        for (low, high), name in zip(SERVICE_BANDS, CATEGORIES)
    ]
    return _cases([*cases, (f"({c}) IS NOT NULL AND NOT isnan({c})", f"'{CATEGORIES[-1]}'")])


def _lookup(label: str, table: dict[str, str], default: str = "NULL") -> Column:
    return _cases([(f"{label} = '{name}'", f"'{value}'") for name, value in table.items()], default)


def category_color(label: str = "category", service: bool = False) -> Column:
    """Hex colour of a category label."""
    return _lookup(label, SERVICE_COLORS if service else MAP_COLORS)


def health_advisory(label: str = "category") -> Column:
    """Advice for a category label, with a default for unknown labels."""
    return _lookup(label, ADVISORIES, f"'{DEFAULT_ADVISORY}'")
