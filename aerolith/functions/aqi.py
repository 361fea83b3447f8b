"""US EPA air-quality index as Column expressions.

All functions are pure ``CASE`` expressions built from the band tables below, so
they run inside whole-stage codegen with no Python in the data path.  They are
assembled as Spark SQL text and parsed once (``F.expr``): a 35-band CASE built
node by node through the Column API costs thousands of driver-to-JVM calls.
Arguments are column names or SQL expression strings.

Two modes (decision D1-D3 of the survey):

* ``"reference"`` (default): a value that falls between two bands (12.05 for PM2.5)
  or below the first band is extrapolated from the *last* band, as the reference
  computes it; rounding is half to even.
* ``"epa"``: the value is first truncated to the band precision (PM2.5 and CO to
  0.1, the others to 1), negatives give NULL, values above the top band are
  extrapolated from the top band.

A NULL concentration gives a NULL sub-index (the reference raises on NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for equal results).
# Bands: (C_low, C_high, I_low, I_high), in the reference's order.
PM25_BANDS = [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200),
              (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500)]
PM10_BANDS = [(0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150), (255, 354, 151, 200),
              (355, 424, 201, 300), (425, 504, 301, 400), (505, 604, 401, 500)]
NO2_BANDS = [(0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150), (361, 649, 151, 200),
             (650, 1249, 201, 300), (1250, 1649, 301, 400), (1650, 2049, 401, 500)]
SO2_BANDS = [(0, 35, 0, 50), (36, 75, 51, 100), (76, 185, 101, 150), (186, 304, 151, 200),
             (305, 604, 201, 300), (605, 804, 301, 400), (805, 1004, 401, 500)]
CO_BANDS = [(0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150), (12.5, 15.4, 151, 200),
            (15.5, 30.4, 201, 300), (30.5, 40.4, 301, 400), (40.5, 50.4, 401, 500)]
# Unit conversions from ug/m3: NO2 -> ppb, SO2 -> ppb, CO -> ppm.
NO2_TO_PPB = 0.53
SO2_TO_PPB = 0.38
CO_TO_PPM = 0.000873
# Forecast index from PM2.5 only: six bands, anything else is 500.
PM25_FORECAST_BANDS = [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150),
                       (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500)]
FORECAST_OUTSIDE = 500
# Status levels: upper bound (inclusive) -> label; above the last bound "Unhealthy".
STATUS_LEVELS = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups")]
STATUS_ABOVE = "Unhealthy"
ALERT_THRESHOLD = 100
# Band precision used by mode="epa".
EPA_PRECISION = {"pm2_5": 0.1, "pm10": 1.0, "nitrogen_dioxide": 1.0, "sulphur_dioxide": 1.0, "carbon_monoxide": 0.1}

BANDS = {
    "pm2_5": PM25_BANDS,
    "pm10": PM10_BANDS,
    "nitrogen_dioxide": NO2_BANDS,
    "sulphur_dioxide": SO2_BANDS,
    "carbon_monoxide": CO_BANDS,
}
UNIT = {"pm2_5": None, "pm10": None, "nitrogen_dioxide": NO2_TO_PPB, "sulphur_dioxide": SO2_TO_PPB,
        "carbon_monoxide": CO_TO_PPM}


def _d(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _sql(c) -> str:
    """SQL text of a column argument: a name (quoted) or an expression string."""
    if isinstance(c, Column):
        raise TypeError("pass a column name or a SQL expression string")
    return c if not c.isidentifier() else f"`{c}`"


def _linear(c: str, band) -> str:
    """((I_hi - I_lo) / (C_hi - C_lo)) * (c - C_lo) + I_lo, in the reference's operation order."""
    clo, chi, ilo, ihi = band
    return f"(({_d(ihi)} - {_d(ilo)}) / ({_d(chi)} - {_d(clo)})) * ({c} - {_d(clo)}) + {_d(ilo)}"


def subindex_sql(c, bands, mode: str = "reference", precision: float | None = None) -> str:
    """Sub-index of concentration ``c`` for ``bands`` (F9) as a SQL CASE expression (bigint)."""
    c = f"CAST({_sql(c)} AS DOUBLE)"
    if mode == "epa":
        return f"CASE WHEN {c} >= {_d(0)} THEN {_truncated_sql(c, bands, round(1 / (precision or 1.0)))} END"
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    whens = " ".join(f"WHEN {c} >= {_d(b[0])} AND {c} <= {_d(b[1])} THEN {_linear(c, b)}" for b in bands)
    return f"CASE WHEN {c} IS NOT NULL THEN CAST(bround(CASE {whens} ELSE {_linear(c, bands[-1])} END, 0) AS BIGINT) END"


def _truncated_sql(c: str, bands, steps: int) -> str:
    """The index of ``c`` truncated to 1/``steps``, in whole steps, so that band edges and halves are exact.

    The inner rounding takes off what binary multiplication adds to a decimal such as 55.4.
    """
    t = f"CAST(floor(round({c} * {_d(steps)}, 6)) AS BIGINT)"
    edges = [(round(b[0] * steps), round(b[1] * steps), b[2], b[3]) for b in bands]
    line = lambda b: f"CAST(bround({_d(b[3] - b[2])} * ({t} - {b[0]}) / {_d(b[1] - b[0])} + {b[2]}, 0) AS BIGINT)"
    return f"CASE {' '.join(f'WHEN {t} BETWEEN {b[0]} AND {b[1]} THEN {line(b)}' for b in edges)} ELSE {line(edges[-1])} END"


def subindex(c, bands, mode: str = "reference", precision: float | None = None) -> Column:
    return F.expr(subindex_sql(c, bands, mode, precision))


def to_index_units_sql(pollutant: str, c) -> str:
    """Concentration in ug/m3 -> the unit of the pollutant's bands (F8)."""
    factor = UNIT[pollutant]
    return _sql(c) if factor is None else f"({_sql(c)} * {_d(factor)})"


def pollutant_subindex_sql(pollutant: str, c=None, mode: str = "reference") -> str:
    c = pollutant if c is None else c
    return subindex_sql(to_index_units_sql(pollutant, c), BANDS[pollutant], mode, EPA_PRECISION[pollutant])


def pollutant_subindex(pollutant: str, c=None, mode: str = "reference") -> Column:
    return F.expr(pollutant_subindex_sql(pollutant, c, mode))


def overall_aqi_sql(pm25="pm2_5", pm10="pm10", no2="nitrogen_dioxide", so2="sulphur_dioxide",
                    co="carbon_monoxide", mode: str = "reference") -> str:
    cols = [pm25, pm10, no2, so2, co]
    parts = [pollutant_subindex_sql(p, c, mode) for p, c in
             zip(["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide"], cols)]
    any_null = " OR ".join(f"{_sql(c)} IS NULL" for c in cols)
    return f"CASE WHEN {any_null} THEN NULL ELSE greatest({', '.join(parts)}) END"


def overall_aqi(pm25="pm2_5", pm10="pm10", no2="nitrogen_dioxide", so2="sulphur_dioxide", co="carbon_monoxide",
                mode: str = "reference") -> Column:
    """Overall index = max of the five sub-indices (F11); NULL if any input is NULL."""
    return F.expr(overall_aqi_sql(pm25, pm10, no2, so2, co, mode))


def pm25_forecast_index(c="pm2_5", mode: str = "reference") -> Column:
    """Forecast index from PM2.5 in six bands.

    ``"reference"``: everything outside the bands (gaps, negatives, NULL) is 500.  ``"epa"``: the value is truncated to tenths, so that
    there are no gaps; NULL and negatives are NULL, above the top band it is 500 (D2).
    """
    c = f"CAST({_sql(c)} AS DOUBLE)"
    if mode == "epa":
        top = PM25_FORECAST_BANDS[-1][1]
        inside = _truncated_sql(c, PM25_FORECAST_BANDS, 10)
        return F.expr(f"CASE WHEN {c} >= {_d(0)} THEN CASE WHEN floor(round({c} * {_d(10)}, 6)) > {_d(top * 10)} THEN CAST({FORECAST_OUTSIDE} AS BIGINT) ELSE {inside} END END")
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    whens = " ".join(f"WHEN {c} >= {_d(b[0])} AND {c} <= {_d(b[1])} THEN CAST(bround({_linear(c, b)}, 0) AS BIGINT)"
                     for b in PM25_FORECAST_BANDS)
    return F.expr(f"CASE {whens} ELSE CAST({FORECAST_OUTSIDE} AS BIGINT) END")


def status(aqi) -> Column:
    """Status label (F13); NULL falls through to the last label as in the reference."""
    a = f"CAST({_sql(aqi)} AS DOUBLE)"
    whens = " ".join(f"WHEN {a} <= {_d(b)} THEN '{label}'" for b, label in STATUS_LEVELS)
    return F.expr(f"CASE {whens} ELSE '{STATUS_ABOVE}' END")


def is_alert(aqi, threshold: float = ALERT_THRESHOLD) -> Column:
    """AQI above the alert threshold."""
    return F.expr(f"CAST({_sql(aqi)} AS DOUBLE) > {_d(threshold)}")
