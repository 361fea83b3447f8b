"""SQL twins of ``aerolith.functions.aqi``, from band tables of their own, so that a wrong breakpoint in either shows."""

from __future__ import annotations

# The published upper edges of the seven bands of each pollutant, in whole steps (tenths for PM2.5 and CO, else units).
# A band starts one step above the edge before it.
STEPS = {"pm2_5": 10, "pm10": 1, "nitrogen_dioxide": 1, "sulphur_dioxide": 1, "carbon_monoxide": 10}
UPPER_EDGES = {
    "pm2_5": [120, 354, 554, 1504, 2504, 3504, 5004],
    "pm10": [54, 154, 254, 354, 424, 504, 604],
    "nitrogen_dioxide": [53, 100, 360, 649, 1249, 1649, 2049],
    "sulphur_dioxide": [35, 75, 185, 304, 604, 804, 1004],
    "carbon_monoxide": [44, 94, 124, 154, 304, 404, 504],
}
INDEX_EDGES = [50, 100, 150, 200, 300, 400, 500]
# Factors from micrograms per cubic metre to the bands' units.
FACTORS = {"nitrogen_dioxide": 0.53, "sulphur_dioxide": 0.38, "carbon_monoxide": 0.000873}
STATUS_EDGES = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups")]
STATUS_LAST = "Unhealthy"
OUTSIDE = 500


def step_bands(pollutant: str, join_last: int = 0) -> list[tuple[int, int, int, int]]:
    """(low, high, index low, index high) in steps; ``join_last`` bands at the top are one with the band below them."""
    edges, index = UPPER_EDGES[pollutant], INDEX_EDGES
    keep = [i for i in range(7) if not 6 - join_last <= i < 6]
    out, low, index_low = [], 0, 0
    for i in keep:
        out.append((low, edges[i], index_low, index[i]))
        low, index_low = edges[i] + 1, index[i] + 1
    return out


def bands(pollutant: str, join_last: int = 0) -> list[tuple[float, float, int, int]]:
    n = STEPS[pollutant]
    return [(lo / n, hi / n, a, b) for lo, hi, a, b in step_bands(pollutant, join_last)]


def _d(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _linear(c: str, band) -> str:
    clo, chi, ilo, ihi = band
    return f"(({_d(ihi)} - {_d(ilo)}) / ({_d(chi)} - {_d(clo)})) * ({c} - {_d(clo)}) + {_d(ilo)}"


def subindex(c: str, table) -> str:
    c = f"CAST({c} AS DOUBLE)"
    whens = " ".join(f"WHEN {c} >= {_d(b[0])} AND {c} <= {_d(b[1])} THEN {_linear(c, b)}" for b in table)
    return f"CAST(round_even(CASE {whens} ELSE {_linear(c, table[-1])} END, 0) AS BIGINT)"


def units(pollutant: str, c: str) -> str:
    f = FACTORS.get(pollutant)
    return c if f is None else f"({c} * {_d(f)})"


def pollutant_subindex(pollutant: str, c: str | None = None) -> str:
    return subindex(units(pollutant, c or pollutant), bands(pollutant))


def overall(cols=("pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide")) -> str:
    pols = ["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide", "carbon_monoxide"]
    parts = [pollutant_subindex(p, c) for p, c in zip(pols, cols)]
    nulls = " OR ".join(f"{c} IS NULL" for c in cols)
    return f"CASE WHEN {nulls} THEN NULL ELSE greatest({', '.join(parts)}) END"


def pm25_forecast(c: str = "pm2_5") -> str:
    """Six bands: the top one reaches over two of the index."""
    c = f"CAST({c} AS DOUBLE)"
    whens = " ".join(
        f"WHEN {c} >= {_d(b[0])} AND {c} <= {_d(b[1])} THEN CAST(round_even({_linear(c, b)}, 0) AS BIGINT)"
        for b in bands("pm2_5", join_last=1))
    return f"CASE {whens} ELSE CAST({OUTSIDE} AS BIGINT) END"


def _tenths(c: str, top: str, join_last: int = 0) -> str:
    """The index of a PM2.5 value cut to whole tenths; ``top`` above the bands (``line``: the last band goes on), NULL below them."""
    t = f"CAST(floor(round({c} * CAST(10 AS DOUBLE), 6)) AS BIGINT)"
    line = lambda b: f"CAST(round_even(CAST({b[3] - b[2]} AS DOUBLE) * ({t} - {b[0]}) / CAST({b[1] - b[0]} AS DOUBLE) + {b[2]}, 0) AS BIGINT)"
    table = step_bands("pm2_5", join_last)
    above = line(table[-1]) if top == "line" else top
    return (f"CASE WHEN {c} < 0 THEN NULL " + " ".join(f"WHEN {t} BETWEEN {b[0]} AND {b[1]} THEN {line(b)}" for b in table)
            + f" WHEN {c} IS NOT NULL THEN {above} END")


def pm25_epa(c: str) -> str:
    return _tenths(c, "line")


def pm25_forecast_epa(c: str = "pm2_5") -> str:
    return _tenths(c, f"CAST({OUTSIDE} AS BIGINT)", join_last=1)


def status(a: str) -> str:
    a = f"CAST({a} AS DOUBLE)"
    whens = " ".join(f"WHEN {a} <= {_d(b)} THEN '{label}'" for b, label in STATUS_EDGES)
    return f"CASE {whens} ELSE '{STATUS_LAST}' END"
