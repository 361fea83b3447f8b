"""Registered query of the streaming operators in batch form (T5); the stream tests are in tests/."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.plans import sqlparts as S
from aerolith.plans.common import round_doubles
from aerolith.plans.registry import query
from aerolith.sources import fixtures as fx
from aerolith.streaming.incremental import hourly_rollup as _rollup


@query("hourly_rollup", sql=f"""WITH {S.ev_cte()}
SELECT station, time AS window_start, time + INTERVAL 1 HOUR AS window_end, count(*) AS n,
  {S.q6(f"{S.dbl('sum(c)')} / {S.dbl('100 * count(*)')}")} AS mean_value,
  {S.q6(S.dbl('max(c)') + ' / ' + S.dbl('100'))} AS max_value
FROM ev GROUP BY station, time""")
def hourly_rollup(spark, sf_dir):
    """T5: every raw event rolled up into tumbling one-hour windows per station."""
    ev = fx.table(spark, sf_dir, "events")
    ev = ev.select(F.col("user_id").alias("station"), "ts",
                   F.round(F.col("value") * 100).cast("bigint").alias("c"))
    out = _rollup(ev, ["station"], "ts", {
        "n": F.count(F.lit(1)),
        "mean_value": F.sum("c").cast("double") / (F.count(F.lit(1)) * 100).cast("double"),
        "max_value": F.max("c").cast("double") / F.lit(100.0),
    })
    return round_doubles(out)
