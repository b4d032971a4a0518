"""Claims data quality on Spark.

Layout:

* ``sources``    -- claims CSV scan, the claims view over ``events``, cost responses
* ``functions``  -- Column-level building blocks (rules, z-score, folder prefix)
* ``operators``  -- DataFrame -> DataFrame operators (classify, outliers, tiers,
                    metrics, time series, alarms, costs, remediation)
* ``plans``      -- end-to-end batch job, sinks, the query catalog
* ``streaming``  -- per-file arrival ingest and windowed metric streams
"""

from claimsdq.params import DQParams

__all__ = ["DQParams"]
