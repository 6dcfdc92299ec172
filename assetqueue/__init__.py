"""assetqueue: asset-health triage analytics as Spark DataFrame jobs.

Every public function takes DataFrames (plus a frozen config) and returns
DataFrames; nothing is collected to the driver except bounded parameters
(a date, a handful of fitted coefficients).
"""

from assetqueue.config import Config, DEFAULT

__all__ = ["Config", "DEFAULT"]
