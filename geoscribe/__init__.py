"""geoscribe: DataFrame operators for geotagged, timestamped short texts.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` with the
column names passed as parameters, so the same code serves the 13-field post
layout (``geoscribe.schema``) and any other table.  The work always runs on
the executors as Spark SQL expressions; nothing is collected to the driver.
"""

from geoscribe.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
