"""States that a periodic job hands from one run to the next, as a folder of Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_MADE_FOR = "__made_for"


class StateTable:
    """One table for each time, in a folder named by its microseconds. Tables are never changed; one without ``_SUCCESS`` does not count.

    ``made_for`` says what the states belong to; reading those of something else raises ``ValueError``.
    """

    KEEP = 2

    def __init__(self, spark: SparkSession, path: str, made_for: str):
        self.spark, self.path, self.made_for = spark, path, made_for
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def times(self) -> list[int]:
        """Microseconds of the complete states, ascending."""
        if not self._files.exists(self._path(self.path)):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._path(self.path))]
        return sorted(int(name[6:]) for name in names
                      if name.startswith("until=") and self._files.exists(self._path(f"{self.path}/{name}/_SUCCESS")))

    def latest(self) -> tuple[dt.datetime | None, DataFrame | None]:
        """The time of the last complete state and its rows; or None twice."""
        times = self.times()
        if not times:
            return None, None
        rows = self.spark.read.parquet(f"{self.path}/until={times[-1]}")
        other = rows.filter(F.col(_MADE_FOR) != self.made_for).select(_MADE_FOR).first()
        if other:
            raise ValueError(f"the state in {self.path} was made for {other[0]}, not for {self.made_for}")
        return _EPOCH + dt.timedelta(microseconds=times[-1]), rows.drop(_MADE_FOR)

    def put(self, rows: DataFrame, until: dt.datetime) -> None:
        """Write the state as of ``until`` and delete all but the last ``KEEP``. A time without a zone is one of the session's zone."""
        micros = (until - _EPOCH) // dt.timedelta(microseconds=1) if until.tzinfo else self.spark.range(1).select(
            F.unix_micros(F.lit(until.isoformat(sep=" ")).cast("timestamp"))).first()[0]
        rows.withColumn(_MADE_FOR, F.lit(self.made_for)).write.mode("overwrite").parquet(f"{self.path}/until={micros}")
        for old in self.times()[:-self.KEEP]:
            self._files.delete(self._path(f"{self.path}/until={old}"), True)
