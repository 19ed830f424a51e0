"""Sources and sinks: text and parquet readers, day-partitioned writers,
catalog tables and their versioned days, text and JDBC export, and the inputs
derived from the driver's tables."""

from accesslake.sources import fixtures, io, versions

__all__ = ["fixtures", "io", "versions"]
