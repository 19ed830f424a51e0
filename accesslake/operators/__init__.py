"""DataFrame -> DataFrame operators of the ODS, DWD and ADS layers."""

from accesslake.operators import ads, dwd, joins, ods

__all__ = ["ads", "dwd", "joins", "ods"]
