"""Access-log warehouse on PySpark.

Raw tab-separated access-log lines go to a cleaned ODS layer, a wide DWD layer
enriched with the province, city and ISP of each IP address, and an ADS layer
that counts requests per city and host for each day. Every step is a
DataFrame -> DataFrame function built from Spark's own column expressions,
joins and aggregates; I/O sits at the edges (``accesslake.sources``) and the
day jobs that wire it together live in ``accesslake.plans``.
"""

from accesslake import schemas
from accesslake.functions import parse
from accesslake.operators import ads, dwd, joins, ods

__all__ = ["schemas", "parse", "ods", "dwd", "ads", "joins"]
