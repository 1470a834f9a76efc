"""Declared table schemas.

Fixed inputs are scanned with an explicit ``StructType``: no inference pass, no
string arithmetic under ANSI mode, and HHMM clock columns such as ``0005`` keep
their leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    """Build a StructType from ``"name type, name type"`` (all nullable, no JVM needed)."""
    mapping = {
        "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
        "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, mapping[kind.lower()], True))
    return T.StructType(fields)


# ---- flight data model (the metric engine's native domain) -----------------------------

# The flights file's columns in their file order, with their types.  The
# five delay-reason columns are summed and compared with zero, so they are integers.
FLIGHTS = struct(
    "YEAR int, MONTH int, DAY int, DAY_OF_WEEK int, AIRLINE string, FLIGHT_NUMBER int, "
    "TAIL_NUMBER string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, "
    "SCHEDULED_DEPARTURE string, DEPARTURE_TIME string, DEPARTURE_DELAY int, TAXI_OUT int, "
    "WHEELS_OFF string, SCHEDULED_TIME int, ELAPSED_TIME int, AIR_TIME int, DISTANCE int, "
    "WHEELS_ON string, TAXI_IN int, SCHEDULED_ARRIVAL string, ARRIVAL_TIME string, "
    "ARRIVAL_DELAY int, DIVERTED int, CANCELLED int, CANCELLATION_REASON string, "
    "AIR_SYSTEM_DELAY int, SECURITY_DELAY int, AIRLINE_DELAY int, LATE_AIRCRAFT_DELAY int, "
    "WEATHER_DELAY int"
)

# Airport and airline file columns.
AIRPORTS = struct(
    "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, "
    "LATITUDE double, LONGITUDE double"
)

AIRLINES = struct("IATA_CODE string, AIRLINE string")

# Path catalogue: logical table name -> location.
CATALOG = struct("name string, path string")

# ---- metric state --------------------------------------------------------------------

# The eight columns of a state row, plus ``committedWindow``: the window_start of the
# partial this version commits (null when the metric had no new rows in that run).  Each row is a
# snapshot: ``liveWindows`` names every window of the metric's current result and ``lastBatches``
# the last micro-batch committed per streaming query.
STATE = T.StructType(struct(
    "metricName string, top int, order string, date timestamp, dateFrom date, dateTo date, "
    "path string, pathAll string, committedWindow string"
).fields + [
    T.StructField("liveWindows", T.ArrayType(T.StringType()), True),
    T.StructField("lastBatches", T.MapType(T.StringType(), T.LongType()), True),
    T.StructField("mode", T.StringType(), True),
])

# ---- driver tables (for typed CSV round trips) --------------------------------------

DRIVER = {
    "region": struct("r_regionkey int, r_name string"),
    "nation": struct("n_nationkey int, n_name string, n_regionkey int"),
    "supplier": struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "customer": struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}
