"""Declared table contracts.

A ``Contract`` is a ``StructType`` plus the rules the reference only states in
comments or types: the business key of a dimension and the columns declared
not null.  Spark's CSV reader makes every column nullable, so the not-null
rule is checked from the null profile (see ``operators.quality``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return list(self.schema.names)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


I, S, D = IntegerType(), StringType(), DoubleType()

# Column names, order and types of the three source contracts.
FLIGHTS_SCHEMA = _s(
    ("YEAR", I, True),
    ("MONTH", I, True),
    ("DAY", I, True),
    ("DAY_OF_WEEK", I, True),
    ("AIRLINE", S, True),
    ("FLIGHT_NUMBER", S, True),
    ("TAIL_NUMBER", S, True),
    ("ORIGIN_AIRPORT", S, True),
    ("DESTINATION_AIRPORT", S, True),
    ("SCHEDULED_DEPARTURE", S, True),
    ("DEPARTURE_TIME", S, True),
    ("DEPARTURE_DELAY", D, True),
    ("TAXI_OUT", D, True),
    ("WHEELS_OFF", S, True),
    ("SCHEDULED_TIME", D, True),
    ("ELAPSED_TIME", D, True),
    ("AIR_TIME", D, True),
    ("DISTANCE", D, True),
    ("WHEELS_ON", S, True),
    ("TAXI_IN", D, True),
    ("SCHEDULED_ARRIVAL", S, True),
    ("ARRIVAL_TIME", S, True),
    ("ARRIVAL_DELAY", D, True),
    ("DIVERTED", I, True),
    ("CANCELLED", I, True),
    ("CANCELLATION_REASON", S, True),
    ("AIR_SYSTEM_DELAY", D, True),
    ("SECURITY_DELAY", D, True),
    ("AIRLINE_DELAY", D, True),
    ("LATE_AIRCRAFT_DELAY", D, True),
    ("WEATHER_DELAY", D, True),
)

AIRLINES_SCHEMA = _s(
    ("IATA_CODE", S, False),
    ("AIRLINE", S, False),
)

AIRPORTS_SCHEMA = _s(
    ("IATA_CODE", S, False),
    ("AIRPORT", S, True),
    ("CITY", S, True),
    ("STATE", S, True),
    ("COUNTRY", S, True),
    ("LATITUDE", D, True),
    ("LONGITUDE", D, True),
)

FLIGHTS = Contract("flights", FLIGHTS_SCHEMA)
AIRLINES = Contract("airlines", AIRLINES_SCHEMA, key=("IATA_CODE",), not_null=("IATA_CODE", "AIRLINE"))
AIRPORTS = Contract("airports", AIRPORTS_SCHEMA, key=("IATA_CODE",), not_null=("IATA_CODE",))

CONTRACTS = {c.name: c for c in (FLIGHTS, AIRLINES, AIRPORTS)}

# Clean layer: the raw flight columns minus the calendar parts, with the
# composed date appended last.
DATE_PARTS = ("YEAR", "MONTH", "DAY")
SILVER_FLIGHTS_SCHEMA = StructType(
    [f for f in FLIGHTS_SCHEMA.fields if f.name not in DATE_PARTS]
    + [StructField("FLIGHT_DATE", DateType(), True)]
)

# Fact layer projection, in output order.
FACT_COLUMNS = (
    "FLIGHT_DATE",
    "AIRLINE_CODE",
    "AIRLINE_NAME",
    "FLIGHT_NUMBER",
    "ORIGIN_AIRPORT",
    "DESTINATION_AIRPORT",
    "DEPARTURE_DELAY",
    "ARRIVAL_DELAY",
    "CANCELLED",
)

# Delay measures neutralised for cancelled flights, and the
# accepted range in minutes (inclusive).
DELAY_COLUMNS = ("DEPARTURE_DELAY", "ARRIVAL_DELAY")
DELAY_MIN = -300
DELAY_MAX = 720

# The labels the cause report shows, with their raw-layer column.
CAUSES = (
    ("Airline Delay", "AIRLINE_DELAY"),
    ("Weather Delay", "WEATHER_DELAY"),
    ("NAS Delay", "AIR_SYSTEM_DELAY"),
    ("Late Aircraft Delay", "LATE_AIRCRAFT_DELAY"),
    ("Security Delay", "SECURITY_DELAY"),
)
