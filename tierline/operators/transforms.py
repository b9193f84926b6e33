"""Layer transforms: raw -> clean -> fact.

All of them are narrow column expressions plus one dimension join, so a layer
is built in a single pass over its input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compose_date
from ..schemas import DATE_PARTS, DELAY_COLUMNS, FACT_COLUMNS
from .joins import broadcast_bound, byte_bound, join_skewed, maybe_broadcast, profile_dimension


def with_flight_date(raw: DataFrame, name: str = "FLIGHT_DATE", strict: bool = False) -> DataFrame:
    """Append the composed calendar date."""
    return raw.withColumn(name, compose_date(*DATE_PARTS, strict=strict))


def neutralise(df: DataFrame, cols: Iterable[str] = DELAY_COLUMNS, flag: Column | None = None) -> DataFrame:
    """Measures become 0 where ``flag`` holds, else stay as they are (P5).

    A null flag leaves the measure unchanged.  Replaced columns keep their
    position and their double type.
    """
    cond = flag if flag is not None else F.col("CANCELLED") == 1
    return df.withColumns(
        {c: F.when(cond, F.lit(0.0)).otherwise(F.col(c)) for c in cols}
    )


def clean(raw: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Raw flights to the clean layer (L2): date, neutralised delays, parts dropped."""
    return neutralise(with_flight_date(raw, strict=strict_dates)).drop(*DATE_PARTS)


def enrich(
    clean_df: DataFrame,
    airlines: DataFrame,
    check_unique: bool = True,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Clean flights left-joined to airlines (J1); unmatched rows keep a null name.

    With ``check_unique`` one aggregate job over the dimension returns its row
    count and the number of repeated keys: a repeated key raises (the left join
    would silently fan out fact rows), and the row count decides the broadcast.
    Without it, a bounded count decides the broadcast.  Beyond the bound a checked dimension is
    joined by ``join_skewed``, which broadcasts the rows of hot codes alone and
    shuffles the rest; an unchecked one by a plain shuffle join.
    """
    dim = airlines.select(
        F.col("IATA_CODE").alias("_DIM_CODE"), F.col("AIRLINE").alias("AIRLINE_NAME")
    )
    if check_unique:
        # One job gives both the uniqueness verdict and the broadcast bound.
        rows, repeated, size = profile_dimension(dim, ["_DIM_CODE"])
        if repeated:
            raise ValueError(f"airlines: key ('IATA_CODE',) is not unique ({repeated} codes repeat)")
        bound = broadcast_bound(dim) if max_broadcast_rows is None else max_broadcast_rows
        fits = rows <= bound and size <= byte_bound(dim)
        dim_side = F.broadcast(dim) if fits else dim
    else:
        fits, dim_side = True, maybe_broadcast(dim, max_broadcast_rows)
    flights = clean_df.withColumnRenamed("AIRLINE", "AIRLINE_CODE")
    if not fits:
        return join_skewed(flights, dim, "AIRLINE_CODE", "_DIM_CODE")
    return flights.join(dim_side, F.col("AIRLINE_CODE") == F.col("_DIM_CODE"), "left")


def build_fact(enriched: DataFrame) -> DataFrame:
    """Fact projection (P1): nine columns, dimension name as AIRLINE_NAME."""
    return enriched.select(*FACT_COLUMNS)


def fact_measures(clean_df: DataFrame) -> DataFrame:
    """The fact's own columns, for reports that do not read the dimension's name.

    The dimension key is unique, so the left join neither adds nor drops rows, and
    a report without the name needs no join.
    """
    return clean_df.withColumnRenamed("AIRLINE", "AIRLINE_CODE").select(*[c for c in FACT_COLUMNS if c != "AIRLINE_NAME"])


def fact(clean_df: DataFrame, airlines: DataFrame, check_unique: bool = True) -> DataFrame:
    """Clean layer to fact layer (L3)."""
    return build_fact(enrich(clean_df, airlines, check_unique=check_unique))
