"""Airport size classes, regions and route types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.functions import attach, band, first_match

# Airports of each region.
REGIONS = {
    "northeast": "BOS JFK LGA EWR PHL BWI DCA IAD BDL PVD ALB SYR ROC BUF PIT",
    "southeast": "ATL MIA FLL MCO TPA CLT RDU MEM BNA JAX RSW PBI SAV CHS GSP",
    "midwest": "ORD MDW DTW MSP CLE CVG IND MKE STL CMH DSM OMA MCI ICT GRR",
    "southwest": "DFW IAH HOU DAL AUS SAT OKC TUL ELP ABQ LBB MAF",
    "west": "LAX SFO SAN SEA PDX PHX LAS SLC DEN OAK SJC SMF BUR ONT RNO BOI ANC HNL",
}

# Departures above which an airport gets each class.
SIZE_CLASSES = ((500_000, "major_hub"), (100_000, "international_gateway"), (50_000, "regional_hub"))


def region_of(airport: Column | str) -> Column:
    airport = F.col(airport) if isinstance(airport, str) else airport
    return first_match([(airport.isin(*codes.split()), name) for name, codes in REGIONS.items()], "other")


def size_class(classes: Sequence[tuple[int, str]] = SIZE_CLASSES) -> Column:
    return band("origin_flight_count", classes, "secondary", op=">")


def airport_sizes(flights: DataFrame) -> DataFrame:
    """Departures per origin airport."""
    return flights.groupBy("Origin").agg(F.count("*").alias("origin_flight_count"))


def route_regions(flights: DataFrame) -> DataFrame:
    """Region of both ends and the kind of route between them."""
    a, b = F.col("origin_region"), F.col("dest_region")
    coasts = ((a == "west") & (b == "northeast")) | ((a == "northeast") & (b == "west"))
    return flights.withColumns({
        "origin_region": region_of("Origin"),
        "dest_region": region_of("Dest"),
    }).withColumn(
        "route_type",
        first_match([(a == b, "intra_regional"), (coasts, "transcontinental")], "inter_regional"),
    )


def location_features(
    flights: DataFrame,
    sizes: DataFrame | None = None,
    classes: Sequence[tuple[int, str]] = SIZE_CLASSES,
) -> DataFrame:
    """Airport size, regions and route type. Departure counts already present are used."""
    if "origin_flight_count" not in flights.columns:
        flights = attach(flights, airport_sizes(flights) if sizes is None else sizes, ["Origin"])
    return route_regions(flights.withColumn("airport_type", size_class(classes)))
