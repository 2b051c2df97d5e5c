"""Zip -> coordinates dimension (#30-#32).

The dimension has one row per zip prefix (the zip domain is bounded, so the
table stays small and joins against it are broadcast by AQE's runtime size
check). Built in three steps: aggregate the raw points, then add customer
zips and seller zips that have no point, with the city's average position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut_lineage

ZIP, LAT, LNG, CITY, STATE = "geolocation_zip_code_prefix", "lat", "lng", "city", "geo_state"
DIM_COLS = [ZIP, LAT, LNG, CITY, STATE]


def zip_geo_agg(geolocation: DataFrame) -> DataFrame:
    """#30: per zip AVG lat, AVG lng, MAX city, MAX state (byte order, T5).

    A NULL zip cannot be a primary key, so its group is dropped (T2).
    """
    return (geolocation.where(F.col(ZIP).isNotNull())
            .groupBy(ZIP)
            .agg(F.avg("geolocation_lat").alias(LAT), F.avg("geolocation_lng").alias(LNG),
                 F.max("geolocation_city").alias(CITY), F.max("geolocation_state").alias(STATE)))


def city_positions(zip_geo: DataFrame) -> DataFrame:
    """Unweighted mean position of a city over its zips (T6a)."""
    return (zip_geo.where(F.col(CITY).isNotNull()).groupBy(CITY)
            .agg(F.avg(LAT).alias("_city_lat"), F.avg(LNG).alias("_city_lng")))


def _smallest_place(places: DataFrame) -> DataFrame:
    """One (city, state) per zip: the smallest, NULLs last."""
    return (places.groupBy(ZIP).agg(F.min(F.struct(F.col(CITY).isNull().alias("_no_city"), CITY,
                                                   F.col(STATE).isNull().alias("_no_state"), STATE)).alias("_cs"))
            .select(ZIP, F.col("_cs." + CITY).alias(CITY), F.col("_cs." + STATE).alias(STATE)))


def add_missing_zips(zip_geo: DataFrame, entities: DataFrame, zip_col: str,
                     city_col: str, state_col: str) -> DataFrame:
    """#31/#32: zips of ``entities`` absent from the dimension, appended.

    ``NOT IN`` semantics on a NULL-free key: NULL entity zips are skipped,
    then a left-anti join. One zip in two cities keeps the smallest
    (city, state), NULLs last, so the key stays unique (T6d). Position = the city's mean
    over the dimension as it is at this step; unknown city -> NULL (T6c).
    """
    new = _smallest_place(entities.where(F.col(zip_col).isNotNull())
                          .select(F.col(zip_col).alias(ZIP), F.col(city_col).alias(CITY),
                                  F.col(state_col).alias(STATE))
                          .join(zip_geo.select(ZIP), ZIP, "left_anti"))
    pos = city_positions(zip_geo)
    added = (new.join(pos, new[CITY] == pos[CITY], "left")
             .select(new[ZIP], F.col("_city_lat").alias(LAT), F.col("_city_lng").alias(LNG),
                     new[CITY], new[STATE]))
    return zip_geo.select(*DIM_COLS).unionByName(added)


def build_zip_geo(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame,
                  materialize: bool = True) -> DataFrame:
    """The completed dimension: points, then customer zips, then seller zips (T6b).

    Like the source's CREATE TABLE, the result is materialized (reliable
    checkpoint in the shared folder): the dimension is small (one row per
    zip prefix) and read by both geo joins of the mart and by every query
    built on it, so it is computed once. Inside the one job, the repeated
    point aggregate is a reused exchange.
    """
    base = zip_geo_agg(geolocation)
    with_c = add_missing_zips(base, customers, "customer_zip_code_prefix",
                              "customer_city", "customer_state")
    out = add_missing_zips(with_c, sellers, "seller_zip_code_prefix", "seller_city", "seller_state")
    return cut_lineage(out, True) if materialize else out


@dataclass(frozen=True)
class ZipState:
    """What the dimension needs of all points and entities seen so far, a row
    per zip in each table: ``points`` (sums and counts of the coordinates,
    largest names), ``customers`` and ``sellers`` (smallest place). Every
    column merges (sum, max, min), so batches may come in any order and a
    batch is read once; earlier points and entities are never read again."""
    points: DataFrame
    customers: DataFrame
    sellers: DataFrame

    def merge(self, other: ZipState) -> ZipState:
        """The state of both inputs: merging a batch's state updates this one."""
        both = self.points.unionByName(other.points).groupBy(ZIP)
        places = [_smallest_place(a.unionByName(b)) for a, b in ((self.customers, other.customers), (self.sellers, other.sellers))]
        return ZipState(both.agg(*_merged()), *places)

    def stored(self) -> ZipState:
        """Written to the shared folder: a row per zip, the input of the next update."""
        return ZipState(*map(cut_lineage, (self.points, self.customers, self.sellers)))

    def dimension(self) -> DataFrame:
        """#30-#32 from the state alone; equals ``build_zip_geo`` on all inputs
        (to the rounding of sums taken in another order)."""
        base = self.points.select(ZIP, *[F.try_divide(f"sum_{c}", f"n_{c}").alias(c) for c in (LAT, LNG)], CITY, STATE)
        return reduce(lambda dim, places: add_missing_zips(dim, places, ZIP, CITY, STATE), (self.customers, self.sellers), base)


def _merged() -> list:
    return [*[F.sum(f"{a}_{c}").alias(f"{a}_{c}") for c in (LAT, LNG) for a in ("sum", "n")], F.max(CITY).alias(CITY), F.max(STATE).alias(STATE)]


def zip_state(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame) -> ZipState:
    """The state of one batch (any of the three may be empty): one partial
    aggregate each, so a hot zip is a row per task."""
    points = (geolocation.where(F.col(ZIP).isNotNull()).groupBy(ZIP)
              .agg(*[x for c in (LAT, LNG) for x in (F.sum(f"geolocation_{c}").alias(f"sum_{c}"), F.count(f"geolocation_{c}").alias(f"n_{c}"))],
                   F.max("geolocation_city").alias(CITY), F.max("geolocation_state").alias(STATE)))

    def places(df: DataFrame, who: str) -> DataFrame:
        return _smallest_place(df.where(F.col(f"{who}_zip_code_prefix").isNotNull()).select(
            F.col(f"{who}_zip_code_prefix").alias(ZIP), F.col(f"{who}_city").alias(CITY), F.col(f"{who}_state").alias(STATE)))

    return ZipState(points, places(customers, "customer"), places(sellers, "seller"))
