"""Queries of the two general problems: snapshot changes and common units, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machiya.functions.quantities import AREA_M2, PRICE_MAN, PRICE_YEN
from machiya.operators.quantities import amount_prior, common_scales, common_units
from machiya.operators.snapshots import latest_readings, snapshot_changes
from machiya.sources.tables import table

#: Outer blanks of any kind, for comparing status texts.
BLANKS = r"^[\s　]+|[\s　]+$"


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    listings = table(spark, folder, "discovered_listings")
    readings = latest_readings(listings, ["snapshotSeq", "propertyId"], "lastSeenAt", ["status", "priceYen"])
    fields = {"status": F.lower(F.regexp_replace("status", BLANKS, "")), "priceYen": F.col("priceYen")}
    return snapshot_changes(readings, "snapshotSeq", "propertyId", fields)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(spark, folder).select("snapshotSeq", "propertyId", "changeKind")


def p3_changed_fields(spark: SparkSession, folder: str) -> DataFrame:
    """How many listings were added, removed or changed per snapshot, and in which fields."""
    out = _changes(spark, folder).select("snapshotSeq", "changeKind", F.concat_ws("+", "changedFields").alias("fields"))
    return out.groupBy("snapshotSeq", "changeKind", "fields").agg(F.count("*").alias("listings"))


def _listing_amounts(listings: DataFrame) -> DataFrame:
    """(snapshotSeq, recordKey, fieldName, recorded, own, commonValue, certain): the prices of each reading of ``listings`` in yen."""
    readings = latest_readings(listings, ["snapshotSeq", "propertyId"], "lastSeenAt", ["priceYen", "priceMan"])
    prior = amount_prior(listings, F.col("priceYen") * PRICE_YEN.own)
    fields = {"priceYen": PRICE_YEN, "priceMan": PRICE_MAN}
    scaled = common_scales(readings.crossJoin(F.broadcast(prior)), fields, F.col("center"), F.col("spread"))
    cells = [
        F.struct(F.lit(n).alias("fieldName"), F.col(n).cast("double").alias("recorded"), F.lit(f.own).alias("own"), F.col(f"{n}_common").alias("commonValue"), F.col(f"{n}_certain").alias("certain"))
        for n, f in fields.items()
    ]
    return scaled.select("snapshotSeq", F.col("propertyId").alias("recordKey"), F.explode(F.array(*cells)).alias("c")).select("snapshotSeq", "recordKey", "c.*").where("commonValue is not null")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    last = table(spark, folder, "discovered_listings").where("snapshotSeq = 5")
    numbers = _listing_amounts(last).where(F.col("commonValue") != F.col("recorded") * F.col("own"))
    texts = common_units(table(spark, folder, "source_properties"), "id", {"price": PRICE_MAN, "land": AREA_M2}).where(~F.col("plain"))
    rows = numbers.select("recordKey", "fieldName", "commonValue").unionByName(texts.select(F.col("id").alias("recordKey"), "fieldName", "commonValue"))
    return rows.select("recordKey", "fieldName", F.round("commonValue").cast("bigint").alias("commonValue")).distinct()


def p7_common_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every stated price and land area in yen or m², plain values included, and whether its unit is certain.

    Listings have one row per snapshot, reading and field; the hand-kept records belong to no snapshot (null).
    """
    numbers = _listing_amounts(table(spark, folder, "discovered_listings")).select("snapshotSeq", "recordKey", "fieldName", "commonValue", "certain")
    texts = common_units(table(spark, folder, "source_properties"), "id", {"price": PRICE_MAN, "land": AREA_M2})
    return numbers.unionByName(texts.select(F.lit(None).cast("int").alias("snapshotSeq"), F.col("id").alias("recordKey"), "fieldName", "commonValue", "certain"))


_READINGS = """
readings AS (
  SELECT DISTINCT snapshotSeq, propertyId, lower(regexp_replace(status, '^[\\s　]+|[\\s　]+$', '', 'g')) AS st, priceYen
  FROM (SELECT *, rank() OVER (PARTITION BY snapshotSeq, propertyId ORDER BY lastSeenAt DESC NULLS LAST) AS rk FROM discovered_listings)
  WHERE rk = 1),
pairs AS (
  SELECT coalesce(n.snapshotSeq, o.snapshotSeq + 1) AS snapshotSeq, coalesce(n.propertyId, o.propertyId) AS propertyId,
         CASE WHEN o.propertyId IS NULL THEN 'added' WHEN n.propertyId IS NULL THEN 'removed' ELSE 'changed' END AS changeKind,
         n.st IS DISTINCT FROM o.st AS st_changed, n.priceYen IS DISTINCT FROM o.priceYen AS price_changed
  FROM (SELECT * FROM readings WHERE snapshotSeq > 1) n
  FULL JOIN (SELECT * FROM readings WHERE snapshotSeq < 5) o ON n.propertyId = o.propertyId AND n.snapshotSeq = o.snapshotSeq + 1
  WHERE o.propertyId IS NULL OR n.propertyId IS NULL OR n.st IS DISTINCT FROM o.st OR n.priceYen IS DISTINCT FROM o.priceYen)
"""

QUERIES = {"p3_found": p3_found, "p3_changed_fields": p3_changed_fields, "p7_found": p7_found, "p7_common_units": p7_common_units}

SQL = {
    "p3_found": f"WITH {_READINGS} SELECT snapshotSeq, propertyId, changeKind FROM pairs",
    "p3_changed_fields": f"""WITH {_READINGS}
        SELECT snapshotSeq, changeKind,
               CASE WHEN changeKind <> 'changed' THEN '' WHEN st_changed AND price_changed THEN 'priceYen+status'
                    WHEN st_changed THEN 'status' ELSE 'priceYen' END AS fields, count(*) AS listings
        FROM pairs GROUP BY ALL""",
}
