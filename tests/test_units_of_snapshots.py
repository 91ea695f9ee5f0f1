from datetime import datetime

from machiya.queries.changes_units import p7_common_units, p7_found


def test_common_units_of_all_snapshots(spark, tmp_path):
    seen = datetime(2026, 1, 1)
    data = [(n, f"h{i}", seen, 30_000_000 + 1_000_000 * i, 3000 + 100 * i) for n in range(1, 6) for i in range(8)] + [(2, "gone", seen, 45_000_000, 4500), (3, "h0", seen, 30_000_000, 3000)]
    spark.createDataFrame(data, "snapshotSeq int, propertyId string, lastSeenAt timestamp, priceYen bigint, priceMan int").write.parquet(str(tmp_path / "discovered_listings.parquet"))
    spark.createDataFrame([("s1", "5000", "120")], "id string, price string, land string").write.parquet(str(tmp_path / "source_properties.parquet"))
    got = {(r["snapshotSeq"], r["recordKey"], r["fieldName"], r["commonValue"]) for r in p7_common_units(spark, str(tmp_path)).collect()}
    whole = {(n, k, f, float(yen)) for n, k, _, yen, _ in data for f in ("priceYen", "priceMan")} | {(None, "s1", "price", 50_000_000.0), (None, "s1", "land", 120.0)}
    assert got == whole
    assert p7_found(spark, str(tmp_path)).count() == 0
