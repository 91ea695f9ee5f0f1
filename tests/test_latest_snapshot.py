from datetime import datetime

from machiya.queries import market as Q

SCHEMA = """snapshotSeq int, propertyId string, source string, sourceId string, address string, landAreaM2 double, buildingAreaM2 double, constructionYear int, layout string, priceYen bigint, status string,
    targetStationWalkMinutes double, priceMatched boolean, walkMatched boolean, firstSeenAt timestamp, missedSearchRuns int, propertyType string, lastSeenAt timestamp"""


def rows(snapshot, ids):
    at = datetime(2026, 9, snapshot)
    return [(snapshot, i, "s", i, "青樹市芹東沢2-9-7", 100.0, 80.0, 2000, "3LDK", 30_000_000, "active", 10.0, True, True, at, 0, "house", at) for i in ids]


def test_a_sixth_snapshot_is_the_latest(spark, tmp_path):
    five = [r for n in range(1, 6) for r in rows(n, ["a", "b"])]
    for name, data in (("five", five), ("six", five + rows(6, ["a", "b", "c", "d"]))):
        spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / name / "discovered_listings.parquet"))
        spark.createDataFrame([], "property_id string").write.parquet(str(tmp_path / name / "documents.parquet"))
    count = lambda q, name: q(spark, str(tmp_path / name)).count()
    for q in (Q.tri_state_criteria, Q.quarantine_prune, Q.quarantine_stamps, Q.upsert_state, Q.reconcile, Q.fold_two, Q.similar_listings):
        assert (count(q, "five"), count(q, "six")) == (2, 4), q.__name__
    assert (count(Q.blocked_pairs, "five"), count(Q.blocked_pairs, "six")) == (1, 6)
    got = {r["operation"]: r["n"] for r in Q.set_operations(spark, str(tmp_path / "six")).collect()}
    assert got == {"union": 4, "both": 2, "gone": 0, "all": 6}


def test_pair_rules(spark, tmp_path):
    base = rows(1, ["a", "b", "c", "d"])
    base[1] = (*base[1][:5], 101.5, 80.5, 2001, *base[1][8:])
    base[2] = (*base[2][:16], "flat", base[2][17])
    base[3] = (*base[3][:5], 130.0, *base[3][6:])
    spark.createDataFrame(base, SCHEMA).write.parquet(str(tmp_path / "discovered_listings.parquet"))
    got = {(r["a"], r["b"]): (r["score"], r["conflict"], r["autoSame"]) for r in Q.pair_scores(spark, str(tmp_path)).collect()}
    assert got["a", "b"] == (105, False, True) and got["a", "c"] == (100, True, False) and got["a", "d"] == (85, True, False)
