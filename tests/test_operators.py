import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from machiya.operators import aggregates, history, joins, merging
from machiya.operators.components import components
from machiya.operators.quality import require, shrink_guard, violations
from machiya.operators.snapshots import latest_readings, snapshot_changes
from machiya.plans.skew import lookup_join

SNAP = "seq int, id string, status string, price bigint, seen timestamp, n int"


def snap(spark, data):
    from datetime import datetime

    return spark.createDataFrame([(s, i, st_, p, t and datetime(2026, 1, t), 0) for s, i, st_, p, t in data], SNAP)


def test_snapshot_changes(spark, as_rows):
    data = [
        (1, "a", "active", 10, 1), (1, "b", "active", 10, 1), (1, "c", None, None, 1), (1, "e", "x", 1, 1),
        (2, "a", " Active", 10, 2), (2, "a", "ended", 99, 1), (2, "c", "x", None, 2), (2, "d", "new", 5, None), (2, "d", "new", 5, None), (2, "e", "x", None, 1),
        (4, "a", "active", 10, 3), (4, "c", "x", 7, 3), (4, "e", "x", None, 1), (4, "b", "active", 10, 1), (None, "z", "x", 1, 1), (4, None, "x", 1, 1),
    ]
    readings = latest_readings(snap(spark, data), ["seq", "id"], "seen", ["status", "price"])
    out = snapshot_changes(readings, "seq", "id", {"status": F.lower(F.trim("status")), "price": F.col("price")})
    got = {(r["seq"], r["id"]): (r["changeKind"], r["changedFields"]) for r in out.collect()}
    assert got == {
        (2, "b"): ("removed", []), (2, "c"): ("changed", ["status"]), (2, "d"): ("added", []), (2, "e"): ("changed", ["price"]),
        (4, "b"): ("added", []), (4, "c"): ("changed", ["price"]), (4, "d"): ("removed", []),
    }


def test_snapshot_changes_of_empty_and_single(spark):
    empty = snap(spark, [])
    one = snap(spark, [(1, "a", "x", 1, 1)])
    for df in (empty, one):
        assert snapshot_changes(latest_readings(df, ["seq", "id"], "seen", ["status"]), "seq", "id", ["status"]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_match_union_find(spark, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    expected = {x: find(x) for x in parent}
    df = spark.createDataFrame(edges, "a int, b int")
    assert {r["node"]: r["root"] for r in components(df, "a", "b").collect()} == expected


def test_lookup_join_splits_hot_keys(spark, as_rows):
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(200)] + [(999, None)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("zz", 3)], "rk string, v int")
    plain = left.join(right, F.col("k") == F.col("rk"), "left")
    split = lookup_join(left, right, "k", "rk", "left", hot_share=0.1, hot_rows=10)
    assert as_rows(plain) == as_rows(split)


def test_rank_percentiles_match_sorting(spark):
    rng = random.Random(3)
    data = [("g", rng.choice([1.0, 2.0, 2.0, 5.5, 9.0])) for _ in range(57)] + [("h", 1.0), ("n", None)]
    got = {r["g"]: (r["p20"], r["p80"]) for r in aggregates.rank_percentiles(spark.createDataFrame(data, "g string, v double"), ["g"], F.col("v"), {"p20": 0.2, "p80": 0.8}).collect()}
    xs = sorted(v for g, v in data if g == "g")
    assert got == {"g": (xs[int(56 * 0.2)], xs[int(56 * 0.8)]), "h": (1.0, 1.0)}


def test_market_metrics_keeps_empty_areas(spark):
    df = spark.createDataFrame([("a", 10.0, 2.0), ("a", 20.0, None), ("a", 0.0, 1.0)], "area string, p double, s double")
    areas = spark.createDataFrame([("a",), ("b",)], "area string")
    got = {r["area"]: r for r in aggregates.market_metrics(df, "area", F.col("p"), F.col("s"), areas).collect()}
    assert got["a"]["medianPrice"] == 15.0 and got["a"]["medianUnitPrice"] == 5.0 and got["a"]["confidence"] == "low"
    assert got["b"]["transactionCount"] == 0 and got["b"]["medianPrice"] is None


def test_changed_rows_and_price_history(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 8), ("a", 4, 12), ("a", 5, None), ("b", 1, None)], "k string, t int, p int")
    assert [(r["k"], r["t"]) for r in history.changed_rows(df, "k", ["t"], ["p"]).orderBy("k", "t").collect()] == [("a", 1), ("a", 3), ("a", 4), ("a", 5), ("b", 1)]
    got = history.price_history(df.withColumn("tie", F.col("t")), "k", "t", "p", "tie").orderBy("t").collect()
    assert [(r["price"], r["firstPrice"], r["totalReduction"], r["reductions"]) for r in got] == [(10, 10, 0, 0), (8, 10, 2, 1), (12, 10, 0, 1)]


def test_bounded_history(spark):
    df = spark.createDataFrame([(list(range(40)),), ([1, 2],)], "h array<int>")
    got = [r[0] for r in df.select(history.bounded_history(F.col("h"))).collect()]
    assert got[0] == [0, *range(11, 40)] and got[1] == [1, 2]


def test_presence_counts_healthy_misses_only(spark):
    seen = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("b", 1), ("c", 1), ("c", 2), ("c", 4), ("c", 5)], "k string, run int")
    runs = spark.createDataFrame([(1, True), (2, True), (3, True), (4, False), (5, True)], "run int, ok boolean")
    got = {r["k"]: (r["firstRun"], r["lastRun"], r["misses"], r["relisted"]) for r in history.presence(seen, runs, "k", "run", "ok").collect()}
    assert got == {"a": (1, 5, 0, 1), "b": (1, 1, 3, 0), "c": (1, 5, 0, 1)}


def test_merge_records_is_order_independent(spark):
    data = [("a", 1, "x", None), ("a", 2, None, 5), ("a", 3, "", 7), ("b", 1, None, None)]
    usable = {"s": F.col("s").isNotNull() & (F.col("s") != "")}
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, s string, v int")
        out = merging.merge_records(df, ["k"], [F.col("t")], {"s": "latest", "v": "earliest", "t": "max"}, usable)
        results.append(sorted(map(tuple, out.collect())))
    assert results[0] == results[1] == results[2] == [("a", "x", 5, 3), ("b", None, None, 1)]


def test_blocked_pairs_respect_sizes(spark):
    df = spark.createDataFrame([(f"a{i}", "big") for i in range(13)] + [("b1", "two"), ("b2", "two"), ("c", "one"), ("d", None)], "k string, blk string")
    assert [(r["a"], r["b"]) for r in joins.blocked_pairs(df, "k", F.col("blk"), ["k"], 2, 12).collect()] == [("b1", "b2")]


def test_duplicate_pairs_of_crowded_addresses_and_localities(spark, monkeypatch):
    monkeypatch.setattr(joins, "BLOCK_PART", 5)
    data = [(f"a{i:02}", "青樹市芹東沢2-9-7") for i in range(30)] + [("b1", "若鳩市鶴舞ケ原77-1"), ("b2", "若鳩市鶴舞ケ原77"), ("b3", "若鳩市鶴舞ケ原77-1"), ("b4", "若鳩市鶴舞ケ原"), ("b5", "若鳩市鶴舞ケ原88-1")]
    data += [("c1", "短町1-2"), ("c2", "短町1"), ("d", None)]
    df = spark.createDataFrame(data, "k string, adr string")
    got = [(r["a"], r["b"], r["same"]) for r in joins.duplicate_pairs(df, "k", F.col("adr"), ["k"], F.regexp_count("adr", F.lit("[0-9]+")) >= 2).collect()]
    crowded = {(f"a{i:02}", f"a{j:02}", True) for i in range(30) for j in range(i + 1, 30)}
    near = {("b1", "b3", True), ("b1", "b2", False), ("b2", "b3", False), ("b1", "b4", False), ("b3", "b4", False), ("b4", "b5", False)}
    assert len(got) == len(set(got)) and set(got) == crowded | near


def test_unique_key_lookup_variants(spark):
    left = spark.createDataFrame([(1, "p1", "s1"), (2, "p9", "s2"), (3, "pp", "s1"), (4, None, None)], "i int, p string, s string")
    right = spark.createDataFrame([("p1", "s9", "one"), ("pp", "s1", "two"), ("pp", "s3", "three"), ("px", "s2", "four")], "p string, s string, v string")
    keys = [F.col("p"), F.col("s")]
    skip = {r["i"]: r["value"] for r in joins.unique_key_lookup(left, right, "i", keys, keys, "v").collect()}
    stop = {r["i"]: r["value"] for r in joins.unique_key_lookup(left, right, "i", keys, keys, "v", skip_ambiguous=False).collect()}
    assert skip == {1: "one", 2: "four", 3: "two", 4: None} and stop == {1: "one", 2: "four", 3: None, 4: None}


def test_comparables_are_null_tolerant(spark):
    items = spark.createDataFrame([("a", "x", 100.0, None, None), ("b", None, 100.0, None, None), ("c", "x", None, None, 2000)], "k string, area string, l double, b double, y int")
    sales = spark.createDataFrame([("x", 10.0, 130.0, 1.0, None), ("x", 20.0, 200.0, None, 1970), ("x", 30.0, None, None, 2010), ("x", 0.0, 100.0, None, None)], "area string, p double, l double, b double, y int")
    names = {"key": "k", "land": "l", "building": "b", "year": "y"}
    got = {r["key"]: (r["comparables"], r["medianPrice"]) for r in joins.comparables(items, sales, "area", names, names, "p", 0.65, 1.35, 20).collect()}
    assert got == {"a": (2, 20.0), "b": (0, None), "c": (2, 20.0)}


def join_rows(plan):
    """Rows that each join of an executed plan gave."""
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.metrics().apply("numOutputRows").value()] if "Join" in name else []
    return own + [n for p in inner for n in join_rows(p)]


@pytest.mark.parametrize("district, want", [(None, (3000, 1500.5, "area")), (("town", "d"), (1000, 1499.5, "district"))], ids=["comparables", "valuation_comparables"])
def test_comparables_form_no_pairs(spark, district, want):
    items = spark.range(300).selectExpr("id k", "'x' area", "100.0 + id / 100 l", "cast(null as double) b", "2000 y", "'北町' town")
    sales = spark.range(3000).selectExpr("'x' area", "1.0 + id p", "100.0 l", "80.0 b", "2001 y", "if(id % 3 = 0, '北町', '南町') d")
    names = {"key": "k", "land": "l", "building": "b", "year": "y"}
    df = joins.comparables(items, sales, "area", names, names, "p", 0.65, 1.35, 20, district)
    got = df.collect()
    assert len(got) == 300 and {tuple(r)[1:] for r in got} == {want}
    assert max(join_rows(df._jdf.queryExecution().executedPlan())) <= 3000  # not 900,000 pairs


@pytest.mark.parametrize("chunk, part, repeats", [(7, 5, 1), (40, 9, 3), (1000, 1000, 1), (1000, 20, 9)])
def test_comparables_of_many_chunks_match_brute_force(spark, monkeypatch, chunk, part, repeats):
    from statistics import median

    monkeypatch.setattr(joins, "SALES_CHUNK", chunk)
    monkeypatch.setattr(joins, "ITEMS_PART", part)
    rng = random.Random(chunk + repeats)
    size = lambda: rng.choice([None, 0.0, -1.0, float("nan"), round(rng.uniform(40, 300), 1), 65.0, 100.0, 135.0])
    items = [(f"i{n}", rng.choice(["x", "x", "y", "z", None]), size(), size(), rng.choice([None, rng.randint(1970, 2020)]), rng.choice(["北町一", "南町", "", None])) for n in range(60)]
    sales = [(rng.choice(["x", "x", "y", "w", None]), rng.choice([None, 0.0, 10.0, 20.0, 30.0, round(rng.uniform(1, 90), 2)]), size(), size(), rng.choice([None, rng.randint(1970, 2020)]), rng.choice(["北町", "南町", "", None])) for _ in range(150)]
    sales += [s for s in sales for _ in range(rng.choice([0, 1, repeats, 4 * repeats]) if repeats > 1 else 0)]
    unknown = lambda v: v is None or not v > 0
    ok = lambda a, b: unknown(a) or unknown(b) or a * 0.65 <= b <= a * 1.35
    for district in (None, ("town", "d")):
        want = {}
        for k, area, land, building, year, town in items:
            near = [(p, d) for a, p, sl, sb, sy, d in sales if area and a == area and p and ok(land, sl) and ok(building, sb) and (year is None or sy is None or abs(year - sy) <= 10)]
            own = [p for p, d in near if district and town and d and d in town]
            ps, level = (own, "district") if len(own) >= 3 else ([p for p, _ in near], "area")
            want[k] = (len(ps), pytest.approx(median(ps)) if ps else None, level)
        i = spark.createDataFrame(items, "k string, area string, l double, b double, y int, town string")
        o = spark.createDataFrame(sales, "area string, p double, l double, b double, y int, d string")
        names = {"key": "k", "land": "l", "building": "b", "year": "y"}
        got = {r["key"]: (r["comparables"], r["medianPrice"], r["level"]) for r in joins.comparables(i, o, "area", names, names, "p", 0.65, 1.35, 10, district).collect()}
        assert got == want


def test_comparables_meet_the_sales_of_a_small_area_once(spark, monkeypatch):
    items = spark.range(20).selectExpr("id k", "if(id % 2 = 0, 'x', 'y') area", "100.0 + id l", "cast(null as double) b", "2000 y", "'北町' town")
    sales = spark.range(90).selectExpr("if(id % 3 = 0, 'x', 'y') area", "if(id < 3, null, id - 3) p", "100.0 l", "80.0 b", "2001 y", "if(id % 5 = 0, '北町', '南町') d")
    names = {"key": "k", "land": "l", "building": "b", "year": "y"}
    run = lambda: joins.comparables(items, sales, "area", names, names, "p", 0.65, 1.35, 20, ("town", "d"))
    df = run()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("FlatMapCoGroups") == 1  # counted and looked up at once
    monkeypatch.setattr(joins, "SALES_CHUNK", 40)  # y has two chunks, x one
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, run().collect()))


def test_sales_are_read_by_code_that_is_compiled(spark, tmp_path):
    from machiya.functions import text
    from machiya.queries import market

    texts = ["12", "12.7", "1e5", "-5", "+5", " 7", "7 ", "1,200", "１２０", "0", "00", "9" * 18, "9" * 19, "9" * 30, "12d", "NaN", "", "-", "120㎡", "3.", ".5", "12\n", "約30", None]
    t = spark.createDataFrame([("x", v, v, v, "1999年", "北町") for v in texts], "_cityName string, TradePrice string, Area string, TotalFloorArea string, BuildingYear string, DistrictName string")
    t.write.parquet(f"{tmp_path}/transactions.parquet")
    sales = market._sales(spark, str(tmp_path))
    want = {r["c"]: r["n"] for r in t.select(F.col("Area").alias("c"), text.lenient_number(F.col("Area")).alias("n")).collect()}
    assert sorted((r[0] for r in sales.select("land").collect()), key=repr) == sorted(want.values(), key=repr)
    stages = sales._jdf.queryExecution().debug().codegenToSeq()
    assert max(stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())) < 8000  # longer ones are interpreted


def test_comparables_and_similar_rows_match_brute_force(spark):
    import random
    from statistics import median

    rng = random.Random(9)
    size = lambda: rng.choice([None, 0.0, -1.0, round(rng.uniform(40, 300), 1), 100.0])
    items = [(f"i{n}", rng.choice(["x", "y", None]), size(), size(), rng.choice([None, rng.randint(1970, 2020)]), rng.choice(["北町一", "南町", None])) for n in range(60)]
    sales = [(rng.choice(["x", "y", None]), float(rng.choice([0, 10, 20, 30, 40])), size(), size(), rng.choice([None, rng.randint(1970, 2020)]), rng.choice(["北町", "南町", "", None])) for _ in range(150)]
    ok = lambda a, b: a is None or b is None or a <= 0 or b <= 0 or a * 0.65 <= b <= a * 1.35
    want = {}
    for k, area, land, building, year, town in items:
        near = [(p, d) for a, p, sl, sb, sy, d in sales if area and a == area and p > 0 and ok(land, sl) and ok(building, sb) and (year is None or sy is None or abs(year - sy) <= 10)]
        own = [p for p, d in near if town and d and d in town]
        ps, level = (own, "district") if len(own) >= 3 else ([p for p, _ in near], "area")
        want[k] = (len(ps), median(ps) if ps else None, level)
    i = spark.createDataFrame(items, "k string, area string, l double, b double, y int, town string")
    o = spark.createDataFrame(sales, "area string, p double, l double, b double, y int, d string")
    names = {"key": "k", "land": "l", "building": "b", "year": "y"}
    got = {r["key"]: (r["comparables"], r["medianPrice"], r["level"]) for r in joins.comparables(i, o, "area", names, names, "p", 0.65, 1.35, 10, ("town", "d")).collect()}
    assert got == want and {"district", "area"} == {v[2] for v in got.values()}

    rows = [(f"r{n}", rng.choice(["x", "x", "y", None]), rng.choice([None, 0, 900_000, rng.randint(1, 90) * 1_000_000]), size()) for n in range(90)] + [("twin", "x", 5_000_000, 80.0), ("twin2", "x", 5_000_000, 80.0)]
    known = lambda v: v is not None and v > 0
    want = {}
    for k, a, p, land in rows:
        ps = [q for j, b, q, other in rows if j != k and a and a == b and known(p) and known(q) and abs(q - p) <= max(0.35 * p, 1e6) and (not known(land) or not known(other) or abs(other - land) <= max(25, 0.35 * land))]
        want[k] = (len(ps), median(ps) if ps else None)
    df = spark.createDataFrame(rows, "k string, area string, p bigint, l double")
    got = {r["k"]: (r["similar"], r["medianPrice"]) for r in joins.similar_rows(df, "k", "area", "p", "l", 0.35, 1e6, 0.35, 25.0).collect()}
    assert got == want and joins.similar_rows(df.limit(0), "k", "area", "p", "l", 0.35, 1e6, 0.35, 25.0).count() == 0


def test_upsert_marks_missing(spark):
    schema = "k string, first int, last int, status string, p int"
    old = spark.createDataFrame([("a", 1, 5, "active", 9), ("b", 2, 5, "active", 8)], schema)
    new = spark.createDataFrame([("a", 7, 7, "active", None), ("c", 7, None, "active", 3)], schema)
    got = sorted(map(tuple, merging.latest_previous_union(old, new, "k", "first", "last", "status", F.lit(9)).collect()))
    assert got == [("a", 1, 7, "active", 9), ("b", 2, 5, "missing", 8), ("c", 7, 9, "active", 3)]


def test_fold_two_and_reconcile(spark, as_rows):
    a = spark.createDataFrame([("x", 1, None), ("y", None, None)], "k string, u int, v int")
    b = spark.createDataFrame([("x", 2, 3), ("z", 5, None)], "k string, u int, v int")
    missing = F.col("u").isNull().cast("int") + F.col("v").isNull().cast("int")
    assert sorted(map(tuple, joins.fold_two(a, b, "k", missing, ["u", "v"]).collect()), key=repr) == [("x", 2, 3), ("y", None, None), ("z", 5, None)]
    assert {r["k"]: r["outcome"] for r in joins.reconcile(a, b, "k", "u").collect()} == {"x": "conflict", "y": "only_left", "z": "only_right"}


def test_checks(spark):
    import pytest

    df = spark.createDataFrame([("a", 1), ("a", -1), ("b", None)], "k string, v int")
    rules = {"negative": F.coalesce(F.col("v") < 0, F.lit(False)), "never": F.lit(False)}
    assert {r["rule"]: r["rows"] for r in violations(df, rules, ["k"]).collect()} == {"negative": 1, "key_repeated": 1}
    with pytest.raises(ValueError, match="negative: 1 rows"):
        require(df, rules, ["k"])
    assert shrink_guard(df, df.limit(1), 0.3).first()["refused"] and not shrink_guard(df, df, 0.3).first()["refused"]
