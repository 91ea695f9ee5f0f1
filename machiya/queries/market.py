"""Queries of aggregates, histories, merging, joins, sets, orders and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from machiya.functions import decisions, text
from machiya.operators import aggregates, components, history, joins, merging
from machiya.operators.quality import violations, shrink_guard
from machiya.operators.snapshots import latest_readings
from machiya.sources.documents import recent_quarters, retrieval_plan
from machiya.sources.tables import table

NOW = "2026-10-12 00:00:00"
READ = ["source", "sourceId", "address", "landAreaM2", "buildingAreaM2", "constructionYear", "layout", "priceYen", "status", "targetStationWalkMinutes", "priceMatched", "walkMatched", "firstSeenAt", "missedSearchRuns", "propertyType"]


def _now():
    return F.lit(NOW).cast("timestamp")


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per snapshot and listing: the reading with the latest lastSeenAt; NaN and 0 areas as null."""
    d = table(spark, folder, "discovered_listings")
    positive = {c: F.when((F.col(c) > 0) & ~F.isnan(c), F.col(c)) for c in ("landAreaM2", "buildingAreaM2")}
    d = d.withColumns({**positive, "status": F.lower(text.strip(F.col("status")))}).withColumn("seen", F.col("lastSeenAt"))
    return latest_readings(d, ["snapshotSeq", "propertyId"], "lastSeenAt", [*READ, "seen"]).withColumnRenamed("seen", "lastSeenAt")


def _snapshots(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the snapshots delivered so far, in order: one per delivery.  ``[0]`` without any."""
    rows = table(spark, folder, "discovered_listings").select("snapshotSeq").where("snapshotSeq is not null").distinct().collect()
    return sorted(r[0] for r in rows) or [0]


def _of(r: DataFrame, snapshot: int) -> DataFrame:
    return r.where(F.col("snapshotSeq") == snapshot)


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    """The readings of the latest snapshot."""
    return _of(_readings(spark, folder), _snapshots(spark, folder)[-1])


def transaction_metrics(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "transactions").where(F.trim("Type").isin("宅地(土地と建物)", "宅地（土地と建物）"))
    return aggregates.market_metrics(t.where("_cityName is not null"), "_cityName", text.lenient_number(F.col("TradePrice")), text.lenient_number(F.col("Area")))


def p20_p80(spark: SparkSession, folder: str) -> DataFrame:
    shares = {"p20": 0.2, "p80": 0.8}
    return aggregates.rank_percentiles(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"), shares)


def field_coverage(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings")
    present = {c: text.usable(F.col(c), text.EMPTY_AUDIT) for c in ("address", "fullAddress", "layout", "structure", "targetStation", "constructionMonth")}
    present |= {c: F.coalesce((F.col(c) > 0) & ~F.isnan(c), F.lit(False)) for c in ("landAreaM2", "buildingAreaM2")}
    return aggregates.field_coverage(d, present, ["snapshotSeq"])


def dup_key_groups(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.duplicate_keys(table(spark, folder, "documents"), F.md5("text"), "doc_id", "source")


def _verdicts(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder)
    flags = {
        "land": decisions.at_least(F.col("landAreaM2"), 100.0), "building": decisions.at_least(F.col("buildingAreaM2"), 80.0), "walk": decisions.at_most(F.col("targetStationWalkMinutes"), 20.0),
        "price": F.col("priceMatched"), "year": decisions.at_least(F.col("constructionYear"), None),
    }
    return r.select("propertyId", "landAreaM2", "targetStationWalkMinutes", decisions.verdict(flags).alias("v"))


def tri_state_criteria(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(spark, folder).select("propertyId", "v.status", F.concat_ws(",", "v.failed").alias("failed"), F.concat_ws(",", "v.unknown").alias("unknown"))


def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    v = _verdicts(spark, folder)
    return aggregates.counters(v, {"status": F.array("v.status"), "failed": F.col("v.failed"), "unknown": F.col("v.unknown")})


def decision_ladder(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder)
    walk, address = F.col("targetStationWalkMinutes"), F.col("address")
    steps = [
        (~text.usable(address, text.EMPTY_AUDIT), F.struct(F.lit("review").alias("decision"), F.lit("address_missing").alias("reason"))),
        (walk.isNull(), F.struct(F.lit("review").alias("decision"), F.lit("walk_unknown").alias("reason"))),
        (walk <= 20, F.struct(F.lit("accepted").alias("decision"), F.lit("within_walk").alias("reason"))),
    ]
    out = decisions.ladder(steps, F.struct(F.lit("rejected").alias("decision"), F.lit("too_far").alias("reason")))
    return r.groupBy(out["decision"].alias("decision"), out["reason"].alias("reason")).agg(F.count("*").alias("n"))


def flag_labels(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    names = decisions.labels({"new": F.col("firstSeenAt") >= _now() - F.expr("interval 30 days"), "unseen": F.col("lastSeenAt").isNull(), "missed": F.col("missedSearchRuns") >= 1, "ended": F.col("status").endswith("ended")})
    missing = decisions.missing_names({c: F.col(c) for c in ("landAreaM2", "buildingAreaM2", "constructionYear")})
    return r.select("snapshotSeq", "propertyId", F.concat_ws(",", names).alias("labels"), F.concat_ws(",", missing).alias("missing"), F.size(missing).alias("missingCount"))


def market_window(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    return aggregates.window_metrics(r, "source", "propertyId", "lastSeenAt", "priceYen", _now(), [20, 365])


def observation_changes(spark: SparkSession, folder: str) -> DataFrame:
    return history.changed_rows(_readings(spark, folder), "propertyId", ["snapshotSeq"], ["status", "priceYen"]).select("propertyId", "snapshotSeq", "status", "priceYen")


def price_history(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    return history.price_history(o, "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")


def bounded_history(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    return history.bounded_rows(e, "user_id", ["ts", "event_id"], 5)


def lifecycle_state(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings")
    # a run that finds fewer listings than runs do on average proves no absence
    found = d.groupBy("snapshotSeq").agg(F.count_distinct("propertyId").alias("n"))
    runs = found.crossJoin(F.broadcast(found.agg(F.avg("n").alias("usual")))).select("snapshotSeq", (F.col("n") >= F.col("usual")).alias("healthy"))
    p = history.presence(d, runs, "propertyId", "snapshotSeq", "healthy")
    return p.withColumn("state", history.presence_state(F.col("misses"), 2))


def lifecycle_summary(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    return r.groupBy("snapshotSeq").agg(F.count("*").alias("listings"), F.count_if(F.col("status") == "active").alias("active"), F.count_if(F.col("status").endswith("ended")).alias("ended"), F.count_if((F.col("lastSeenAt") >= _now() - F.expr("interval 30 days"))).alias("recent"))


def quarantine_stamps(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    holds = F.coalesce(F.col("targetStationWalkMinutes") > 20, F.lit(False))
    last = _snapshots(spark, folder)[-1]
    prior = r.where(F.col("snapshotSeq") < last).select("propertyId", F.when(holds, F.col("lastSeenAt")).alias("quarantinedAt"))
    current = _of(r, last).select("propertyId", "targetStationWalkMinutes", F.lit(None).cast("timestamp").alias("quarantinedAt"))
    return history.earliest_stamp(current, prior, "propertyId", holds, "quarantinedAt", _now()).select("propertyId", F.unix_micros("quarantinedAt").alias("quarantinedMicros"))


def quarantine_prune(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder)
    kept = table(spark, folder, "documents").where("property_id is not null").select(F.col("property_id").alias("propertyId")).distinct()
    rejected = F.coalesce((F.col("targetStationWalkMinutes") > 20) & (F.col("firstSeenAt") < _now() - F.expr("interval 90 days")), F.lit(False))
    protected = r.join(kept, "propertyId", "left_semi").select("propertyId")
    return r.where(~rejected).select("propertyId").union(protected).distinct()


def latest_merge(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    usable = {c: text.usable(F.col(c), text.EMPTY_DETAIL) for c in ("address", "layout")}
    policy = {"address": "latest", "layout": "latest", "landAreaM2": "latest", "priceYen": "newest", "firstSeenAt": "min", "status": "latest"}
    out = merging.merge_records(r, ["propertyId"], [F.col("snapshotSeq")], policy, usable)
    return out.withColumn("firstSeenAt", F.unix_micros("firstSeenAt"))


def representative(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").withColumn("digest", F.md5("text"))
    return merging.representatives(d, ["digest"], [F.col("source").isNotNull().cast("int"), -F.col("doc_id")], ["doc_id", "source", "n_chars"])


def marked_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("digest"))
    return merging.marked_duplicates(d, ["digest"], [F.col("doc_id")]).select("doc_id", "duplicateOfFirst")


def fingerprint_distinct(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type", F.floor("value").alias("level"))
    return merging.distinct_fingerprints(e, ["user_id", "event_type", "level"], ["event_id"])


def upsert_state(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder).select("propertyId", "snapshotSeq", "firstSeenAt", "lastSeenAt", "status", "priceYen")
    at = _snapshots(spark, folder)
    old, new = (_of(r, n).drop("snapshotSeq") for n in (at[max(0, len(at) - 2)], at[-1]))
    out = merging.latest_previous_union(old, new, "propertyId", "firstSeenAt", "lastSeenAt", "status", _now())
    return out.select("propertyId", F.unix_micros("firstSeenAt").alias("firstMicros"), F.unix_micros("lastSeenAt").alias("lastMicros"), "status", "priceYen")


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder).withColumn("market", text.market_address(F.col("address")))
    return joins.duplicate_pairs(r, "propertyId", F.col("market"), ["landAreaM2", "buildingAreaM2", "constructionYear", "layout", "propertyType"], text.digit_runs(F.col("market")) >= 2)


def blocked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of one exact address, of any size, and the pairs of small localities whose addresses contain each other."""
    return _pairs(spark, folder).select("a", "b", "same")


def pair_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of ``blocked_pairs``, whether the two contradict each other, and whether they are surely the same."""
    p = _pairs(spark, folder)
    x, y = (lambda c: F.col(f"va.{c}")), (lambda c: F.col(f"vb.{c}"))
    land, building = (joins.relative_difference(x(c), y(c)) for c in ("landAreaM2", "buildingAreaM2"))
    year = F.abs(x("constructionYear") - y("constructionYear"))
    plan = [text.layout_token(F.col(f"{s}.layout")) for s in ("va", "vb")]
    types = x("propertyType") == y("propertyType")
    points = [(F.col("same"), 45), (~F.col("same"), 30), (land <= 0.02, 20), ((land > 0.02) & (land <= 0.08), 10), (building <= 0.02, 20), ((building > 0.02) & (building <= 0.08), 10), (year <= 1, 10), (plan[0] == plan[1], 5), (types, 5)]
    sure = lambda c: F.coalesce(c, F.lit(False))
    conflict = sure(land > 0.15) | sure(building > 0.15) | sure(year > 2) | sure(~types)
    close = [F.abs(x(c) - y(c)) <= F.greatest(F.lit(2.0), F.greatest(x(c), y(c)) * 0.02) for c in ("landAreaM2", "buildingAreaM2")]
    alike = sure(close[0]) & sure(close[1]) & sure(year <= 1) & ~conflict & F.coalesce(plan[0] == plan[1], F.lit(True))
    return p.select("a", "b", joins.pair_score(points).alias("score"), conflict.alias("conflict"), (F.col("same") & alike).alias("autoSame"))


_CITY = "([^都道府県市区町村]{1,8}市)"


def _number(c: str) -> Column:
    """``lenient_number``; texts of digits alone, which most are, are read without its patterns.

    For the others it stands in a function of an array: the code of three of them is too long to be compiled at run time.
    """
    plain = F.when(F.col(c).rlike("^[0-9]{1,18}$"), F.col(c).cast("double"))
    return F.when(plain > 0, plain).otherwise(F.transform(F.array(c), text.lenient_number)[0])


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "transactions")
    return t.select(F.col("_cityName").alias("city"), _number("TradePrice").alias("price"), _number("Area").alias("land"), _number("TotalFloorArea").alias("building"), F.nullif(F.regexp_extract("BuildingYear", "((?:19|20)[0-9]{2})", 1), F.lit("")).cast("int").alias("year"), F.trim("DistrictName").alias("district"))


_ITEM = {"key": "propertyId", "land": "landAreaM2", "building": "buildingAreaM2", "year": "constructionYear"}
_SALE = {"land": "land", "building": "building", "year": "year"}


def comparables(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder).withColumn("city", F.nullif(F.regexp_extract("address", _CITY, 1), F.lit("")))
    return joins.comparables(r, _sales(spark, folder), "city", _ITEM, _SALE, "price", 0.65, 1.35, 20).withColumnRenamed("key", "propertyId").drop("level")


def valuation_comparables(spark: SparkSession, folder: str) -> DataFrame:
    """Comparable sales in wider bands, those of the listing's own district alone where there are three."""
    r = _latest(spark, folder).withColumn("city", F.nullif(F.regexp_extract("address", _CITY, 1), F.lit("")))
    r = r.withColumn("town", F.regexp_extract("address", _CITY + "([^0-9０-９]*)", 2))
    return joins.comparables(r, _sales(spark, folder), "city", _ITEM, _SALE, "price", 0.55, 1.8, 25, ("town", "district")).withColumnRenamed("key", "propertyId")


def unique_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    last = _latest(spark, folder).select("propertyId", "sourceId", F.col("propertyId").alias("value"))
    docs = table(spark, folder, "documents").select("doc_id", "property_id")
    tail = F.nullif(F.regexp_extract("property_id", ":(.*)$", 1), F.lit(""))
    return joins.unique_key_lookup(docs, last, "doc_id", [F.col("property_id"), tail], [F.col("propertyId"), F.col("sourceId")], "value")


def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    at = _snapshots(spark, folder)
    a, b = (_of(r, n).select("propertyId", "priceYen") for n in (at[0], at[-1]))
    return joins.reconcile(a, b, "propertyId", "priceYen")


def fold_two(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    columns = ["priceYen", "landAreaM2", "buildingAreaM2", "status"]
    missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    at = _snapshots(spark, folder)
    a, b = (_of(r, n).select("propertyId", *columns) for n in (at[max(0, len(at) - 2)], at[-1]))
    return joins.fold_two(a, b, "propertyId", missing, columns)


def dimension_attach(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "property_id")
    first = joins.first_by(_readings(spark, folder).select("propertyId", "snapshotSeq", "status", "source"), ["propertyId"], [F.col("snapshotSeq")])
    return docs.join(first, F.col("property_id") == F.col("propertyId"), "left").select("doc_id", "property_id", "status", F.col("source").alias("listedAt"), F.col("snapshotSeq").alias("firstSnapshot"))


def similar_listings(spark: SparkSession, folder: str) -> DataFrame:
    """For each listing the others of its city with a near price and, if known, near land, and their median price."""
    r = _latest(spark, folder).withColumn("city", F.nullif(F.regexp_extract("address", _CITY, 1), F.lit("")))
    return joins.similar_rows(r, "propertyId", "city", "priceYen", "landAreaM2", 0.35, 1e6, 0.35, 25.0)


def fetch_queue(spark: SparkSession, folder: str) -> DataFrame:
    r = _latest(spark, folder)
    missing = sum((F.col(c).isNull().cast("int") for c in ("landAreaM2", "buildingAreaM2", "constructionYear")), F.lit(0))
    priority = decisions.ladder([(missing >= 2, F.lit(0)), (missing == 1, F.lit(1)), (F.col("lastSeenAt").isNull(), F.lit(2))], F.lit(3))
    return r.select("propertyId", missing.alias("missing"), priority.alias("priority")).where("priority < 3").orderBy("priority", F.desc("missing"), "propertyId").limit(500)


def category_examples(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("source", "doc_id", "n_chars")
    return joins.examples(d.where("source is not null"), "source", [F.desc("n_chars"), F.col("doc_id")], 15)


def retention_cap(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", "ts", "user_id")
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(2000).orderBy("ts", "event_id")


def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "duplicate_review_candidates").where("similarityScore >= 0.8")
    linked = components.components(p, "propertyIdA", "propertyIdB")
    seen = table(spark, folder, "discovered_listings").groupBy("propertyId").agg(F.min("firstSeenAt").alias("first"))
    known = linked.join(seen, F.col("node") == F.col("propertyId"), "left")
    best = components.best_of_component(known, "root", [F.coalesce(F.unix_micros("first"), F.lit(2**62)), F.col("node")], "node")
    return best.select("root", F.col("best").alias("canonical"), F.col("size").alias("members"))


def set_operations(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder).select("snapshotSeq", "propertyId")
    at = _snapshots(spark, folder)
    one, five = (_of(r, n).select("propertyId") for n in (at[0], at[-1]))
    parts = {"union": one.union(five).distinct(), "both": one.join(five, "propertyId", "left_semi"), "gone": one.join(five, "propertyId", "left_anti"), "all": one.unionByName(five)}
    out = None
    for name, df in parts.items():
        part = df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("operation"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def props_unnest(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    parsed = F.from_json("props", StructType([StructField("k", LongType())]))
    return e.select("event_id", parsed["k"].alias("k"))


def component_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A mean of whichever components are known, their weights renormalized, and terms that score points in a text."""
    s = table(spark, folder, "source_properties").select("id", "building", "walk", "year", "layout").distinct()
    parts = [(decisions.clamp(F.nanvl(F.col("building"), F.lit(None).cast("double")) / 2, 0.0, 100.0), 0.5), (decisions.clamp(100 - F.col("walk") * 3.0, 0.0, 100.0), 0.3), (decisions.clamp((F.col("year") - 1980) * 2.0, 0.0, 100.0), 0.2)]
    return s.select("id", F.floor(decisions.weighted_mean(parts)).alias("score"), decisions.term_points(F.col("layout"), {"LDK": 3, "+S": 2}).alias("points"))


def explicit_end(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    phrases = ["続きは店頭で", "END OF NOTE", "以上"]
    return d.select("doc_id", F.concat_ws(",", F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(F.col("text"), p))).alias("phrases")).where("phrases <> ''")


def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings")
    rules = {
        "area_not_positive": F.coalesce((F.col("landAreaM2") <= 0) | (F.col("buildingAreaM2") <= 0), F.lit(False)),
        "id_missing": ~text.usable(F.col("propertyId")),
        "status_unknown": ~F.coalesce(F.col("status").isin("active", "possibly_ended", "observed_ended", "confirmed_ended"), F.lit(False)),
        "seen_before_first": F.coalesce(F.col("lastSeenAt") < F.col("firstSeenAt"), F.lit(False)),
    }
    return violations(d, rules, ["snapshotSeq", "propertyId"])


def drop_guard(spark: SparkSession, folder: str) -> DataFrame:
    r = _readings(spark, folder)
    at = _snapshots(spark, folder)
    return shrink_guard(_of(r, at[max(0, len(at) - 2)]), _of(r, at[-1]), 0.3)


def walk_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Listings by what they tell of the walk to the station: rows whose evidence is incomplete or contradictory."""
    d = table(spark, folder, "discovered_listings")
    minutes, flag, named = F.col("targetStationWalkMinutes"), F.col("targetStationWalkAvailable"), text.usable(F.col("targetStation"), text.EMPTY_AUDIT)
    plausible = F.coalesce(minutes.between(1, 120), F.lit(False))
    steps = [
        (minutes.isNotNull() & ~plausible, F.lit("implausible")), (plausible & F.coalesce(~flag, F.lit(False)), F.lit("contradicted")), (plausible & ~named, F.lit("no_station")),
        (plausible, F.lit("complete")), (F.coalesce(flag, F.lit(False)), F.lit("promised")), (named, F.lit("station_only")),
    ]
    return d.groupBy("snapshotSeq", decisions.ladder(steps, F.lit("none")).alias("category")).agg(F.count("*").alias("rows"))


def data_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """One row per source: rows, listings, span of sightings in days, share of rows without a sighting, repeated rows."""
    d = table(spark, folder, "discovered_listings")
    out = d.groupBy("source").agg(
        F.count("*").alias("rows"), F.count_distinct("propertyId").alias("listings"), F.count_distinct("snapshotSeq", "propertyId").alias("readings"), F.count_if(F.col("lastSeenAt").isNull()).alias("unseen"),
        F.floor((F.unix_micros(F.max("lastSeenAt")) - F.unix_micros(F.min("lastSeenAt"))) / F.lit(86_400_000_000)).alias("spanDays"),
    )
    return out.withColumn("repeatedRows", F.col("rows") - F.col("readings")).withColumn("unseenShare", F.col("unseen") / F.col("rows"))


def record_promotion(spark: SparkSession, folder: str) -> DataFrame:
    """Per listing: the first usable address of its aliases, and the distinct spellings of all, in order."""
    d = table(spark, folder, "discovered_listings")
    names = ["fullAddress", "address", "propertyAddress"]
    one = d.groupBy("propertyId").agg(*[F.max(c).alias(c) for c in names])
    spellings = F.array_distinct(F.array_compact(F.array(*[F.when(text.usable(F.col(c), text.EMPTY_DETAIL), text.strip(F.col(c))) for c in names])))
    return one.select("propertyId", text.first_usable([F.col(c) for c in names], text.EMPTY_DETAIL).alias("address"), F.concat_ws("|", spellings).alias("spellings"))


def quarter_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Which newest quarter each city still needs, against the quarters that are stored."""
    t = table(spark, folder, "transactions").where("_cityName is not null")
    stored = t.where("_period is not null").select(F.col("_cityName").alias("city"), F.col("_period").alias("period"))
    return retrieval_plan(t.select(F.col("_cityName").alias("city")), recent_quarters(spark, 2026, 4), stored)


_P = lambda c: f"CASE WHEN {c} > 0 AND NOT isnan({c}) THEN {c} END"
_STRIP = lambda c: f"regexp_replace({c}, '^[\\s　]+|[\\s　]+$', '', 'g')"
_N = lambda c: f"(SELECT CASE WHEN x > 0 THEN x END FROM (SELECT try_cast(nullif(regexp_extract(translate(replace({c}, ',', ''), '{text.WIDE_DIGITS}．', '{text.DIGITS}.'), '[0-9]+(?:\\.[0-9]+)?'), '') AS DOUBLE) AS x))"
_R = f"""r AS (SELECT snapshotSeq, propertyId, source, sourceId, address, {_P('landAreaM2')} AS land, {_P('buildingAreaM2')} AS bld, constructionYear AS yr, layout, priceYen, lower({_STRIP('status')}) AS st,
    targetStationWalkMinutes AS walk, priceMatched, walkMatched, firstSeenAt, lastSeenAt, missedSearchRuns, propertyType AS ptype FROM discovered_listings
    QUALIFY row_number() OVER (PARTITION BY snapshotSeq, propertyId ORDER BY lastSeenAt DESC NULLS LAST) = 1)"""
_MARKET = f"regexp_replace(trim(replace(regexp_replace(translate(coalesce(address, ''), '{text.WIDE_DIGITS}ヶ之　 ', '{text.DIGITS}ケの'), '丁目|番地|番', '-', 'g'), '号', '')), '[-ー―‐−]+', '-', 'g')"
_V = f"""v AS (SELECT propertyId, {{'land': land >= 100, 'building': bld >= 80, 'walk': walk <= 20, 'price': priceMatched, 'year': true}} AS f FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)),
    w AS (SELECT propertyId, list_filter([CASE WHEN NOT f.land THEN 'land' END, CASE WHEN NOT f.building THEN 'building' END, CASE WHEN NOT f.walk THEN 'walk' END, CASE WHEN NOT f.price THEN 'price' END], lambda x: x IS NOT NULL) AS failed,
        list_filter([CASE WHEN f.land IS NULL THEN 'land' END, CASE WHEN f.building IS NULL THEN 'building' END, CASE WHEN f.walk IS NULL THEN 'walk' END, CASE WHEN f.price IS NULL THEN 'price' END], lambda x: x IS NOT NULL) AS unknown FROM v),
    z AS (SELECT *, CASE WHEN len(failed) > 0 THEN 'excluded' WHEN len(unknown) > 0 THEN 'pending' ELSE 'matched' END AS status FROM w)"""
_COVER = " UNION ALL ".join(
    [f"SELECT snapshotSeq, '{c}' AS field, coalesce({_STRIP(c)} NOT IN ('', '-', '－', '不明', '未定', 'なし', 'N/A'), false) AS ok FROM discovered_listings" for c in ("address", "fullAddress", "layout", "structure", "targetStation", "constructionMonth")]
    + [f"SELECT snapshotSeq, '{c}', coalesce({c} > 0 AND NOT isnan({c}), false) FROM discovered_listings" for c in ("landAreaM2", "buildingAreaM2")]
)
_PAIR = f"""m AS (SELECT *, {_MARKET} AS mk FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)), q AS (SELECT *, len(regexp_extract_all(mk, '[0-9]+')) >= 2 AS dr, regexp_replace(mk, '[0-9-]', '', 'g') AS loc FROM m WHERE mk IS NOT NULL), k AS (SELECT *, count(*) OVER (PARTITION BY loc) AS sz FROM q),
    id AS (SELECT x.propertyId AS a, y.propertyId AS b FROM k x JOIN k y ON x.mk = y.mk AND x.propertyId < y.propertyId WHERE x.dr
        UNION SELECT x.propertyId, y.propertyId FROM k x JOIN k y ON x.loc = y.loc AND x.propertyId < y.propertyId WHERE x.sz BETWEEN 2 AND 12 AND len(x.loc) >= 6 AND (contains(x.mk, y.mk) OR contains(y.mk, x.mk)) AND (x.dr OR y.dr)),
    pr AS (SELECT id.a, id.b, x.mk = y.mk AS same, x.land l1, y.land l2, x.bld b1, y.bld b2, x.yr y1, y.yr y2, x.layout p1, y.layout p2, x.ptype t1, y.ptype t2 FROM id JOIN k x ON x.propertyId = id.a JOIN k y ON y.propertyId = id.b)"""
_TOK = lambda c: "(SELECT trim(regexp_replace(coalesce(" + ", ".join(f"nullif(regexp_extract(up, '[0-9]+\\s*{k}(?:\\s*\\+\\s*(?:[0-9]+\\s*)?S)?'), '')" for k in ("LDK", "DK", "LK", "K")) + f"), '[\\s　]+', ' ', 'g')) FROM (SELECT upper(translate(translate({c}, '{text.WIDE_DIGITS}{text.WIDE_LETTERS}', '{text.DIGITS}{text.LETTERS}'), '＋', '+')) AS up))"

QUERIES = {
    f.__name__: f
    for f in (
        transaction_metrics, p20_p80, field_coverage, dup_key_groups, tri_state_criteria, run_counters, decision_ladder, flag_labels, market_window, observation_changes, price_history, bounded_history,
        lifecycle_state, lifecycle_summary, quarantine_stamps, quarantine_prune, latest_merge, representative, marked_duplicates, fingerprint_distinct, upsert_state, blocked_pairs, pair_scores, comparables, valuation_comparables,
        unique_key_lookup, reconcile, fold_two, dimension_attach, similar_listings, fetch_queue, category_examples, retention_cap, duplicate_groups, set_operations, props_unnest, component_scores,
        explicit_end, constraint_violations, drop_guard, walk_audit, data_quality_report, record_promotion, quarter_plan,
    )
}

SQL = {
    "transaction_metrics": f"""WITH t AS (SELECT _cityName, {_N('TradePrice')} AS p, {_N('Area')} AS s FROM transactions WHERE trim("Type") IN ('宅地(土地と建物)', '宅地（土地と建物）') AND _cityName IS NOT NULL)
        SELECT _cityName, count(*) AS transactionCount, median(p) AS medianPrice, median(p / s) AS medianUnitPrice, CASE WHEN count(*) >= 10 THEN 'medium' WHEN count(*) < 3 THEN 'low' ELSE 'limited' END AS confidence
        FROM t WHERE p > 0 GROUP BY _cityName""",
    "p20_p80": """SELECT l_returnflag, l_linestatus, v[1 + floor((len(v) - 1) * 0.2)::INT] AS p20, v[1 + floor((len(v) - 1) * 0.8)::INT] AS p80
        FROM (SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice)) AS v FROM lineitem GROUP BY ALL)""",
    "field_coverage": f"SELECT snapshotSeq, field, count(*) FILTER (ok) AS present, count(*) FILTER (NOT ok) AS missing, count(*) FILTER (ok) / count(*) AS ratio FROM ({_COVER}) GROUP BY ALL",
    "dup_key_groups": """WITH c AS (SELECT md5(text) AS key, coalesce(source, 'null') AS s, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL),
        i AS (SELECT md5(text) AS key, count(DISTINCT doc_id) AS ids FROM documents GROUP BY ALL)
        SELECT key, sum(n)::BIGINT AS rows, any_value(ids) AS ids, array_to_string(list_sort(list(s || '=' || n)), ',') AS states FROM c JOIN i USING (key) GROUP BY key HAVING sum(n) > 1""",
    "tri_state_criteria": f"WITH {_R}, {_V} SELECT propertyId, status, array_to_string(failed, ',') AS failed, array_to_string(unknown, ',') AS unknown FROM z",
    "run_counters": f"WITH {_R}, {_V} SELECT counter, name, count(*) AS n FROM (SELECT 'status' AS counter, status AS name FROM z UNION ALL SELECT 'failed', unnest(failed) FROM z UNION ALL SELECT 'unknown', unnest(unknown) FROM z) GROUP BY ALL",
    "decision_ladder": f"""WITH {_R} SELECT decision, reason, count(*) AS n FROM (SELECT CASE WHEN NOT coalesce({_STRIP('address')} NOT IN ('', '-', '－', '不明', '未定', 'なし', 'N/A'), false) OR walk IS NULL THEN 'review' WHEN walk <= 20 THEN 'accepted' ELSE 'rejected' END AS decision,
        CASE WHEN NOT coalesce({_STRIP('address')} NOT IN ('', '-', '－', '不明', '未定', 'なし', 'N/A'), false) THEN 'address_missing' WHEN walk IS NULL THEN 'walk_unknown' WHEN walk <= 20 THEN 'within_walk' ELSE 'too_far' END AS reason FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)) GROUP BY ALL""",
    "flag_labels": f"""WITH {_R} SELECT snapshotSeq, propertyId, concat_ws(',', CASE WHEN firstSeenAt >= TIMESTAMPTZ '{NOW}+00' - INTERVAL 30 DAY THEN 'new' END, CASE WHEN lastSeenAt IS NULL THEN 'unseen' END, CASE WHEN missedSearchRuns >= 1 THEN 'missed' END, CASE WHEN st LIKE '%ended' THEN 'ended' END) AS labels,
        concat_ws(',', CASE WHEN land IS NULL THEN 'landAreaM2' END, CASE WHEN bld IS NULL THEN 'buildingAreaM2' END, CASE WHEN yr IS NULL THEN 'constructionYear' END) AS missing,
        (land IS NULL)::INT + (bld IS NULL)::INT + (yr IS NULL)::INT AS missingCount FROM r""",
    "market_window": f"""WITH {_R}, i AS (SELECT source AS area, days, propertyId, lastSeenAt AS t, priceYen AS p FROM r, (VALUES (20), (365)) d(days) WHERE lastSeenAt <= TIMESTAMPTZ '{NOW}+00' AND epoch_us(lastSeenAt) >= epoch_us(TIMESTAMPTZ '{NOW}+00') - days * 86400000000),
        e AS (SELECT area, days, propertyId, count(*) AS events, count(*) FILTER (p > 0) AS points, arg_min(p, (t, p)) FILTER (p > 0) AS f, arg_max(p, (t, p)) FILTER (p > 0) AS l, min(t) AS t0, max(t) AS t1 FROM i GROUP BY ALL),
        g AS (SELECT area, days, count(*) AS entities, sum(events)::BIGINT AS events, median(f) AS startMedian, median(l) AS endMedian, median(f) FILTER (points >= 2) AS fa, median(l) FILTER (points >= 2) AS fb, count(*) FILTER (points >= 2 AND l < f) AS reduced,
            floor((epoch_us(max(t1)) - epoch_us(min(t0))) / 86400000000)::BIGINT AS spanDays FROM e GROUP BY ALL)
        SELECT area, days, entities, events, startMedian, endMedian, reduced, spanDays, (fb - fa) / fa * 100 AS changePct, least(100.0, spanDays / days * 100) AS coveragePct FROM g""",
    "observation_changes": f"WITH {_R}, l AS (SELECT propertyId, snapshotSeq, st, priceYen, lag(st) OVER w AS ps, lag(priceYen) OVER w AS pp, row_number() OVER w AS n FROM r WINDOW w AS (PARTITION BY propertyId ORDER BY snapshotSeq)) SELECT propertyId, snapshotSeq, st AS status, priceYen FROM l WHERE n = 1 OR st IS DISTINCT FROM ps OR priceYen IS DISTINCT FROM pp",
    "price_history": """WITH c AS (SELECT *, lag(o_totalprice) OVER w AS b, row_number() OVER w AS n FROM orders WHERE o_totalprice > 0 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
        p AS (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice AS price FROM c WHERE n = 1 OR o_totalprice <> b),
        f AS (SELECT *, first_value(price) OVER w AS fp, CASE WHEN price < lag(price) OVER w THEN 1 ELSE 0 END AS fell FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
        SELECT o_custkey, o_orderdate, o_orderkey, price, fp AS firstPrice, greatest(fp - price, 0) AS totalReduction, greatest((fp - price) / fp, 0) AS reductionRate, (sum(fell) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))::BIGINT AS reductions FROM f""",
    "bounded_history": "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 OR row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 4",
    "lifecycle_state": """WITH s AS (SELECT DISTINCT propertyId, snapshotSeq AS n FROM discovered_listings), u AS (SELECT n, count(*) AS c FROM s GROUP BY n), h AS (SELECT n, sum((c >= (SELECT avg(c) FROM u))::INT) OVER (ORDER BY n) AS hh, (c >= (SELECT avg(c) FROM u))::INT AS ok FROM u),
        g AS (SELECT propertyId, n, hh, hh - ok - lag(hh) OVER (PARTITION BY propertyId ORDER BY n) AS gap FROM s JOIN h USING (n)),
        o AS (SELECT propertyId, min(n) AS firstRun, max(n) AS lastRun, ((SELECT max(hh) FROM h) - max(hh))::BIGINT AS misses, count(*) FILTER (gap > 0) AS relisted FROM g GROUP BY propertyId)
        SELECT *, CASE WHEN misses = 0 THEN 'active' WHEN misses < 2 THEN 'possibly_ended' ELSE 'observed_ended' END AS state FROM o""",
    "lifecycle_summary": f"WITH {_R} SELECT snapshotSeq, count(*) AS listings, count(*) FILTER (st = 'active') AS active, count(*) FILTER (st LIKE '%ended') AS ended, count(*) FILTER (lastSeenAt >= TIMESTAMPTZ '{NOW}+00' - INTERVAL 30 DAY) AS recent FROM r GROUP BY ALL",
    "quarantine_stamps": f"""WITH {_R}, o AS (SELECT propertyId, min(lastSeenAt) FILTER (walk > 20) AS m FROM r WHERE snapshotSeq < (SELECT max(snapshotSeq) FROM discovered_listings) GROUP BY ALL)
        SELECT r.propertyId, CASE WHEN walk > 20 THEN epoch_us(coalesce(m, TIMESTAMPTZ '{NOW}+00')) END AS quarantinedMicros FROM r LEFT JOIN o USING (propertyId) WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)""",
    "quarantine_prune": f"""WITH {_R} SELECT propertyId FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings) AND (NOT coalesce(walk > 20 AND firstSeenAt < TIMESTAMPTZ '{NOW}+00' - INTERVAL 90 DAY, false) OR propertyId IN (SELECT property_id FROM documents WHERE property_id IS NOT NULL))""",
    "latest_merge": f"""WITH {_R}, u AS (SELECT *, {_STRIP('address')} NOT IN ('', '-', '－', '不明', '未定') AS oka, {_STRIP('layout')} NOT IN ('', '-', '－', '不明', '未定') AS okl FROM r)
        SELECT propertyId, arg_max(address, snapshotSeq) FILTER (oka) AS address, arg_max(layout, snapshotSeq) FILTER (okl) AS layout, arg_max(land, snapshotSeq) FILTER (land IS NOT NULL) AS landAreaM2,
        max({{'s': snapshotSeq, 'p': priceYen}}).p AS priceYen, epoch_us(min(firstSeenAt)) AS firstSeenAt, arg_max(st, snapshotSeq) FILTER (st IS NOT NULL) AS status FROM u GROUP BY propertyId""",
    "representative": "SELECT digest, doc_id, source, n_chars, members FROM (SELECT md5(text) AS digest, doc_id, source, n_chars, count(*) OVER (PARTITION BY md5(text)) AS members, row_number() OVER (PARTITION BY md5(text) ORDER BY (source IS NOT NULL) DESC, doc_id) AS n FROM documents) WHERE n = 1",
    "marked_duplicates": "SELECT doc_id, text IS NOT NULL AND row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 AS duplicateOfFirst FROM documents",
    "fingerprint_distinct": "SELECT min(event_id) AS event_id, user_id, event_type, floor(value)::BIGINT AS level FROM events GROUP BY user_id, event_type, floor(value)::BIGINT",
    "upsert_state": f"""WITH {_R}, o AS (SELECT * FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings WHERE snapshotSeq < (SELECT max(snapshotSeq) FROM discovered_listings))), c AS (SELECT * FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings))
        SELECT coalesce(c.propertyId, o.propertyId) AS propertyId, epoch_us(coalesce(o.firstSeenAt, c.firstSeenAt, TIMESTAMPTZ '{NOW}+00')) AS firstMicros,
        epoch_us(CASE WHEN c.propertyId IS NOT NULL THEN coalesce(c.lastSeenAt, TIMESTAMPTZ '{NOW}+00') ELSE o.lastSeenAt END) AS lastMicros, CASE WHEN c.propertyId IS NOT NULL THEN c.st ELSE 'missing' END AS status, coalesce(c.priceYen, o.priceYen) AS priceYen
        FROM c FULL JOIN o ON c.propertyId = o.propertyId""",
    "blocked_pairs": f"WITH {_R}, {_PAIR} SELECT a, b, same FROM pr",
    "pair_scores": f"""WITH {_R}, {_PAIR}, d AS (SELECT *, CASE WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN abs(l1 - l2) / greatest(l1, l2) END AS dl, CASE WHEN b1 IS NOT NULL AND b2 IS NOT NULL THEN abs(b1 - b2) / greatest(b1, b2) END AS db,
            abs(y1 - y2) AS dy, {_TOK('p1')} AS u1, {_TOK('p2')} AS u2 FROM pr),
        e AS (SELECT *, coalesce(dl > 0.15, false) OR coalesce(db > 0.15, false) OR coalesce(dy > 2, false) OR coalesce(t1 <> t2, false) AS conflict FROM d)
        SELECT a, b, CASE WHEN same THEN 45 ELSE 30 END + CASE WHEN dl <= 0.02 THEN 20 WHEN dl <= 0.08 THEN 10 ELSE 0 END + CASE WHEN db <= 0.02 THEN 20 WHEN db <= 0.08 THEN 10 ELSE 0 END
            + CASE WHEN dy <= 1 THEN 10 ELSE 0 END + CASE WHEN u1 = u2 THEN 5 ELSE 0 END + CASE WHEN t1 = t2 THEN 5 ELSE 0 END AS score, conflict,
            same AND NOT conflict AND coalesce(abs(l1 - l2) <= greatest(2.0, 0.02::DOUBLE * greatest(l1, l2)), false) AND coalesce(abs(b1 - b2) <= greatest(2.0, 0.02::DOUBLE * greatest(b1, b2)), false) AND coalesce(dy <= 1, false) AND coalesce(u1 = u2, true) AS autoSame FROM e""",
    "comparables": f"""WITH {_R}, i AS (SELECT propertyId, nullif(regexp_extract(address, '([^都道府県市区町村]{{1,8}}市)', 1), '') AS city, land, bld, yr FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)),
        t AS (SELECT _cityName AS city, {_N('TradePrice')} AS p, {_N('Area')} AS l, {_N('TotalFloorArea')} AS b, try_cast(nullif(regexp_extract(BuildingYear, '((?:19|20)[0-9]{{2}})', 1), '') AS INT) AS y FROM transactions)
        SELECT propertyId, count(p) AS comparables, median(p) AS medianPrice FROM i LEFT JOIN t ON i.city = t.city AND p > 0 AND coalesce(l BETWEEN land * (1 - 0.35::DOUBLE) AND land * (1 + 0.35::DOUBLE), true) AND coalesce(b BETWEEN bld * (1 - 0.35::DOUBLE) AND bld * (1 + 0.35::DOUBLE), true) AND coalesce(abs(yr - y) <= 20, true)
        GROUP BY propertyId""",
    "valuation_comparables": f"""WITH {_R}, i AS (SELECT propertyId, nullif(regexp_extract(address, '([^都道府県市区町村]{{1,8}}市)', 1), '') AS city, regexp_extract(address, '([^都道府県市区町村]{{1,8}}市)([^0-9０-９]*)', 2) AS town, land, bld, yr FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)),
        t AS (SELECT _cityName AS city, trim(DistrictName) AS district, {_N('TradePrice')} AS p, {_N('Area')} AS l, {_N('TotalFloorArea')} AS b, try_cast(nullif(regexp_extract(BuildingYear, '((?:19|20)[0-9]{{2}})', 1), '') AS INT) AS y FROM transactions),
        c AS (SELECT propertyId, p, coalesce(contains(town, district) AND district <> '', false) AS own FROM i LEFT JOIN t ON i.city = t.city AND p > 0 AND coalesce(l BETWEEN land * 0.55::DOUBLE AND land * 1.8::DOUBLE, true) AND coalesce(b BETWEEN bld * 0.55::DOUBLE AND bld * 1.8::DOUBLE, true) AND coalesce(abs(yr - y) <= 25, true)),
        n AS (SELECT propertyId, count(p) AS every, median(p) AS every_median, count(p) FILTER (own) AS near, median(p) FILTER (own) AS near_median FROM c GROUP BY propertyId)
        SELECT propertyId, CASE WHEN near >= 3 THEN near ELSE every END AS comparables, CASE WHEN near >= 3 THEN near_median ELSE every_median END AS medianPrice, CASE WHEN near >= 3 THEN 'district' ELSE 'area' END AS level FROM n""",
    "unique_key_lookup": f"""WITH {_R}, l AS (SELECT propertyId, sourceId FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)), u AS (SELECT sourceId FROM l GROUP BY sourceId HAVING count(*) = 1)
        SELECT doc_id, coalesce(a.propertyId, b.propertyId) AS value, CASE WHEN a.propertyId IS NOT NULL THEN 0 WHEN b.propertyId IS NOT NULL THEN 1 END AS rank
        FROM documents d LEFT JOIN l a ON a.propertyId = d.property_id LEFT JOIN (SELECT l.* FROM l JOIN u USING (sourceId)) b ON b.sourceId = nullif(regexp_extract(d.property_id, ':(.*)$', 1), '')""",
    "reconcile": f"""WITH {_R}, a AS (SELECT propertyId, priceYen FROM r WHERE snapshotSeq = (SELECT min(snapshotSeq) FROM discovered_listings)), b AS (SELECT propertyId, priceYen FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings))
        SELECT coalesce(a.propertyId, b.propertyId) AS propertyId, a.priceYen AS leftValue, b.priceYen AS rightValue, CASE WHEN a.propertyId IS NULL THEN 'only_right' WHEN b.propertyId IS NULL THEN 'only_left'
        WHEN a.priceYen IS NULL AND b.priceYen IS NULL THEN 'both_missing' WHEN a.priceYen IS NULL THEN 'left_missing' WHEN b.priceYen IS NULL THEN 'right_missing' WHEN a.priceYen = b.priceYen THEN 'agree' ELSE 'conflict' END AS outcome
        FROM a FULL JOIN b ON a.propertyId = b.propertyId""",
    "fold_two": f"""WITH {_R}, x AS (SELECT propertyId, priceYen, land, bld, st, snapshotSeq, (priceYen IS NULL)::INT + (land IS NULL)::INT + (bld IS NULL)::INT + (st IS NULL)::INT AS m FROM r)
        SELECT coalesce(a.propertyId, b.propertyId) AS propertyId, CASE WHEN f THEN coalesce(b.priceYen, a.priceYen) ELSE coalesce(a.priceYen, b.priceYen) END AS priceYen, CASE WHEN f THEN coalesce(b.land, a.land) ELSE coalesce(a.land, b.land) END AS landAreaM2,
        CASE WHEN f THEN coalesce(b.bld, a.bld) ELSE coalesce(a.bld, b.bld) END AS buildingAreaM2, CASE WHEN f THEN coalesce(b.st, a.st) ELSE coalesce(a.st, b.st) END AS status
        FROM (SELECT a, b, a.m IS NULL OR coalesce(b.m < a.m, false) AS f FROM (SELECT * FROM x WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings WHERE snapshotSeq < (SELECT max(snapshotSeq) FROM discovered_listings))) a FULL JOIN (SELECT * FROM x WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)) b ON a.propertyId = b.propertyId)""",
    "dimension_attach": f"WITH {_R}, f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY propertyId ORDER BY snapshotSeq) = 1) SELECT doc_id, property_id, f.st AS status, f.source AS listedAt, f.snapshotSeq AS firstSnapshot FROM documents d LEFT JOIN f ON d.property_id = f.propertyId",
    "similar_listings": f"""WITH {_R}, i AS (SELECT propertyId, nullif(regexp_extract(address, '([^都道府県市区町村]{{1,8}}市)', 1), '') AS city, CASE WHEN priceYen > 0 THEN priceYen::DOUBLE END AS p, land AS l FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings))
        SELECT x.propertyId, count(y.p) AS similar, median(y.p) AS medianPrice FROM i x LEFT JOIN i y ON x.city = y.city AND x.propertyId <> y.propertyId AND abs(y.p - x.p) <= greatest(x.p * 0.35::DOUBLE, 1000000) AND coalesce(abs(y.l - x.l) <= greatest(25, x.l * 0.35::DOUBLE), true)
        GROUP BY x.propertyId""",
    "fetch_queue": f"""WITH {_R}, m AS (SELECT propertyId, (land IS NULL)::INT + (bld IS NULL)::INT + (yr IS NULL)::INT AS missing, lastSeenAt FROM r WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)), p AS (SELECT propertyId, missing, CASE WHEN missing >= 2 THEN 0 WHEN missing = 1 THEN 1 WHEN lastSeenAt IS NULL THEN 2 ELSE 3 END AS priority FROM m)
        SELECT * FROM p WHERE priority < 3 ORDER BY priority, missing DESC, propertyId LIMIT 500""",
    "category_examples": "SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id)::INT AS position FROM documents WHERE source IS NOT NULL QUALIFY position <= 15",
    "retention_cap": "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000",
    "duplicate_groups": """WITH RECURSIVE e AS (SELECT propertyIdA a, propertyIdB b FROM duplicate_review_candidates WHERE similarityScore >= 0.8 AND propertyIdA <> propertyIdB UNION SELECT propertyIdB, propertyIdA FROM duplicate_review_candidates WHERE similarityScore >= 0.8 AND propertyIdA <> propertyIdB),
        t AS (SELECT a AS node, b AS o FROM e UNION SELECT t.node, e.b FROM t JOIN e ON t.o = e.a), c AS (SELECT node, min(o) AS root FROM (SELECT node, o FROM t UNION SELECT node, node FROM t) GROUP BY node),
        s AS (SELECT propertyId, min(firstSeenAt) AS f FROM discovered_listings GROUP BY ALL)
        SELECT root, arg_min(node, (coalesce(epoch_us(f), 4611686018427387904), node)) AS canonical, count(*) AS members FROM c LEFT JOIN s ON s.propertyId = c.node GROUP BY root""",
    "set_operations": """WITH a AS (SELECT DISTINCT propertyId FROM discovered_listings WHERE snapshotSeq = (SELECT min(snapshotSeq) FROM discovered_listings)), b AS (SELECT DISTINCT propertyId FROM discovered_listings WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings))
        SELECT 'union' AS operation, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
        UNION ALL SELECT 'gone', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'all', count(*) FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
    "props_unnest": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
    "component_scores": """WITH s AS (SELECT DISTINCT id, CASE WHEN NOT isnan(building) THEN building END AS b, walk, year, layout FROM source_properties),
        c AS (SELECT id, layout, CASE WHEN b IS NOT NULL THEN greatest(least(b / 2, 100), 0) END AS x, CASE WHEN walk IS NOT NULL THEN greatest(least(100 - walk * 3.0::DOUBLE, 100), 0) END AS y, CASE WHEN year IS NOT NULL THEN greatest(least((year - 1980) * 2.0::DOUBLE, 100), 0) END AS z FROM s)
        SELECT id, floor((coalesce(x * 0.5::DOUBLE, 0) + coalesce(y * 0.3::DOUBLE, 0) + coalesce(z * 0.2::DOUBLE, 0)) / nullif(CASE WHEN x IS NOT NULL THEN 0.5::DOUBLE ELSE 0 END + CASE WHEN y IS NOT NULL THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN z IS NOT NULL THEN 0.2::DOUBLE ELSE 0 END, 0))::BIGINT AS score,
        CASE WHEN contains(layout, 'LDK') THEN 3.0::DOUBLE ELSE 0 END + CASE WHEN contains(layout, '+S') THEN 2.0::DOUBLE ELSE 0 END AS points FROM c""",
    "explicit_end": "SELECT doc_id, phrases FROM (SELECT doc_id, concat_ws(',', CASE WHEN contains(text, '続きは店頭で') THEN '続きは店頭で' END, CASE WHEN contains(text, 'END OF NOTE') THEN 'END OF NOTE' END, CASE WHEN contains(text, '以上') THEN '以上' END) AS phrases FROM documents) WHERE phrases <> ''",
    "constraint_violations": f"""WITH v AS (
        SELECT 'area_not_positive' AS rule, coalesce((landAreaM2 <= 0) OR (buildingAreaM2 <= 0), false) AS bad FROM discovered_listings
        UNION ALL SELECT 'id_missing', NOT coalesce({_STRIP('propertyId')} NOT IN ('', '-'), false) FROM discovered_listings
        UNION ALL SELECT 'status_unknown', NOT coalesce(status IN ('active', 'possibly_ended', 'observed_ended', 'confirmed_ended'), false) FROM discovered_listings
        UNION ALL SELECT 'seen_before_first', coalesce(lastSeenAt < firstSeenAt, false) FROM discovered_listings
        UNION ALL SELECT 'key_repeated', unnest(range(n - 1)) >= 0 FROM (SELECT count(*) AS n FROM discovered_listings GROUP BY snapshotSeq, propertyId HAVING count(*) > 1))
        SELECT rule, count(*) AS rows FROM v WHERE bad GROUP BY rule""",
    "drop_guard": f"WITH {_R} SELECT count(*) FILTER (snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings WHERE snapshotSeq < (SELECT max(snapshotSeq) FROM discovered_listings))) AS before, count(*) FILTER (snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)) AS after, count(*) FILTER (snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)) < 0.7 * count(*) FILTER (snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings WHERE snapshotSeq < (SELECT max(snapshotSeq) FROM discovered_listings))) AS refused FROM r",
    "walk_audit": f"""SELECT snapshotSeq, CASE WHEN m IS NOT NULL AND NOT ok THEN 'implausible' WHEN ok AND NOT f THEN 'contradicted' WHEN ok AND NOT named THEN 'no_station' WHEN ok THEN 'complete' WHEN f THEN 'promised' WHEN named THEN 'station_only' ELSE 'none' END AS category, count(*) AS rows
        FROM (SELECT snapshotSeq, targetStationWalkMinutes AS m, coalesce(targetStationWalkMinutes BETWEEN 1 AND 120, false) AS ok, targetStationWalkAvailable AS f, coalesce({_STRIP('targetStation')} NOT IN ('', '-', '－', '不明', '未定', 'なし', 'N/A'), false) AS named FROM discovered_listings) GROUP BY ALL""",
    "data_quality_report": """SELECT *, rows - readings AS repeatedRows, unseen / rows AS unseenShare FROM (SELECT source, count(*) AS rows, count(DISTINCT propertyId) AS listings, count(DISTINCT (snapshotSeq, propertyId)) AS readings,
        count(*) FILTER (lastSeenAt IS NULL) AS unseen, floor((epoch_us(max(lastSeenAt)) - epoch_us(min(lastSeenAt))) / 86400000000)::BIGINT AS spanDays FROM discovered_listings GROUP BY source)""",
    "record_promotion": f"""WITH o AS (SELECT propertyId, max(fullAddress) AS f, max(address) AS a, max(propertyAddress) AS p FROM discovered_listings GROUP BY propertyId),
        u AS (SELECT propertyId, CASE WHEN {_STRIP('f')} NOT IN ('', '-', '－', '不明', '未定') THEN {_STRIP('f')} END AS f, CASE WHEN {_STRIP('a')} NOT IN ('', '-', '－', '不明', '未定') THEN {_STRIP('a')} END AS a, CASE WHEN {_STRIP('p')} NOT IN ('', '-', '－', '不明', '未定') THEN {_STRIP('p')} END AS p FROM o)
        SELECT propertyId, coalesce(f, a, p) AS address, concat_ws('|', f, CASE WHEN a IS DISTINCT FROM f THEN a END, CASE WHEN p IS DISTINCT FROM f AND p IS DISTINCT FROM a THEN p END) AS spellings FROM u""",
    "quarter_plan": "SELECT _cityName AS city, '2026Q3' AS period, CASE WHEN bool_or(coalesce(_period = '2026Q3', false)) THEN 'already_stored' ELSE 'to_fetch' END AS status FROM transactions WHERE _cityName IS NOT NULL GROUP BY _cityName",
}
