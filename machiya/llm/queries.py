"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machiya.functions.quantities import AREA_M2, TRADE_YEN
from machiya.llm.addresses import gazetteer, located_addresses, located_records, parsed_addresses, same_house_number
from machiya.llm.components import linking_rows, listing_groups
from machiya.llm.leakage import leaked_passages
from machiya.llm.matching import BELIEF, agreement, candidates, house_clusters, house_values, joined_houses, learned_weights, match_probabilities, rescored
from machiya.llm.mixing import mix, short_sources
from machiya.llm.percentiles import merge_counts, percentiles, value_counts
from machiya.llm.survivors import completeness, current_values, surviving_fields, value_levels, value_precedence, with_levels
from machiya.llm.truncation import field_lengths, length_limits, truncated_texts
from machiya.operators.quantities import quantity
from machiya.plans.durable import write_table
from machiya.sources.tables import table

SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return listing_groups(table(spark, folder, "duplicate_review_candidates"))


SURVIVOR_FIELDS = ["address", "landAreaM2", "buildingAreaM2", "constructionYear", "layout", "priceYen"]


#: Fields whose values follow one another over the snapshots.
CHANGING = ["status", "missedSearchRuns"]


def _clean_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.lower(F.regexp_replace("status", r"^[\s　]+|[\s　]+$", "")))


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """Group members that are in the listings, with the reading of the latest snapshot that has them."""
    pairs = table(spark, folder, "duplicate_review_candidates")
    groups = listing_groups(pairs)
    reading = F.max(F.struct("snapshotSeq", F.col("lastSeenAt").isNotNull().alias("seen"), "lastSeenAt", *SURVIVOR_FIELDS, *CHANGING)).alias("r")
    last = table(spark, folder, "discovered_listings").where("propertyId is not null").groupBy("propertyId").agg(reading).select("propertyId", "r.*")
    return _clean_status(groups.join(last, "propertyId").join(completeness(linking_rows(pairs)), "propertyId", "left"))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return _clean_status(table(spark, folder, "discovered_listings").select("propertyId", "lastSeenAt", *CHANGING))


def _survivors(spark: SparkSession, folder: str) -> DataFrame:
    levels = value_levels(_history(spark, folder), "propertyId", CHANGING, "lastSeenAt")
    members = with_levels(_members(spark, folder), CHANGING, levels)
    return surviving_fields(members, "groupId", "propertyId", SURVIVOR_FIELDS, "completeness", "lastSeenAt", [f"{c}_level" for c in CHANGING])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _survivors(spark, folder).select("groupId", "fieldName", F.col("stated").alias("propertyId"))


def p4_current_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The suppliers of each field where learned precedence, not the smallest id, orders members without a time."""
    return _survivors(spark, folder).select("groupId", "fieldName", F.col("current").alias("propertyId"), "basis")


def p4_precedence(spark: SparkSession, folder: str) -> DataFrame:
    """Which statuses and missed runs follow which, with the transitions both ways, and what was concluded."""
    return value_precedence(_history(spark, folder), "propertyId", CHANGING, "lastSeenAt")


def p4_current_status(spark: SparkSession, folder: str) -> DataFrame:
    """The current status of each group; where members have no time, by the order in which statuses follow one another."""
    levels = value_levels(_history(spark, folder), "propertyId", ["status"], "lastSeenAt").drop("field")
    return current_values(_members(spark, folder), "groupId", "propertyId", "status", "lastSeenAt", levels)


def _sale_counts(spark: SparkSession, folder: str, *groups: str, relative_error: float = 0.0) -> DataFrame:
    """Value counts of TradePrice and Area per group; each distinct text is parsed once per group."""
    sales = table(spark, folder, "transactions")
    for g in groups:
        sales = sales.where(F.col(g).isNotNull())
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("fieldName"), F.col(n).alias("text")) for n in ("TradePrice", "Area")])).alias("c")
    texts = sales.select(*groups, cells).select(*groups, "c.*").where("text is not null").groupBy(*groups, "fieldName", "text").agg(F.count("*").alias("rows"))
    price = F.col("fieldName") == "TradePrice"
    values = texts.withColumn("value", F.coalesce(quantity(F.when(price, F.col("text")), TRADE_YEN), quantity(F.when(~price, F.col("text")), AREA_M2)))
    return value_counts(values, [*groups, "fieldName"], "value", relative_error, "rows")


def p5_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Five percentiles of TradePrice and Area per city and quarter, exact."""
    return percentiles(_sale_counts(spark, folder, "_cityName", "_period"), ["_cityName", "_period", "fieldName"], SHARES)


def p5_merged_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Medians per city from the merged summaries of single quarters, within one percent."""
    quarters = _sale_counts(spark, folder, "_cityName", "_period", relative_error=0.01).drop("_period")
    return percentiles(merge_counts(quarters), ["_cityName", "fieldName"], (0.5,))


def p5_merged_check(spark: SparkSession, folder: str) -> DataFrame:
    """Exact medians per city beside the merged ones of ``p5_merged_loads``: whether each keeps its stated error."""
    keys = ["_cityName", "fieldName"]
    exact = percentiles(_sale_counts(spark, folder, "_cityName", "_period").groupBy(*keys, "value").agg(F.sum("rows").alias("rows")), keys, (0.5,))
    merged = p5_merged_loads(spark, folder).select(*keys, F.col("percentile").alias("merged"))
    within = F.abs(F.col("merged") - F.col("percentile")) <= F.col("percentile") * (0.01 + 1e-9)
    return exact.join(merged, keys).select(*keys, "rows", F.col("percentile").alias("median"), within.alias("withinError"))


def p5_order_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles of line prices per flag and status: few groups of very many different values."""
    counts = value_counts(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return percentiles(counts, ["l_returnflag", "l_linestatus"], SHARES)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    groups = ["_cityName", "_period", "fieldName"]
    out = percentiles(_sale_counts(spark, folder, "_cityName", "_period"), groups, (0.5, 0.9)).where("rows >= 20")
    wide = out.groupBy(*groups).agg(F.max(F.when(F.col("share") == 0.5, F.col("percentile"))).alias("median"), F.max(F.when(F.col("share") == 0.9, F.col("percentile"))).alias("p90"))
    return wide.where("p90 >= 3 * median").select("_cityName", "_period", "fieldName")


ADDRESSES = ["address", "fullAddress", "propertyAddress"]


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Listings (side l) and hand-kept records (side r): (side, id, place, number, district, land, building, year).

    One row per place and number that the record's addresses may mean; a record without any has null places.
    """
    listings = table(spark, folder, "discovered_listings")
    kept = table(spark, folder, "source_properties")
    positive = lambda c: F.when((c > 0) & ~F.isnan(c), c)
    # only price, status and times vary between the snapshots of a listing
    one = listings.where("propertyId is not null").groupBy("propertyId").agg(
        *[F.max(a).alias(a) for a in ADDRESSES],
        F.max(positive(F.col("landAreaM2"))).alias("land"),
        F.max(positive(F.col("buildingAreaM2"))).alias("building"),
        F.max(F.when(F.col("constructionYear") > 0, F.col("constructionYear"))).cast("double").alias("year"),
    )
    two = kept.where("id is not null").select(F.col("id"), "address", quantity(F.col("land"), AREA_M2).alias("land"), positive(F.col("building")).alias("building"), F.when(F.col("year") > 0, F.col("year")).cast("double").alias("year")).distinct()
    one, two = write_table(one, "listings").df, write_table(two, "kept").df
    texts = one.select(F.explode(F.array(*ADDRESSES)).alias("text")).unionByName(two.select(F.col("address").alias("text")))
    parsed = write_table(parsed_addresses(texts, "text"), "addresses").df
    places = write_table(gazetteer(parsed), "gazetteer").df
    located = write_table(located_addresses(texts, "text", places, parsed), "located").df
    first = F.explode_outer("numbers").alias("number")
    at = located_records(one, "propertyId", ADDRESSES, located).select(F.col("propertyId").alias("id"), "place", "district", first)
    names = ["id", "place", "number", "district", "land", "building", "year"]
    left = one.select(F.col("propertyId").alias("id"), "land", "building", "year").join(at, "id", "left").select(F.lit("l").alias("side"), *names)
    # an address of a hand-kept record may name several places that tie: all of them are alternatives
    where = two.select("id", F.col("address").alias("text")).join(located, "text").select("id", "place", "number", "district").distinct()
    return left.unionByName(two.select("id", "land", "building", "year").join(where, "id", "left").select(F.lit("r").alias("side"), *names))


def p2_matches(spark: SparkSession, folder: str) -> DataFrame:
    """(propertyId, id, confidence, settled): listings and hand-kept records of the same house.

    Houses are matched one to one; a pair's confidence comes from its own evidence and the messages that its houses got.
    """
    records = write_table(_records(spark, folder), "records").df
    housed = write_table(joined_houses(house_clusters(records, ["side"]), ["side"]), "houses").df
    values = write_table(house_values(housed, ["side"]), "values").df
    pairs = write_table(candidates(values.where("side = 'l'"), values.where("side = 'r'"), floor=None), "pairs").df
    weights = learned_weights(pairs, values.count())
    matched = match_probabilities(rescored(pairs, weights)).where(F.col("probability") >= BELIEF).select("lid", "rid", "score", "message", "settled")
    matched = write_table(matched, "matched").df
    mine = lambda n: housed.where(f"side = '{n}'").select(F.col("house").alias(f"{n}id"), *[F.col(c).alias(f"{n}_{c}") for c in ("id", "place", "number", "district", "land", "building", "year")])
    own = agreement(matched.join(mine("l"), "lid").join(mine("r"), "rid"))
    belief = F.col("own") + F.col("message")
    out = rescored(own, weights, None).withColumn("own", F.coalesce("score", F.lit(0.0))).withColumn("confidence", 1 / (1 + F.exp(-belief)))
    return out.groupBy(F.col("l_id").alias("propertyId"), F.col("r_id").alias("id")).agg(F.max("confidence").alias("confidence"), F.min("settled").alias("settled"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_matches(spark, folder).select("propertyId", "id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_house_number(table(spark, folder, "discovered_listings"), "propertyId", ADDRESSES)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p8_leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    """Per test item: in how many documents it leaked, and the largest share held by one."""
    leaks = leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return leaks.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("share").alias("largestShare"))


def _mix(spark: SparkSession, folder: str):
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return short_sources(_mix(spark, folder)[0])


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached shares per source."""
    return _mix(spark, folder)[0]


def p9_mixed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The mixed corpus as token ranges of texts per slot of each shard."""
    _, slots, pieces = _mix(spark, folder)
    return slots.where("block is not null").join(pieces, ["source", "block"])


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncated_texts(table(spark, folder, "documents")).select("doc_id")


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: texts, cut texts, and how many of them were cut at a length limit, in transfer, in markup."""
    docs = table(spark, folder, "documents")
    cut = truncated_texts(docs).groupBy(F.col("source").alias("s")).agg(F.count("*").alias("cut"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("limit", "transfer", "markup")])
    rates = docs.where("text is not null").groupBy("source").agg(F.count("*").alias("texts")).join(cut, F.col("s").eqNullSafe(F.col("source")), "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return rates.select("source", "texts", n("cut").alias("cutTexts"), n("limit").alias("cutAtLimit"), n("transfer").alias("cutInTransfer"), n("markup").alias("cutInMarkup"), (n("cut") / F.col("texts")).alias("rate"))


def p10_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths at which the texts of a source stop too often."""
    docs = table(spark, folder, "documents").where("text is not null").select("source", F.xxhash64("text").alias("digest"), *[c.alias(n) for n, c in field_lengths(F.col("text")).items()])
    return length_limits(docs.dropDuplicates(["source", "digest"]), {"chars": F.col("chars"), "bytes": F.col("bytes")})


_LINKS = """
links AS (SELECT propertyIdA a, propertyIdB b FROM duplicate_review_candidates WHERE similarityScore >= 0.72 AND propertyIdA <> propertyIdB
          UNION SELECT propertyIdB, propertyIdA FROM duplicate_review_candidates WHERE similarityScore >= 0.72 AND propertyIdA <> propertyIdB),
reach AS (SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a)
"""
_NUMBERS = """
cells AS (
  SELECT _cityName, _period, 'TradePrice' AS fieldName, TradePrice AS t FROM transactions WHERE _cityName IS NOT NULL AND _period IS NOT NULL
  UNION ALL SELECT _cityName, _period, 'Area', Area FROM transactions WHERE _cityName IS NOT NULL AND _period IS NOT NULL),
numbers AS (
  SELECT _cityName, _period, fieldName,
         try_cast(regexp_replace(regexp_replace(translate(t, '０１２３４５６７８９，', '0123456789,'), '[,\\s円]', '', 'g'), '(㎡|m²|m2)$', '') AS DOUBLE) AS x
  FROM cells)
"""

_PRECEDENCE = """
seen AS (SELECT propertyId, lastSeenAt AS t, lower(regexp_replace(status, '^[\\s　]+|[\\s　]+$', '', 'g')) AS status, missedSearchRuns::VARCHAR AS missedSearchRuns FROM discovered_listings WHERE propertyId IS NOT NULL AND lastSeenAt IS NOT NULL),
hist AS (SELECT 'status' AS field, propertyId AS k, t, status AS v FROM seen WHERE status IS NOT NULL UNION SELECT 'missedSearchRuns', propertyId, t, missedSearchRuns FROM seen WHERE missedSearchRuns IS NOT NULL),
step AS (SELECT field, lag(v) OVER (PARTITION BY field, k ORDER BY t, v) AS a, v AS b FROM hist),
cnt AS (SELECT field, a, b, count(*) AS n FROM step WHERE a IS NOT NULL AND a <> b GROUP BY ALL),
flow AS (SELECT field, v, sum(n * d) / sum(n) AS late FROM (SELECT field, a AS v, 0 AS d, n FROM cnt UNION ALL SELECT field, b, 1, n FROM cnt) GROUP BY ALL),
prec AS (SELECT c.field, c.a AS before, c.b AS after, c.n, coalesce(r.n, 0) AS reverse,
        CASE WHEN c.n < 3 THEN 'support' WHEN c.n < 0.6 * (c.n + coalesce(r.n, 0)) THEN 'majority' WHEN fa.late >= fb.late THEN 'direction' ELSE 'kept' END AS verdict
    FROM cnt c LEFT JOIN cnt r ON r.field = c.field AND r.a = c.b AND r.b = c.a JOIN flow fa ON fa.field = c.field AND fa.v = c.a JOIN flow fb ON fb.field = c.field AND fb.v = c.b)"""
_MEMBER = """
grp AS (SELECT min(other) AS groupId, node AS propertyId FROM reach GROUP BY node),
last AS (SELECT * FROM discovered_listings QUALIFY row_number() OVER (PARTITION BY propertyId ORDER BY snapshotSeq DESC, lastSeenAt DESC NULLS LAST) = 1)"""

QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_matches": p2_matches, "p6_found": p6_found, "p4_found": p4_found, "p4_current_fields": p4_current_fields, "p4_precedence": p4_precedence, "p4_current_status": p4_current_status, "p5_percentiles": p5_percentiles, "p5_merged_loads": p5_merged_loads, "p5_merged_check": p5_merged_check, "p5_order_prices": p5_order_prices, "p5_found": p5_found,
    "p8_found": p8_found, "p8_leaked_items": p8_leaked_items, "p9_found": p9_found, "p9_shares": p9_shares, "p9_mixed_texts": p9_mixed_texts,
    "p10_found": p10_found, "p10_rates": p10_rates, "p10_limits": p10_limits}

SQL = {
    "p1_found": f"WITH RECURSIVE {_LINKS} SELECT min(other) AS groupId, node AS propertyId FROM reach GROUP BY node",
    "p4_found": f"""WITH RECURSIVE {_LINKS},
        grp AS (SELECT min(other) AS groupId, node AS propertyId FROM reach GROUP BY node),
        comp AS (SELECT id AS propertyId, max(coalesce(c, 0)) AS c FROM (
            SELECT propertyIdA id, detailCompletenessA c FROM duplicate_review_candidates WHERE similarityScore >= 0.72 AND propertyIdA <> propertyIdB
            UNION ALL SELECT propertyIdB, detailCompletenessB FROM duplicate_review_candidates WHERE similarityScore >= 0.72 AND propertyIdA <> propertyIdB) GROUP BY id),
        member AS (SELECT g.groupId, l.*, row_number() OVER (PARTITION BY g.groupId ORDER BY k.c DESC, l.lastSeenAt DESC NULLS LAST, l.propertyId) AS rk
            FROM grp g JOIN comp k USING (propertyId)
            JOIN (SELECT * FROM discovered_listings QUALIFY row_number() OVER (PARTITION BY propertyId ORDER BY snapshotSeq DESC, lastSeenAt DESC NULLS LAST) = 1) l USING (propertyId)),
        cell AS (SELECT groupId, propertyId, rk, 'record' AS fieldName, true AS ok FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'address', trim(address) NOT IN ('', '-', '不明', '0') FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'landAreaM2', landAreaM2 <> 0 FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'buildingAreaM2', buildingAreaM2 <> 0 FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'constructionYear', constructionYear <> 0 FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'layout', trim(layout) NOT IN ('', '-', '不明', '0') FROM member
            UNION ALL SELECT groupId, propertyId, rk, 'priceYen', priceYen <> 0 FROM member)
        SELECT groupId, fieldName, arg_min(propertyId, rk) AS propertyId FROM cell WHERE ok GROUP BY groupId, fieldName""",
    "p4_precedence": f"WITH {_PRECEDENCE} SELECT * FROM prec",
    "p4_current_status": f"""WITH RECURSIVE {_LINKS}, {_MEMBER}, {_PRECEDENCE},
        chain AS (SELECT after AS v, 1 AS level FROM prec WHERE verdict = 'kept' AND field = 'status' UNION SELECT p.after, c.level + 1 FROM chain c JOIN prec p ON p.before = c.v AND p.verdict = 'kept' AND p.field = 'status'),
        level AS (SELECT v, max(level) AS level FROM chain GROUP BY v),
        m AS (SELECT groupId, propertyId, lastSeenAt AS t, lower(regexp_replace(status, '^[\\s　]+|[\\s　]+$', '', 'g')) AS v FROM grp JOIN last USING (propertyId)),
        mem AS (SELECT m.*, coalesce(level.level, 0) AS level FROM m LEFT JOIN level USING (v) WHERE v IS NOT NULL),
        timed AS (SELECT * FROM mem WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY groupId ORDER BY t DESC, propertyId) = 1),
        untimed AS (SELECT * FROM mem WHERE t IS NULL QUALIFY row_number() OVER (PARTITION BY groupId ORDER BY level DESC, propertyId) = 1),
        b AS (SELECT coalesce(a.groupId, u.groupId) AS groupId, a.groupId IS NULL OR coalesce(u.level, -1) > a.level AS after, a.propertyId AS ap, a.v AS av, u.propertyId AS up, u.v AS uv FROM timed a FULL JOIN untimed u ON a.groupId = u.groupId)
        SELECT groupId, CASE WHEN after THEN up ELSE ap END AS propertyId, CASE WHEN after THEN uv ELSE av END AS value, CASE WHEN after THEN 'precedence' ELSE 'time' END AS basis FROM b""",
    "p5_percentiles": f"""WITH {_NUMBERS}
        SELECT _cityName, _period, fieldName, rows, unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS share, unnest(ps) AS percentile
        FROM (SELECT _cityName, _period, fieldName, count(*) AS rows, quantile_cont(x, [0.1, 0.25, 0.5, 0.75, 0.9]) AS ps
              FROM numbers WHERE x > 0 GROUP BY _cityName, _period, fieldName)""",
    "p5_merged_check": f"""WITH {_NUMBERS}
        SELECT _cityName, fieldName, count(*) AS rows, quantile_cont(x, 0.5) AS median, true AS withinError FROM numbers WHERE x > 0 GROUP BY _cityName, fieldName""",
    "p5_order_prices": """SELECT l_returnflag, l_linestatus, rows, unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS share, unnest(ps) AS percentile
        FROM (SELECT l_returnflag, l_linestatus, count(*) AS rows, quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.75, 0.9]) AS ps FROM lineitem GROUP BY ALL)""",
    "p5_found": f"""WITH {_NUMBERS}
        SELECT _cityName, _period, fieldName FROM numbers WHERE x > 0 GROUP BY ALL
        HAVING count(*) >= 20 AND quantile_cont(x, 0.9) >= 3 * quantile_cont(x, 0.5)""",
}
