"""Queries of scalar operators: text, numbers, addresses, dates, money, addresses of pages, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machiya.functions import dates, decisions, money, text, urls
from machiya.sources.tables import table

NOW = "2026-10-12 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def lenient_number(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "transactions")
    return t.groupBy("TradePrice", "Area").agg(F.count("*").alias("n")).select(
        "TradePrice", "Area", "n", text.lenient_number(F.col("TradePrice")).alias("price"), text.signed_number(F.col("Area")).alias("areaNumber"),
        text.whole_number(F.col("TradePrice")).alias("whole"), text.number_text(text.lenient_number(F.col("Area"))).alias("areaText"),
    )


def text_clean(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    value = text.clean_value(F.col("text"), ["", "-"], ["続きは店頭で", "(update)"], ["おすすめ"])
    return d.select("doc_id", F.md5(text.clean(F.col("text"))).alias("cleaned"), F.md5(F.coalesce(value, F.lit("none"))).alias("valueDigest"), text.usable(F.col("source")).alias("hasSource"))


def address_norm(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "source_properties").select("id", "address").distinct()
    market = text.market_address(F.col("address"))
    return s.select("id", "address", market.alias("market"), text.digit_runs(market).alias("digitRuns"), text.identity_address(F.col("address")).alias("identity"), text.bare_address(F.col("address")).alias("bare"))


def hash_keys(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "duplicate_review_candidates")
    return p.select("candidateId", "propertyIdA", "propertyIdB", text.pair_key(F.col("propertyIdA"), F.col("propertyIdB")).alias("pairKey")).distinct()


def layout_token(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings")
    kinds = [("軽量鉄骨", "light steel"), ("鉄骨鉄筋", "steel concrete"), ("鉄筋", "concrete"), ("鉄骨", "steel"), ("木", "timber")]
    return d.select("layoutRaw", "structure").distinct().select("layoutRaw", "structure", text.layout_token(F.col("layoutRaw")).alias("layout"), text.class_of(F.col("structure"), kinds, "unknown").alias("structureClass"))


def money_band(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "source_properties").select("price").distinct()
    yen = money.money_yen(F.col("price"))
    return s.select("price", yen.alias("yen"), money.price_band(yen, (5e6, 1e7, 2e8, 5e8)).alias("band"), F.size(money.price_candidates(F.col("price"))).alias("candidates"))


def area_parse(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "source_properties").select("land").distinct()
    return s.select("land", text.area_m2(F.col("land")).alias("withUnit"), text.area_m2(F.col("land"), bare=True).alias("bare"))


def quarter_end(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "transactions").select("_period", "Period").distinct()
    at = F.coalesce(dates.quarter_end(F.col("_period")), dates.quarter_end(F.col("Period")))
    return t.select("_period", F.col("Period").alias("stated"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("endsAt"), dates.in_window(at, _now(), 365).alias("lastYear"))


def age_years(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings").select("constructionMonth").distinct()
    t = table(spark, folder, "transactions").select("BuildingYear").distinct()
    ages = d.select(F.col("constructionMonth").alias("stated"), dates.age_years(F.col("constructionMonth"), _now()).alias("age"), F.lit(None).cast("string").alias("ym"))
    parsed = dates.year_month(F.col("BuildingYear"))
    years = t.select(F.col("BuildingYear").alias("stated"), dates.age_years(parsed["ym"], _now(), clamp=True).alias("age"), parsed["ym"].alias("ym"))
    return ages.unionByName(years)


def elapsed_days(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings")
    return d.select("snapshotSeq", "propertyId", dates.whole_days(F.col("firstSeenAt"), F.col("lastSeenAt")).alias("daysListed"), dates.in_window(F.col("lastSeenAt"), _now(), 14).alias("recent")).distinct()


def url_canonical(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings").select("sourceUrl").distinct()
    page = urls.canonical(F.col("sourceUrl"), "https://listings.example/", None, r"(?i)/(?:nc_|b-)[0-9]+(?:/|$)")
    return d.select("sourceUrl", page.alias("page"), urls.path_key(page, r"(?i)/((?:nc_|b-)[0-9]+)(?:/|$)").alias("listingId"), F.try_parse_url("sourceUrl", F.lit("HOST")).alias("host"))


def alias_map(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "discovered_listings").select("status").distinct()
    s = F.lower(text.strip(F.col("status")))
    return d.select("status", text.alias_of(s, {"confirmed_ended": "ended", "observed_ended": "ended", "possibly_ended": "unsure"}).alias("state"))


def _tiers(spark: SparkSession, folder: str) -> tuple[DataFrame, F.Column]:
    d = table(spark, folder, "discovered_listings")
    d = d.join(F.broadcast(d.agg(F.max("snapshotSeq").alias("snapshotSeq"))), "snapshotSeq", "left_semi")
    kept = text.first_usable([F.col("fullAddress"), F.col("address"), F.col("propertyAddress")], text.EMPTY_DETAIL)
    positive = lambda c: F.when((F.col(c) > 0) & ~F.isnan(c), F.col(c))
    rows = d.select("propertyId", "source", "sourceId", text.identity_address(kept).alias("a"), text.number_text(positive("landAreaM2")).alias("l"), text.number_text(positive("buildingAreaM2")).alias("b"), F.coalesce(F.col("constructionYear").cast("string"), F.lit("")).alias("y"), F.coalesce(text.layout_token(F.col("layout")), F.lit("")).alias("p")).distinct()
    a, land, b, y, p = (F.col(c) for c in "albyp")
    key = decisions.tiered_key([("address_land_building", [a, land, b]), ("address_land_year_plan", [a, land, y, p]), ("address_building_year_plan", [a, b, y, p]), ("address_land", [a, land]), ("address_building", [a, b])], F.lit("house"))
    return rows, key


def tiered_identity(spark: SparkSession, folder: str) -> DataFrame:
    rows, key = _tiers(spark, folder)
    return rows.select("propertyId", key["key"].alias("identityKey"), key["tier"].alias("tier")).distinct()


def identity_records(spark: SparkSession, folder: str) -> DataFrame:
    """The public identity of each listing: its own id, else its tiered key, else a hash of what is known; and all aliases."""
    rows, key = _tiers(spark, folder)
    # hand-entered records have no stable id of their own and are known by their content
    own = F.when(F.col("source") != "manual", F.col("propertyId"))
    record = decisions.identity_record([("id", own), ("tier", key["key"])], F.concat_ws("|", "source", "sourceId", "a", "l", "b"), [F.col("propertyId"), F.col("sourceId")])
    return rows.select("propertyId", record["key"].alias("identityKey"), record["kind"].alias("kind"), F.concat_ws(",", record["aliases"]).alias("aliases")).distinct()


def information_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates that texts state of their own update."""
    d = table(spark, folder, "documents")
    stated = dates.labelled_date(F.col("text"), ["情報提供日", "（"]), dates.labelled_date(F.col("text"), ["次回更新予定日", "更新予定日"])
    return d.select("doc_id", stated[0].alias("informationDate"), stated[1].alias("nextUpdate")).where("informationDate is not null or nextUpdate is not null")


_W, _N = text.WIDE_DIGITS, text.DIGITS
_LEN = lambda c: f"nullif(regexp_extract(translate(replace({c}, ',', ''), '{_W}．', '{_N}.'), '[0-9]+(?:\\.[0-9]+)?'), '')"
_SGN = lambda c: f"nullif(regexp_extract(translate(regexp_replace({c}, '[,，]', '', 'g'), '{_W}．', '{_N}.'), '-?[0-9]+(?:\\.[0-9]+)?'), '')"
_POS = lambda x: f"CASE WHEN try_cast({x} AS DOUBLE) > 0 THEN try_cast({x} AS DOUBLE) END"
_STRIP = lambda c: f"regexp_replace({c}, '^[\\s　]+|[\\s　]+$', '', 'g')"
_CLEAN = lambda c: f"trim(regexp_replace({c}, '[\\s　]+', ' ', 'g'))"
_MARKET = f"regexp_replace(trim(replace(regexp_replace(translate(coalesce(address, ''), '{_W}ヶ之　 ', '{_N}ケの'), '丁目|番地|番', '-', 'g'), '号', '')), '[-ー―‐−]+', '-', 'g')"
_FOLD = lambda c: f"translate({c}, '{_W}{text.WIDE_LETTERS}', '{_N}{text.LETTERS}')"
_IDENT = lambda c: "regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(translate(" + _FOLD(f"coalesce({c}, '')") + ", '－―‐−ー', '-----'), '丁目|番地|番', '-', 'g'), '号|[\\s　,，、。．.()（）【】\\[\\]「」『』]', '', 'g'), '-+', '-', 'g')), '^-+|-+$', '', 'g')"
_TXT = lambda x: f"coalesce(regexp_replace(printf('%.2f', {x}), '\\.?0+$', ''), '')"
_LAYOUT = lambda c: "(SELECT " + _CLEAN("coalesce(" + ", ".join(f"nullif(regexp_extract(up, '[0-9]+\\s*{k}(?:\\s*\\+\\s*(?:[0-9]+\\s*)?S)?'), '')" for k in ("LDK", "DK", "LK", "K")) + ")") + f" FROM (SELECT upper(translate({_FOLD(c)}, '＋', '+')) AS up))"
_QEND = lambda c: f"CASE WHEN regexp_matches({c}, '(19|20)[0-9]{{2}}\\s*[Qq][1-4]') THEN last_day(make_date(regexp_extract({c}, '((?:19|20)[0-9]{{2}})\\s*[Qq]([1-4])', 1)::INT, regexp_extract({c}, '((?:19|20)[0-9]{{2}})\\s*[Qq]([1-4])', 2)::INT * 3, 1))::TIMESTAMP + INTERVAL 86399 SECOND WHEN regexp_matches({c}, '(19|20)[0-9]{{2}}年\\s*第?[1-4]四半期') THEN last_day(make_date(regexp_extract({c}, '((?:19|20)[0-9]{{2}})年\\s*第?([1-4])四半期', 1)::INT, regexp_extract({c}, '((?:19|20)[0-9]{{2}})年\\s*第?([1-4])四半期', 2)::INT * 3, 1))::TIMESTAMP + INTERVAL 86399 SECOND END"
_FIRST = "coalesce(" + ", ".join(f"CASE WHEN {_STRIP(c)} NOT IN ('', '-', '－', '不明', '未定') THEN {_STRIP(c)} END" for c in ("fullAddress", "address", "propertyAddress")) + ")"
_OKU = "'([0-9]+(?:\\.[0-9]+)?)\\s*億(?:\\s*([0-9]+(?:\\.[0-9]+)?)\\s*万)?'"

QUERIES = {f.__name__: f for f in (lenient_number, text_clean, address_norm, hash_keys, layout_token, money_band, area_parse, quarter_end, age_years, elapsed_days, url_canonical, alias_map, tiered_identity, identity_records, information_dates)}

_TIERS = f"""r AS (SELECT DISTINCT propertyId, source, sourceId, {_IDENT(_FIRST)} AS a, {_TXT('CASE WHEN landAreaM2 > 0 AND NOT isnan(landAreaM2) THEN landAreaM2 END')} AS l, {_TXT('CASE WHEN buildingAreaM2 > 0 AND NOT isnan(buildingAreaM2) THEN buildingAreaM2 END')} AS b,
            coalesce(constructionYear::VARCHAR, '') AS y, coalesce({_LAYOUT('layout')}, '') AS p FROM discovered_listings WHERE snapshotSeq = (SELECT max(snapshotSeq) FROM discovered_listings)),
        t AS (SELECT *, CASE WHEN a <> '' AND l <> '' AND b <> '' THEN 'address_land_building' WHEN a <> '' AND l <> '' AND y <> '' AND p <> '' THEN 'address_land_year_plan'
            WHEN a <> '' AND b <> '' AND y <> '' AND p <> '' THEN 'address_building_year_plan' WHEN a <> '' AND l <> '' THEN 'address_land' WHEN a <> '' AND b <> '' THEN 'address_building' END AS tier FROM r),
        k AS (SELECT DISTINCT propertyId, source, sourceId, a, l, b, 'property:' || substr(sha256(tier || '|' || CASE tier WHEN 'address_land_building' THEN concat_ws('|', a, l, b) WHEN 'address_land_year_plan' THEN concat_ws('|', a, l, y, p)
            WHEN 'address_building_year_plan' THEN concat_ws('|', a, b, y, p) WHEN 'address_land' THEN concat_ws('|', a, l) ELSE concat_ws('|', a, b) END || '|house'), 1, 24) AS identityKey, tier FROM t)"""

SQL = {
    "lenient_number": f"""SELECT TradePrice, Area, count(*) AS n, {_POS(_LEN('TradePrice'))} AS price, try_cast({_SGN('Area')} AS DOUBLE) AS areaNumber,
        CASE WHEN regexp_full_match({_STRIP(f"translate(replace(TradePrice, ',', ''), '{_W}．', '{_N}.')")}, '-?[0-9]+(?:\\.[0-9]+)?') THEN try_cast({_STRIP(f"translate(replace(TradePrice, ',', ''), '{_W}．', '{_N}.')")} AS DOUBLE) END AS whole,
        {_TXT(_POS(_LEN('Area')))} AS areaText FROM transactions GROUP BY TradePrice, Area""",
    "text_clean": f"""WITH c AS (SELECT *, {_CLEAN('text')} AS cl FROM documents),
        v AS (SELECT *, trim(regexp_replace(regexp_replace(cl, '\\s*(?:続きは店頭で|\\(update\\)).*$', ''), '\\s*(?:\\[[^\\]]*\\]|［[^］]*］|【[^】]+】)', '', 'g')) AS val FROM c)
        SELECT doc_id, md5(cl) AS cleaned, md5(coalesce(CASE WHEN val NOT IN ('', '-') AND NOT contains(val, 'おすすめ') THEN val END, 'none')) AS valueDigest,
        source IS NOT NULL AND trim(source) NOT IN ('', '-') AS hasSource FROM v""",
    "address_norm": f"""SELECT DISTINCT id, address, {_MARKET} AS market, len(regexp_extract_all({_MARKET}, '[0-9]+'))::INT AS digitRuns, {_IDENT('address')} AS identity,
        regexp_replace(translate(coalesce(address, ''), '{_W}', '{_N}'), '[\\s　\\-ー－―‐−]|丁目|番地|番|号', '', 'g') AS bare FROM source_properties""",
    "hash_keys": "SELECT DISTINCT candidateId, propertyIdA, propertyIdB, 'dup:' || substr(sha256(least(propertyIdA, propertyIdB) || '|' || greatest(propertyIdA, propertyIdB)), 1, 20) AS pairKey FROM duplicate_review_candidates",
    "layout_token": f"""SELECT DISTINCT layoutRaw, structure, {_LAYOUT('layoutRaw')} AS layout,
        CASE WHEN contains(structure, '軽量鉄骨') THEN 'light steel' WHEN contains(structure, '鉄骨鉄筋') THEN 'steel concrete' WHEN contains(structure, '鉄筋') THEN 'concrete'
             WHEN contains(structure, '鉄骨') THEN 'steel' WHEN contains(structure, '木') THEN 'timber' ELSE 'unknown' END AS structureClass FROM discovered_listings""",
    "money_band": f"""WITH s AS (SELECT DISTINCT price, regexp_replace(translate(price, '{_W}．', '{_N}.'), '[,，]', '', 'g') AS p FROM source_properties),
        y AS (SELECT price, p, coalesce(
            round(try_cast(nullif(regexp_extract(p, {_OKU}, 1), '') AS DOUBLE) * 100000000 + coalesce(try_cast(nullif(regexp_extract(p, {_OKU}, 2), '') AS DOUBLE), 0) * 10000),
            round(try_cast(nullif(regexp_extract(p, '([0-9]+(?:\\.[0-9]+)?)\\s*万円', 1), '') AS DOUBLE) * 10000),
            CASE WHEN regexp_matches(p, '[0-9]+\\s*円') THEN CASE WHEN regexp_extract(p, '([0-9]+)\\s*円', 1)::DOUBLE BETWEEN 5000000 AND 500000000 THEN regexp_extract(p, '([0-9]+)\\s*円', 1)::DOUBLE END
                 WHEN regexp_matches(p, '[¥￥]\\s*[0-9]+') THEN CASE WHEN regexp_extract(p, '[¥￥]\\s*([0-9]+)', 1)::DOUBLE BETWEEN 5000000 AND 500000000 THEN regexp_extract(p, '[¥￥]\\s*([0-9]+)', 1)::DOUBLE END END)::BIGINT AS yen FROM s)
        SELECT price, yen, CASE WHEN yen IS NULL THEN 'missing' WHEN yen <= 0 THEN 'invalid' WHEN yen < 5000000 THEN 'very_low' WHEN yen > 500000000 THEN 'very_high'
            WHEN yen BETWEEN 10000000 AND 200000000 THEN 'normal' ELSE 'unusual' END AS band,
            CASE WHEN price IS NULL THEN NULL WHEN regexp_matches(p, '[0-9]\\s*(億|万円)') AND yen BETWEEN 5000000 AND 500000000 THEN 1 ELSE 0 END AS candidates FROM y""",
    "area_parse": f"""WITH s AS (SELECT DISTINCT land, translate(replace(replace(translate(regexp_replace({_CLEAN('land')}, '[,，]', '', 'g'), '{_W}．', '{_N}.'), '平方メートル', 'm2'), '㎡', 'm2'), 'ｍ²Ｍ', 'm2m') AS t FROM source_properties),
        u AS (SELECT land, t, try_cast(nullif(regexp_extract(t, '(?:^|[^A-Za-z0-9.])([0-9]+(?:\\.[0-9]+)?)\\s*m\\s*\\^?\\s*2', 1), '') AS DOUBLE) AS x FROM s)
        SELECT land, CASE WHEN x > 0 THEN x END AS withUnit, CASE WHEN coalesce(x, CASE WHEN regexp_full_match(t, '[0-9]+(\\.[0-9]+)?') THEN try_cast(t AS DOUBLE) END) > 0
            THEN coalesce(x, CASE WHEN regexp_full_match(t, '[0-9]+(\\.[0-9]+)?') THEN try_cast(t AS DOUBLE) END) END AS bare FROM u""",
    "quarter_end": f"""WITH q AS (SELECT DISTINCT _period, "Period" AS pp FROM transactions), e AS (SELECT _period, pp, coalesce({_QEND('_period')}, {_QEND('pp')}) AS ends FROM q)
        SELECT _period, pp AS stated, strftime(ends, '%Y-%m-%d %H:%M:%S') AS endsAt, coalesce(ends BETWEEN TIMESTAMP '{NOW}' - INTERVAL 365 DAY AND TIMESTAMP '{NOW}', false) AS lastYear FROM e""",
    "age_years": """WITH m AS (SELECT DISTINCT constructionMonth AS stated FROM discovered_listings), b AS (SELECT DISTINCT BuildingYear AS stated FROM transactions),
        am AS (SELECT stated, CASE WHEN regexp_full_match(stated, '[0-9]{4}-[0-9]{2}') THEN (2026 - substr(stated, 1, 4)::INT) * 12 + 10 - substr(stated, 6, 2)::INT END AS n, NULL::VARCHAR AS ym FROM m),
        ay AS (SELECT stated, CASE WHEN regexp_matches(stated, '(19|20)[0-9]{2}\\s*年') THEN regexp_extract(stated, '((?:19|20)[0-9]{2})\\s*年', 1) || '-01' END AS ym FROM b)
        SELECT stated, CASE WHEN n >= 0 THEN n / 12 END AS age, ym FROM am UNION ALL
        SELECT stated, CASE WHEN ym IS NOT NULL THEN greatest(((2026 - substr(ym, 1, 4)::INT) * 12 + 9) / 12, 0) END AS age, ym FROM ay""",
    "elapsed_days": f"""SELECT DISTINCT snapshotSeq, propertyId, CASE WHEN firstSeenAt IS NOT NULL AND lastSeenAt IS NOT NULL THEN greatest(floor((epoch_us(lastSeenAt) - epoch_us(firstSeenAt)) / 86400000000), 0)::INT END AS daysListed,
        coalesce(lastSeenAt BETWEEN TIMESTAMPTZ '{NOW}+00' - INTERVAL 14 DAY AND TIMESTAMPTZ '{NOW}+00', false) AS recent FROM discovered_listings""",
    "url_canonical": """SELECT DISTINCT sourceUrl, CASE WHEN regexp_matches(sourceUrl, '(?i)^https?://[^/]+.*/(?:nc_|b-)[0-9]+(?:/|$)') THEN regexp_replace(sourceUrl, '[?#].*$', '') END AS page,
        nullif(lower(regexp_extract(sourceUrl, '(?i)/((?:nc_|b-)[0-9]+)(?:/|$)', 1)), '') AS listingId, nullif(regexp_extract(sourceUrl, '^https?://([^/]+)', 1), '') AS host FROM discovered_listings""",
    "alias_map": f"""SELECT DISTINCT status, CASE lower({_STRIP('status')}) WHEN 'confirmed_ended' THEN 'ended' WHEN 'observed_ended' THEN 'ended' WHEN 'possibly_ended' THEN 'unsure' ELSE lower({_STRIP('status')}) END AS state FROM discovered_listings""",
    "tiered_identity": f"WITH {_TIERS} SELECT propertyId, identityKey, tier FROM k",
    "identity_records": f"""WITH {_TIERS}, i AS (SELECT propertyId, CASE WHEN source <> 'manual' THEN propertyId END AS own, identityKey AS tk, sourceId,
            'candidate:' || substr(sha256(concat_ws('|', source, sourceId, a, l, b)), 1, 24) AS fallback FROM k)
        SELECT DISTINCT propertyId, coalesce(own, tk, fallback) AS identityKey, CASE WHEN own IS NOT NULL THEN 'id' WHEN tk IS NOT NULL THEN 'tier' ELSE 'candidate' END AS kind,
            array_to_string(list_filter([coalesce(own, tk, fallback), own, tk, propertyId, sourceId], lambda x, j: x IS NOT NULL AND list_position([coalesce(own, tk, fallback), own, tk, propertyId, sourceId], x) = j), ',') AS aliases FROM i""",
    "information_dates": """WITH d AS (SELECT doc_id, regexp_extract(text, '(?:情報提供日|（)\\s*[:：]?\\s*(20[0-9]{2})年\\s*([0-9]{1,2})月\\s*([0-9]{1,2})日', ['y', 'm', 'd']) AS i, regexp_extract(text, '(?:次回更新予定日|更新予定日)\\s*[:：]?\\s*(20[0-9]{2})年\\s*([0-9]{1,2})月\\s*([0-9]{1,2})日', ['y', 'm', 'd']) AS n FROM documents)
        SELECT * FROM (SELECT doc_id, CASE WHEN i.y <> '' THEN printf('%04d-%02d-%02d', i.y::INT, i.m::INT, i.d::INT) END AS informationDate, CASE WHEN n.y <> '' THEN printf('%04d-%02d-%02d', n.y::INT, n.m::INT, n.d::INT) END AS nextUpdate FROM d) WHERE informationDate IS NOT NULL OR nextUpdate IS NOT NULL""",
}
