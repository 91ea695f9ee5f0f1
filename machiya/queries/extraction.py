"""Queries of extraction from texts and markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machiya.functions import money, text
from machiya.operators import pages
from machiya.plans.parallel import spread
from machiya.sources.tables import table

TRUSTED = ["label"]


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    patterns = [("land", "label", 0.95, r"(?:土地面積 |Land:? )([0-9]+(?:\.[0-9]+)?)"), ("land", "sentence", 0.8, r"(?:土地は|stands on )([0-9]+(?:\.[0-9]+)?)"), ("price", "label", 0.9, r"(?:価格 |Price: )([0-9]+)"), ("price", "sentence", 0.7, r"(?:価格は|price is )([0-9]+)")]
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(s).alias("source"), F.lit(c).alias("confidence"), F.regexp_extract_all("text", F.lit(p), 1).alias("values")) for f, s, c, p in patterns])
    rules = d.select("doc_id", F.posexplode(cells).alias("rule", "c"))
    values = rules.select("doc_id", "c.field", "c.source", "c.confidence", "rule", F.posexplode("c.values").alias("at", "value"))
    return values.select("doc_id", "field", "value", "source", "confidence", (F.col("rule") * 10000 + F.col("at")).alias("ordinal"))


def candidate_vote(spark: SparkSession, folder: str) -> DataFrame:
    return pages.vote(_candidates(spark, folder), TRUSTED, "doc_id").select("doc_id", "field", "value", "source", "score", "votes", "candidates")


def extraction_audit(spark: SparkSession, folder: str) -> DataFrame:
    won = pages.vote(_candidates(spark, folder), TRUSTED, "doc_id")
    rows = pages.audit(won, table(spark, folder, "documents"), ["land", "price"], 900, "doc_id")
    return rows.groupBy("field", "status", "method").agg(F.count("*").alias("n"), F.sum("candidates").alias("candidates"))


def page_fields(spark: SparkSession, folder: str) -> DataFrame:
    won = pages.vote(_candidates(spark, folder), TRUSTED, "doc_id")
    rec = pages.records(won, ["land", "price"], "doc_id")
    q = pages.quality({"land": F.col("land"), "price": F.col("price")}, ["price"])
    return rec.select("doc_id", "land", "price", q["quality"].alias("quality"), q["score"].alias("score"), F.concat_ws(",", q["missing"]).alias("missing"))


def text_blocks(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents").where(F.col("text").rlike(r"(?i)<p[\s>]")))
    blocks = pages.page_evidence(d, "doc_id", "text").where("kind = 'block' and label = 'p'")
    return blocks.groupBy(F.col("page_id").cast("bigint").alias("doc_id")).agg(F.count("*").alias("blocks"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page for each reading of a listing: table and list pairs, a meta element, a next link, and a seller's section."""
    d = table(spark, folder, "discovered_listings")
    cell = lambda c, unit: F.concat(F.col(c).cast("string"), F.lit(unit))
    none = F.lit("-")
    land, building = (F.coalesce(F.when((F.col(c) > 0) & ~F.isnan(c), cell(c, u)), none) for c, u in (("landAreaM2", "m2"), ("buildingAreaM2", "㎡")))
    price = F.coalesce(F.when(F.col("priceMan") > 0, cell("priceMan", "万円")), none)
    parts = [
        "<html><head><title>", F.col("propertyId"), "</title><meta name='Status' content='", F.coalesce("status", F.lit("")), "'></head><body><div class='Company-info'><table><tr><th>土地面積</th><td>999m2</td></tr></table></div>",
        "<table><tr><th>土地面積<td>", land, "<th>建物面積<td>", building, "</table><dl><dt>価格<dd><b>", price, "</b> 税込</dl><script>var x = '<td>1m2';</script><a href='/p/", F.col("snapshotSeq").cast("string"), "' rel=next>次</a></body>",
    ]
    html = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return d.where("propertyId is not null").select(F.concat_ws("|", F.col("snapshotSeq"), "propertyId", F.xxhash64("status", "landAreaM2", "buildingAreaM2", "priceMan")).alias("page"), html.alias("html")).distinct()


def page_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written from listings and read again: fields by voted candidates, and links; a seller's section is left out."""
    evidence = pages.page_evidence(spread(_pages(spark, folder)), "page", "html")
    value = F.col("value")
    rules = [
        ("land", "pair_table", "土地面積", "table", 0.95, text.area_m2(value)), ("building", "pair_table", "建物面積", "table", 0.95, text.area_m2(value)),
        ("price", "pair_list", "価格", "list", 0.9, money.money_yen(value)), ("status", "meta", "^status$", "meta", 0.8, F.nullif(text.strip(value), F.lit(""))), ("title", "title", "", "title", 0.8, value), ("next", "link", "next", "link", 0.9, value),
    ]
    won = pages.records(pages.vote(pages.field_candidates(evidence, rules), ["table"]), [r[0] for r in rules])
    return won.groupBy("title", "next", F.col("land").cast("double").alias("land"), F.col("building").cast("double").alias("building"), F.col("price").cast("bigint").alias("price"), "status").agg(F.count("*").alias("pages"))


def link_extract(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    links = d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"(https?://[\x21-\x7e]+)"), 1)).alias("position", "url"))
    key = F.regexp_extract("url", r"/([a-z]/[0-9]+)$", 1)
    return links.groupBy("doc_id", key.alias("pageKey")).agg(F.min("position").alias("position"), F.min_by("url", "position").alias("url"))


def station_walks(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    known = table(spark, folder, "discovered_listings").where("targetStation is not null").select(F.col("targetStation").alias("station")).distinct()
    walks = d.select(F.explode(pages.station_access(F.col("text"))).alias("w")).select("w.*").join(known, "station", "left_semi")
    return walks.groupBy("station").agg(F.count("*").alias("mentions"), F.min("minutes").alias("shortest"))


_C = r"""c AS (SELECT doc_id, 'land' AS field, 'label' AS source, 950 AS conf, 0 AS rule, regexp_extract_all(text, '(?:土地面積 |Land:? )([0-9]+(?:\.[0-9]+)?)', 1) AS vs FROM documents
    UNION ALL SELECT doc_id, 'land', 'sentence', 800, 1, regexp_extract_all(text, '(?:土地は|stands on )([0-9]+(?:\.[0-9]+)?)', 1) FROM documents
    UNION ALL SELECT doc_id, 'price', 'label', 900, 2, regexp_extract_all(text, '(?:価格 |Price: )([0-9]+)', 1) FROM documents
    UNION ALL SELECT doc_id, 'price', 'sentence', 700, 3, regexp_extract_all(text, '(?:価格は|price is )([0-9]+)', 1) FROM documents),
    x AS (SELECT doc_id, field, source, conf, rule, unnest(vs) AS value, generate_subscripts(vs, 1) AS k FROM c),
    n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, field, value) AS votes, count(*) OVER (PARTITION BY doc_id, field) AS candidates FROM x),
    s AS (SELECT *, least(1000, conf + CASE WHEN votes >= 2 THEN 80 ELSE 0 END + CASE WHEN votes >= 3 THEN 40 ELSE 0 END + CASE WHEN source = 'label' THEN 30 ELSE 0 END)::INT AS score FROM n),
    w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id, field ORDER BY score DESC, votes DESC, rule, k) = 1)"""

QUERIES = {f.__name__: f for f in (candidate_vote, extraction_audit, page_fields, text_blocks, page_round_trip, link_extract, station_walks)}

SQL = {
    "text_blocks": r"""SELECT doc_id, len(l) AS blocks FROM (SELECT doc_id, list_distinct(list_filter(list_transform(string_split(text, '<p>')[2:], lambda x: trim(regexp_replace(replace(regexp_replace(
            regexp_extract(x, '^(.*?)(?:</p>|$)', 1, 's'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '\s+', ' ', 'g'))), lambda x: x <> '' AND len(x) <= 1500)) AS l FROM documents WHERE contains(text, '<p>')) WHERE len(l) > 0""",
    "page_round_trip": r"""SELECT propertyId AS title, '/p/' || snapshotSeq AS next, CASE WHEN landAreaM2 > 0 AND NOT isnan(landAreaM2) THEN landAreaM2 END AS land, CASE WHEN buildingAreaM2 > 0 AND NOT isnan(buildingAreaM2) THEN buildingAreaM2 END AS building,
            CASE WHEN priceMan > 0 THEN priceMan::BIGINT * 10000 END AS price, nullif(regexp_replace(status, '^[\s　]+|[\s　]+$', '', 'g'), '') AS status, count(*) AS pages
        FROM (SELECT DISTINCT snapshotSeq, propertyId, status, landAreaM2, buildingAreaM2, priceMan FROM discovered_listings WHERE propertyId IS NOT NULL) GROUP BY ALL""",
    "candidate_vote": f"WITH {_C} SELECT doc_id, field, value, source, score, votes, candidates FROM w",
    "extraction_audit": f"""WITH {_C} SELECT field, CASE WHEN value IS NULL THEN 'missing' WHEN score < 900 THEN 'weak' ELSE 'found' END AS status, source AS method, count(*) AS n, coalesce(sum(candidates), 0)::BIGINT AS candidates
        FROM (SELECT doc_id, f.field FROM documents, (VALUES ('land'), ('price')) f(field)) LEFT JOIN w USING (doc_id, field) GROUP BY ALL""",
    "page_fields": f"""WITH {_C}, r AS (SELECT doc_id, max(value) FILTER (field = 'land') AS land, max(value) FILTER (field = 'price') AS price FROM w GROUP BY doc_id)
        SELECT doc_id, land, price, CASE WHEN price IS NULL THEN 'poor' WHEN land IS NULL THEN 'partial' ELSE 'good' END AS quality, CASE WHEN price IS NULL THEN 30 WHEN land IS NULL THEN 75 ELSE 100 END AS score,
        concat_ws(',', CASE WHEN land IS NULL THEN 'land' END, CASE WHEN price IS NULL THEN 'price' END) AS missing FROM r""",
    "link_extract": r"""WITH l AS (SELECT doc_id, unnest(u) AS url, generate_subscripts(u, 1) - 1 AS k FROM (SELECT doc_id, regexp_extract_all(text, 'https?://[\x21-\x7e]+') AS u FROM documents))
        SELECT doc_id, regexp_extract(url, '/([a-z]/[0-9]+)$', 1) AS pageKey, min(k)::INT AS position, arg_min(url, k) AS url FROM l GROUP BY doc_id, regexp_extract(url, '/([a-z]/[0-9]+)$', 1)""",
    "station_walks": r"""WITH m AS (SELECT unnest(regexp_extract_all(text, '([^\s　「」『』、。/（）()・]{1,12}駅[」』]?\s*(?:から|まで|より)?\s*(?:徒歩|歩)\s*(?:約)?\s*[0-9]{1,3}\s*分)', 1)) AS x FROM documents),
        w AS (SELECT regexp_extract(x, '^(.*?)駅', 1) AS station, try_cast(regexp_extract(x, '([0-9]{1,3})\s*分', 1) AS INT) AS minutes FROM m)
        SELECT station, count(*) AS mentions, min(minutes) AS shortest FROM w WHERE minutes BETWEEN 1 AND 120 AND station IN (SELECT targetStation FROM discovered_listings) GROUP BY station""",
}
