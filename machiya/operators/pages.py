"""Evidence from page markup: label and value pairs, links, structured data, meta, blocks; votes, audits, records.

The markup is read once per page by the standard library's parser, in Arrow batches; all later steps are DataFrame
operators over the long evidence table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EVIDENCE = "page_id string, kind string, ordinal int, label string, value string"
#: Elements without an end tag; elements whose text is dropped; those that make text blocks; longest block.
VOID = {"br", "img", "input", "meta", "link", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}
DROPPED = {"script", "style", "noscript", "template", "iframe", "svg"}
# Elements that make text blocks, in the order in which equal blocks are taken.
BLOCKS = ("h1", "h2", "h3", "h4", "p", "li", "td", "th", "dt", "dd", "div", "span")
LONGEST_BLOCK = 1500
# Class or id words of sections about the seller, not about the page's own subject.
EXCLUDED = ("shop", "company", "tenpo", "store", "inquiry")
#: What opening one element closes, if it is open.
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Node:
    """An element: tag, attributes, and children that are nodes or texts."""

    __slots__ = ("attributes", "children", "excluded", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], excluded: bool):
        self.tag, self.attributes, self.excluded = tag, attributes, excluded
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def text(self) -> str:
        parts = [c if isinstance(c, str) else c.text() for c in self.children if isinstance(c, str) or c.tag not in DROPPED]
        return " ".join(" ".join(parts).split())


class _Tree(HTMLParser):
    def __init__(self, excluded: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.words = [w.lower() for w in excluded]
        self.root = Node("", {}, False)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        attributes = {k.lower(): v or "" for k, v in attrs}
        while len(self.open) > 1 and self.open[-1].tag in _CLOSES.get(tag, ()):
            self.open.pop()
        marks = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
        node = Node(tag, attributes, self.open[-1].excluded or tag in DROPPED or any(w in marks for w in self.words))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str, excluded: Sequence[str] = EXCLUDED) -> Node:
    """The tree of a page; sections whose class or id has an excluded word are marked.  Broken markup never fails, unclosed elements end with their parent."""
    tree = _Tree(excluded)
    tree.feed(html)
    tree.close()
    return tree.root


def read_page(html: str, excluded: Sequence[str] = EXCLUDED) -> list[tuple[str, int, str, str]]:
    """(kind, ordinal, label, value) of a page: pair_table, pair_list, link, json_ld, meta, block, title, text."""
    root = parse(html, excluded)
    out: list[tuple[str, str, str]] = []
    blocks: dict[str, dict[str, None]] = {t: {} for t in BLOCKS}
    for node in root.walk():
        if node.tag == "title" and node.text():
            out.append(("title", "", node.text()))
        if node.tag == "meta":
            name = node.attributes.get("name") or node.attributes.get("property") or node.attributes.get("itemprop")
            if name and node.attributes.get("content"):
                out.append(("meta", name.lower(), " ".join(node.attributes["content"].split())))
        if node.tag == "script" and "ld+json" in node.attributes.get("type", "").lower():
            try:
                data = json.loads("".join(c for c in node.children if isinstance(c, str)))
            except ValueError:
                data = None
            for x in data if isinstance(data, list) else [data]:
                if isinstance(x, dict):
                    out.append(("json_ld", str(x.get("@type", "")), json.dumps(x, ensure_ascii=False, sort_keys=True)))
        if node.tag == "a" and node.attributes.get("href"):
            rel = "next" if "next" in node.attributes.get("rel", "") else " ".join(filter(None, (node.text(), node.attributes.get("aria-label"), node.attributes.get("title"))))
            out.append(("link", rel, node.attributes["href"]))
        if node.excluded:
            continue
        if node.tag == "tr":
            cells = [c for c in node.walk() if c.tag in ("th", "td") and c.text()]
            for a, b in zip(cells, cells[1:]):
                if a.tag == "th" and b.tag == "td":
                    out.append(("pair_table", a.text(), b.text()))
        if node.tag == "dl":
            items = [c for c in node.children if isinstance(c, Node) and c.tag in ("dt", "dd")]
            for a, b in zip(items, items[1:]):
                if a.tag == "dt" and b.tag == "dd" and a.text() and b.text():
                    out.append(("pair_list", a.text(), b.text()))
        if node.tag in blocks:
            t = node.text()
            if t and len(t) <= LONGEST_BLOCK:
                blocks[node.tag][t] = None
    seen: set[str] = set()
    for tag in BLOCKS:
        for t in blocks[tag]:
            if t not in seen:
                seen.add(t)
                out.append(("block", tag, t))
    out.append(("text", "", root.text()))
    return [(kind, i, label, value) for i, (kind, label, value) in enumerate(out)]


def page_evidence(pages: DataFrame, key: str, html: str, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """The evidence table (page_id, kind, ordinal, label, value) of all pages; null and empty pages give no rows.

    Pairs and blocks of sections with an ``excluded`` class or id word, and of what they hold, are left out.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *r) for i, h in zip(batch["page_id"], batch["html"]) for r in read_page(h, excluded)]
            yield pd.DataFrame(rows, columns=["page_id", "kind", "ordinal", "label", "value"])

    return pages.where(F.col(html).isNotNull() & (F.col(html) != "")).select(F.col(key).cast("string").alias("page_id"), F.col(html).alias("html")).mapInPandas(read, EVIDENCE)


def next_page(evidence: DataFrame) -> DataFrame:
    """(page_id, next): the address of the next page: a link marked next, else one whose words say so."""
    said = F.col("label").contains("次へ") | F.col("label").contains("次のページ")
    rank = F.when(F.col("label") == "next", 0).when(said, 1)
    found = evidence.where("kind = 'link'").withColumn("_r", rank).where("_r is not null")
    return found.groupBy("page_id").agg(F.min_by("value", F.struct("_r", "ordinal")).alias("next"))


def field_candidates(evidence: DataFrame, rules: Sequence[tuple[str, str, str, str, float, Column]]) -> DataFrame:
    """(page_id, field, value, source, confidence, ordinal) by rules (field, kind, label pattern, source, confidence, value).

    A rule applies to evidence of its kind whose label matches; candidates without a value are dropped.
    """
    cells = [F.when((F.col("kind") == kind) & F.col("label").rlike(label), F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"))) for field, kind, label, source, confidence, value in rules]
    long = evidence.select("page_id", "ordinal", F.posexplode(F.array(*cells)).alias("rule", "c")).where("c is not null")
    return long.select("page_id", "c.*", (F.col("ordinal") * 1000 + F.col("rule")).alias("ordinal")).where("value is not null")


def vote(candidates: DataFrame, trusted: Sequence[str], key: str = "page_id") -> DataFrame:
    """(key, field, value, source, score, votes, candidates): the winning value of each field.

    Confidence in thousandths, plus 80 for a value seen twice, 40 more for three times, 30 for a trusted source, at most
    1000; then the number of votes; then the first candidate.
    """
    seen = F.count("*").over(Window.partitionBy(key, "field", "value"))
    scored = candidates.withColumn("votes", seen).withColumn("score", F.least(F.lit(1000), F.round(F.col("confidence") * 1000).cast("int") + F.when(F.col("votes") >= 2, 80).otherwise(0) + F.when(F.col("votes") >= 3, 40).otherwise(0) + F.when(F.col("source").isin(*trusted), 30).otherwise(0)))
    best = F.max_by(F.struct("value", "source", "score", "votes"), F.struct("score", "votes", -F.col("ordinal"))).alias("b")
    return scored.groupBy(key, "field").agg(best, F.count("*").alias("candidates")).select(key, "field", "b.*", "candidates")


def audit(winners: DataFrame, keys: DataFrame, fields: Sequence[str], weak_below: int = 700, key: str = "page_id") -> DataFrame:
    """(key, field, status, method, score, candidates) for every key and field: found, weak or missing."""
    wanted = keys.select(key).distinct().withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
    both = wanted.join(winners, [key, "field"], "left")
    status = F.when(F.col("value").isNull(), "missing").when(F.col("score") < weak_below, "weak").otherwise("found")
    return both.select(key, "field", status.alias("status"), F.col("source").alias("method"), "score", F.coalesce("candidates", F.lit(0)).alias("candidates"))


def records(winners: DataFrame, fields: Sequence[str], key: str = "page_id") -> DataFrame:
    """One row per key with a column per field, from the winners."""
    return winners.groupBy(key).pivot("field", list(fields)).agg(F.first("value"))


def quality(record: Mapping[str, Column], critical: Sequence[str]) -> Column:
    """Struct (quality, score, missing): poor without a critical field, good with all, else partial."""
    missing = F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in record.items()]))
    lacks = F.exists(missing, lambda m: m.isin(*critical))
    name = F.when(lacks, "poor").when(F.size(missing) > 0, "partial").otherwise("good")
    return F.struct(name.alias("quality"), F.when(lacks, 30).when(F.size(missing) > 0, 75).otherwise(100).alias("score"), missing.alias("missing"))


def merged_parses(parses: DataFrame, key: str, rank: Sequence[Column], fields: Sequence[str]) -> DataFrame:
    """One record per key from several parses of a page: values of the best parse, gaps filled from the others in order."""
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)])
    return parses.withColumn("_o", order).groupBy(key).agg(*[F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("_o"))).alias(f) for f in fields])


def station_access(c: Column, stations: Sequence[str] | None = None) -> Column:
    """Array of (station, minutes) for the walks of 1 to 120 minutes that a text states, from the given stations or any."""
    found = F.regexp_extract_all(c, F.lit(r"([^\s「」『』、。/（）()・]{1,12}駅[」』]?\s*(?:から|まで|より)?\s*(?:徒歩|歩)\s*(?:約)?\s*[0-9]{1,3}\s*分)"), 1)
    split = F.transform(found, lambda x: F.struct(F.regexp_extract(x, "^(.*?)駅", 1).alias("station"), F.regexp_extract(x, "([0-9]{1,3})\\s*分", 1).try_cast("int").alias("minutes")))
    return F.filter(split, lambda s: s["minutes"].between(1, 120) & (s["station"].isin(*stations) if stations else F.lit(True)))


def http_error_class(status: Column, timed_out: Column | None = None) -> Column:
    """Class of a failed request by its status, or by whether it timed out; null for a status that is no failure.

    A request without a status is a ``timeout`` if it timed out, else a ``network_error``.
    """
    late = F.coalesce(timed_out, F.lit(False)) if timed_out is not None else F.lit(False)
    names = {"forbidden": status.isin(401, 403), "not_found": status.isin(404, 410), "rate_limited": status == 429, "server_error": status.between(500, 599), "client_error": status.between(400, 499), "timeout": status.isNull() & late, "network_error": status.isNull()}
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in names.items()])


def retry_delay(attempt: Column, retry_after: Column, longest: float = 4.0, asked: tuple[float, float] = (0.5, 8.0)) -> Column:
    """Seconds to wait before another attempt: what the server asks for within bounds, else doubling up to ``longest``."""
    stated = F.when(retry_after.isNotNull(), F.greatest(F.least(retry_after.cast("double"), F.lit(asked[1])), F.lit(asked[0])))
    return F.coalesce(stated, F.least(F.pow(F.lit(2.0), attempt), F.lit(longest)))
