"""Postal addresses written differently: a gazetteer built from the addresses themselves, and beam search over it."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.plans.durable import write_table
from machiya.plans.parallel import evenly

#: A spelling joins another one of its locality when they are one edit apart and the other is so many times as frequent.
VARIANT_RATIO = 4
#: Share of a name's addresses that one misspelling of it has at most; a spelling with clearly more is a name of its own.
SLIP_SHARE = 0.04
#: Partial readings kept per step of the beam search.
BEAM = 24
#: Cost of a place that only one address text names: it is as likely a slip of another as a place.
SINGLE = 1.1
#: Gazetteer entries sent to the tasks at once; a larger gazetteer is searched in blocks of this size.
GAZETTEER_BLOCK = 50_000
#: Share of a town's addresses with a 丁目 from which its house numbers have three parts.
CHOME_SHARE = 0.3

# Words of a business address, notes after an address, letters that are written for one another.
_BUSINESS = re.compile(r"営業所|営業部|営業課|センター|本店|支店|本社|支社|店舗|事務所|オフィス|株式会社|有限会社|不動産")
_FLOOR = re.compile(r"[0-9]+\s*(?:F|階)", re.IGNORECASE)
_NOTE = re.compile(r"\([^()]*\)|【[^【】]*】|\[[^\[\]]*\]|付近|周辺図あり|周辺|近辺|他[0-9]+筆|ほか[0-9]+筆|外[0-9]+筆|地図")
_LABEL = re.compile(r"^(?:所在地?|住所|物件所在地|場所|アドレス|address)\s*[::]\s*", re.IGNORECASE)
_POSTCODE = re.compile(r"〒?\s*[0-9]{3}\s*[-‐–ー−]\s*[0-9]{4}(?=\D|$)(?!\s*[-‐–ー−])")
_DASHES = str.maketrans({c: "-" for c in "‐‑‒–—―−ー－ｰ─━"})
_SAME = str.maketrans({"ヶ": "ケ", "ヵ": "ケ", "が": "ケ", "ガ": "ケ", "か": "ケ", "カ": "ケ", "け": "ケ", "の": "ノ", "之": "ノ", "乃": "ノ", "ツ": "ツ", "ッ": "ツ", "つ": "ツ", "っ": "ツ", "澤": "沢", "濱": "浜", "邊": "辺", "櫻": "桜", "條": "条", "瀧": "滝", "嶋": "島"})
_EMPTY = {"", "-", "不明", "なし", "未定", "null", "none", "n/a"}
_KANJI = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
_KANJI_NUMBER = re.compile(r"[〇零一二三四五六七八九十百千]+(?=\s*(?:丁目|番地|番(?!町)|号))|(?<=[0-9丁目番地のノ号-])[〇零一二三四五六七八九十百千]+(?=$|[-のノ\s,])")
_NUMBER_START = re.compile(r"[0-9]+\s*(?:丁目|番|号|の|ノ|-|$|,|\s)|[0-9]+")


def _kanji_value(word: str) -> str:
    if not re.search("[十百千]", word):
        return "".join(str(_KANJI[c]) for c in word)
    total, digit = 0, None
    for ch in word:
        if ch in _KANJI:
            digit = _KANJI[ch]
        else:
            total += (1 if digit is None else digit) * {"十": 10, "百": 100, "千": 1000}[ch]
            digit = None
    return str(total + (digit or 0))


def split_address(text: str | None) -> tuple[str, list[int], bool] | None:
    """(name, numbers, has 丁目) of an address; None for placeholders and business addresses.

    The name is everything before the house number with spellings folded; an address written from small to large,
    with commas, is turned round.  Kanji numerals count as numbers only where a number's unit or a dash is beside them,
    so place names keep theirs.
    """
    if text is None:
        return None
    s = unicodedata.normalize("NFKC", text).strip()
    if s.lower() in _EMPTY:
        return None
    s = _POSTCODE.sub("", _LABEL.sub("", s))
    if _BUSINESS.search(s) and (_FLOOR.search(s) or re.search(r"[0-9]\D*(?:" + _BUSINESS.pattern + ")", s)):
        return None
    s = _NOTE.sub("", s).translate(_DASHES).strip(" 、,。")
    if "," in s or "、" in s:
        parts = [p.strip() for p in re.split(r"[,、]", s) if p.strip()]
        first = re.match(r"^([0-9〇零一二三四五六七八九十百千丁目番地号のノ\s-]+?)\s+([^0-9丁番地号のノ\s-].*)$", parts[0])
        if first and re.match(r"[0-9〇零一二三四五六七八九十百千]", first.group(1)):
            s = "".join(reversed(parts[1:])) + first.group(2) + first.group(1)
        else:
            s = "".join(reversed(parts)) if len(parts) > 1 and re.search(r"[都道府県]$", parts[-1]) else "".join(parts)
    s = re.sub(r"\s+", "", s)
    s = _KANJI_NUMBER.sub(lambda m: _kanji_value(m.group()), s)
    s = _KANJI_NUMBER.sub(lambda m: _kanji_value(m.group()), s)
    at = re.search(r"[0-9]", s)
    name, rest = (s, "") if at is None else (s[: at.start()], s[at.start() :])
    chome = re.match(r"^([0-9]+)丁目", rest)
    block = re.match(r"^[0-9]+(?:(?:丁目|番地|番|号|地|[-のノ])+[0-9]+){0,3}", rest)
    numbers = [int(n) for n in re.findall(r"[0-9]+", block.group()) if len(n) <= 9] if block else []
    name = name.translate(_SAME).strip("-")
    name = re.sub(r"大字|(?<=[市区町村巾])字|^字", "", name)
    return name, numbers, chome is not None


def split_name(name: str) -> tuple[str, str, str]:
    """(prefecture, city, town) of a folded name by the usual endings; parts that are not there are empty."""
    m = re.match(r"^(.{2,3}[都道府県])?((?:.+?市(?:.+?区(?=.))?)|(?:.+?郡.+?[町村])|(?:.+?区(?=.)))?(.*)$", name)
    return m.group(1) or "", m.group(2) or "", m.group(3) or ""


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, or ``most + 1`` when it is larger than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


class Gazetteer:
    """Prefectures, cities and towns for the beam search, indexed by the first two characters of their names."""

    def __init__(self, rows: Sequence[tuple[str, str, str, int]]):
        self.count = {r[:3]: r[3] for r in rows}
        self.prefectures = {r[0] for r in rows if r[0]}
        self.cities: dict[str, set[tuple[str, str]]] = defaultdict(set)
        self.towns: dict[str, set[tuple[str, str, str]]] = defaultdict(set)
        self.inside: dict[tuple[str, str], set[tuple[str, str, str]]] = defaultdict(set)
        for p, c, t, _ in rows:
            for ch in set(c[:2]):
                self.cities[ch].add((p, c))
            for ch in set(t[:2]):
                self.towns[ch].add((p, c, t))
            self.inside[p, c].add((p, c, t))

    def resolve(self, name: str) -> list[tuple[str, float]]:
        """The places a name may mean, cheapest first: (place, cost), each part spelled with at most one edit.

        Beam search over the levels: prefecture (may be missing), city (may be missing), town (must end the name).
        """
        # a partial reading: (cost, position, prefecture or '', city or None)
        beam = [(0.2, 0, "", None)]
        for p in self.prefectures:
            for n in (len(p) - 1, len(p), len(p) + 1):
                d = edits(name[:n], p, 1)
                if d <= 1 and n > 1:
                    beam.append((float(d), n, p, None))
        beam = sorted(beam, key=lambda b: b[0])[:BEAM]
        nxt = []
        for cost, at, p, _ in beam:
            nxt.append((cost + 0.4, at, p, None))
            near = self.cities.get(name[at : at + 1], set()) | self.cities.get(name[at + 1 : at + 2], set())
            for q, c in near:
                if p and q != p:
                    continue
                for n in (len(c) - 1, len(c), len(c) + 1):
                    d = edits(name[at : at + n], c, 1)
                    if d <= 1:
                        nxt.append((cost + d, at + n, q, (q, c)))
        beam = sorted(nxt, key=lambda b: b[0])[: 4 * BEAM]
        found: dict[str, float] = {}
        for cost, at, p, city in beam:
            rest = name[at:]
            if len(rest) < 1:
                continue
            near = self.inside[city] if city else self.towns.get(rest[:1], set()) | self.towns.get(rest[1:2], set())
            for entry in near:
                if p and entry[0] != p:
                    continue
                d = edits(rest, entry[2], 1 if len(entry[2]) > 2 else 0)
                if d <= 1 and not (d and len(entry[2]) <= 2):
                    key = "/".join(entry)
                    slip = SINGLE if self.count[entry] == 1 else 0.0
                    found[key] = min(found.get(key, 99.0), cost + d + slip)
        best = min(found.values(), default=0.0)
        return sorted((f for f in found.items() if f[1] <= best + 0.01), key=lambda f: (f[1], f[0]))


def parsed_addresses(texts: DataFrame, text: str) -> DataFrame:
    """(text, name, prefecture, city, town, numbers, chome) of each distinct address text that names a place."""
    schema = "text string, name string, prefecture string, city string, town string, numbers array<bigint>, chome boolean"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch["text"]:
                got = split_address(t)
                if got and (got[0] or got[1]):
                    rows.append((t, got[0], *split_name(got[0]), got[1], got[2]))
            yield pd.DataFrame(rows, columns=["text", "name", "prefecture", "city", "town", "numbers", "chome"])

    return evenly(texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct(), "text").mapInPandas(parse, schema)


def _deletions(name: Column) -> Column:
    """A name and all names that lack one of its characters; two names one edit apart share one of them."""
    return F.array_distinct(F.concat(F.array(name), F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))))))


def _canonical(spellings: DataFrame, within: list[str], name: str) -> DataFrame:
    """(within, name, canonical): each spelling with the frequent spelling of its locality that it is a variant of.

    A variant is at most as frequent as slips of the other are; neighbouring names that are only rarer stay apart.

    ``spellings`` has (within, name, n).  Pairs come from shared deletions, so none are compared but near ones.
    """
    keyed = spellings.where(F.length(name) >= 3).select(*within, name, "n", F.explode(_deletions(F.col(name))).alias("d"))
    other = keyed.select(*[F.col(w).alias(f"_{w}") for w in within], F.col(name).alias("_name"), F.col("n").alias("_n"), F.col("d").alias("_d"))
    # as many as slips bring, and two deviations; a single one is never too many
    slips = F.greatest(F.lit(1.0), SLIP_SHARE * F.col("_n") + 2 * F.sqrt(SLIP_SHARE * F.col("_n")))
    on = (F.col("d") == F.col("_d")) & (F.col("_n") >= VARIANT_RATIO * F.col("n")) & (F.col("n") <= slips)
    for w in within:
        on = on & (F.col(w) == F.col(f"_{w}"))
    near = keyed.join(other, on).groupBy(*within, name).agg(F.max(F.struct("_n", "_name")).getField("_name").alias("canonical"))
    return spellings.join(near, [*within, name], "left").select(*within, name, "n", F.coalesce("canonical", name).alias("canonical"))


def _canonical_prefectures(counted: DataFrame) -> DataFrame:
    """(prefecture, _prefecture): spellings one edit from a far more frequent prefecture that has the cities of most of their texts.

    ``counted`` has (prefecture, city, n).  A rare prefecture with cities of its own stays.
    """
    cities = counted.groupBy("prefecture", "city").agg(F.sum("n").alias("cn"))
    names = cities.groupBy("prefecture").agg(F.sum("cn").alias("n"))
    keyed = names.select("prefecture", "n", F.explode(_deletions(F.col("prefecture"))).alias("d"))
    other = keyed.select(F.col("prefecture").alias("_prefecture"), F.col("n").alias("_n"), "d")
    near = keyed.join(other, "d").where(F.col("_n") >= VARIANT_RATIO * F.col("n")).select("prefecture", "n", "_prefecture", "_n").distinct()
    known = cities.select(F.col("prefecture").alias("_prefecture"), "city")
    shared = near.join(cities, "prefecture").join(known, ["_prefecture", "city"]).groupBy("prefecture", "n", "_prefecture", "_n").agg(F.sum("cn").alias("shared")).where("shared * 2 > n")
    return shared.groupBy("prefecture").agg(F.max(F.struct("_n", "_prefecture")).getField("_prefecture").alias("_prefecture"))


def gazetteer(parsed: DataFrame) -> DataFrame:
    """(prefecture, city, town, n, chome_share): the places that addresses with all three parts name.

    Counts are over distinct address texts.  A prefecture is folded into another only as its misspelling, however rare
    it is.  City spellings are clustered within prefectures, then town spellings
    within localities; a rare spelling one edit from a frequent one is a variant of it.
    """
    full = parsed.where("prefecture <> '' and city <> '' and town <> ''")
    sums = [F.sum(c).alias(c) for c in ("n", "c", "m")]
    # written, since each is read several times; they have one row per place
    counted = write_table(full.groupBy("prefecture", "city", "town").agg(F.count("*").alias("n"), F.count_if(F.col("chome") | (F.size("numbers") >= 3)).alias("c"), F.count_if(F.size("numbers") >= 1).alias("m")), "counted").df
    prefectures = write_table(_canonical_prefectures(counted), "prefectures").df
    folded = write_table(counted.join(prefectures, "prefecture", "left").groupBy(F.coalesce("_prefecture", "prefecture").alias("prefecture"), "city", "town").agg(*sums), "folded").df
    cities = write_table(_canonical(folded.groupBy("prefecture", "city").agg(F.sum("n").alias("n")), ["prefecture"], "city").select("prefecture", "city", F.col("canonical").alias("_city")), "cities").df
    located = write_table(folded.join(cities, ["prefecture", "city"]).groupBy("prefecture", F.col("_city").alias("city"), "town").agg(*sums), "towns").df
    towns = _canonical(located.select("prefecture", "city", "town", "n"), ["prefecture", "city"], "town").select("prefecture", "city", "town", F.col("canonical").alias("_town"))
    out = located.join(towns, ["prefecture", "city", "town"]).groupBy("prefecture", "city", F.col("_town").alias("town")).agg(*sums)
    return out.select("prefecture", "city", "town", "n", (F.col("c") / F.greatest("m", F.lit(1))).alias("chome_share"))


def resolved_names(names: DataFrame, places: DataFrame) -> DataFrame:
    """(name, place, cost) for each distinct folded name: the cheapest places it may mean, several if they tie.

    The gazetteer is sent to the tasks in blocks of at most ``GAZETTEER_BLOCK`` entries, cut along prefectures and
    cities by their sorted order; one block holds all real ones.  The cheapest places over all blocks stay.
    """
    rows = places.select("prefecture", "city", "town", "n").orderBy("prefecture", "city", "town")
    out = None
    total = places.count()
    numbered = rows if total <= GAZETTEER_BLOCK else rows.withColumn("_block", F.pmod(F.xxhash64("prefecture", "city"), F.lit(-(-total // GAZETTEER_BLOCK))))
    for b in range(max(1, -(-total // GAZETTEER_BLOCK))):
        part = rows if total <= GAZETTEER_BLOCK else numbered.where(F.col("_block") == b).drop("_block")
        shared = names.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known = Gazetteer(shared.value)
            for batch in batches:
                got = [(n, place, cost) for n in batch["name"] for place, cost in known.resolve(n)]
                yield pd.DataFrame(got, columns=["name", "place", "cost"])

        found = names.mapInPandas(search, "name string, place string, cost double")
        out = found if out is None else out.unionByName(found)
    if total > GAZETTEER_BLOCK:
        best = out.groupBy("name").agg(F.min("cost").alias("best"))
        out = out.join(best, "name").where("cost <= best + 0.01").drop("best")
    return out


def located_addresses(texts: DataFrame, text: str, places: DataFrame, parsed: DataFrame) -> DataFrame:
    """(text, place, cost, number, district): each address text with the places it may mean and its house number, if complete.

    Where houses are numbered by 丁目-番-号 only three numbers are complete; elsewhere the first is the 番地 and the second
    its branch.  ``district`` is the 丁目 where there are any, even of an incomplete number.
    """
    names = parsed.where("name <> ''").select("name").distinct()
    found = write_table(resolved_names(evenly(names, "name"), places), "names").df
    style = places.select(F.concat_ws("/", "prefecture", "city", "town").alias("_place"), "chome_share")
    joined = parsed.join(found, "name").join(style, F.col("place") == F.col("_place"))
    n = F.col("numbers")
    three = F.when(F.size(n) >= 3, F.concat_ws("-", F.slice(n, 1, 3).cast("array<string>")))
    other = F.when((F.size(n).between(1, 2)) & ~F.col("chome"), F.concat_ws("-", n.cast("array<string>"))).when((F.size(n) >= 3), three)
    number = F.when(F.col("chome_share") >= CHOME_SHARE, three).otherwise(other)
    district = F.when((F.col("chome_share") >= CHOME_SHARE) & (F.size(n) >= 1), n[0])
    return joined.select("text", "place", "cost", number.alias("number"), district.alias("district"))


def located_records(df: DataFrame, key: str, fields: Sequence[str], located: DataFrame) -> DataFrame:
    """(key, place, numbers, district): where each record is, by all its address texts together.

    Texts vote for their places, cheap readings more than dear ones; the place with most votes wins, and a tie leaves
    the record without one.  ``numbers`` are the house numbers that its texts give at that place, sorted; none, one, or
    several if they disagree; ``district`` is their 丁目 if all that state one agree.
    """
    cells = F.explode(F.array(*[F.col(f) for f in fields])).alias("text")
    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), cells).where("text is not null").distinct()
    votes = texts.join(located, "text").groupBy("key", "place").agg(
        F.sum(F.lit(4.0) - F.col("cost")).alias("votes"), F.sort_array(F.collect_set("number")).alias("numbers"), F.max(F.col("number").isNotNull()).alias("has"), F.when(F.min("district") == F.max("district"), F.min("district")).alias("district")
    )
    order = Window.partitionBy("key").orderBy(F.desc("votes"), F.desc("has"))
    ranked = votes.withColumn("rank", F.rank().over(order))
    alone = ranked.where("rank = 1").withColumn("ties", F.count("*").over(Window.partitionBy("key")))
    return alone.where("ties = 1").select(F.col("key").alias(key), "place", "numbers", "district")


def houses_by_address(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, place, number): records whose address fields place them at a house number, one row per number they give."""
    cells = F.explode(F.array(*[F.col(f) for f in fields])).alias("text")
    texts = df.select(cells)
    parsed = write_table(parsed_addresses(texts, "text"), "addresses").df
    places = write_table(gazetteer(parsed), "gazetteer").df
    located = located_addresses(texts, "text", places, parsed)
    return located_records(df, key, fields, located).select(key, "place", F.explode("numbers").alias("number"))


def same_house_number(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(propertyId1, propertyId2): all pairs of records at one house number, smaller key first.

    The pairs are the result, so their number is the sum of squares of the records per house number; the join is on
    place and number, and a crowded number's pairs are split among tasks by the hash of one side.
    """
    at = write_table(houses_by_address(df, key, fields).distinct(), "houses").df
    salts = 16
    left = at.select(F.col(key).alias("propertyId1"), "place", "number", F.pmod(F.xxhash64(key), F.lit(salts)).alias("salt"))
    crowded = at.groupBy("place", "number").agg(F.count("*").alias("size")).where("size > 1")
    right = at.join(crowded, ["place", "number"]).select(F.col(key).alias("propertyId2"), "place", "number", F.explode(F.when(F.col("size") > 1000, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(-1)))).alias("salt"))
    left = left.join(crowded, ["place", "number"]).withColumn("salt", F.when(F.col("size") > 1000, F.col("salt")).otherwise(F.lit(-1)))
    pairs = left.join(right, ["place", "number", "salt"]).where("propertyId1 < propertyId2")
    return pairs.select("propertyId1", "propertyId2").distinct()
