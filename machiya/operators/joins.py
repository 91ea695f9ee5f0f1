"""Joins: blocked pairs, comparables within bands, unique-key lookup, reconciliation, folding two tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.operators.bands import Sales
from machiya.plans.durable import write_table
from machiya.plans.skew import HOT_ROWS, HOT_SHARE, lookup_join


#: Width of the logarithmic classes on which sizes within a band meet.
CLASS_WIDTH = 0.25
#: Rows of one block that meet a whole block in one part; larger blocks are dealt to more parts.
BLOCK_PART = 1000
#: Sales and items that meet in one step of ``comparables``, about.
SALES_CHUNK, ITEMS_PART = 1 << 20, 1 << 15
#: Areas up to this number are broadcast or named; more are joined by their hash.
FEW_AREAS = 10_000


def _class(x: Column) -> Column:
    """Class of a positive size; null for others."""
    return F.when(x > 0, F.floor(F.log(x) / CLASS_WIDTH))


def _class_span(low: Column, high: Column) -> Column:
    """The classes that a range of positive sizes touches, one more on either side against rounding; null if unknown."""
    at = lambda x: F.floor(F.log(F.greatest(x, F.lit(1e-9))) / CLASS_WIDTH)
    return F.when(high > 0, F.sequence(at(low) - 1, at(high) + 1))


def blocked_pairs(df: DataFrame, key: str, block: Column, columns: Sequence[str], smallest: int = 2, largest: int | None = None) -> DataFrame:
    """Pairs (a, b) of rows of one block, smaller key first, for blocks within the size limits.

    Block sizes are counted before any pair is formed, so blocks beyond ``largest`` cost one counted row.  Null blocks
    have no pairs.  Rows should be unique by key.
    """
    rows = df.select(F.col(key).alias("k"), block.alias("block"), F.struct(*columns).alias("v")).where("block is not null")
    sizes = rows.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") >= smallest)
    if largest is not None:
        sizes = sizes.where(F.col("size") <= largest)
    kept = rows.join(sizes.select("block"), "block", "left_semi")
    a = kept.select("block", F.col("k").alias("a"), F.col("v").alias("va"))
    b = kept.select("block", F.col("k").alias("b"), F.col("v").alias("vb"))
    return a.join(b, "block").where("a < b").select("a", "b", "va", "vb")


def duplicate_pairs(df: DataFrame, key: str, address: Column, columns: Sequence[str], detailed: Column, smallest: int = 2, largest: int = 12, least: int = 6) -> DataFrame:
    """Pairs (a, b, va, vb, same) of rows that may be one house, smaller key first: the union of two blockings.

    Rows of one detailed address are all paired, however many they are; the rows of a large block are dealt to parts,
    each of which meets the whole block.  Rows of one locality (the address without digits and dashes, of at least
    ``least`` characters) are paired if one address contains the other and one is detailed, in localities of ``smallest``
    to ``largest`` rows.  ``same`` tells whether the addresses are equal; a pair that both find comes once.  Null
    addresses have no pairs.  Rows should be unique by key.
    """
    rows = df.select(F.col(key).alias("k"), address.alias("address"), F.coalesce(detailed, F.lit(False)).alias("detailed"), F.struct(*columns).alias("v")).where("address is not null")
    exact = rows.where("detailed")
    parts = exact.groupBy("address").agg(F.count("*").alias("size")).where("size > 1").select("address", F.ceil(F.col("size") / BLOCK_PART).cast("int").alias("parts"))
    dealt = exact.join(parts, "address")
    a = dealt.select("address", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int").alias("part"), F.col("k").alias("a"), F.col("v").alias("va"))
    b = dealt.select("address", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("k").alias("b"), F.col("v").alias("vb"))
    equal = a.join(b, ["address", "part"]).where("a < b").select("a", "b", "va", "vb", F.lit(True).alias("same"))

    near = rows.withColumn("block", F.regexp_replace("address", "[0-9-]", "")).where(F.length("block") >= least)
    found = blocked_pairs(near, "k", F.col("block"), ["address", "detailed", "v"], smallest, largest)
    x, y = F.col("va.address"), F.col("vb.address")
    # pairs of one detailed address are in the other blocking
    local = found.where((F.contains(x, y) | F.contains(y, x)) & (F.col("va.detailed") | F.col("vb.detailed")) & ~((x == y) & F.col("va.detailed")))
    return equal.unionByName(local.select("a", "b", F.col("va.v").alias("va"), F.col("vb.v").alias("vb"), (x == y).alias("same")))


def relative_difference(x: Column, y: Column) -> Column:
    """|x - y| / max(x, y); null if either is unknown or neither is positive."""
    return F.try_divide(F.abs(x - y), F.greatest(x, y))


def pair_score(parts: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the points, in hundredths, of the conditions that are true; unknown conditions give none."""
    return sum((F.when(c, F.lit(p)).otherwise(0) for c, p in parts), F.lit(0))


def _price_bounds(offered: DataFrame, places: DataFrame, most: int) -> DataFrame:
    """(b_area, bounds): prices that cut the sales of each area of ``places`` into its number of ``chunks``, about evenly."""
    cuts = F.percentile_approx("s_price", [j / most for j in range(1, most)], max(10_000, 100 * most))
    cut = offered.groupBy(F.col("s_area").alias("b_area")).agg(cuts.alias("cuts")).join(places, F.col("b_area") == F.col("at"))
    return cut.select("b_area", F.transform(F.sequence(F.lit(1), F.col("chunks") - 1), lambda j: F.element_at("cuts", F.floor(j * most / F.col("chunks")).cast("int"))).alias("bounds"))


def comparables(
    items: DataFrame, sales: DataFrame, area: str, item_columns: Mapping[str, str], sale_columns: Mapping[str, str], price: str, low: float, high: float, years: int, district: tuple[str, str] | None = None, fewest: int = 3
) -> DataFrame:
    """Each item with the number and median price of its comparable sales: (key, comparables, medianPrice, level).

    A sale is comparable in the same area if its sizes lie in ``low`` to ``high`` of the item's and its year within
    ``years``, where both are known; ``item_columns`` and ``sale_columns`` name ``key``, ``land``, ``building`` and
    ``year``.  Sizes that are NaN or not positive are unknown.  ``district`` names a column of items whose text must
    contain a column of sales: where at least ``fewest`` comparable sales are of the item's district they alone count
    (level ``district``), else all (``area``).

    Items are first reduced to their distinct characteristics, so equal ones are compared once.  No pair is formed: an
    item's comparable sales are the intersection of bitsets over sales in order of price (``bands.py``), 64 sales at a
    time, and the middle of them is looked up there.  An area of more than ``SALES_CHUNK`` sales is cut into chunks by
    price: there each item first counts its sales per chunk, and the price is looked up in the chunk that the counts
    tell to have the middle ranks.  A task holds one chunk of about ``SALES_CHUNK`` sales and at most about
    ``ITEMS_PART`` items, however many an area has.
    """
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = lambda names, k: F.col(names[k]).cast("double")
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    kinds = ("land", "building", "year")
    names = [f"i_{k}" for k in (*kinds, "district")]
    traits = ["area", *names]
    # null for unknown, as frames of Python know no difference to NaN
    usable = lambda k: F.when((number(item_columns, k) > 0 if k != "year" else F.lit(True)) & ~F.isnan(number(item_columns, k)), number(item_columns, k))
    each = write_table(items.select(F.col(item_columns["key"]).alias("key"), text(area).alias("area"), *[usable(k).alias(f"i_{k}") for k in kinds], text(district and district[0]).alias("i_district")), "items").df
    wanted = write_table(each.where("area is not null").select(*traits).distinct(), "wanted").df
    offered = sales.where(F.col(area).isNotNull()).select(
        text(area).alias("s_area"), F.col(price).cast("double").alias("s_price"), *[number(sale_columns, k).alias(f"s_{k}") for k in kinds], text(district and district[1]).alias("s_district")
    )
    # of each area that has both, numbered: its chunks of sales, and to how many parts its items are dealt
    parts = wanted.groupBy("area").agg(F.ceil(F.count("*") / ITEMS_PART).cast("int").alias("parts"))
    amounts = offered.groupBy(F.col("s_area").alias("at")).agg(F.count("*").alias("sales"))
    both = amounts.join(parts, F.col("at") == F.col("area")).select("at", "sales", F.ceil(F.col("sales") / SALES_CHUNK).cast("int").alias("chunks"), "parts")
    places = write_table(both.coalesce(1).withColumn("no", F.monotonically_increasing_id()), "places").df
    total, areas, most = places.agg(F.sum("sales"), F.count("*"), F.max("chunks")).first()
    large = [r[0] for r in places.where("chunks > 1").select("at").collect()]
    # few areas are named, so that the sales of others are not read
    of_large = offered.where(F.col("s_area").isin(large)) if len(large) <= FEW_AREAS else offered
    if large:
        bounds = _price_bounds(of_large, places.where("chunks > 1"), most)
        places = write_table(places.join(bounds, F.col("at") == F.col("b_area"), "left").drop("b_area"), "bounds").df
    hot = None if areas <= FEW_AREAS else [r[0] for r in places.where(F.col("sales") > max(HOT_ROWS, int(total * HOT_SHARE))).select("at").collect()]

    def placed(df: DataFrame, key: str, places: DataFrame) -> DataFrame:
        return df.join(F.broadcast(places), F.col(key) == F.col("at")) if hot is None else lookup_join(df, places, key, "at", "inner", hot=hot)

    def slot(chunk: Column, part: Column) -> Column:
        return F.col("no") * (1 << 40) + chunk.cast("bigint") * (1 << 20) + part

    def supply(offered: DataFrame, places: DataFrame):
        """The sales by slot: each chunk of an area comes once for each part of its items."""
        below = lambda f: F.size(F.filter("bounds", f))
        first, last = below(lambda x: x < F.col("s_price")), below(lambda x: x <= F.col("s_price"))
        # sales at a price that is a bound may be on either side of it
        chunk = F.when(F.col("chunks") > 1, first + F.pmod(F.xxhash64("s_land", "s_building", "s_year", "s_district"), last - first + 1)).otherwise(0) if large else F.lit(0)
        # sales without a price are left to ``Sales``: a filter here would read every price from its text twice
        dealt = placed(offered, "s_area", places).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return dealt.select(slot(chunk, F.col("part")).alias("slot"), "s_price", *[f"s_{k}" for k in (*kinds, "district")]).repartition(tasks, "slot").groupBy("slot")

    local = district is not None
    kept = "area string, i_land double, i_building double, i_year double, i_district string"

    def filled(these: pa.Table, columns: Sequence[str], more: Mapping[str, tuple[Sequence, pa.DataType]]) -> pa.Table:
        out = these.select(list(columns))
        for name, (values, kind) in more.items():
            out = out.append_column(name, pa.array(values, kind))
        return out

    def count(these: pa.Table, those: pa.Table) -> pa.Table:
        n = these.num_rows if those.num_rows else 0
        these = these.slice(0, n)
        alone = n > 0 and these.column("chunks")[0].as_py() == 1
        every, own, prices = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full((2, n), np.nan)
        for at, met, near in Sales(those).met(these, low, high, years) if n else ():
            every[at], own[at] = met.n, near.n if near else 0
            if alone and met.n:
                of = near if local and near and near.n >= fewest else met
                prices[0, at], prices[1, at] = of.price_at(((of.n - 1) // 2, of.n // 2))
        out = filled(these, [*traits, "slot", "chunks"], {"all": (every, pa.int64()), "own": (own, pa.int64()), "lowPrice": (prices[0], pa.float64()), "highPrice": (prices[1], pa.float64())})
        return out.filter(pa.array(every > 0))

    def look_up(these: pa.Table, those: pa.Table) -> pa.Table:
        n = these.num_rows if those.num_rows else 0
        these = these.slice(0, n)
        by_district, lower, upper = (these.column(c).to_pylist() for c in ("local", "lower", "upper"))
        prices = [(None, None)] * n
        for at, met, near in Sales(those).met(these, low, high, years) if n else ():
            for k in at.tolist():
                prices[k] = (near if by_district[k] else met).price_at((lower[k], upper[k]))
        return filled(these, [*traits, "local", "n"], {"lowPrice": ([p[0] for p in prices], pa.float64()), "highPrice": ([p[1] for p in prices], pa.float64())})

    dealt = placed(wanted, "area", places.drop("bounds")).select(*traits, "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.xxhash64(*names), F.col("parts")).alias("part"), "no")
    dealt = dealt.select(*traits, "chunks", slot(F.col("chunk"), F.col("part")).alias("slot")).repartition(tasks, "slot")
    counted = dealt.groupBy("slot").cogroup(supply(offered, places)).applyInArrow(count, f"{kept}, slot bigint, chunks int, all bigint, own bigint, lowPrice double, highPrice double")
    if large:
        counted = write_table(counted, "counted").df
    found = counted.withColumn("local", F.col("own") >= fewest if local else F.lit(False)).withColumn("n", F.when(F.col("local"), F.col("own")).otherwise(F.col("all")))
    found = found.where("chunks = 1").select(*traits, "local", "n", "lowPrice", "highPrice")
    if large:
        item = Window.partitionBy(*traits)
        before = item.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.where("chunks > 1").withColumn("local", F.sum("own").over(item) >= fewest if local else F.lit(False)).withColumn("here", F.when(F.col("local"), F.col("own")).otherwise(F.col("all")))
        counted = counted.withColumns({"n": F.sum("here").over(item), "before": F.coalesce(F.sum("here").over(before), F.lit(0))})
        place = lambda rank: F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("here")), rank - F.col("before")).otherwise(-1)
        ranked = counted.withColumns({"lower": place(F.floor((F.col("n") - 1) / 2)), "upper": place(F.floor(F.col("n") / 2))}).where("lower >= 0 or upper >= 0")
        ranked = ranked.select(*traits, "slot", "local", "n", "lower", "upper").repartition(tasks, "slot")
        middle = ranked.groupBy("slot").cogroup(supply(of_large, places.where("chunks > 1"))).applyInArrow(look_up, f"{kept}, local boolean, n bigint, lowPrice double, highPrice double")
        # the two middle ranks may lie in two chunks
        found = found.unionByName(middle.groupBy(*traits).agg(F.max("local").alias("local"), F.max("n").alias("n"), F.max("lowPrice").alias("lowPrice"), F.max("highPrice").alias("highPrice")))
    found = found.withColumn("median", F.col("lowPrice") * 0.5 + F.col("highPrice") * 0.5).withColumnsRenamed({t: f"_{t}" for t in traits})
    same = F.col("area") == F.col("_area")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_{n}"))
    return each.join(found, same, "left").select("key", F.coalesce("n", F.lit(0)).alias("comparables"), F.col("median").alias("medianPrice"), F.when(F.col("local"), "district").otherwise("area").alias("level"))


def similar_rows(df: DataFrame, key: str, area: str, price: str, land: str, price_share: float, price_least: float, land_share: float, land_least: float) -> DataFrame:
    """(key, similar, medianPrice): for each priced row the other rows of its area with a near price and, if known, near land.

    Near is within ``share`` of the row's own value, or ``least`` if that is more.  Rows are reduced to their distinct
    area, price and land with counts, and meet on logarithmic classes of the price, so only rows of near prices are
    compared; a row itself is taken out of the count of its own characteristics.  Rows without an area or a positive price
    are similar to none and get 0.  Rows should be unique by key.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("k"), F.col(area).alias("a"), F.when(F.col(price) > 0, F.col(price).cast("double")).alias("p"), F.when(F.col(land) > 0, F.col(land).cast("double")).alias("l"))
    traits = rows.where("a is not null and p is not null").groupBy("a", "p", "l").agg(F.count("*").alias("n"))
    reach = F.greatest(F.col("p") * price_share, F.lit(price_least))
    left = traits.withColumn("class", F.explode(_class_span(F.col("p") - reach, F.col("p") + reach))).repartition(tasks, "a", "class")
    right = traits.select(F.col("a").alias("ya"), F.col("p").alias("yp"), F.col("l").alias("yl"), F.col("n").alias("yn"), _class(F.col("p")).alias("yclass")).repartition(tasks, "ya", "yclass")
    land_near = F.coalesce(F.abs(F.col("yl") - F.col("l")) <= F.greatest(F.lit(land_least), F.col("l") * land_share), F.lit(True))
    met = left.join(right, (F.col("a") == F.col("ya")) & (F.col("class") == F.col("yclass")) & (F.abs(F.col("yp") - F.col("p")) <= reach) & land_near)
    own = (F.col("yp") == F.col("p")) & F.col("yl").eqNullSafe(F.col("l"))
    prices = met.groupBy("a", "p", "l", "yp").agg(F.sum(F.col("yn") - own.cast("int")).alias("w")).where("w > 0")
    found = prices.groupBy("a", "p", "l").agg(F.sum("w").alias("similar"), F.percentile("yp", F.lit(0.5), F.col("w")).alias("medianPrice")).select(F.col("a").alias("fa"), F.col("p").alias("fp"), F.col("l").alias("fl"), "similar", "medianPrice")
    out = rows.join(found, (F.col("a") == F.col("fa")) & (F.col("p") == F.col("fp")) & F.col("l").eqNullSafe(F.col("fl")), "left")
    return out.select(F.col("k").alias(key), F.coalesce("similar", F.lit(0)).alias("similar"), "medianPrice")


def unique_key_lookup(left: DataFrame, right: DataFrame, identity: str, left_keys: Sequence[Column], right_keys: Sequence[Column], value: str, skip_ambiguous: bool = True) -> DataFrame:
    """(identity, value, rank): each left row with the right row of its first key that names exactly one.

    Keys are tried in order; one that several right rows have is passed over, or ends the search without a match if not
    ``skip_ambiguous``.  Rows without a match have nulls.
    """
    keyed = lambda df, keys, keep: df.select(*keep, F.posexplode(F.array(*[k.cast("string") for k in keys])).alias("rank", "key")).where("key is not null and key <> ''")
    r = keyed(right, right_keys, [F.col(value).alias("_value")]).groupBy("rank", "key").agg(F.count("*").alias("_n"), F.min("_value").alias("_value"))
    hits = keyed(left, left_keys, [F.col(identity).alias("_id")]).join(r, ["rank", "key"])
    if skip_ambiguous:
        hits = hits.where("_n = 1")
    first = hits.groupBy("_id").agg(F.min(F.struct("rank", F.when(F.col("_n") == 1, F.col("_value")).alias("value"))).alias("m"))
    return left.select(F.col(identity).alias("_l")).join(first, F.col("_l") == F.col("_id"), "left").select(F.col("_l").alias(identity), F.col("m.value").alias("value"), F.when(F.col("m.value").isNotNull(), F.col("m.rank")).alias("rank"))


def reconcile(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, left, right, outcome) over all keys of two tables, one row per key each: agree, conflict or missing a side."""
    a = left.select(F.col(key).alias("_a"), F.col(value).alias("leftValue"), F.lit(True).alias("_in_a"))
    b = right.select(F.col(key).alias("_b"), F.col(value).alias("rightValue"), F.lit(True).alias("_in_b"))
    both = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    outcome = (
        F.when(F.col("_in_a").isNull(), "only_right").when(F.col("_in_b").isNull(), "only_left")
        .when(F.col("leftValue").isNull() & F.col("rightValue").isNull(), "both_missing")
        .when(F.col("leftValue").isNull(), "left_missing").when(F.col("rightValue").isNull(), "right_missing")
        .when(F.col("leftValue") == F.col("rightValue"), "agree").otherwise("conflict")
    )
    return both.select(F.coalesce("_a", "_b").alias(key), "leftValue", "rightValue", outcome.alias("outcome"))


def fold_two(left: DataFrame, right: DataFrame, key: str, missing: Column, columns: Sequence[str]) -> DataFrame:
    """One row per key of two tables: the side with fewer missing values supplies its non-null values, the other fills.

    ``missing`` counts a row's missing values; ties go to ``left``.
    """
    a = left.select(F.col(key).alias("_a"), missing.alias("_ma"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = right.select(F.col(key).alias("_b"), missing.alias("_mb"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    right_first = F.col("_ma").isNull() | F.coalesce(F.col("_mb") < F.col("_ma"), F.lit(False))
    return both.select(F.coalesce("_a", "_b").alias(key), *[F.when(right_first, F.coalesce(f"_b_{c}", f"_a_{c}")).otherwise(F.coalesce(f"_a_{c}", f"_b_{c}")).alias(c) for c in columns])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def examples(df: DataFrame, category: str, order: Sequence[Column], most: int) -> DataFrame:
    """At most so many rows per category, by ``order``: a report of examples, with their position."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(category).orderBy(*order))).where(F.col("position") <= most)
