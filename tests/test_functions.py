import pytest
from pyspark.sql import functions as F

from machiya.functions import dates, decisions, money, text, urls
from machiya.functions.quantities import AREA_M2, PRICE_MAN, TRADE_YEN, read_quantity
from machiya.operators.quantities import amount_prior, common_scales, common_units


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("stated, expected", [("1,234.5円", 1234.5), ("１２３", 123.0), ("0", None), ("-5", 5.0), ("なし", None), (None, None), ("", None)])
def test_lenient_number(spark, stated, expected):
    assert one(spark, text.lenient_number, stated) == expected


@pytest.mark.parametrize("stated, expected", [("-5", -5.0), ("0", 0.0), ("x", None)])
def test_signed_number(spark, stated, expected):
    assert one(spark, text.signed_number, stated) == expected


@pytest.mark.parametrize("stated, bare, expected", [("1,234.56 m²", False, 1234.56), ("９５．２㎡", False, 95.2), ("120.50", False, None), ("120.50", True, 120.5), ("0㎡", True, None), (None, True, None)])
def test_area(spark, stated, bare, expected):
    assert one(spark, lambda c: text.area_m2(c, bare), stated) == expected


@pytest.mark.parametrize("stated, expected", [("４ＬＤＫ＋Ｓ", "4LDK+S"), ("3LDK+2S", "3LDK+2S"), ("2DK 角部屋", "2DK"), ("土地", None), (None, None)])
def test_layout(spark, stated, expected):
    assert one(spark, text.layout_token, stated) == expected


def test_addresses(spark):
    assert one(spark, text.market_address, "若柴１２３番地 1") == "若柴123-1"
    assert one(spark, text.market_address, None) == ""
    assert one(spark, text.identity_address, "Ａ町（１）２番３号") == "a町12-3"
    assert one(spark, lambda c: text.digit_runs(c), "1-2-3") == 3


def test_number_text(spark):
    assert [one(spark, lambda c: text.number_text(c), x, "double") for x in (120.0, 120.5, None)] == ["120", "120.5", ""]


@pytest.mark.parametrize(
    "stated, expected", [("4480万円", 44_800_000), ("1億2,000万円", 120_000_000), ("1億円", 100_000_000), ("¥44800000", 44_800_000), ("44800000円", 44_800_000), ("100円", None), ("相談", None), (None, None)]
)
def test_money(spark, stated, expected):
    assert one(spark, money.money_yen, stated) == expected


@pytest.mark.parametrize("stated, ym, precision", [("2015年3月", "2015-03", "month"), ("2015/12", "2015-12", "month"), ("2015年", "2015-01", "year"), ("令和3年4月", "2021-04", "month"), ("平成元年", None, None), (None, None, None)])
def test_year_month(spark, stated, ym, precision):
    got = one(spark, dates.year_month, stated)
    assert (got["ym"], got["precision"]) == (ym, precision) if ym else got is None or got["ym"] is None


def test_ages_and_days(spark):
    now = F.lit("2026-10-12 00:00:00").cast("timestamp")
    assert one(spark, lambda c: dates.age_years(c, now), "2025-10") == 1.0
    assert one(spark, lambda c: dates.age_years(c, now), "2027-01") is None
    assert one(spark, lambda c: dates.age_years(c, now, clamp=True), "2027-01") == 0.0
    assert one(spark, lambda c: F.date_format(dates.quarter_end(c), "yyyy-MM-dd HH:mm:ss"), "2026年第1四半期") == "2026-03-31 23:59:59"
    assert one(spark, lambda c: dates.whole_days(c.cast("timestamp"), now), "2026-10-10 00:00:01") == 1
    assert one(spark, lambda c: dates.whole_days(c.cast("timestamp"), now), "2027-10-10 00:00:01") == 0
    assert one(spark, lambda c: dates.built_year(c, 2026), "築11年") == 2015


def test_urls(spark):
    page = lambda c: urls.canonical(c, "https://a.example/", ["a.example"], r"/nc_[0-9]+(?:/|$)")
    assert one(spark, page, "https:/a.example/x/nc_12/?q=1#f") == "https://a.example/x/nc_12/"
    assert one(spark, page, "/x/nc_12/") == "https://a.example/x/nc_12/"
    assert one(spark, page, "//a.example/nc_1") == "https://a.example/nc_1"
    for bad in ("javascript:void(0)", "#", "https://b.example/nc_1", "https://a.example/top", None, ""):
        assert one(spark, page, bad) is None


def test_verdict_keeps_unknown(spark):
    df = spark.createDataFrame([(1.0, None), (5.0, None), (1.0, 2.0)], "a double, b double")
    flags = {"a": decisions.at_most(F.col("a"), 3.0), "b": decisions.at_most(F.col("b"), 3.0), "c": decisions.at_most(F.col("b"), None)}
    got = [r[0] for r in df.select(decisions.verdict(flags).alias("v")).collect()]
    assert [g["status"] for g in got] == ["pending", "excluded", "matched"]
    assert got[1]["failed"] == ["a"] and got[1]["unknown"] == ["b"]


def test_weighted_mean_renormalizes(spark):
    df = spark.createDataFrame([(10.0, None), (None, None), (10.0, 20.0)], "a double, b double")
    got = [r[0] for r in df.select(decisions.weighted_mean([(F.col("a"), 0.4), (F.col("b"), 0.1)])).collect()]
    assert got == [10.0, None, pytest.approx(12.0)]


def test_tiered_key(spark):
    df = spark.createDataFrame([("a", "1", "2"), ("a", "1", None), (None, "1", "2")], "a string, b string, c string")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    got = [r[0] for r in df.select(decisions.tiered_key([("abc", [a, b, c]), ("ab", [a, b])], F.lit("t"))).collect()]
    assert [g["tier"] for g in got] == ["abc", "ab", None]
    assert got[0]["key"] != got[1]["key"] and len(got[0]["key"]) == len("property:") + 24


PRICES = {
    "￥81,700,000-": 81_700_000, "7,570万円": 75_700_000, "0.556億円": 55_600_000, "2億1,210万円": 212_100_000, "一億七千二百九十万円": 172_900_000, "二億千九百九十万円": 219_900_000,
    "24900 万": 249_000_000, "JPY 45600000": 45_600_000, "31.6M JPY": 31_600_000, "31.6m": 31_600_000, "38.7百万円": 38_700_000, "37,800千円": 37_800_000, "約6,480万円（税込）": 64_800_000,
    "7,740": 77_400_000, "30000": 300_000_000, "200": 2_000_000, "3億円": 300_000_000, "１１８８０万円": 118_800_000, "応相談": None, "-": None, "": None, "0": None, "-500万円": None, None: None,
}
AREAS = {
    "33.76坪": 33.76 * 400 / 121, "118.91㎡(35.97坪)": 118.91, "40.49つぼ": 40.49 * 400 / 121, "73.13 tsubo": 73.13 * 400 / 121, "159.80㎡（実測）": 159.8, "158.56平米": 158.56, "2.3342アール": 233.42,
    "1,438 sq ft": 1438 * 0.3048**2, "1,099ft²": 1099 * 0.3048**2, "2846 sqft": 2846 * 0.3048**2, "0.022898ha": 228.98, "2.2222a": 222.22, "173.89平方メートル": 173.89, "0.0001 km2": 100.0, "四十坪": 40 * 400 / 121, "不明": None,
    "12 m3": None, "30 kg": None,
}


@pytest.mark.parametrize("stated", PRICES)
def test_prices(stated):
    got = read_quantity(stated, PRICE_MAN)
    assert got == (None if PRICES[stated] is None else pytest.approx(PRICES[stated]))


@pytest.mark.parametrize("stated", AREAS)
def test_areas(stated):
    got = read_quantity(stated, AREA_M2)
    assert got == (None if AREAS[stated] is None else pytest.approx(AREAS[stated]))


def test_long_and_odd_texts_do_not_fail():
    for t in ("9" * 5000, "万" * 3000, "1" + "," * 2000, "１" * 400 + "坪", "m2" * 500, "約" * 1000 + "3", "5円" * 300):
        read_quantity(t, TRADE_YEN)


def test_common_units(spark, as_rows):
    df = spark.createDataFrame([("a", "3510", "1坪", 1), ("a", "3510", "1坪", 2), ("b", None, "不明", 3), (None, "10万円", "5㎡", 4)], "id string, price string, land string, plain int")
    out = common_units(df, "id", {"price": PRICE_MAN, "land": AREA_M2})
    got = {(r["fieldName"], r["recorded"]): (r["commonValue"], r["plain"]) for r in out.collect()}
    assert got == {("price", "3510"): (35_100_000.0, True), ("land", "1坪"): (pytest.approx(400 / 121), False)}
    assert common_units(df.limit(0), "id", {"price": PRICE_MAN}).count() == 0


def test_bare_numbers_are_read_by_learned_amounts(spark):
    """A bare number leaves its field's unit only if the field's own amounts say so; close calls are marked."""
    usual = [(f"u{i}", str(3000 + 137 * i)) for i in range(60)]
    odd = [("yen", "34900000"), ("own", "30000"), ("two", "200"), ("oku", "3億円"), ("wide", "７,７４０")]
    out = common_units(spark.createDataFrame(usual + odd, "id string, price string"), "id", {"price": PRICE_MAN})
    got = {r["id"]: (r["commonValue"], r["plain"]) for r in out.where("id not like 'u%'").collect()}
    assert got["yen"] == (34_900_000, False) and got["oku"] == (300_000_000, False) and got["wide"] == (77_400_000, False)
    # the same price in two notations is one amount when rows like it are usual
    dear = [(f"d{i}", str(20_000 + 500 * i)) for i in range(60)]
    out = common_units(spark.createDataFrame(dear + odd, "id string, price string"), "id", {"price": PRICE_MAN})
    got = {r["id"]: (r["commonValue"], r["plain"], r["certain"]) for r in out.where("id not like 'd%'").collect()}
    assert got["own"] == (300_000_000, True, True) and got["oku"][0] == 300_000_000
    # a number near the boundary of two units is kept whole, and marked
    one = common_units(spark.createDataFrame(usual + [("x", "29000")], "id string, price string"), "id", {"price": PRICE_MAN}).where("id = 'x'").first()
    assert one["commonValue"] in (290_000_000, 29_000_000) and isinstance(one["certain"], bool)


def test_units_are_segmented():
    from machiya.functions.quantities import PRICE_YEN, unit_factor

    assert [f for f, _ in PRICE_MAN.scales()] == [1e4, 1.0, 1e3, 1e6] and PRICE_YEN.own == 1.0 and AREA_M2.own == 1.0
    assert unit_factor("坪", "length", 2) == pytest.approx(400 / 121)
    with pytest.raises(ValueError):
        unit_factor("kg", "money", 1)


def test_common_scales_are_chosen_jointly(spark):
    from machiya.functions.quantities import PRICE_YEN

    data = [(42_900_000, 4290), (3390, 3390), (43_200_000, 43_200_000), (16_850, 16_850), (20_000, 2_000), (17_330, None), (None, None), (0, 5000)]
    df = spark.createDataFrame(data, "priceYen bigint, priceMan int")
    usual = spark.createDataFrame([(x * 1_000_000,) for x in (25, 30, 35, 40, 45, 50, 60, 70, 90, 120)], "priceYen bigint")
    prior = amount_prior(usual, F.col("priceYen") * PRICE_YEN.own)
    got = common_scales(df.crossJoin(prior), {"priceYen": PRICE_YEN, "priceMan": PRICE_MAN}, F.col("center"), F.col("spread")).select("priceYen_common", "priceMan_common").collect()
    assert [tuple(r) for r in got] == [(42.9e6, 42.9e6), (33.9e6, 33.9e6), (43.2e6, 43.2e6), (168.5e6, 168.5e6), (20e6, 20e6), (173.3e6, None), (None, None), (None, 50e6)]


@pytest.mark.parametrize("stated, expected", [("情報提供日：2026年4月5日 次回", "2026-04-05"), ("更新 2026年4月5日", None), (None, None)])
def test_labelled_date(spark, stated, expected):
    assert one(spark, lambda c: dates.labelled_date(c, ["情報提供日"]), stated) == expected


@pytest.mark.parametrize("stated, expected", [("平成5年3月 2001年", ("2001-01", "year")), ("2001/4 2002年7月", ("2002-07", "month")), ("昭和60年", None), ("2001年13月", None), ("令和 2 年 11 月", ("2020-11", "month"))])
def test_year_month_prefers(spark, stated, expected):
    got = one(spark, dates.year_month, stated)
    assert (None if got is None else tuple(got)) == expected


def test_identity_record(spark):
    df = spark.createDataFrame([("x:1", "property:k", "1"), (None, "property:k", " "), (" ", None, None), (None, None, "2")], "a string, b string, c string")
    got = [r[0] for r in df.select(decisions.identity_record([("id", F.col("a")), ("tier", F.col("b"))], F.col("c"), [F.col("c")])).collect()]
    assert [(g["kind"], list(g["aliases"])[1:]) for g in got] == [("id", ["property:k", "1"]), ("tier", []), ("candidate", []), ("candidate", ["2"])]
    assert got[0]["key"] == "x:1" and got[2]["key"].startswith("candidate:") and got[2]["key"] != got[3]["key"]
