import pytest

from machiya.llm.addresses import Gazetteer, edits, gazetteer, houses_by_address, parsed_addresses, same_house_number, split_address
from machiya.llm.matching import NUMBER, TYPED, candidates, house_clusters, learned_weights, match_probabilities

SPLITS = {
    "汐見県深汐市鳩南野200番地 付近": ("汐見県深汐市鳩南野", [200]),
    "3-4-19 夕陽台, 白凪市, 翠嶺県": ("翠嶺県白凪市夕陽台", [3, 4, 19]),
    "〒961-8432 翠嶺県白凪市夕陽台６丁目２１番３１号": ("翠嶺県白凪市夕陽台", [6, 21, 31]),
    "霧ケ原市岩戸里四丁目三十五番十九号": ("霧ケ原市岩戸里", [4, 35, 19]),
    "所在地：三ツ森市雲井6の13の3（住居表示）": ("三ツ森市雲井", [6, 13, 3]),
    "若鳩市大字鶴舞ヵ原 2208番地の5 他3筆": ("若鳩市鶴舞ケ原", [2208, 5]),
    "白凪市一番町2-3-4": ("白凪市一番町", [2, 3, 4]),
    "6 丁目 15 番 30 号 岩戸里, 霧ヶ原市": ("霧ケ原市岩戸里", [6, 15, 30]),
    "汐見県早苗巾大字鳩南野121番38": ("汐見県早苗巾鳩南野", [121, 38]),
    "青樹市芹沢5丁目": ("青樹市芹沢", [5]),
}


@pytest.mark.parametrize("stated", SPLITS)
def test_split_address(stated):
    assert split_address(stated)[:2] == SPLITS[stated]


@pytest.mark.parametrize("stated", [None, "", "-", "不明", "汐見県鳴海市本通7-20-10 緑青タワー6F 本社営業部"])
def test_no_place(stated):
    assert split_address(stated) is None


def test_edits():
    assert edits("岩戸里", "戸岩里", 1) == 1 and edits("abc", "abd", 1) == 1 and edits("abc", "c", 1) == 2 and edits("", "", 1) == 0


def listings(spark):
    data = [(f"f{i:02}", f"汐見県青樹市芹東沢{i % 4 + 1}丁目{i}番{i + 1}号", None, None) for i in range(30)] + [(f"h{i:02}", f"翠嶺県若鳩市鶴舞ヶ原{900 + i}番地", None, "") for i in range(20)]
    data += [
        ("a", "青樹市芹東沢2-9-7", None, None), ("b", "不明", None, "汐見県青樹市芹東択２丁目９番７号"), ("c", "汐見県芹東沢二丁目九番七号", "-", None), ("d", "芹東沢2丁目", "青樹市芹東沢2-9-7 周辺図あり", None),
        ("e", "青樹市芹東沢2丁目9番", None, None), ("g", "若鳩市鶴舞ガ原77", None, None), ("i", "翠嶺県若鳩市字鶴舞ケ原77番地", None, None), ("j", "若鳩市鶴舞ケ原77番地1", None, None),
        ("k", None, None, "汐見県青樹市本通2-9-7 緑青タワー6F 営業所"), ("l", None, None, None), (None, "青樹市芹東沢2-9-7", None, None), ("a", "青樹市芹東沢2-9-7", None, None), ("m", "x" * 50_000, "1" * 9_000, None),
    ]
    return spark.createDataFrame(data, "id string, address string, fullAddress string, propertyAddress string")


def test_same_house_number(spark):
    fields = ["address", "fullAddress", "propertyAddress"]
    got = {tuple(r) for r in same_house_number(listings(spark), "id", fields).collect()}
    assert got == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d"), ("g", "i")}
    assert same_house_number(listings(spark).limit(0), "id", fields).count() == 0


def test_houses_of_crowded_number(spark):
    df = spark.createDataFrame([(f"n{i:04}", "汐見県青樹市芹東沢2-9-7", f"汐見県青樹市芹東沢{i}-1-1") for i in range(1, 40)], "id string, address string, other string")
    assert same_house_number(df, "id", ["address"]).count() == 39 * 38 // 2


def test_rare_prefectures_stay_and_misspelled_ones_are_folded(spark):
    data = [(f"n{i:03}", f"翠嶺県若鳩市鶴舞ケ原{i}-1") for i in range(1, 200)] + [("r1", "汐見県青樹市芹東沢7-1"), ("r2", "汐見県青樹市芹東沢7番地1"), ("r3", "青樹市芹東沢7の1")]
    data += [("w", "翠領県若鳩市鶴舞ケ原5番地1"), ("o1", "翠里県深汐市本通3-1"), ("o2", "翠里県深汐市本通3番地1")]
    df = spark.createDataFrame(data, "id string, address string")
    places = {(r["prefecture"], r["city"]) for r in gazetteer(parsed_addresses(df, "address")).collect()}
    assert places == {("翠嶺県", "若鳩市"), ("汐見県", "青樹市"), ("翠里県", "深汐市")}
    assert {tuple(r) for r in same_house_number(df, "id", ["address"]).collect()} == {("r1", "r2"), ("r1", "r3"), ("r2", "r3"), ("n005", "w"), ("o1", "o2")}


def test_all_tied_places_of_a_town_name():
    known = Gazetteer([("汐見県", f"{c}市", "本通里", 5) for c in "青白黒赤緑紫銀金藍"] + [("汐見県", "青市", "芹東沢", 5)])
    assert {p for p, _ in known.resolve("本通里")} == {f"汐見県/{c}市/本通里" for c in "青白黒赤緑紫銀金藍"}
    assert [p for p, _ in known.resolve("白市本通里")] == ["汐見県/白市/本通里"]


def test_rarer_neighbours_are_no_misspellings(spark):
    data = [(f"e{i:03}", f"汐見県青樹市東芹沢{i}-1") for i in range(1, 101)] + [(f"w{i:02}", f"汐見県青樹市西芹沢{i}-1") for i in range(1, 21)] + [(f"x{i}", f"汐見県青樹市東芹択{i}番地1") for i in range(1, 4)]
    df = spark.createDataFrame(data, "id string, address string")
    assert {r["town"] for r in gazetteer(parsed_addresses(df, "address")).collect()} == {"東芹沢", "西芹沢"}
    assert {tuple(r) for r in same_house_number(df, "id", ["address"]).collect()} == {(f"e{i:03}", f"x{i}") for i in range(1, 4)}


RECORD = "id string, place string, number string, district bigint, land double, building double, year double"


def test_clusters_and_matches(spark):
    left = spark.createDataFrame(
        [
            ("l1", "p", "1-1-1", 1, 100.0, 80.0, 2000.0), ("l2", "p", "1-1-1", 1, 100.4, None, 2001.0), ("l3", "p", "1-1-1", 1, None, 80.1, None), ("l4", "p", "1-1-1", 1, 150.0, 95.0, 2015.0),
            ("l5", "p", None, 2, 120.0, 70.0, 1990.0), ("l6", "q", "5", None, None, None, None),
        ],
        RECORD,
    )
    clustered = house_clusters(left)
    houses = {r["id"]: r["house"] for r in clustered.collect()}
    assert houses == {"l1": "l1", "l2": "l1", "l3": "l1", "l4": "l4", "l5": "l5", "l6": "l6"}
    right = spark.createDataFrame(
        [("r1", "p", "1-1-1", 1, 100.0, 80.0, 2000.0), ("r2", "p", "1-1-1", 1, 150.2, 95.0, 2015.0), ("r3", "p", "2-2-22", 2, 120.0, 70.0, 1990.0), ("r4", "p", "3-1-1", 3, 120.0, 70.0, 1990.0), ("r5", "z", "5", None, None, None, None)],
        RECORD,
    )
    values = left.where("id in ('l1', 'l4', 'l5', 'l6')")
    got = {(r["lid"], r["rid"]): r["probability"] for r in match_probabilities(candidates(values, right)).collect()}
    assert {k for k, p in got.items() if p >= 0.5} == {("l1", "r1"), ("l4", "r2"), ("l5", "r3")}
    assert all(0 <= p <= 1 for p in got.values())
    assert match_probabilities(candidates(values.limit(0), right)).count() == 0


def test_records_without_a_place_meet_by_their_areas(spark):
    left = spark.createDataFrame([("l1", None, None, None, 123.4, 81.2, 1999.0), ("l2", "p", "1-1-1", 1, 150.0, 95.0, 2015.0), ("l3", None, None, None, 99.0, None, 1999.0)], RECORD)
    right = spark.createDataFrame([("r1", "p", "7", None, 123.4, 81.2, 1999.0), ("r2", None, None, None, 150.0, 95.0, 2015.0), ("r3", "q", "3", None, 99.0, 70.0, 1999.0)], RECORD)
    got = {(r["lid"], r["rid"]): r["probability"] for r in match_probabilities(candidates(left, right)).collect()}
    assert {k for k, p in got.items() if p >= 0.5} == {("l1", "r1"), ("l2", "r2")}


def test_weights_are_learned_from_patterns(spark):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(400):
        match = i % 2 == 0
        rows.append((NUMBER, rng.choice([0, 0, 1]) if match else rng.choice([3, 4, 4, 1]), rng.choice([0, 1]) if match else 4, rng.choice([0, 1]) if match else 3, 1))
    weights, places = learned_weights(spark.createDataFrame(rows, "where int, land int, building int, year int, n int"))
    # a level that matches often share and others never gains weight, one that both have loses some
    assert weights["building"][0] > TYPED["building"][0] - 1 and weights["building"][4] < -3 and weights["land"][1] < weights["land"][0] and abs(places[NUMBER]) < 1
    assert learned_weights(spark.createDataFrame([], "where int, land int, building int, year int"))[0] == TYPED


def test_messages_settle_on_a_swinging_graph(spark):
    """A ring of equal candidates, and one record with many: rounds end, and every pair says whether it has settled."""
    ring = [(f"a{i}", f"b{i}", 8.0) for i in range(6)] + [(f"a{i}", f"b{(i + 1) % 6}", 8.0) for i in range(6)] + [("hub", f"x{i}", 5.0) for i in range(40)] + [("lone", "pair", 0.0)]
    got = {(r["lid"], r["rid"]): r for r in match_probabilities(spark.createDataFrame(ring, "lid string, rid string, score double")).collect()}
    assert len(got) == len(ring) and all(r["settled"] is not None for r in got.values())
    assert got["lone", "pair"]["probability"] == 0.5 and abs(sum(r["probability"] for k, r in got.items() if k[0] == "hub") - 1) < 0.05
    assert all(abs(r["probability"] - 0.5) < 0.05 for k, r in got.items() if k[0].startswith("a"))


def test_one_to_one_factor_decides(spark):
    pairs = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 2.5), ("b", "x", 2.8)], "lid string, rid string, score double")
    got = {(r["lid"], r["rid"]): r["probability"] for r in match_probabilities(pairs).collect()}
    # exact marginals of the three admissible assignments with a match, and of none
    from math import exp

    w = {"ax": exp(3.0), "ay": exp(2.5), "bx": exp(2.8), "aybx": exp(5.3)}
    z = 1 + sum(w.values())
    assert got["b", "x"] == pytest.approx((w["bx"] + w["aybx"]) / z, abs=0.02) and got["a", "x"] == pytest.approx(w["ax"] / z, abs=0.02)


def test_parsed_addresses_of_nothing(spark):
    assert parsed_addresses(spark.createDataFrame([(None,), ("",)], "t string"), "t").count() == 0
    assert houses_by_address(spark.createDataFrame([], "id string, address string"), "id", ["address"]).count() == 0
