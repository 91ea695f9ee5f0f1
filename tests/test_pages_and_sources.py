import json

from pyspark.sql import functions as F

from machiya.functions import text
from machiya.operators import pages
from machiya.sources import documents, paged

PAGE = """<html><head><title>家 4LDK</title><meta name="Keywords" content=" a  b "><meta property="og:x" content="1">
<script type="application/ld+json">[{"@type": "House", "floorSize": 95.2}, 3]</script><script type="application/ld+json">{bad</script></head>
<body><h1>見出し</h1><div class="shop-info"><table><tr><th>所在地</th><td>店の住所</td></tr></table></div>
<table><tr><th>所在地</th><td>深汐市本町1-2-3</td><th>土地面積</th><td>120.5m<sup>2</sup></td></tr><tr><th>価格</th><td>5,980万円</td></tr></table>
<dl><dt>間取り<dd>４ＬＤＫ<dt>築年月<dd>2015年3月</dl><p>一つ目<p>二つ目<p>一つ目<a href="/x/nc_12/">詳細</a><a href="?page=2">次へ</a></body>"""


def test_page_evidence(spark):
    df = spark.createDataFrame([("p1", PAGE), ("p2", None), ("p3", ""), ("p4", "<p>開いた<b>まま"), ("p5", "x" * 300_000)], "id string, html string")
    got = pages.page_evidence(df, "id", "html").collect()
    one = {(r["kind"], r["label"]): r["value"] for r in got if r["page_id"] == "p1" and r["kind"] != "block"}
    assert one["pair_table", "所在地"] == "深汐市本町1-2-3" and one["pair_table", "土地面積"] == "120.5m 2" and one["pair_list", "間取り"] == "４ＬＤＫ"
    assert json.loads(one["json_ld", "House"])["floorSize"] == 95.2 and one["meta", "keywords"] == "a b" and one["title", ""] == "家 4LDK"
    blocks = [r["value"] for r in got if r["page_id"] == "p1" and r["kind"] == "block" and r["label"] == "p"]
    assert blocks == ["一つ目", "二つ目", "一つ目 詳細 次へ"]
    assert {r["page_id"] for r in got} == {"p1", "p4", "p5"}
    assert [r["value"] for r in got if r["page_id"] == "p4" and r["kind"] == "block"] == ["開いた まま"]


def test_record_of_a_page(spark):
    evidence = pages.page_evidence(spark.createDataFrame([("p1", PAGE)], "id string, html string"), "id", "html")
    value = F.col("value")
    rules = [
        ("land", "pair_table", "土地面積", "table_th_td", 0.95, text.area_m2(value)), ("layout", "pair_list", "間取り", "dl_dt_dd", 0.95, text.layout_token(value)),
        ("layout", "title", "", "title", 0.6, text.layout_token(value)), ("address", "pair_table", "所在地", "table_th_td", 0.95, value),
    ]
    won = pages.vote(pages.field_candidates(evidence, rules), ["table_th_td", "dl_dt_dd"])
    rec = pages.records(won, ["land", "layout", "address", "year"]).first()
    assert (rec["land"], rec["layout"], rec["address"], rec["year"]) == ("120.5", "4LDK", "深汐市本町1-2-3", None)
    audit = {r["field"]: (r["status"], r["candidates"]) for r in pages.audit(won, evidence, ["land", "layout", "year"]).collect()}
    assert audit == {"land": ("found", 1), "layout": ("found", 2), "year": ("missing", 0)}
    assert pages.next_page(evidence).first()["next"] == "?page=2"


def test_vote_prefers_score_then_votes_then_order(spark):
    data = [(1, "f", "a", "s", 0.70, 0), (1, "f", "b", "s", 0.60, 1), (1, "f", "b", "s", 0.60, 2), (1, "f", "b", "s", 0.60, 3), (1, "g", "x", "s", 0.5, 4), (1, "g", "y", "s", 0.5, 5)]
    df = spark.createDataFrame(data, "page_id int, field string, value string, source string, confidence double, ordinal int")
    assert {r["field"]: (r["value"], r["score"]) for r in pages.vote(df, []).collect()} == {"f": ("b", 720), "g": ("x", 500)}


def test_station_access(spark):
    df = spark.createDataFrame([("深汐駅から徒歩12分、月見坂駅 徒歩500分、他所駅 徒歩3分",), (None,)], "t string")
    got = [r[0] for r in df.select(pages.station_access(F.col("t"), ["深汐", "月見坂"])).collect()]
    assert [(s["station"], s["minutes"]) for s in got[0]] == [("深汐", 12)] and not got[1]


def test_merged_parses(spark):
    df = spark.createDataFrame([("a", 2, "x", None), ("a", 1, "y", "z")], "k string, q int, u string, v string")
    assert tuple(pages.merged_parses(df, "k", [F.col("q")], ["u", "v"]).first()) == ("a", "x", "z")


def test_json_table(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType
    import pytest

    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    for name, body in {"env.json": {"version": 1, "properties": [{"a": "1"}, 5, {"b": "2", "c": 3}]}, "bare.json": [{"a": "1"}, "x", {"b": "2"}]}.items():
        (tmp_path / name).write_text(json.dumps(body))
        assert sorted(map(tuple, documents.json_table(spark, str(tmp_path / name), schema).collect()), key=repr) == [("1", None), (None, "2")]
    assert documents.json_table(spark, str(tmp_path / "none.json"), schema).count() == 0
    with pytest.raises(FileNotFoundError):
        documents.json_table(spark, str(tmp_path / "none.json"), schema, required=True)


def test_sale_periods(spark, tmp_path):
    body = {"periods": [{"period": "2026Q1", "cities": {"k": {"name": "深汐市", "data": [{"Area": "10"}, {"Area": None}]}, "e": {"data": []}}}], "transactions": [{"Area": "7"}]}
    (tmp_path / "t.json").write_text(json.dumps(body))
    got = sorted(map(tuple, documents.sale_periods(spark, str(tmp_path / "t.json"), ["Area"]).collect()), key=repr)
    assert got == [("10", "深汐市", "2026Q1"), ("7", None, None), (None, "深汐市", "2026Q1")]


def test_replace_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    documents.replace_table(spark.range(5), path)
    documents.replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_paged_source(spark, tmp_path):
    for name, html in {"a/1.html": '<a href="/nc_1/">one</a><a href="/nc_2/">two</a><a rel="next" href="2.html">n</a>', "a/2.html": '<a href="/nc_1/">again</a><a href="1.html">次へ</a>', "b/1.html": '<a rel="next" href="9.html">n</a>'}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(html)
    spark.dataSource.register(paged.PagedSource)
    found = spark.read.format("machiya_paged").option("path", str(tmp_path)).load()
    links = sorted((r["target"], r["listingId"], r["page"]) for r in paged.first_links(found, "(?i)/(nc_[0-9]+)").collect())
    assert links == [("a", "nc_1", 1), ("a", "nc_2", 1)]
    assert {r["target"]: (r["healthy"], r["error"]) for r in paged.target_health(found).collect()} == {"a": (False, "loop"), "b": (False, "FileNotFoundError")}


def test_retrieval(spark):
    q = documents.recent_quarters(spark, 2026, 2, 3)
    assert [r["period"] for r in q.orderBy("age").collect()] == ["2026Q1", "2025Q4", "2025Q3"]
    cities = spark.createDataFrame([("a",), ("b",)], "city string")
    stored = spark.createDataFrame([("a", "2026Q1")], "city string, period string")
    assert {r["city"]: r["status"] for r in documents.retrieval_plan(cities, q, stored).collect()} == {"a": "already_stored", "b": "to_fetch"}
    attempts = spark.createDataFrame([("a", 0, "q0", 404, 0), ("a", 1, "q1", 200, 4), ("b", 0, "q0", 404, 0), ("c", 0, "q0", 500, 0), ("c", 1, "q1", 200, 1), ("d", 0, "q0", 200, 0)], "city string, age int, period string, status_code int, rows int")
    assert {r["city"]: r["status"] for r in documents.first_answers(attempts).collect()} == {"a": "success", "b": "no_data_in_search_window", "c": "error", "d": "success_zero_records"}


def test_error_classes(spark):
    df = spark.createDataFrame([(200,), (404,), (429,), (503,), (403,), (None,)], "s int")
    assert [r[0] for r in df.select(pages.http_error_class(F.col("s"))).collect()] == [None, "not_found", "rate_limited", "server_error", "forbidden", "network_error"]


def test_error_classes_and_delays(spark):
    df = spark.createDataFrame([(401, False, 1, None), (None, True, 2, 0.1), (None, None, 5, 60.0), (404, True, 0, 3.0)], "s int, late boolean, n int, after double")
    assert [r[0] for r in df.select(pages.http_error_class(F.col("s"), F.col("late"))).collect()] == ["forbidden", "timeout", "network_error", "not_found"]
    assert [r[0] for r in df.select(pages.retry_delay(F.col("n"), F.col("after"))).collect()] == [2.0, 0.5, 8.0, 3.0]


def test_sections_of_the_seller_are_left_out():
    html = "<div id='tenpo-info'><p>one</p></div><div class=footer><p>two</p></div><div class='Company'><table><tr><th>a<td>b</table></div>"
    kinds = [(k, v) for k, _, _, v in pages.read_page(html) if k in ("block", "pair_table")]
    assert ("block", "two") in kinds and ("block", "one") not in kinds and not [k for k, _ in kinds if k == "pair_table"]
    assert ("block", "one") in [(k, v) for k, _, _, v in pages.read_page(html, ["footer"])]
