import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from machiya.llm import mixing as M  # noqa: E402


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one(size):
    for key in (0, 5, 2**40):
        assert sorted(M._feistel(np.arange(size), size, key)) == list(range(size))


def docs(spark):
    data = [("a", f"text number {i} about a small house near the river") for i in range(60)] + [("b", f"another note {i} on the garden wall") for i in range(5)]
    data += [("b", "another note 0 on the garden wall")] * 30 + [("x", "not in the mix at all"), (None, "no source here"), ("a", None), ("a", ""), ("a", "word " * 4000)]
    return spark.createDataFrame(data, "source string, text string").withColumn("tokens", F.lit("clash")).withColumn("start", F.lit(1))


def targets(spark):
    return spark.createDataFrame([("a", 6.0, 2), ("b", 3.0, 2), ("c", 1.0, 5), ("a", 6.0, 2), (None, 1.0, 1), ("d", None, 3)], "source string, target_weight double, max_repeats int")


def test_counts_are_exact(spark):
    enc = M._encoder(*M.default_tokenizer())
    for r in M.token_counts(docs(spark)).join(docs(spark).where("text is not null").select("source", "text", F.substring(F.sha2("text", 256), 1, 32).alias("digest")).distinct(), ["digest"]).collect():
        assert r["tokens"] == len(enc.encode_ordinary(r["text"]))


def test_mix(spark):
    report, slots, pieces = M.mix(docs(spark), targets(spark), block=16)
    rep = {r["source"]: r for r in report.collect()}
    assert set(rep) == {"a", "b", "c", "d"}
    assert rep["a"]["reachable"] and not rep["b"]["reachable"] and not rep["c"]["reachable"] and rep["d"]["share"] == 0.0
    assert sum(r["share"] for r in rep.values()) == pytest.approx(1.0)
    # no block is used more often than its source's texts may be
    used = slots.where("block is not null").groupBy("source", "block").count().collect()
    assert all(r["count"] <= rep[r["source"]]["max_repeats"] for r in used)
    # every token of every used text lies in exactly one piece, blocks are full but the last
    texts = {r["digest"]: r["tokens"] for r in M.token_counts(docs(spark)).where("source in ('a', 'b') and tokens > 0").collect()}
    spans = {}
    for r in pieces.collect():
        spans.setdefault(r["digest"], []).append((r["from"], r["to"]))
    assert {d: sum(t - f for f, t in s) for d, s in spans.items()} == texts
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    sizes = {(r["source"], r["block"]): r["n"] for r in pieces.groupBy("source", "block").agg(F.sum(F.col("to") - F.col("from")).alias("n")).collect()}
    last = {s: max(b for t, b in sizes if t == s) for s, _ in sizes}
    assert all(n == 16 or b == last[s] for (s, b), n in sizes.items())
    # all slots of the mix are drawn, and the reached share of a reachable source is near its target
    total = rep["a"]["allTokens"]
    assert slots.count() == -(-total // 16)
    assert abs(rep["a"]["reachedShare"] - 0.6) < 6 * rep["a"]["standardError"] + 0.02 and rep["b"]["emptySlots"] > 0 and rep["c"]["emptySlots"] == rep["c"]["drawnSlots"] > 0
    assert sorted(r["source"] for r in M.short_sources(report, 16).collect()) == ["b", "c"]
    # ordinals of a source run on without gaps or repeats over all shards
    at = {}
    for r in slots.collect():
        at.setdefault(r["source"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in at.values())
    # every shard of the mixed corpus holds the tokens of its filled blocks exactly
    joined = slots.where("block is not null").join(pieces, ["source", "block"]).groupBy("shard").agg(F.sum(F.col("to") - F.col("from")).alias("n")).collect()
    want = {}
    for r in slots.where("block is not null").collect():
        want[r["shard"]] = want.get(r["shard"], 0) + sizes[r["source"], r["block"]]
    assert {r["shard"]: r["n"] for r in joined} == want
    assert rep["b"]["reachedTokens"] <= rep["b"]["availableTokens"]


def test_runs_of_shards_count_on(spark, monkeypatch):
    planned = M.plan(M.token_counts(docs(spark)), targets(spark), 4)
    alone = M.draw_slots(planned, 4, slots=20).orderBy("shard", "source").collect()
    monkeypatch.setattr(M, "RUNS", 3)
    assert M.draw_slots(planned, 4, slots=20).orderBy("shard", "source").collect() == alone
    for s in ("a", "b", "c"):
        mine = [r for r in alone if r["source"] == s]
        assert [r["first"] for r in mine] == [sum(x["count"] for x in mine[:i]) for i in range(len(mine))]


@pytest.mark.parametrize("runs, slots", [(3, 64), (6, 25)])
def test_every_run_has_shards(spark, monkeypatch, runs, slots):
    # 4 and 10 shards: two runs of two, and five runs of two, where as many runs as allowed would leave the last one without
    planned = spark.createDataFrame([("a", 0.6, 1000, 10, 2), ("b", 0.4, 1000, 3, 2)], "source string, share double, allTokens bigint, blocks bigint, max_repeats int")
    alone = M.draw_slots(planned, 4, slots).orderBy("shard", "source").collect()
    monkeypatch.setattr(M, "RUNS", runs)
    drawn = M.draw_slots(planned, 4, slots)
    assert drawn.orderBy("shard", "source").collect() == alone
    assert sum(r["count"] for r in alone) == 250 == M.mixed_blocks(planned, drawn).count()


def test_runs_are_drawn_by_all_tasks(spark):
    planned = spark.createDataFrame([("a", 0.6, 10_000, 10, 2), ("b", 0.4, 10_000, 3, 2)], "source string, share double, allTokens bigint, blocks bigint, max_repeats int")
    assert M.draw_slots(planned, 4, slots=25).rdd.getNumPartitions() == 4


def test_draws_do_not_depend_on_partitions(spark):
    texts = M.token_counts(docs(spark))
    a = M.draw_slots(M.plan(texts, targets(spark), 4), 4, slots=100).orderBy("shard", "source").collect()
    b = M.draw_slots(M.plan(texts.repartition(7), targets(spark).repartition(3), 4), 4, slots=100).orderBy("shard", "source").collect()
    assert a == b and len(a) > 4


def test_empty(spark):
    report, slots, pieces = M.mix(docs(spark).limit(0), targets(spark), block=16)
    assert {r["source"] for r in report.collect()} == {"a", "b", "c", "d"} and slots.count() == 0 and pieces.count() == 0
    report, slots, _ = M.mix(docs(spark), targets(spark).limit(0), block=16)
    assert report.count() == 0 and slots.count() == 0
