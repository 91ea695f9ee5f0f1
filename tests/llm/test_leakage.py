import random

import pytest
from pyspark.sql import functions as F

import numpy as np

from machiya.llm import leakage as L
from machiya.llm.leakage import banded_lcs, held_share, leaked_passages, passages

KANA = "".join(chr(c) for c in range(0x3042, 0x3090)) + "山川田市石門橋井森谷浜原北南東西"
LINE = "次の文章を読んで、答えなさい。"


def prose(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(KANA) + ("。" if i % 37 == 36 else "") for i in range(n))


def english(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def items(spark):
    data = [(i, LINE * (i % 2) + prose(i, 200)) for i in range(1, 9)] + [(i, english(i, 70)) for i in range(20, 24)]
    data += [(90, None), (91, ""), (None, prose(1, 50)), (1, LINE + prose(1, 200))]
    return spark.createDataFrame(data, "item_id bigint, text string")


def altered(text, seed):
    rng = random.Random(seed)
    out = list(text)
    for i in rng.sample(range(len(out)), len(out) // 60):
        out[i] = rng.choice(KANA)
    return "".join(out).replace("。", "．")


def test_passages(items):
    got = {r["item_id"]: r["passage"] for r in passages(items).collect()}
    assert set(got) == {*range(1, 9), *range(20, 24)} and all(LINE[:5] not in p for p in got.values()) and len(got[1]) == len(got[2]) == 200


def test_leaks(spark, items, monkeypatch):
    p = {i: prose(i, 200) for i in range(1, 9)}
    docs = [
        (1, "前置き" + p[1] + "後置き"), (2, altered(p[2], 2)), (3, p[3][:40] + prose(77, 90) + p[3][90:170]), (4, p[4][:80]), (5, "<p>" + p[5][:60] + "</p>\n<p>" + p[5][60:130] + "</p>"), (6, LINE + prose(78, 200)),
        (7, p[1] + p[2]), (8, english(20, 70).upper().replace(" ", "\n")), (9, english(21, 70)[:150]), (10, None), (11, ""), (12, prose(5000, 60_000) + p[6]), (1, "前置き" + p[1] + "後置き"), (None, p[7]), (13, p[8][100:] + prose(79, 5) + p[8][:60]),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(0)).withColumn("pos", F.lit(0))
    found = lambda: sorted((r["doc_id"], r["item_id"], r["share"]) for r in leaked_passages(df, items).collect())
    got = found()
    assert {r[:2] for r in got} == {(1, 1), (2, 2), (3, 3), (5, 5), (7, 1), (7, 2), (8, 20), (12, 6), (13, 8)}
    assert leaked_passages(df.limit(0), items).count() == 0 and leaked_passages(df, items.limit(0)).count() == 0
    # the shuffled index finds the same, with and without hot q-grams, as do small chunks
    monkeypatch.setattr(L, "BROADCAST_GRAMS", 10)
    monkeypatch.setattr(L, "BITMAP_BITS", 1 << 19)
    copies = lambda rows: sorted(set(rows))
    assert copies(found()) == copies(got)
    monkeypatch.setattr(L, "hot_keys", lambda hits, key: [r[0] for r in hits.groupBy(key).count().orderBy(F.desc("count"), key).limit(30).collect()])
    monkeypatch.setattr(L, "CHUNK", 64)
    assert copies(found()) == copies(got)
    monkeypatch.setattr(L, "BROADCAST_GRAMS", 2_000_000)
    assert found() == got


def test_short_passages_are_found(spark):
    items = spark.createDataFrame([(1, "海の見える丘の上の家に"), (2, "quiet house by sea"), (3, "鶴亀"), (4, "!?")], "item_id bigint, text string")
    docs = [(1, "昨日は" + "海の見える丘の上の家に" + "行きました。"), (2, "I saw a quiet house by sea, and left."), (3, prose(5, 80)), (4, "長い名の鶴亀の湯"), (5, english(9, 40))]
    got = {(r["doc_id"], r["item_id"]) for r in leaked_passages(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()}
    assert got == {(1, 1), (2, 2), (4, 3)}


def test_lemma_holds():
    """Regions with as many edits as the budget admits share at least the bound, whatever the edits."""
    rng = random.Random(6)
    for _ in range(200):
        p = prose(rng.randint(0, 99), 25)
        d = list(p)
        at = rng.randrange(25)
        d[at : at + rng.randint(0, 1)] = [rng.choice(KANA)] * rng.randint(0, 1)
        hashes = [set(L.gram_hashes(L._codes(x), 5).tolist()) for x in (p, "".join(d))]
        assert len(hashes[0] & hashes[1]) >= 25 - 5 + 1 - 5


def test_hashes_are_of_whole_q_grams():
    text = prose(3, 300)
    for q in (1, 2, 3, 5, 7, 12):
        h = L.gram_hashes(L._codes(text), q)
        grams = [text[i : i + q] for i in range(len(text) - q + 1)]
        assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams)) and all(np.all(h[[i for i, g in enumerate(grams) if g == x]] == h[grams.index(x)]) for x in grams[:5])
    assert len(L.gram_hashes(L._codes("ab"), 3)) == 0


def test_against_alignment_without_filter():
    for seed in range(20):
        p = prose(seed, 150)
        cut = random.Random(seed).randint(0, 150)
        d = prose(900 + seed, 50) + p[:cut] + prose(950 + seed, 50)
        p, d = p.replace("。", ""), d.replace("。", "")
        share = held_share(d, p, 5)
        assert abs(share - cut / 150) < 0.08 or cut < 15 and share < 0.1


def test_banded_lcs():
    assert banded_lcs("abcdef", "abcdef", 3) == 6 and banded_lcs("abcdef", "abXdef", 3) == 5 and banded_lcs("abcdef", "zzz", 3) == 0
    assert banded_lcs("abcdefgh", "efghabcd", 1) < 4
