import random

from pyspark.sql import functions as F

from machiya.llm.truncation import binomial_tail, discovery_threshold, examples, field_lengths, length_hazards, length_limits, tail_of, truncated_texts

WORDS = "house garden river window kitchen station quiet sunny street market corner school bridge harbour meadow window".split()
CLOSING = ["Ref 12-3", "Branch 4", "- city gas", "- 3 parking spaces", "END OF NOTE"]


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(6, 12))).capitalize() + "."


def whole(rng):
    lines = [" ".join(sentence(rng) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 5))]
    lines.insert(1, rng.choice(CLOSING))
    if rng.random() < 0.4:
        lines.append(rng.choice(CLOSING))
    return "\n".join(lines)


def test_tails():
    assert tail_of("One. Two.") == ("stop", "") and tail_of("終わり。") == ("stop", "") and tail_of("いいね！」") == ("stop", "") and tail_of("") == ("stop", "") and tail_of("  \n") == ("stop", "")
    assert tail_of("One. Two") == ("open", "Two") and tail_of("One.\nTwo") == ("open", "\nTwo") and tail_of("幅員6.") == ("open", "\n幅員6.")
    for cut in ("文字�", "<p>One.</p><p", "<p>One.</p>\n<p>Two.", "One.</p>&nb", "One.<", "One.</"):
        assert tail_of(cut)[0] == "markup", cut
    # inline tags, and blocks that the text never closes, say nothing; a mark of a cut ends no sentence
    assert tail_of("床は<b>無垢材です。") == ("stop", "") and tail_of("<p>One.<p>Two.") == ("stop", "") and tail_of("<p>One.</p><p>Two")[0] == "markup"
    assert tail_of("One. Two th…") == ("open", "Two th") and tail_of("One. Two th...") == ("open", "Two th") and tail_of("One. Two.…") == ("stop", "") and tail_of("…") == ("stop", "")
    assert tail_of("<p>One.</p>\n<p>Two.</p>") == ("stop", "") and tail_of("<p>One.&nbsp;</p>") == ("stop", "")


def test_binomial_tail_and_threshold(spark):
    from math import comb

    for k, n, h in ((3, 10, 0.1), (40, 1000, 0.01), (10, 10, 0.2), (5, 200, 0.001)):
        assert abs(binomial_tail(k, n, h) - sum(comb(n, i) * h**i * (1 - h) ** (n - i) for i in range(k, n + 1))) < 1e-12
    assert binomial_tail(1, 100, 0.5) == 1.0 and binomial_tail(0, 0, 0.1) == 1.0
    rng = random.Random(4)
    ps = [rng.random() for _ in range(300)] + [rng.random() * 1e-4 for _ in range(12)]
    ranked = sorted(ps)
    best = max((p for i, p in enumerate(ranked, 1) if p <= 0.05 * i / len(ps)), default=None)
    bound = discovery_threshold(spark.createDataFrame([(p,) for p in ps], "p double"))
    assert [p for p in ps if p <= bound] and max(p for p in ps if p <= bound) == best
    assert discovery_threshold(spark.createDataFrame([(0.9,), (0.8,)], "p double")) is None


def test_hazards_match_brute_force(spark):
    rng = random.Random(8)
    xs = [rng.randint(1, 90) for _ in range(400)] + [40] * 20
    got = {r["length"]: r for r in length_hazards(spark.createDataFrame([(None, x) for x in xs], "source string, n int"), {"chars": F.col("n")}).collect()}
    assert set(got) == set(xs)
    for at, r in got.items():
        around = [x for x in range(max(1, at - 20), at + 21) if x != at]
        ends, risk = sum(x in around for x in xs), sum(sum(x >= a for x in xs) for a in around)
        assert r["at_risk"] == sum(x >= at for x in xs) and abs(r["near_hazard"] - min(0.999, max((ends + 0.5) / (risk + 1), sum(max(1, at - 20) <= x < at for x in xs) / max(1, min(20, at - 1)) / r["at_risk"]))) < 1e-12


def test_examples_are_bounded_and_lengths_fold_marks(spark):
    assert len(examples("\n".join(f"line {i}" for i in range(5000)))) <= 12
    got = spark.createDataFrame([("abc...",), ("あい\ufffd",), ("ab…",)], "t string").select(*[c.alias(n) for n, c in field_lengths(F.col("t")).items()]).collect()
    assert [tuple(r) for r in got] == [(4, 3), (2, 6), (3, 2)]


def test_held_out_cuts(spark):
    rng = random.Random(11)
    data, cut = [], set()
    for i in range(900):
        t = whole(rng)
        if i % 9 == 0:
            limit = 90 if i % 2 else rng.randint(40, 110)
            if len(t) > limit and t[:limit].rstrip()[-1].isalpha() and t[limit].isalpha():
                t = t[:limit]
                cut.add(i)
        data.append((i, t, f"s{i % 2}"))
    data += [(2000, None, "s0"), (2001, "", "s0"), (2002, "   ", None), (None, "cut of", "s0")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string").withColumn("kind", F.lit("clash")).withColumn("length", F.lit(0))
    out = truncated_texts(df).collect()
    found = {r["doc_id"] for r in out}
    assert len(found & cut) >= 0.9 * len(cut), (len(found & cut), len(cut))
    assert len(found - cut) <= 0.1 * len(cut)


def test_copies_count_alike_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "<p>One.</p><p", "a"), (2, "<p>One.</p><p", None), (3, "Fine.", "a")], "doc_id bigint, text string, source string")
    assert sorted(r["doc_id"] for r in truncated_texts(df).collect()) == [1, 2]
    assert truncated_texts(df.limit(0)).count() == 0


def test_limits_hold_the_false_discovery_rate(spark):
    rng = random.Random(2)
    data = [("a", rng.randint(20, 400)) for _ in range(3000)] + [("a", 255)] * 60 + [("b", rng.randint(20, 400)) for _ in range(3000)]
    df = spark.createDataFrame(data, "source string, n int")
    got = {(r["source"], r["length"]) for r in length_limits(df, {"chars": F.col("n")}).collect()}
    assert ("a", 255) in got and len(got) <= 2
