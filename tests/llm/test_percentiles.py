import math
import random

import numpy as np
import pytest

from machiya.llm import percentiles as P

SHARES = (0.0, 0.1, 0.5, 0.9, 1.0)


def table(spark, data):
    return spark.createDataFrame(data, "g string, h string, value double")


@pytest.mark.parametrize("hot", [100_000, 50])
def test_matches_numpy_and_merges(spark, monkeypatch, hot):
    monkeypatch.setattr(P, "HOT_VALUES", hot)  # with 50, the largest group is split by buckets
    rng = random.Random(5)
    data = [("big", "x", rng.lognormvariate(3, 1)) for _ in range(700)] + [("ties", "x", float(rng.choice([1, 2, 2, 2, 50]))) for _ in range(90)] + [("one", None, 7.0)]
    data += [("big", "x", None), ("big", "x", float("nan")), ("neg", "x", -3.0), ("neg", "x", 0.0)]
    df = table(spark, data).withColumnRenamed("h", "rank")  # a clashing name
    loads = [P.value_counts(part, ["g", "rank"], "value") for part in df.randomSplit([0.4, 0.3, 0.3], 3)]
    got = {(r["g"], r["share"]): (r["rows"], r["percentile"]) for r in P.percentiles(P.merge_counts(*loads), ["g", "rank"], SHARES).collect()}
    groups = {}
    for g, _, v in data:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    assert set(got) == {(g, s) for g in groups for s in SHARES}
    for g, xs in groups.items():
        for s in SHARES:
            assert got[g, s] == (len(xs), pytest.approx(np.quantile(xs, s)))


def test_relative_error_is_kept(spark):
    rng = random.Random(6)
    xs = [rng.lognormvariate(10, 2) for _ in range(500)] + [0.0]
    counts = P.value_counts(table(spark, [("g", "h", x) for x in xs]), ["g"], "value", relative_error=0.02)
    for r in P.percentiles(counts, ["g"], (0.25, 0.5, 0.75)).collect():
        exact = sorted(xs)[int(500 * r["share"])]
        assert abs(r["percentile"] - exact) <= 0.021 * exact
    assert counts.count() < 501


def test_empty(spark):
    assert P.percentiles(P.value_counts(table(spark, []), ["g"], "value"), ["g"], (0.5,)).count() == 0
