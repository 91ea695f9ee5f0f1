"""Texts that were cut off: length hazards per source, and endings that whole texts do not have.

A cut is of one of three classes: ``limit`` (an incomplete ending at a length whose hazard is significant), ``transfer``
(an incomplete ending at any other length, judged by the same model against lower prior odds) and ``markup`` (a broken
character, an open tag or entity, or a block element that is left open).  Hazards alone cannot show the last two.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.plans.durable import write_table
from machiya.plans.parallel import spread

#: Lengths on either side whose hazard a length is tested against.
NEIGHBOURS = 20
#: Rate of false discoveries among the lengths called limits, and the fewest texts that may show one.
FALSE_DISCOVERY, FEWEST = 0.05, 4
#: Texts from which the ending model learns (a bound: their number does not grow with the corpus), examples and cuts per text.
LEARN_TEXTS, EXAMPLES_PER_TEXT, CUTS_PER_TEXT = 6_000, 12, 3
#: An ending without a stop that so many different texts have, and such a share of them, is one that authors write.
COMMON_CLOSING, COMMON_SHARE = 3, 0.0003
#: Prior odds that a text is cut, away from any limit, and at a significant length: authors and forms also fill a field
#: exactly, so a limit alone never outweighs a clearly whole ending.
PRIOR_ODDS, LIMIT_ODDS = 0.08, 2.0
#: Most that the log odds fall because the closing line stands whole inside other texts, and the share of the texts that
#: counts as one such text (at least one text).
WHOLE_LINE, WHOLE_SHARE = 4.0, 1e-4
#: Weights of the ending model.
DIMENSIONS = 1 << 15

_STOPS = "。．｡！!？?…♪♫♡★☆"
#: Marks that a field or a page puts where it cut a text.
_ELLIPSIS = re.compile(r"(?:…+|\.{3,}|\[…\]|\[\.\.\.\])$")
_CLOSERS = "」』）)】］]》〉\"'”’"
_TAG_OR_ENTITY = re.compile(r"<[^<>]*>|&[a-zA-Z]{2,8};|&#[0-9]{1,6};")
_OPEN_MARKUP = re.compile(r"(?:<[a-zA-Z/!]?[^<>]*|&[a-zA-Z#][a-zA-Z0-9]{0,7}|<)$")
_ASIAN = re.compile(r"[぀-ヿ㐀-鿿ｦ-ﾟ]")


def _unclosed(text: str) -> bool:
    """True when a block element is left open in a text that closes others of its kind.

    Inline elements, and blocks whose end tags the text always leaves out, say nothing.
    """
    opened: dict[str, list[int]] = {}
    for m in re.finditer(r"<(/?)(p|div|li|td|tr|table|ul|ol|section|article)\b[^<>]*>", text, re.IGNORECASE):
        n = opened.setdefault(m.group(2).lower(), [0, 0])
        n[bool(m.group(1))] += 1
    return any(ends and starts > ends for starts, ends in opened.values())


def tail_of(text: str) -> tuple[str, str]:
    """(kind, tail): kind is ``markup`` (broken character or markup), ``stop`` (a finished sentence) or ``open``.

    The tail of an open ending is what follows the last finished sentence of the last line; it begins with a line mark
    when it is the whole line.  An ellipsis at the very end may be the mark of a cut: it finishes nothing unless a
    finished sentence stands before it.
    """
    if text.endswith("\ufffd") or _OPEN_MARKUP.search(text):
        return "markup", ""
    body = _TAG_OR_ENTITY.sub("\n", text).rstrip()
    body = _ELLIPSIS.sub("", body).rstrip() or body
    unclosed = _unclosed(text)
    if not body:
        return ("markup", "") if unclosed else ("stop", "")
    line = body[body.rfind("\n") + 1 :].strip()
    end = 0
    for m in re.finditer(rf"[{_STOPS}]+[{re.escape(_CLOSERS)}]*|\.(?:[{re.escape(_CLOSERS)}]*)(?=\s|$)", line):
        if m.group()[0] == ".":
            before = line[max(0, m.start() - 1) : m.start()]
            # a point after a digit, or in Asian text, may stand inside a number: it ends nothing by itself
            if _ASIAN.match(before) or (before.isdigit() and m.end() == len(line)):
                continue
        end = m.end()
    tail = line[end:].strip()
    if unclosed:
        return "markup", ""
    if not tail:
        return "stop", ""
    return "open", ("\n" if end == 0 else "") + tail


def shape_of(tail: str) -> str:
    """A tail with digits and Latin runs of addresses folded, by which equal closings are counted."""
    s = re.sub(r"https?://[\x21-\x7e]+", "http", tail)
    return re.sub(r"[0-9０-９]+(?:[.,][0-9０-９]+)*", "9", s)


def digest_of(shape: str) -> int:
    """A shape as a signed 64-bit number, by which lines are counted over the corpus."""
    n = xxhash.xxh64_intdigest(shape.encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >= 1 << 63 else n


def inner_lines(text: str) -> list[int]:
    """Digests of the lines without a stop that more text follows: lines that were surely written to their end."""
    lines = [x for x in _TAG_OR_ENTITY.sub("\n", text).split("\n") if x.strip()]
    return sorted({digest_of(shape_of(t)) for k, t in map(tail_of, lines[:-1]) if k == "open" and t.startswith("\n")})


def _features(tail: str) -> list[int]:
    s = shape_of(tail)
    found = [f"e{n}{s[-n:]}" for n in range(1, 8)] + [f"b{n}{s[:n]}" for n in (2, 3, 5)] + ["w" + s, f"l{min(40, len(s)) // 4}", f"s{s[:1] == chr(10)}"]
    found.append(f"x{s[:1] == chr(10)}{s[-3:]}")
    found.append("a" + (s.split() or [""])[-1])
    for o, c in ("「」", "（）", "()", "『』", "【】"):
        if s.count(o) != s.count(c):
            found.append("u" + o)
    return [_stable_hash(f) % DIMENSIONS for f in found]


def _stable_hash(s: str) -> int:
    h = 2166136261
    for b in s.encode("utf-8", "replace"):
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h


@dataclass
class EndingModel:
    """Log odds that an open ending was cut; a logistic model over hashed features."""

    weights: np.ndarray
    bias: float

    def log_odds(self, tail: str) -> float:
        return float(self.weights[_features(tail)].sum() + self.bias)


def examples(text: str, seed: int = 7) -> list[tuple[int | None, list[int], int]]:
    """(label, features, digest) of at most ``EXAMPLES_PER_TEXT`` endings of a text.

    Label 0 are lines and sentences that more text follows, 1 are cuts at random places; the text's own open ending has
    no label yet: it counts as whole if it is a common closing.
    """
    rng = np.random.default_rng((seed, abs(digest_of(text))))
    body = _TAG_OR_ENTITY.sub("\n", text)
    whole, cuts, own = [], [], []
    for line in [x for x in body.split("\n") if x.strip()][:-1]:
        kind, tail = tail_of(line)
        if kind == "open":
            whole.append(tail)
    # sentences that end with a point after a digit, and are followed by more
    whole += [m.group(1) for m in re.finditer(r"(?<=[.!?] )([^.!?\n]{3,160}[0-9]\.)(?= [A-Z])", body)]
    kind, tail = tail_of(text)
    if kind == "open":
        own.append(tail)
    for cut in rng.integers(1, max(2, len(body)), CUTS_PER_TEXT):
        if body[cut - 1 : cut + 1].strip() == "" or body[cut : cut + 1] in ("\n", ""):
            continue
        kind, tail = tail_of(body[:cut])
        if kind == "open":
            cuts.append(tail)
    room = EXAMPLES_PER_TEXT - len(cuts) - len(own)
    if len(whole) > room:
        whole = [whole[i] for i in sorted(rng.choice(len(whole), room, replace=False))]
    return [(label, _features(t), digest_of(shape_of(t))) for label, ts in ((0, whole), (1, cuts), (None, own)) for t in ts]


def fit_endings(rows: list, labels: list[int], rounds: int = 80) -> EndingModel:
    """Fit the model to hashed features and labels; without examples of both kinds it says nothing."""
    if len(set(labels)) < 2:
        return EndingModel(np.zeros(DIMENSIONS), 0.0)
    y = np.array(labels, dtype=float)
    flat = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, b, speed = np.zeros(DIMENSIONS), 0.0, np.full(DIMENSIONS, 1e-8)
    for _ in range(rounds):  # full-batch adaptive gradient steps
        z = np.bincount(owner, weights=w[flat], minlength=len(rows)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(flat, weights=g[owner], minlength=DIMENSIONS) + 0.05 * w
        speed += grad**2
        w -= 0.5 * grad / np.sqrt(speed)
        b -= 0.5 * g.mean()
    return EndingModel(w, b)


def learned_endings(texts: DataFrame, closings: DataFrame) -> EndingModel:
    """The ending model of at most ``LEARN_TEXTS`` different texts, the least by hash.

    Examples are made where the texts lie; the driver gets at most ``LEARN_TEXTS * EXAMPLES_PER_TEXT`` rows of some
    thirty numbers, however long the texts are.
    """
    sample = texts.where("trim(text) <> ''").select("text", F.xxhash64("text").alias("h"))
    chosen = sample.select("h").distinct().orderBy("h").limit(LEARN_TEXTS)
    own = sample.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("text").alias("text"))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, *e) for h, t in zip(batch["h"], batch["text"]) for e in examples(t)]
            yield pd.DataFrame(rows, columns=["h", "label", "features", "shape"]).astype({"label": "Int32"})

    made = own.mapInPandas(make, "h bigint, label int, features array<int>, shape bigint")
    known = closings.select(F.col("shape").alias("_shape"))
    judged = made.join(known, F.col("shape") == F.col("_shape"), "left").where("label is not null or _shape is not null")
    rows = judged.select(F.coalesce("label", F.lit(0)).alias("label"), "features", "h", "shape").toPandas()
    rows["key"] = [tuple(f) for f in rows["features"]]
    rows = rows.sort_values(["h", "shape", "label", "key"])  # sums of floats must not depend on the order of arrival
    return fit_endings(list(rows["features"]), [int(x) for x in rows["label"]])


def binomial_tail(seen: int, risk: int, hazard: float) -> float:
    """P(X >= seen) of a binomial with ``risk`` trials, summed from ``seen`` on; 1 unless more than expected are seen."""
    if seen <= risk * hazard:
        return 1.0
    odds = math.log(hazard) - math.log1p(-hazard)
    log_term = math.lgamma(risk + 1) - math.lgamma(seen + 1) - math.lgamma(risk - seen + 1) + seen * odds + risk * math.log1p(-hazard)
    term, total = 1.0, 1.0
    for k in range(seen, risk):
        term *= (risk - k) / (k + 1) * math.exp(odds)
        total += term
        if term < total * 1e-12:
            break
    return min(1.0, math.exp(log_term) * total) if log_term > -745 else 0.0


def field_lengths(text: Column) -> dict[str, Column]:
    """Characters and bytes that a text takes in a field, without broken characters at its end.

    A mark of a cut counts as one character, however it is written, and as no byte: fields of so many bytes are cut first.
    """
    whole = F.regexp_replace(text, "\ufffd+$", "")
    mark = r"(?:…+|[.]{3,}|\[…\]|\[[.]{3}\])$"
    return {"chars": F.length(F.regexp_replace(whole, mark, "…")).cast("bigint"), "bytes": F.octet_length(F.regexp_replace(whole, mark, "")).cast("bigint")}


def length_hazards(texts: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(source, measure, length, texts, at_risk, hazard, near_hazard, p): the discrete hazard of every length that occurs.

    The hazard of a length is the share of the texts at least that long that end there.  The neighbouring hazard pools the
    lengths up to ``NEIGHBOURS`` away on either side, whether texts end there or not: all their endings over all their
    texts at risk (half an ending is added, so it is never 0).  Where lengths run out by themselves hazards rise to 1, so
    it is no lower than what lets as many texts end as at the shorter neighbours on average.  ``p`` is the exact binomial
    tail of the endings seen.
    ``texts`` should have each text once per source, else copies look like limits.  Texts without a source form one group
    of their own; null lengths are dropped.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("bigint").alias("length")) for n, c in measures.items()])).alias("m")
    counts = texts.select("source", cells).select("source", "m.*").where("length > 0").groupBy("source", "measure", "length").agg(F.count("*").alias("texts"))
    by = Window.partitionBy("source", "measure").orderBy("length")
    near, beyond = by.rangeBetween(-NEIGHBOURS, NEIGHBOURS), by.rangeBetween(NEIGHBOURS + 1, Window.unboundedFollowing)
    lengths = counts.select(
        "*",
        F.sum("texts").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("at_risk"),
        F.sum("texts").over(near).alias("ends"), F.sum(F.col("texts") * F.col("length")).over(near).alias("sums"), F.coalesce(F.sum("texts").over(beyond), F.lit(0)).alias("longer"),
        F.coalesce(F.sum("texts").over(by.rangeBetween(-NEIGHBOURS, -1)), F.lit(0)).alias("before"),
    )
    first = F.greatest(F.col("length") - NEIGHBOURS, F.lit(1))
    # a text is at risk at every length of the window up to its own
    exposure = (F.col("length") + NEIGHBOURS - first + 1) * F.col("longer") + F.col("sums") - (first - 1) * F.col("ends") - F.col("at_risk")
    pooled = (F.col("ends") - F.col("texts") + 0.5) / (exposure + 1)
    running_out = F.coalesce(F.try_divide(F.col("before"), F.col("length") - first), F.lit(0.0)) / F.col("at_risk")
    hazards = lengths.withColumn("hazard", F.col("texts") / F.col("at_risk")).withColumn("near_hazard", F.least(F.greatest(pooled, running_out), F.lit(0.999)))

    @F.pandas_udf("double")
    def tail(seen: pd.Series, risk: pd.Series, hazard: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(k), int(n), float(h)) for k, n, h in zip(seen, risk, hazard)])

    return hazards.withColumn("p", tail("texts", "at_risk", "near_hazard")).select("source", "measure", "length", "texts", "at_risk", "hazard", "near_hazard", "p")


def discovery_threshold(tested: DataFrame, p: str = "p", rate: float = FALSE_DISCOVERY) -> float | None:
    """The largest p-value at which the false discovery rate over all rows of ``tested`` is held; None if none passes.

    Step-up by counting: starting from the rate itself, the bound falls to ``rate * (rows at most the bound) / rows``
    until it stands still, which is the largest such bound.  Counts only; p-values are never ranked in one place.
    """
    rows = tested.count()
    bound, passing = rate, -1
    while rows:
        now = tested.where(F.col(p) <= bound).count()
        if now == 0:
            return None
        if now == passing:
            return bound
        passing, bound = now, rate * now / rows
    return None


def length_limits(texts: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(source, measure, length, texts, at_risk, hazard, near_hazard, p): lengths at which a source's texts stop too often.

    The hazards of ``length_hazards`` that stand out under false-discovery control, with at least ``FEWEST`` texts.
    """
    tested = write_table(length_hazards(texts, measures), "hazards").df
    bound = discovery_threshold(tested)
    return tested.where(F.col("p") <= F.lit(-1.0 if bound is None else bound)).where(F.col("texts") >= FEWEST)


def truncated_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, source, kind, log_odds, at_limit, tail): the documents whose text was cut off, with the class of the cut.

    A broken character or open markup at the end is a cut (``markup``).  A finished sentence is none.  Any other ending is
    judged by a model of endings: at a significant length of its source (``length_limits``) with ``LIMIT_ODDS`` before
    evidence (``limit``), else with ``PRIOR_ODDS`` (``transfer``).  A closing line that stands whole inside other texts
    speaks against a cut, by the share of the texts that have it, unless it ends in a digit at a limit.  The model is
    learned here, from at most ``LEARN_TEXTS`` texts; lengths, hazards, lines and common closings are counted over all.
    Null and blank texts are not cut; null doc_ids are dropped; copies count; texts of any length are read whole.
    """
    docs = spread(documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "source", "text"))
    schema = "doc_id bigint, source string, chars bigint, bytes bigint, kind string, tail string, shape bigint, digest bigint, inner array<bigint>"
    measured = docs.select("doc_id", "source", "text", *[c.alias(n) for n, c in field_lengths(F.col("text")).items()], F.xxhash64("text").alias("digest"))

    def endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [tail_of(t) for t in batch["text"]]
            out = batch.drop(columns="text")
            out["kind"], out["tail"] = [k for k, _ in read], [t for _, t in read]
            out["shape"] = [digest_of(shape_of(t)) for _, t in read]
            out["inner"] = [inner_lines(t) for t in batch["text"]]
            yield out[["doc_id", "source", "chars", "bytes", "kind", "tail", "shape", "digest", "inner"]]

    ended = write_table(measured.mapInPandas(endings, schema), "endings")
    ends = ended.df
    distinct = write_table(ends.select("source", "digest", "chars", "bytes", "kind", "shape").dropDuplicates(["source", "digest"]), "distinct").df
    limits = write_table(length_limits(distinct, {"chars": F.col("chars"), "bytes": F.col("bytes")}), "limits").df
    texts = distinct.count()
    closings = write_table(distinct.where("kind = 'open'").groupBy("shape").agg(F.count_distinct("digest").alias("n")).where(F.col("n") >= max(COMMON_CLOSING, COMMON_SHARE * texts)), "closings").df
    model = learned_endings(docs, closings)
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.astype("float32"), model.bias))

    @F.pandas_udf("double")
    def judged(tails: pd.Series) -> pd.Series:
        own = EndingModel(*shared.value)
        return tails.map(own.log_odds)

    # only lines that end some text need counting
    asked = distinct.where("kind = 'open'").select(F.col("shape").alias("line")).distinct()
    inside = ends.select(F.explode("inner").alias("line")).groupBy("line").agg(F.count("*").alias("seen")).join(asked, "line", "left_semi")
    out = ends.drop("inner").where("kind <> 'stop'").join(inside, F.col("shape") == F.col("line"), "left")
    for m in ("chars", "bytes"):
        at = limits.where(F.col("measure") == m).select(F.col("source").alias(f"{m}_source"), F.col("length").alias(f"{m}_length"), F.lit(True).alias(f"{m}_limit"))
        out = out.join(at, F.col("source").eqNullSafe(F.col(f"{m}_source")) & (F.col(m) == F.col(f"{m}_length")), "left")
    limited = F.coalesce("chars_limit", "bytes_limit", F.lit(False))
    unit = max(1.0, WHOLE_SHARE * texts)
    seen = F.when(limited & F.col("tail").rlike("[0-9０-９]$"), F.lit(0.0)).otherwise(F.least(F.log1p(F.coalesce("seen", F.lit(0)) / unit), F.lit(WHOLE_LINE)))
    prior = F.when(limited, math.log(LIMIT_ODDS)).otherwise(math.log(PRIOR_ODDS))
    scored = out.withColumn("log_odds", F.when(F.col("kind") == "open", judged(F.col("tail")) + prior - seen))
    kind = F.when(F.col("kind") == "markup", "markup").when(limited, "limit").otherwise("transfer")
    return scored.where((F.col("kind") == "markup") | (F.col("log_odds") > 0)).select("doc_id", "source", kind.alias("kind"), "log_odds", limited.alias("at_limit"), "tail")
