"""Mixing sources to target weights: token blocks, multinomial draws per shard, permuted block indices."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.plans.durable import write_table
from machiya.plans.parallel import spread

#: Tokens per block and slots per output shard.
BLOCK, SHARD_SLOTS = 256, 1024
#: Least number of hash buckets by which a source's texts are numbered; no task holds more than one bucket of one source.
BUCKETS = 64
#: Runs of neighbouring shards whose draws are summed first; a bound, so that the sums before each run are a few rows.
RUNS = 4_096
#: Standard errors of a source's drawn slots by which its supply may lie above them and still be held to the exact bound.
ALLOWANCE = 6.0


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def default_tokenizer() -> tuple[str, str]:
    """(path, split pattern) of the many-language vocabulary of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def token_counts(documents: DataFrame, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """(source, digest, copies, tokens): each distinct text of a source once, with its number of copies and its length.

    The digest is 128 bits of SHA-256.  Null texts are dropped; an empty text has no tokens.
    """
    path, pattern = tokenizer or default_tokenizer()

    @F.pandas_udf("bigint")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(path, pattern)
        for batch in texts:
            yield pd.Series([len(x) for x in enc.encode_ordinary_batch(batch.tolist(), num_threads=1)])

    rows = spread(documents.where("text is not null").select("source", "text"))
    counted = rows.select("source", F.substring(F.sha2("text", 256), 1, 32).alias("digest"), count("text").alias("tokens"))
    return counted.groupBy("source", "digest").agg(F.count("*").alias("copies"), F.first("tokens").alias("tokens"))


def pack_blocks(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, digest, tokens, start): place of every text in its source's token stream, cut into blocks by ``block``.

    The order is by digest.  Offsets are prefix sums at two levels, over buckets of digests and within each, so a
    source that holds most rows is still spread over all shuffle partitions, and over ``BUCKETS`` tasks at least.
    """
    buckets = min(65536, max(BUCKETS, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    bucketed = texts.withColumn("bucket", F.floor(F.conv(F.substring("digest", 1, 4), 16, 10).cast("bigint") * buckets / 65536).cast("int"))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return placed.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))).select("source", "digest", "tokens", (F.col("base") + F.col("inside")).alias("start"))


def _feistel(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of ``range(size)`` applied to ``x``: four Feistel rounds, walked until inside the range."""
    bits = max(2, int(size - 1).bit_length())
    half = (bits + 1) // 2
    mask = np.uint64((1 << half) - 1)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for r in range(4):
            mixed = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 0x2545F4914F6CDD1D + r * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, (left ^ mixed) & mask
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def plan(texts: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per source of ``targets``: share, targetTokens, availableTokens, blocks, reachable.

    The mix is as large as all of ``texts`` with their copies, texts without a target source included.  A text is
    available ``max_repeats`` times, however many copies the source holds; the source reaches its share if that is
    enough.  Repeated target rows count once; null, NaN and negative weights count as 0, null repeats as 0.
    """
    weight = F.when(F.col("target_weight").isNotNull() & ~F.isnan("target_weight"), F.greatest("target_weight", F.lit(0.0))).otherwise(0.0)
    wanted = targets.where("source is not null").select("source", weight.alias("weight"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats")).dropDuplicates(["source"])
    total = texts.agg(F.sum(F.col("tokens") * F.col("copies")).alias("all_tokens"))
    sums = wanted.agg(F.sum("weight").alias("all_weight"))
    per = texts.groupBy("source").agg(F.sum("tokens").alias("distinct_tokens"))
    out = wanted.join(per, "source", "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(sums))
    share = F.coalesce(F.try_divide("weight", "all_weight"), F.lit(0.0))
    out = out.select("source", "max_repeats", share.alias("share"), (share * F.coalesce("all_tokens", F.lit(0))).alias("targetTokens"), F.coalesce("distinct_tokens", F.lit(0)).alias("distinctTokens"), F.coalesce("all_tokens", F.lit(0)).alias("allTokens"))
    out = out.withColumn("availableTokens", F.col("distinctTokens") * F.col("max_repeats")).withColumn("blocks", F.ceil(F.col("distinctTokens") / block))
    return out.withColumn("reachable", F.col("availableTokens") >= F.col("targetTokens"))


def draw_slots(planned: DataFrame, block: int = BLOCK, slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """(shard, source, first, count): how many slots each shard gives each source, and the ordinal of the first.

    Each shard draws its counts from the multinomial of the target shares, seeded by its number: a pure function of the
    shard, so it is drawn twice instead of being gathered.  First every run of neighbouring shards (at most ``RUNS`` of
    them, however many shards there are) adds up its draws; the sums of the runs before are at most ``RUNS`` rows a source;
    then each shard counts on from its run's sum.  No task holds a source's shards, and none are shuffled.
    """
    spark = planned.sparkSession
    rows = planned.select("source", "share", "allTokens").orderBy("source").collect()  # one row per target source
    names, shares = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)
    total = -(-int(rows[0][2]) // block) if rows else 0
    schema = "shard bigint, source string, first bigint, count bigint"
    if not total or shares.sum() <= 0:
        return spark.createDataFrame([], schema)
    shards = -(-total // slots)
    width = -(-shards // RUNS)
    runs = -(-shards // width)  # counted from their width, so that the last one has shards too
    chances = shares / shares.sum()

    def drawn(run: int) -> tuple[np.ndarray, np.ndarray]:
        mine = np.arange(run * width, min(shards, (run + 1) * width))
        return mine, np.array([np.random.default_rng((seed, int(n))).multinomial(min(slots, total - int(n) * slots), chances) for n in mine]).reshape(len(mine), len(names))

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for run in batch["id"]:
                yield pd.DataFrame({"run": int(run), "at": np.arange(len(names)), "sum": drawn(int(run))[1].sum(axis=0)})

    def count_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for run, before in zip(batch["run"], batch["before"]):
                mine, counts = drawn(int(run))
                first = np.cumsum(counts, axis=0) - counts + np.array(before, dtype=np.int64)
                yield pd.DataFrame({"shard": np.repeat(mine, len(names)), "source": names * len(mine), "first": first.reshape(-1), "count": counts.reshape(-1)})

    tasks = min(runs, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sums = spark.range(0, runs, 1, tasks).mapInPandas(add_up, "run bigint, at int, sum bigint")
    before = Window.partitionBy("at").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # RUNS rows at most
    # dealt in turn: a repartition by run, as the runs lie already, is left out of the plan, and then few bytes are one task
    offsets = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("at", "before"))).alias("b"))
    return offsets.select("run", F.transform("b", lambda x: x["before"]).alias("before")).repartition(tasks).mapInPandas(count_on, schema)


def mixed_blocks(planned: DataFrame, drawn: DataFrame, seed: int = 17) -> DataFrame:
    """(shard, source, slot, repeat, block): the block that fills every slot; ``block`` is null beyond ``max_repeats``.

    The k-th slot of a source takes entry ``k mod blocks`` of the permutation of pass ``k div blocks`` over its blocks,
    so a block is used once per pass and passes differ in order.  The permutation is computed, not stored.
    """
    sized = drawn.where("count > 0").join(F.broadcast(planned.select("source", "blocks", "max_repeats")), "source")
    schema = "shard bigint, source string, slot bigint, repeat bigint, block bigint"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                k = np.arange(r.first, r.first + r.count, dtype=np.int64)
                blocks = int(r.blocks)
                repeat = k // blocks if blocks else np.full(len(k), np.iinfo(np.int64).max)
                index = np.full(len(k), -1, dtype=np.int64)
                salt = int.from_bytes(r.source.encode(), "little") % (1 << 61)
                for p in np.unique(repeat):
                    if p < r.max_repeats and blocks:
                        here = repeat == p
                        index[here] = _feistel(k[here] % blocks, blocks, salt + seed * 1_000_003 + int(p))
                filled = pd.array(index, dtype="Int64")
                filled[index < 0] = pd.NA
                yield pd.DataFrame({"shard": r.shard, "source": r.source, "slot": k, "repeat": np.where(index < 0, -1, repeat), "block": filled})

    return sized.mapInPandas(fill, schema)


def mix(documents: DataFrame, targets: DataFrame, tokenizer: tuple[str, str] | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan with drawn and empty slots and reached shares, filled slots, text pieces of every block).

    ``pieces`` is (source, block, digest, from, to): the token ranges of the texts in a block, in order; joined with
    the slots by source and block it is the mixed corpus.  Reached shares count the tokens of the joined blocks; they
    scatter by ``standardError`` around the target share, as every slot draws its source.
    Documents of no or another source count towards the size only.
    """
    texts = write_table(token_counts(documents, tokenizer), "tokens").df
    planned = write_table(plan(texts, targets, block), "plan").df
    used = texts.join(F.broadcast(planned.select("source")), "source", "left_semi")
    placed = pack_blocks(used, block).where("tokens > 0")
    last = F.floor((F.col("start") + F.col("tokens") - 1) / block)
    spans = placed.select("source", "digest", "tokens", "start", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("block"))
    lo, hi = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("start") + F.col("tokens"), (F.col("block") + 1) * block)
    pieces = spans.select("source", "block", "digest", (lo - F.col("start")).alias("from"), (hi - F.col("start")).alias("to"))
    slots = write_table(mixed_blocks(planned, draw_slots(planned, block)), "slots").df
    sizes = pieces.groupBy("source", "block").agg(F.sum(F.col("to") - F.col("from")).alias("held"))
    drawn = slots.groupBy("source").agg(F.count("*").alias("drawnSlots"), F.count_if(F.col("block").isNull()).alias("emptySlots"))
    reached = slots.where("block is not null").groupBy("source", "block").agg(F.count("*").alias("uses")).join(sizes, ["source", "block"]).groupBy("source").agg(F.sum(F.col("uses") * F.col("held")).alias("reachedTokens"))
    all_reached = reached.agg(F.sum("reachedTokens").alias("all_reached"))
    report = planned.join(drawn, "source", "left").join(reached, "source", "left").crossJoin(F.broadcast(all_reached))
    report = report.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("drawnSlots", "emptySlots", "reachedTokens")})
    report = report.withColumn("reachedShare", F.coalesce(F.try_divide("reachedTokens", "allTokens"), F.lit(0.0)))
    report = report.withColumn("shareOfMix", F.coalesce(F.try_divide("reachedTokens", "all_reached"), F.lit(0.0)))
    # of a share drawn slot by slot
    slot_count = F.greatest(F.ceil(F.col("allTokens") / block), F.lit(1))
    report = report.withColumn("standardError", F.sqrt(F.col("share") * (1 - F.col("share")) / slot_count))
    return report.drop("all_reached"), slots, pieces


def short_sources(report: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source): sources whose slots the mix leaves empty because they cannot reach their share.

    Slots are drawn at random, so near its bound a source may by chance be spared empty slots: one whose filled slots
    reach its supply within ``ALLOWANCE`` standard errors of the draw is held to the exact token bound as well, which also
    settles the ones with empty slots that a generous draw alone has emptied.  A share above 0 without any text is short.
    """
    filled = F.col("drawnSlots") - F.col("emptySlots")
    slack = ALLOWANCE * F.col("standardError") * F.greatest(F.ceil(F.col("allTokens") / block), F.lit(1)) + F.col("max_repeats") + 1
    near = (F.col("emptySlots") > 0) | (filled + slack >= F.col("blocks") * F.col("max_repeats"))
    return report.where(near & ~F.col("reachable")).select("source")
