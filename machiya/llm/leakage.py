"""Evaluation passages in a corpus: q-gram lemma over overlapping diagonal bands, then banded alignment.

A stretch of ``region`` characters of a passage with ``budget`` edits shares at least ``region - q + 1 - q * budget``
q-grams with its copy, all of them on neighbouring diagonals (document position minus passage position).  Every passage has
its own q, region and budget, by its script and length; documents are scanned once, and only bands that meet a passage's
bound are aligned.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machiya.plans.durable import write_table
from machiya.plans.parallel import evenly, spread
from machiya.plans.skew import hot_keys

#: Length of the q-grams of passages that are mostly ASCII, and of others; shorter passages have shorter ones.
Q_ASCII, Q_OTHER = 12, 5
#: Diagonals per band; neighbouring bands overlap by half.
BAND = 16
#: Edits admitted per character of a region, and the shortest region looked for, in q-gram lengths.
EDIT_RATE, REGION = 0.04, 5
#: Share of a passage that a document must hold.
HELD = 0.5
#: A first sentence that opens at least this many passages is an instruction, not part of any.
STANDING = 3
#: Up to this many q-grams the passages' index is broadcast (16 bytes each); a larger one is joined by a shuffle, after a
#: bitmap of so many bits has ruled out most positions.
BROADCAST_GRAMS, BITMAP_BITS = 2_000_000, 1 << 27
#: Characters hashed at once, so that a text of any length takes bounded memory.
CHUNK = 1 << 18
#: Parts over which the documents with one hot q-gram are spread in the shuffled join.
SALTS = 32


def folded(text: Column) -> Column:
    """Text without markup, case, blanks and punctuation, so that only its wording is compared."""
    plain = F.regexp_replace(F.regexp_replace(text, r"<[^<>]*>", ""), r"&[a-z]{2,8};|&#[0-9]{1,6};", "")
    wide = F.translate(F.lower(plain), "０１２３４５６７８９ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ", "0123456789abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(wide, r"[^\p{L}\p{N}]+", "")


def passages(items: DataFrame) -> DataFrame:
    """(item_id, passage): folded passages without a standing instruction at their start.

    The first sentence is an instruction when at least ``STANDING`` items open with it.  Null or empty texts and null
    ids give no passage; repeated rows give one.
    """
    texts = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text").distinct()
    texts = texts.withColumn("opening", F.regexp_extract("text", r"^\s*(.+?(?:[。！？:：]|[.!?](?=\s)|\n))", 1))
    common = texts.where("opening <> ''").groupBy("opening").count().where(F.col("count") >= STANDING).select(F.col("opening").alias("standing"))
    cut = texts.join(common, F.col("opening") == F.col("standing"), "left")
    body = F.when(F.col("standing").isNotNull(), F.substring(F.ltrim("text"), F.length("opening") + 1, F.length("text"))).otherwise(F.col("text"))
    return cut.select("item_id", folded(body).alias("passage")).where("passage <> ''")


def measured_passages(items: DataFrame) -> DataFrame:
    """(item_id, passage, n, q, region, budget, bound): every passage with the figures of its q-gram lemma.

    The region is ``REGION`` q-grams long, or half of a short passage; then q is at most half of the region, so that even a
    passage of two characters has a bound of 1 or more.
    """
    texts = passages(items).withColumn("n", F.length("passage"))
    usual = F.when(F.length(F.regexp_replace("passage", r"[^\x00-\x7f]", "")) * 2 > F.col("n"), Q_ASCII).otherwise(Q_OTHER)
    region = F.greatest(F.least(usual * REGION, F.ceil(F.col("n") * HELD)), F.lit(1)).cast("int")
    with_q = texts.withColumn("region", region).withColumn("q", F.least(usual, F.greatest(F.floor((F.col("region") + 1) / 2), F.lit(1))).cast("int"))
    with_k = with_q.withColumn("budget", F.floor(F.col("region") * EDIT_RATE).cast("int"))
    return with_k.withColumn("bound", F.greatest(F.col("region") - F.col("q") + 1 - F.col("q") * F.col("budget"), F.lit(1)))


_BASE = 0x9E3779B97F4A7C15


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all q-grams of an array of code points; one per position that has a whole q-gram."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, at = None, 0
    power, block, width = np.uint64(_BASE), codes.astype(np.uint64) + np.uint64(1), 1
    # polynomial hash by doubling: a block of width w is two blocks of width w / 2
    while True:
        if q & width:
            part = block[at : at + n]
            out = part.copy() if out is None else out * power + part
            at += width
        width *= 2
        if width > q:
            break
        block = block[: len(block) - width // 2] * power + block[width // 2 :]
        power = np.uint64(int(power) ** 2 % (1 << 64))
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@dataclass
class PassageIndex:
    """Passages and their q-grams by hash, small enough to be broadcast."""

    items: list[int]
    texts: list[str]
    q: np.ndarray
    n: np.ndarray
    region: np.ndarray
    bound: np.ndarray
    by_q: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list) -> PassageIndex:
        """From rows (item_id, passage, n, q, region, bound)."""
        by_q = {}
        for q in sorted({r["q"] for r in rows}):
            hashes, item, at = [], [], []
            for i, r in enumerate(rows):
                if r["q"] == q:
                    h = gram_hashes(_codes(r["passage"]), q)
                    hashes.append(h)
                    item.append(np.full(len(h), i))
                    at.append(np.arange(len(h)))
            h, i, p = np.concatenate(hashes), np.concatenate(item), np.concatenate(at)
            order = np.argsort(h, kind="stable")
            known, starts, counts = np.unique(h[order], return_index=True, return_counts=True)
            bits = max(16, int(len(known) * 16).bit_length())
            flags = np.zeros(1 << bits, dtype=bool)
            flags[(known & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
            by_q[q] = (flags, known, np.stack([starts, counts]), i[order], p[order])
        column = lambda c: np.array([r[c] for r in rows], dtype=np.int64)
        return cls([r["item_id"] for r in rows], [r["passage"] for r in rows], column("q"), column("n"), column("region"), column("bound"), by_q)

    def hits(self, codes: np.ndarray, q: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document positions, passages, passage positions) of all shared q-grams, chunk by chunk."""
        flags, known, spans, item, at = self.by_q[q]
        for lo in range(0, len(codes), CHUNK):
            h = gram_hashes(codes[lo : lo + CHUNK + q - 1], q)
            maybe = np.flatnonzero(flags[(h & np.uint64(len(flags) - 1)).astype(np.int64)])
            where = np.searchsorted(known, h[maybe])
            sure = known[np.minimum(where, len(known) - 1)] == h[maybe]
            maybe, where = maybe[sure], where[sure]
            starts, counts = spans[0][where], spans[1][where]
            total = int(counts.sum())
            if total:
                first = np.repeat(starts - np.cumsum(counts) + counts, counts)
                entry = first + np.arange(total)
                yield np.repeat(maybe + lo, counts), item[entry], at[entry]

    def pairs(self, texts: list[str]) -> list[tuple[int, int]]:
        """(text, passage) whose shared q-grams, counted in overlapping bands, meet the passage's bound."""
        codes = _codes("\x00".join(texts))
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        half = BAND // 2
        longest = int(self.n.max())
        width = (int(np.diff(starts).max()) + longest) // half + 3
        found = []
        for q in self.by_q:
            cells: dict[int, int] = {}
            for d, i, p in self.hits(codes, q):
                t = np.searchsorted(starts, d, side="right") - 1
                cell = (d - starts[t] - p + longest) // half
                keys, counts = np.unique((t * len(self.items) + i) * width + cell, return_counts=True)
                if cells:
                    for k, c in zip(keys.tolist(), counts.tolist()):
                        cells[k] = cells.get(k, 0) + c
                else:
                    cells = dict(zip(keys.tolist(), counts.tolist()))
            if not cells:
                continue
            keys = np.array(sorted(cells), dtype=np.int64)
            counts = np.array([cells[k] for k in keys.tolist()], dtype=np.int64)
            i = keys // width % len(self.items)
            # a band is two neighbouring half bands; one whose count meets the bound retains both
            after = np.zeros(len(keys), dtype=np.int64)
            next_to = np.flatnonzero(np.diff(keys) == 1)
            after[next_to] = counts[next_to + 1]
            kept = counts + after >= self.bound[i]
            retained = kept.copy()
            retained[next_to + 1] |= kept[next_to]
            pair, shared = keys // width, counts * retained
            order = np.flatnonzero(np.r_[True, np.diff(pair) != 0])
            sums = np.add.reduceat(shared, order)
            item = i[order]
            enough = (sums > 0) & (sums >= least_shared(self.n[item], self.region[item], self.bound[item]))
            found += [(int(x) // len(self.items), int(x) % len(self.items)) for x in pair[order][enough]]
        return found


def least_shared(n, region, bound):
    """What the retained bands of a pair share at least, if regions within the budget make up the held share.

    Each whole region shares its bound; the rest of a stretch, less than a region, need not share any.
    """
    return n * HELD * bound / region - bound


def banded_lcs(a: str, b: str, band: int) -> int:
    """Length of the longest common subsequence of two strings over cells at most ``band`` off the diagonal.

    Bit-parallel: one big-integer step per character of ``b``.
    """
    where: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(a):
        where[ch] |= 1 << i
    full, v = (1 << len(a)) - 1, (1 << len(a)) - 1
    slope = len(a) / max(1, len(b))
    for j, ch in enumerate(b):
        m = where.get(ch, 0)
        if m:
            at = int(j * slope)
            lo = max(0, at - band)
            m &= ((1 << (at + band + 1)) - 1) >> lo << lo
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def held_share(document: str, passage: str, q: int) -> float:
    """Share of a passage's wording that the document holds, in any number of stretches, by chained q-grams.

    A stretch counts from two q-grams on, or a third of a passage that is shorter than six.
    """
    index: dict[str, list[int]] = defaultdict(list)
    for i in range(len(passage) - q + 1):
        index[passage[i : i + q]].append(i)
    hits = []
    for d in range(len(document) - q + 1):
        for i in index.get(document[d : d + q], ()):
            hits.append((i, d))
    # chains of hits that run on along nearly the same diagonal
    chains: list[list[int]] = []
    open_chains: list[list[int]] = []
    for i, d in sorted(hits, key=lambda h: (h[1], h[0])):
        best = None
        for c in open_chains:
            gap_i, gap_d = i - c[1], d - c[3]
            if -q < gap_i <= 4 * q and 0 <= gap_d <= 4 * q and abs(gap_i - gap_d) <= BAND and (best is None or abs(gap_i - gap_d) < abs(i - best[1] - d + best[3])):
                best = c
        if best is None:
            open_chains.append([i, i, d, d, 1])
            chains.append(open_chains[-1])
        elif i >= best[1]:
            best[1], best[3] = i, d
            best[4] += 1
        open_chains = [c for c in open_chains if d - c[3] <= 4 * q]
    covered: list[tuple[int, int, int]] = []
    shortest = min(2 * q, -(-len(passage) // 3))
    for i0, i1, d0, d1, n in chains:
        i1, d1 = i1 + q, d1 + q
        if i1 - i0 < shortest:
            continue
        same = banded_lcs(passage[i0:i1], document[d0:d1], BAND)
        if same >= 0.75 * max(i1 - i0, d1 - d0):
            covered.append((i0, i1, same))
    total, end = 0.0, 0
    for i0, i1, same in sorted(covered):
        new = max(0, i1 - max(i0, end))
        total += new * same / (i1 - i0)
        end = max(end, i1)
    return total / len(passage)


def _bitmap(index: DataFrame) -> np.ndarray:
    """Bits of all hashes of an index, put together from segments of fixed size: ``BITMAP_BITS / 8`` bytes at the driver."""
    segment = 1 << 16
    bits = index.select(F.expr(f"gram & {BITMAP_BITS - 1}").alias("bit")).distinct()

    def packed(key, rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(segment, dtype=np.uint8)
        flags[(rows["bit"].to_numpy() % segment).astype(np.int64)] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(flags).tobytes()]})

    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for r in bits.withColumn("segment", F.floor(F.col("bit") / segment)).groupBy("segment").applyInPandas(packed, "segment bigint, bits binary").toLocalIterator():
        out[r["segment"] * segment // 8 : (r["segment"] + 1) * segment // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _gram_rows(df: DataFrame, key: str, text: str, qs: list[int] | None, keep=None) -> DataFrame:
    """(key, q, gram, pos) of a text column; ``qs`` are the lengths, or None for the row's own ``q``.

    ``keep`` is a broadcast bitmap: positions whose hash is not in it are left out.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["q"] if qs is None else [None] * len(batch)
            for k, t, q0 in zip(batch[key], batch[text], own):
                codes = _codes(t)
                for q in qs or [int(q0)]:
                    for lo in range(0, len(codes), CHUNK):
                        h = gram_hashes(codes[lo : lo + CHUNK + q - 1], q)
                        at = np.arange(len(h))
                        if keep is not None:
                            bit = (h & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
                            at = np.flatnonzero(keep.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
                        yield pd.DataFrame({key: k, "q": q, "gram": h[at].view(np.int64), "pos": at + lo})

    return df.mapInPandas(rows, f"{key} bigint, q int, gram bigint, pos bigint")


def _pairs_by_shuffle(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """(doc_id, item_id) like ``PassageIndex.pairs``, for an index of any size: hits are joined and counted by shuffles.

    A bitmap of fixed size drops most positions where they are hashed.  Documents with a hot q-gram (a stock phrase) meet
    its entries in ``SALTS`` parts.
    """
    index = write_table(_gram_rows(tests.select("item_id", "passage", "q"), "item_id", "passage", None).select("item_id", "q", "gram", F.col("pos").alias("ipos")), "grams").df
    qs = [r["q"] for r in tests.select("q").distinct().orderBy("q").collect()]  # at most Q_ASCII lengths
    keep = docs.sparkSession.sparkContext.broadcast(_bitmap(index))
    hits = write_table(_gram_rows(docs, "doc_id", "folded", qs, keep), "hits").df
    hot = hot_keys(hits, "gram")
    is_hot = F.col("gram").isin(hot) if hot else F.lit(False)
    left = hits.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0)))
    right = index.withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))))
    cell = F.floor((F.col("pos") - F.col("ipos")) / (BAND // 2))
    cells = left.join(right, ["q", "gram", "salt"]).groupBy("doc_id", "item_id", cell.alias("cell")).agg(F.count("*").alias("shared"))
    # a band is two neighbouring half bands: each is named by its lower one
    bands = cells.select("doc_id", "item_id", "cell", "shared", F.explode(F.array(F.col("cell") - 1, F.col("cell"))).alias("band"))
    figures = tests.select("item_id", "n", "region", "bound")
    counted = bands.groupBy("doc_id", "item_id", "band").agg(F.sum("shared").alias("both"), F.collect_list(F.struct("cell", "shared")).alias("cells"))  # two cells at most
    kept = counted.join(figures, "item_id").where(F.col("both") >= F.col("bound"))
    retained = kept.select("doc_id", "item_id", "n", "region", "bound", F.explode("cells").alias("c")).select("doc_id", "item_id", "n", "region", "bound", "c.*").distinct()
    sums = retained.groupBy("doc_id", "item_id", "n", "region", "bound").agg(F.sum("shared").alias("shared"))
    return sums.where(F.col("shared") >= least_shared(F.col("n"), F.col("region"), F.col("bound"))).select("doc_id", "item_id")


def leaked_passages(documents: DataFrame, items: DataFrame, held: float = HELD) -> DataFrame:
    """(doc_id, item_id, share) of documents that hold at least ``held`` of an item's passage.

    Every position of every document is looked up in the passages' q-grams; what is shared is counted in overlapping bands
    of diagonals; bands that meet the lemma's bound of the passage (``measured_passages``) are retained, and pairs whose
    retained bands can make up the share are aligned within the bands.  With an index of up to ``BROADCAST_GRAMS`` all
    this happens where the document lies, and nothing is shuffled; a larger one is joined by a shuffle.  Null and empty
    texts hold nothing; copies count; null doc_ids are dropped; texts and passages of any length are read whole; a passage
    without letters and digits is none.
    """
    docs = spread(documents).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", folded(F.col("text")).alias("folded")).where("folded <> ''")
    tests = write_table(measured_passages(items), "passages").df
    schema = "doc_id bigint, item_id bigint, share double"
    if (tests.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_GRAMS:
        rows = tests.orderBy("item_id", "passage").collect()  # at most BROADCAST_GRAMS characters
        if not rows:
            return docs.select("doc_id", F.lit(0).cast("bigint").alias("item_id"), F.lit(0.0).alias("share")).where("false")
        shared = docs.sparkSession.sparkContext.broadcast(PassageIndex.of(rows))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = shared.value
            for batch in batches:
                ids, texts = batch["doc_id"].tolist(), batch["folded"].tolist()
                # some texts at a time, by their length
                at = 0
                while at < len(texts):
                    to, size = at, 0
                    while to < len(texts) and (to == at or size + len(texts[to]) <= 4 * CHUNK):
                        size += len(texts[to])
                        to += 1
                    got = [(ids[at + t], index.items[i], held_share(texts[at + t], index.texts[i], int(index.q[i]))) for t, i in index.pairs(texts[at:to])]
                    yield pd.DataFrame(got, columns=["doc_id", "item_id", "share"])
                    at = to

        return docs.mapInPandas(scan, schema).where(F.col("share") >= held)

    chosen = _pairs_by_shuffle(docs, tests).join(docs, "doc_id").join(tests.select("item_id", "passage", "q"), "item_id")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            share = [held_share(d, p, int(q)) for d, p, q in zip(batch["folded"], batch["passage"], batch["q"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "item_id": batch["item_id"], "share": share})

    # the pairs are few but costly
    out = evenly(chosen.select("doc_id", "item_id", "folded", "passage", "q"), "doc_id", "item_id").mapInPandas(align, schema)
    return out.where(F.col("share") >= held)
