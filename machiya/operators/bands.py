"""Ranks among the sales that lie within an item's bands, by bitsets over sales in order of price."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the bitsets kept of one characteristic; beyond, they are made anew.
KEPT = 1 << 25
#: Words of a bitset that are counted as one block.
BLOCK = 16
_BYTES, _SUM = np.uint64(0x00FF00FF00FF00FF), np.uint64(0x0001000100010001)


def packed(mask: np.ndarray) -> np.ndarray:
    """A mask as bits in 64-bit words, in whole blocks."""
    out = np.zeros(-(-len(mask) // (64 * BLOCK)) * 8 * BLOCK, dtype=np.uint8)
    bits = np.packbits(mask, bitorder="little")
    out[: len(bits)] = bits
    return out.view(np.uint64)


class _Kept(dict):
    """Bitsets by key, made when first asked for."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        out = self.make(key)
        if (len(self) + 1) * out.nbytes > KEPT:
            self.clear()
        self[key] = out
        return out


class Met:
    """Some of the sales as a bitset: how many they are, and the prices at ranks."""

    def __init__(self, price: np.ndarray, bits: np.ndarray):
        self.price, self.bits = price, bits
        # sums of the words' counts, eight bytes at a time: at most 64 a word, 128 a pair, 256 in two bytes
        pairs = np.bitwise_count(bits).view(np.uint64)
        pairs = pairs[0::2] + pairs[1::2]
        self.sums = ((pairs & _BYTES) + ((pairs >> np.uint64(8)) & _BYTES)) * _SUM >> np.uint64(48)
        self.n = int(self.sums.sum())
        self.ends = None

    def price_at(self, ranks: Sequence[int]) -> list[float | None]:
        """The prices at these ranks, counted from 0; none for negative ranks."""
        if self.ends is None:
            self.ends = np.cumsum(self.sums)
        out, last, at = [], -1, None
        for rank in ranks:
            if rank < 0:
                out.append(None)
                continue
            block = int(np.searchsorted(self.ends, rank, "right"))
            if block != last:
                last, at = block, np.flatnonzero(np.unpackbits(self.bits[block * BLOCK : (block + 1) * BLOCK].view(np.uint8), bitorder="little"))
            out.append(float(self.price[block * BLOCK * 64 + at[rank - int(self.ends[block]) + len(at)]]))
        return out


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column of doubles; NaN for null."""
    return table.column(name).to_numpy()


def _spans(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, int, _Kept]:
    """For each range ``low`` to ``high`` its key, the key of everything, and by key the values that are in it or unknown.

    The key has the places of the range's ends among the distinct values, so ranges that hold the same values share one;
    an unknown range holds all.
    """
    known = ~np.isnan(values)
    levels = np.unique(values[known])
    width = len(levels) + 1
    codes = np.where(known, np.searchsorted(levels, values), -1).astype(np.int16 if width < 1 << 15 else np.int32)
    unknown = packed(~known)
    first, last = np.searchsorted(levels, low, "left"), np.searchsorted(levels, high, "right")
    keys = np.where(np.isnan(low), width - 1, np.where(first < last, first * width + last, 0))
    return keys, width - 1, _Kept(lambda k: packed((codes >= k // width) & (codes < k % width)) | unknown)


class Sales:
    """Sales in order of price, without those that are not above 0; ``met`` finds those of each item."""

    def __init__(self, sales: pa.Table):
        sales = sales.filter(pc.invert(pc.less_equal(sales.column("s_price"), 0.0)))  # null is left out, too
        price = _numbers(sales, "s_price")
        order = np.argsort(price, kind="stable")
        land, building, year = (_numbers(sales, f"s_{k}")[order] for k in ("land", "building", "year"))
        self.price = price[order]
        self.values = [np.where(land > 0, land, np.nan), np.where(building > 0, building, np.nan), year]
        district = sales.column("s_district").combine_chunks().dictionary_encode()
        self.codes, self.districts = district.indices.fill_null(-1).to_numpy(zero_copy_only=False)[order], district.dictionary.to_pylist()

    def _towns(self, towns: list[str | None]) -> tuple[np.ndarray, _Kept]:
        """For each town the number of the set of districts in its name, 0 for none, and by number the sales of such districts."""
        numbers, known = {(): 0}, {None: 0}
        for town in set(towns) - {None}:
            known[town] = numbers.setdefault(tuple(k for k, d in enumerate(self.districts) if d and d in town), len(numbers))
        sets = list(numbers)

        def own(number: int) -> np.ndarray:
            inside = np.zeros(len(self.districts) + 1, dtype=bool)  # the last one for sales without any
            inside[list(sets[number])] = True
            return packed(inside[self.codes])

        return np.array([known[t] for t in towns], dtype=np.int64), _Kept(own)

    def met(self, items: pa.Table, low: float, high: float, years: int) -> Iterator[tuple[np.ndarray, Met, Met | None]]:
        """Places of items that meet the same sales, those sales, and which of them are of the items' own district, if it has any.

        Items come in the order of their ranges, so neighbours share what their ranges have in common.
        """
        land, building, year = (_numbers(items, f"i_{k}") for k in ("land", "building", "year"))
        spans = [_spans(v, a, b) for v, a, b in zip(self.values, (land * low, building * low, year - years), (land * high, building * high, year + years))]
        towns, of_town = self._towns(items.column("i_district").to_pylist())
        columns = [*(s[0] for s in spans), towns]
        order = np.lexsort(columns[::-1])
        rows = np.column_stack(columns)[order]
        starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
        everything = packed(np.ones(len(self.price), dtype=bool))

        def within(bits: np.ndarray, k: int, key: int) -> np.ndarray:
            return bits if key == spans[k][1] else bits & spans[k][2][key]

        before = (None,) * 3
        for group, (a, b, c, town) in zip(np.split(order, starts[1:]), rows[starts].tolist()):
            if a != before[0]:
                of_land = within(everything, 0, a)
            if (a, b) != before[:2]:
                of_sizes = within(of_land, 1, b)
            if (a, b, c) != before:
                every = Met(self.price, within(of_sizes, 2, c))
            before = a, b, c
            yield group, every, Met(self.price, every.bits & of_town[town]) if town else None
