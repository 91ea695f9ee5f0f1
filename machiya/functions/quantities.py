"""Numbers with units in text: segmenting unit strings over tries, and reading the number before them.

A unit is ``[power word] prefix* root [exponent]`` in any mixture of scripts.  All readings of a unit string are found
by dynamic programming over three tries; which one is meant follows from what the field measures.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

# Multipliers, roots as (dimension, power, factor to the base unit yen or metre), exponents.
PREFIXES = {
    "百": 1e2, "千": 1e3, "万": 1e4, "萬": 1e4, "億": 1e8, "兆": 1e12, "十": 1e1,
    "da": 1e1, "h": 1e2, "k": 1e3, "K": 1e3, "M": 1e6, "G": 1e9, "d": 1e-1, "c": 1e-2, "m": 1e-3,
    "キロ": 1e3, "ヘクト": 1e2, "センチ": 1e-2, "ミリ": 1e-3, "メガ": 1e6,
    "thousand": 1e3, "million": 1e6, "mil": 1e6, "mn": 1e6, "mm": 1e6, "MM": 1e6, "billion": 1e9, "bn": 1e9, "man": 1e4, "oku": 1e8,
}
ROOTS = {
    "円": ("money", 1, 1.0), "圓": ("money", 1, 1.0), "yen": ("money", 1, 1.0), "jpy": ("money", 1, 1.0), "¥": ("money", 1, 1.0), "\\": ("money", 1, 1.0),
    "m": ("length", 1, 1.0), "メートル": ("length", 1, 1.0), "米": ("length", 1, 1.0), "meter": ("length", 1, 1.0), "metre": ("length", 1, 1.0), "meters": ("length", 1, 1.0), "metres": ("length", 1, 1.0),
    "ft": ("length", 1, 0.3048), "feet": ("length", 1, 0.3048), "foot": ("length", 1, 0.3048), "フィート": ("length", 1, 0.3048), "yd": ("length", 1, 0.9144), "ヤード": ("length", 1, 0.9144),
    "a": ("length", 2, 100.0), "アール": ("length", 2, 100.0), "are": ("length", 2, 100.0), "ares": ("length", 2, 100.0),
    "ヘクタール": ("length", 2, 10000.0), "hectare": ("length", 2, 10000.0), "hectares": ("length", 2, 10000.0),
    "acre": ("length", 2, 4046.8564224), "acres": ("length", 2, 4046.8564224), "エーカー": ("length", 2, 4046.8564224),
    "坪": ("length", 2, 400 / 121), "つぼ": ("length", 2, 400 / 121), "ツボ": ("length", 2, 400 / 121), "tsubo": ("length", 2, 400 / 121), "歩": ("length", 2, 400 / 121),
    "畝": ("length", 2, 12000 / 121), "反": ("length", 2, 120000 / 121),
}
EXPONENTS = {"2": 2, "^2": 2, "**2": 2, "3": 3, "^3": 3}
POWER_WORDS = {"平方": 2, "平": 2, "sq": 2, "square": 2, "立方": 3, "cubic": 3}
KANJI_DIGITS = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "壱": 1, "弐": 2, "参": 3}

_SMALL, _BIG = {"十": 1e1, "百": 1e2, "千": 1e3}, {"万": 1e4, "萬": 1e4, "億": 1e8, "兆": 1e12}
#: A segment's cost; a reading of the wrong dimension costs so much that any other wins.
_SEGMENT, _WRONG, _IMPLIED, _CASE = 1.0, 50.0, 1.5, 0.5


class Trie:
    """Longest-to-shortest lookups of all entries that start at a position."""

    def __init__(self, entries: dict):
        self.root: dict = {}
        for word, value in entries.items():
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {})
            node[None] = (word, value)

    def at(self, text: str, start: int):
        node, i = self.root, start
        while i < len(text) and text[i] in node:
            node = node[text[i]]
            i += 1
            if None in node:
                yield i, node[None]


_PREFIX, _ROOT, _EXP, _POW = Trie(PREFIXES), Trie(ROOTS), Trie(EXPONENTS), Trie(POWER_WORDS)


@dataclass(frozen=True)
class Field:
    """What a field measures: its dimension and power, its own unit, and the units a bare number in it may be meant in.

    ``units`` are (unit, cost): how unlikely, as a natural log of odds against the own unit, the field's numbers are in it.
    ``grain`` is the amount of which usual values are multiples, 0 if there is none.
    """

    dimension: str
    power: int
    unit: str
    units: tuple[tuple[str, float], ...] = ()
    grain: float = 0.0

    @property
    def own(self) -> float:
        """Factor of the field's own unit to the base unit (yen, metre)."""
        return unit_factor(self.unit, self.dimension, self.power)

    def scales(self) -> list[tuple[float, float]]:
        """(factor, cost) of every unit its numbers may be in, the own one first."""
        return [(self.own, 0.0)] + [(unit_factor(u, self.dimension, self.power), c) for u, c in self.units if u != self.unit]


#: Prices are written in 円 or 万円; 千円 and 百万円 are rare in this trade.
_PRICE_UNITS = (("円", 1.0), ("万円", 1.0), ("千円", 5.5), ("百万円", 6.0))
PRICE_YEN = Field("money", 1, "円", _PRICE_UNITS, 1e5)
PRICE_MAN = Field("money", 1, "万円", _PRICE_UNITS, 1e5)
TRADE_YEN = Field("money", 1, "円")
AREA_M2 = Field("length", 2, "平方メートル")


@lru_cache(maxsize=100_000)
def segment(unit: str, dimension: str, power: int) -> tuple[float, tuple[str, ...], float] | None:
    """The cheapest reading of a unit string for a field: (cost, multiplier words, factor of root and exponent).

    Dynamic programming over positions and stages (power word, prefixes, root, exponent).  A string of prefixes alone
    implies the field's root.  None when no segmentation covers the string.
    """
    n = len(unit)
    low = unit.lower()
    # best[(position, stage)] = (cost, power word, prefixes, root, exponent); stages: 0 start, 1 prefixes, 2 root, 3 done
    best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, 0, (), None, 0)}

    def put(key, state):
        if key not in best or state[0] < best[key][0]:
            best[key] = state

    for i in range(n):
        for stage in range(4):
            if (i, stage) not in best:
                continue
            cost, word, pre, root, exp = best[(i, stage)]
            if unit[i] in " ./・-,":
                put((i + 1, stage), (cost, word, pre, root, exp))
            if stage == 0 and not word:
                for j, (_, p) in _POW.at(low, i):
                    put((j, 0), (cost + _SEGMENT, p, pre, root, exp))
            if stage <= 1:
                for j, (w, _) in _PREFIX.at(unit, i):
                    put((j, 1), (cost + _SEGMENT, word, (*pre, w), root, exp))
                for j, (w, _) in _PREFIX.at(low, i):
                    put((j, 1), (cost + _SEGMENT + _CASE, word, (*pre, w), root, exp))
                for j, (_, r) in _ROOT.at(low, i):
                    # among the roots of one spelling the field's dimension decides at the end
                    put((j, 2), (cost + _SEGMENT + (_WRONG if r[0] != dimension else 0), word, pre, r, exp))
            if stage == 2:
                for j, (_, e) in _EXP.at(unit, i):
                    put((j, 3), (cost + _SEGMENT, word, pre, root, e))
    found = []
    for stage in range(4):
        if (n, stage) not in best:
            continue
        cost, word, pre, root, exp = best[(n, stage)]
        if root is None:
            if not pre or (power != 1 and word == 0):
                continue
            found.append((cost + _IMPLIED, pre, 1.0))
            continue
        times = exp or word or 1
        if root[0] != dimension or root[1] * times != power:
            cost += _WRONG
            found.append((cost, pre, math.nan))
            continue
        # SI prefixes are raised with the root they stand on; counting words multiply the number
        si = math.prod(PREFIXES[p] for p in pre if p.isascii() or p in ("キロ", "ヘクト", "センチ", "ミリ", "メガ")) if root[0] == "length" else 1.0
        words = () if root[0] == "length" and si != 1.0 else pre
        found.append((cost, words, (si * root[2]) ** times if root[1] == 1 else si * root[2]))
    found = [f for f in found if f[0] < _WRONG and not math.isnan(f[2])]
    return min(found, key=lambda f: f[0]) if found else None


def unit_factor(unit: str, dimension: str, power: int) -> float:
    """Factor of a unit to the base unit of its dimension, by its cheapest segmentation."""
    parsed = segment(unit, dimension, power)
    if parsed is None:
        raise ValueError(f"{unit} is no unit of {dimension} to the power {power}")
    _, words, factor = parsed
    return math.prod(PREFIXES[w] for w in words) * factor


_NUMBER = re.compile(r"[0-9][0-9,]*(?:\.[0-9]+)?|\.[0-9]+|[〇零一二三四五六七八九壱弐参]+")
_HEAD = re.compile(r"^[\s約およそ計総额額:：≒~〜+]*(?:approx\.?|about|ca\.?|c\.)?\s*", re.IGNORECASE)
_PARENS = re.compile(r"[(\[【〔（][^)\]】〕）]*[)\]】〕）]?")
_TAIL = re.compile(r"[\s\-‐–—―ー.。、,也程度前後くらいぐらい]+$")


def _digits(text: str) -> float:
    if text[0] in KANJI_DIGITS:
        return float("".join(str(KANJI_DIGITS[c]) for c in text))
    return float(text.replace(",", ""))


def read_quantity(text: str | None, field: Field) -> float | None:
    """The quantity a text states, in the field's base unit (yen, m²); None when it states none.

    Handles digits of any width, kanji numerals, compound sums such as 2億1,210万円, units before or after the number,
    and a second statement in brackets, which is ignored.  A bare number is in the field's own unit.  Zero and negative
    amounts state no quantity.
    """
    return read_statement(text, field)[0]


def read_statement(text: str | None, field: Field) -> tuple[float | None, bool]:
    """(quantity, bare): like ``read_quantity``; bare when the text is a number without any unit or counting word."""
    number, factor, bare = _statement(text, field)
    return (None if number is None else number * (field.own if bare else factor)), bare


def _statement(text: str | None, field: Field) -> tuple[float | None, float, bool]:
    """(number, factor, bare) of a text; the number is None when it states no quantity."""
    nothing = (None, 1.0, False)
    if text is None:
        return nothing
    s = unicodedata.normalize("NFKC", text)
    s = s.replace("−", "-").replace("，", ",")
    s = _HEAD.sub("", _PARENS.sub("", s).strip())
    s = _TAIL.sub("", s)
    if not s or s[0] == "-":
        return nothing
    # a leading unit string, then (number, unit string) pairs; counting words may open a number (千二百)
    first = re.search(r"[0-9]|[〇零一二三四五六七八九壱弐参十百千]", s)
    if first is None:
        return nothing
    lead, at = s[: first.start()].strip(), first.start()
    numbers: list[tuple[float | None, str]] = []
    while at < len(s):
        m = _NUMBER.match(s, at)
        value = None
        if m:
            value, at = _digits(m.group().rstrip(",")), m.end()
        stop = at
        while stop < len(s):
            m = _NUMBER.match(s, stop)
            if m and not (s[stop] in "23" and m.end() == stop + 1 and stop > at and re.match(r"[A-Za-z^*ルト]", s[stop - 1])):
                break
            stop += 1
        unit, at = s[at:stop].strip(), stop
        numbers.append((value, unit))
    total, section, number, factor, bare, seen = 0.0, 0.0, None, None, True, False
    for value, unit in numbers:
        if value is not None:
            if number is not None:
                return nothing  # two numbers without a unit between them are no quantity
            number = value
            seen = True
        words: tuple[str, ...] = ()
        if unit:
            parsed = segment(unit, field.dimension, field.power)
            if parsed is None:
                # a counting word or unit may be followed by other words: keep the longest readable head
                cut = next((c for c in range(len(unit) - 1, 0, -1) if segment(unit[:c], field.dimension, field.power)), 0)
                if not cut:
                    return nothing
                parsed = segment(unit[:cut], field.dimension, field.power)
            _, words, f = parsed
            bare = False
            rooted = any(r in unit.lower() for r in ROOTS if ROOTS[r][0] == field.dimension and (len(r) > 1 or not r.isascii())) or f != 1.0
            factor = f
        else:
            rooted = False
        for w in words:
            seen = True
            if w in _SMALL:
                section += (1.0 if number is None else number) * _SMALL[w]
                number = None
            elif w in _BIG:
                section += number or 0.0
                total += (section or 1.0) * _BIG[w]
                section, number = 0.0, None
            else:
                # no field of money counts thousandths: a small m is the million there
                number = (1.0 if number is None else number) * (1e6 if w == "m" and field.dimension == "money" else PREFIXES[w])
        if rooted:
            break
    value = total + section + (number or 0.0)
    if not seen or value <= 0:
        return nothing
    if lead:
        parsed = segment(lead, field.dimension, field.power)
        if parsed is not None:
            bare, factor = False, parsed[2]
        elif bare and not re.fullmatch(r"[^0-9]*[:：]?", lead):
            return nothing
    return value, factor or 1.0, bare
