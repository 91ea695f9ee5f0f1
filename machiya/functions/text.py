"""Text columns: usable values, numbers in text, addresses, layouts, surrogate keys.  Built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits and letters of full width, and the spellings that stand for a missing value in each vocabulary.
WIDE_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
WIDE_LETTERS = "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
EMPTY_TEXT = ("", "-")
EMPTY_VALUATION = ("", "-", "不明")
EMPTY_DETAIL = ("", "-", "－", "不明", "未定")
EMPTY_AUDIT = ("", "-", "－", "不明", "未定", "なし", "N/A")
BLANKS = r"[\s　]+"


def strip(c: Column) -> Column:
    """Without outer blanks of any width."""
    return F.regexp_replace(c, r"^[\s　]+|[\s　]+$", "")


def usable(c: Column, empty: Sequence[str] = EMPTY_TEXT) -> Column:
    """Not null, and not one of the vocabulary's spellings of nothing; never null itself."""
    return c.isNotNull() & ~F.coalesce(strip(c.cast("string")).isin(*empty), F.lit(False))


def first_usable(columns: Sequence[Column], empty: Sequence[str] = EMPTY_TEXT) -> Column:
    """The first usable text among aliases, stripped; null if none is."""
    return F.coalesce(*[F.when(usable(c, empty), strip(c.cast("string"))) for c in columns])


def fold_digits(c: Column) -> Column:
    """ASCII digits and point for those of full width."""
    return F.translate(c, WIDE_DIGITS + "．", DIGITS + ".")


def fold_width(c: Column) -> Column:
    """ASCII digits and letters for those of full width."""
    return F.translate(c, WIDE_DIGITS + WIDE_LETTERS, DIGITS + LETTERS)


def lenient_number(c: Column) -> Column:
    """The first unsigned number in a text, if positive; thousands separators are dropped, digits of any width count."""
    found = F.regexp_extract(fold_digits(F.regexp_replace(c.cast("string"), ",", "")), r"[0-9]+(?:\.[0-9]+)?", 0)
    value = F.nullif(found, F.lit("")).try_cast("double")
    return F.when(value > 0, value)


def signed_number(c: Column) -> Column:
    """Like ``lenient_number`` but zero and a sign are kept."""
    found = F.regexp_extract(fold_digits(F.regexp_replace(c.cast("string"), "[,，]", "")), r"-?[0-9]+(?:\.[0-9]+)?", 0)
    return F.nullif(found, F.lit("")).try_cast("double")


def whole_number(c: Column) -> Column:
    """A number only if the whole text is one."""
    s = strip(fold_digits(F.regexp_replace(c.cast("string"), ",", "")))
    return F.when(s.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$"), s.try_cast("double"))


def number_text(value: Column, decimals: int = 2) -> Column:
    """A number as canonical text: fixed decimals without trailing zeros; empty for null."""
    fixed = F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", value))
    return F.coalesce(F.regexp_replace(fixed, r"\.?0+$", "") if decimals > 0 else fixed, F.lit(""))


def clean(c: Column) -> Column:
    """Runs of blanks of any width as one space, outer ones removed."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def clean_value(c: Column, invalid: Sequence[str], notes: Sequence[str], promotional: Sequence[str]) -> Column:
    """A labelled value without page furniture: text from a note on, and bracketed remarks, are cut; promotion is null."""
    from re import escape

    s = F.regexp_replace(clean(c), r"\s*(?:" + "|".join(map(escape, notes)) + r").*$", "")
    s = F.trim(F.regexp_replace(s, r"\s*(?:\[[^\]]*\]|［[^］]*］|【[^】]+】)", ""))
    return F.when(~s.isin(*invalid) & ~s.rlike("|".join(map(escape, promotional))), s)


def market_address(c: Column) -> Column:
    """Address for equality tests: digits folded, blanks out, number units as dashes, runs of dashes as one."""
    s = F.translate(F.coalesce(c, F.lit("")), WIDE_DIGITS + "ヶ之　 ", DIGITS + "ケの")
    s = F.regexp_replace(F.regexp_replace(s, r"丁目|番地|番", "-"), "号", "")
    return F.regexp_replace(F.trim(s), r"[-ー―‐−]+", "-")


def identity_address(c: Column) -> Column:
    """Address for identity keys: also letters folded, punctuation out, lower case, no outer dashes."""
    s = F.translate(fold_width(F.coalesce(c, F.lit(""))), "－―‐−ー", "-----")
    s = F.regexp_replace(F.regexp_replace(s, r"丁目|番地|番", "-"), r"号|[\s　,，、。．.()（）【】\[\]「」『』]", "")
    return F.regexp_replace(F.lower(F.regexp_replace(s, "-+", "-")), r"^-+|-+$", "")


def bare_address(c: Column) -> Column:
    """Address for grouping: blanks, dashes and number units out altogether."""
    return F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), WIDE_DIGITS, DIGITS), r"[\s　\-ー－―‐−]|丁目|番地|番|号", "")


def digit_runs(address: Column) -> Column:
    """How many runs of digits an address has; two or more name a house."""
    return F.regexp_count(address, F.lit("[0-9]+"))


def layout_token(c: Column) -> Column:
    """Room layout: the first of nLDK, nDK, nLK, nK with an optional +S, upper case and half width; null if none."""
    s = F.upper(F.translate(fold_width(c), "＋", "+"))
    tail = r"(?:\s*\+\s*(?:[0-9]+\s*)?S)?"
    kinds = [F.nullif(F.regexp_extract(s, r"[0-9]+\s*" + k + tail, 0), F.lit("")) for k in ("LDK", "DK", "LK", "K")]
    return clean(F.coalesce(*kinds))


def area_m2(c: Column, bare: bool = False) -> Column:
    """A positive area in text with a unit of square metres; a number without unit only if the label allows it."""
    s = F.replace(F.replace(fold_digits(F.regexp_replace(clean(c), "[,，]", "")), F.lit("平方メートル"), F.lit("m2")), F.lit("㎡"), F.lit("m2"))
    found = F.regexp_extract(F.translate(s, "ｍ²Ｍ", "m2m"), r"(?<![A-Za-z0-9])([0-9]+(?:\.[0-9]+)?)\s*m\s*\^?\s*2", 1)
    value = F.nullif(found, F.lit("")).try_cast("double")
    if bare:
        value = F.coalesce(value, F.when(s.rlike(r"^[0-9]+(?:\.[0-9]+)?$"), s.try_cast("double")))
    return F.when(value > 0, value)


def stable_key(c: Column, prefix: str = "", length: int = 20) -> Column:
    """Prefix and the first hexadecimal digits of SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(c, 256), 1, length))


def pair_key(a: Column, b: Column, prefix: str = "dup:") -> Column:
    """Surrogate key of an unordered pair."""
    return stable_key(F.concat_ws("|", F.least(a, b), F.greatest(a, b)), prefix)


def class_of(c: Column, terms: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The class of the first term that occurs in a text; the default if none does or the text is null."""
    out = F.lit(default)
    for term, name in reversed(terms):
        out = F.when(c.contains(term), F.lit(name)).otherwise(out)
    return out


def alias_of(c: Column, aliases: dict[str, str], keep: bool = True) -> Column:
    """Canonical name of an alias; a text that is no alias stays, or is null without ``keep``."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), c)
    return F.coalesce(known, c) if keep else known
