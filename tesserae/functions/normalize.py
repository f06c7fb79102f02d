"""Conservative normalisation of place names, as Arrow UDFs and column expressions.

What could merge two different names is left alone. All profiles are idempotent.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Numerals, and the dashes that count as a hyphen between digits.
DIGITS = "〇一二三四五六七八九"
ZEROS = "零"
UNITS = {"十": 10, "百": 100}
DASHES = "‐‑‒–—―−－ー"

_NUMERAL = f"[{DIGITS}{ZEROS}{''.join(UNITS)}]+"
_GROUP = re.compile(f"([{DIGITS}{ZEROS}]*)([{''.join(UNITS)}]?)")


def numeral(text: str | None) -> int | None:
    """A numeral up to 999. Digits alone are positional. Otherwise each group of digits and a unit counts the last of its digits (one, if it
    has none) times the unit; 0 and anything else is None."""
    if not text:
        return None
    values = [0 if c in ZEROS else DIGITS.find(c) for c in text]
    if min(values) >= 0:
        return int("".join(map(str, values)))
    if re.fullmatch(_NUMERAL, text) is None:
        return None
    total = 0
    for digits, unit in _GROUP.findall(text):
        last = (0 if digits[-1] in ZEROS else DIGITS.find(digits[-1])) if digits else 0
        total += (last or 1) * UNITS[unit] if unit else last
    return total or None


def conservative(name: str | None) -> str:
    """NFKC without white space, to a fixed point (four passes at most); numerals before 丁目 in figures; one hyphen between digits."""
    text = name or ""
    for _ in range(4):
        before, text = text, re.sub(r"\s+", "", unicodedata.normalize("NFKC", text))
        if text == before:
            break
    number = lambda m: m[0] if (n := numeral(m[1])) is None else f"{n}丁目"
    text = re.sub(f"({_NUMERAL})丁目", number, text)
    return re.sub(rf"(?<=\d)[{DASHES}](?=\d)", "-", text)


@F.pandas_udf(StringType())
def _conservative(names: pd.Series) -> pd.Series:
    """Each distinct name of a batch is normalised once."""
    names = names.fillna("")
    return names.map({n: conservative(n) for n in names.unique()})


def normalize_conservative(name: Column) -> Column:
    """NULL becomes empty. Of an ASCII name only white space can go, so it stays in the JVM; only the others are sent to Python."""
    plain = F.length(name) == F.octet_length(name)
    bare = F.regexp_replace(name, r"[\x09-\x0D\x1C-\x20]+", "")
    return F.when(name.isNull(), "").when(plain, bare).otherwise(_conservative(F.when(~plain, name)))


def normalize_relaxed(name: Column) -> Column:
    """Conservative, without one leading 大字 or 字."""
    return F.regexp_replace(normalize_conservative(name), "^(大字|字)", "")


def normalize_postal_town(name: Column) -> Column:
    """Conservative, of the name without parenthesised parts (half or full width)."""
    return normalize_conservative(F.regexp_replace(F.coalesce(name, F.lit("")), "[（(][^）)]*[）)]", ""))


def full_name(*parts: Column) -> Column:
    """Parts of a name in one string, NULL as empty."""
    return F.concat_ws("", *parts)


def with_normalized(df: DataFrame, column: str, out: str, profile=normalize_conservative) -> DataFrame:
    """Normalise distinct names only, then join them back: for columns with many repeats."""
    names = df.select(column).distinct().withColumn(out, profile(F.col(column)))
    return df.join(names, df[column].eqNullSafe(names[column]), "left").drop(names[column])


def license_text_hash(html: Column) -> Column:
    """SHA-256 of a page's text: scripts, styles, markup and white space do not count."""
    bare = F.regexp_replace(F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</(script|style)>", ""), "<[^>]*>", "")
    return F.sha2(F.regexp_replace(bare, "[ \\t\\n\\r\\f\\x0b]+", ""), 256)


def acquisition_stamp(df: DataFrame, stamp: str, attested: str) -> DataFrame:
    """One row, ``stamp``: the latest attested instant, as it was written; NULL without any. What does not parse is skipped."""
    at = F.coalesce(*[F.try_to_timestamp(F.col(stamp), F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss")])
    return df.filter(attested).agg(F.max_by(stamp, at).alias("stamp"))
