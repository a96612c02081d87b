"""Text, identifier and safe-number columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters kept in file names.
_UNSAFE = r"[^0-9A-Za-z._-]"

# Bomb event texts, tried in this order.
BOMB_EVENTS: list[tuple[str, tuple[str, ...]]] = [
    ("planted", ("plant",)),
    ("defused", ("defus",)),
    ("explode", ("explod", "explode", "detonat")),
]

# Team numbers and side spellings.
TEAM_OF_NUMBER = {2: "T", 3: "CT"}
TEAM_OF_SIDE = {"ct": "CT", "t": "T"}
OTHER_TEAM_OF_SIDE = {"ct": "T", "t": "CT"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_slug(c) -> Column:
    """One underscore for every unsafe character."""
    return F.regexp_replace(_col(c), _UNSAFE, "_")


def slugify(c) -> Column:
    """One underscore per run of unsafe characters, none at the ends."""
    return F.btrim(F.regexp_replace(_col(c), _UNSAFE + "+", "_"), F.lit("_"))


def number(c) -> Column:
    """Numeric value, NULL where the text is not a number."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def finite(c) -> Column:
    """NULL instead of NaN and the infinities."""
    value = _col(c).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def whole(c) -> Column:
    """Whole number, NULL where the text is not a number."""
    return number(c).try_cast("bigint")


def flag(c) -> Column:
    """Boolean, number or text as a nullable 0/1 integer."""
    return _col(c).try_cast("int")


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """``a != b`` where a missing value differs from everything."""
    return a.isNull() | b.isNull() | (a != b)


def lookup(c: Column, mapping: dict) -> Column:
    """Constant lookup; NULL for values that are not listed."""
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def event_label(c, labels: Sequence[tuple[str, tuple[str, ...]]] = BOMB_EVENTS, skip: Sequence[str] = ()) -> Column:
    """First label one of whose patterns occurs in the lower-cased text, else NULL."""
    text = F.lower(_col(c))
    out = F.lit(None).cast("string")
    for label, patterns in reversed([x for x in labels if x[0] not in skip]):
        hit = F.lit(False)
        for p in patterns:
            hit = hit | text.contains(p)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def stable_id(*parts, length: int = 16) -> Column:
    """Short SHA-1 of the parts, each followed by ``|``; a missing part reads ``None``."""
    pieces: list[Column] = []
    for p in parts:
        pieces += [F.coalesce(_col(p).cast("string"), F.lit("None")), F.lit("|")]
    return F.substring(F.sha1(F.concat(*pieces).cast("binary")), 1, length)
