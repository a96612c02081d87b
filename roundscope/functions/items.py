"""Inventory texts and item categories."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item name fragments by category and the weight of each category in the score.
AWP = ["awp"]
RIFLES = [
    "ak-47", "ak47", "ak", "m4a1-s", "m4a1s", "m4a1", "m4a4", "famas", "galil ar", "galil", "aug", "sg 553", "sg553",
]
SMGS = ["mp9", "mac-10", "mac10", "mp7", "mp5-sd", "mp5sd", "ump-45", "ump45", "p90"]
HEAVY = ["nova", "xm1014", "mag-7", "mag7", "sawed-off", "sawed off", "m249", "negev"]
PISTOLS = [
    "glock-18", "glock", "usp-s", "usps", "p2000", "p250", "fiveseven", "five-seven", "tec-9", "tec9", "cz75-auto",
    "cz75a", "dual berettas", "desert eagle", "deagle", "r8 revolver", "revolver",
]
CATEGORIES: dict[str, list[str]] = {
    "awp": AWP, "rifles": RIFLES, "smgs": SMGS, "heavy": HEAVY, "pistols": PISTOLS,
}
WEIGHTS: dict[str, float] = {
    "awp": 6.0, "rifles": 3.0, "smgs": 1.5, "heavy": 1.5, "pistols": 0.5, "helmets": 0.75,
}

_STRINGS = "array<string>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _json_list(text: Column) -> Column:
    """Elements of a JSON list, NULL when the text is no list."""
    is_list = F.btrim(text).startswith("[") & F.btrim(text).endswith("]")
    return F.when(is_list, F.from_json(text, _STRINGS))


def _encode(values: Column) -> Column:
    """JSON list text with a blank after each comma."""
    quoted = F.transform(values, lambda x: F.to_json(F.array(x)))
    inner = F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    return F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]"))


def inventory_json(c, is_array: bool = False) -> Column:
    """Inventory as the text of a JSON list.

    An array is encoded; list text is re-encoded, broken list text gives ``[]``; bare
    text becomes a one-element list with its blanks kept; a missing value gives ``[]``.
    """
    value = _col(c)
    empty = F.lit("[]")
    if is_array:
        return F.coalesce(_encode(value), empty)
    trimmed = F.btrim(value)
    bracketed = trimmed.startswith("[") & trimmed.endswith("]")
    return (
        F.when(value.isNull(), empty)
        .when(bracketed, F.coalesce(_encode(F.from_json(trimmed, _STRINGS)), empty))
        .otherwise(_encode(F.array(value)))
    )


def items(c) -> Column:
    """Lower-cased elements of an inventory text, NULL for those that are; an unreadable text has none."""
    return F.transform(F.coalesce(_json_list(_col(c)), F.array().cast(_STRINGS)), F.lower)


def _matcher(tokens: Sequence[str]) -> str:
    return "|".join(re.escape(t) for t in sorted(set(tokens)))


def any_of(tokens: Sequence[str], item_list: Column) -> Column:
    """Whether some element contains one of the tokens."""
    pattern = _matcher(tokens)
    if not tokens:
        return F.lit(False)
    return F.exists(item_list, lambda x: F.coalesce(x.rlike(pattern), F.lit(False)))


def count_of(tokens: Sequence[str], item_list: Column) -> Column:
    """How many elements contain one of the tokens."""
    pattern = _matcher(tokens)
    return F.size(F.filter(item_list, lambda x: x.rlike(pattern))) if tokens else F.lit(0)


# A list of strings without escapes: its elements can be told apart by their quotes alone.
_PLAIN_LIST = r'^\s*\[\s*"[^"\\\x00-\x1F]*"(\s*,\s*"[^"\\\x00-\x1F]*")*\s*\]\s*$'


def is_plain(c) -> Column:
    """Whether an inventory text is a list of strings without escapes, as almost all are."""
    return F.coalesce(_col(c).rlike(_PLAIN_LIST), F.lit(False))


def count_in(tokens: Sequence[str], text, plain: Column, lowered: Column, present: bool = False) -> Column:
    """``count_of`` straight from an inventory text, or just 0 and 1 if only ``present`` is asked for.

    A plain list is searched quote by quote without being parsed; ``plain`` and ``lowered`` are
    computed once per text by the caller. Any other text is parsed.
    """
    if not tokens:
        return F.lit(0)
    parsed = items(text)
    if any(not t.strip(" ,\t") or '"' in t for t in tokens):
        return any_of(tokens, parsed).cast("int") if present else count_of(tokens, parsed)
    pattern = _matcher(tokens)
    hit = lowered.rlike(pattern)
    if present:
        return F.when(plain, hit.cast("int")).otherwise(any_of(tokens, parsed).cast("int"))
    quoted = F.lit(f'"[^"]*(?:{pattern})[^"]*"')
    found = F.when(hit, F.regexp_count(lowered, quoted)).otherwise(0)
    return F.when(plain, found).otherwise(count_of(tokens, parsed))


def score(weights: dict[str, float] = WEIGHTS) -> Column:
    """Weighted sum of the category columns of a team."""
    total = None
    for name, weight in weights.items():
        term = F.lit(weight) * F.col(name)
        total = term if total is None else total + term
    return total
