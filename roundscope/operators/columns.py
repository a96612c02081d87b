"""Column bookkeeping for sources whose column names vary (decided while planning)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number


def pick(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def resolve(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first present candidate to its target; an existing target is kept."""
    renames: dict[str, str] = {}
    for target, candidates in names.items():
        if target in df.columns:
            continue
        found = next((c for c in candidates if c in df.columns and c not in renames), None)
        if found:
            renames[found] = target
    return df.withColumnsRenamed(renames) if renames else df


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[F.col(c) for c in columns if c in df.columns])


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns in front, unless the frame has them."""
    new = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in constants.items() if k not in df.columns]
    return df.select(*new, "*") if new else df


def add_missing(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add NULL columns of the given types where absent."""
    new = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def require(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Fail when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {missing}; it has {df.columns}")
    return df


# Coordinate triples in order of preference.
COORDINATES = [
    ("victim_X", "victim_Y", "victim_Z"),
    ("attacker_X", "attacker_Y", "attacker_Z"),
    ("killer_X", "killer_Y", "killer_Z"),
    ("X", "Y", "Z"),
    ("x", "y", "z"),
    ("posX", "posY", "posZ"),
    ("position_x", "position_y", "position_z"),
]


def coordinates(df: DataFrame, triples=COORDINATES) -> DataFrame:
    """Add x, y, z from the first triple whose three columns all exist."""
    if all(c in df.columns for c in ("x", "y", "z")):
        return df
    for triple in triples:
        if all(c in df.columns for c in triple):
            return df.withColumns({t: number(c) for t, c in zip("xyz", triple)})
    return df


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column a frame lacks is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def finite_or_null(df: DataFrame, columns: Sequence[str], drop_empty: bool = True) -> DataFrame:
    """Numbers with infinities as NULL; rows with no value at all are dropped."""
    value = {c: number(c) for c in columns}
    out = df.withColumns({c: F.when(F.abs(v) != float("inf"), v) for c, v in value.items()})
    return out.dropna(how="all", subset=list(columns)) if drop_empty else out


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys where a missing key matches a missing key."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = one if same is None else same & one
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])
