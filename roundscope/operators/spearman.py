"""Spearman correlation of all feature pairs over the rows where both are known."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import finite
from ..session import BROADCAST_ROWS, stored
from .distribution import ROWS_PER_RANGE, prefix_counts

# A value that more than one in so many entries hold has its ranks broadcast: there are fewer such values than this.
FREQUENT_SHARE = 1000


def _null_classes(df: DataFrame, features: Sequence[str]) -> list[int]:
    """For each feature the first feature that is missing in exactly the same rows."""
    pairs = list(combinations(range(len(features)), 2))
    leader = list(range(len(features)))
    if not pairs:
        return leader
    apart = df.agg(
        *[F.expr(f"bool_or((`{features[i]}` IS NULL) <> (`{features[j]}` IS NULL)) AS `{i}_{j}`") for i, j in pairs]
    ).first()
    for i, j in pairs:
        if leader[j] == j and leader[i] == i and not apart[f"{i}_{j}"]:
            leader[j] = i
    return leader


def ranked_entries(entries: DataFrame, ranks: DataFrame, total: int) -> DataFrame:
    """Entries (_row, f, value) with the ranks of their value.

    Values that a large share of the entries hold are looked up by broadcast, the others meet in one shuffle, where no
    value has many rows.
    """
    frequent = F.col("_n") > max(1, total // FREQUENT_SHARE)
    few = F.broadcast(ranks.filter(frequent))
    often = entries.join(few, ["f", "value"])
    seldom = entries.join(few.select("f", "value"), ["f", "value"], "left_anti").join(ranks.filter(~frequent), ["f", "value"])
    return often.unionByName(seldom)


def few_valued(distinct: Mapping[int, int], limit: int) -> list[int]:
    """Features whose rank tables, the smallest first, hold no more values together than every executor may hold."""
    chosen, held = [], 0
    for f, n in sorted(distinct.items(), key=lambda item: (item[1], item[0])):
        held += n
        if held > limit:
            break
        chosen.append(f)
    return sorted(chosen)


def spearman_matrix(
    df: DataFrame, features: Sequence[str], rows_per_range: int = ROWS_PER_RANGE, broadcast_values: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows (f1, f2, rho, n) of the full symmetric matrix; rho is NULL where a feature is constant.

    The ranks of a feature depend on the partner only through the rows where the partner is missing,
    so each feature is ranked once per distinct pattern of missing values, not once per pair. Ranks
    are twice the centred average rank: whole numbers whose mean is zero. Sizes and variances follow
    from the rank table alone; only the products need the rows. Features with few distinct values
    look their ranks up by broadcast, and their rows stay where they are; all such tables together have at
    most ``broadcast_values`` values. The others are taken as entries (row, feature, value): one join
    gives every entry its ranks, whatever the number of features, and one shuffle brings the entries
    of a row together. No pair of features ever becomes a row.
    """
    features = list(features)
    rows = stored(df.select(F.monotonically_increasing_id().alias("_row"), *[(finite(f) + F.lit(0.0)).alias(f) for f in features]))
    leader = _null_classes(rows, features)
    slot = {m: k for k, m in enumerate(sorted(set(leader)))}

    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("value")) for i, f in enumerate(features)])
    known = [F.col(features[m]).isNotNull().cast("int").alias(f"_k{k}") for m, k in slot.items()]
    values = rows.select(*known, F.inline(cells)).filter(F.col("value").isNotNull())
    names = [f"_n{k}" for k in slot.values()]
    counts = [F.sum(f"_k{k}").alias(f"_n{k}") for k in slot.values()]
    per_value = values.groupBy("f", "value").agg(F.count(F.lit(1)).alias("_n"), *counts)
    table = prefix_counts(stored(per_value), "value", ["f"], names, rows_per_range)
    centred = [(2 * F.col(f"{n}_below") + F.col(n) - F.col(f"{n}_total")).cast("double").alias(f"_c{n}") for n in names]
    ranks = stored(table.select("f", "value", "_n", *names, *centred))

    # One row per feature, so a fixed number of rows comes to the driver.
    spread = ranks.groupBy("f").agg(
        F.sum("_n").alias("entries"),
        F.count(F.lit(1)).alias("distinct"),
        *[F.sum(n).alias(f"n{n}") for n in names],
        *[F.sum(F.col(n) * F.col(f"_c{n}") * F.col(f"_c{n}")).alias(f"v{n}") for n in names],
    )
    sizes = {r["f"]: r for r in spread.collect()}

    def partner(j: int) -> str:
        return names[slot[leader[j]]]

    pairs = list(combinations(range(len(features)), 2))
    needed = sorted({(i, partner(j)) for i, j in pairs} | {(j, partner(i)) for i, j in pairs})
    few = few_valued({f: r["distinct"] for f, r in sizes.items()}, broadcast_values)
    many = [i for i in sizes if i not in few]
    wide = rows
    for i in few:
        ranks_of = [F.col(f"_c{n}").alias(f"_r{i}{n}") for k, n in needed if k == i]
        if ranks_of:
            wide = wide.join(F.broadcast(ranks.filter(F.col("f") == i).select(F.col("value").alias(features[i]), *ranks_of)), features[i], "left")
    if many:
        entries = rows.select("_row", F.inline(cells)).filter(F.col("value").isNotNull() & F.col("f").isin(many))
        ranked = ranked_entries(entries, ranks.drop(*names), sum(sizes[i]["entries"] for i in many))
        # Dealt by row before they are gathered, so that an entry travels as it is and not as a row of all ranks.
        gathered = ranked.repartition("_row").groupBy("_row").agg(
            *[F.expr(f"max(_c{n}) FILTER (WHERE f = {i}) AS _r{i}{n}") for i, n in needed if i in many]
        )
        wide = wide.join(gathered, "_row", "left")
    # A feature without a value has no ranks.
    for i, n in needed:
        if i not in sizes:
            wide = wide.withColumn(f"_r{i}{n}", F.lit(None).cast("double"))

    # A rank is NULL where its feature is, so a product counts only rows where both are known.
    products = [F.expr(f"sum(_r{i}{partner(j)} * _r{j}{partner(i)}) AS _{i}_{j}") for i, j in pairs]
    sums = wide.agg(F.count(F.lit(1)), *products)

    def cell(i: int, j: int) -> str:
        """One cell of the matrix as SQL text."""
        n = sizes[i][f"n{partner(j)}"] if i in sizes else 0
        vi = sizes[i][f"v{partner(j)}"] if i in sizes else 0.0
        vj = sizes[j][f"v{partner(i)}"] if j in sizes else 0.0
        if not (n and vi and vj):
            rho = "CAST(NULL AS DOUBLE)"
        elif i == j:
            rho = "1.0D"
        else:
            rho = f"_{min(i, j)}_{max(i, j)} / {vi**0.5 * vj**0.5!r}D"
        return f"struct({i} AS i, {j} AS j, {rho} AS rho, {int(n or 0)}L AS n)"

    grid = ", ".join(cell(i, j) for i in range(len(features)) for j in range(len(features)))
    names_of = F.array(*[F.lit(f) for f in features])
    return sums.select(F.expr(f"inline(array({grid}))")).select(
        names_of[F.col("i")].alias("f1"), names_of[F.col("j")].alias("f2"), "rho", "n"
    )
