"""Source union and priority de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(sources, priority_col: str = "priority") -> DataFrame:
    """[(df, priority), ...] -> one DataFrame, each row tagged with its source
    priority; columns matched by name."""
    tagged = [df.withColumn(priority_col, F.lit(int(p))) for df, p in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def keep_top_priority(df: DataFrame, key, priority_col: str = "priority", null_keys: bool = True,
                      ends: tuple[int, int] | None = None) -> DataFrame:
    """Rows whose priority is the best (lowest) of their key; ties survive
    (``rank() = 1`` semantics).

    Expressed as min-per-key + semi join instead of a window: the aggregate is
    combined map-side, so a key holding a large share of all rows never sorts
    in one task, and AQE splits the skewed side of the join.  The per-key
    table grows with the data, so it is never broadcast (row-count estimates
    undersize long keys such as hashes): a shuffled hash join builds on it.
    ``null_keys=False`` (no key is NULL, as with hashes): an inner join on the
    keys alone, so the aggregate's partitioning serves the join and the
    minimum is computed once for all sources.  ``ends`` (with
    ``null_keys=False``): the best and the worst priority there are.  Rows of
    the best stay where they are, and keys of the worst beat no other row, so
    neither are shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ends is not None and not null_keys:
        p, given = F.col(priority_col), reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        first, rest = df.where(given & (p <= ends[0])), df.where(given & (p > ends[0]))
        better = df.where(p < ends[1]).groupBy(*keys).agg(F.min(priority_col).alias("_best"))
        better = better.select(*[F.col(k).alias(f"_best_{k}") for k in keys], "_best").hint("shuffle_hash")
        # an outer join: Spark would move an anti join into every source of the union
        kept = rest.join(better, [F.col(k) == F.col(f"_best_{k}") for k in keys], "left") \
            .where(F.col("_best").isNull() | (p <= F.col("_best")))
        return first.unionByName(kept.select(*df.columns))
    best = df.groupBy(*keys).agg(F.min(priority_col).alias("_best")).hint("shuffle_hash")
    if not null_keys:
        best = best.select(*[F.col(k).alias(f"_best_{k}") for k in keys], "_best").hint("shuffle_hash")
        cond = [df[k] == best[f"_best_{k}"] for k in keys] + [df[priority_col] <= best["_best"]]
        return df.join(best, cond).select(*df.columns)
    cond = [df[k].eqNullSafe(best[k]) for k in keys] + [df[priority_col] == best["_best"]]
    return df.join(best, cond, "left_semi")


def rank_top_priority(df: DataFrame, key, priority_col: str = "priority") -> DataFrame:
    """Window form of the same rule (``rank() over (partition by key order by
    priority) = 1``); kept for small inputs and as a cross-check."""
    from pyspark.sql import Window
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(priority_col)
    return df.withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")
