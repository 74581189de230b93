"""Caps, budgets and early stops as declarative operators.

All of them follow an order column. Caps over a whole relation would need one
sequential pass; here they are made of distributed parts: positions come from
per-group windows or from counts of chunks of the order (see `running`), so no
task sees all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(group: list[str]) -> list[Column]:
    return [F.col(f"`{g}`") for g in group]


# Rows of a range of the order that one task may add up.
RANGE_ROWS = 200_000


def _range_of(df: DataFrame, seq: str, rows: int, least: int = 1) -> Column:
    """The number of a row's range: ranges hold about `rows` rows each, however seq is spread; there are `least` at least.

    Bounds are quantiles of seq, looked up by binary search in an array literal.
    """
    n = max(least, -(-df.select(seq).count() // rows))
    if n <= 1:
        return F.lit(0)
    at = F.array(*[F.lit(k / n) for k in range(1, n)])
    bounds = sorted(set(df.agg(F.percentile_approx(seq, at, 50 * n).alias("b")).first().b or []))
    steps = max(1, len(bounds).bit_length())
    table = F.array(*map(F.lit, bounds))
    # bounds below seq are counted: by the highest bit first, a step that leads beyond the array is not taken
    widths = F.array(*[F.lit(1 << (steps - 1 - k)) for k in range(steps)])
    return F.aggregate(widths, F.lit(0), lambda i, w: F.when(F.coalesce(F.get(table, i + w - F.lit(1)) < F.col(seq), F.lit(False)), i + w).otherwise(i))


def running(df: DataFrame, seq: str, values: dict[str, Column], *, group: list[str] | None = None, most: bool = False, rows: int = RANGE_ROWS, chunks: int = 1) -> DataFrame:
    """Adds sums of `values` over all rows before each row, in the order of seq; with `most` their maxima, null where there is none.

    Rows are split into ranges of seq of about equal size, more of them the more
    rows there are; each range is summed on its own, sums of ranges are
    accumulated (one row for each range and group), and added. So the pass is
    distributed even for a single group, one that holds most rows, or an order
    with far-off values; `chunks` asks for that many ranges at least. seq must be
    numeric, not null and unique within the group.
    """
    group = group or []
    of = F.max if most else F.sum
    none = F.lit(None) if most else F.lit(0)
    chunked = df.withColumns({f"__v_{k}": v for k, v in values.items()}).withColumn("__chunk", _range_of(df, seq, rows, chunks))
    sums = chunked.groupBy(*_by(group), "__chunk").agg(*[of(f"__v_{k}").alias(f"__s_{k}") for k in values])
    before = Window.partitionBy(*_by(group)).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*_by(group), "__chunk", *[F.coalesce(of(f"__s_{k}").over(before), none).alias(f"__o_{k}") for k in values])
    inner = Window.partitionBy(*_by(group), "__chunk").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.withColumns({f"__l_{k}": F.coalesce(of(f"__v_{k}").over(inner), none) for k in values})
    joined = local.alias("l").join(offsets.alias("o"), [F.col(f"l.`{g}`").eqNullSafe(F.col(f"o.`{g}`")) for g in group] + [F.col("l.__chunk") == F.col("o.__chunk")])
    both = (lambda x, y: F.greatest(x, y)) if most else (lambda x, y: x + y)
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], *[both(F.col(f"l.__l_{k}"), F.col(f"o.__o_{k}")).alias(k) for k in values])


def cap(df: DataFrame, n: int | None, seq: str, group: list[str] | None = None) -> DataFrame:
    """The first n rows in order, of each group if given; all rows if n is None. Without groups Spark takes the ordered top n."""
    if n is None:
        return df
    if not group:
        return df.orderBy(seq).limit(n)
    # rank limits are pushed below the shuffle, so a group's task receives at most n rows from each other task
    rank = Window.partitionBy(*_by(group)).orderBy(seq)
    return df.withColumn("__rank", F.row_number().over(rank)).where(F.col("__rank") <= n).drop("__rank")


def cap_reached(df: DataFrame, n: int, group: list[str]) -> DataFrame:
    """Per group: rows, and whether the cap is reached, also by exactly n rows."""
    return df.groupBy(*group).agg(F.count("*").alias("rows"), (F.count("*") >= n).alias("cap_reached"))


def cap_by_page(df: DataFrame, n: int, page: str, group: list[str]) -> DataFrame:
    """Whole pages until at least n rows are there: a page begun below the cap is taken in full, so the cap may be overshot."""
    pages = df.groupBy(*_by(group), F.col(f"`{page}`").alias("__page")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*_by(group)).orderBy("__page").rowsBetween(Window.unboundedPreceding, -1)
    taken = pages.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).where(F.col("__before") < n).select(*[F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(group)], "__page")
    cond = [F.col(f"`{g}`").eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)] + [F.col(f"`{page}`").eqNullSafe(F.col("__page"))]
    return df.join(taken, cond, "left_semi")


def success_budget(df: DataFrame, n: int, ok: Column, seq: str, group: list[str] | None = None, rows: int = RANGE_ROWS) -> DataFrame:
    """Rows tried while fewer than n successes came before; failures are free. `ok` null counts as a failure."""
    done = running(df, seq, {"successes_before": F.coalesce(ok, F.lit(False)).cast("long")}, group=group, rows=rows)
    return done.where(F.col("successes_before") < n)


def stop_after_streak(df: DataFrame, k: int, failed: Column, seq: str, group: list[str], rows: int = RANGE_ROWS) -> DataFrame:
    """Rows up to and with the k-th failure in a row; a success ends a streak. Null counts as no failure.

    streak is the number of failures in a row that end at a row: the failures
    up to it less those before the last success. Both come from `running`, so a
    group of any size is split among tasks.
    """
    marked = df.withColumn("__bad", F.coalesce(failed, F.lit(False)))
    counted = running(marked, seq, {"__before": F.col("__bad").cast("long")}, group=group, rows=rows)
    based = running(counted, seq, {"__base": F.when(~F.col("__bad"), F.col("__before"))}, group=group, most=True, rows=rows)
    streaks = based.withColumn("streak", F.when(F.col("__bad"), F.col("__before") + 1 - F.coalesce("__base", F.lit(0))).otherwise(F.lit(0)).cast("long"))
    end = streaks.where(F.col("streak") >= k).groupBy(*[F.col(f"`{g}`").alias(f"__g{i}") for i, g in enumerate(group)]).agg(F.min(f"`{seq}`").alias("__stop"))
    cond = [F.col(f"`{g}`").eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    kept = streaks.join(end, cond, "left") if group else streaks.crossJoin(end)
    return kept.where(F.col("__stop").isNull() | (F.col(f"`{seq}`") <= F.col("__stop"))).select(*[F.col(f"`{c}`") for c in [*df.columns, "streak"]])


def stop_at_stale_pages(df: DataFrame, k: int, page: str, key: str, group: list[str]) -> DataFrame:
    """Pages up to and with the k-th in a row that brings no new key, or up to the first without any key.

    A key is new on the page where it first occurs within the group. Pages with
    only null keys count as empty.
    """
    first = df.where(F.col(f"`{key}`").isNotNull()).groupBy(*_by(group), key).agg(F.min(page).alias("__first"))
    new = first.groupBy(*_by(group), F.col("__first").alias(page)).agg(F.count("*").alias("new"))
    pages = df.groupBy(*_by(group), page).agg(F.count(key).alias("found")).join(new, [*group, page], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    w = Window.partitionBy(*_by(group)).orderBy(page)
    empty = pages.where("found = 0").groupBy(*_by(group)).agg(F.min(page).alias("__empty"))
    stale = stop_after_streak(pages, k, F.col("new") == 0, page, group)
    kept = stale.join(empty, group, "left").where(F.col("__empty").isNull() | (F.col(page) <= F.col("__empty"))).select(*group, page)
    return df.join(kept, [*group, page], "left_semi")


def page_cap(df: DataFrame, page: str, n: int, total: Column | None = None) -> DataFrame:
    """Pages 1 to n, and no further than the total of pages where one is known (null, 0 or unparsable: the first page only)."""
    limit = F.lit(n) if total is None else F.least(F.lit(n), F.greatest(F.coalesce(total.try_cast("int"), F.lit(1)), F.lit(1)))
    return df.where(F.col(f"`{page}`").between(1, limit))


def byte_cap(df: DataFrame, content: str, n: int) -> DataFrame:
    """Rows whose binary content has at most n bytes; null content is dropped."""
    return df.where(F.octet_length(F.col(f"`{content}`")) <= n)
