"""Marketing campaigns: from cost lines to daily spend and day indicators.

A campaign is ``name, start, end`` with one total cost per channel. The names active on a day are kept as
rows (``active_campaigns``), not as a list in one cell, because their number grows with the campaigns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.functions.names import normalise_name
from tillcast.operators.daily import require_columns

CAMPAIGN = ["name", "start", "end"]
BLOCK = 16  # days that one row of ``sum_by_day`` holds


def channels(costs: DataFrame, mode: str = "mode") -> list[str]:
    """Fit step of a wide table: the channel names, which become columns. ``channel_costs`` and ``channel_daily_cost``
    keep channels as rows where there may be more of them than a table has columns."""
    return sorted(r[0] for r in costs.select(mode).where(F.col(mode).isNotNull()).distinct().collect())


def channel_costs(costs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per campaign and channel, for any number of channels; campaigns without any cost have none."""
    require_columns(costs, [*keys, *CAMPAIGN, "mode", "cost"])
    return costs.where("mode IS NOT NULL AND cost IS NOT NULL").groupBy(*keys, *CAMPAIGN, "mode").agg(F.sum("cost").alias("cost"))


def channel_daily_cost(costs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``date, mode, cost``: the daily share of each channel as rows, for any number of channels."""
    duration = F.date_diff("end", "start") + 1
    daily = costs.where("mode IS NOT NULL AND cost IS NOT NULL").select(*keys, "start", "end", "mode", (F.col("cost") / duration).alias("cost"))
    return sum_by_day(daily, [*keys, "mode"], "cost").select(*keys, "date", "mode", "cost")


def sum_by_day(spans: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, date, value``: the sum of ``value`` over the rows whose ``start`` to ``end`` holds the day, for many keys.

    Spans travel, not days: equal spans are summed first, so a key with most of the rows is no hot spot, and a key's spans
    then meet in one task. There a row is a key and a block of ``BLOCK`` days with a sum per day; days follow at the end.
    """
    merged = spans.where(F.col("start") <= F.col("end")).groupBy(*keys, "start", "end").agg(F.sum(value).alias("_value"))
    first, last = F.unix_date("start"), F.unix_date("end")
    block = F.explode(F.sequence(F.floor(first / BLOCK).cast("int"), F.floor(last / BLOCK).cast("int")))
    placed = merged.repartition(*keys).select(*keys, first.alias("_first"), last.alias("_last"), "_value", block.alias("_block"))
    day = F.col("_block") * BLOCK
    sums = [F.sum(F.when((day + i).between(F.col("_first"), F.col("_last")), F.col("_value"))).alias(f"_{i}") for i in range(BLOCK)]
    blocks = placed.groupBy(*keys, "_block").agg(*sums)
    days = blocks.select(*keys, "_block", F.posexplode(F.array(*[f"_{i}" for i in range(BLOCK)])).alias("_day", value)).where(F.col(value).isNotNull())
    return days.select(*keys, F.date_from_unix_date(F.col("_block") * BLOCK + F.col("_day")).alias("date"), value)


def campaign_pivot(costs: DataFrame, modes: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per campaign, one column per channel of the caller's list; campaigns without any cost in those
    channels are dropped, other gaps are 0. ``channel_costs`` has rows for channels that nobody listed."""
    require_columns(costs, [*keys, *CAMPAIGN, "mode", "cost"])
    names = [normalise_name(m) for m in modes]
    wide = costs.groupBy(*keys, *CAMPAIGN).agg(
        *[F.sum(F.when(F.col("mode") == m, F.col("cost"))).alias(n) for m, n in zip(modes, names)]
    )
    return wide.na.drop("all", subset=names).na.fill(0.0, subset=names)


def campaign_days(campaigns: DataFrame) -> DataFrame:
    """One row per campaign and day; a campaign that ends before it starts has none."""
    return campaigns.where(F.col("start") <= F.col("end")).withColumn("date", F.explode(F.sequence("start", "end")))


def active_campaigns(campaigns: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The campaigns of each day as rows ``date, name``."""
    return campaign_days(campaigns).select(*keys, "date", "name")


def active_counts(campaigns: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``date, name, n``: how many campaigns of each name run on each of its days."""
    return sum_by_day(campaigns.withColumn("n", F.lit(1)), [*keys, "name"], "n").select(*keys, "date", "name", "n")


def cost_columns(campaigns: DataFrame, keys: tuple[str, ...] = ()) -> list[str]:
    return [c for c in campaigns.columns if c not in (*keys, *CAMPAIGN)]


def campaign_daily_cost(campaigns: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Number of campaigns and cost per channel for each day with a campaign.

    Days are expanded inside the scan stage and summed before the shuffle, so only one partial row per
    task and calendar day travels.
    """
    duration = F.date_diff("end", "start") + 1
    costs = cost_columns(campaigns, keys)
    daily = campaigns.select(*keys, "start", "end", *[(F.col(c) / duration).alias(c) for c in costs])
    return campaign_days(daily).groupBy(*keys, "date").agg(
        F.count("*").alias("name_counts"),
        *[F.sum(c).alias(f"{c}_daily_cost") for c in costs],
    )


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, with the ``first`` and ``last`` day of the range."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    ends = spark.range(1).select(first.alias("first"), last.alias("last"))
    return ends.select("first", "last", F.explode(F.sequence("first", "last")).alias("date"))


def _edges(campaigns: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Days on which some name becomes active (``opens``) or stops being active (``closes``).

    A name opens at the start of one of its campaigns unless another of its campaigns covers the day
    before. Campaigns are first reduced to one row per name and edge day, so the window of a name holds
    at most one row per calendar day however many campaigns share the name.
    """
    starts = campaigns.groupBy(*keys, "name", "start").agg(F.max("end").alias("reach"))
    by_name = W.partitionBy(*keys, "name").orderBy("start")
    seen = starts.withColumns(
        {
            "covered": F.max("reach").over(by_name.rowsBetween(W.unboundedPreceding, -1)),
            "reach": F.max("reach").over(by_name.rowsBetween(W.unboundedPreceding, 0)),
            "following": F.lead("start").over(by_name),
        }
    )
    # A name closes where the days covered so far end before the day before its next start.
    opens = F.col("covered").isNull() | (F.col("covered") < F.date_sub("start", 1))
    closes = F.col("following").isNull() | (F.col("reach") < F.date_sub("following", 1))
    opened = F.struct(F.col("start").alias("date"), F.lit(1).alias("opens"), F.lit(0).alias("closes"))
    closed = F.struct(F.col("reach").alias("date"), F.lit(0).alias("opens"), F.lit(1).alias("closes"))
    moves = F.array_compact(F.array(F.when(opens, opened), F.when(closes, closed)))
    return seen.where(opens | closes).select(*keys, F.inline(moves))


def _changes(campaigns: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys, date, change``: two rows per campaign, however long it runs."""
    return campaigns.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("start").alias("date"), F.lit(1).alias("change")),
                F.struct(F.date_add("end", 1).alias("date"), F.lit(-1).alias("change")),
            )
        ),
    )


def indicators_within(campaigns: DataFrame, extents: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``campaign_indicators`` of every day from ``first`` to ``last`` of each series; ``extents`` holds ``keys, first, last``.

    Only days on which something changes are shuffled and sorted. Such a row stands for the days up to the next one, which are
    made from it at the end.
    """
    valid = campaigns.select(*keys, *CAMPAIGN).where(F.col("start") <= F.col("end"))
    none, zero = F.lit(None).cast("date"), F.lit(0)
    parts = (
        _changes(valid, keys).select(*keys, "date", none.alias("first"), none.alias("last"), "change", zero.alias("opens"), zero.alias("closes"))
        .unionAll(_edges(valid, keys).select(*keys, "date", none, none, zero, "opens", "closes"))
        .unionAll(extents.where("first <= last").select(*keys, F.col("first").alias("date"), "first", "last", zero, zero, zero))
    )
    found = parts.groupBy(*keys, "date").agg(
        *[F.max(c).alias(c) for c in ("first", "last", "opens", "closes")], F.sum("change").alias("change")
    )
    series = W.partitionBy(*keys)
    w = series.orderBy("date")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    runs = found.withColumns(
        {
            "first": F.max("first").over(whole),
            "last": F.max("last").over(whole),
            "now": F.sum("change").over(w.rowsBetween(W.unboundedPreceding, 0)),
            "until": F.date_sub(F.lead("date").over(w), 1),
            "fewer": F.coalesce(F.lead("change").over(w) < 0, F.lit(False)),
        }
    ).withColumn("until", F.coalesce("until", "last"))
    begin, end = F.greatest("date", "first"), F.least("until", "last")
    days = runs.where(begin <= end).withColumn("day", F.explode(F.sequence(begin, end)))
    changed = F.col("day") == F.col("date")
    is_start = changed & (F.col("day") > F.col("first")) & ((F.col("opens") == 1) | (F.col("change") > 0))
    is_end = (F.col("day") < F.col("last")) & ((changed & (F.col("closes") == 1)) | ((F.col("day") == F.col("until")) & F.col("fewer")))
    return days.select(
        *keys, F.col("day").alias("date"), F.col("now").alias("name_counts"), is_start.cast("int").alias("is_name_start"), is_end.cast("int").alias("is_name_end")
    )


def campaign_indicators(campaigns: DataFrame, days: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each of ``days``: number of campaigns, and whether any begins or finishes there.

    A day is a start if a name is active that was not active the day before, or if more campaigns run
    than the day before; an end likewise against the day after. The first and the last day of a
    range see themselves as their neighbour. ``days`` holds ``keys, date, first, last``.
    """
    valid = campaigns.select(*keys, *CAMPAIGN).where(F.col("start") <= F.col("end"))
    on = [*keys, "date"]
    changes = _changes(valid, keys)
    # One aggregation brings days, changes and edges together; a date outside the days has no ``first``.
    none = F.lit(None).cast("date")
    zero = F.lit(0)
    parts = (
        days.select(*on, "first", "last", zero.alias("change"), zero.alias("opens"), zero.alias("closes"))
        .unionAll(changes.select(*on, none, none, "change", zero, zero))
        .unionAll(_edges(valid, keys).select(*on, none, none, zero, "opens", "closes"))
    )
    full = parts.groupBy(*on).agg(
        F.max("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("change").alias("change"),
        F.max("opens").alias("opens"),
        F.max("closes").alias("closes"),
    )
    # One row per calendar day (and series): the running sum of the changes is the number of campaigns.
    w = W.partitionBy(*keys).orderBy("date") if keys else W.orderBy("date")
    full = full.withColumn("now", F.sum("change").over(w.rowsBetween(W.unboundedPreceding, 0)))
    full = full.withColumns({"prev": F.lag("now").over(w), "next": F.lead("now").over(w)})
    is_start = (F.col("date") > F.col("first")) & ((F.col("opens") == 1) | (F.col("now") > F.col("prev")))
    is_end = (F.col("date") < F.col("last")) & ((F.col("closes") == 1) | (F.col("now") > F.col("next")))
    return full.where(F.col("first").isNotNull()).select(
        *on,
        F.col("now").alias("name_counts"),
        F.coalesce(is_start, F.lit(False)).cast("int").alias("is_name_start"),
        F.coalesce(is_end, F.lit(False)).cast("int").alias("is_name_end"),
    )


def indicators_from_names(
    daily: DataFrame, column: str = "name", keys: list[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The same indicators from a daily table whose ``column`` holds the names as list text.

    Names are compared as text: a day continues the day before if its whole text is part of that day's
    text. ``keys`` separate series; within one there is one row per day. Without the column all three
    indicators are 0.
    """
    keys = keys or []
    names = [f"{column}_counts", f"is_{column}_start", f"is_{column}_end"]
    if start and end:
        if keys:
            raise ValueError("give either a day range or series keys")
        spine = daily.sparkSession.range(1).select(
            F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
        )
        daily = spine.join(daily, "date", "left")
    if column not in daily.columns:
        return daily.select(*keys, "date", *[F.lit(0).alias(n) for n in names])
    text = F.coalesce(F.btrim(F.col(column), F.lit('[]"')), F.lit(""))
    w = W.partitionBy(*keys).orderBy("date") if keys else W.orderBy("date")
    count = F.when(F.col("_text") == "", 0).otherwise(F.size(F.split("_text", ",")))
    rows = (
        daily.select(*keys, "date", text.alias("_text"))
        .withColumn("_n", count)
        .withColumns(
            {
                "_prev": F.coalesce(F.lag("_text").over(w), F.col("_text")),
                "_next": F.coalesce(F.lead("_text").over(w), F.col("_text")),
                "_more": F.coalesce(F.col("_n") - F.lag("_n").over(w), F.lit(0)),
                "_fewer": F.coalesce(F.col("_n") - F.lead("_n").over(w), F.lit(0)),
            }
        )
    )

    def flag(neighbour: str, change: str) -> Column:
        changed = (F.col("_n") >= 1) & ~F.contains(F.col(neighbour), F.col("_text"))
        return (changed | (F.col(change) > 0)).cast("int")

    return rows.select(
        *keys,
        "date",
        F.col("_n").alias(names[0]),
        flag("_prev", "_more").alias(names[1]),
        flag("_next", "_fewer").alias(names[2]),
    )
