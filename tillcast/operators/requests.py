"""Forecast requests: parse, check, flatten, and complete their look-back sales. Many requests at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.values import day, inference_days, lookback_days

# The request format.
REQUEST_SCHEMA = """
outlet_attributes ARRAY<STRUCT<
  inference_date: ARRAY<STRING>, cost_centre_code: INT, location: STRING, type: STRING, factor: ARRAY<DOUBLE>,
  is_daily_rainfall_total_mm: ARRAY<BOOLEAN>, maximum_temperature_c: ARRAY<DOUBLE>,
  is_public_holiday: ARRAY<BOOLEAN>, is_school_holiday: ARRAY<BOOLEAN>, is_pandemic_restrictions: ARRAY<BOOLEAN>>>,
lag_sales_attributes ARRAY<STRUCT<lag_sales_date: ARRAY<STRING>, lag_sales: ARRAY<DOUBLE>>>,
mkt_attributes ARRAY<STRUCT<
  campaign_name: STRING, campaign_start_date: STRING, campaign_end_date: STRING,
  marketing_channels: ARRAY<STRING>, total_cost: ARRAY<DOUBLE>>>
"""
CHANNELS = ["TV Ad", "Radio Ad", "Instagram Ad", "Facebook Ad", "Youtube Ad", "Poster Campaign", "Digital"]
DAY_FIELDS = [
    "factor",
    "is_daily_rainfall_total_mm",
    "maximum_temperature_c",
    "is_public_holiday",
    "is_school_holiday",
    "is_pandemic_restrictions",
]
FLAG_FIELDS = [f for f in DAY_FIELDS if f.startswith("is_")]
MIN_LAG_DAYS = 7
LOOKBACK_DAYS = 14


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """``request_id, request_date`` and the three attribute blocks from JSON text.

    Stage the result before checking it: the checks touch the blocks many times, and a filter on them would
    repeat the parsing.
    """
    parsed = F.from_json(body, REQUEST_SCHEMA).alias("_r")
    return df.select("request_id", "request_date", parsed).select("request_id", "request_date", "_r.*")


@dataclass(frozen=True)
class RequestDefaults:
    """What a request means that leaves a field out."""

    days: int = 7
    cost_centre_code: int = 201
    location: str = "West"
    type: str = "dine-in"
    factor: float = 1.0
    maximum_temperature_c: float = 30.0
    flag: bool = False
    lag_days: int = 7
    lag_sales: float = 5831.0
    campaign_name: str = "campaign 1"
    campaign_start_date: str = "2023-10-01"
    campaign_end_date: str = "2023-10-30"
    total_cost: float = 0.0


def with_defaults(requests: DataFrame, defaults: RequestDefaults = RequestDefaults()) -> DataFrame:
    """Fill the fields that a block of a parsed request leaves out. Blocks that are missing stay missing.

    Days to predict follow the request's date, look-back days lie before it; the other day fields get as many values as
    there are default days. Without this step a missing field is an error of the request.
    """
    iso = "yyyy-MM-dd"

    def filled(block: Column, values: dict[str, Column]) -> Column:
        for name, value in values.items():
            block = block.withField(name, F.coalesce(block[name], value))
        return block

    def dates(days: Column) -> Column:
        return F.transform(days, lambda d: F.date_format(d, iso))

    of_day = {"factor": F.lit(defaults.factor), "maximum_temperature_c": F.lit(defaults.maximum_temperature_c)} | {f: F.lit(defaults.flag) for f in FLAG_FIELDS}
    outlet = {
        "inference_date": dates(inference_days(F.col("request_date"), defaults.days)),
        "cost_centre_code": F.lit(defaults.cost_centre_code),
        "location": F.lit(defaults.location),
        "type": F.lit(defaults.type),
        **{name: F.array_repeat(value, defaults.days) for name, value in of_day.items()},
    }
    lag = {"lag_sales_date": dates(lookback_days(F.col("request_date"), defaults.lag_days)), "lag_sales": F.array_repeat(F.lit(defaults.lag_sales), defaults.lag_days)}
    campaign = {
        "campaign_name": F.lit(defaults.campaign_name),
        "campaign_start_date": F.lit(defaults.campaign_start_date),
        "campaign_end_date": F.lit(defaults.campaign_end_date),
        "marketing_channels": F.array(*[F.lit(c) for c in CHANNELS]),
        "total_cost": F.array_repeat(F.lit(defaults.total_cost), len(CHANNELS)),
    }
    blocks = {"outlet_attributes": outlet, "lag_sales_attributes": lag, "mkt_attributes": campaign}
    return requests.withColumns({name: F.transform(name, _filler(filled, values)) for name, values in blocks.items()})


def _filler(filled, values: dict[str, Column]):
    return lambda block: filled(block, values)


def _length(values: Column) -> Column:
    """Elements of an array; −1 where there is none, so that a missing array breaks every rule about its length."""
    return F.coalesce(F.size(values), F.lit(-1))


def _bad_dates(dates: Column) -> Column:
    return F.exists(dates, lambda d: day(d).isNull())


def check_requests(requests: DataFrame) -> DataFrame:
    """Add ``errors``: every rule the request breaks, an empty array for a good one.

    A request without a field that scoring needs says so here, unless ``with_defaults`` has filled it.
    """
    outlet, lag = F.try_element_at("outlet_attributes", F.lit(1)), F.try_element_at("lag_sales_attributes", F.lit(1))
    days, lag_days = _length(outlet["inference_date"]), _length(lag["lag_sales_date"])
    one_outlet, one_lag = _length(F.col("outlet_attributes")) == 1, _length(F.col("lag_sales_attributes")) == 1
    uneven = F.lit(False)
    for f in DAY_FIELDS:
        uneven = uneven | (_length(outlet[f]) != days)
    campaigns = F.coalesce("mkt_attributes", F.array().cast(requests.schema["mkt_attributes"].dataType))
    listed = F.array(*[F.lit(c) for c in CHANNELS])
    rules = {
        "exactly one outlet block": ~one_outlet,
        "exactly one lag sales block": ~one_lag,
        "inference date is missing": one_outlet & (days < 1),
        "cost centre code is missing": one_outlet & outlet["cost_centre_code"].isNull(),
        "outlet type is missing": one_outlet & outlet["type"].isNull(),
        "inference date is not a date": _bad_dates(outlet["inference_date"]),
        "lag sales date is not a date": _bad_dates(lag["lag_sales_date"]),
        "campaign date is not a date": F.exists(
            campaigns, lambda m: day(m["campaign_start_date"]).isNull() | day(m["campaign_end_date"]).isNull()
        ),
        "outlet fields differ in length": one_outlet & uneven,
        "lag sales fields differ in length": one_lag & (_length(lag["lag_sales"]) != lag_days),
        f"fewer than {MIN_LAG_DAYS} lag days": one_lag & (lag_days < MIN_LAG_DAYS),
        "too few marketing channels": F.exists(
            campaigns,
            lambda m: (_length(m["marketing_channels"]) < len(CHANNELS)) | (_length(m["total_cost"]) < len(CHANNELS)),
        ),
        "unknown marketing channel": F.exists(
            campaigns, lambda m: F.size(F.array_except(m["marketing_channels"], listed)) > 0
        ),
        "campaign fields differ in length": F.exists(
            campaigns,
            lambda m: (_length(m["marketing_channels"]) != _length(m["total_cost"]))
            & (F.least(_length(m["marketing_channels"]), _length(m["total_cost"])) >= len(CHANNELS)),
        ),
    }
    found = F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()])
    return requests.withColumn("errors", F.array_compact(found))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") > 0).select("request_id", "request_date", "errors")


def outlet_rows(requests: DataFrame) -> DataFrame:
    """One row per request and day to predict."""
    o = F.col("outlet_attributes")[0]
    rows = requests.select(
        "request_id",
        "request_date",
        o["cost_centre_code"].cast("string").alias("outlet"),
        o["location"].alias("location"),
        o["type"].alias("type"),
        F.inline(
            F.arrays_zip(o["inference_date"].alias("inference_date"), *[o[f].alias(f) for f in DAY_FIELDS])
        ),
    )
    return rows.withColumn("date", day("inference_date")).drop("inference_date")


def lag_rows(requests: DataFrame) -> DataFrame:
    """One row per request and look-back day."""
    lag = F.col("lag_sales_attributes")[0]
    rows = requests.select(
        "request_id",
        "request_date",
        F.inline(F.arrays_zip(lag["lag_sales_date"].alias("lag_sales_date"), lag["lag_sales"].alias("lag_sales"))),
    )
    return rows.select("request_id", "request_date", day("lag_sales_date").alias("date"), "lag_sales")


def campaign_cost_rows(requests: DataFrame) -> DataFrame:
    """One row per request, campaign and channel: ``name, start, end, mode, cost``."""
    campaigns = requests.select("request_id", F.explode("mkt_attributes").alias("m"))
    rows = campaigns.select(
        "request_id",
        F.col("m.campaign_name").alias("name"),
        day("m.campaign_start_date").alias("start"),
        day("m.campaign_end_date").alias("end"),
        F.inline(F.arrays_zip(F.col("m.marketing_channels").alias("mode"), F.col("m.total_cost").alias("cost"))),
    )
    return rows


def _running(campaigns: Column, on: Column) -> Column:
    """Names of the campaigns that run on a day."""
    return F.transform(F.filter(campaigns, lambda c: (c["start"] <= on) & (on <= c["end"])), lambda c: c["name"])


def _campaign_flags(campaigns: Column, on: Column, first: Column, last: Column) -> list[Column]:
    """The indicators of ``campaigns.campaign_indicators`` for one day of a request."""
    now, before, after = (_running(campaigns, F.date_add(on, i)) for i in (0, -1, 1))

    def moved(other: Column) -> Column:
        return (F.size(F.array_except(now, other)) > 0) | (F.size(now) > F.size(other))

    return [
        F.size(now).alias("name_counts"),
        ((on > first) & moved(before)).cast("int").alias("is_name_start"),
        ((on < last) & moved(after)).cast("int").alias("is_name_end"),
    ]


def days_to_predict(requests: DataFrame) -> Column:
    """All days to predict of a request as one array: its day fields and campaign indicators."""
    o = F.col("outlet_attributes")[0]
    fields = F.arrays_zip(
        F.transform(o["inference_date"], day).alias("date"), *[o[f].alias(f) for f in DAY_FIELDS]
    )
    dates = F.transform(o["inference_date"], day)
    first, last = F.array_min(dates), F.array_max(dates)
    paid = F.filter(
        F.coalesce("mkt_attributes", F.array().cast(requests.schema["mkt_attributes"].dataType)),
        lambda m: F.exists(m["total_cost"], lambda c: c.isNotNull()),
    )
    campaigns = F.array_distinct(
        F.transform(
            paid,
            lambda m: F.struct(
                m["campaign_name"].alias("name"),
                day(m["campaign_start_date"]).alias("start"),
                day(m["campaign_end_date"]).alias("end"),
            ),
        )
    )
    return F.transform(
        fields,
        lambda x: F.struct(
            x["date"].alias("date"),
            *[x[f].alias(f) for f in DAY_FIELDS],
            *_campaign_flags(campaigns, x["date"], first, last),
        ),
    )


def complete_lookback(requests: DataFrame, target: str = "proxyrevenue", carry: tuple[str, ...] = ()) -> DataFrame:
    """Look-back sales of each request as a gap-free series up to its last day to predict.

    With fewer than 14 days given, the first 7 of the look-back period must be there; the missing days up to the
    14th then repeat the value a week before. Without those 7 the request keeps the days it came with. All other
    gaps are 0. A request is one row, so everything happens inside it and nothing is shuffled. ``carry`` names
    further columns of the request to keep on each day.
    """
    lag = F.col("lag_sales_attributes")[0]
    given = F.transform(
        F.arrays_zip(lag["lag_sales_date"].alias("day"), lag["lag_sales"].alias("value")),
        lambda x: F.struct(day(x["day"]).alias("day"), x["value"].alias("value")),
    )
    ahead = F.transform(F.col("outlet_attributes")[0]["inference_date"], day)
    rows = requests.select("request_id", "request_date", *carry, given.alias("given"), F.array_max(ahead).alias("to_date"))
    days = F.transform("given", lambda x: x["day"])
    first_seven = F.filter(
        "given",
        lambda x: x["value"].isNotNull()
        & x["day"].between(F.date_sub("request_date", LOOKBACK_DAYS), F.date_sub("request_date", LOOKBACK_DAYS - 6)),
    )
    short = F.size("given") < LOOKBACK_DAYS
    rows = rows.withColumns(
        {
            "first": F.array_min(days),
            "last": F.array_max(days),
            "short": short,
            "complete": ~short | (F.size(first_seven) >= 7),
        }
    )
    until = F.when(F.col("complete"), F.greatest("last", "to_date")).otherwise(F.col("last"))
    rows = rows.select("*", F.explode(F.sequence(F.col("first"), until)).alias("date"))

    def sales(on: Column) -> Column:
        same = F.filter("given", lambda x: (x["day"] == on) & x["value"].isNotNull())
        return F.try_element_at(same, F.lit(-1))["value"]

    repeats = F.col("short") & (F.col("date") < F.date_add("first", LOOKBACK_DAYS))
    own, before = sales(F.col("date")), F.when(repeats, sales(F.date_sub("date", 7)))
    rows = rows.withColumns({"own": own, "before": before}).where("complete OR own IS NOT NULL")
    value = F.coalesce("own", "before", F.lit(0.0))
    return rows.select("request_id", "date", value.alias(target), *carry)
