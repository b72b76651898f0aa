"""Registered queries: models, explanations, forecast requests and batch scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.names import normalise_name
from tillcast.operators import requests as rq
from tillcast.operators import splits as sp
from tillcast.operators.additive_model import AdditiveModel, AdditiveSpec
from tillcast.operators.adstock import AdstockSpec
from tillcast.operators.collinear import dependent_columns
from tillcast.operators.indicators import IndicatorSpec, booleans_to_int
from tillcast.operators.ordinal_model import OrdinalModel
from tillcast.plans import modelling as md
from tillcast.plans import roles as r
from tillcast.plans import scoring as sc
from tillcast.plans import training as tr
from tillcast.plans.queries_features import training_inputs, training_spec
from tillcast.plans.registry import present, query, with_sql
from tillcast.session import fresh_path, stage
from tillcast.sources.artefacts import ArtefactStore, RunStore

LABELS = tr.LABELS
KEYS = ["outlet", "date", "fold", "role"]
ADDITIVE = AdditiveSpec()

# --- models on the supplier series -------------------------------------------------------------------------


def _fold_one(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    spec = training_spec()
    prepared = tr.prepare(*training_inputs(spark, sf), spec)
    table, features = tr.fold_dataset(prepared, spec, 1)
    return stage(table, "model-table"), features


def _ordinal(table: DataFrame, features: list[str]) -> OrdinalModel:
    return md.fit_model(table, features, LABELS, md.ModelSpec(md.ORDINAL))


def _additive(table: DataFrame, features: list[str]) -> AdditiveModel:
    return md.fit_model(table, features, LABELS, md.ModelSpec(additive=ADDITIVE))


def _predictions(scored: DataFrame) -> DataFrame:
    chances = [F.col("probabilities")[i].alias(f"p{i}") for i in range(len(LABELS))]
    return present(scored.select(*KEYS, "label", "prediction", "class_id", *chances))


@query("ordinal_model_predictions")
def ordinal_model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    table, features = _fold_one(spark, sf)
    return _predictions(_ordinal(table, features).transform(table))


@query("additive_model_predictions")
def additive_model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    table, features = _fold_one(spark, sf)
    return _predictions(_additive(table, features).transform(table))


@query("model_evaluation")
def model_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the ordinal model on training, validation and testing in one query."""
    table, features = _fold_one(spark, sf)
    return present(md.report(_ordinal(table, features), table))


@query("stored_model_predictions")
def stored_model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of a model that was stored as a table and read back."""
    table, features = _fold_one(spark, sf)
    store = ArtefactStore(spark, fresh_path(spark, "models"))
    store.save("ordinal", "1", _ordinal(table, features).parameters(spark))
    return _predictions(OrdinalModel.from_parameters(store.load("ordinal")).transform(table))


@query("global_importance")
def global_importance(spark: SparkSession, sf: str) -> DataFrame:
    table, features = _fold_one(spark, sf)
    return present(_additive(table, features).importance(spark))


@query("feature_shapes")
def feature_shapes(spark: SparkSession, sf: str) -> DataFrame:
    table, features = _fold_one(spark, sf)
    return present(_additive(table, features).shapes(spark))


@query("local_contributions")
def local_contributions(spark: SparkSession, sf: str) -> DataFrame:
    table, features = _fold_one(spark, sf)
    return present(_additive(table, features).contributions(table, KEYS))


# --- forecast requests from the users' daily revenue ---------------------------------------------------------


def _day_features(user: Column, date: Column) -> dict[str, Column]:
    """What a request states about a day, as a rule of user and weekday."""
    at = F.weekday(date)
    even = (user + at) % 2 == 0
    return {
        "factor": (user % 5 + at) / 2.0,
        "is_daily_rainfall_total_mm": even,
        "maximum_temperature_c": (25 + (user + at) % 7).cast("double"),
        "is_public_holiday": (user + at) % 3 == 0,
        "is_school_holiday": at == 4,
        "is_pandemic_restrictions": user % 4 == 1,
    }


def requests(spark: SparkSession, sf: str, flawed: bool = True) -> DataFrame:
    """``request_id, request_date, body``: one request per user and week, as JSON text.

    Predicted is a week from Monday on; the request is made two days before and states the user's revenue of the
    14 days before that. With ``flawed``, some users break a rule of the request format.
    """
    daily = r.user_daily(spark, sf)
    monday = F.date_trunc("week", F.date_add("date", 9)).cast("date")
    weeks = daily.select(F.col("outlet").cast("bigint").alias("user"), "date", "proxyrevenue", F.explode(F.array(monday, F.date_add(monday, 7))).alias("w"))
    given = weeks.groupBy("user", "w").agg(F.sort_array(F.collect_list(F.struct("date", "proxyrevenue"))).alias("days"))
    kind, user, w = F.col("user") % 10, F.col("user"), F.col("w")

    def broken(which: int, bad: Column, good: Column) -> Column:
        return F.when(kind == which, bad).otherwise(good) if flawed else good

    iso = "yyyy-MM-dd"
    ahead = F.sequence(w, F.date_add(w, 6))
    dates = F.transform(ahead, lambda x: F.date_format(x, iso))
    states = {name: F.transform(ahead, _stated(user, name)) for name in rq.DAY_FIELDS}
    outlet = F.struct(
        broken(7, F.concat(F.array(F.lit("2024-13-01")), F.slice(dates, 2, 6)), dates).alias("inference_date"),
        user.cast("int").alias("cost_centre_code"),
        F.lit("West").alias("location"),
        F.when(user % 2 == 0, "dine-in").otherwise("carry-out").alias("type"),
        broken(6, F.slice(states["factor"], 1, 6), states["factor"]).alias("factor"),
        *[states[n].alias(n) for n in rq.DAY_FIELDS[1:]],
    )
    past = F.transform("days", lambda x: F.date_format(x["date"], iso))
    past_bad = F.transform("days", lambda x: F.date_format(x["date"], "dd/MM/yyyy"))
    sales = F.transform("days", lambda x: x["proxyrevenue"])
    lag = F.struct(
        broken(3, past_bad, past).alias("lag_sales_date"),
        broken(4, F.slice(sales, F.lit(1), F.size(sales) - 1), sales).alias("lag_sales"),
    )
    channels, costs = F.array(*[F.lit(c) for c in rq.CHANNELS]), F.array(*[F.lit(100.0 * (i + 1)) for i in range(7)])

    def campaign(label: str, first: int, last: int) -> Column:
        return F.struct(
            F.concat(F.lit(label), (user % 3).cast("string")).alias("campaign_name"),
            F.date_format(F.date_add(w, first), iso).alias("campaign_start_date"),
            F.date_format(F.date_add(w, last), iso).alias("campaign_end_date"),
            broken(5, F.slice(channels, 1, 6), channels).alias("marketing_channels"),
            costs.alias("total_cost"),
        )

    body = F.struct(
        F.array(outlet).alias("outlet_attributes"),
        F.array(lag).alias("lag_sales_attributes"),
        F.array(campaign("campaign ", -5, 2), campaign("late campaign ", 3, 10)).alias("mkt_attributes"),
    )
    return given.select(
        F.concat(user.cast("string"), F.lit("/"), w.cast("string")).alias("request_id"),
        F.date_sub(w, 2).alias("request_date"),
        F.to_json(body).alias("body"),
    )


def _stated(user: Column, name: str):
    return lambda day: _day_features(user, day)[name]


_REQUESTS = (
    r.USER_DAILY,
    """weeks AS (
  SELECT CAST(outlet AS BIGINT) AS u, date, proxyrevenue,
         CAST(unnest([CAST(date_trunc('week', date + 9) AS DATE), CAST(date_trunc('week', date + 9) AS DATE) + 7]) AS DATE) AS w
  FROM user_daily),
made AS (SELECT u, w, u || '/' || w AS request_id, w - 2 AS today, min(date) AS lo, max(date) AS hi, count(*) AS n,
         count(*) FILTER (date BETWEEN w - 16 AND w - 10) AS early FROM weeks GROUP BY u, w),
checked AS (
  SELECT *, concat_ws('; ', CASE WHEN u % 10 = 7 THEN 'inference date is not a date' END,
    CASE WHEN u % 10 = 3 THEN 'lag sales date is not a date' END, CASE WHEN u % 10 = 6 THEN 'outlet fields differ in length' END,
    CASE WHEN u % 10 = 4 THEN 'lag sales fields differ in length' END, CASE WHEN n < 7 THEN 'fewer than 7 lag days' END,
    CASE WHEN u % 10 = 5 THEN 'too few marketing channels' END) AS errors FROM made),
good AS (SELECT * FROM checked WHERE errors = '')""",
)


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return rq.check_requests(stage(rq.parse_requests(requests(spark, sf)), "requests"))


@query(
    "request_validate",
    with_sql(*_REQUESTS, "SELECT request_id, CAST(today AS VARCHAR) AS request_date, errors FROM checked"),
)
def request_validate(spark: SparkSession, sf: str) -> DataFrame:
    return present(_checked(spark, sf).select("request_id", "request_date", F.array_join("errors", "; ").alias("errors")))


_MISSING = {0: "inference_date", 1: "lag_sales_date", 2: "marketing_channels", 3: "total_cost", 4: "factor"}


def _with_gaps(parsed: DataFrame) -> DataFrame:
    """Well-formed requests without one array each, by the user; some with a channel of another name."""
    user = F.split("request_id", "/")[0].cast("int") % 7

    def without(block: Column, field: str, which: int) -> Column:
        empty = F.lit(None).cast("array<string>" if field not in ("factor", "total_cost") else "array<double>")
        return F.when(user == which, block.withField(field, empty)).otherwise(block)

    def campaign(m: Column) -> Column:
        other = m.withField("marketing_channels", F.concat(m["marketing_channels"], F.array(F.lit("Sky Writing"))))
        return F.when(user == 5, other).otherwise(without(without(m, "marketing_channels", 2), "total_cost", 3))

    return parsed.withColumns(
        {
            "outlet_attributes": F.transform("outlet_attributes", lambda o: without(without(o, "inference_date", 0), "factor", 4)),
            "lag_sales_attributes": F.transform("lag_sales_attributes", lambda o: without(o, "lag_sales_date", 1)),
            "mkt_attributes": F.transform("mkt_attributes", campaign),
        }
    )


@query(
    "request_missing_arrays",
    with_sql(
        *_REQUESTS,
        """SELECT request_id, concat_ws('; ', CASE WHEN u % 7 = 0 THEN 'inference date is missing' END,
    CASE WHEN u % 7 IN (0, 4) THEN 'outlet fields differ in length' END, CASE WHEN u % 7 = 1 THEN 'lag sales fields differ in length' END,
    CASE WHEN n < 7 OR u % 7 = 1 THEN 'fewer than 7 lag days' END, CASE WHEN u % 7 IN (2, 3) THEN 'too few marketing channels' END,
    CASE WHEN u % 7 = 5 THEN 'unknown marketing channel' END, CASE WHEN u % 7 = 5 THEN 'campaign fields differ in length' END) AS errors
  FROM made""",
    ),
)
def request_missing_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """A missing array is an error that the request is told, never a request that passes and gives nothing."""
    parsed = stage(_with_gaps(rq.parse_requests(requests(spark, sf, flawed=False))), "requests")
    return present(rq.check_requests(parsed).select("request_id", F.array_join("errors", "; ").alias("errors")))


@query(
    "request_flatten",
    with_sql(
        *_REQUESTS,
        """days AS (SELECT *, unnest(range(0, 7)) AS i FROM good)""",
        """SELECT request_id, CAST(today AS VARCHAR) AS request_date, CAST(u AS VARCHAR) AS outlet, 'West' AS location,
  CASE WHEN u % 2 = 0 THEN 'dine-in' ELSE 'carry-out' END AS type, CAST(w + CAST(i AS INTEGER) AS VARCHAR) AS date, round((u % 5 + i) / 2, 4) AS factor,
  CAST((u + i) % 2 = 0 AS BIGINT) AS is_daily_rainfall_total_mm, CAST(25 + (u + i) % 7 AS DOUBLE) AS maximum_temperature_c,
  CAST((u + i) % 3 = 0 AS BIGINT) AS is_public_holiday, CAST(i = 4 AS BIGINT) AS is_school_holiday,
  CAST(u % 4 = 1 AS BIGINT) AS is_pandemic_restrictions FROM days""",
    ),
)
def request_flatten(spark: SparkSession, sf: str) -> DataFrame:
    rows = rq.outlet_rows(rq.accepted(_checked(spark, sf)))
    return present(booleans_to_int(rows, rq.FLAG_FIELDS))


@query(
    "request_lag_rows",
    with_sql(
        *_REQUESTS,
        """SELECT request_id, CAST(today AS VARCHAR) AS request_date, CAST(date AS VARCHAR) AS date, proxyrevenue AS lag_sales
  FROM good JOIN weeks USING (u, w)""",
    ),
)
def request_lag_rows(spark: SparkSession, sf: str) -> DataFrame:
    return present(rq.lag_rows(rq.accepted(_checked(spark, sf))))


@query(
    "request_campaign_rows",
    with_sql(
        *_REQUESTS,
        """both_campaigns AS (
  SELECT request_id, 'campaign ' || u % 3 AS name, w - 5 AS "start", w + 2 AS "end" FROM good
  UNION ALL SELECT request_id, 'late campaign ' || u % 3, w + 3, w + 10 FROM good)""",
        """SELECT request_id, name, CAST("start" AS VARCHAR) AS "start", CAST("end" AS VARCHAR) AS "end",
  unnest(['TV Ad', 'Radio Ad', 'Instagram Ad', 'Facebook Ad', 'Youtube Ad', 'Poster Campaign', 'Digital']) AS mode,
  unnest([100.0::DOUBLE, 200, 300, 400, 500, 600, 700]) AS cost FROM both_campaigns""",
    ),
)
def request_campaign_rows(spark: SparkSession, sf: str) -> DataFrame:
    return present(rq.campaign_cost_rows(rq.accepted(_checked(spark, sf))))


_LOOKBACK = """spine AS (
  SELECT g.*, CAST(unnest(generate_series(lo, CASE WHEN n >= 14 OR early = 7 THEN greatest(hi, w + 6) ELSE hi END, INTERVAL 1 DAY)) AS DATE) AS date
  FROM good g),
joined AS (SELECT s.*, k.proxyrevenue AS own FROM spine s LEFT JOIN weeks k ON k.u = s.u AND k.w = s.w AND k.date = s.date),
filled AS (
  SELECT *, CASE WHEN n < 14 AND date < lo + 14
            THEN last_value(own IGNORE NULLS) OVER (PARTITION BY request_id, isodow(date) ORDER BY date) ELSE own END AS v
  FROM joined),
history AS (SELECT request_id, date, coalesce(v, 0) AS proxyrevenue FROM filled WHERE n >= 14 OR early = 7 OR own IS NOT NULL)"""


@query(
    "lookback_impute",
    with_sql(*_REQUESTS, _LOOKBACK, "SELECT request_id, CAST(date AS VARCHAR) AS date, proxyrevenue FROM history"),
)
def lookback_impute(spark: SparkSession, sf: str) -> DataFrame:
    good = stage(rq.accepted(_checked(spark, sf)), "requests")
    return present(rq.complete_lookback(good))


_PLACED = """numbered AS (
  SELECT *, lag(proxyrevenue, 9) OVER w AS l9, lag(proxyrevenue, 14) OVER w AS l14, count(*) OVER f AS c, avg(proxyrevenue) OVER f AS sma,
         row_number() OVER w - 1 AS k FROM history
  WINDOW w AS (PARTITION BY request_id ORDER BY date), f AS (PARTITION BY request_id ORDER BY date ROWS BETWEEN 15 PRECEDING AND 9 PRECEDING)),
blocks AS (SELECT request_id, k // 7 AS b, avg(proxyrevenue) AS m FROM numbered GROUP BY ALL),
placed AS (
  SELECT x.*, p.m AS m1, (p.m + q.m) / 2 AS m2 FROM numbered x
  JOIN blocks p ON p.request_id = x.request_id AND p.b = (x.k - 2) // 7 - 1
  JOIN blocks q ON q.request_id = x.request_id AND q.b = (x.k - 2) // 7 - 2 WHERE x.k >= 2)"""


@query(
    "request_features",
    with_sql(
        *_REQUESTS,
        _LOOKBACK,
        _PLACED,
        """SELECT request_id, CAST(date AS VARCHAR) AS date, round(l9, 4) AS lag_9_proxyrevenue, round(l14, 4) AS lag_14_proxyrevenue,
  round(sma, 4) AS lag_9_sma_7_days_proxyrevenue, round(m1, 4) AS lag_mean_1_week_proxyrevenue, round(m2, 4) AS lag_mean_2_week_proxyrevenue,
  CAST(1 AS BIGINT) AS name_counts, CAST(date = w + 3 AS BIGINT) AS is_name_start, CAST(date = w + 2 AS BIGINT) AS is_name_end,
  CAST(isodow(date) < 6 AS BIGINT) AS is_weekday
  FROM placed JOIN good USING (request_id) WHERE date BETWEEN w AND w + 6 AND l14 IS NOT NULL AND c = 7""",
    ),
)
def request_features(spark: SparkSession, sf: str) -> DataFrame:
    good = stage(rq.accepted(_checked(spark, sf)), "requests")
    rows = sc.request_features(good, user_spec())
    return present(rows.select("request_id", "date", *tr.lag_columns(user_spec()), "name_counts", "is_name_start", "is_name_end", "is_weekday"))


_COSTS = tuple(f"{normalise_name(c)}_daily_cost" for c in rq.CHANNELS)


@query(
    "request_features_adstock",
    with_sql(
        *_REQUESTS,
        _LOOKBACK,
        _PLACED,
        f"""SELECT request_id, CAST(date AS VARCHAR) AS date,
  {", ".join(f"round({25 * (k + 1)} * (1 - pow(0.5, date - w + 6)), 4) AS adstock_{c}" for k, c in enumerate(_COSTS))}
  FROM placed JOIN good USING (request_id) WHERE date BETWEEN w AND w + 6 AND l14 IS NOT NULL AND c = 7""",
    ),
)
def request_features_adstock(spark: SparkSession, sf: str) -> DataFrame:
    """Adstock of the campaigns that a request states: two of eight days each, one after the other, at the same cost."""
    good = stage(rq.accepted(_checked(spark, sf)), "requests")
    spec = replace(user_spec(), adstock=AdstockSpec(_COSTS, 0.5))
    return present(sc.request_features(good, spec).select("request_id", "date", *[f"adstock_{c}" for c in _COSTS]))


def _left_out(parsed: DataFrame) -> DataFrame:
    """Well-formed requests without some fields, by the user."""
    user = F.split("request_id", "/")[0].cast("int") % 5
    without = {0: ("inference_date",), 1: ("factor", "is_school_holiday"), 2: ("type", "location"), 3: ("cost_centre_code", "maximum_temperature_c")}

    def outlet(o: Column) -> Column:
        for kind, names in without.items():
            for name in names:
                o = o.withField(name, F.when(user != kind, o[name]))
        return o

    def lag(block: Column) -> Column:
        return block.withField("lag_sales_date", F.when(user != 4, block["lag_sales_date"])).withField("lag_sales", F.when(user != 4, block["lag_sales"]))

    return parsed.withColumns({"outlet_attributes": F.transform("outlet_attributes", outlet), "lag_sales_attributes": F.transform("lag_sales_attributes", lag)})


@query(
    "request_defaults",
    with_sql(
        *_REQUESTS,
        "days AS (SELECT *, unnest(range(0, 7)) AS i FROM made)",
        """SELECT request_id, CAST(w + CAST(i AS INTEGER) AS VARCHAR) AS date, CASE WHEN u % 5 = 3 THEN '201' ELSE CAST(u AS VARCHAR) END AS outlet,
  CASE WHEN u % 5 = 2 OR u % 2 = 0 THEN 'dine-in' ELSE 'carry-out' END AS type, CASE WHEN u % 5 = 1 THEN 1 ELSE round((u % 5 + i) / 2, 4) END AS factor,
  CASE WHEN u % 5 = 3 THEN 30::DOUBLE ELSE CAST(25 + (u + i) % 7 AS DOUBLE) END AS maximum_temperature_c,
  CAST(u % 5 <> 1 AND i = 4 AS BIGINT) AS is_school_holiday, CASE WHEN u % 5 = 4 THEN 7 ELSE n END AS lag_days FROM days""",
    ),
)
def request_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that leave fields out, with the defaults in their place."""
    parsed = stage(rq.with_defaults(_left_out(rq.parse_requests(requests(spark, sf, flawed=False)))), "requests")
    lag_days = parsed.select("request_id", F.size(F.col("lag_sales_attributes")[0]["lag_sales"]).alias("lag_days"))
    rows = booleans_to_int(rq.outlet_rows(parsed), rq.FLAG_FIELDS).join(lag_days, "request_id")
    return present(rows.select("request_id", "date", "outlet", "type", "factor", "maximum_temperature_c", "is_school_holiday", "lag_days"))


@query(
    "request_outcomes",
    with_sql(
        *_REQUESTS,
        _LOOKBACK,
        _PLACED,
        """scored AS (SELECT request_id, date FROM placed JOIN good USING (request_id) WHERE date BETWEEN w AND w + 6 AND l14 IS NOT NULL AND c = 7),
asked AS (SELECT request_id, today, CAST(w + CAST(unnest(range(0, 7)) AS INTEGER) AS DATE) AS date FROM good)""",
        """SELECT request_id, CAST(today AS VARCHAR) AS request_date, CAST(NULL AS VARCHAR) AS date, 'rejected' AS status, errors AS reason
  FROM checked WHERE errors <> ''
  UNION ALL SELECT a.request_id, CAST(today AS VARCHAR), CAST(a.date AS VARCHAR), CASE WHEN s.date IS NULL THEN 'rejected' ELSE 'scored' END,
    CASE WHEN s.date IS NULL THEN 'look-back incomplete' END
  FROM asked a LEFT JOIN scored s ON s.request_id = a.request_id AND s.date = a.date""",
    ),
)
def request_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every request and every day asked for."""
    checked = stage(_checked(spark, sf), "checked")
    return present(sc.request_outcomes(checked, sc.request_features(rq.accepted(checked), user_spec())))


# --- batch scoring -----------------------------------------------------------------------------------------


def user_spec() -> tr.TrainingSpec:
    return tr.TrainingSpec(split=sp.SplitSpec(sp.SIMPLE, 23, 3, 4, 1), indicators=IndicatorSpec(holidays=()))


def user_artefacts(spark: SparkSession, sf: str, additive: bool = False) -> sc.Artefacts:
    """A model on the users' own series, with the day features that requests state."""
    daily = r.user_daily(spark, sf)
    user = F.col("outlet").cast("bigint")
    stated = {n: c if n in ("factor", "maximum_temperature_c") else c.cast("int") for n, c in _day_features(user, F.col("date")).items()}
    series = daily.withColumns({**stated, "type": F.when(user % 2 == 0, "dine-in").otherwise("carry-out")})
    spec = user_spec()
    prepared = tr.prepare(series, None, None, spec)
    table, features = tr.fold_dataset(prepared, spec, 1)
    table = stage(table, "model-table")
    model = _additive(table, features) if additive else _ordinal(table, features)
    return sc.Artefacts(model, 1, prepared.scaling, prepared.one_hot, prepared.scaled, prepared.bins)


@query("score_batch")
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Requests scored with the model, scaling and one-hot categories that training stored, by run and fold."""
    parsed = stage(rq.parse_requests(requests(spark, sf)), "requests")
    store = RunStore(spark, fresh_path(spark, "artefacts"))
    sc.save_artefacts(user_artefacts(spark, sf), store, "1")
    scored = sc.score(parsed, sc.load_artefacts(store, "1", 1), user_spec())
    chances = [F.col("probabilities")[str(i)].alias(f"p{i}") for i in range(len(LABELS))]
    return present(scored.select("request_id", "date", "cost_centre_code", "sales_class_id", "sales_class_name", *chances))


@query("score_explanations")
def score_explanations(spark: SparkSession, sf: str) -> DataFrame:
    parsed = stage(rq.parse_requests(requests(spark, sf)), "requests")
    return present(sc.explain(parsed, user_artefacts(spark, sf, additive=True), user_spec()))


# --- stored runs and models with dependent features -----------------------------------------------------------


@query(
    "artefact_latest",
    """WITH runs AS (
  SELECT 'first' AS run, l_returnflag AS flag, l_extendedprice AS price FROM lineitem WHERE l_quantity <= 25
  UNION ALL SELECT 'second', l_returnflag, l_extendedprice FROM lineitem),
asked(asked, run) AS (VALUES ('latest', 'second'), ('first', 'first'))
SELECT asked, flag, round(avg(price), 4) AS mean, count(*) AS n, (SELECT round(max(price), 4) FROM runs r WHERE r.run = a.run) AS highest
FROM asked a JOIN runs USING (run) GROUP BY asked, a.run, flag""",
)
def artefact_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of two tables each; the last committed one is read without naming it, the other by its name."""
    store, lines = RunStore(spark, fresh_path(spark, "runs")), r.table(spark, sf, "lineitem")
    for run, rows in (("first", lines.where("l_quantity <= 25")), ("second", lines)):
        means = rows.groupBy(F.col("l_returnflag").alias("flag")).agg(F.avg("l_extendedprice").alias("mean"), F.count("*").alias("n"))
        store.publish(run, {"means": means, "highest": rows.agg(F.max("l_extendedprice").alias("highest"))})
    read = []
    for asked, run in (("latest", None), ("first", "first")):
        tables = store.load(run)
        highest = tables["highest"].first()["highest"]
        read.append(tables["means"].select(F.lit(asked).alias("asked"), "flag", "mean", "n", F.lit(highest).alias("highest")))
    return present(read[0].unionByName(read[1]))


@query(
    "implicit_constants",
    """SELECT * FROM (
  SELECT 1::BIGINT AS place, 'is_r' AS feature FROM lineitem
  HAVING max(abs((l_returnflag = 'A')::INT + (l_returnflag = 'N')::INT + (l_returnflag = 'R')::INT - 1)) = 0
  UNION ALL SELECT 2, 'twice' FROM lineitem HAVING abs(regr_r2(2 * l_quantity - 3, l_quantity) - 1) < 1e-9
  UNION ALL SELECT 3, 'net' FROM lineitem HAVING max(abs((l_extendedprice - 7 * l_tax) - l_extendedprice + 7 * l_tax)) < 1e-6)""",
)
def implicit_constants(spark: SparkSession, sf: str) -> DataFrame:
    """Features that a constant and the features before them give: the last of all dummies, and mixes of other columns."""
    flags = {f"is_{v.lower()}": (F.col("l_returnflag") == v).cast("double") for v in "ANR"}
    mixes = {"twice": 2 * F.col("l_quantity") - 3, "net": F.col("l_extendedprice") - 7 * F.col("l_tax")}
    rows = r.table(spark, sf, "lineitem").withColumns(flags | mixes)
    names = ["l_quantity", "l_extendedprice", "l_tax", "l_discount", *flags, *mixes]
    found = dependent_columns(rows, names)
    return present(spark.createDataFrame(list(enumerate(found, 1)), "place bigint, feature string"))
