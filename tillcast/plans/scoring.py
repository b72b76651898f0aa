"""Batch scoring: a table of forecast requests to one prediction per request and day."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.names import normalise_name
from tillcast.operators import adstock as ads
from tillcast.operators import campaigns as camp
from tillcast.operators import encoders as enc
from tillcast.operators import requests as rq
from tillcast.operators.additive_model import AdditiveModel
from tillcast.operators.indicators import booleans_to_int, weekday_flag
from tillcast.operators.lags import lag_features
from tillcast.operators.ordinal_model import OrdinalModel
from tillcast.plans.training import TrainingSpec, encode
from tillcast.sources.artefacts import RunStore, lookup

KEY = ("request_id",)


@dataclass(frozen=True)
class Artefacts:
    """What training left for scoring: model, fold, and its parameter tables."""

    model: OrdinalModel | AdditiveModel
    fold: int
    scaling: DataFrame
    one_hot: DataFrame | None
    scaled: tuple[str, ...]
    bins: DataFrame | None = None


_KINDS = {"ordinal": OrdinalModel, "additive": AdditiveModel}


def save_artefacts(artefacts: Artefacts, store: RunStore, run_id: str) -> None:
    """Publish what scoring needs as one run: the model of either kind, the scaling, the one-hot categories and the class
    edges of all folds."""
    spark = store.spark
    kind = next(name for name, of in _KINDS.items() if isinstance(artefacts.model, of))
    tables = {
        "model": artefacts.model.parameters(spark).withColumns({"fold": F.lit(artefacts.fold), "model_kind": F.lit(kind)}),
        "scaling": artefacts.scaling,
        "scaled": spark.createDataFrame([(c,) for c in artefacts.scaled], "column STRING"),
    }
    tables |= {name: table for name, table in (("one_hot", artefacts.one_hot), ("bins", artefacts.bins)) if table is not None}
    store.publish(run_id, tables)


def load_artefacts(store: RunStore, run_id: str | None, fold: int) -> Artefacts:
    """The stored parameters of one fold; of the asked run, or of the last one."""
    tables = store.load(run_id)
    model = lookup(tables["model"], fold)
    kinds = [r["model_kind"] for r in model.select("model_kind").distinct().collect()]
    if len(kinds) != 1:
        raise LookupError(f"fold {fold} needs exactly one model, found {kinds}")
    scaled = tuple(sorted(r["column"] for r in tables["scaled"].collect()))
    one_hot, bins = (lookup(tables[name], fold) if name in tables else None for name in ("one_hot", "bins"))
    return Artefacts(_KINDS[kinds[0]].from_parameters(model), fold, lookup(tables["scaling"], fold), one_hot, scaled, bins)


def request_features(good: DataFrame, spec: TrainingSpec) -> DataFrame:
    """One row per request and day to predict, with calendar, campaign and lag features.

    Everything a request states is worked out inside its row; the only shuffle brings the days of a request's
    history together for the lags, and the days to predict travel with them.
    """
    o = F.col("outlet_attributes")[0]
    stated = good.withColumns(
        {
            "outlet": o["cost_centre_code"].cast("string"),
            "location": o["location"],
            "type": o["type"],
            "days": rq.days_to_predict(good),
        }
    )
    about = ("request_date", "outlet", "location", "type")
    history = rq.complete_lookback(stated, spec.target, carry=(*about, "days"))
    # Of the days to predict, each day of the history keeps its own: none for a look-back day.
    history = history.withColumn("days", F.filter("days", lambda x: x["date"] == F.col("date")))
    lags = lag_features(history, replace(spec.lags, keys=KEY), carry=(*about, "days")).drop("date")
    rows = lags.select(*[c for c in lags.columns if c != "days"], F.inline("days"))
    if spec.adstock:
        campaigns = camp.campaign_pivot(rq.campaign_cost_rows(good), rq.CHANNELS, KEY)
        costs = tuple(f"{normalise_name(c)}_daily_cost" for c in rq.CHANNELS)
        daily = camp.campaign_daily_cost(campaigns, KEY)
        stock = ads.adstock(daily, replace(spec.adstock, keys=KEY, columns=costs))
        rows = ads.join_adstock(rows, stock, [*KEY, "date"])
    return rows.withColumn("is_weekday", weekday_flag())


def assemble(features: DataFrame, artefacts: Artefacts, spec: TrainingSpec) -> DataFrame:
    """Request features encoded with the parameters of the artefact fold; flags become 0/1."""
    rows = features.withColumn("fold", F.lit(artefacts.fold))
    rows = encode(enc.scale_fitted(rows, artefacts.scaling, list(artefacts.scaled)), artefacts.one_hot, spec)
    return booleans_to_int(rows, rq.FLAG_FIELDS).drop("location")


def format_predictions(scored: DataFrame) -> DataFrame:
    """The response rows: class id and name, and each class's probability to 4 decimals."""
    entries = F.transform(
        "probabilities", lambda p, i: F.struct(i.cast("string").alias("class"), F.round(p, 4).alias("p"))
    )
    return scored.select(
        "request_id",
        "request_date",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("outlet").cast("int").alias("cost_centre_code"),
        F.col("class_id").cast("string").alias("sales_class_id"),
        F.col("prediction").alias("sales_class_name"),
        F.map_from_entries(entries).alias("probabilities"),
    )


def score(requests: DataFrame, artefacts: Artefacts, spec: TrainingSpec) -> DataFrame:
    """Parsed requests to response rows; ``request_outcomes`` accounts for the requests and days without one."""
    return score_features(request_features(rq.accepted(rq.check_requests(requests)), spec), artefacts, spec)


def score_features(features: DataFrame, artefacts: Artefacts, spec: TrainingSpec) -> DataFrame:
    """Response rows of the days that ``request_features`` has made."""
    return format_predictions(artefacts.model.transform(assemble(features, artefacts, spec)))


SCORED, REJECTED, INCOMPLETE = "scored", "rejected", "look-back incomplete"


def request_outcomes(checked: DataFrame, features: DataFrame) -> DataFrame:
    """``request_id, request_date, date, status, reason``: what became of every request.

    A request that breaks rules is one row without a date. Of the others each day to predict is one row: scored if
    ``features`` holds it, else its look-back does not reach far enough for its lags.
    """
    refused = rq.rejected(checked).select(
        "request_id",
        "request_date",
        F.lit(None).cast("date").alias("date"),
        F.lit(REJECTED).alias("status"),
        F.array_join("errors", "; ").alias("reason"),
    )
    asked = rq.outlet_rows(rq.accepted(checked)).select("request_id", "request_date", "date").distinct()
    held = features.select("request_id", "date", F.lit(SCORED).alias("found")).distinct()
    days = asked.join(held, ["request_id", "date"], "left").select(
        "request_id",
        "request_date",
        "date",
        F.coalesce("found", F.lit(REJECTED)).alias("status"),
        F.when(F.col("found").isNull(), INCOMPLETE).alias("reason"),
    )
    return refused.unionByName(days)


def explain(requests: DataFrame, artefacts: Artefacts, spec: TrainingSpec) -> DataFrame:
    """What every feature adds to each prediction (additive model)."""
    good = rq.accepted(rq.check_requests(requests))
    return artefacts.model.contributions(assemble(request_features(good, spec), artefacts, spec), ["request_id", "date"])
