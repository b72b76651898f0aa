"""From daily tables to a model table, fold by fold, and the models on it.

Each fitted step learns from the training rows of its fold. The fold table is staged once as Parquet: the fits and
the transforms after them scan it instead of repeating the joins before it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import adstock as ads
from tillcast.operators import campaigns as camp
from tillcast.operators import dataset as ds
from tillcast.operators import encoders as enc
from tillcast.operators.daily import date_extent
from tillcast.operators.indicators import IndicatorSpec, day_indicators
from tillcast.operators.lags import LagSpec, lag_features, lag_names
from tillcast.operators.outlets import OutletFilter, attach_daily, usable_outlets
from tillcast.operators.relevance import relevance_table, top_features
from tillcast.operators.rolling import RollingSpec, feature_settings, join_rolling, rolling_features
from tillcast.operators.splits import SplitSpec, split
from tillcast.session import stage

# The four sales classes, lowest first.
LABELS = ["Low", "Medium", "High", "Exceptional"]


@dataclass(frozen=True)
class TrainingSpec:
    split: SplitSpec = SplitSpec()
    lags: LagSpec = LagSpec()
    indicators: IndicatorSpec = IndicatorSpec()
    outlets: OutletFilter | None = None
    labels: tuple[str, ...] = tuple(LABELS)
    target: str = "proxyrevenue"
    one_hot: tuple[str, ...] = ("type",)
    ordinal: dict = field(default_factory=dict)
    scaling: str = enc.NORMALIZE
    scaled: tuple[str, ...] = ()
    scale_lags: bool = True
    adstock: ads.AdstockSpec | None = None
    rolling: RollingSpec | None = None
    rolling_count: int = 20
    rolling_significant: int = 4
    drop: tuple[str, ...] = ()


@dataclass(frozen=True)
class Prepared:
    """The encoded fold table and everything fitted on the way; the parameter tables are small."""

    table: DataFrame
    bins: DataFrame
    scaling: DataFrame
    one_hot: DataFrame | None
    selected: DataFrame | None
    scaled: tuple[str, ...]
    chosen: dict[int, list[str]] = field(default_factory=dict)


def fold_table(series: DataFrame, daily: DataFrame | None, campaigns: DataFrame | None, spec: TrainingSpec) -> DataFrame:
    """Usable outlets with daily, campaign and calendar features, tagged with fold and role.

    All features of a day depend on its date alone, so they are joined before the split, which stays a projection: a
    day is shuffled once however many folds hold it.
    """
    if spec.outlets:
        series = usable_outlets(series, spec.outlets)
    extent = date_extent(series)[:2]  # of the staged series alone: the joins are not run for it
    days = attach_daily(series, stage(daily, "daily") if daily is not None else None)
    if campaigns is not None:
        campaigns = stage(campaigns, "campaigns")
        spine = camp.day_range(series.sparkSession, *[d.isoformat() for d in extent])
        days = attach_daily(days, stage(camp.campaign_indicators(campaigns, spine), "campaign-days"))
        if spec.adstock:
            stock = stage(ads.adstock(camp.campaign_daily_cost(campaigns), spec.adstock), "adstock")
            days = ads.join_adstock(days, stock)
    days = ds.drop_columns(day_indicators(days, spec.indicators), list(spec.drop))
    return split(days, spec.split, extent=extent)


def select_rolling(binned: DataFrame, spec: TrainingSpec) -> DataFrame:
    """``fold, feature, p_value, place``: the best window features of each fold's training rows."""
    label = f"binned_{spec.target}"
    rows = enc.training(binned).withColumn("label", F.col(label))
    # One role only, so windows and tests are grouped by the same keys.
    made = rolling_features(rows, replace(spec.rolling, keys=("fold", "outlet")), carry=("label",))
    names = [c for c in feature_settings(spec.rolling) if c in made.columns]
    table = relevance_table(made, names, list(spec.labels), spec.rolling_significant)
    return top_features(table, spec.rolling_count)


def fold_selection(selected: DataFrame) -> dict[int, list[str]]:
    """The selected features by fold; at most ``rolling_count`` per fold reach the driver."""
    found: dict[int, list[str]] = {}
    for row in selected.select("fold", "feature").distinct().collect():
        found.setdefault(row["fold"], []).append(row["feature"])
    return {fold: sorted(names) for fold, names in sorted(found.items())}


def _with_rolling(binned: DataFrame, chosen: dict[int, list[str]], spec: TrainingSpec) -> DataFrame:
    """Each fold's own selection; the features of other folds are NULL in its rows and drop none of them."""
    wanted = sorted({name for names in chosen.values() for name in names})
    if not wanted:
        return binned
    made = rolling_features(binned, spec.rolling, only=wanted)
    own = {name: F.when(F.col("fold").isin([f for f, names in chosen.items() if name in names]), F.col(name)) for name in wanted}
    joined = join_rolling(binned, made, spec.rolling.keys).withColumns(own)
    gap = F.lit(False)
    for fold, names in chosen.items():
        missing = F.lit(False)
        for name in names:
            missing = missing | F.col(name).isNull()
        gap = gap | ((F.col("fold") == fold) & missing)
    return joined.where(~gap)


def prepare(series: DataFrame, daily: DataFrame | None, campaigns: DataFrame | None, spec: TrainingSpec) -> Prepared:
    """Run the chain. Each input is computed once and staged: several steps read it.

    Lags look back in the whole series, so they are made before it is split and travel along; rows without
    them still count for the target bins and are dropped after those.
    """
    series = stage(lag_features(series, spec.lags, complete=False, carry=tuple(series.columns)), "series")
    folds = stage(fold_table(series, daily, campaigns, spec), "folds")
    labels = {spec.target: list(spec.labels)}
    bins = stage(enc.fit_bins(folds, labels), "bins")
    table = enc.bin_encode(folds, bins, labels)
    selected, chosen = None, {}
    if spec.rolling:
        selected = stage(select_rolling(table, spec), "selected")
        chosen = fold_selection(selected)
        table = _with_rolling(table, chosen, spec)
    table = stage(table.na.drop("any", subset=lag_names(spec.lags)), "lagged")
    scaled = enc.scaled_columns(table, list(spec.scaled), spec.scale_lags)
    scaling = stage(enc.fit_scaling(table, scaled, spec.scaling), "scaling")
    one_hot = None
    if spec.one_hot:
        one_hot = stage(enc.fit_one_hot(table, list(spec.one_hot)), "one-hot")
    table = encode(enc.scale(table, scaling, scaled, spec.scaling), one_hot, spec)
    return Prepared(table, bins, scaling, one_hot, selected, tuple(scaled), chosen)


def encode(table: DataFrame, one_hot: DataFrame | None, spec: TrainingSpec) -> DataFrame:
    """Encodings of text columns with fitted parameters; scoring runs the same step."""
    if spec.ordinal:
        table = enc.ordinal_encode(table, spec.ordinal).drop(*spec.ordinal)
    if one_hot is not None:
        table = enc.one_hot_encode(table, one_hot)
    return table


def fold_dataset(prepared: Prepared, spec: TrainingSpec, fold: int) -> tuple[DataFrame, list[str]]:
    """Model table of one fold and its features: no source columns, no constant ones, none with gaps, and of the
    window features those that this fold selected."""
    target = f"binned_{spec.target}"
    others = {name for names in prepared.chosen.values() for name in names} - set(prepared.chosen.get(fold, []))
    rows = prepared.table.where(F.col("fold") == fold).drop(spec.target, *others)
    constants = ds.constant_columns(rows, ds.feature_columns(rows, target))
    rows = ds.drop_constant(rows, constants, fold)
    table = ds.model_table(rows, target, list(spec.labels))
    return table, [c for c in table.columns if c not in (*ds.KEYS, "label", "label_id")]


def lag_columns(spec: TrainingSpec) -> list[str]:
    return lag_names(spec.lags)
