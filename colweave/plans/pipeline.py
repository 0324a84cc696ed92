"""Whole plans: fit a preparation and a model, keep them, score new rows.

``prepare`` takes few passes over the training table: one profile (missing
values, constants, means and distinct sketches of every column at once), one
for the encoder, one per optional step (correlation, scaling). What it fitted
is small and typed. ``Prepared.transform`` starts no job: it is a projection
plus broadcast joins for text codes, in the order used at fit time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.ml.base import Estimator
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from colweave.functions.dates import FIVE_PARTS, SIX_PARTS, expand_dates
from colweave.operators.encode import (
    BUDGET_MOST_COLUMNS,
    ONEHOT_MOST_VALUES,
    Lookup,
    OneHot,
    choose_by_budget,
    choose_by_count,
    encoded_columns,
    fit_dictionary,
    fit_frequency,
    onehot_name,
)
from colweave.operators.narrow import Narrowing, fit_floats, fit_integers
from colweave.operators.nulls import FillPolicy, fill_constant
from colweave.operators.profile import profile, profile_and, row_has_missing
from colweave.operators.project import EmptyInput, by_denial, by_prefix, guard_features, pick
from colweave.operators.scale import Scaler
from colweave.operators.score import auc_of_labels, rmse
from colweave.operators.select import correlated_columns
from colweave.plans.models import CLASSIFICATION, REGRESSION, Fitted, Shape, fit, held
from colweave.plans.search import depth_search, select_model
from colweave.schema import KEY, LABEL, Roles, is_number, plain_numbers, quoted
from colweave.session import discard, settle
from colweave.sources.scan import file_bytes
from colweave.sources.sinks import save_predictions


@dataclass(frozen=True)
class Recipe:
    """Steps of a preparation; the order is fixed but for the fill."""

    parts: Sequence[str] = tuple(SIX_PARTS)
    empty_date: bool = False
    fill_first: bool = False  # fill before encoding: -1 becomes a category
    encoder: str = "onehot"  # onehot, budget or frequency
    deny: bool = False  # choose columns by denial instead of by prefix
    drop_correlated: bool = False
    scale: bool = True
    most_columns: int = BUDGET_MOST_COLUMNS


ONEHOT = Recipe()
FILL_FIRST = Recipe(fill_first=True)
BUDGET = Recipe(fill_first=True, encoder="budget", drop_correlated=True, scale=False)
FREQUENCY = Recipe(
    parts=tuple(FIVE_PARTS), empty_date=True, fill_first=True, encoder="frequency", deny=True, scale=False
)


@dataclass(frozen=True)
class Prepared:
    """A fitted preparation."""

    recipe: Recipe
    roles: Roles
    policy: FillPolicy
    onehot: OneHot
    lookup: Lookup | None
    used: Sequence[str]
    scaler: Scaler | None = None
    label_deviation: float | None = None
    facts: Mapping[str, Any] = field(default_factory=dict)
    seconds: Mapping[str, float] = field(default_factory=dict)  # of the steps of the fit

    @property
    def shape(self) -> Shape:
        return Shape(self.facts["rows"], len(self.used), self.label_deviation or 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        """Key and label (if present) followed by the fitted feature columns."""
        recipe, label = self.recipe, self.roles.label
        out = expand_dates(plain_numbers(df), list(recipe.parts), recipe.empty_date, roles=self.roles)
        if recipe.fill_first:
            out = self.policy.apply(out, self.roles.features(out.columns))
        out = self.lookup.apply(out) if self.lookup else self.onehot.apply(out)
        out = pick(out, self.used, [c for c in (KEY, label) if c in df.columns])
        if not recipe.fill_first:
            out = self.policy.apply(out, self.used)
        if self.scaler:
            out = self.scaler.apply(out)
        return out.withColumnRenamed(label, LABEL)


def prepare(df: DataFrame, recipe: Recipe = ONEHOT, roles: Roles | None = None, stats: str = "train") -> Prepared:
    """Fit a preparation on a training table."""
    roles = roles or Roles()
    label = roles.label
    df = plain_numbers(df)
    seconds, since = {}, time.monotonic()

    def passed(step: str) -> None:
        nonlocal since
        seconds[step], since = time.monotonic() - since, time.monotonic()

    raw = expand_dates(df, list(recipe.parts), recipe.empty_date, roles=roles)
    names = roles.features(raw.columns)
    table, flag = raw, row_has_missing(names)
    if recipe.fill_first:
        table, flag = fill_constant(raw.selectExpr("*", f"{flag} as _missing"), names), "_missing"
    more = {"missing": f"coalesce(bool_or({flag}), false)"}
    if label in raw.columns and is_number(raw.schema[label].dataType):
        more["label_deviation"] = f"stddev_pop({quoted(label)})"
    profiles, found = profile_and(table, names, recipe.encoder != "frequency", more)
    missing = found["missing"]
    passed("profile")
    table = table.drop("_missing")
    rows = profiles[names[0]].rows if names else 0
    if rows < 2:
        raise EmptyInput(f"train table has {rows} rows, at least 2 are needed")
    means = {n: p.mean for n, p in profiles.items() if p.mean is not None}
    policy = FillPolicy(missing, {} if missing or stats == "self" else means, stats)

    constant = [n for n, p in profiles.items() if p.constant]
    width = len(raw.columns) - int(label in raw.columns)
    onehot, lookup = OneHot({}), None
    if recipe.encoder == "frequency":
        text = [n for n in encoded_columns(names, roles) if n not in constant]
        lookup = fit_frequency(table, text, roles)
        table = lookup.apply(table)
    elif recipe.encoder == "budget":
        onehot = OneHot.fit(table, choose_by_budget(profiles, width, most_columns=recipe.most_columns))
    else:
        onehot = OneHot.fit(table, choose_by_count(profiles))
    if lookup is None:
        table = onehot.apply(table)
    passed("encode")
    # the indicator of "missing" is 0 on every row, hence constant
    constant += [onehot_name(c, None) for c, values in onehot.values.items() if None in values]

    left = [c for c in table.columns if c not in constant and roles.of(c) not in ("key", "label", "ignore")]
    if recipe.deny:
        used = by_denial(left, list(lookup.sizes) if lookup else (), roles)
    else:
        used = by_prefix(left)
    guard_features(used)
    facts = {
        "rows": rows, "columns": width, "constant_columns": len(constant),
        "encoded_columns": len(lookup.sizes if lookup else onehot.values),
        "onehot_columns": len([c for c in used if c.startswith("onehot")]),
        "number_columns": len([c for c in used if c.startswith("number")]),
    }
    deviation = found.get("label_deviation")
    prepared = Prepared(recipe, roles, policy, onehot, lookup, used, label_deviation=deviation)
    if recipe.drop_correlated:
        late = set(correlated_columns(prepared.transform(df), used))
        used = [c for c in used if c not in late]
        prepared = replace(prepared, used=used)
        passed("select")
    if recipe.scale:
        prepared = replace(prepared, scaler=Scaler.fit(prepared.transform(df), used))
        passed("scale")
    return replace(prepared, facts={**facts, "used_columns": len(used)}, seconds=seconds)


def compact(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Drop constants, narrow numbers, one-hot text with 3 to 20 values, dictionary codes for other repeated text.

    One profile decides for all columns; the key and the label pass through.
    """
    roles = roles or Roles()
    names = roles.features(df.columns)
    profiles = profile(df, names)
    kept = [n for n in names if not profiles[n].constant]
    text = [n for n in kept if profiles[n].dtype == "string"]
    few = {n: profiles[n].values for n in text if profiles[n].exact and 2 < profiles[n].distinct <= ONEHOT_MOST_VALUES}
    codes = fit_dictionary(df, [n for n in text if n not in few], profiles=profiles)
    onehot = OneHot.fit(df, few)
    numbers = [n for n in kept if profiles[n].dtype != "string"]
    out = codes.apply(onehot.apply(df))
    integers, floats = fit_integers(df, numbers), fit_floats(df, numbers)
    bits = {n: "tinyint" for n in onehot.names()}
    small = Narrowing({**integers.types, **floats.types, **bits}, {}).apply(out)
    keep = [c for c in (KEY, roles.label) if c in df.columns]
    return pick(small, [*onehot.names(), *[n for n in kept if n not in few]], keep)


# ---------------------------------------------------------------- models on prepared tables


@dataclass(frozen=True)
class Scorer:
    """A fitted preparation and model: everything scoring needs."""

    prepared: Prepared
    fitted: Fitted
    mode: str

    def predict(self, df: DataFrame, probability: bool = False) -> DataFrame:
        """(key, label if present, prediction); lazy, the scored table is not shuffled."""
        return self.fitted.predict(self.prepared.transform(df), probability)


def _sized(prepared: Prepared, written: DataFrame) -> Prepared:
    """With the bytes of the written training table among the facts: a listing of its files."""
    folders = sorted({name.rpartition("/")[0] for name in written.inputFiles()})
    size = sum(file_bytes(written.sparkSession, folder) for folder in folders)
    return replace(prepared, facts={**prepared.facts, "train_bytes": size})


def train(
    df: DataFrame, mode: str, estimator: Callable[[Shape], Estimator] | Estimator,
    recipe: Recipe = ONEHOT, roles: Roles | None = None,
) -> Scorer:
    """Prepare and fit. ``estimator`` may be a function of the prepared table's shape.

    The source is read once: its rows are settled for the passes of the fit and deleted after it.
    """
    df = settle(df, "train")
    prepared = _sized(prepare(df, recipe, roles), df)
    made = estimator if isinstance(estimator, Estimator) else estimator(prepared.shape)
    fitted = fit(made, prepared.transform(df), prepared.used, prepared.facts["rows"])
    discard(df)
    return Scorer(prepared, fitted, mode)


def train_best(
    df: DataFrame, mode: str, candidates: Mapping[str, Estimator], recipe: Recipe = FREQUENCY,
    depths: Sequence[int] | None = None, roles: Roles | None = None, seconds: float | None = None,
    samples: Sequence[int] = (),
) -> tuple[Scorer, DataFrame]:
    """Prepare, pick the best candidate, search its depth, refit; every step on all rows.

    ``samples`` asks for earlier selection rounds on that many rows. With a
    time budget in ``seconds`` the depth search stops between fits when the
    rest is needed for the final fit. Gives the scorer and the leaderboard of the last round.
    The prepared rows are dealt once, for all fits.
    """
    df = settle(df, "train")
    prepared = _sized(prepare(df, recipe, roles), df)
    with held(prepared.transform(df), prepared.used, prepared.facts["rows"]) as table:
        name, board = select_model(candidates, table, prepared.used, mode, samples, prepared.facts["rows"])
        best = candidates[name]
        if depths and best.hasParam("maxDepth"):
            best, _ = depth_search(best, table, prepared.used, mode, depths, seconds)
        fitted = fit(best, table, prepared.used, prepared.facts["rows"])
    discard(df)
    return Scorer(prepared, fitted, mode), board


def run_metrics(spark: SparkSession, fitted: Prepared | Scorer, **more: Any) -> DataFrame:
    """One row of run metrics: the counts of a fit, the seconds of its steps, and what the caller measured.

    A scorer also gives its mode, the method that was chosen, its parameters (JSON) and the bytes of its training table.
    """
    prepared = fitted.prepared if isinstance(fitted, Scorer) else fitted
    row = {**prepared.facts, **{f"seconds_{k}": float(v) for k, v in prepared.seconds.items()}}
    if isinstance(fitted, Scorer):
        row |= {"mode": fitted.mode, **fitted.fitted.described()}
    row |= more
    return spark.createDataFrame([tuple(row.values())], list(row))


def run_all(
    spark: SparkSession, sets: Mapping[str, tuple[str, DataFrame, DataFrame]],
    estimator: Callable[[str, Shape], Estimator], recipe: Recipe = ONEHOT, out: str | None = None,
) -> DataFrame:
    """Train, predict and score each named (mode, train, test) set; one metrics row per set.

    With ``out`` the predictions of a set go to ``out``/name. They are computed once, for the file and for the score.
    """
    run, rows = str(uuid.uuid4()), []
    for name, (mode, train_table, test_table) in sets.items():
        start = time.monotonic()
        scorer = train(train_table, mode, lambda shape, mode=mode: estimator(mode, shape), recipe)
        fitted_at = time.monotonic()
        scored = settle(scorer.predict(test_table), "scored")
        if out:
            save_predictions(scored, f"{out}/{name}")
        value = (rmse(scored) if mode == REGRESSION else auc_of_labels(scored)).first()[0]
        predicted = scored.count()
        discard(scored)
        facts, method = scorer.prepared.facts, scorer.fitted.described()
        rows.append((
            run, name, mode, facts["rows"], facts["used_columns"], value, fitted_at - start, time.monotonic() - fitted_at,
            method["method"], method["parameters"], facts["columns"], facts["train_bytes"], predicted,
        ))
    return spark.createDataFrame(
        rows, "run_id string, dataset string, mode string, rows bigint, used_columns bigint, score double,"
        " train_seconds double, predict_seconds double, method string, parameters string, columns bigint, train_bytes bigint,"
        " predicted_rows bigint",
    )


# ---------------------------------------------------------------- saved state


def save(scorer: Scorer, path: str) -> None:
    """State as one JSON row, the lookup table as parquet, the model in Spark ML's format.

    Everything goes to a new version folder; the file that names the current
    version is switched last, so a scorer loaded from ``path`` can be saved there, and a failed save changes nothing.
    """
    p = scorer.prepared
    state = {
        "mode": scorer.mode, "names": list(scorer.fitted.names), "used": list(p.used), "facts": dict(p.facts),
        "recipe": {**p.recipe.__dict__, "parts": list(p.recipe.parts)}, "roles": p.roles.overrides,
        "policy": {"missing": p.policy.missing, "train_means": dict(p.policy.train_means), "stats": p.policy.stats},
        "onehot": {c: list(v) for c, v in p.onehot.values.items()},
        "scaler": {c: list(v) for c, v in p.scaler.stats.items()} if p.scaler else None,
        "label_deviation": p.label_deviation,
        "lookup": {"rows": p.lookup.rows, "sizes": {c: list(s) for c, s in p.lookup.sizes.items()}} if p.lookup else None,
    }
    spark = p.lookup.table.sparkSession if p.lookup else SparkSession.active()
    version = uuid.uuid4().hex
    folder = f"{path}/{version}"
    spark.createDataFrame([(json.dumps(state),)], "state string").write.parquet(f"{folder}/state")
    if p.lookup:
        p.lookup.table.write.parquet(f"{folder}/lookup")
    PipelineModel([scorer.fitted.model]).write().session(spark).save(f"{folder}/model")
    name, files = _pointer(spark, path)
    out = files.create(name, True)
    out.write(bytearray(version, "ascii"))
    out.close()


def _pointer(spark: SparkSession, path: str):
    """(path of the small file that names the current version, its file system)"""
    jvm = spark.sparkContext._jvm
    name = jvm.org.apache.hadoop.fs.Path(f"{path}/current")
    return name, name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def load(spark: SparkSession, path: str) -> Scorer:
    """The scorer saved last; versions saved before stay readable for those who hold them."""
    name, _ = _pointer(spark, path)
    path = f"{path}/{spark.read.text(name.toString()).first()[0]}"
    state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
    lookup = None
    if state["lookup"]:
        sizes = {c: tuple(s) for c, s in state["lookup"]["sizes"].items()}
        lookup = Lookup(spark.read.parquet(f"{path}/lookup"), state["lookup"]["rows"], sizes)
    scaler = Scaler({c: tuple(v) for c, v in state["scaler"].items()}) if state["scaler"] else None
    recipe = Recipe(**{**state["recipe"], "parts": tuple(state["recipe"]["parts"])})
    prepared = Prepared(
        recipe, Roles(state["roles"]), FillPolicy(**state["policy"]), OneHot(state["onehot"]), lookup,
        state["used"], scaler, state["label_deviation"], state["facts"],
    )
    model = PipelineModel.load(f"{path}/model").stages[0]
    return Scorer(prepared, Fitted(model, state["names"]), state["mode"])


__all__ = [
    "BUDGET", "CLASSIFICATION", "FILL_FIRST", "FREQUENCY", "ONEHOT", "REGRESSION", "Prepared", "Recipe", "Scorer",
    "compact", "load", "prepare", "run_all", "run_metrics", "save", "train", "train_best",
]
