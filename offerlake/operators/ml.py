"""Price model: feature preparation, imputation, encoding, search, scoring
(SURVEY P17-P20, A2-A6, M1-M10, S6-S8).

Everything stays in Spark: fitted statistics are one-row aggregates (a mean
or a mode per column), the encoder is a table of categories ranked by a
distributed sort, the model a ``GBTRegressor`` searched over a fold column.
Codes are plain numbers, so a column may have any number of categories.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from offerlake.functions import vocab
from offerlake.operators import search
from offerlake.operators.clean import categorical_columns, drop_columns, drop_null_columns
from offerlake.session import columnar_copy

TARGET = "price_total"

# FIXED VALUES: the imputation groups of the price model.
MEAN_COLUMNS = ("size", "rent")
MODE_COLUMNS = (
    "offer_type", "building_type", "year_built", "floor",
    "primary_market", "has_lift", "has_tv", "has_internet",
    "has_phone_line", "is_furnished", "has_dishwasher", "has_fridge",
    "has_oven", "has_stove", "has_washing_machine", "has_garden",
    "has_balcony", "has_porch", "has_parking", "gated_community",
    "guarded_building", "has_cctv", "n_rooms",
)
CONST_COLUMNS = ("construction_status", "ownership_type", "heating_type", "windows_type", "building_material")

# FIXED VALUES: the search grid (learning rate, depth, number of trees).
DEFAULT_GRID = {
    "stepSize": (0.01, 0.05, 0.1, 0.2),
    "maxDepth": (2, 3, 5, 7, 10),
    "maxIter": tuple(range(100, 1000, 100)),
}


# ------------------------------------------------------------ preparation

def features_frame(gold: DataFrame, target: str = TARGET) -> tuple[DataFrame, list[str]]:
    """P17 + P18 + P20: drop ``offer_date`` if present, drop all-NULL feature
    columns, and name the categorical (non-numeric) features.  The target is
    kept alongside (P19 splits it off only logically)."""
    df = drop_columns(gold, ("offer_date",))
    feats = drop_null_columns(df.drop(target))
    df = df.select(target, *feats.columns)
    cats = [c for c in categorical_columns(df) if c != target]
    return df, cats


def mode_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: most frequent non-NULL value of every column; a tie goes to the smallest value.

    Boolean columns are counted by one row of sums.  The others are stacked
    into (column, value) pairs and counted in one partially aggregated pass;
    the winner per column is a min over struct(-count, value), so no column is
    ever collected whole.  Values are compared in their own type (numbers as
    numbers, False < True).
    """
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    flags = [c for c in columns if isinstance(dtypes[c], BooleanType)]
    others = [c for c in columns if c not in flags]
    parts = []
    if others:

        def entry(c: str) -> Column:
            numeric = isinstance(dtypes[c], NumericType)
            num = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
            txt = F.lit(None).cast("string") if numeric else F.col(c).cast("string")
            return F.struct(F.lit(c).alias("column"), num.alias("num"), txt.alias("txt"), F.col(c).cast("string").alias("value"))

        pairs = df.select(F.explode(F.array(*[entry(c) for c in others])).alias("p")).select("p.*")
        pairs = pairs.filter(F.col("value").isNotNull())
        counts = pairs.groupBy("column", "num", "txt", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), "num", "txt", "value", "n")).alias("b"))
        parts.append(best.select("column", F.col("b.value").alias("value"), F.col("b.n").alias("n")))
    if flags:
        sums = df.agg(*[F.struct(F.count_if(F.col(c)).alias("t"), F.count_if(~F.col(c)).alias("f")).alias(c) for c in flags])
        each = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in flags])).alias("x"))
        t, f = F.col("x.n.t"), F.col("x.n.f")
        value = F.when(t > f, F.lit("true")).otherwise(F.lit("false"))
        flagged = each.filter((t > 0) | (f > 0)).select("x.column", value.alias("value"), F.greatest(t, f).alias("n"))
        parts.append(flagged)
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def mean_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """A3: mean of each column over its non-NULL values (one aggregate row)."""
    if not columns:
        return {}
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return row.asDict()


@dataclass
class Imputer:
    """M1-M3 fitted values: column -> fill value (already of the column's type)."""

    fills: dict[str, object] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        e = {c: F.coalesce(F.col(c), F.lit(v).cast(dtypes[c])) for c, v in self.fills.items() if c in dtypes and v is not None}
        return df.withColumns(e)


def imputed_columns(
    df: DataFrame, mean_cols: Sequence[str] = MEAN_COLUMNS, mode_cols: Sequence[str] = MODE_COLUMNS
) -> tuple[list[str], list[str]]:
    """The columns filled by a mean and by a mode that ``df`` has."""
    return [c for c in mean_cols if c in df.columns], [c for c in mode_cols if c in df.columns]


def constant_fills(
    df: DataFrame,
    filled: Sequence[str],
    const_cols: Sequence[str] = CONST_COLUMNS,
    fill_value: str = vocab.MISSING_CATEGORY,
    target: str = TARGET,
) -> dict[str, str]:
    """M3: the listed columns and every other string column that no mean or mode fills (the remainder rule)."""
    listed = {*filled, target}
    rest = [f.name for f in df.schema.fields if f.name not in listed and isinstance(f.dataType, StringType)]
    return {c: fill_value for c in [*(c for c in const_cols if c in df.columns), *rest]}


def fit_imputer(
    df: DataFrame,
    mean_cols: Sequence[str] = MEAN_COLUMNS,
    mode_cols: Sequence[str] = MODE_COLUMNS,
    const_cols: Sequence[str] = CONST_COLUMNS,
    fill_value: str = vocab.MISSING_CATEGORY,
    target: str = TARGET,
) -> Imputer:
    """Fit mean, mode and constant imputation on the columns that are present."""
    mean_cols, mode_cols = imputed_columns(df, mean_cols, mode_cols)
    fills: dict[str, object] = dict(mean_values(df, mean_cols))
    if mode_cols:
        for r in mode_table(df, mode_cols).collect():  # one row per column
            fills[r["column"]] = r["value"]
    return Imputer(constant_fills(df, [*mean_cols, *mode_cols], const_cols, fill_value, target) | fills)


def as_categories(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Booleans and other non-string categoricals as text, for the indexer."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.col(c).cast("string") for c in cats if not isinstance(dtypes[c], StringType)})


def category_table(df: DataFrame, cats: Sequence[str], also: Mapping[str, str] | None = None) -> DataFrame:
    """A5: (column, category, index) with categories sorted per column.

    The distinct (column, category) pairs are ranked by a distributed sort
    (``global_rank``), so no column's categories have to fit in one task;
    a category's index is its rank minus the rank of its column's first
    category (one row per column, broadcast).  ``also`` adds one category to
    a column (the value that imputation writes).
    """
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cats]
    pairs = df.select(F.explode(F.array(*entries)).alias("p")).select("p.*").filter(F.col("category").isNotNull())
    if also:
        pairs = pairs.unionAll(df.sparkSession.createDataFrame(sorted(also.items()), "column string, category string"))
    ranked = global_rank(pairs.distinct(), "column", "category")
    start = ranked.groupBy("column").agg(F.min("_rank").alias("_start"))
    return ranked.join(F.broadcast(start), "column").select(
        "column", "category", (F.col("_rank") - F.col("_start")).cast("double").alias("index")
    )


#: Columns of up to so many categories are encoded by a list in the plan, of up to
#: so many by a broadcast table, larger ones by a shuffled join.
LISTED_CATEGORIES = 64
BROADCAST_CATEGORIES = 20_000


@dataclass
class Encoder:
    """M4: categories sorted ascending -> 0, 1, ... as plain numbers; an unseen category is an error."""

    table: DataFrame  # (column, category, index), materialised
    columns: list[str]

    def __post_init__(self):
        n = {r["column"]: r["count"] for r in self.table.groupBy("column").count().collect()}  # one row per column
        self.sizes = {c: n.get(c, 0) for c in self.columns}
        short = [c for c in self.columns if self.sizes[c] <= LISTED_CATEGORIES]
        self.lists: dict[str, list[str]] = {c: [] for c in short}
        if short:
            for r in self.table.filter(F.col("column").isin(short)).orderBy("column", "index").collect():
                self.lists[r["column"]].append(r["category"])

    def transform(self, df: DataFrame) -> DataFrame:
        codes = {}
        for c in self.columns:
            if c in self.lists:
                listed = F.array(*[F.lit(x) for x in self.lists[c]]).cast("array<string>")
                codes[c] = F.nullif(F.array_position(listed, F.col(c)), F.lit(0)) - 1
            else:
                t = self.table.filter(F.col("column") == c).select(F.col("category").alias("_c"), F.col("index").alias(f"_i_{c}"))
                t = F.broadcast(t) if self.sizes[c] <= BROADCAST_CATEGORIES else t
                df = df.join(t, F.col(c) == F.col("_c"), "left").drop("_c")
                codes[c] = F.col(f"_i_{c}")
        out = {}
        for c, code in codes.items():
            error = F.raise_error(F.concat(F.lit(f"unseen category of {c}: "), F.col(c)))
            out[f"{c}_idx"] = F.when(F.col(c).isNotNull() & code.isNull(), error.cast("double")).otherwise(code.cast("double"))
        return df.withColumns(out).drop(*[f"_i_{c}" for c in self.columns])


def fit_encoder(df: DataFrame, cats: Sequence[str], also: Mapping[str, str] | None = None) -> Encoder:
    """M4: an encoder over all categories of ``df``."""
    return Encoder(columnar_copy(category_table(df, cats, also)), list(cats))


def assembler(cats: Sequence[str], numeric: Sequence[str]) -> VectorAssembler:
    """M5: encoded categoricals first, then the remaining (numeric) columns passed through."""
    return VectorAssembler(inputCols=[f"{c}_idx" for c in cats] + list(numeric), outputCol="features", handleInvalid="keep")


def rmse(df: DataFrame, prediction: str = "prediction", label: str = TARGET) -> DataFrame:
    """One row, the root mean squared error."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2))).alias("rmse"))


# --------------------------------------------------------------- searching

def sample_params(grid: Mapping[str, Sequence], n_iter: int, seed: int = vocab.SEARCH_SEED) -> list[dict]:
    """M7: ``n_iter`` distinct combinations of the grid, drawn with a fixed seed."""
    keys = sorted(grid)
    combos = list(itertools.product(*[grid[k] for k in keys]))
    rng = np.random.RandomState(seed)
    picks = rng.choice(len(combos), size=min(n_iter, len(combos)), replace=False)
    return [dict(zip(keys, combos[i])) for i in sorted(picks)]


def assign_folds(df: DataFrame, k: int = 3, label: str = TARGET, seed: int = vocab.SEARCH_SEED) -> DataFrame:
    """M8: folds stratified on a continuous target.

    Rows are range-sorted by (label, seeded hash) -- a distributed sort, no
    single-task window -- and written with their places, so these are fixed; the
    global rank is then partition offset + position in partition, and
    ``fold = rank mod k`` deals neighbours in price order to different folds
    (each fold gets every k-th price).  Only one count per partition reaches
    the driver.
    """
    key = F.xxhash64(*[F.col(c) for c in df.columns], F.lit(seed))
    ranked = global_rank(df.withColumn("_h", key), label, "_h")
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_h", "_rank")


def global_rank(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``_rank``: the 0-based position of each row in ``order`` (ascending).

    A range-partitioned sort (sampled bounds, no single task), whose rows are written with
    their partition and their position inside it, so both stay fixed; rank = offset of the
    row's partition + position.  Only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranked = columnar_copy(df.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", position))
    counts = sorted((r[0], r[1]) for r in ranked.groupBy("_p").count().collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    # One row per partition: a size bound known before the join, so it is broadcast.
    off = spark.createDataFrame(offsets, "_p int, _off long")
    return (
        ranked.join(F.broadcast(off), "_p")
        .withColumn("_rank", F.col("_off") + F.col("_i"))
        .drop("_p", "_i", "_off")
    )


@dataclass
class PriceModel:
    """Imputation values, encoder and the fitted Spark ML stages (assembler, trees)."""

    imputer: Imputer
    encoder: Encoder
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        x = as_categories(self.imputer.transform(df), self.encoder.columns)
        return self.pipeline.transform(self.encoder.transform(x))


@dataclass
class FitResult:
    model: PriceModel
    best_params: dict
    best_rmse: float
    candidates: list[tuple[dict, float]]


@dataclass
class Prepared:
    """Training rows and what is known of them before any fit: names, and categories of all rows."""

    df: DataFrame
    target: str
    encoder: Encoder
    numeric: list[str]

    def imputer(self, rows: DataFrame) -> Imputer:
        return fit_imputer(rows, target=self.target)

    def encoded(self, rows: DataFrame, imputer: Imputer) -> DataFrame:
        """M1-M4: imputed rows with the codes of their categories."""
        return self.encoder.transform(as_categories(imputer.transform(rows), self.encoder.columns))

    def vectors(self, rows: DataFrame, imputer: Imputer) -> DataFrame:
        """M1-M5: target and feature vector of imputed, encoded rows."""
        return self.assembled(self.encoded(rows, imputer))

    def assembled(self, encoded: DataFrame) -> DataFrame:
        """M5: target and feature vector."""
        return self.assembler().transform(encoded).select(self.target, "features")

    def stored(self, rows: DataFrame, imputer: Imputer, *also: str) -> DataFrame:
        """``encoded`` rows as a table of what vectors are made of (and the columns ``also``).

        Vectors are made from it where they are read: as columns of few values they take a
        fraction of a vector's bytes on disk.
        """
        names = [*also, self.target, *self.assembler().getInputCols()]
        return columnar_copy(self.encoded(rows, imputer).select(*names))

    def assembler(self) -> VectorAssembler:
        return assembler(self.encoder.columns, self.numeric)

    def trees(self, params: Mapping[str, object], seed: int) -> GBTRegressor:
        """M6: gradient-boosted trees on the assembled features."""
        return GBTRegressor(labelCol=self.target, featuresCol="features", seed=seed, **params)

    def fit(self, params: Mapping[str, object], seed: int) -> PriceModel:
        """One model on all rows."""
        imputer = self.imputer(self.df)
        model = self.trees(params, seed).fit(self.assembled(self.stored(self.df, imputer)))
        return PriceModel(imputer, self.encoder, PipelineModel([self.assembler(), model]))


def prepare(gold: DataFrame, target: str = TARGET, stored: bool = False) -> Prepared:
    """P17-P20 and the categories.  The categories are a schema, not a statistic of the
    target: they are read from all rows, so a fold may lack some of them."""
    df, cats = features_frame(gold if stored else columnar_copy(gold), target)
    df = df.filter(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("double"))
    fills = {c: v for c, v in fit_imputer(df.limit(0), mean_cols=(), mode_cols=MODE_COLUMNS, target=target).fills.items() if v is not None}
    encoder = fit_encoder(df, cats, {c: v for c, v in fills.items() if c in cats})
    return Prepared(df, target, encoder, [c for c in df.columns if c not in cats and c != target])


def fold_imputers(folded: DataFrame, folds: int, target: str = TARGET) -> list[Imputer]:
    """For each fold the imputer of its training rows, from statistics that are counted once for all folds."""
    plain = folded.drop("fold")
    means, modes = imputed_columns(plain)
    constants = constant_fills(plain, [*means, *modes], target=target)
    return [Imputer(constants | fills) for fills in search.fold_fills(folded, folds, means, modes)]


def train_price_model(
    gold: DataFrame,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    n_iter: int = 10,
    folds: int = 3,
    seed: int = vocab.SEARCH_SEED,
    parallelism: int = 4,
    target: str = TARGET,
    stored: bool = False,
    ledger: str | None = None,
) -> FitResult:
    """P17-P20, encoding (M4), then imputation (M1-M3), assembly (M5) and trees (M6)
    searched (M7) over stratified folds (M8) by RMSE (A6); refit on all rows.

    Means and modes are fitted inside each fold, on its training rows only.  A
    fold's codes are made once and stored; draws that differ in their number of
    trees alone share one fit, and the fits of a fold read that copy,
    ``parallelism`` of them at a time.
    ``ledger`` names a table (on shared storage) in which finished fits are
    written down: a search that was cut off goes on from there.  The passes over
    ``gold`` read one stored copy: pass ``stored=True`` when it already is one
    (read from a written table, or checkpointed), otherwise it is checkpointed first.
    """
    p = prepare(gold, target, stored)
    params = sample_params(grid, n_iter, seed)
    wanted = search.staged(params)
    folded = assign_folds(p.df, folds, target, seed)
    book = search.Ledger(p.df.sparkSession, ledger, search.digest(p.df, seed=seed, folds=folds) if ledger else "")
    open_folds = [f for f in range(folds) if not all(book.holds(fit, f, counts) for fit, counts in wanted.items())]
    imputers = fold_imputers(folded, folds, target) if open_folds else []
    for f in open_folds:
        rows = p.stored(folded, imputers[f], "fold")
        fit_on, try_on = (p.assembled(rows.filter(side)) for side in (F.col("fold") != f, F.col("fold") == f))

        def errors(fit: str, counts: Sequence[int]) -> list[tuple[int, float, int]]:
            model = p.trees({**json.loads(fit), "maxIter": counts[-1]}, seed).fit(fit_on)
            return search.stage_errors(model, try_on, target, counts)

        search.run_fits(book, f, wanted, errors, parallelism)
    fit_of = [json.dumps({k: v for k, v in x.items() if k != "maxIter"}, sort_keys=True) for x in params]
    means = [float(np.mean([book.error(fit, f, x["maxIter"]) for f in range(folds)])) for fit, x in zip(fit_of, params)]
    best = int(np.argmin(means))
    return FitResult(p.fit(params[best], seed), params[best], means[best], list(zip(params, means)))


def save_model(model: PriceModel, path: str) -> None:
    """The stages in Spark ML's format; the fills as a one-row table and the categories as a table beside it."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"fills": model.imputer.fills, "categorical": model.encoder.columns})
    spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")
    model.encoder.table.write.mode("overwrite").parquet(f"{path}/categories")


def load_model(path: str) -> PriceModel:
    """Load a model saved by ``save_model``."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    encoder = Encoder(spark.read.parquet(f"{path}/categories"), meta["categorical"])
    return PriceModel(Imputer(meta["fills"]), encoder, PipelineModel.load(f"{path}/pipeline"))


def predict(model: PriceModel | None, df: DataFrame) -> DataFrame:
    """M9: batch scores; with no model loaded every row gets the fallback value."""
    if model is None:
        return df.withColumn("prediction", F.lit(vocab.NO_MODEL_PREDICTION))
    return model.transform(df)
