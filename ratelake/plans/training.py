"""Training and batch scoring with Spark ML.

The described model is a boosted-tree regressor of another library. Spark's has
no L1 or L2 term, so its metrics are not comparable with that model's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.model import quoted
from ratelake.operators.metrics import regression_metrics
from ratelake.session import shared_folder
from ratelake.sinks.store import TableStore

# Model and split parameters.
MAX_DEPTH = 6
LEARNING_RATE = 0.01
ROUNDS = 1000
ROW_SHARE = 0.8
COLUMN_SHARE = "0.8"
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
# Rows that a task of a fit holds; each round reads them again, about 180 bytes a row.
ROWS_PER_TASK = 1_000_000
# Rounds after which a fit of Spark's cuts its lineage, if there is a checkpoint folder.
CHECKPOINT_ROUNDS = 10
# Early stopping by improvement; Spark has no patience count.
MIN_IMPROVEMENT = 0.01
# The day of the run that made a prediction.
SCORED_ON = "scored_on"


def bucket_of(*columns: str, buckets: int = 10, seed: int | None = None) -> Column:
    """A reproducible bucket from the row's key, equal on every engine that has MD5."""
    parts = [quoted(c).cast("string") for c in columns]
    text = F.concat_ws("|", *([F.lit(str(seed))] if seed is not None else []), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def with_split(df: DataFrame, *key: str, test_share: float = TEST_SHARE, seed: int | None = None) -> DataFrame:
    """Add ``split`` = train or test. A row's part never depends on partitioning or order."""
    return df.withColumn(
        "split",
        F.when(bucket_of(*key, buckets=1000, seed=seed) < round(test_share * 1000), F.lit("test")).otherwise(F.lit("train")),
    )


def booster(
    features: Sequence[str],
    label: str,
    rounds: int = ROUNDS,
    max_depth: int = MAX_DEPTH,
    learning_rate: float = LEARNING_RATE,
    seed: int = SEED,
    validation: str | None = None,
) -> Pipeline:
    """Assembler and booster. ``validation`` names a boolean column for early stopping."""
    stopping = {"validationIndicatorCol": validation, "validationTol": MIN_IMPROVEMENT} if validation else {}
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        maxDepth=max_depth,
        stepSize=learning_rate,
        maxIter=rounds,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=COLUMN_SHARE,
        checkpointInterval=CHECKPOINT_ROUNDS,
        seed=seed,
        **stopping,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), regressor])


def _used(features: Sequence[str], label: str, validation: str | None = None, **_) -> list[str]:
    """The columns that a fit reads."""
    return [*features, label, *([validation] if validation else [])]


def _checkpointed(spark: SparkSession, rounds: int) -> None:
    """Each round of a fit depends on the one before; a long fit needs a folder where that chain is cut."""
    context = spark.sparkContext
    if rounds > CHECKPOINT_ROUNDS and context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


@contextmanager
def spread(df: DataFrame, columns: Sequence[str], above: int | None = None) -> Iterator[DataFrame]:
    """The columns of ``df``, dealt to tasks of about ``ROWS_PER_TASK`` rows; a table of fewer rows is left as it is.

    With ``above``, a table of more rows than that is dealt to all cores too. However many rows a part of a file holds, a task of the fit keeps a bounded number. All
    columns decide where a row goes and rows are sorted there, so that what a seed samples
    depends on the rows alone, not on files or on the order in which they arrive.
    """
    rows = df.count()
    if rows <= min(ROWS_PER_TASK, ROWS_PER_TASK if above is None else above):
        yield df
        return
    # Spark hashes no maps and variants.
    hashed = [quoted(f.name) for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    kept = [quoted(c) for c in dict.fromkeys(columns)]
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    dealt = df.select(*kept, F.xxhash64(*hashed).alias("__deal")).repartition(tasks, "__deal")
    # Kept for the block: a fit reads its input several times.
    held = dealt.sortWithinPartitions(*kept).drop("__deal").persist()
    try:
        yield held
    finally:
        held.unpersist()


def fit(df: DataFrame, features: Sequence[str], label: str, deal_above: int | None = None, **params) -> PipelineModel:
    """The model fitted on ``df``. ``deal_above``: rows beyond which all cores work, worth its shuffle in a long fit."""
    _checkpointed(df.sparkSession, params.get("rounds", ROUNDS))
    with spread(df, _used(features, label, **params), deal_above) as rows:
        return booster(features, label, **params).fit(rows)


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, folds: int = FOLDS, **params
) -> CrossValidatorModel:
    """K-fold RMSE of the booster; off in the default plan."""
    validator = CrossValidator(
        estimator=booster(features, label, **params),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        numFolds=folds,
        seed=SEED,
    )
    _checkpointed(df.sparkSession, params.get("rounds", ROUNDS))
    with spread(df, _used(features, label, **params)) as rows:
        return validator.fit(rows)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with their prediction; partitions take the place of read chunks."""
    return model.transform(df).drop("features")


def evaluate(model: PipelineModel, df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Metrics per split in one pass."""
    return regression_metrics(score(model, df), label, "prediction", [split])


def read_training_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Training data from CSV with a header and a stated schema."""
    return spark.read.schema(schema).csv(path, header=True)


def save_features(store: TableStore, table: str, features: DataFrame, date_column: str) -> None:
    """Keep features by month of ``date_column``; months of ``features`` are replaced, so a run can be repeated."""
    store.ensure_table(table, features.schema, date_column, description="Features by month")
    store.replace_partitions(table, features)


def save_predictions(store: TableStore, table: str, scored: DataFrame, run_day: date) -> None:
    """Keep the predictions of one day's run beside those of other days. A repeated run takes the place of its first."""
    rows = scored.withColumn(SCORED_ON, F.lit(run_day))
    store.ensure_table(table, rows.schema, SCORED_ON, granularity="day", description="Predictions by day of the run")
    with store.staged(rows) as kept:
        if kept.isEmpty():
            store.drop_parts(table, [f"{run_day:%Y-%m-%d}"])
        else:
            store.replace_partitions(table, kept)


def read_predictions(store: TableStore, table: str, run_day: date | None = None) -> DataFrame:
    """One day's predictions, by default the newest run's; only that day's files are read."""
    return store.scan(table, {SCORED_ON: run_day or store.latest_date(table, SCORED_ON)})
