"""Gradient-boosted rankers over the numeric columns of a feature table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from .evaluation import per_query_recall
from .topk import blend

#: Columns that say what a row is, not what is known of it; ``category_match`` shifts between the log and the queries to come.
NOT_FEATURES = {"qid", "item_idx", "label", "query_id", "item_id", "split", "category_match"}
#: Splits that a model may be trained on.
TRAINABLE = {("fit",), ("dev", "fit")}


def numeric_inputs(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """Names of the columns a model may see, in the table's order; all must be numbers or flags."""
    text = []
    names = []
    for field in df.schema.fields:
        if field.name in NOT_FEATURES or field.name in without:
            continue
        (names if isinstance(field.dataType, NumericType | BooleanType) else text).append(field.name)
    if text:
        raise ValueError(f"columns that are no numbers: {text}")
    return names


def guard(df: DataFrame, splits: tuple[str, ...]) -> None:
    """Only fit, or fit and dev, may train, and no row of another split may be there."""
    if tuple(sorted(splits)) not in TRAINABLE:
        raise ValueError(f"models are not trained on {splits}")
    if df.where(F.col("split").isNull() | ~F.col("split").isin(*splits)).head(1):
        raise ValueError("rows of other splits in the training table")


def train(df: DataFrame, features: list[str], trees: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42, splits: tuple[str, ...] | None = None) -> PipelineModel:
    """A model of ``label``; ``splits`` are those the table may hold."""
    if splits is not None:
        guard(df, splits)
    gbt = GBTClassifier(labelCol="label", featuresCol="__x", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
    numbers = df.select("label", *[F.col(c).cast("double") for c in features])
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__x", handleInvalid="keep"), gbt]).fit(numbers)


def _inputs(model: PipelineModel, df: DataFrame) -> DataFrame:
    names = model.stages[0].getInputCols()
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"features that the model was trained on are missing: {missing}")
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """``df`` with the margin of label 1."""
    return model.transform(_inputs(model, df)).withColumn(name, vector_to_array("rawPrediction")[1]).drop("__x", "rawPrediction", "probability", "prediction")


def score_models(models: dict[str, PipelineModel], df: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """``df`` with the margin of each model, and ``score``: the margin of one, the weighted sum of standard scores within a query of several."""
    for name, model in models.items():
        df = score(model, df, f"score_{name}")
    names = [f"score_{m}" for m in models]
    return df.withColumn("score", F.col(names[0])) if len(names) == 1 else blend(df, names, weights)


def prefix_scores(model: PipelineModel, df: DataFrame, sizes: list[int]) -> DataFrame:
    """``df`` with score_<n>, the margin after the first n trees, for each n of ``sizes``; one pass over the rows.

    Spark's trees are in the driver's model; their predictions on a leaf
    vector are taken by the first n trees of a copy of the model.
    """
    boosted: GBTClassificationModel = model.stages[-1]
    names, rows = model.stages[0].getInputCols(), _inputs(model, df)
    rows = rows.withColumn("__x", array_to_vector(F.array(*names)))
    for i, (tree, weight) in enumerate(zip(boosted.trees, boosted.treeWeights, strict=True)):
        tree.setFeaturesCol("__x").setPredictionCol(f"__t{i}")
        rows = tree.transform(rows)
        rows = rows.withColumn(f"__m{i}", (F.col(f"__m{i - 1}") if i else F.lit(0.0)) + F.col(f"__t{i}") * weight)
    for n in sizes:
        rows = rows.withColumn(f"score_{n}", F.col(f"__m{min(n, len(boosted.trees)) - 1}"))
    return rows.select(*df.columns, *[f"score_{n}" for n in sizes])


def select_trees(model: PipelineModel, dev: DataFrame, queries: DataFrame, truth: DataFrame, every: int = 50, k: int = 50) -> tuple[int, list[tuple[int, float]]]:
    """The number of trees with the best mean recall on dev rows, of equal ones the smallest; and all that were tried."""
    n = len(model.stages[-1].trees)
    sizes = sorted({*range(every, n + 1, every), n})
    scored = prefix_scores(model, dev, sizes)
    tried = [(size, per_query_recall(queries, scored, truth, [k], f"score_{size}").agg(F.avg(f"recall_{k}")).first()[0] or 0.0) for size in sizes]
    return max(tried, key=lambda t: (t[1], -t[0]))[0], tried


def save(model: PipelineModel, path: str) -> None:
    """The model whole: its trees and the names of its features, in order."""
    model.write().overwrite().save(path)


def load(path: str, features: list[str] | None = None) -> PipelineModel:
    """A saved model; ValueError if it was trained on other features."""
    model = PipelineModel.load(path)
    if features is not None and model.stages[0].getInputCols() != features:
        raise ValueError("the model was trained on other features")
    return model


def blend_grid(df: DataFrame, scores: list[str], queries: DataFrame, truth: DataFrame, grid: tuple[float, ...] = (0.25, 0.5, 0.75), k: int = 50) -> DataFrame:
    """(w, recall): mean recall at k of blends, w for the first of two models and 1 - w for the second; equal weights for more."""
    weights = [[w, 1 - w] for w in grid] if len(scores) == 2 else [None]
    out = None
    for w in weights:
        per = per_query_recall(queries, blend(df, scores, w).withColumn("score", F.round("score", 6)), truth, [k])
        own = per.agg(F.avg(f"recall_{k}").alias("recall")).select(F.lit(w[0] if w else 1 / len(scores)).alias("w"), "recall")
        out = own if out is None else out.unionByName(own)
    return out
