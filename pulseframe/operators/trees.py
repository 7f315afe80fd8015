"""Fitted forests as tables of nodes and as column expressions.

Scoring by expressions needs no vectors and no model object in the tasks: the trees are nested CASE expressions that
Catalyst compiles with the rest of the query, on tables and on streams.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions import is_missing
from pulseframe.staging import remove, stage, work_dir

#: Nodes of a model that become expressions; its settings bound them, not the data.
MOST_NODES = 50_000


def forest_nodes(spark: SparkSession, forest: RandomForestRegressionModel) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, prediction, gain, n_rows), a row for each node.

    A split on a number goes left up to `threshold`, one on a category goes left for `categories`; a leaf has no feature.
    """
    path = work_dir(spark, "forest")
    forest.write().save(path)
    data = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    number = inner & (F.col("split.numCategories") < 0)
    nodes = stage(
        data.select(
            "tree",
            F.col("id").alias("node"),
            F.when(inner, F.col("split.featureIndex")).alias("feature"),
            F.when(number, values[0]).alias("threshold"),
            F.when(inner & ~number, values).alias("categories"),
            F.when(inner, F.col("leftChild")).alias("left"),
            F.when(inner, F.col("rightChild")).alias("right"),
            "prediction",
            F.when(inner, F.col("gain")).alias("gain"),
            F.col("rawCount").alias("n_rows"),
        ),
        "nodes",
    )
    remove(spark, path)
    return nodes


def _number(value: float) -> str:
    return f"{value!r}D"


def _tree(nodes: Mapping[int, Row], at: int, features: Sequence[str]) -> str:
    node = nodes[at]
    if node["feature"] is None:
        return _number(node["prediction"])
    value = features[node["feature"]]
    if node["categories"] is None:
        goes_left = f"{value} <= {_number(node['threshold'])}"
    else:
        goes_left = f"{value} IN ({', '.join(map(_number, node['categories']))})" if node["categories"] else "FALSE"
    return f"CASE WHEN {goes_left} THEN {_tree(nodes, node['left'], features)} ELSE {_tree(nodes, node['right'], features)} END"


def forest_expression(nodes: DataFrame, features: Sequence[str]) -> Column:
    """The mean of the trees' predictions, added up in the order of the trees, so that it equals the model's to the last bit.

    `features` are names of DOUBLE columns. NaN goes where a number beyond every threshold goes.
    """
    rows = nodes.limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes: score with the model itself")
    trees: dict[int, dict[int, Row]] = defaultdict(dict)
    for row in rows:
        trees[row["tree"]][row["node"]] = row
    named = [f"`{name}`" for name in features]
    total = " + ".join(["0.0D", *(f"({_tree(trees[number], 0, named)})" for number in sorted(trees))])
    return F.expr(f"({total}) / {_number(float(len(trees)))}")


def _indexed(df: DataFrame, stage: StringIndexerModel) -> DataFrame:
    column, output, labels = F.col(stage.getInputCol()), stage.getOutputCol(), stage.labels
    index = F.when(F.lit(False), F.lit(0.0))
    for place, label in enumerate(labels):
        index = index.when(column == label, F.lit(float(place)))
    if stage.getHandleInvalid() == "keep":
        return df.withColumn(output, index.otherwise(F.lit(float(len(labels)))))
    if stage.getHandleInvalid() == "skip":
        return df.withColumn(output, index).where(F.col(output).isNotNull())
    message = F.concat(F.lit(f"{stage.getInputCol()} has a value that was not seen: "), F.coalesce(column, F.lit("NULL")))
    return _required(df.withColumn(output, index), F.col(output).isNotNull(), message)


def _required(df: DataFrame, good: Column, message: Column) -> DataFrame:
    """`df`, which fails at a row that is not good. A filter, since the optimizer drops columns that no tree asks for."""
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _checked(df: DataFrame, stage: VectorAssembler) -> tuple[DataFrame, list[str]]:
    """`df` with the features as doubles under names of their own."""
    inputs = stage.getInputCols()
    values = [F.col(name).cast("double") for name in inputs]
    missing = reduce(lambda a, b: a | b, map(is_missing, values))
    how = stage.getHandleInvalid()
    if how == "skip":
        df = df.where(~missing)
    elif how == "keep":
        values = [F.coalesce(value, F.lit(float("nan"))) for value in values]
    else:
        df = _required(df, ~missing, F.lit(f"one of {', '.join(inputs)} is missing"))
    names = [f"_{stage.getOutputCol()}_{place}" for place in range(len(inputs))]
    return df.withColumns(dict(zip(names, values))), names


def score_by_expressions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with the predictions of a fitted pipeline of indexers, assemblers and forests, tables and streams alike.

    As `model.transform`, row for row and bit for bit, but without the vector column. Rows with missing or unseen values are treated as
    the pipeline's stages say. Meant for forests of up to a few hundred nodes: the code of larger ones is too long for
    one compiled method, and the model itself is then as fast or faster.
    """
    features: dict[str, list[str]] = {}
    for part in model.stages:
        if isinstance(part, StringIndexerModel):
            df = _indexed(df, part)
        elif isinstance(part, VectorAssembler):
            df, features[part.getOutputCol()] = _checked(df, part)
        elif isinstance(part, RandomForestRegressionModel):
            nodes = forest_nodes(df.sparkSession, part)
            df = df.withColumn(part.getPredictionCol(), forest_expression(nodes, features[part.getFeaturesCol()]))
        else:
            raise TypeError(f"no expression for a {type(part).__name__}")
    return df.drop(*(name for names in features.values() for name in names))
