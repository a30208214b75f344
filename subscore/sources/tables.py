"""CSV tables in, score and model files out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_csv(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """CSV with a header, every column text; ``path`` may be a folder of part files.

    With ``columns`` the schema is declared and no job runs to look at the header.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sampling: float = 1.0,
) -> DataFrame:
    """CSV with a header and typed columns.

    Types are inferred when no ``schema`` is given. That reads the file once more,
    or the given share of it; a type inferred from a share may not fit the rest.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).option("samplingRatio", sampling).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks are kept, so text reads back as it was."""
    writer = df.write.mode("overwrite").option("header", True)
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path)


def write_scores(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, written by the executors."""
    scores.write.mode(mode).json(path)


def save_model(model: PipelineModel, uri: str) -> None:
    """Write the model to any file system Spark knows, replacing what is there."""
    model.write().overwrite().save(uri)


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
