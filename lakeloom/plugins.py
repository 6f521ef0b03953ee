"""Pluggable models: scorers, captioners, encoders, labelers and image coders, one instance for each Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

#: Result type of each kind of model; a model takes and returns one list for each batch.
KINDS = {
    "scorer": "struct<score:double,probs:array<double>>",
    "captioner": "string",
    "encoder": "array<float>",
    "labeler": "array<struct<type:string,cls:int,data:array<double>>>",
    "coder": "binary",
}
_MODELS: dict[str, tuple[str, Callable]] = {}
_LOADED: dict[str, Callable] = {}


def register(kind: str, name: str, load: Callable[[], Callable[[list], list]]) -> None:
    """``load`` builds the model in a worker, at its first batch; the model maps a list of inputs to a list."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind}; known are {', '.join(KINDS)}")
    _MODELS[name] = (kind, load)


def apply(name: str, column: Column) -> Column:
    """The model over a column in Arrow batches."""
    kind, load = _MODELS[name]

    @pandas_udf(KINDS[kind])
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _LOADED:
            _LOADED[name] = load()
        for batch in batches:
            out = _LOADED[name](batch.tolist())
            yield pd.DataFrame(out, columns=["score", "probs"]) if kind == "scorer" else pd.Series(out, dtype=object)

    return run(column)


def score_missing(df: DataFrame, name: str, column: str) -> DataFrame:
    """Scores only the rows that no ground truth covers; the others never reach the model."""
    known = df.where(F.col("score").isNotNull())
    need = df.where(F.col("score").isNull()).withColumn("_s", apply(name, F.col(column)))
    need = need.withColumn("score", F.col("_s.score")).withColumn("probs", F.col("_s.probs")).drop("_s")
    return known.unionByName(need)


def label_missing(df: DataFrame, name: str, column: str) -> DataFrame:
    """Labels only rows without annotations whose task is not quality, and says which were labelled by the model."""
    bare = (F.coalesce(F.size("annotations"), F.lit(0)) <= 0) & (F.col("task") != "quality")
    rest = df.where(~bare).withColumn("is_autolabeled", F.lit(False))
    need = df.where(bare).withColumn("annotations", apply(name, F.col(column))).withColumn("is_autolabeled", F.coalesce(F.size("annotations") > 0, F.lit(False)))
    return rest.unionByName(need)


def caption(df: DataFrame, name: str | None, column: str, fallback: str = "an image") -> DataFrame:
    """Sidecar captions first, then the captioner, then a constant."""
    blank = F.coalesce(F.col("caption"), F.lit("")) == ""
    if name is None:
        return df.withColumn("caption", F.when(blank, F.lit(fallback)).otherwise(F.col("caption")))
    rest, need = df.where(~blank), df.where(blank).withColumn("caption", F.coalesce(apply(name, F.col(column)), F.lit(fallback)))
    return rest.unionByName(need)


def recode(df: DataFrame, name: str, column: str) -> DataFrame:
    """Image bytes resized and encoded by a coder, which needs a library that this package does not bring; bytes that it
    gives back as None leave out their row."""
    return df.withColumn(column, apply(name, F.col(column))).where(F.col(column).isNotNull())
