"""Feature stages (MLlib transformers/estimators) and stage builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucketize(
    df: DataFrame, input_col: str, output_col: str, splits: Sequence[float]
) -> DataFrame:
    """Bucket index of ``input_col``: bucket i holds ``[splits[i], splits[i+1])``
    (the last bucket also holds its upper bound). Use ``-inf``/``inf`` ends
    to cover every value."""
    return Bucketizer(splits=list(splits), inputCol=input_col, outputCol=output_col).transform(df)


def string_indexer(input_col: str, output_col: str, keep_unseen: bool = False) -> StringIndexer:
    """Most frequent label -> 0.0, ties alphabetical. Unseen labels raise, or
    with ``keep_unseen`` go to an extra index equal to the label count."""
    return StringIndexer(
        inputCol=input_col,
        outputCol=output_col,
        handleInvalid="keep" if keep_unseen else "error",
        stringOrderType="frequencyDesc",
    )


def index_strings(
    fit_df: DataFrame,
    apply_df: DataFrame,
    input_col: str,
    output_col: str,
    keep_unseen: bool = False,
) -> DataFrame:
    """Fit an indexer on ``fit_df`` (a distributed label count; only the
    label list reaches the driver) and apply it to ``apply_df``."""
    return string_indexer(input_col, output_col, keep_unseen).fit(fit_df).transform(apply_df)


def one_hot(df: DataFrame, input_col: str, output_col: str, drop_last: bool = True) -> DataFrame:
    """One-hot vector of an index column (last category dropped by default)."""
    enc = OneHotEncoder(inputCols=[input_col], outputCols=[output_col], dropLast=drop_last)
    return enc.fit(df).transform(df)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str) -> DataFrame:
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col).transform(df)


def standard_scale(
    df: DataFrame, input_col: str, output_col: str, with_mean: bool = False, with_std: bool = True
) -> DataFrame:
    """Divide by the sample standard deviation (no centring by default).
    Fitting is one distributed summary pass."""
    sc = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)
    return sc.fit(df).transform(df)


def vector_items(vec: Column | str, n: int, prefix: str, digits: int | None = None) -> list[Column]:
    """The first ``n`` components of a vector column as scalar columns."""
    arr = vector_to_array(F.col(vec) if isinstance(vec, str) else vec)
    out = []
    for i in range(n):
        c = F.get(arr, i)
        if digits is not None:
            c = F.round(c, digits)
        out.append(c.alias(f"{prefix}{i}"))
    return out


def vector_text(vec: Column | str) -> Column:
    """A vector as ``"v0,v1,..."`` with integral components (one-hot)."""
    arr = vector_to_array(F.col(vec) if isinstance(vec, str) else vec)
    return F.array_join(F.transform(arr, lambda x: x.cast("int").cast("string")), ",")


@dataclass(frozen=True)
class Columns:
    """How the columns of a table enter a feature vector, in this order:
    bucketed (column -> splits), indexed and one-hot categories, numbers as
    they are, and numbers divided by their standard deviation."""

    bucketed: Mapping[str, Sequence[float]] = field(default_factory=dict)
    indexed: Sequence[str] = ()
    one_hot: Sequence[str] = ()
    plain: Sequence[str] = ()
    scaled: Sequence[str] = ()


def feature_stages(
    columns: Columns, output: str = "features", keep_unseen: bool = False, prefix: str = "_f"
) -> list:
    """Pipeline stages from ``columns`` to the vector ``output``. Every kind of
    encoding is one multi-column stage, so all categories are counted by one
    job. Intermediate columns are named ``<prefix>_<kind>_<column>``."""
    name = lambda kind, cols: [f"{prefix}_{kind}_{c}" for c in cols]
    stages, parts = [], []

    def add(stage, made: list[str], used: bool = True) -> None:
        stages.append(stage)
        parts.extend(made if used else [])

    if columns.bucketed:
        made = name("bucket", columns.bucketed)
        splits = [list(v) for v in columns.bucketed.values()]
        add(Bucketizer(splitsArray=splits, inputCols=list(columns.bucketed), outputCols=made), made)
    categories = [*columns.indexed, *columns.one_hot]
    if categories:
        made = name("index", categories)
        handle = "keep" if keep_unseen else "error"
        add(StringIndexer(inputCols=categories, outputCols=made, handleInvalid=handle), made[: len(columns.indexed)])
        if columns.one_hot:
            vectors = name("onehot", columns.one_hot)
            add(OneHotEncoder(inputCols=made[len(columns.indexed) :], outputCols=vectors), vectors)
    parts.extend(columns.plain)
    if columns.scaled:
        numbers, made = f"{prefix}_numbers", [f"{prefix}_scaled"]
        add(VectorAssembler(inputCols=list(columns.scaled), outputCol=numbers), [], used=False)
        add(StandardScaler(inputCol=numbers, outputCol=made[0]), made)
    return [*stages, VectorAssembler(inputCols=parts, outputCol=output)]
