"""Model input: exact imputation, one-hot encoding, assembly."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSizeHint, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskloom.functions.parsing import number_column
from riskloom.operators.selection import exact_quantiles
from riskloom.schema import CATEGORICAL, NUMERIC

FILLED, INDEX, ONE_HOT = "__filled", "__index", "__onehot"
# The only category of a column without any value; encoders refuse an empty name.
NO_CATEGORY = "(none)"
FEATURES_COLUMN = "features"


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (midpoint of the two middle values) of all columns, each pass one aggregate over all of them."""
    return exact_quantiles(df, {c: number_column(df, c) for c in columns}, Fraction(1, 2))


def _category_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, name, value, n, size): counts per column and value as text; `size` orders values of number columns."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    by_size = F.when(F.col("name").isin(numeric), F.col("value").try_cast("double"))
    return (
        df.select(*by, *[F.col(c).cast("string") for c in columns])
        .unpivot(list(by), list(columns), "name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("size", by_size)
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each column as text, the smallest on ties; one scan for all."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), "size", "value"))
    rows = _category_counts(df, columns, []).groupBy("name").agg(best.alias("best")).collect()
    found = {row["name"]: row["best"]["value"] for row in rows}
    return {c: found.get(c) for c in columns}


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = medians(df, columns)
    return df.withColumns({c: F.coalesce(number_column(df, c), F.lit(values[c])) for c in columns})


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = modes(df, columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(values[c]).cast(df.schema[c].dataType)) for c in columns}
    )


def _named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns with an empty text as a missing one."""
    text = [c for c in columns if not isinstance(df.schema[c].dataType, NumericType)]
    return df.withColumns({c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in text})


class _Columns(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns filled with their median", TypeConverters.toListString)
    categoricalCols = Param(
        Params._dummy(), "categoricalCols", "columns filled with their mode", TypeConverters.toListString
    )


class PolicyImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns exact medians and modes from the rows it is fit on, and from no others."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PolicyImputerModel":
        numeric, categorical = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        middle, common = medians(df, numeric), modes(_named(df, categorical), categorical)
        # A column without any value carries no information; a constant keeps the width stable.
        return PolicyImputerModel(
            numericCols=numeric,
            categoricalCols=categorical,
            numericFills=[0.0 if middle[c] is None else middle[c] for c in numeric],
            categoricalFills=[NO_CATEGORY if common[c] is None else common[c] for c in categorical],
        )


class PolicyImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Writes each input column, without gaps, to a column of its own."""

    numericFills = Param(Params._dummy(), "numericFills", "value per numeric column", TypeConverters.toListFloat)
    categoricalFills = Param(
        Params._dummy(), "categoricalFills", "value per categorical column", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, numericFills=None, categoricalFills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        numbers = zip(self.getOrDefault("numericCols"), self.getOrDefault("numericFills"))
        texts = zip(self.getOrDefault("categoricalCols"), self.getOrDefault("categoricalFills"))
        filled = {c + FILLED: F.coalesce(number_column(df, c), F.lit(v)) for c, v in numbers}
        filled |= {c + FILLED: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(v)) for c, v in texts}
        return df.withColumns(filled)


def one_hot_stages(columns: Sequence[str], suffix: str = "") -> list:
    """Every category seen in fitting, in text order; an unseen or missing one is all zeros.

    The indexer's extra slot for the unseen is the one the encoder drops.
    """
    index = StringIndexer(
        inputCols=[c + suffix for c in columns],
        outputCols=[c + INDEX for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encode = OneHotEncoder(
        inputCols=[c + INDEX for c in columns], outputCols=[c + ONE_HOT for c in columns], dropLast=True
    )
    return [index, encode]


def assembler(numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> VectorAssembler:
    """Numeric block, then categorical block."""
    return VectorAssembler(
        inputCols=[*[c + FILLED for c in numeric], *[c + ONE_HOT for c in categorical]],
        outputCol=FEATURES_COLUMN,
    )


def preparation_stages(numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> list:
    imputer = PolicyImputer(numericCols=list(numeric), categoricalCols=list(categorical))
    return [imputer, *one_hot_stages(categorical, FILLED), assembler(numeric, categorical)]


def learn_preparation(
    df: DataFrame, by: str | None = None, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL
) -> dict[object, PipelineModel]:
    """Fitted preparation stages for each group of rows, equal to those that fitting on the group alone gives.

    All groups are learned in the same passes: the medians' aggregates, and one count of categories that
    yields modes and dictionaries both. Without `by` the only group is None. The driver holds each
    group's dictionaries, as the fitted indexer does.
    """
    groups = [] if by is None else [by]
    middle = exact_quantiles(df, {c: number_column(df, c) for c in numeric}, Fraction(1, 2), groups)
    middle = middle if by is not None else {(): middle}
    counted = _category_counts(_named(df, categorical), categorical, groups).groupBy(*groups, "name")
    best = F.min(F.struct((-F.col("n")).alias("rank"), "size", "value"))
    rows = counted.agg(best.alias("best"), F.collect_list("value").alias("values")).collect()
    found = {(tuple(row[c] for c in groups), row["name"]): (row["best"]["value"], row["values"]) for row in rows}

    fitted = {}
    for group, medians_ in middle.items():
        own = {c: found.get((group, c), (NO_CATEGORY, [NO_CATEGORY])) for c in categorical}
        imputer = PolicyImputerModel(
            numericCols=list(numeric),
            categoricalCols=list(categorical),
            numericFills=[0.0 if medians_[c] is None else medians_[c] for c in numeric],
            categoricalFills=[own[c][0] for c in categorical],
        )
        # A column without any value is filled with the empty text, its only category then.
        labels = [own[c][1] for c in categorical]
        index, encode = one_hot_stages(categorical, FILLED)
        # The indexer learns from the distinct values alone: so many rows as the longest list, short ones repeated.
        rows = [tuple(of[i % len(of)] for of in labels) for i in range(max(map(len, labels)))]
        index = index.fit(df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` string" for c in index.getInputCols())))
        # The encoder reads the sizes from the columns' metadata, not from rows.
        indexed = index.transform(imputer.transform(df.limit(0)))
        fitted[group[0] if group else None] = PipelineModel([imputer, index, encode.fit(indexed), assembler(numeric, categorical)])
    return fitted


def working_columns(columns: Sequence[str]) -> list[str]:
    """The helper columns that the preparation stages leave behind."""
    return [c for c in columns if c.endswith((FILLED, INDEX, ONE_HOT))]


def vector_width(df: DataFrame, column: str) -> int | None:
    """Vector length from the column's metadata, else from one row."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if known is None:
        row = df.filter(F.col(column).isNotNull()).select(F.size(vector_to_array(column)).alias("w")).first()
        known = row.w if row else None
    return known


def align_width(df: DataFrame, column: str, width: int, out: str) -> DataFrame:
    """Vector cut, or padded with zeros at the end, to the width a model expects; stays sparse."""
    have = vector_width(df, column)
    if have is None or have == width:
        return df.withColumn(out, F.col(column))
    if have > width:
        return VectorSlicer(inputCol=column, outputCol=out, indices=list(range(width))).transform(df)
    rows = df.withColumn("__padding", array_to_vector(F.array_repeat(F.lit(0.0), width - have)))
    for name, size in ((column, have), ("__padding", width - have)):
        rows = VectorSizeHint(inputCol=name, size=size, handleInvalid="optimistic").transform(rows)
    joined = VectorAssembler(inputCols=[column, "__padding"], outputCol=out, handleInvalid="keep")
    return joined.transform(rows).drop("__padding")
