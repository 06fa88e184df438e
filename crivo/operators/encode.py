"""Model matrix: category vocabulary, one-hot columns, signature, alignment."""

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo import schema

# A column with more categories than this gets no column per category: it is
# encoded by a vocabulary kept as a table (``sparse_matrix``).
MOST_CATEGORIES = 1_000

# The column types a signature may hold.
_SIGNATURE_TYPES = {"double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class SignatureColumn:
    """One column of a model's input. A one-hot column also names the source
    column and the category it stands for."""

    name: str
    type: str
    source: str | None = None
    category: str | None = None

    def __post_init__(self):
        if self.type not in _SIGNATURE_TYPES:
            raise ValueError(f"column {self.name}: type {self.type} is not in a signature")


Vocabulary = dict[str, list[str]]


def quoted(name: str) -> Column:
    """A column by its literal name, dots and hyphens included."""
    return F.col("`" + name.replace("`", "``") + "`")


def category_counts(df: DataFrame, columns=schema.CATEGORICAL_FEATURES) -> DataFrame:
    """Rows per category of each column, in one scan; NULL is no category."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(pairs).alias("pair"))
        .select("pair.column", "pair.value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary(df: DataFrame, columns=schema.CATEGORICAL_FEATURES) -> Vocabulary:
    """Categories of each column in code-point order.

    Only distinct values reach the driver, and no more than the limit: a column
    beyond it raises.
    """
    limit = MOST_CATEGORIES * len(columns)
    rows = category_counts(df, columns).select("column", "value").limit(limit + 1).collect()
    found: Vocabulary = {c: sorted(r.value for r in rows if r.column == c) for c in columns}
    for column, values in found.items():
        if len(values) > MOST_CATEGORIES or len(rows) > limit:
            raise ValueError(f"{column} has over {MOST_CATEGORIES} categories")
    return found


def vocabulary_table(df: DataFrame, columns=schema.CATEGORICAL_FEATURES) -> DataFrame:
    """Categories with their position and row count. The window runs over
    distinct categories, not rows."""
    by_column = Window.partitionBy("column").orderBy("value")
    position = F.row_number().over(by_column).cast("bigint") - 1
    return category_counts(df, columns).select(
        "column", position.alias("pos"), F.col("value"), F.col("n")
    )


def sparse_matrix(
    df: DataFrame,
    vocabulary: DataFrame,
    keep: list[str],
    columns=schema.CATEGORICAL_FEATURES,
    numeric=schema.NUMERIC_FEATURES,
) -> DataFrame:
    """Keep some columns and add ``features``, a sparse vector: the numeric
    columns, then one place per category of each column, by its position in the
    vocabulary table (``vocabulary_table``, written with the model).

    For any number of categories: the driver holds one number per column. A NULL
    category and one outside the vocabulary have no place set. NULL numbers
    become NaN.
    """
    sizes = {r.column: r.n for r in vocabulary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    coded = df.select(
        *[quoted(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
        *[quoted(c).cast("double").alias(f"_number_{i}") for i, c in enumerate(numeric)],
        *[quoted(c).alias(f"_value_{i}") for i, c in enumerate(columns)],
    )
    for i, column in enumerate(columns):
        # NULL meets nothing, so rows without a category needn't meet in one task.
        apart = F.concat(F.lit("\0"), F.xxhash64(*coded.columns).cast("string"))
        value = F.coalesce(f"_value_{i}", apart)
        positions = vocabulary.where(F.col("column") == column).select(
            F.col("value").alias("_met"), F.col("pos").cast("double").alias("_pos")
        )
        absent = F.lit(float(sizes.get(column, 0)))
        coded = (
            coded.join(positions, value == F.col("_met"), "left")
            .withColumn(f"_code_{i}", F.coalesce("_pos", absent))
            .drop("_met", "_pos", f"_value_{i}")
        )
    places = []
    for i, column in enumerate(columns):
        # The place behind the last category stands for none, and is dropped.
        names = {"ml_attr": {"type": "nominal", "name": f"_code_{i}", "num_vals": sizes.get(column, 0) + 1}}
        coded = coded.withMetadata(f"_code_{i}", names)
        places.append(f"_places_{i}")
    codes = [f"_code_{i}" for i in range(len(columns))]
    if codes:
        coded = OneHotEncoder(inputCols=codes, outputCols=places, dropLast=True).fit(coded).transform(coded)
    numbers = [f"_number_{i}" for i in range(len(numeric))]
    whole = VectorAssembler(inputCols=numbers + places, outputCol="features", handleInvalid="keep").transform(coded)
    return whole.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)], "features")


def matrix_signature(
    df: DataFrame, categories: Vocabulary, numeric=schema.NUMERIC_FEATURES
) -> list[SignatureColumn]:
    """Columns of the model matrix: the numeric ones in list order, then one
    boolean per category, per source column in code-point order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = {T.DoubleType(): "double", T.LongType(): "long", T.BooleanType(): "boolean"}
    columns = [SignatureColumn(c, names.get(types[c], types[c].simpleString())) for c in numeric]
    for source, values in categories.items():
        columns += [SignatureColumn(f"{source}_{v}", "boolean", source, v) for v in values]
    return columns


def signature_table(spark, model: str, version: int, signature: list[SignatureColumn]) -> DataFrame:
    rows = [
        (model, version, i, c.name, c.type, c.source, c.category) for i, c in enumerate(signature)
    ]
    return spark.createDataFrame(
        rows,
        "model string, version int, pos int, name string, type string,"
        " source string, category string",
    )


def one_hot(df: DataFrame, categories: Vocabulary, keep: list[str]) -> DataFrame:
    """Keep some columns and add a boolean per category. A NULL category and
    one outside the vocabulary leave every flag false."""
    flags = [
        _is_category(source, value).alias(f"{source}_{value}")
        for source, values in categories.items()
        for value in values
    ]
    return df.select(*[quoted(c) for c in keep], *flags)


def unseen_categories(df: DataFrame, categories: Vocabulary) -> DataFrame:
    """Rows per column whose category is not in the vocabulary; alignment
    gives these no flag without complaint."""
    sums = [
        F.count_if(quoted(c).isNotNull() & ~quoted(c).isin(values)).alias(c)
        for c, values in categories.items()
    ]
    return df.agg(*sums)


def align(
    df: DataFrame, signature: list[SignatureColumn], keep: list[str] | None = None
) -> DataFrame:
    """Fill, prune, order and cast the columns to the signature, in one
    projection.

    A one-hot column is taken as it is if present, else derived from its source
    column, else false. A missing numeric column raises. Columns outside the
    signature go, unless ``keep`` names them.
    """
    present = set(df.columns)
    columns = [quoted(c) for c in keep or []]
    for c in signature:
        if c.name in present:
            value = _checked_cast(quoted(c.name), c, df.schema[c.name].dataType)
        elif c.source is not None and c.source in present:
            value = _is_category(c.source, c.category)
        elif c.type == "boolean":
            value = F.lit(False)
        else:
            raise ValueError(f"column {c.name} of the signature is missing")
        columns.append(value.alias(c.name))
    return df.select(*columns)


def _is_category(source: str, value: str) -> Column:
    return F.coalesce(quoted(source) == F.lit(value), F.lit(False))


def _checked_cast(value: Column, column: SignatureColumn, found: T.DataType) -> Column:
    """Cast to the signature's type. NULL and NaN have no whole or boolean
    counterpart, so there they raise."""
    target = _SIGNATURE_TYPES[column.type]
    if column.type == "double":
        return value.cast(target)
    empty = value.isNull()
    if isinstance(found, (T.DoubleType, T.FloatType)):
        empty = empty | F.isnan(value)
    refused = F.raise_error(F.lit(f"column {column.name}: no value to cast to {column.type}"))
    return F.when(empty, refused.cast(target)).otherwise(value.cast(target))
