"""Schemas of JSON documents nobody declared, found by an aggregate over all of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.sources.tables import staged

# Families of JSON types: whole numbers and fractions are both numbers.
LONG, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, NULL = (
    "long", "double", "string", "boolean", "object", "array", "null",
)
# Documents nest no deeper than this, or inference raises.
MOST_LEVELS = 32
_TYPES = {LONG: T.LongType(), DOUBLE: T.DoubleType(), STRING: T.StringType(), BOOLEAN: T.BooleanType()}
#: Stands for the elements of an array in a path.
STEP = "[]"
CORRUPT = "corrupt"
_FRACTION = r"DECIMAL\(\d+,\d+\)|FLOAT"
_TOO_DEEP = f"documents nest deeper than {MOST_LEVELS} levels"


def _family(shape: Column) -> Column:
    """The family that a shape, as of ``schema_of_variant``, belongs to."""
    return (
        F.when(shape.isNull(), CORRUPT)
        .when(shape == "BIGINT", LONG)
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), DOUBLE)
        .when(shape.startswith("OBJECT"), OBJECT)
        .when(shape.startswith("ARRAY"), ARRAY)
        .when(shape == "VOID", NULL)
        .when(shape == "BOOLEAN", BOOLEAN)
        .otherwise(STRING)
    )


def json_fields(documents: DataFrame, text: str) -> DataFrame:
    """One row per path of the documents: how many values of each family it has,
    the type that holds them all, and whether they conflict.

    A path is an array of names, ``[]`` for the elements of an array; the document
    is the empty path, and text that is no JSON counts there as ``n_corrupt``. Counts
    of two sets of documents add up, so the aggregate combines on the map side
    and the schema of more documents needs the new ones only (``merged_fields``).
    Whole numbers and fractions make doubles; other mixtures conflict and are
    kept as text. Values of equal shape are counted before they are taken apart, so
    there is a row for each shape and not for each value. A shape does not tell how
    many elements an array has, so values with arrays are taken apart one level at
    a time, until no level holds any.
    """
    parsed = documents.select(F.try_parse_json(F.col(text)).alias("value"))
    level = parsed.select(F.array().cast("array<string>").alias("path"), "value")
    shape = F.regexp_replace(F.schema_of_variant("value"), _FRACTION, "DOUBLE")
    shapes = None
    for _ in range(MOST_LEVELS):
        shaped = level.withColumn("shape", shape)
        # Quoted names could look like types.
        shaped = shaped.withColumn("apart", F.coalesce(F.col("shape").rlike("ARRAY<|`"), F.lit(False)))
        known = F.when(F.col("apart"), _family(F.col("shape"))).otherwise(F.col("shape"))
        counted = staged(
            shaped.groupBy("path", "apart", known.alias("shape")).agg(F.count(F.lit(1)).alias("n")), "shapes"
        )
        shapes = counted if shapes is None else shapes.unionByName(counted)
        if counted.where("apart").isEmpty():
            return _fields(_counts_of(shapes))
        level = _members(shaped.where("apart"), "path")
    raise ValueError(_TOO_DEEP)


def _counts_of(shapes: DataFrame) -> DataFrame:
    """(path, family, n) of the values with a shape and of all values inside. Values
    that were taken apart come with their family only."""
    written = F.regexp_replace("shape", r"\b([A-Z]+)(?=[,>]|$)", '"$1"')
    written = F.regexp_replace(written, r"(\w+): ", '"$1": ')
    written = F.regexp_replace(F.regexp_replace(written, "OBJECT<", "{"), ">", "}")
    counts = shapes.where("apart").select("path", F.col("shape").alias("family"), "n")
    level = shapes.where("NOT apart").select("path", "n", F.parse_json(written).alias("value"))
    for _ in range(MOST_LEVELS):
        leaf = F.try_variant_get("value", "$", "string")
        is_object = F.schema_of_variant("value").startswith("OBJECT")
        typed = level.withColumn("family", F.when(is_object, OBJECT).otherwise(_family(leaf)))
        found = typed.groupBy("path", "family").agg(F.sum("n").alias("n"))
        counts = counts.unionByName(found)
        deepest = F.size("path") >= MOST_LEVELS - 1
        nested = typed.where("family = 'object'")
        if not counts.where(deepest & F.col("family").isin(OBJECT, ARRAY)).isEmpty():
            raise ValueError(_TOO_DEEP)
        if nested.isEmpty():
            break
        level = staged(_members(nested, "path", "n"), "members")
    return counts


def _members(values: DataFrame, *columns: str) -> DataFrame:
    """What objects and arrays hold, under their paths, with other columns."""
    whole = values.select(*columns, F.col("value").alias("whole"))
    members = whole.lateralJoin(values.sparkSession.tvf.variant_explode(F.col("whole").outer()))
    path = F.array_append("path", F.coalesce("key", F.lit(STEP))).alias("path")
    return members.select(path, "value", *[c for c in columns if c != "path"])


def _fields(counts: DataFrame) -> DataFrame:
    kinds = (LONG, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, NULL, CORRUPT)
    sums = [F.coalesce(F.sum(F.when(F.col("family") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in kinds]
    return _judged(counts.groupBy("path").agg(*sums))


def merged_fields(one: DataFrame, other: DataFrame) -> DataFrame:
    """The fields of two sets of documents together."""
    numbers = [c for c in one.columns if c.startswith("n_")]
    both = one.select("path", *numbers).unionByName(other.select("path", *numbers))
    return _judged(both.groupBy("path").agg(*[F.sum(c).alias(c) for c in numbers]))


def _judged(fields: DataFrame) -> DataFrame:
    has = {k: F.col(f"n_{k}") > 0 for k in (LONG, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY)}
    numbers = has[LONG] | has[DOUBLE]
    others = [has[k].cast("int") for k in (STRING, BOOLEAN, OBJECT, ARRAY)]
    kinds = sum(others, numbers.cast("int"))
    only = F.when(has[DOUBLE], DOUBLE).when(has[LONG], LONG)
    for kind in (BOOLEAN, OBJECT, ARRAY):
        only = only.when(has[kind], kind)
    return fields.withColumns(
        {"type": F.when(kinds > 1, STRING).otherwise(only.otherwise(STRING)), "conflict": kinds > 1}
    )


def inferred_schema(fields: DataFrame) -> T.StructType:
    """The schema to read the documents with: one row per path reaches the driver.
    Fields are in the order of their names."""
    types = {tuple(r.path): r.type for r in fields.select("path", "type").collect()}

    def below(path: tuple[str, ...]) -> T.DataType:
        kind = types.get(path, STRING)
        if kind == ARRAY:
            return T.ArrayType(below((*path, STEP)))
        if kind != OBJECT:
            return _TYPES[kind]
        names = sorted(p[-1] for p in types if len(p) == len(path) + 1 and p[:-1] == path)
        return T.StructType([T.StructField(n, below((*path, n))) for n in names])

    found = below(())
    if not isinstance(found, T.StructType):
        raise ValueError("the documents are no objects")
    return found
