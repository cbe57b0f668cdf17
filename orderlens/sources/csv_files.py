"""CSV loading with declared types.

Files are read as text, missing-value tokens become null, and each declared column is
converted to its type. Text that does not convert exactly stops the load: bad data never
turns into null and a number is never rounded to fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts read as "missing", the default list of pandas.read_csv.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Wide enough to tell 12.0, a valid id, from 12.5.
_EXACT = T.DecimalType(38, 18)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    require_all: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """All columns of the file, those in ``schema`` typed, the others as text.

    ``path`` is a file or a directory of files with the same header. Columns of ``schema``
    must be present unless ``require_all`` is off. Rows with too few or too many fields
    stop the load. ``multi_line`` admits line breaks inside quoted fields, at the price
    that a file can no longer be split between tasks.
    """
    text = spark.read.csv(
        path,
        sep=sep,
        header=True,
        encoding="UTF-8",
        quote='"',
        escape='"',
        mode="FAILFAST",
        enforceSchema=False,
        multiLine=multi_line,
    )
    absent = [name for name in schema.names if name not in text.columns]
    if absent and require_all:
        raise ValueError(f"{path}: missing columns {', '.join(absent)}")
    text = text.select([_or_missing(name) for name in text.columns])
    types = {field.name: field.dataType for field in schema}
    return text.select(
        [_typed(name, types.get(name, T.StringType())).alias(name) for name in text.columns]
    )


def _or_missing(name: str) -> Column:
    column = F.col(f"`{name}`")
    return F.when(~column.isin(*MISSING), column).alias(name)


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        value = _number(text, kind)
    else:
        value = text.try_cast(kind)
    problem = F.concat(F.lit(f"column {name}: '"), text, F.lit(f"' is not {kind.simpleString()}"))
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(problem)))


def _number(text: Column, kind: T.DataType) -> Column:
    """The exact value as ``kind``, null where the text is no number or does not fit."""
    exact = text.try_cast(_EXACT)
    narrowed = exact.try_cast(kind)
    lossless = F.when(narrowed == exact, narrowed)
    if isinstance(kind, T.IntegralType):
        return F.coalesce(text.try_cast(kind), lossless)
    # Plain text with few enough decimals cannot be rounded: spare it the wide parse.
    dot = F.instr(text, ".")
    plain = (dot == 0) | (F.length(text) - dot <= kind.scale)
    exponent = text.contains("e") | text.contains("E")
    return F.when(plain & ~exponent, text.try_cast(kind)).otherwise(lossless)
