"""Comma separated lines to typed rows, and the lines that cannot be typed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadstream import schemas

# Spellings of non-finite numbers that are accepted, all others with the
# same letters are not.
_NON_FINITE = ["NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity"]
_NON_FINITE_ANY_CASE = [
    sign + word for sign in ("", "+", "-") for word in ("nan", "inf", "infinity")
]


def _typed(text: Column, kind: T.DataType) -> Column:
    """The field's value, or null where the text is no number of that kind."""
    if isinstance(kind, T.LongType):
        # A whole number is written without surrounding blanks.
        return F.when(text == F.trim(text), text.try_cast("bigint"))
    if isinstance(kind, T.DoubleType):
        word = F.trim(text)
        odd = F.lower(word).isin(_NON_FINITE_ANY_CASE) & ~word.isin(_NON_FINITE)
        return F.when(~odd, text.try_cast("double"))
    return text


def _examined(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The line, its fields by name and ``reason``: null, empty, short or bad_number."""
    # Empty fields at the end of a line do not count as fields.
    parts = F.split(F.rtrim(F.col("value"), F.lit(",")), ",")
    # A generator is not merged with the filter above it, so a line is split once.
    split_once = F.explode(F.array(parts)).alias("_parts")
    typed = lines.select("value", split_once).select(
        "value",
        F.size("_parts").alias("_n"),
        *[
            _typed(F.get("_parts", F.lit(i)), f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        ],
    )
    numbers = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    bad = F.lit(False)
    for name in numbers:
        bad = bad | F.col(name).isNull()
    reason = (
        F.when(F.coalesce(F.col("value"), F.lit("")) == "", "empty")
        .when(F.col("_n") < len(schema.fields), "short")
        .when(bad, "bad_number")
    )
    return typed.withColumn("reason", reason)


def _parse(lines: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    examined = _examined(lines, schema)
    ok = F.col("reason").isNull()
    if strict:
        message = F.concat_ws(": ", "reason", "value")
        ok = F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return examined.where(ok).select(*schema.fieldNames())


def parse_passages(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Passages from lines of seven fields in column ``value``; more fields are ignored.

    ``strict`` fails the query on the first line that is no passage; otherwise such lines
    are left out, and ``quality_split`` returns them.
    """
    return _parse(lines, schemas.PASSAGE, strict)


def parse_police_actions(lines: DataFrame, strict: bool = False) -> DataFrame:
    return _parse(lines, schemas.POLICE_ACTION, strict)


def parse_violations(lines: DataFrame, strict: bool = False) -> DataFrame:
    return _parse(lines, schemas.VIOLATION, strict)


def classified(lines: DataFrame, schema: T.StructType = schemas.PASSAGE) -> DataFrame:
    """Every line with its ``kind``, ``ok`` or the reason of its rejection, and the fields of
    ``schema``, which are null unless it is ok: good and bad lines of one pass."""
    examined = _examined(lines, schema)
    ok = F.col("reason").isNull()
    fields = [F.when(ok, F.col(c)).alias(c) for c in schema.fieldNames()]
    return examined.select("value", F.coalesce("reason", F.lit("ok")).alias("kind"), *fields)


#: What ``classified`` tells apart.
KINDS = ("ok", "empty", "short", "bad_number")


def quality_split(
    lines: DataFrame, schema: T.StructType = schemas.PASSAGE
) -> tuple[DataFrame, DataFrame]:
    """Good rows of ``schema``, and rejected lines as (value, reason)."""
    rejects = _examined(lines, schema).where(F.col("reason").isNotNull())
    return _parse(lines, schema, strict=False), rejects.select("value", "reason")
