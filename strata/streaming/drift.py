"""JSON lines whose fields change over time: types inferred per batch, merged into the table's schema.

    field unknown to the table   added, with the type that all its values in the batch share
    field known, value fits      cast to the table's type
    field known, value unfit     the column is null, the raw value goes to ``_rescued``
    name that cannot be a column (differs in case only, or reserved by the table): ``_rescued``

``_rescued`` is a JSON object of raw field texts, null when everything fitted, so nothing that was
read is lost.  A value fits when its text survives the cast: ``1.5`` does not fit a bigint column, ``12`` does.
New fields: integers become bigint, other numbers double, true/false boolean, text and mixed
types string, objects and arrays string (their JSON).  A field that was null throughout waits
until a value shows its type.

Inference is one aggregation over (field name, type) pairs, combined before the shuffle; the driver
receives at most ``max_fields`` names, the most frequent first.  Rarer ones (ids used as field
names) stay in ``_rescued``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DoubleType, IntegerType, LongType, MapType, ShortType, StringType,
                               StructField, StructType)

from strata.spec import COMMIT, DELETED

RESCUED = "_rescued"
MAX_FIELDS = 1000
_TEXTS = "map<string,string>"
_KINDS = "map<string,variant>"
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_NUMBERS = {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}


def _type_of(kinds: set[str]) -> DataType:
    if kinds == {"BIGINT"}:
        return LongType()
    if kinds <= _NUMBERS:
        return DoubleType()
    if kinds == {"BOOLEAN"}:
        return BooleanType()
    return StringType()


def infer(lines: DataFrame, known: StructType, max_fields: int = MAX_FIELDS) -> StructType:
    """``known`` and the fields that lines (column ``value``) bring beyond it."""
    taken = {f.name.lower() for f in known.fields} | {c.lower() for c in (COMMIT, DELETED, RESCUED, "_bucket", "_v")}
    pairs = lines.select(F.explode(F.from_json("value", _KINDS)).alias("name", "content")).where(~F.lower("name").isin(*taken))
    kind = F.regexp_extract(F.schema_of_variant("content"), "^[A-Z]+", 0)
    counted = pairs.select("name", kind.alias("kind")).where("kind NOT IN ('', 'VOID')").groupBy("name", "kind").count()
    per_name = counted.groupBy("name").agg(F.collect_set("kind").alias("kinds"), F.sum("count").alias("n"))
    room = max(0, max_fields - len(known.fields))
    fields = list(known.fields)
    for r in per_name.orderBy(F.desc("n"), "name").limit(room).collect():
        if r.name and r.name.lower() not in taken:
            taken.add(r.name.lower())
            fields.append(StructField(r.name, _type_of(set(r.kinds)), True))
    return StructType(fields)


def _fitted(text: Column, kind: DataType) -> tuple[Column, Column]:
    """(the value, whether the text survives the cast)."""
    if isinstance(kind, StringType):
        return text, F.lit(True)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        value = F.from_json(text, kind)
    else:
        value = text.try_cast(kind)
    if isinstance(kind, _INTEGRAL):
        return F.when(value.cast("string") == text, value), F.coalesce(value.cast("string") == text, F.lit(False))
    if isinstance(kind, BooleanType):
        return F.when(text.isin("true", "false"), value), text.isin("true", "false")
    return value, value.isNotNull()


def conform(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines (column ``value``) -> the columns of ``schema``, ``_rescued`` and ``_line`` (the text of a line
    that is no JSON object, else null).  Blank lines are no rows."""
    rows = lines.where(F.trim("value") != "").select("value", F.from_json("value", _TEXTS).alias("_texts"))
    columns, fits = [], []
    for f in schema.fields:
        text = F.element_at("_texts", F.lit(f.name))
        value, fit = _fitted(text, f.dataType)
        columns.append(value.alias(f.name))
        fits.append((f.name, text.isNull() | fit))
    rows = rows.select("value", "_texts", *columns, F.array(*[F.when(~fit, F.lit(name)) for name, fit in fits]).alias("_unfit"))
    names = [f.name for f in schema.fields]
    left = F.map_filter("_texts", lambda k, v: v.isNotNull() & (~k.isin(*names) | F.array_contains("_unfit", k)))
    return rows.select(*[F.col(f"`{n}`") for n in names], F.when(F.size(left) > 0, F.to_json(left)).alias(RESCUED),
                       F.when(F.col("_texts").isNull(), F.col("value")).alias("_line"))
