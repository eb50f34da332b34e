"""Rows to JSON messages and back. The same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.functions.text import literal, name, parse_ts, with_columns
from txnrisk.schemas import RAW_FIELDS, TS_FORMAT, message_schema

CORRUPT = "_corrupt_record"
WIRE = {f.name: f.wire for f in RAW_FIELDS}
NAME = {f.wire: f.name for f in RAW_FIELDS}


def encode(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Key and JSON value per row, under the wire names. Null fields are left out."""
    fields = ", ".join(f"{literal(WIRE.get(c, c))}, {name(c)}" for c in df.columns)
    options = f"map('timestampFormat', {literal(TS_FORMAT)})"
    value = f"to_json(named_struct({fields}), {options})"
    return df.selectExpr(f"cast({name(key)} AS string) AS key", f"{value} AS value")


def _fields(schema: T.StructType) -> list[str]:
    """The fields of ``data`` under our names."""
    return [f"data.{name(f.name)} AS {name(NAME.get(f.name, f.name))}" for f in schema.fields]


def decode(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """JSON values to columns under our names; fields that are missing become null.

    ``_corrupt_record`` holds the text of a value that is no JSON object of this
    schema, or that has a field of the wrong type; for a null value it is empty. It is null otherwise.
    """
    schema = schema or message_schema()
    parsed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    whole = F.col(value).cast("string")
    data = df.select(F.from_json(whole, parsed, options).alias("data"), whole.alias("whole"))
    # A blank value parses to nothing at all.
    # A null value is no message either: it is kept apart as an empty text.
    corrupt = f"coalesce(data.{name(CORRUPT)}, if(data IS NULL, coalesce(whole, ''), NULL))"
    return data.selectExpr(*_fields(schema), f"{corrupt} AS {name(CORRUPT)}")


def explode_array(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """Values that hold a JSON array of objects (or one object) to one row per object.

    Objects that do not decode are left out: ``array_rejects`` has them.
    """
    return accepted(array_items(df, schema, value))


def array_items(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """The decoded objects of the arrays, good and bad. A value that is no array is one object.

    An item that is null decodes to nothing and is bad, as a null value is.
    """
    whole = F.col(value).cast("string")
    items = F.when(whole.rlike(r"^\s*\["), F.from_json(whole, "array<string>"))
    items = F.coalesce(items, F.array(whole))
    return decode(df.select(F.explode(items).alias(value)), schema or message_schema(with_label=True), value)


def array_rejects(df: DataFrame, schema: T.StructType | None = None, value: str = "value") -> DataFrame:
    """What ``explode_array`` leaves out: values that are no JSON, and objects that do not decode."""
    return rejected(array_items(df, schema, value))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(decoded: DataFrame) -> DataFrame:
    """Values that did not decode, with the reason."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("value"), F.lit("malformed message").alias("reason")
    )


def type_message(df: DataFrame, flags: Sequence[str] | None = None) -> DataFrame:
    """Message types to stored types: text flags to int, text time to timestamp, money to decimal."""
    known = {f.name: f for f in RAW_FIELDS}
    flags = flags or [f.name for f in RAW_FIELDS if f.stored == "int" and f.message == "string"]
    changes = {}
    for c in df.columns:
        field = known.get(c)
        if field is None or field.stored == "string":
            continue
        if field.stored == "timestamp":
            changes[c] = parse_ts(c)
        elif c in flags:
            words = f"CASE lower({name(c)}) WHEN 'yes' THEN 1 WHEN 'true' THEN 1 WHEN 'no' THEN 0 WHEN 'false' THEN 0 END"
            changes[c] = f"coalesce(try_cast({name(c)} AS int), {words})"
        else:
            changes[c] = f"try_cast({name(c)} AS {field.stored})"
    return with_columns(df, changes)


# Messages whose fields are not known beforehand ----------------------------------


def variants(df: DataFrame, value: str = "value") -> DataFrame:
    """``value`` and ``object``: each object of a message as a variant; null where the text holds none.

    An array gives one row for each item. What is no JSON, and items that are no objects, keep their text.
    """
    whole = F.col(value).cast("string")
    parsed = df.select(whole.alias("value"), F.try_parse_json(whole).alias("v"))
    kind = F.schema_of_variant("v")
    items = F.when(kind.startswith("ARRAY"), F.from_json("value", "array<string>"))
    parsed = parsed.select(F.explode(F.coalesce(items, F.array("value"))).alias("value"))
    parsed = parsed.select(F.coalesce("value", F.lit("")).alias("value"), F.try_parse_json("value").alias("v"))
    return parsed.select("value", F.when(kind.startswith("OBJECT"), F.col("v")).alias("object"))


def inferred_schema(objects: DataFrame) -> T.StructType:
    """The fields of all objects, over the whole table, by name.

    Whole numbers of any width are bigint, a field with several widths or scales of numbers double, one with
    texts and other values, or with nothing but nulls, string. Nested values are kept as their JSON text. One
    text with the schema comes to the driver.
    """
    merged = objects.where("object IS NOT NULL").agg(F.schema_of_variant_agg("object").alias("s")).first()["s"]
    out = T.StructType()
    for field, kind in sorted(variant_fields(merged or "")):
        if kind in ("BIGINT", "BOOLEAN"):
            out.add(field, kind.lower())
        elif kind.startswith(("DECIMAL", "DOUBLE", "FLOAT")):
            out.add(field, "double")
        else:
            out.add(field, "string")
    return out


def variant_fields(schema: str) -> list[tuple[str, str]]:
    """Names and types of ``OBJECT<name: TYPE, ...>``; names in back quotes may hold any character."""
    if not schema.startswith("OBJECT<"):
        return []
    out, depth, quoted, start = [], 0, False, len("OBJECT<")
    for at in range(start, len(schema)):
        c = schema[at]
        if c == "`":
            quoted = not quoted
        elif quoted:
            continue
        elif c in "<(":
            depth += 1
        elif depth == 0 and c in ",>":
            if part := schema[start:at].strip():
                end = part.rindex("`") + 1 if part.startswith("`") else part.index(":")
                field = part[:end].strip()
                field = field[1:-1].replace("``", "`") if field.startswith("`") else field
                out.append((field, part[part.index(":", end) + 1 :].strip()))
            start = at + 1
        elif c in ">)":
            depth -= 1
    return out


def decode_inferred(objects: DataFrame, schema: T.StructType) -> DataFrame:
    """The objects' fields as columns, under our names where we have one, and ``_corrupt_record``.

    A field that is missing, or whose value does not fit its type, is null.
    """
    fields = []
    for f in schema.fields:
        path = f"$['{f.name}']" if '"' in f.name else f'$["{f.name}"]'
        fields.append(f"try_variant_get(object, {literal(path)}, {literal(f.dataType.simpleString())}) AS {name(NAME.get(f.name, f.name))}")
    return objects.selectExpr(*fields, f"if(object IS NULL, value, NULL) AS {name(CORRUPT)}")
