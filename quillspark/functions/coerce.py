"""Records to typed documents: projection, parsing by field type, and a per-field report.

A null is an absent value and is never an error. ``strict`` stops the batch at the first bad value;
``permissive`` splits bad rows off as a reject table. All of it is one narrow pass over the rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.errors import MappingError
from quillspark.functions.values import FLOAT, IPV4, RFC3339, SIGNED, UNSIGNED, ipv4_key
from quillspark.mapping import Field, Mapping

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def project(records: DataFrame, mapping: Mapping) -> DataFrame:
    """Keep the key and the mapped fields; a mapped column the records lack becomes null."""
    if mapping.key not in records.columns:
        raise MappingError(f"key column not found: {mapping.key}")
    return records.select(
        mapping.key,
        *[F.col(n) if n in records.columns else F.lit(None).alias(n) for n in mapping.names],
    )


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _TIMES):
        return F.date_format(value.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(kind, _NESTED):
        return F.to_json(value)
    return value.cast("string")


def parsed(field: Field, value: Column, kind: T.DataType) -> Column:
    """The value as the field's Spark type, null when it does not parse."""
    text = _as_text(value, kind)
    match field.type:
        case "text" | "string":
            return text
        case "u64":
            if field.wide:
                number = text.try_cast("decimal(38,0)")
                return F.when(text.rlike(UNSIGNED) & (number < F.lit(Decimal(2**64))), number)
            return F.when(text.rlike(UNSIGNED), text.try_cast("bigint"))
        case "i64":
            return F.when(text.rlike(SIGNED), text.try_cast("bigint"))
        case "f64":
            if isinstance(kind, T.NumericType):
                return value.cast("double")
            return F.when(text.rlike(FLOAT), text.try_cast("double"))
        case "bool":
            return F.when(text.isin("true", "false"), text == "true")
        case "date":
            if isinstance(kind, _TIMES):
                return F.date_trunc("second", value.cast("timestamp"))
            stamp = F.regexp_replace(F.upper(text), " ", "T").try_cast("timestamp")
            return F.when(text.rlike(RFC3339), F.date_trunc("second", stamp))
        case "bytes":
            return value if isinstance(kind, T.BinaryType) else F.encode(text, "UTF-8")
        case "json":
            return value if isinstance(kind, T.VariantType) else F.try_parse_json(text)
        case "ip_addr":
            return F.when(text.rlike(IPV4), ipv4_key(text))
        case "facet":
            return F.when(text.startswith("/"), text)
    raise MappingError(f"invalid field type: {field.type}")


def _typed_columns(records: DataFrame, mapping: Mapping) -> list[tuple[Field, Column, Column]]:
    kinds = {f.name: f.dataType for f in records.schema.fields}
    found = []
    for f in mapping.fields:
        value = F.col(f"`{f.name}`")
        kind = kinds[f.name]
        typed = F.lit(None) if isinstance(kind, T.NullType) else parsed(f, value, kind)
        found.append((f, value, typed.cast(f.spark_type)))
    return found


def coerce(records: DataFrame, mapping: Mapping) -> DataFrame:
    """Typed documents; any value that does not parse fails the whole batch."""
    records = project(records, mapping)
    columns = [F.col(mapping.key)]
    for f, value, typed in _typed_columns(records, mapping):
        message = F.concat(F.lit("cannot parse '"), value.try_cast("string"), F.lit(f"' as {f.type} for field {f.name}"))
        if f.type not in ("text", "string"):
            typed = F.when(value.isNull() | typed.isNotNull(), typed).otherwise(F.raise_error(message).cast(f.spark_type))
        columns.append(typed.alias(f.name))
    return records.select(*columns)


def coerce_permissive(records: DataFrame, mapping: Mapping) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)``: good rows typed, bad rows as they came plus ``_errors``."""
    records = project(records, mapping)
    typed = _typed_columns(records, mapping)
    errors = F.array_compact(
        F.array(
            *[
                F.when(value.isNotNull() & col.isNull(), F.lit(f"cannot parse {f.name} as {f.type}"))
                for f, value, col in typed
            ]
        )
    )
    marked = records.withColumn("_errors", errors)
    good = marked.filter(F.size("_errors") == 0).select(mapping.key, *[c.alias(f.name) for f, _, c in typed])
    return good, marked.filter(F.size("_errors") > 0)


def conform_report(records: DataFrame, mapping: Mapping) -> DataFrame:
    """Present, missing and unparsable values of every mapped field, counted in one pass."""
    records = project(records, mapping)
    typed = _typed_columns(records, mapping)
    counts = records.agg(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("field"),
                    F.lit(f.type).alias("type"),
                    F.count(value).alias("present"),
                    F.count_if(value.isNull()).alias("missing"),
                    F.count_if(value.isNotNull() & col.isNull()).alias("unparsable"),
                )
                for f, value, col in typed
            ]
        ).alias("report")
    )
    return counts.select(F.inline("report"))
