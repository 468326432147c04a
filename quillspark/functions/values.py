"""Typed values: addresses, facet paths and dates, as columns and as driver-side literals."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.errors import QueryError

# The accepted spellings of each type.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
UNSIGNED = r"^\+?[0-9]+$"
SIGNED = r"^[+-]?[0-9]+$"
FLOAT = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))$"


def ipv4_key(address: Column) -> Column:
    """IPv4 text to its 32-bit number, null when it is not an IPv4 address."""
    part = F.split(address, r"\.")
    number = sum((part[i].cast("bigint") * (256 ** (3 - i)) for i in range(1, 4)), part[0].cast("bigint") * 256**3)
    return F.when(address.rlike(IPV4), number)


def ipv4_text(key: Column) -> Column:
    """The 32-bit number back to dotted text."""
    return F.concat_ws(".", *[F.pmod(F.shiftright(key, 8 * i), F.lit(256)).cast("string") for i in (3, 2, 1, 0)])


def ipv4_literal(address: str) -> int:
    if not re.match(IPV4, address):
        raise QueryError(f"cannot parse '{address}' as IP address")
    a, b, c, d = (int(p) for p in address.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def facet_ancestors(path: Column) -> Column:
    """``/a/b/c`` to ``[/a, /a/b, /a/b/c]``."""
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(steps, lambda s, i: F.concat(F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i + 1), "/")))


def date_literal(value) -> dt.datetime:
    """RFC 3339 text (or an aware datetime) to a UTC datetime of whole seconds."""
    if isinstance(value, dt.datetime):
        parsed = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    else:
        if not re.match(RFC3339, str(value)):
            raise QueryError(f"cannot parse '{value}' as date")
        parsed = dt.datetime.fromisoformat(str(value).upper().replace("Z", "+00:00"))
    return parsed.astimezone(dt.timezone.utc).replace(microsecond=0)


def typed_literal(field_type: str, value) -> Column:
    """A query value parsed by the field's type; raises ``QueryError`` when it does not parse."""
    text = str(value).lower() if isinstance(value, bool) else str(value)
    bad = QueryError(f"cannot parse '{value}' as {field_type}")
    if field_type in ("u64", "i64"):
        if not re.match(UNSIGNED if field_type == "u64" else SIGNED, text):
            raise bad
        if not -(2**63) <= int(text) < 2 ** (63 if field_type == "i64" else 64):
            raise bad
        return F.lit(int(text)).cast("bigint") if int(text) < 2**63 else F.lit(Decimal(text))
    if field_type == "f64":
        if not re.match(FLOAT, text):
            raise bad
        return F.lit(float(text))
    if field_type == "bool":
        if text not in ("true", "false"):
            raise bad
        return F.lit(text == "true")
    if field_type == "date":
        return F.timestamp_seconds(F.lit(int(date_literal(value).timestamp())))
    if field_type == "bytes":
        return F.lit(bytes(value) if isinstance(value, (bytes, bytearray)) else text.encode())
    if field_type == "ip_addr":
        return F.lit(ipv4_literal(text)).cast("bigint")
    raise QueryError(f"term queries not supported for fields of type {field_type}")
