"""Reading the JSON claim detail."""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal
from functools import partial, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import schemas

_BROKEN = "_broken"


def parse_detail(column: str = "claim_detail", schema: str = schemas.CLAIM_DETAIL) -> Column:
    return F.from_json(F.col(column), schema)


def detail_parses(column: str = "claim_detail") -> Column:
    """Whether the text is one JSON object. Malformed text does not make from_json null, so the broken-record field is asked."""
    schema = f"struct<edi_source:string, {_BROKEN}:string>"
    parsed = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": _BROKEN})
    return F.coalesce(parsed.isNotNull() & parsed[_BROKEN].isNull(), F.lit(False))


def detail_has_source(column: str = "claim_detail") -> Column:
    return F.get_json_object(F.col(column), "$.edi_source").isNotNull()


def has_cob_text(column: str = "claim_detail") -> Column:
    """The coordination-of-benefits flag as the text it has in the JSON."""
    return F.get_json_object(F.col(column), "$.adjudication.coordination_of_benefits")


def cob_payer(column: str = "claim_detail") -> Column:
    return F.get_json_object(F.col(column), "$.adjudication.cob_payer")


def _all(tests: list[Column]) -> Column:
    return reduce(Column.__and__, tests, F.lit(True))


def _some(items: Column, holds: Callable[[Column], Column]) -> Column:
    return F.exists(items, lambda item: F.coalesce(holds(item), F.lit(False)))


_NUMBERS = (T.IntegralType, T.FractionalType)


def _struct_holds(field: Column, kind: T.DataType, pattern: object) -> Column:
    if isinstance(pattern, dict):
        if not isinstance(kind, T.StructType):
            return F.lit(False)
        known = {f.name: f.dataType for f in kind.fields}
        inner = [_struct_holds(field.getField(k), known[k], v) if k in known else F.lit(False) for k, v in pattern.items()]
        return field.isNotNull() & _all(inner)
    if isinstance(pattern, list):
        if not isinstance(kind, T.ArrayType):
            return F.lit(False)
        inner = [_some(field, partial(_struct_holds, kind=kind.elementType, pattern=p)) for p in pattern]
        return field.isNotNull() & _all(inner)
    if pattern is None:
        return field.isNull()
    of_kind = T.BooleanType if isinstance(pattern, bool) else T.StringType if isinstance(pattern, str) else _NUMBERS
    return field.eqNullSafe(F.lit(pattern)) if isinstance(kind, of_kind) else F.lit(False)


def json_contains(parsed: Column, pattern: dict, schema: str = schemas.CLAIM_DETAIL) -> Column:
    """JSON containment on a struct parsed with ``schema``: objects hold what the pattern's objects hold, every element of a list in
    the pattern is contained in some element of the array there, scalars are equal and of one type.

    A field that the schema does not have is never there. A parsed struct does not tell a null from a missing field: None in a
    pattern matches both; ``variant_contains`` tells them apart.
    """
    return F.coalesce(_struct_holds(parsed, T.DataType.fromDDL(schema), pattern), F.lit(False))


_PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_NUMBER_KINDS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def variant_field(value: Column, key: str) -> Column:
    """The value under a key of a VARIANT object; null if it is not there."""
    if _PLAIN_KEY.fullmatch(key):
        return F.try_variant_get(value, f"$.{key}", "variant")
    return F.try_variant_get(value, "$", "map<string,variant>")[key]


def _variant_holds(value: Column, pattern: object) -> Column:
    if isinstance(pattern, dict):
        if not pattern:
            return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
        return _all([_variant_holds(variant_field(value, k), v) for k, v in pattern.items()])
    if isinstance(pattern, list):
        items = F.try_variant_get(value, "$", "array<variant>")
        inner = [_some(items, partial(_variant_holds, pattern=p)) for p in pattern]
        return items.isNotNull() & _all(inner)
    if pattern is None:
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    kind = F.schema_of_variant(value)
    if isinstance(pattern, bool):
        return (F.try_variant_get(value, "$", "boolean") == F.lit(pattern)) & (kind == "BOOLEAN")
    if isinstance(pattern, str):
        return (F.try_variant_get(value, "$", "string") == F.lit(pattern)) & (kind == "STRING")
    exact = Decimal(str(pattern))
    fits = abs(exact) < 10**19 and exact.normalize().as_tuple().exponent >= -18
    got, asked = ("decimal(38,18)", F.lit(exact).cast("decimal(38,18)")) if fits else ("double", F.lit(float(pattern)))
    return (F.try_variant_get(value, "$", got) == asked) & kind.rlike(_NUMBER_KINDS)


def variant_contains(value: Column, pattern: dict | list) -> Column:
    """JSON containment on a VARIANT, for any pattern and with no schema: objects within objects, each element of a list in some
    element of the array there, in any order; numbers by value, everything else by type and value. What is not there is
    not contained; null is contained in null only. Numbers are compared to 18 decimals where these suffice for the pattern."""
    return F.coalesce(_variant_holds(value, pattern), F.lit(False))
