"""Schema comparison: drift reports and backward-compatibility rules.

``schema_diff(old, new)`` lists added / removed / retyped columns.
``is_backward_compatible(old, new)``: readers of the new schema can read
data written with the old one — a column may be added only if nullable;
dropping or retyping a column is rejected (the registry's BACKWARD rule).
"""

from __future__ import annotations

from pyspark.sql import types as T


def schema_diff(old: T.StructType, new: T.StructType) -> list[dict]:
    o = {f.name: f for f in old.fields}
    n = {f.name: f for f in new.fields}
    out = []
    for name, f in n.items():
        if name not in o:
            out.append({"column_name": name, "change": "missing_in_warehouse",
                        "old_type": None, "new_type": f.dataType.simpleString(), "nullable": f.nullable})
        elif o[name].dataType != f.dataType:
            out.append({"column_name": name, "change": "retyped", "old_type": o[name].dataType.simpleString(),
                        "new_type": f.dataType.simpleString(), "nullable": f.nullable})
    for name, f in o.items():
        if name not in n:
            out.append({"column_name": name, "change": "missing_in_source",
                        "old_type": f.dataType.simpleString(), "new_type": None, "nullable": f.nullable})
    return out


def is_backward_compatible(old: T.StructType, new: T.StructType) -> tuple[bool, list[str]]:
    reasons = []
    for d in schema_diff(old, new):
        if d["change"] == "missing_in_warehouse" and not d["nullable"]:
            reasons.append(f"added non-nullable column {d['column_name']}")
        elif d["change"] == "retyped":
            reasons.append(f"retyped {d['column_name']}: {d['old_type']} -> {d['new_type']}")
        elif d["change"] == "missing_in_source":
            reasons.append(f"dropped column {d['column_name']}")
    return (not reasons), reasons


#: Exact whole-number types by size; each holds all values of those before it.
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Decimal digits that hold every value of a whole-number type.
_DIGITS = dict(zip(map(str, _WHOLE), (3, 5, 10, 19), strict=True))
#: Whole-number types whose every value a floating type holds.
_EXACT = {str(T.FloatType()): _WHOLE[:2], str(T.DoubleType()): _WHOLE[:3]}


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    """Whether ``new`` holds every value of ``old`` unchanged."""
    if old == new or isinstance(old, T.NullType):
        return True
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE.index(old) < _WHOLE.index(new)
    if isinstance(new, T.DecimalType):
        whole = _DIGITS.get(str(old), None) if not isinstance(old, T.DecimalType) else old.precision - old.scale
        scale = old.scale if isinstance(old, T.DecimalType) else 0
        return whole is not None and new.scale >= scale and new.precision - new.scale >= whole
    if str(new) in _EXACT and old in _EXACT[str(new)]:
        return True
    if isinstance(old, T.FloatType) and isinstance(new, T.DoubleType):
        return True
    if isinstance(old, T.DateType) and isinstance(new, T.TimestampType | T.TimestampNTZType):
        return True
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return can_widen(old.elementType, new.elementType) and (new.containsNull or not old.containsNull)
    return False


def widened(column: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """``new``, if it holds all of ``old``; else raises."""
    if not can_widen(old, new):
        raise ValueError(f"column {column}: {old.simpleString()} can't become {new.simpleString()} without loss")
    return new
