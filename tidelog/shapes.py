"""Shapes: a table's declared columns, their metadata and keys, and real data cast onto them.

A shape is a ``StructType`` with a name. Behaviour lives in column metadata under the keys below. Casting is recursive, fills absent
nullable columns with null, and refuses by path what cannot fit.
"""

from __future__ import annotations

import dataclasses
import json
import typing
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path
from uuid import UUID

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIMARY, PARTITION, SORT, DERIVED, FIELD_ID = "primary_key", "partition_key", "sort_key", "derived_from", "field_id"


class DoesNotFit(ValueError):
    """What could not be cast; the message names the path."""


@dataclass(frozen=True)
class Shape:
    name: str
    schema: T.StructType
    namespace: str = ""
    metadata: dict = field(default_factory=dict, hash=False, compare=False)

    def keys(self, kind: str) -> dict[str, object]:
        return {f.name: f.metadata[kind] for f in self.schema.fields if kind in (f.metadata or {})}

    @property
    def primary_keys(self) -> list[str]:
        names = list(self.keys(PRIMARY))
        for n in names:
            if self.schema[n].nullable:
                raise DoesNotFit(f"{self.name}.{n}: a primary key is never null")
        return names

    @property
    def partition_keys(self) -> dict[str, object]:
        return self.keys(PARTITION)

    @property
    def sort_keys(self) -> list[str]:
        return [n for n, _ in sorted(self.keys(SORT).items(), key=lambda kv: int(kv[1]) if str(kv[1]).isdigit() else 0)]

    @property
    def derived_keys(self) -> dict[str, object]:
        return self.keys(DERIVED)

    @property
    def leaf_names(self) -> list[str]:
        return _leaves(self.schema, "")

    # documents

    def to_dict(self) -> dict:
        return {"name": self.name, "type": "struct", **({"namespace": self.namespace} if self.namespace else {}), **({"metadata": self.metadata} if self.metadata else {}), "fields": [_field_out(f) for f in self.schema.fields]}

    @classmethod
    def from_dict(cls, doc: dict) -> "Shape":
        return cls(doc["name"], T.StructType([_field_in(f) for f in doc.get("fields", [])]), doc.get("namespace") or (doc.get("metadata") or {}).get("namespace", ""), doc.get("metadata") or {})

    @classmethod
    def read(cls, path: str | Path) -> "Shape":
        return cls.from_dict(read_document(path))

    def write(self, path: str | Path) -> None:
        write_document(self.to_dict(), path)


def _leaves(kind: T.DataType, at: str) -> list[str]:
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in _leaves(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType, f"{at}.element")
    if isinstance(kind, T.MapType):
        return _leaves(kind.keyType, f"{at}.key") + _leaves(kind.valueType, f"{at}.value")
    return [at]


# Documents: mappings as JSON, YAML or TOML. None is dropped on writing.


def _clean(doc):
    if isinstance(doc, dict):
        return {k: _clean(v) for k, v in doc.items() if v is not None}
    return [_clean(v) for v in doc] if isinstance(doc, (list, tuple)) else doc


def read_document(path: str | Path) -> dict:
    path = Path(path)
    if path.suffix in (".yml", ".yaml"):
        import yaml

        return yaml.safe_load(path.read_text()) or {}
    if path.suffix == ".toml":
        import tomllib

        return tomllib.loads(path.read_text())
    return json.loads(path.read_text())


def write_document(doc: dict, path: str | Path) -> None:
    path = Path(path)
    if path.suffix in (".yml", ".yaml"):
        import yaml

        path.write_text(yaml.safe_dump(_clean(doc), sort_keys=False, allow_unicode=True))
    elif path.suffix == ".toml":
        raise ValueError("TOML is read only here")
    else:
        path.write_text(json.dumps(_clean(doc), indent=2, ensure_ascii=False))


#: Document spellings of types.
_SPELLED = {
    "bool": T.BooleanType(), "boolean": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float": T.FloatType(), "float32": T.FloatType(), "double": T.DoubleType(),
    "float64": T.DoubleType(), "string": T.StringType(), "utf8": T.StringType(), "large_string": T.StringType(), "binary": T.BinaryType(), "date32[day]": T.DateType(), "date32": T.DateType(),
    "timestamp[us]": T.TimestampNTZType(), "timestamp[us, tz=utc]": T.TimestampType(), "timestamp[ns]": T.LongType(), "time64[ns]": T.LongType(), "time64[us]": T.LongType(), "duration[us]": T.DayTimeIntervalType(),
}


def _type_in(doc: dict) -> tuple[T.DataType, dict]:
    name = str(doc.get("type", "string")).strip()
    low = name.lower().replace(" ", "")
    if low == "struct":
        return T.StructType([_field_in(f) for f in doc["fields"]]), {}
    if low.startswith(("list", "large_list", "fixed_size_list")):
        item = doc.get("item") or doc.get("fields", [{}])[0]
        more = {"list": name} if low != "list" else {}
        return T.ArrayType(_type_in(item)[0], bool(item.get("nullable", False))), more | ({"list_size": doc["list_size"]} if "list_size" in doc else {})
    if low == "map":
        key, value = doc.get("key", {"type": "string"}), doc.get("value") or doc.get("item") or {"type": "string"}
        return T.MapType(_type_in(key)[0], _type_in(value)[0], bool(value.get("nullable", False))), {}
    if low.startswith("decimal"):
        p, s = (int(x) for x in low[low.index("(") + 1 : -1].split(","))
        if p > 38:
            raise DoesNotFit(f"{doc.get('name')}: a decimal has at most 38 digits, not {p}")
        return T.DecimalType(p, s), {}
    if low.startswith("fixed_size_binary"):
        return T.BinaryType(), {"length": int(low[low.index("[") + 1 : -1])}
    kind = _SPELLED.get(low) or _SPELLED.get(name.lower())
    if kind is None:
        raise DoesNotFit(f"{doc.get('name')}: no type is called {name}")
    return kind, ({"unit": low} if low in ("timestamp[ns]", "time64[ns]", "time64[us]") else {})


def _field_in(doc: dict) -> T.StructField:
    kind, more = _type_in(doc)
    meta = {k.split(":", 1)[-1] if k.startswith("iceberg:") else k: v for k, v in (doc.get("metadata") or {}).items()} | more
    if doc.get("description"):
        meta["description"] = doc["description"]
    return T.StructField(doc["name"], kind, bool(doc.get("nullable", False)), meta)


def _type_out(kind: T.DataType, meta: dict) -> dict:
    if isinstance(kind, T.StructType):
        return {"type": "struct", "fields": [_field_out(f) for f in kind.fields]}
    if isinstance(kind, T.ArrayType):
        return {"type": meta.get("list", "list"), "item": {**_type_out(kind.elementType, {}), "nullable": kind.containsNull or None}}
    if isinstance(kind, T.MapType):
        return {"type": "map", "key": _type_out(kind.keyType, {}), "value": {**_type_out(kind.valueType, {}), "nullable": kind.valueContainsNull or None}}
    if isinstance(kind, T.DecimalType):
        return {"type": f"decimal128({kind.precision}, {kind.scale})"}
    if isinstance(kind, T.BinaryType) and "length" in meta:
        return {"type": f"fixed_size_binary[{meta['length']}]"}
    if "unit" in meta:
        return {"type": meta["unit"]}
    return {"type": next(n for n, k in _SPELLED.items() if type(k) is type(kind))}


def _field_out(f: T.StructField) -> dict:
    meta = {k: v for k, v in (f.metadata or {}).items() if k not in ("description", "length", "list", "list_size", "unit")}
    return {"name": f.name, **_type_out(f.dataType, f.metadata or {}), "nullable": f.nullable or None, "description": (f.metadata or {}).get("description"), "metadata": meta or None}


# Classes as shapes

_HINTS = {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType(), bytes: T.BinaryType(), datetime: T.TimestampNTZType(), date: T.DateType(), timedelta: T.DayTimeIntervalType(), Decimal: T.DecimalType(38, 9), UUID: T.StringType(), Path: T.StringType()}


def _of_hint(hint, path: str, seen: tuple = ()) -> tuple[T.DataType, bool]:
    origin, args = typing.get_origin(hint), typing.get_args(hint)
    if origin in (typing.Union, type(int | None)):
        some = [a for a in args if a is not type(None)]
        if len(some) != 1:
            raise DoesNotFit(f"{path}: a union of several types has no column")
        return _of_hint(some[0], path, seen)[0], True
    if origin in (list, set, frozenset) or origin is tuple and len(args) == 2 and args[1] is ...:
        inner, null = _of_hint(args[0], path, seen)
        return T.ArrayType(inner, null), False
    if origin is tuple:
        return T.StructType([T.StructField(f"f{i}", *_of_hint(a, f"{path}.f{i}", seen)) for i, a in enumerate(args)]), False
    if origin is dict:
        value, null = _of_hint(args[1], path, seen)
        return T.MapType(_of_hint(args[0], path, seen)[0], value, null), False
    if dataclasses.is_dataclass(hint):
        if hint in seen:
            raise DoesNotFit(f"{path}: {hint.__name__} contains itself")
        return shape_of(hint, seen).schema, False
    if isinstance(hint, type) and hasattr(hint, "__members__"):
        return (T.IntegerType() if issubclass(hint, int) else T.StringType()), False
    if hint in _HINTS:
        return _HINTS[hint], False
    raise DoesNotFit(f"{path}: {hint} has no column type")


def shape_of(cls: type, seen: tuple = ()) -> Shape:
    """The shape of a dataclass: its hints are the types, a field's ``metadata`` is the column's."""
    hints = typing.get_type_hints(cls)
    fields = [T.StructField(f.name, *_of_hint(hints[f.name], f"{cls.__name__}.{f.name}", (*seen, cls)), dict(f.metadata)) for f in dataclasses.fields(cls)]
    return Shape(cls.__name__, T.StructType(fields), cls.__module__)


def class_of(shape: Shape) -> type:
    """A dataclass whose shape is this one again, as far as hints can say it."""
    back = {type(v): k for k, v in reversed(_HINTS.items())} | {T.IntegerType: int, T.TimestampType: datetime}

    def hint(kind: T.DataType, null: bool, name: str):
        if isinstance(kind, T.StructType):
            out = class_of(Shape(name.title().replace("_", ""), kind))
        elif isinstance(kind, T.ArrayType):
            out = list[hint(kind.elementType, kind.containsNull, name)]
        elif isinstance(kind, T.MapType):
            out = dict[hint(kind.keyType, False, name), hint(kind.valueType, kind.valueContainsNull, name)]
        else:
            out = back[type(kind)]
        return out | None if null else out

    rows = [(f.name, hint(f.dataType, f.nullable, f.name), dataclasses.field(default=None, metadata=f.metadata or {}) if f.nullable else dataclasses.field(metadata=f.metadata or {})) for f in shape.schema.fields]
    return dataclasses.make_dataclass(shape.name, rows, kw_only=True)


# Merging


def merged(target: T.DataType, other: T.DataType) -> T.DataType:
    """``target`` with what only ``other`` has, which becomes nullable; where both have it the target wins. Map keys are never merged."""
    if isinstance(target, T.StructType) and isinstance(other, T.StructType):
        have = set(target.names)
        kept = [T.StructField(f.name, merged(f.dataType, other[f.name].dataType) if f.name in other.names else f.dataType, f.nullable, f.metadata) for f in target.fields]
        return T.StructType(kept + [T.StructField(f.name, f.dataType, True, f.metadata) for f in other.fields if f.name not in have])
    if isinstance(target, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(merged(target.elementType, other.elementType), target.containsNull)
    if isinstance(target, T.MapType) and isinstance(other, T.MapType):
        return T.MapType(target.keyType, merged(target.valueType, other.valueType), target.valueContainsNull)
    return target


# Casting

_INTEGRAL = {"byte": 8, "tinyint": 8, "short": 16, "smallint": 16, "integer": 32, "int": 32, "long": 64, "bigint": 64}


def _cast(c: Column, have: T.DataType, want: T.DataType, path: str, safe: bool) -> Column:
    if have == want:
        return c
    if isinstance(want, T.StructType):
        return _to_struct(c, have, want, path, safe)
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.transform(c, lambda x: _cast(x, have.elementType, want.elementType, f"{path}[]", safe))
        if isinstance(have, T.MapType):
            entry = T.StructType([T.StructField("key", have.keyType), T.StructField("value", have.valueType)])
            return F.transform(F.map_entries(c), lambda x: _cast(x, entry, want.elementType, f"{path}[]", safe))
        if isinstance(have, T.StructType):
            return F.when(c.isNotNull(), F.array(*[_cast(c.getField(f.name), f.dataType, want.elementType, f"{path}.{f.name}", safe) for f in have.fields]))
    elif isinstance(want, T.MapType):
        if isinstance(have, T.MapType):
            keys = F.transform_keys(c, lambda k, v: _cast(k, have.keyType, want.keyType, f"{path}.key", safe))
            return F.transform_values(keys, lambda k, v: _cast(v, have.valueType, want.valueType, f"{path}.value", safe))
        if isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType) and len(have.elementType.fields) == 2:
            entry = T.StructType([T.StructField("key", want.keyType), T.StructField("value", want.valueType)])
            return F.map_from_entries(F.transform(c, lambda x: _to_struct(x, have.elementType, entry, path, safe, by_place=True)))
        if isinstance(have, T.StructType):
            pairs = [x for f in have.fields for x in (_cast(F.lit(f.name), T.StringType(), want.keyType, path, safe), _cast(c.getField(f.name), f.dataType, want.valueType, f"{path}.{f.name}", safe))]
            return F.when(c.isNotNull(), F.create_map(*pairs))
    elif not isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        name = want.simpleString()
        if safe:
            return c.cast(want)
        bits = _INTEGRAL.get(name)
        if bits and have.simpleString() in _INTEGRAL:  # wraps, as two's complement does
            half = 1 << (bits - 1)
            return c.cast(want) if bits == 64 else (F.pmod(c.cast("decimal(20,0)") + half, F.lit(1 << bits).cast("decimal(20,0)")) - half).cast(want)
        return c.try_cast(want)
    raise DoesNotFit(f"{path}: {have.simpleString()} does not fit {want.simpleString()}")


def _to_struct(c: Column, have: T.DataType, want: T.StructType, path: str, safe: bool, by_place: bool = False) -> Column:
    members = []
    for i, f in enumerate(want.fields):
        at = f"{path}.{f.name}"
        if isinstance(have, T.StructType):
            src = have.fields[i] if by_place else next((g for g in have.fields if g.name == f.name), None)
            got = None if src is None else _cast(c.getField(src.name), src.dataType, f.dataType, at, safe)
        elif isinstance(have, T.MapType):
            got = _cast(F.try_element_at(c, F.lit(f.name).cast(have.keyType)), have.valueType, f.dataType, at, safe)
        elif isinstance(have, T.ArrayType):
            got = _cast(F.get(c, F.lit(i)), have.elementType, f.dataType, at, safe)
        else:
            raise DoesNotFit(f"{path}: {have.simpleString()} does not fit a struct")
        members.append(_demanded(got, f, at, c).alias(f.name))
    return F.when(c.isNotNull(), F.struct(*members))


def _demanded(got: Column | None, f: T.StructField, path: str, whole: Column | None = None) -> Column:
    if got is None:
        if not f.nullable:
            raise DoesNotFit(f"{path}: is missing and must not be null")
        return F.lit(None).cast(f.dataType)
    if f.nullable:
        return got
    null = got.isNull() if whole is None else whole.isNotNull() & got.isNull()
    return F.coalesce(got, F.when(null, F.raise_error(F.lit(f"{path}: must not be null")).cast(f.dataType)))


def cast_onto(df: DataFrame, shape: Shape | T.StructType, safe: bool = False, merge_schema: bool = False) -> DataFrame:
    """``df`` reordered and cast to ``shape``: extra columns go (or stay, nullable, with ``merge_schema``), absent nullable ones are null.

    Not ``safe``: integers wrap, text that is no value becomes null; ``safe``: what would lose something raises. A column that must not
    be null and is absent is refused here, a null in it when the rows are computed; both name the path.
    """
    want = shape.schema if isinstance(shape, Shape) else shape
    name = shape.name if isinstance(shape, Shape) else "row"
    if merge_schema:
        want = merged(want, df.schema)
    out = []
    for f in want.fields:
        src = next((g for g in df.schema.fields if g.name == f.name), None)
        got = None if src is None else _cast(F.col(f"`{f.name}`"), src.dataType, f.dataType, f"{name}.{f.name}", safe)
        out.append(_demanded(got, f, f"{name}.{f.name}").alias(f.name, metadata=f.metadata or {}))
    return df.select(*out)
