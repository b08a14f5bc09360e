"""Fields of records whose keys nobody declared.

The reader keeps each record as a VARIANT. One aggregate over the records finds
their keys and types, nested ones too; a projection then gives every scalar
leaf a typed column, named by its keys joined with dots. Lists, and keys whose
values are of several types, become JSON text (scalars among them plain text).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that a projection makes at most; with more, the caller names the keys.
MOST_FIELDS = 1000


@dataclass(frozen=True)
class Field:
    """A leaf: the keys that lead to it, and its type (None: of several types, or a list)."""
    keys: tuple[str, ...]
    type: str | None

    @property
    def name(self) -> str:
        return ".".join(self.keys)


def _leaves(kind: T.StructType, keys: tuple[str, ...] = ()) -> Iterable[Field]:
    for f in kind.fields:
        at = (*keys, f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, at)
        elif isinstance(f.dataType, T.ArrayType | T.VariantType | T.StructType):
            yield Field(at, None)
        else:
            yield Field(at, "string" if isinstance(f.dataType, T.NullType) else f.dataType.simpleString())


def parse_schema(text: str) -> list[Field]:
    """The leaves of a type as ``schema_of_variant_agg`` writes it."""
    if not text.startswith("OBJECT<"):
        return []
    # OBJECT is what SQL calls STRUCT, unless it is part of a quoted key.
    text = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return list(_leaves(T.DataType.fromDDL(text)))


def undeclared(text: str | None, known: Sequence[str] = (), most: int = MOST_FIELDS) -> list[Field]:
    """The leaves of a type (see ``parse_schema``) without those below the ``known`` keys.
    More than ``most`` are an error, not a loss: name the keys that you want then."""
    fields = [f for f in parse_schema(text or "") if f.keys[0] not in known]
    if len(fields) > most:
        raise ValueError(f"{len(fields)} different keys, more than {most}: pass the fields that are wanted")
    return fields


def discover(df: DataFrame, record: str, known: Sequence[str] = (), most: int = MOST_FIELDS) -> list[Field]:
    """The leaves of the VARIANT column ``record``, without those below the
    ``known`` keys; one aggregate, of which one row comes to the driver."""
    text = df.filter(F.schema_of_variant(record).startswith("OBJECT")).agg(F.schema_of_variant_agg(record)).first()[0]
    return undeclared(text, known, most)


def discover_by(df: DataFrame, record: str, kind: str) -> dict:
    """The type of the VARIANT column ``record``, which holds objects only, for
    each value of ``kind``, which are few; one aggregate."""
    return {k: text for k, text in df.groupBy(kind).agg(F.schema_of_variant_agg(record)).collect()}


def _member(value: Column, key: str) -> Column:
    if "'" in key or "\\" in key:  # no path can name these
        return F.element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(key))
    return F.try_variant_get(value, f"$['{key}']", "variant")


def project(record: Column, fields: Iterable[Field], taken: Iterable[str] = (), prefix: str = "") -> dict[str, Column]:
    """A column for each field. A name that is ``taken`` (case does not count)
    gets ``prefix`` in front, and underscores until it is free."""
    seen, out = {t.lower() for t in taken}, {}
    for f in fields:
        value = record
        for key in f.keys:
            value = _member(value, key)
        name = f.name
        if name.lower() in seen and prefix:
            name = prefix + name
        while name.lower() in seen:
            name = "_" + name
        seen.add(name.lower())
        text = F.coalesce(F.try_variant_get(value, "$", "string"), F.when(F.schema_of_variant(value) != "VOID", F.to_json(value)))
        out[name] = (text if f.type is None else F.try_variant_get(value, "$", f.type)).alias(name)
    return out
