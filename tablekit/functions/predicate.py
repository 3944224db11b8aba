"""Predicates on named fields: a small tree that becomes a Column, in SQL's three-valued logic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType, StructType


@dataclass(frozen=True)
class Predicate:
    method: str
    name: str | None = None
    literals: tuple = ()
    parts: tuple[Predicate, ...] = field(default=())

    def fields(self) -> set[str]:
        return {self.name} if self.name is not None else set().union(*(p.fields() for p in self.parts))

    def conjuncts(self) -> list[Predicate]:
        return [c for p in self.parts for c in p.conjuncts()] if self.method == "and" else [self]

    def column(self, schema: StructType) -> Column:
        """The Column; literals are cast to the field's type, so that filters reach the files."""
        if self.method in ("and", "or"):
            return reduce(lambda a, b: a & b if self.method == "and" else a | b, [p.column(schema) for p in self.parts])
        kind = schema[self.name].dataType
        c, of = F.col(f"`{self.name}`"), [F.lit(x).cast(kind) for x in self.literals]
        if self.method in ("startswith", "endswith", "contains"):
            text = c if isinstance(kind, StringType) else c.cast("string")
            return getattr(text, self.method)(self.literals[0])
        if self.method in ("is_in", "is_not_in"):
            found = c.isin(of) if of else F.lit(False)
            return found if self.method == "is_in" else ~found
        return _LEAVES[self.method](c, *of)


_LEAVES: dict[str, Callable[..., Column]] = {
    "equal": lambda c, x: c == x,
    "not_equal": lambda c, x: c != x,
    "less_than": lambda c, x: c < x,
    "less_or_equal": lambda c, x: c <= x,
    "greater_than": lambda c, x: c > x,
    "greater_or_equal": lambda c, x: c >= x,
    "is_null": lambda c: c.isNull(),
    "is_not_null": lambda c: c.isNotNull(),
    "between": lambda c, lo, hi: c.between(lo, hi),
}


class PredicateBuilder:
    """Makes predicates on the fields of one row type; unknown fields are a ValueError."""

    def __init__(self, schema: StructType):
        self.schema = schema

    def _leaf(self, method: str, name: str, *literals: Any) -> Predicate:
        if name not in self.schema.names:
            raise ValueError(f"The field {name} is not in field list {self.schema.names}.")
        kind = self.schema[name].dataType
        for x in literals:
            wrong = isinstance(x, str) and isinstance(kind, NumericType) or isinstance(x, (list, dict, set)) or isinstance(x, bytes) and not isinstance(kind, BinaryType)
            if wrong:
                raise ValueError(f"The literal {x!r} doesn't fit the field {name} of type {kind.simpleString()}.")
        return Predicate(method, name, tuple(literals))

    def equal(self, name: str, literal: Any) -> Predicate:
        return self._leaf("equal", name, literal)

    def not_equal(self, name: str, literal: Any) -> Predicate:
        return self._leaf("not_equal", name, literal)

    def less_than(self, name: str, literal: Any) -> Predicate:
        return self._leaf("less_than", name, literal)

    def less_or_equal(self, name: str, literal: Any) -> Predicate:
        return self._leaf("less_or_equal", name, literal)

    def greater_than(self, name: str, literal: Any) -> Predicate:
        return self._leaf("greater_than", name, literal)

    def greater_or_equal(self, name: str, literal: Any) -> Predicate:
        return self._leaf("greater_or_equal", name, literal)

    def is_null(self, name: str) -> Predicate:
        return self._leaf("is_null", name)

    def is_not_null(self, name: str) -> Predicate:
        return self._leaf("is_not_null", name)

    def startswith(self, name: str, literal: str) -> Predicate:
        return self._leaf("startswith", name, literal)

    def endswith(self, name: str, literal: str) -> Predicate:
        return self._leaf("endswith", name, literal)

    def contains(self, name: str, literal: str) -> Predicate:
        return self._leaf("contains", name, literal)

    def is_in(self, name: str, literals: Sequence[Any]) -> Predicate:
        return self._leaf("is_in", name, *literals)

    def is_not_in(self, name: str, literals: Sequence[Any]) -> Predicate:
        return self._leaf("is_not_in", name, *literals)

    def between(self, name: str, low: Any, high: Any) -> Predicate:
        return self._leaf("between", name, low, high)

    def and_predicates(self, predicates: Sequence[Predicate]) -> Predicate:
        return self._joined("and", predicates)

    def or_predicates(self, predicates: Sequence[Predicate]) -> Predicate:
        return self._joined("or", predicates)

    @staticmethod
    def _joined(method: str, predicates: Sequence[Predicate]) -> Predicate:
        if not predicates:
            raise ValueError(f"'{method}' needs at least one predicate.")
        return predicates[0] if len(predicates) == 1 else Predicate(method, parts=tuple(predicates))
