"""Label matchers, filtersets (all must hold) and lists of filtersets (one must hold)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import all_true, any_true, get


@dataclass(frozen=True)
class Matcher:
    """op is = != =~ or !~; patterns are Java's and have to match the whole value. A label that isn't there reads as ''."""

    name: str
    op: str
    value: str

    def __post_init__(self):
        if self.op not in ("=", "!=", "=~", "!~"):
            raise ValueError(f"no such matcher: {self.op}")

    def col(self, labels: str | Column = "labels") -> Column:
        found = get(F.col(labels) if isinstance(labels, str) else labels, self.name)
        if self.op in ("=", "!="):
            return found == self.value if self.op == "=" else found != self.value
        whole = found.rlike(rf"\A(?:{self.value})\z")
        return whole if self.op == "=~" else ~whole


Filterset = Sequence[Matcher]


def all_of(filterset: Filterset, labels: str | Column = "labels") -> Column:
    return all_true(m.col(labels) for m in filterset)


def any_of(filtersets: Sequence[Filterset] | None, labels: str | Column = "labels") -> Column:
    """True where one filterset holds. None keeps all, an empty list nothing."""
    return F.lit(True) if filtersets is None else any_true(all_of(f, labels) for f in filtersets)
