"""Experimental design: which sample column belongs to which condition and replicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sample:
    """One sample column: 1-based position in the wide table, condition, replicate."""

    position: int
    condition: str
    replicate: int

    @property
    def name(self) -> str:
        return f"{self.condition}-{self.replicate}"


@dataclass(frozen=True)
class Contrast:
    """A pairwise comparison; effects are reported as ``right - left``."""

    left: str
    right: str
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or f"{self.left}-{self.right}"


@dataclass(frozen=True)
class Design:
    """Ordered list of samples. The order of conditions is the display order."""

    samples: tuple[Sample, ...]

    @classmethod
    def from_positions(cls, groups: Mapping[str, Sequence[int]]) -> Design:
        """``{"A": [2, 3, 4], "B": [5, 6, 7]}`` with 1-based column positions."""
        out: list[Sample] = []
        for condition, positions in groups.items():
            out += [Sample(p, condition, r) for r, p in enumerate(positions, start=1)]
        if len({s.position for s in out}) != len(out):
            raise ValueError("a column position is used by two samples")
        return cls(tuple(out))

    @classmethod
    def from_counts(cls, groups: Mapping[str, int], first: int = 2) -> Design:
        """``{"A": 3, "B": 3}``: consecutive columns starting at position ``first``."""
        positions: dict[str, list[int]] = {}
        at = first
        for condition, n in groups.items():
            positions[condition] = list(range(at, at + n))
            at += n
        return cls.from_positions(positions)

    @property
    def conditions(self) -> list[str]:
        return list(dict.fromkeys(s.condition for s in self.samples))

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.samples]

    def contrast(self, left: str, right: str) -> Contrast:
        for c in (left, right):
            if c not in self.conditions:
                raise ValueError(f"unknown condition {c!r}")
        return Contrast(left, right)

    def all_contrasts(self) -> list[Contrast]:
        """Every pair of conditions, in design order."""
        cs = self.conditions
        return [Contrast(a, b) for i, a in enumerate(cs) for b in cs[i + 1 :]]

    def rename(self, df: DataFrame) -> DataFrame:
        """Keep the identifier (first column) and the design's columns, renamed
        ``Condition-Replicate``. Works by position, so repeated names are fine."""
        positional = df.toDF(*[f"c{i}" for i in range(1, len(df.columns) + 1)])
        return positional.select(
            F.col("c1").alias(df.columns[0]),
            *[F.col(f"c{s.position}").alias(s.name) for s in self.samples],
        )

    def condition_order(self, condition: Column) -> Column:
        """Display rank of a condition, NULL when it is not part of the design."""
        expr = F.when(F.lit(False), F.lit(0))
        for i, c in enumerate(self.conditions):
            expr = expr.when(condition == c, F.lit(i))
        return expr
