"""Figures taken while a frame is written, so that nothing reads the result again for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from harborline.operators.quality import observable


# Two to this number of buckets: about 0.4 % standard error in some 64 KB.
SKETCH_BITS = 16


class Observed:
    """Named aggregates of a frame, computed by the job that writes it.

    Put it on the frame right under the write: there each row passes once, in a task whose result counts once even if
    executors are lost. (Under a shuffle, a repeated map task would count its rows again.)
    """

    def __init__(self, **figures: Column):
        self.figures, self.observation = figures, None

    def on(self, df: DataFrame) -> DataFrame:
        self.observation = Observation()
        return df.observe(self.observation, *[column.alias(name) for name, column in self.figures.items()])

    def values(self) -> dict:
        """The figures, once the write is done."""
        return dict(self.observation.get)


class TableFigures(Observed):
    """What a published table is judged by: rows, filled values of each column, the span and the
    distinct values of some, and plain checks."""

    def __init__(self, df: DataFrame, checks=(), spans=(), distincts=()):
        self.names, self.spans, self.distincts = df.columns, tuple(spans), tuple(distincts)
        self.checks = [c for c in checks if observable(c, df.schema)]
        measures = {
            f"check_{i}_{k}": m for i, check in enumerate(self.checks) for k, m in enumerate(check.measures())
        }
        ends = {f"{end}_{i}": take(c) for i, c in enumerate(self.spans) for end, take in (("low", F.min), ("high", F.max))}
        filled = {f"filled_{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(self.names)}
        sketches = {f"distinct_{i}": F.hll_sketch_agg(c, SKETCH_BITS) for i, c in enumerate(self.distincts)}
        super().__init__(rows=F.count("*"), **filled, **ends, **sketches, **measures)

    def values(self) -> dict:
        if getattr(self, "_values", None) is None:
            self._values = super().values()
        return self._values

    @property
    def rows(self) -> int:
        return self.values()["rows"]

    def filled(self) -> dict[str, int]:
        return {c: self.values()[f"filled_{i}"] for i, c in enumerate(self.names)}

    def measured(self) -> dict[str, list]:
        """By check name, what its measures came to."""
        return {
            check.name: [self.values()[f"check_{i}_{k}"] for k in range(len(check.measures()))]
            for i, check in enumerate(self.checks)
        }

    def sketches(self) -> dict[str, bytes]:
        """Mergeable sketches of the distinct values of some columns; none for a column without a value."""
        found = {c: self.values()[f"distinct_{i}"] for i, c in enumerate(self.distincts)}
        return {c: sketch for c, sketch in found.items() if sketch is not None}

    def metrics(self) -> list[tuple[str, int | None]]:
        """(metric, value) rows for the registry."""
        values = self.values()
        found = [("rows_written", self.rows)]
        found += [(f"nulls.{c}", self.rows - n) for c, n in self.filled().items()]
        for i, c in enumerate(self.spans):
            found += [(f"{end}.{c}", values[f"{key}_{i}"]) for end, key in (("min", "low"), ("max", "high"))]
        return found
