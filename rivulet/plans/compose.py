"""Named, nestable composition of steps (a process group with an input
and an output port). Composition is ``DataFrame.transform``: one lazy plan,
optimised once by Catalyst."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


class Group:
    """``Group("name", step, step, ...)`` is itself a step."""

    def __init__(self, name: str, *steps: Step):
        self.name = name
        self.steps = steps

    def __call__(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = df.transform(s)
        return df

    def __repr__(self) -> str:
        return f"Group({self.name!r}, {len(self.steps)} steps)"


def compose(*steps: Step, name: str = "group") -> Group:
    return Group(name, *steps)
