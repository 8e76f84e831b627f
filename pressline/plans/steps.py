"""Jobs as steps that know what they need, so that a plan holds only what its caller asks for.

Catalyst cannot drop an unwanted field behind the generators and Python stages of a page job, and a
field that nobody reads still costs its place in the plan.  Here a job is a list of steps; those whose
columns nobody wants are never built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from pressline.functions.text import let


@dataclass(frozen=True)
class Marks:
    """Independent columns read off the rows as they come; all chosen marks are added in one step."""

    gives: tuple[str, ...]
    columns: Callable[[], dict[str, Column]]
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Step:
    """Columns added to the rows from columns that earlier steps have given."""

    gives: tuple[str, ...]
    needs: tuple[str, ...]
    add: Callable[[DataFrame], DataFrame]


def mark(name: str, column: Callable[[], Column]) -> Marks:
    return Marks((name,), lambda: {name: column()})


def chosen(steps: Sequence[Marks | Step], wanted: Iterable[str]) -> list[Marks | Step]:
    """The steps that give what is wanted, or what such steps need, in their order."""
    open_names, kept = set(wanted), []
    for step in reversed(steps):
        if open_names & set(step.gives):
            open_names |= set(step.needs)
            kept.append(step)
    return kept[::-1]


def built(df: DataFrame, steps: Sequence[Marks | Step], wanted: Iterable[str]) -> DataFrame:
    """``df`` with the columns of all steps that the wanted columns call for; steps stand in an order that gives before it needs."""
    todo = chosen(steps, wanted)
    marks = {name: column for step in todo if isinstance(step, Marks) for name, column in step.columns().items()}
    if marks:
        df = let(df, **marks)
    for step in todo:
        if isinstance(step, Step):
            df = step.add(df)
    return df
