"""Column names beside those a caller's table has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def fresh(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores where the columns hold one of them (whatever its case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def refuse_taken(docs: DataFrame, *names: str | None) -> None:
    """An error if a result column would have the name of a column that is there."""
    taken = {c.lower() for c in docs.columns}
    if clash := [n for n in names if n and n.lower() in taken]:
        raise ValueError(f"the documents have a column {', '.join(clash)} already; name another one for the result")
