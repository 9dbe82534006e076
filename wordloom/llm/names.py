"""Column names that a table does not have yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as it takes to clash with none."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
