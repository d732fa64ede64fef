"""Column names for helper columns that no input column has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores added until no taken name (in
    any case) and no earlier one equals it."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
