"""Column names that clash with none of the caller's."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain, count


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Each wanted name, or the first of name_1, name_2, … that neither ``taken`` nor an earlier one carries (case ignored)."""
    used = {name.lower() for name in taken}
    out = []
    for name in wanted:
        free = next(n for n in chain([name], (f"{name}_{i}" for i in count(1))) if n.lower() not in used)
        used.add(free.lower())
        out.append(free)
    return out
