"""Column-name rules (schema work on the driver, never row work).

A name is split into words and re-joined as ``UPPER_SNAKE_CASE``. Only
ASCII letters and digits form words; anything else separates words and
is dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed value: word pattern. A word is an optional capital followed by a
# lowercase run, or a capital run not followed by a lowercase letter, or a
# digit run. ---
WORD_PATTERN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def snake_upper(name: str) -> str:
    """``SalesOrderID`` -> ``SALES_ORDER_ID``; ``address1`` -> ``ADDRESS_1``.

    May return ``""`` for a name without ASCII letters or digits.
    """
    # Words hold only ASCII letters and digits and are never empty, so the
    # result is already [A-Z0-9_] with single, inner underscores.
    return "_".join(WORD_PATTERN.findall(name)).upper()


def normalized_names(names: list[str] | tuple[str, ...]) -> list[str]:
    """Normalize every name and make the result unique.

    * An empty result becomes ``COL_<1-based position>``.
    * Repeats get ``_1``, ``_2``, ... in order of appearance; a suffix that
      would clash with another column's name is skipped, so the output is
      always unique and a column that is naturally ``X_1`` keeps that name.
    """
    bases = []
    for pos, name in enumerate(names, start=1):
        base = snake_upper(name)
        bases.append(base if base else f"COL_{pos}")
    reserved = set(bases)
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    out = []
    for base in bases:
        if base not in taken:
            chosen = base
        else:
            n = repeats.get(base, 0)
            while True:
                n += 1
                chosen = f"{base}_{n}"
                if chosen not in taken and chosen not in reserved:
                    break
            repeats[base] = n
        taken.add(chosen)
        out.append(chosen)
    return out


def qcol(name: str) -> Column:
    """Reference a column by its exact name (dots, spaces, backticks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")
