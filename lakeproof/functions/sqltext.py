"""SQL spelling of names and literals.

Wide projections are generated as SQL text: a table with hundreds of columns
then costs one call to the planner per expression instead of one per operator.
"""

from __future__ import annotations


def name(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
