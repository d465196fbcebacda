"""Small helpers that write DuckDB oracle SQL text (union-all long forms)."""

from __future__ import annotations


def union_all(template: str, cols, table: str | None = None) -> str:
    """``template`` is formatted with {c} (column) and {i} (position)."""
    parts = [template.format(c=c, i=i, t=table) for i, c in enumerate(cols)]
    return "\nunion all\n".join(parts)


def round_cols(cols, nd: int = 6) -> str:
    return ", ".join(f"round({c}, {nd}) as {c}" for c in cols)
