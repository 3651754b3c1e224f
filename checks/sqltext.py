"""Small builders for the reference SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def div0(a: str, b: str) -> str:
    return (
        f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL WHEN ({b}) = 0 THEN 0 "
        f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"
    )


def qty(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,6))"


def values(rows: Sequence[Sequence[object]]) -> str:
    def lit(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def in_list(items: Iterable[str]) -> str:
    return "(" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + ")"


def final(sql: str, dates: Iterable[str] = (), numbers: Iterable[str] = (), counts: Iterable[str] = ()) -> str:
    """Dates as ISO text, fractions as doubles, counts as bigints."""
    casts = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates]
    casts += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in numbers]
    casts += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in counts]
    if not casts:
        return sql
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql.strip()}) AS q"
