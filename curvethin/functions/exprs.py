"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and formats of the original job's keys and output.
KEY_SEPARATOR = "#"
FIELD_SEPARATOR = ";"
HANDLE_SEPARATOR = ","
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
WRITER_USER = "spark"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair(primary: str | Column, fallback: str | Column) -> Column:
    """``CASE WHEN a <> 0 THEN a ELSE b END``: a null or zero ``a`` falls to ``b``."""
    a = col(primary)
    return F.when(a != 0, a).otherwise(col(fallback))


def blank_to_null(c: str | Column) -> Column:
    """Empty string -> null (no trimming: only the exact empty string)."""
    return F.nullif(col(c), F.lit(""))


def series_key_text(cols: Sequence[str | Column]) -> Column:
    """Display form of a composite series key, ``a#b#c``."""
    return F.concat_ws(KEY_SEPARATOR, *[col(c).cast("string") for c in cols])






def fit(sse: Column, sst: Column) -> Column:
    """Fit measure ``1 - sqrt(SSE/SST)``; 1.0 when either sum is zero."""
    return F.when((sse == 0) | (sst == 0), F.lit(1.0)).otherwise(1.0 - F.sqrt(sse / sst))


def level_cut(m: Column, p: float) -> Column:
    """Number of ranked interior points kept at fraction ``p``: floor(m * p)."""
    return F.floor(m.cast("double") * F.lit(float(p)))






def output_handle(handle: str | Column, category: str | Column, run_date: str | Column) -> Column:
    """``HANDLE,<category>,<yyyy-MM-dd>``."""
    d = F.date_format(F.to_date(col(run_date)), DATE_FORMAT) if isinstance(run_date, str) \
        else F.date_format(run_date, DATE_FORMAT)
    return F.concat_ws(HANDLE_SEPARATOR, col(handle), col(category), d)


# ---------------------------------------------------------------- SQL text
# The level scan needs a few hundred expressions; building each from Column
# objects costs one JVM round trip per operator node, so they are written as
# SQL text and parsed once per column (same Catalyst expressions).

def q(name: str) -> str:
    """Quote an identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def dlit(v: float) -> str:
    """Exact double literal (repr round-trips)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _p(*args: str) -> list[str]:
    """Parenthesise SQL fragments before substituting them."""
    return [f"({a})" for a in args]


def significance_sql(x: str, y: str, xp: str, yp: str, xn: str, yn: str) -> str:
    x, y, xp, yp, xn, yn = _p(x, y, xp, yp, xn, yn)
    return f"abs(({xn} - {xp}) * ({y} - {yp}) + ({yp} - {yn}) * ({x} - {xp}))"


def interpolate_sql(x: str, px: str, py: str, nx: str, ny: str) -> str:
    x, px, py, nx, ny = _p(x, px, py, nx, ny)
    dy, dx = f"({ny} - {py})", f"({nx} - {px})"
    slope = f"({dy} / {dx})"
    return f"CASE WHEN {dy} = 0 OR {dx} = 0 THEN {ny} ELSE {slope} * {x} + ({ny} - {slope} * {nx}) END"


def fit_sql(sse: str, sst: str) -> str:
    sse, sst = _p(sse, sst)
    return f"CASE WHEN {sse} = 0 OR {sst} = 0 THEN 1.0D ELSE 1.0D - sqrt({sse} / {sst}) END"


def entry_level_sql(rank: str, m: str, levels: Sequence[float]) -> str:
    parts = " ".join(f"WHEN {rank} <= floor(CAST({m} AS DOUBLE) * {dlit(p)}) THEN {i}"
                     for i, p in enumerate(levels, 1))
    return f"CASE {parts} ELSE {len(levels) + 1} END"


def first_level_sql(fits: str, n_levels: int, target: float) -> str:
    parts = " ".join(f"WHEN {fits}[{i}] >= {dlit(target)} THEN {i + 1}" for i in range(n_levels))
    return f"CASE {parts} ELSE {n_levels} END"
