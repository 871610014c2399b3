"""Job parameters for curve thinning.

The tuning row of the source system is read by position; the names below are
ours.  Levels are built by repeated addition so the cut-off fractions are the
same binary doubles the original loop produces (0.1, 0.2, 0.30000000000000004,
...), which decides ``floor(m * p)`` exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Any, Sequence

# Defaults of the original job (threshold, head rows, tail rows,
# target fit, start fraction, fraction step) and the positions of those values
# in its one-row tuning table.
DEFAULT_THRESHOLD = 50
DEFAULT_PRE = 10
DEFAULT_POST = 10
DEFAULT_TARGET = 0.99
DEFAULT_START = 0.1
DEFAULT_STEP = 0.1
CONFIG_POSITIONS = {"threshold": 2, "pre": 3, "post": 4, "target": 5, "start": 6, "step": 7}

# A level costs a few array operations a task; so many doubles are kept for each series whose fits are all asked for.
MAX_LEVELS = 10_000

ANCHOR_MODES = ("origin", "first")


@dataclass(frozen=True)
class ThinConfig:
    """Parameters of one thinning run.

    threshold   series with at most this many rows pass through whole
    pre / post  rows kept verbatim at the head / tail of a longer series
    target      fit the chosen level must reach (1 - sqrt(SSE/SST))
    start/step  first kept fraction and its increment
    leading_anchor
                "origin": a dropped point with no kept interior point before
                it is interpolated from (0, 0) (the original behaviour);
                "first": from the first middle point.
    max_series_rows
                series longer than this are thinned by the split path, in
                blocks of ``block_rows`` rows, so no task holds a whole series;
                equal by default, as either is what a Python task holds at once.
    sort_rows   rows per range partition in the split path's sorts.
    """

    threshold: int = DEFAULT_THRESHOLD
    pre: int = DEFAULT_PRE
    post: int = DEFAULT_POST
    target: float = DEFAULT_TARGET
    start: float = DEFAULT_START
    step: float = DEFAULT_STEP
    leading_anchor: str = "origin"
    max_series_rows: int = 250_000
    block_rows: int = 250_000
    sort_rows: int = 250_000

    def __post_init__(self) -> None:
        self.validate()

    def validate(self) -> None:
        if self.threshold < 0 or self.pre < 0 or self.post < 0:
            raise ValueError("threshold, pre and post must be >= 0")
        for name in ("target", "start", "step"):
            v = getattr(self, name)
            if not isinstance(v, (int, float)) or math.isnan(v) or math.isinf(v):
                raise ValueError(f"{name} must be a finite number, got {v!r}")
        if not self.step > 0:
            raise ValueError("step must be > 0, or the level scan never ends")
        if self.target > 1:
            raise ValueError("target must be <= 1, or the level scan never ends")
        if self.start < 0:
            raise ValueError("start must be >= 0")
        if (1 - self.start) / self.step > MAX_LEVELS:
            raise ValueError(f"step gives more than {MAX_LEVELS} levels")
        if self.leading_anchor not in ANCHOR_MODES:
            raise ValueError(f"leading_anchor must be one of {ANCHOR_MODES}")
        if self.block_rows < 2 or self.max_series_rows < 1 or self.sort_rows < 1:
            raise ValueError("block_rows must be >= 2, max_series_rows and sort_rows >= 1")

    def levels(self) -> list[float]:
        """Kept fractions tried in order; the last is the first one >= 1."""
        out: list[float] = []
        p = float(self.start)
        while True:
            out.append(p)
            if p >= 1.0:
                return out
            p += self.step

    def with_(self, **kw: Any) -> "ThinConfig":
        return replace(self, **kw)

    @classmethod
    def from_row(cls, row: Sequence[Any], **kw: Any) -> "ThinConfig":
        """Build from the positional tuning row (12 values, 2..7 used)."""
        vals = list(row)
        p = CONFIG_POSITIONS
        return cls(
            threshold=int(vals[p["threshold"]]),
            pre=int(vals[p["pre"]]),
            post=int(vals[p["post"]]),
            target=float(vals[p["target"]]),
            start=float(vals[p["start"]]),
            step=float(vals[p["step"]]),
            **kw,
        )
