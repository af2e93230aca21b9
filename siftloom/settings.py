"""Settings shared by every check and cleaning step.

Two behaviours are offered where the coded and the documented rules differ:
``mode="intent"`` (default) follows the documented rule, ``mode="as_coded"``
reproduces the coded one.
"""

from __future__ import annotations

from dataclasses import dataclass

INTENT = "intent"
AS_CODED = "as_coded"

# Words that count as missing when a number is parsed.
NUMERIC_MISSING_WORDS = (
    "", "NA", "N/A", "na", "n/a",
    "null", "NULL", "undefined", "Undefined", "UNDEFINED",
)

# Date orders, tried first to last.
DATE_ORDERS = (
    "ymd HMS", "ymd HM", "ymd",
    "mdy HMS", "mdy HM", "mdy",
    "dmy HMS", "dmy HM", "dmy",
)


@dataclass(frozen=True)
class Settings:
    """Thresholds and behaviour switches; the defaults are the documented values."""

    mode: str = INTENT
    row_id: str = "row_number"
    iqr_multiplier: float = 1.5
    long_text: int = 200
    high_missing_pct: float = 30.0
    price_outlier: float = 10_000.0
    numeric_missing_words: tuple[str, ...] = NUMERIC_MISSING_WORDS
    date_orders: tuple[str, ...] = DATE_ORDERS

    def __post_init__(self) -> None:
        if self.mode not in (INTENT, AS_CODED):
            raise ValueError(f"mode must be {INTENT!r} or {AS_CODED!r}, not {self.mode!r}")

    @property
    def as_coded(self) -> bool:
        return self.mode == AS_CODED

    def data_columns(self, columns: list[str]) -> list[str]:
        """Columns that hold data: the row id is bookkeeping, except as coded."""
        return [c for c in columns if self.as_coded or c != self.row_id]


DEFAULT = Settings()
CODED = Settings(mode=AS_CODED)
