"""Column names, key lists and forecast parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names and defaults of the demand data model.
PRODUCT = "ProductId"
BRANCH = "BranchId"
COUNTRY = "CountryCode"
COUNTRY_NAME = "CountryName"
CURRENCY = "Currency"
DATE = "EffectiveDate"
TARGET_DATE = "ForecastDate"
DEMAND = "Demand"
FORECAST_DAY = "ForecastDay"
FORECAST_STEP = "ForecastStep"
WEEKDAY = "DayOfWeekName"

SERIES_KEYS = (PRODUCT, BRANCH, COUNTRY, CURRENCY)
SCALING_KEYS = (COUNTRY, CURRENCY, BRANCH)
STRING_COLUMNS = SERIES_KEYS

COUNTRY_NAMES = {"ZM": "Zambia"}


@dataclass(frozen=True)
class Quantiles:
    """Named quantile levels in ascending order; first, middle and last have roles."""

    levels: tuple[tuple[str, float], ...] = (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.levels]

    @property
    def probabilities(self) -> list[float]:
        return [p for _, p in self.levels]

    @property
    def low(self) -> str:
        return self.levels[0][0]

    @property
    def mid(self) -> str:
        return self.levels[len(self.levels) // 2][0]

    @property
    def high(self) -> str:
        return self.levels[-1][0]


@dataclass(frozen=True)
class ForecastSpec:
    """Parameters of a forecast run.

    ``day_offset=1`` numbers the first horizon day 2, so the ``<= horizon`` filter
    drops the last one; ``day_offset=0`` numbers days 1..horizon.
    """

    horizon: int = 10
    freq_days: int = 1
    batch_size: int = 100
    iterative_steps: int = 20
    day_offset: int = 1
    trailing_rows: int = 28
    weekday_weeks: int = 8
    quantiles: Quantiles = field(default_factory=Quantiles)
    keys: tuple[str, ...] = SERIES_KEYS
    scaling_keys: tuple[str, ...] = SCALING_KEYS

    @property
    def forecast_days(self) -> list[int]:
        """Day numbers kept by the horizon filter."""
        first = self.freq_days + self.day_offset
        last = self.horizon * self.freq_days + self.day_offset
        return [d for d in range(first, last + 1, self.freq_days) if d <= self.horizon * self.freq_days]
