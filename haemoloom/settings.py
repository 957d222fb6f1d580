"""Parameters shared by the operators."""

from dataclasses import dataclass

BATCH = "batch"
SERVING = "serving"

_HOUR_US = 3_600_000_000


@dataclass(frozen=True)
class Settings:
    """Pipeline parameters.

    ``semantics`` picks between the two rule sets, which differ in three
    expressions:

    ==================  ==============================  =========================
    expression          ``batch``                       ``serving``
    ==================  ==============================  =========================
    session gap         whole elapsed hours > window    exact elapsed time > window
    dialysis vintage    calendar-year difference        whole days / 365.25
    minutes in session  whole minutes, toward zero      fractional minutes
    ==================  ==============================  =========================
    """

    # The defaults of the published parameters.
    session_window: int = 12  # hours
    interval: int = 15  # minutes per bin
    rolling_window: int = 3  # bins before the current one
    prediction_intervals: int = 5  # bins to look ahead
    threshold: float = 90.0  # mmHg, systolic
    semantics: str = BATCH

    def __post_init__(self):
        if self.semantics not in (BATCH, SERVING):
            raise ValueError(f"semantics must be '{BATCH}' or '{SERVING}', not '{self.semantics}'")
        if self.session_window < 0 or self.interval < 1 or self.rolling_window < 0:
            raise ValueError("session_window, interval and rolling_window must not be negative or zero-width")
        if self.prediction_intervals < 1:
            raise ValueError("prediction_intervals must be at least 1")

    @property
    def serving(self) -> bool:
        return self.semantics == SERVING

    @property
    def longest_pause_us(self) -> int:
        """Longest gap, in microseconds, that stays inside one session.

        Batch counts whole hours, so a gap splits only from ``window + 1``
        hours on; serving splits just past ``window`` hours.
        """
        if self.serving:
            return self.session_window * _HOUR_US
        return (self.session_window + 1) * _HOUR_US - 1

    @property
    def interval_us(self) -> int:
        return self.interval * 60_000_000
