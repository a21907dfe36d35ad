"""All registered queries."""

from pulseloom.plans import classify, cleaning, joining, messages, models, profiling, series, streams  # noqa: F401
from pulseloom.plans.base import REGISTRY  # noqa: F401

FLAGSHIP = "level_window_mean"
