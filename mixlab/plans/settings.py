"""Parameters of the registered queries: channels, carry-over, coefficients, dates."""

from __future__ import annotations

from mixlab.config import CHANNEL_PARAMS
from mixlab.operators.model import LinearScorer
from mixlab.sources.retail import RETAIL_CHANNELS

CHANNELS = RETAIL_CHANNELS

# The six product types take the parameters of the first six media channels.
PARAMS = dict(zip(CHANNELS, CHANNEL_PARAMS.values()))

# A fixed linear model, so that attribution can be stated in SQL as well.
INTERCEPT = 150000.0
COEFS = {
    "economy_adstock": 52000.0,
    "large_adstock": 31000.0,
    "medium_adstock": 24000.0,
    "promo_adstock": 9000.0,
    "small_adstock": -4000.0,
    "standard_adstock": 1500.0,
    "day_of_week": 350.0,
    "is_weekend": -900.0,
}
SCORER = LinearScorer(INTERCEPT, COEFS)

TRAIN_END = "2000-01-01"
TEST_START = "2000-01-02"
RANGE = ("1996-01-01", "1999-12-31")
TOTAL, MIN_PCT, MAX_PCT = 100000.0, 0.05, 0.4
GRID = {"decay_rate": (0.3, 0.5, 0.7), "k": (0.5, 0.8), "S": (2000.0, 10000.0)}
SEED = 42
