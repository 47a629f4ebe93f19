"""Settings read once on the driver from the JSON configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# The media channels and their carry-over / saturation parameters.
CHANNELS = ("tv", "radio", "print", "social_media", "search", "email", "display")

CHANNEL_PARAMS = {
    "tv": {"decay_rate": 0.7, "max_lag": 14, "saturation_type": "hill", "k": 0.7, "S": 5000},
    "radio": {"decay_rate": 0.6, "max_lag": 7, "saturation_type": "hill", "k": 0.6, "S": 2000},
    "print": {"decay_rate": 0.5, "max_lag": 21, "saturation_type": "hill", "k": 0.5, "S": 3000},
    "social_media": {"decay_rate": 0.5, "max_lag": 5, "saturation_type": "hill", "k": 0.8, "S": 2500},
    "search": {"decay_rate": 0.4, "max_lag": 3, "saturation_type": "hill", "k": 0.9, "S": 4000},
    "email": {"decay_rate": 0.3, "max_lag": 4, "saturation_type": "hill", "k": 0.7, "S": 1000},
    "display": {"decay_rate": 0.5, "max_lag": 10, "saturation_type": "hill", "k": 0.6, "S": 2000},
}

# Lags, windows, and boosting rounds of the model and of the importance report.
DEFAULT_LAGS = (1, 7, 14, 28)
DEFAULT_WINDOWS = (7, 14, 30)
BOOSTING_ROUNDS = 500
IMPORTANCE_ROUNDS = 100

# The grid that tuning searches per channel, unless the configuration names another.
TUNING_GRID = {"decay_rate": (0.3, 0.5, 0.7), "k": (0.5, 0.8, 1.2), "S": (1000.0, 3000.0, 9000.0)}


@dataclass(frozen=True)
class MixConfig:
    """The settings the operators need, with the defaults of the JSON sections."""

    include_returns: bool = True
    start_date: str | None = None
    end_date: str | None = None
    train_end_date: str | None = None
    test_start_date: str | None = None
    remove_outliers: bool = True
    outlier_threshold: float = 3.0
    fill_strategy: str = "interpolate"
    lags: tuple[int, ...] | None = DEFAULT_LAGS
    windows: tuple[int, ...] | None = DEFAULT_WINDOWS
    seasonality: bool = True
    holidays: bool = True
    channels: tuple[str, ...] = CHANNELS
    channel_params: dict = field(default_factory=lambda: dict(CHANNEL_PARAMS))
    normalize: bool = False
    validate: bool = False
    folds: int = 3
    tuning: bool = False
    tuning_grid: dict = field(default_factory=lambda: dict(TUNING_GRID))
    rounds: int = BOOSTING_ROUNDS
    seed: int = 42
    budget: float = 100000.0
    min_pct: float = 0.05
    max_pct: float = 0.4

    @classmethod
    def from_dict(cls, raw: dict) -> "MixConfig":
        data = raw.get("data", {})
        prep = raw.get("preprocessing", {})
        feat = raw.get("feature_engineering", {})
        model = raw.get("modeling", {})
        opt = raw.get("optimization", {})
        lags = tuple(feat.get("lag_periods", DEFAULT_LAGS))
        windows = tuple(feat.get("rolling_windows", DEFAULT_WINDOWS))
        return cls(
            include_returns=data.get("include_returns", True),
            start_date=data.get("start_date", data.get("train_start_date")),
            end_date=data.get("end_date", data.get("test_end_date")),
            train_end_date=data.get("train_end_date"),
            test_start_date=data.get("test_start_date"),
            remove_outliers=prep.get("remove_outliers", True),
            outlier_threshold=float(prep.get("outlier_threshold", 3)),
            fill_strategy=prep.get("fill_missing_strategy", "interpolate"),
            lags=lags if feat.get("create_lag_features", True) else None,
            windows=windows if feat.get("create_rolling_features", True) else None,
            seasonality=feat.get("create_seasonality_features", True),
            holidays=feat.get("create_holiday_features", True),
            channels=tuple(raw.get("marketing_channels", CHANNELS)),
            normalize=prep.get("normalize_features", False),
            validate=model.get("validation_strategy") == "time_series_split",
            folds=model.get("num_validation_folds", 3),
            tuning=model.get("hyperparameter_tuning", False),
            tuning_grid=model.get("tuning_grid", dict(TUNING_GRID)),
            rounds=model.get("boosting_rounds", BOOSTING_ROUNDS),
            seed=model.get("random_state", 42),
            budget=float(opt.get("budget_constraint", 100000)),
            min_pct=opt.get("min_channel_budget_pct", 0.05),
            max_pct=opt.get("max_channel_budget_pct", 0.4),
        )

    @classmethod
    def from_json(cls, path: str) -> "MixConfig":
        with open(path) as handle:
            return cls.from_dict(json.load(handle))
