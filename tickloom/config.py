"""Typed configuration of the stages. Every key is effective, unknown keys are refused."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from pathlib import Path

DEFAULT_WINDOWS = {"S": 5, "M": 20, "L": 50, "XL": 200}


class ConfigError(ValueError):
    pass


def _check(condition: bool, message: str) -> None:
    if not condition:
        raise ConfigError(message)


def duration_us(text: str | int | None) -> int:
    """Digits, blanks, and one of d, h, m, s, to microseconds. Nothing, none, 0 and 0s are zero."""
    if text in (None, 0) or str(text).strip().lower() in ("", "0", "0s", "none"):
        return 0
    m = re.fullmatch(r"(\d+)\s*([dhms])", str(text).strip().lower())
    _check(m is not None, f"not a duration: {text!r}")
    return int(m[1]) * {"d": 86_400, "h": 3_600, "m": 60, "s": 1}[m[2]] * 1_000_000


@dataclass(frozen=True)
class WrangleConfig:
    tick_size: int = 200
    lower: float = 0.01
    upper: float = 0.99

    def __post_init__(self):
        _check(self.tick_size > 0, "tick_size must be positive")
        _check(0 <= self.lower < self.upper <= 1, "lower and upper must be shares in order")


@dataclass(frozen=True)
class FeatureConfig:
    """block_rows: rows of a block of the halo layout; None: a window per series."""

    windows: dict[str, int] = field(default_factory=lambda: dict(DEFAULT_WINDOWS))
    anchor: str = "XL"
    corr_threshold: float = 0.85
    fit_fraction: float = 0.7
    clip_low: float = 0.001
    clip_high: float = 0.999
    fit_sample_rows: int = 300_000
    corr_sample_rows: int = 250_000
    fit_blocks: int = 5
    distinct_blocks: bool = False
    block_rows: int | None = 20_000

    def __post_init__(self):
        _check(bool(self.windows) and all(w >= 2 for w in self.windows.values()), "windows must have two rows at least")
        _check("S" in self.windows or not {"M", "L"} & set(self.windows), "windows M and L need S")
        _check(0 < self.corr_threshold <= 1, "corr_threshold must be in (0, 1]")
        _check(0 <= self.clip_low < self.clip_high <= 1, "clip quantiles must be shares in order")
        _check(self.fit_blocks >= 1, "fit_blocks must be positive")
        _check(self.block_rows is None or self.block_rows >= self.halo, "block_rows must not be below the halo")

    @property
    def anchor_rows(self) -> int:
        return self.windows.get(self.anchor, max(self.windows.values()))

    @property
    def halo(self) -> int:
        return max(self.windows.values()) + max(self.anchor_rows, max(self.windows.values())) + 12

    @property
    def fraction(self) -> float:
        return min(0.95, max(0.05, self.fit_fraction))


@dataclass(frozen=True)
class SplitConfig:
    start: str | None = "2023-01-01"
    end: str | None = "2025-12-01"
    train: float = 0.7
    val: float = 0.15
    mode: str = "time"
    boundary_drop: int = 0
    embargo: str = "0s"
    monotonic_check: bool = True
    monotonic_rows: int = 300_000

    def __post_init__(self):
        _check(self.mode in ("time", "row"), "mode must be time or row")
        _check(self.train > 0 and self.val > 0 and self.train + self.val < 1, "portions must be positive and leave a rest")
        _check(self.boundary_drop >= 0, "boundary_drop must not be negative")
        duration_us(self.embargo)

    @property
    def embargo_us(self) -> int:
        return duration_us(self.embargo)


@dataclass(frozen=True)
class LabelConfig:
    horizon: int = 50
    vol_mode: str = "ewm"
    vol_window: int = 50
    vol_ret_clip: float = 0.02
    atr_mode: str = "ewm"
    atr_window: int = 50
    pt_mult: float = 1.5
    sl_mult: float = 2.0
    min_vol: float = 1e-6
    min_move_cost_mult: float = 3.0
    min_move_buffer_bps: float = 0.5
    tie_break: str = "close_based"
    ret_clip: float = 0.20
    cost_k: float = 0.8
    slippage_k: float = 0.20
    slippage_pow: float = 0.50
    min_cost_bps: float = 0.6
    max_cost_bps: float = 6.0
    roundtrip: bool = True
    weight_cap: float = 50.0
    purge: bool = False
    purge_embargo: int = 0
    block_rows: int | None = 5_000

    def __post_init__(self):
        _check(self.horizon > 1, "horizon must be over 1")
        _check(self.vol_mode in ("ewm", "rolling_std") and self.atr_mode in ("ewm", "sma"), "unknown vol_mode or atr_mode")
        _check(self.vol_window >= 2 and self.atr_window >= 2, "vol_window and atr_window must have two rows at least")
        _check(self.pt_mult > 0 and self.sl_mult > 0, "multipliers must be positive")
        _check(self.tie_break in ("worst_case", "best_case", "close_based"), "unknown tie_break")
        _check(0 <= self.min_cost_bps <= self.max_cost_bps and self.max_cost_bps > 0, "cost bounds must be in order")
        _check(self.min_move_cost_mult >= 0 and self.min_move_buffer_bps >= 0, "the least move must not be negative")
        _check(self.cost_k >= 0 and self.slippage_k >= 0 and self.slippage_pow >= 0, "cost factors must not be negative")
        _check(self.ret_clip > 0 and self.vol_ret_clip > 0 and self.weight_cap > 0, "clips must be positive")
        _check(self.purge_embargo >= 0 and self.min_vol > 0, "purge_embargo and min_vol out of range")

    @property
    def least_rows(self) -> int:
        return self.horizon + max(self.vol_window, self.atr_window) + 5


@dataclass(frozen=True)
class PipelineConfig:
    wrangle: WrangleConfig = WrangleConfig()
    features: FeatureConfig = field(default_factory=FeatureConfig)
    split: SplitConfig = SplitConfig()
    labels: LabelConfig = LabelConfig()


STAGES = {"wrangle": WrangleConfig, "features": FeatureConfig, "split": SplitConfig, "labels": LabelConfig}


def from_dict(given: dict) -> PipelineConfig:
    """{"stage": {key: value}}; unknown stages and keys are errors."""
    _check(isinstance(given, dict), "a mapping of stages is needed")
    _check(set(given) <= set(STAGES), f"unknown stages: {sorted(set(given) - set(STAGES))}")
    made = {}
    for stage, values in given.items():
        known = {f.name for f in fields(STAGES[stage])}
        values = values or {}
        _check(isinstance(values, dict), f"{stage} must be a mapping")
        _check(set(values) <= known, f"unknown keys of {stage}: {sorted(set(values) - known)}")
        made[stage] = STAGES[stage](**values)
    return PipelineConfig(**made)


def _read(path: str) -> dict:
    import yaml

    if not Path(path).is_file():
        raise ConfigError(f"no such configuration: {path}")
    try:
        return yaml.safe_load(Path(path).read_text()) or {}
    except yaml.YAMLError as e:
        raise ConfigError(f"not YAML: {path}: {e}") from e


def load(path: str) -> PipelineConfig:
    return from_dict(_read(path))


#: The keys of a flat file, and the stage and key that each one means here.
FLAT = {
    "tick_bar_size": ("wrangle", "tick_size"), "starting_date": ("split", "start"), "end_date": ("split", "end"),
    "train_portion": ("split", "train"), "val_portion": ("split", "val"),
}
#: Keys that a flat file may hold without effect, unless all keys are asked for.
FLAT_IDLE = {
    "validation_portion": ("split", "val"), "horizon_bars": ("labels", "horizon"), "vol_window": ("labels", "vol_window"), "vol_windows": ("labels", "vol_window"),
    "vol_mode": ("labels", "vol_mode"), "vol_ret_clip": ("labels", "vol_ret_clip"), "pt_mult": ("labels", "pt_mult"), "sl_mult": ("labels", "sl_mult"),
    "cost_k_spread": ("labels", "cost_k"), "slippage_k": ("labels", "slippage_k"), "slippage_pow_speed": ("labels", "slippage_pow"), "min_cost_bps": ("labels", "min_cost_bps"),
    "max_cost_bps": ("labels", "max_cost_bps"), "cost_roundtrip": ("labels", "roundtrip"), "min_vol": ("labels", "min_vol"), "ret_clip": ("labels", "ret_clip"),
    "tie_break": ("labels", "tie_break"), "purge_mode": ("labels", "purge"), "purge_embargo_bars": ("labels", "purge_embargo"), "weight_cap": ("labels", "weight_cap"),
}
FLAT_NAMES = ("name", "version", "reports_name", "data_path")
#: What a flat file leaves open.
FLAT_DEFAULTS = {"starting_date": "2025-01-01", "end_date": "2025-12-01"}
PURGE_MODES = {"none": False, "nonoverlap": True}


@dataclass(frozen=True)
class FlatConfig:
    """source and report as named in the file; idle: its keys without effect."""

    source: str
    report: str
    stages: PipelineConfig
    idle: tuple[str, ...]


def from_flat(given: dict, all_keys: bool = False) -> FlatConfig:
    """A flat mapping of keys. Splits and labels take their defaults where a key of FLAT_IDLE stands, unless all_keys; unknown keys
    are errors. Of two keys with one meaning the one in FLAT counts. Numbers may be written as text (YAML reads 1e-6 as such)."""
    _check(isinstance(given, dict), "a mapping of keys is needed")
    known = {*FLAT, *FLAT_IDLE, *FLAT_NAMES}
    _check(set(given) <= known, f"unknown keys: {sorted(map(str, set(given) - known))}")
    meant = (FLAT_IDLE if all_keys else {}) | FLAT
    made: dict[str, dict] = {}
    for key, (stage, name) in meant.items():
        value = given.get(key, FLAT_DEFAULTS.get(key))
        if value is None:
            continue
        kind = type(getattr(STAGES[stage](), name))
        try:
            if key == "purge_mode":
                _check(str(value) in PURGE_MODES, f"unknown purge_mode: {value}")
                value = PURGE_MODES[str(value)]
            made.setdefault(stage, {})[name] = kind(value)
        except (TypeError, ValueError) as e:
            raise ConfigError(f"not a value of {key}: {value!r}") from e
    idle = () if all_keys else tuple(k for k in given if k in FLAT_IDLE)
    return FlatConfig(str(given.get("data_path") or "sample_data/raw_data/XAUUSD.csv"), str(given.get("reports_name") or "Default Report"), from_dict(made), idle)


def load_flat(path: str, all_keys: bool = False) -> FlatConfig:
    return from_flat(_read(path), all_keys)
