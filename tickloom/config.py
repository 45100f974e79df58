"""Thresholds, penalties and exchange sets, with a YAML overlay."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

# Exchange names, latency limits (ms), issue codes and penalties are data.
SCORING_EXCHANGES = ("binance", "kraken", "bybit", "deribit", "coinbase")
KNOWN_EXCHANGES = ("binance", "kraken", "bybit", "deribit", "coinbase", "okx", "huobi", "kucoin", "gate", "bitfinex")
LATENCY_LIMITS = {"binance": 100, "kraken": 200, "bybit": 150, "deribit": 100, "coinbase": 150, "okx": 150, "huobi": 200, "kucoin": 200, "gate": 250, "bitfinex": 150}
PENALTIES = {
    "INVALID_PRICE_NEGATIVE": 0.25,
    "INVALID_VOLUME_NEGATIVE": 0.20,
    "UNKNOWN_EXCHANGE": 0.15,
    "OUT_OF_ORDER": 0.30,
    "DUPLICATE_TIMESTAMP": 0.10,
    "LARGE_GAP": 0.05,
    "EXTREME_PRICE_MOVE": 0.20,
    "LARGE_PRICE_MOVE": 0.05,
    "PRICE_ANOMALY": 0.10,
    "EXTREME_VOLUME_SPIKE": 0.15,
    "VOLUME_SPIKE": 0.05,
    "EXCESSIVE_PRECISION": 0.05,
    "STALE_DATA": 0.15,
    "DELAYED_DATA": 0.05,
    "FUTURE_TIMESTAMP": 0.20,
}
PARSE_ERROR = "PARSE_ERROR"


@dataclass(frozen=True)
class QualityConfig:
    """What the scorer compares with. ``compare_to_prior_ema`` measures volume spikes against the average before the tick."""

    valid_exchanges: tuple[str, ...] = SCORING_EXCHANGES
    latency_limits: dict[str, int] = field(default_factory=lambda: dict(LATENCY_LIMITS))
    penalties: dict[str, float] = field(default_factory=lambda: dict(PENALTIES))
    extreme_move: float = 0.10
    large_move: float = 0.05
    ema_deviation: float = 0.15
    ema_alpha: float = 0.1
    extreme_volume: float = 100.0
    large_volume: float = 10.0
    stale_ms: int = 30_000
    delayed_ms: int = 10_000
    future_ms: int = 5_000
    gap_ms: int = 60_000
    max_decimals: int = 8
    low_quality: float = 0.7
    compare_to_prior_ema: bool = False

    def penalty(self, issue: str) -> float:
        """Penalty of an issue code; unknown codes cost nothing."""
        return self.penalties.get(issue, 0.0)

    def is_valid_exchange(self, exchange: str) -> bool:
        return exchange.lower() in self.valid_exchanges


#: YAML key -> field, for the names that operators of the service use.
_YAML = {
    "max_price_deviation_pct": "extreme_move",
    "large_price_move_pct": "large_move",
    "ema_deviation_threshold": "ema_deviation",
    "extreme_volume_spike": "extreme_volume",
    "large_volume_spike": "large_volume",
    "stale_data_threshold_ms": "stale_ms",
    "delayed_data_threshold_ms": "delayed_ms",
    "future_timestamp_threshold_ms": "future_ms",
    "large_gap_threshold_ms": "gap_ms",
    "max_decimal_places": "max_decimals",
    "penalties": "penalties",
}


def load_config(path: str | None = None, base: QualityConfig | None = None) -> QualityConfig:
    """Defaults overlaid by the ``exchanges`` and ``quality`` sections of a YAML file; other keys are ignored."""
    base = base or QualityConfig()
    if path is None:
        return base
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    found: dict = {_YAML[k]: v for k, v in (data.get("quality") or {}).items() if k in _YAML}
    names = data.get("exchanges") or {}
    if "valid_exchanges" in names:
        found["valid_exchanges"] = tuple(names["valid_exchanges"])
    if "latency_thresholds" in names:
        found["latency_limits"] = {**base.latency_limits, **names["latency_thresholds"]}
    return dataclasses.replace(base, **found)
