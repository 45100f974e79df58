"""A plain-Python scorer, written from the specification of the checks."""

from __future__ import annotations

PENALTY = dict(INVALID_PRICE_NEGATIVE=25, INVALID_VOLUME_NEGATIVE=20, UNKNOWN_EXCHANGE=15, OUT_OF_ORDER=30, DUPLICATE_TIMESTAMP=10, LARGE_GAP=5, EXTREME_PRICE_MOVE=20, LARGE_PRICE_MOVE=5, PRICE_ANOMALY=10, EXTREME_VOLUME_SPIKE=15, VOLUME_SPIKE=5, EXCESSIVE_PRECISION=5, STALE_DATA=15, DELAYED_DATA=5, FUTURE_TIMESTAMP=20)
VALID = {"binance", "kraken", "bybit", "deribit", "coinbase"}


def score(ticks: list[dict]) -> dict[int, tuple[float, list[str]]]:
    """seq -> (score, issues) for ticks with seq, symbol, exchange, price, volume, ts_ms, now_ms."""
    state: dict[str, list] = {}
    out = {}
    for t in sorted(ticks, key=lambda t: t["seq"]):
        found = []
        p, v, ts = t["price"], t["volume"], t["ts_ms"]
        last_ts, last_p, pe, ve = state.get(t["symbol"], [None] * 4)
        found += ["INVALID_PRICE_NEGATIVE"] * (p <= 0) + ["INVALID_VOLUME_NEGATIVE"] * (v < 0) + ["UNKNOWN_EXCHANGE"] * (t["exchange"] not in VALID)
        if last_ts is not None:
            d = ts - last_ts
            found += ["OUT_OF_ORDER"] if d < 0 else ["DUPLICATE_TIMESTAMP"] if d == 0 else ["LARGE_GAP"] if d > 60000 else []
        if last_p:
            m = abs(p - last_p) / last_p
            found += ["EXTREME_PRICE_MOVE"] if m > 0.10 else ["LARGE_PRICE_MOVE"] if m > 0.05 else []
        pe = p if pe is None else 0.1 * p + 0.9 * pe
        ve = v if ve is None else 0.1 * v + 0.9 * ve
        found += ["PRICE_ANOMALY"] * (pe > 0 and abs(p - pe) / pe > 0.15)
        if ve > 0:
            found += ["EXTREME_VOLUME_SPIKE"] if v / ve > 100 else ["VOLUME_SPIKE"] if v / ve > 10 else []
        s = repr(p)
        found += ["EXCESSIVE_PRECISION"] * ("." in s and len(s.split(".")[1]) > 8)
        age = t["now_ms"] - ts
        found += ["STALE_DATA"] if age > 30000 else ["DELAYED_DATA"] if age > 10000 else ["FUTURE_TIMESTAMP"] if age < -5000 else []
        state[t["symbol"]] = [ts, p, pe, ve]
        out[t["seq"]] = (max(0, 100 - sum(PENALTY[f] for f in found)) / 100, found)
    return out
