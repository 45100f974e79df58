"""Latency triangulation, provenance and heartbeat queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import heartbeat as hb
from tickloom.operators import provenance as pv
from tickloom.operators import triangulation as tri
from tickloom.sources import fixtures as fx

HOUR = 3_600_000
BEAT_TIMEOUT = 2 * HOUR


def _tri(s, d) -> DataFrame:
    return fx.triangulated(s, d)


def _detect(*which):
    def run(s, d) -> DataFrame:
        found = tri.detect(tri.with_state(_tri(s, d)), *[w() for w in which])
        return found.select("event_id", "source_id", "anomaly", F.round("severity", 6).alias("severity"), F.round("value", 4).alias("value"))

    return run


def _prov(s, d) -> DataFrame:
    return fx.provenance(s, d)


def _sources(s, d) -> DataFrame:
    """Reliability of every source: how often its events are no errors."""
    e = fx.table(s, d, "events")
    name = F.concat("event_type", F.lit("_"), (F.col("user_id") % 3).cast("string"))
    return e.groupBy(name.alias("source_id")).agg(F.avg((F.col("event_id") % 10 != 0).cast("double")).alias("uptime_ratio"), F.avg((F.col("event_id") % 7 == 0).cast("double")).alias("error_rate"))


def _verdicts(s, d) -> DataFrame:
    return pv.validate(_prov(s, d), _sources(s, d), pv.Rules(stale_ms=1800))


def _stats(s, d) -> DataFrame:
    out = pv.stats(_verdicts(s, d))
    show = F.array_join(F.transform(F.map_entries("rejection_reasons"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",")
    return out.withColumn("rejection_reasons", show).withColumn("accept_rate", F.round("accept_rate", 6))


def _beats(s, d) -> DataFrame:
    return fx.heartbeats(s, d)


def _checks(s, d) -> DataFrame:
    b = _beats(s, d).select("strategy_id").distinct()
    return b.withColumn("check_ms", F.explode(F.sequence(F.lit(fx.AS_OF_EVENTS_MS - 720 * HOUR), F.lit(fx.AS_OF_EVENTS_MS), F.lit(6 * HOUR))))


QUERIES = {
    "tri_latencies": lambda s, d: tri.latencies(_tri(s, d)).select("event_id", "source_id", "network_ms", "processing_ms", "total_ms"),
    "ts_regression": _detect(tri.regression),
    "latency_spike": _detect(tri.spike),
    "data_bunching": _detect(tri.bunching),
    "clock_drift": _detect(tri.drift),
    "anomaly_union": lambda s, d: tri.detect(tri.with_state(_tri(s, d))).groupBy("source_id", "anomaly").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("severity"), 6).alias("worst")),
    "latency_metrics": lambda s, d: tri.metrics(_tri(s, d)),
    "prometheus_lines": lambda s, d: tri.prometheus_lines(tri.metrics(_tri(s, d))),
    "data_hash": lambda s, d: _prov(s, d).select("event_id", pv.data_hash(F.col("symbol")).alias("data_hash")),
    "value_plausibility": lambda s, d: pv.plausibility(_prov(s, d)).select("event_id", "plausibility"),
    "ts_consistency": lambda s, d: pv.consistency(_prov(s, d)).select("event_id", F.round("consistency", 6).alias("consistency")),
    "source_reliability": lambda s, d: pv.reliability(_prov(s, d), _sources(s, d)).groupBy("source_id").agg(F.round(F.max("reliability"), 6).alias("reliability")),
    "cross_source_agreement": lambda s, d: pv.cross_source(_prov(s, d)).select("event_id", F.round("cross", 6).alias("cross")),
    "provenance_score": lambda s, d: _verdicts(s, d).filter("quality IS NOT NULL").select("event_id", F.round("quality", 6).alias("quality")),
    "provenance_verdict": lambda s, d: _verdicts(s, d).select("event_id", "reject_reason"),
    "rejection_stats": _stats,
    "heartbeat_escalation": lambda s, d: hb.escalations(_beats(s, d), BEAT_TIMEOUT, fx.AS_OF_EVENTS_MS),
    "heartbeat_asof": lambda s, d: hb.as_of(_checks(s, d), _beats(s, d), BEAT_TIMEOUT),
}

_LAT = "WITH " + fx.TRI + ", lat AS (SELECT *, (receive_us - exchange_us) / 1000.0::DOUBLE AS network_ms, (process_us - receive_us) / 1000.0::DOUBLE AS processing_ms, (process_us - exchange_us) / 1000.0::DOUBLE AS total_ms FROM tri)"
_STATE = _LAT + """, st AS (SELECT *, row_number() OVER w AS n, lag(exchange_us) OVER w AS last_us,
  quantile_cont(network_ms, 0.5) OVER (PARTITION BY source_id ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS med,
  quantile_cont(network_ms, 0.5) OVER (PARTITION BY source_id ORDER BY event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS short,
  list(receive_us) OVER (PARTITION BY source_id ORDER BY event_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS rec
  FROM lat WINDOW w AS (PARTITION BY source_id ORDER BY event_id)),
base AS (SELECT source_id, quantile_cont(network_ms, 0.5) AS b FROM st WHERE n <= 100 GROUP BY 1 HAVING count(*) = 100),
x AS (SELECT st.*, b, len(list_filter(rec, lambda t: t > receive_us - 1000)) AS c, len(rec) AS nr FROM st LEFT JOIN base USING (source_id)),
a AS (
  SELECT event_id, source_id, 'TIMESTAMP_REGRESSION' AS anomaly, least(1.0, abs((exchange_us - last_us) / 1000.0::DOUBLE) / 1000) AS severity, (exchange_us - last_us) / 1000.0::DOUBLE AS value FROM x WHERE exchange_us - last_us < -10000
  UNION ALL SELECT event_id, source_id, 'LATENCY_SPIKE', CASE WHEN med = 0 THEN 1.0 ELSE least(1.0, (network_ms - med * 3) / (med * 3)) END, network_ms FROM x WHERE n >= 50 AND network_ms > med * 3 AND network_ms > 50
  UNION ALL SELECT event_id, source_id, 'DATA_BUNCHING', least(1.0, c / 30.0::DOUBLE), c::DOUBLE FROM x WHERE nr >= 10 AND c >= 10
  UNION ALL SELECT event_id, source_id, 'CLOCK_DRIFT', least(1.0, abs(short - b) / 300), short - b FROM x WHERE n >= 100 AND abs(short - b) > 100)"""
_MET = _LAT + """, l AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY event_id DESC) AS rn FROM lat QUALIFY rn <= 1000),
m AS (SELECT source_id, count(*) AS sample_count, quantile_cont(network_ms, 0.5) AS network_median_ms,
  list_sort(list(network_ms))[least(floor(count(*) * 0.99::DOUBLE)::BIGINT + 1, count(*))] AS network_p99_ms, quantile_cont(processing_ms, 0.5) AS processing_median_ms FROM l GROUP BY 1)"""


def _one(kind: str) -> str:
    return _STATE + f" SELECT event_id, source_id, anomaly, round(severity, 6) AS severity, round(value, 4) AS value FROM a WHERE anomaly = '{kind}'"


_FOLD = """, o AS (SELECT event_id, source_id, source_us, row_number() OVER (PARTITION BY source_id ORDER BY event_id) AS k FROM {src}),
f AS (SELECT source_id, k, event_id, source_us AS last, 1.0::DOUBLE AS score FROM o WHERE k = 1
  UNION ALL SELECT o.source_id, o.k, o.event_id, CASE WHEN o.source_us - f.last BETWEEN -100000 AND 10000000 THEN o.source_us ELSE f.last END,
    CASE WHEN o.source_us - f.last < -100000 THEN 0.0 WHEN o.source_us - f.last > 10000000 THEN 1 - least(1.0, (o.source_us - f.last) / 1e6 / 50) ELSE 1.0 END FROM f JOIN o ON o.source_id = f.source_id AND o.k = f.k + 1)"""
_PLAUS = """, pw AS (SELECT event_id, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM {src} WINDOW w AS (PARTITION BY symbol, data_type ORDER BY event_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)),
pz AS (SELECT event_id, CASE WHEN n < 10 THEN 0 ELSE abs(value - m) / CASE WHEN s < 1e-10 THEN CASE WHEN m <> 0 THEN abs(m) * 0.01 ELSE 1 END ELSE s END END AS z FROM pw),
plaus AS (SELECT event_id, CASE WHEN z <= 3 THEN 1.0 WHEN z <= 6 THEN 0.5 ELSE 0.0 END::DOUBLE AS plausibility FROM pz)"""
_CROSS = """, cg AS (SELECT event_id, source_id, value, symbol, data_type, source_us // 3600000 AS b FROM {src}),
cm AS (SELECT x.event_id, any_value(x.value) AS v, avg(y.value) AS m, count(y.value) AS n FROM cg x LEFT JOIN cg y ON x.symbol = y.symbol AND x.data_type = y.data_type AND x.b = y.b AND x.source_id <> y.source_id GROUP BY 1),
cr AS (SELECT event_id, n, CASE WHEN n = 0 THEN 1.0 WHEN m = 0 THEN 1.0 ELSE greatest(0.0, 1 - abs(v - m) / abs(m) * 10) END AS agree FROM cm)"""
_REL = """, src AS (SELECT event_type || '_' || (user_id % 3) AS source_id, least(1, greatest(0, avg((event_id % 10 <> 0)::INT) * 0.6 + (1 - avg((event_id % 7 = 0)::INT)) * 0.4)) AS r FROM events GROUP BY 1)"""
_PROV = "WITH RECURSIVE " + fx.PROVENANCE
_VERDICT = _PROV + ", fresh AS (SELECT * FROM prov WHERE staleness_ms <= 1800)" + _FOLD.format(src="fresh") + _PLAUS.format(src="fresh") + _CROSS.format(src="fresh") + _REL + """,
q AS (SELECT fresh.event_id, least(1, greatest(0, coalesce(r, 0.8) * 0.3 + f.score * 0.2 + plausibility * 0.3 + agree * 0.2)) AS quality
  FROM fresh JOIN f USING (event_id) JOIN plaus USING (event_id) JOIN cr USING (event_id) LEFT JOIN src ON src.source_id = fresh.source_id),
v AS (SELECT event_id, quality, CASE WHEN quality < 0.7 THEN 'quality_too_low' END AS reject_reason FROM q UNION ALL SELECT event_id, NULL, 'staleness_exceeded' FROM prov WHERE staleness_ms > 1800)"""
_BEATS = "WITH " + fx.HEARTBEATS + f""", g AS (SELECT *, coalesce(lead(ts_ms) OVER w, {fx.AS_OF_EVENTS_MS}) AS next_ms, coalesce(lag(positions_hash) OVER w <> positions_hash, false) AS hash_changed FROM heartbeats WINDOW w AS (PARTITION BY strategy_id ORDER BY ts_ms, event_id)),
m AS (SELECT *, greatest(0, (next_ms - 1) // {BEAT_TIMEOUT} - (ts_ms + {BEAT_TIMEOUT}) // {BEAT_TIMEOUT}) AS missed FROM g),
h AS (SELECT *, coalesce(max((missed >= 5)::INT) OVER (PARTITION BY strategy_id ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS halted, coalesce(lag(missed) OVER (PARTITION BY strategy_id ORDER BY ts_ms, event_id), 0) AS was FROM m)"""

ORACLES = {
    "tri_latencies": _LAT + " SELECT event_id, source_id, network_ms, processing_ms, total_ms FROM lat",
    "ts_regression": _one("TIMESTAMP_REGRESSION"),
    "latency_spike": _one("LATENCY_SPIKE"),
    "data_bunching": _one("DATA_BUNCHING"),
    "clock_drift": _one("CLOCK_DRIFT"),
    "anomaly_union": _STATE + " SELECT source_id, anomaly, count(*) AS n, round(max(severity), 6) AS worst FROM a GROUP BY ALL",
    "latency_metrics": _MET + " SELECT * FROM m",
    "prometheus_lines": _MET + """ SELECT format('tickloom_network_latency_median_ms{{source="{}"}} {:.2f}', source_id, network_median_ms) AS line FROM m
 UNION ALL SELECT format('tickloom_network_latency_p99_ms{{source="{}"}} {:.2f}', source_id, network_p99_ms) FROM m
 UNION ALL SELECT format('tickloom_processing_latency_median_ms{{source="{}"}} {:.2f}', source_id, processing_median_ms) FROM m""",
    "data_hash": _PROV + " SELECT event_id, substr(sha256(source_id || ':' || source_us || ':' || symbol), 1, 16) AS data_hash FROM prov",
    "value_plausibility": _PROV + _PLAUS.format(src="prov") + " SELECT event_id, plausibility FROM plaus",
    "ts_consistency": _PROV + _FOLD.format(src="prov") + " SELECT event_id, round(score, 6) AS consistency FROM f",
    "source_reliability": _PROV + _REL + " SELECT DISTINCT prov.source_id, round(coalesce(r, 0.8), 6) AS reliability FROM prov LEFT JOIN src USING (source_id)",
    "cross_source_agreement": _PROV + _CROSS.format(src="prov") + " SELECT event_id, round(agree, 6) AS cross FROM cr",
    "provenance_score": _VERDICT + " SELECT event_id, round(quality, 6) AS quality FROM q",
    "provenance_verdict": _VERDICT + " SELECT event_id, reject_reason FROM v",
    "rejection_stats": _VERDICT + " SELECT count(*) AS total_received, count(*) FILTER (reject_reason IS NULL) AS total_accepted, count(*) FILTER (reject_reason IS NOT NULL) AS total_rejected, round(count(*) FILTER (reject_reason IS NULL) / count(*), 6) AS accept_rate, 'quality_too_low=' || count(*) FILTER (reject_reason = 'quality_too_low') || ',staleness_exceeded=' || count(*) FILTER (reject_reason = 'staleness_exceeded') AS rejection_reasons FROM v",
    "heartbeat_escalation": _BEATS + " SELECT strategy_id, event_id, ts_ms, missed, CASE WHEN halted = 1 OR missed >= 5 THEN 'HALTED' WHEN missed >= 3 THEN 'CANCEL_ALL' WHEN missed >= 2 THEN 'ALERT' WHEN missed >= 1 THEN 'WARNING' ELSE 'NORMAL' END AS level, halted = 0 AND was > 0 AS recovers, halted = 0 AS accepted, hash_changed FROM h",
    "heartbeat_asof": "WITH " + fx.HEARTBEATS + f", c AS (SELECT strategy_id, unnest(range({fx.AS_OF_EVENTS_MS - 720 * HOUR}, {fx.AS_OF_EVENTS_MS} + 1, {6 * HOUR})) AS check_ms FROM (SELECT DISTINCT strategy_id FROM heartbeats)) SELECT *, coalesce(check_ms - last_ms > {BEAT_TIMEOUT}, false) AS late FROM (SELECT strategy_id, check_ms, (SELECT max(ts_ms) FROM heartbeats h WHERE h.strategy_id = c.strategy_id AND ts_ms <= check_ms) AS last_ms FROM c)",
}
