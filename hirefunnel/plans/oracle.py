"""The catalogue's queries as plain SQL on the supplied tables, for DuckDB.

Written independently of the Spark code: amounts are whole cents, keys are compared with
IS NOT DISTINCT FROM, and merges are full joins.
"""

from __future__ import annotations

from hirefunnel.fixtures import BATCH_STAMP, SPLIT, STREAM_STAMP
from hirefunnel.plans.catalogue import LOOKUP_JOB, NEWEST
from hirefunnel.schema import BATCH, INCREMENTAL, LATE, STREAM

_UUID = (
    "substr({h}, 9, 8) || '-' || substr({h}, 5, 4) || '-1' || substr({h}, 2, 3)"
    " || '-8000-000000000000'"
).format(h="format('{:016x}', epoch_us(ts) * 10 + 122192928000000000)")

_BASE = f"""
WITH tracking AS (
  SELECT {_UUID} AS create_time, ts,
         cast(CASE WHEN k % 2 = 0 THEN user_id % 5 ELSE user_id END AS integer) AS job_id,
         CASE event_type WHEN 'signup' THEN 'conversion' WHEN 'purchase' THEN 'qualified'
                         WHEN 'error' THEN 'unqualified' ELSE event_type END AS custom_track,
         CASE WHEN k % 13 <> 0 THEN value END AS bid,
         CASE WHEN k % 11 <> 0 THEN k % 2 END AS publisher_id,
         cast(k % 2 AS varchar) AS campaign_id,
         CASE WHEN k % 7 <> 0 THEN cast(k % 2 AS varchar) END AS group_id
  FROM (SELECT *, cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS integer) AS k FROM events)
), job AS (
  SELECT cast(c_custkey + 1 AS integer) AS job_id, cast(c_nationkey AS varchar) AS company_id,
         c_mktsegment AS campaign_id, cast(nullif(n_regionkey, 0) AS varchar) AS group_id
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_EVENT_KEYS = "job_id, publisher_id, campaign_id, group_id"
_COUNTS = "clicks, conversion, qualified_application, disqualified_application"
_FACT = f"dates, hours, {_EVENT_KEYS}, company_id, spend_hour, {_COUNTS}, updated_at, sources"


def _cents(total: str, divisor: str) -> str:
    return f"((2 * {total} + {divisor}) // (2 * {divisor})) / 100.0"


def _metrics(source: str = "tracking", keys: str = _EVENT_KEYS) -> str:
    return f"""
  SELECT dates, hours, {keys},
         {_cents('cents', '1')} AS spend_hour,
         CASE WHEN bids > 0 THEN {_cents('cents', 'bids')} END AS bid_set,
         {_COUNTS}
  FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS dates, cast(hour(ts) AS integer) AS hours, {keys},
           cast(coalesce(sum(round(bid * 100)) FILTER (custom_track = 'click'), 0) AS bigint) AS cents,
           count(bid) FILTER (custom_track = 'click') AS bids,
           count(*) FILTER (custom_track = 'click') AS clicks,
           count(*) FILTER (custom_track = 'conversion') AS conversion,
           count(*) FILTER (custom_track = 'qualified') AS qualified_application,
           count(*) FILTER (custom_track = 'unqualified') AS disqualified_application
    FROM {source} GROUP BY ALL
  )"""


def _fact(source: str, label: str, stamp: str) -> str:
    return f"""
  SELECT {_FACT.replace('job_id', 'm.job_id').replace('company_id', 'j.company_id')
          .replace('campaign_id', 'm.campaign_id').replace('group_id', 'm.group_id')}
  FROM (SELECT *, TIMESTAMP '{stamp}' AS updated_at, '{label}' AS sources FROM ({_metrics(source)})) m
  LEFT JOIN job j ON m.job_id = j.job_id"""


_BEFORE = f"(SELECT * FROM tracking WHERE ts < TIMESTAMP '{SPLIT}')"
_BATCH_FACT = _fact("tracking", BATCH, BATCH_STAMP)


def _same(left: str, right: str) -> str:
    keys = ["dates", "hours", *_EVENT_KEYS.split(", ")]
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)


def _replaced(stored: str, rows: str) -> str:
    """Full join in which the new row wins."""
    picked = ", ".join(
        f"CASE WHEN n.updated_at IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
        for c in _FACT.split(", ")
    )
    return f"SELECT {picked} FROM ({stored}) o FULL JOIN ({rows}) n ON {_same('o', 'n')}"


def _added(stored: str, rows: str) -> str:
    """Full join that adds the measures."""
    either = ["dates", "hours", *_EVENT_KEYS.split(", "), "company_id", "updated_at", "sources"]
    picked = [f"CASE WHEN n.updated_at IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in either]
    picked += [f"coalesce(o.{c}, 0) + coalesce(n.{c}, 0) AS {c}" for c in _COUNTS.split(", ")]
    picked.append(
        "round((coalesce(o.spend_hour, 0) + coalesce(n.spend_hour, 0)) * 100) / 100.0 AS spend_hour"
    )
    return f"SELECT {', '.join(picked)} FROM ({stored}) o FULL JOIN ({rows}) n ON {_same('o', 'n')}"


def _kind(kind: str, count: str, fill: bool = True) -> str:
    def key(c: str, zero: str) -> str:
        return f"coalesce({c}, {zero}) AS {c}" if fill else c

    bid = "coalesce(bid, 0)" if fill else "bid"
    micros = f"cast(round({bid} * 1000000) AS bigint)"
    money = (
        f", sum({micros})::bigint / nullif(count({bid}), 0) / 1000000 AS bid_set"
        f", sum({micros})::bigint / 1000000 AS spend_hour"
        if kind == "click"
        else ""
    )
    return f"""
  SELECT {key('job_id', '0')}, cast(ts AS date) AS date, cast(hour(ts) AS integer) AS hour,
         {key('publisher_id', '0')}, {key('campaign_id', "'0'")}, {key('group_id', "'0'")},
         count(*) AS {count} {money}
  FROM tracking WHERE custom_track = '{kind}'
  GROUP BY {', '.join(key(c, z).split(' AS ')[0] for c, z in (('job_id', '0'), ('publisher_id', '0'), ('campaign_id', "'0'"), ('group_id', "'0'")))}, cast(ts AS date), hour(ts)"""


_SPARSE_KEYS = ["job_id", "date", "hour", "publisher_id", "campaign_id", "group_id"]


def _full_join(fill_keys: bool, fill: bool) -> str:
    out = _kind("click", "clicks", fill_keys)
    have = ["bid_set", "spend_hour", "clicks"]
    for kind, count in (
        ("conversion", "conversions"),
        ("qualified", "qualified"),
        ("unqualified", "unqualified"),
    ):
        on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in _SPARSE_KEYS)
        keys = ", ".join(
            f"CASE WHEN b.{count} IS NOT NULL THEN b.{k} ELSE a.{k} END AS {k}" for k in _SPARSE_KEYS
        )
        out = (
            f"SELECT {keys}, {', '.join('a.' + c for c in have)}, b.{count}"
            f" FROM ({out}) a FULL JOIN ({_kind(kind, count, fill_keys)}) b ON {on}"
        )
        have.append(count)
    if fill:
        zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in have)
        out = f"SELECT {', '.join(_SPARSE_KEYS)}, {zeros} FROM ({out})"
    return out


def _dimension_metrics(label: str | None = None, stamp: str | None = None, log: str = "tracking") -> str:
    """Every event joined to its job first, then grouped."""
    joined = f"""(SELECT t.ts, t.job_id, t.custom_track, t.bid, t.publisher_id,
                        j.campaign_id, j.group_id, j.company_id
                 FROM {log} t LEFT JOIN job j ON t.job_id = j.job_id)"""
    rows = _metrics(joined, f"{_EVENT_KEYS}, company_id")
    if label is None:
        return rows
    return (
        f"SELECT {_FACT} FROM (SELECT *, TIMESTAMP '{stamp}' AS updated_at,"
        f" '{label}' AS sources FROM ({rows}))"
    )


def _json(name: str, text: bool = True) -> str:
    value = f"""'"' || {name} || '"'""" if text else name
    return f"""'"{name.split('::')[0]}":' || {value}"""


_MESSAGE = f"""
SELECT cast(job_id AS varchar) AS key,
       '{{' || concat_ws(',', {_json('job_id', False)}, {_json('custom_track')},
         '"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '"', {_json('publisher_id', False)},
         {_json('bid')}, {_json('campaign_id')}, {_json('group_id')}, {_json('create_time')}) || '}}' AS value
FROM tracking"""

_SINK_MARK = f"(SELECT max(ts) FROM {_BEFORE})"
_STREAM_FACT = _fact("tracking", STREAM, STREAM_STAMP)
_TOTALS = f"""
  SELECT job_id, sum(clicks)::bigint AS clicks, sum(conversion)::bigint AS conversions,
         sum(qualified_application)::bigint AS qualified
  FROM ({_metrics()}) GROUP BY job_id"""
_LAGGING = _fact(_BEFORE, STREAM, STREAM_STAMP)


def _drift() -> str:
    counts = _COUNTS.split(", ")
    keys = ", ".join(
        f"CASE WHEN b.sources IS NOT NULL THEN b.{k} ELSE s.{k} END AS {k}"
        for k in ["dates", "hours", *_EVENT_KEYS.split(", ")]
    )
    columns = ", ".join(
        f"coalesce(b.{c}, 0) AS {c}_batch, coalesce(s.{c}, 0) AS {c}_stream,"
        f" coalesce(b.{c}, 0) - coalesce(s.{c}, 0) AS {c}_drift"
        for c in counts
    )
    return (
        f"SELECT {keys}, {columns} FROM ({_BATCH_FACT}) b"
        f" FULL JOIN ({_LAGGING}) s ON {_same('b', 's')}"
    )


def _relabel(fact: str, label: str) -> str:
    return f"SELECT * REPLACE ('{label}' AS sources) FROM ({fact})"


_FINE = """(SELECT * REPLACE (CASE WHEN group_id IS NULL AND campaign_id = '1'
                            THEN cast(round(bid * 100) AS bigint) * 1237 / 1e6 * 1e18
                            ELSE cast(round(bid * 100) AS bigint) * 1237 / 1e6 END AS bid)
           FROM tracking)"""


def _exact(label: str, stamp: str) -> str:
    """Fact rows of fine bids, added as whole thousand-millionths; the average and unusable bids."""
    amount = "try_cast(bid AS decimal(24,9))"
    return f"""
  SELECT dates, hours, m.job_id, publisher_id, m.campaign_id, m.group_id, j.company_id,
         ((2 * nanos + 10000000) // 20000000) / 100.0 AS spend_hour,
         CASE WHEN bids > 0 THEN ((2 * nanos + bids * 10000000) // (bids * 20000000)) / 100.0 END AS bid_set,
         unusable_bids, {_COUNTS}, TIMESTAMP '{stamp}' AS updated_at, '{label}' AS sources
  FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS dates, cast(hour(ts) AS integer) AS hours, {_EVENT_KEYS},
           cast(coalesce(sum({amount}) FILTER (custom_track = 'click'), 0) * 1000000000 AS hugeint) AS nanos,
           count({amount}) FILTER (custom_track = 'click') AS bids,
           count(*) FILTER (custom_track = 'click' AND bid IS NOT NULL AND {amount} IS NULL) AS unusable_bids,
           count(*) FILTER (custom_track = 'click') AS clicks,
           count(*) FILTER (custom_track = 'conversion') AS conversion,
           count(*) FILTER (custom_track = 'qualified') AS qualified_application,
           count(*) FILTER (custom_track = 'unqualified') AS disqualified_application
    FROM {_FINE} GROUP BY ALL
  ) m LEFT JOIN job j ON m.job_id = j.job_id"""


_BAD = "((job_id = 1 AND group_id IS NULL) OR (job_id = 2 AND publisher_id IS NULL))"
_AHEAD = """(SELECT * FROM tracking UNION ALL
            SELECT * REPLACE (ts + INTERVAL 60 YEAR AS ts) FROM tracking
            WHERE job_id = 3 AND publisher_id IS NULL)"""
_AGREE = " AND ".join(f"{c}_drift = 0" for c in _COUNTS.split(", "))
_HOURS_FROM_MARK = f"date_trunc('hour', {_SINK_MARK} - INTERVAL 2 HOUR)"
_TOUCHED = f"(SELECT * FROM tracking WHERE ts >= {_HOURS_FROM_MARK})"

_SELECTS = {
    "hourly_metrics": f"""
        SELECT m.*, j.company_id, '{BATCH}' AS sources
        FROM ({_metrics()}) m LEFT JOIN job j ON m.job_id = j.job_id""",
    "hourly_metrics_dimension_keys": _dimension_metrics(),
    "hourly_metrics_known_only": _metrics(
        "(SELECT * FROM tracking WHERE custom_track IN"
        " ('click', 'conversion', 'qualified', 'unqualified'))"
    ),
    "hourly_metrics_filled": _metrics(
        "(SELECT * REPLACE (coalesce(job_id, 0) AS job_id, coalesce(publisher_id, 0) AS publisher_id,"
        " coalesce(campaign_id, '0') AS campaign_id, coalesce(group_id, '0') AS group_id) FROM tracking)"
    ),
    "job_hour_metrics": _metrics(keys="job_id"),
    "clicks_by_hour_sql": _kind("click", "clicks"),
    "conversions_by_hour_sql": _kind("conversion", "conversions"),
    "qualified_by_hour_sql": _kind("qualified", "qualified"),
    "unqualified_by_hour_sql": _kind("unqualified", "unqualified"),
    "metrics_full_join": _full_join(True, False),
    "metrics_full_join_null_keys": _full_join(False, True),
    "metrics_one_pass": f"""
        SELECT strftime(date, '%Y-%m-%d') AS dates, hour AS hours, {_EVENT_KEYS}, bid_set, spend_hour,
               clicks, conversions AS conversion, qualified AS qualified_application,
               unqualified AS disqualified_application
        FROM ({_full_join(True, False)})""",
    "event_scan": "SELECT * FROM tracking",
    "dimension_scan": "SELECT * FROM job",
    "dimension_ids": "SELECT cast(group_id AS integer) AS group_id FROM job WHERE group_id IS NOT NULL",
    "enriched_events": """
        SELECT t.job_id, t.create_time, t.ts, t.custom_track, t.bid, t.publisher_id,
               j.campaign_id, j.group_id, j.company_id
        FROM tracking t LEFT JOIN job j ON t.job_id = j.job_id""",
    "unmatched_jobs": f"""
        SELECT * FROM ({_metrics()}) m
        WHERE NOT EXISTS (SELECT 1 FROM job j WHERE j.job_id = m.job_id)""",
    "timeuuid_decode": f"""
        SELECT event_id, {_UUID} AS create_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
    "keyed_publish": _MESSAGE,
    "json_envelope_roundtrip": "SELECT * FROM tracking",
    "event_from_action": """
        SELECT ts, cast(user_id AS integer) AS job_id, event_type AS custom_track,
               cast(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS double) AS bid,
               cast(NULL AS integer) AS publisher_id, cast(NULL AS varchar) AS campaign_id,
               cast(NULL AS varchar) AS group_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS decoded, count(*) AS n, count(*) AS n_ids
        FROM events
        GROUP BY ts, user_id, event_type""",
    "high_water_mark": "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS mark FROM tracking",
    "new_data_gate": f"""
        SELECT max(ts) AS source_mark, {_SINK_MARK} AS sink_mark,
               max(ts) > {_SINK_MARK} AS has_new
        FROM tracking""",
    "incremental_delta": f"SELECT * FROM tracking WHERE ts > {_SINK_MARK}",
    "incremental_recompute": _replaced(
        _fact(_BEFORE, INCREMENTAL, STREAM_STAMP), _fact(_TOUCHED, INCREMENTAL, BATCH_STAMP)
    ),
    "data_time_stamp": f"""
        SELECT *, (SELECT max(ts) FROM tracking) AS updated_at FROM ({_metrics()})""",
    "merge_replace": _replaced(_fact(_BEFORE, BATCH, STREAM_STAMP), _BATCH_FACT),
    "merge_accumulate": _added(
        _LAGGING,
        _fact(f"(SELECT * FROM tracking WHERE ts >= TIMESTAMP '{SPLIT}')", STREAM, BATCH_STAMP),
    ),
    "append_rows": f"{_LAGGING} UNION ALL {_BATCH_FACT}",
    "batch_job": _BATCH_FACT,
    "batch_late_job": _dimension_metrics(BATCH, BATCH_STAMP),
    "batch_averages": _exact(BATCH, BATCH_STAMP),
    "batch_text_times": _fact(f"(SELECT * FROM tracking WHERE NOT {_BAD})", BATCH, BATCH_STAMP),
    "batch_rejects": f"""
        SELECT CASE WHEN job_id = 1 THEN 'unreadable time' ELSE 'no time' END AS reason,
               create_time, cast(job_id AS varchar) AS job_id, custom_track,
               CASE WHEN job_id = 1 THEN 'not a time' END AS ts, count(*) AS n
        FROM tracking WHERE {_BAD}
        GROUP BY job_id, create_time, custom_track, bid, publisher_id, campaign_id, group_id""",
    "batch_tombstones": _fact(
        "(SELECT * FROM tracking WHERE hour(ts) % 6 <> 0 AND publisher_id IS NOT NULL)",
        BATCH,
        BATCH_STAMP,
    ),
    "fact_of_version": _fact(_BEFORE, BATCH, STREAM_STAMP),
    "incremental_late_events": f"""
        SELECT * EXCLUDE (updated_at) FROM ({_fact(_AHEAD, INCREMENTAL, BATCH_STAMP)})""",
    "incremental_job": f"""
        SELECT * REPLACE (
          CASE WHEN cast(dates AS timestamp) + hours * INTERVAL 1 HOUR >= {_HOURS_FROM_MARK}
               THEN (SELECT max(ts) FROM tracking) ELSE {_SINK_MARK} END AS updated_at)
        FROM ({_fact('tracking', INCREMENTAL, BATCH_STAMP)})""",
    "stream_hourly_metrics": _STREAM_FACT,
    "stream_dimension_keys": _dimension_metrics(STREAM, STREAM_STAMP),
    "stream_hourly_watermarked": _STREAM_FACT,
    "stream_delta_metrics": _STREAM_FACT,
    "stream_deltas_fine_bids": _exact(STREAM, STREAM_STAMP),
    "job_list": "SELECT DISTINCT job_id FROM tracking WHERE job_id IS NOT NULL",
    "job_totals": _TOTALS,
    "job_lookup": f"SELECT * FROM tracking WHERE job_id = {LOOKUP_JOB}",
    "conversion_funnel": f"""
        SELECT job_id, cast(s.step AS integer) AS step, s.stage,
               CASE s.step WHEN 1 THEN clicks WHEN 2 THEN conversions ELSE qualified END AS value,
               CASE WHEN clicks > 0 THEN
                 {_cents('10000 * CASE s.step WHEN 1 THEN clicks WHEN 2 THEN conversions ELSE qualified END', 'clicks')}
               END AS percent_initial
        FROM ({_TOTALS}), (VALUES (1, 'Views'), (2, 'Applications'), (3, 'Qualified')) s(step, stage)""",
    "grand_total": """
        SELECT count(*) AS total FROM tracking WHERE custom_track IN ('click', 'conversion')""",
    "latest_by_source": f"{_LAGGING} ORDER BY updated_at DESC",
    "newest_per_source": f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (
                      PARTITION BY sources
                      ORDER BY updated_at DESC, dates DESC NULLS LAST, hours DESC NULLS LAST,
                               job_id NULLS FIRST, publisher_id NULLS FIRST, campaign_id NULLS FIRST,
                               group_id NULLS FIRST, company_id NULLS FIRST) AS rank
          FROM ({_LAGGING} UNION ALL {_BATCH_FACT}))
        WHERE rank <= {NEWEST}""",
    "capture_since": f"SELECT * FROM ({_MESSAGE} WHERE ts >= TIMESTAMP '{SPLIT}' - INTERVAL 1 MINUTE)",
    "stream_late_rows": f"""
        {_fact(f"(SELECT * FROM tracking WHERE ts >= TIMESTAMP '{SPLIT}')", STREAM, STREAM_STAMP)}
        UNION ALL {_fact(_BEFORE, LATE, STREAM_STAMP)}""",
    "stream_epochs_dimension": _dimension_metrics(
        STREAM, STREAM_STAMP, "(SELECT * FROM tracking UNION ALL SELECT * FROM tracking)"
    ),
    "recorded_counts": f"""
        SELECT 'broker' AS layer, count(*) AS n FROM tracking
        UNION ALL SELECT 'stream', count(*) FROM tracking
        UNION ALL SELECT 'warehouse', count(*) FROM tracking WHERE NOT {_BAD}
        UNION ALL SELECT 'quarantine', count(*) FROM tracking WHERE {_BAD}""",
    "layer_counts": """
        SELECT 'source' AS layer, count(*) AS n FROM tracking
        UNION ALL SELECT 'broker', count(*) FROM tracking
        UNION ALL SELECT 'warehouse', count(*) FROM tracking
                  WHERE custom_track IN ('click', 'conversion', 'qualified', 'unqualified')""",
    "drift_report": _drift(),
    "drift_agreement": f"""
        SELECT count(*) AS n_keys, count(*) FILTER ({_AGREE}) AS n_agree,
               count(*) FILTER ({_AGREE}) / count(*) AS agreement
        FROM ({_drift()})""",
    "corrected_view": _replaced(
        _fact("tracking", STREAM, BATCH_STAMP), _fact(_BEFORE, BATCH, STREAM_STAMP)
    ),
}

ORACLE = {name: f"{_BASE}\n{select}" for name, select in _SELECTS.items()}
