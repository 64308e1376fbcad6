"""SQL twins of the catalogue queries, for DuckDB on the same tables."""

from __future__ import annotations

from skytide.functions.timeconv import LEAP_SECONDS

_MEASURED = """
m AS (
  SELECT event_id, event_id AS candid, CAST(user_id AS VARCHAR) AS objectId, user_id, event_type AS topic, props,
         ts, epoch_us(ts) // 1000 AS ms, value,
         (epoch_us(ts) // 1000) / CAST(86400000 AS DOUBLE) + CAST(2440587.5 AS DOUBLE) AS jd,
         (epoch_us(ts) // 1000) / CAST(86400000 AS DOUBLE) + CAST(40587.0 AS DOUBLE) AS mjd,
         CAST(event_id % 3 + 1 AS INTEGER) AS fid,
         CASE WHEN event_id % 7 <> 0 THEN value END AS magpsf,
         value / 10 AS sigmapsf,
         CAST(18.0 + event_id % 5 AS DOUBLE) AS diffmaglim,
         value - 50 AS flux, value / 10 AS flux_err,
         (['u', 'g', 'r', 'i', 'z', 'y'])[CAST(event_id % 6 + 1 AS INTEGER)] AS band
  FROM events
)"""

# Every alert paired with its own point (pos 0) and its 30 earlier ones, oldest first.
_POINTS = _MEASURED + """,
h AS (
  SELECT *, list(struct_pack(jd := jd, fid := fid, magpsf := magpsf, sigmapsf := sigmapsf, diffmaglim := diffmaglim,
                             mjd := mjd, flux := flux, flux_err := flux_err, band := band))
            OVER (PARTITION BY user_id ORDER BY ms, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS past
  FROM m
),
a AS (
  SELECT *, list_concat([struct_pack(jd := jd, fid := fid, magpsf := magpsf, sigmapsf := sigmapsf,
                                     diffmaglim := diffmaglim, mjd := mjd, flux := flux, flux_err := flux_err,
                                     band := band)], coalesce(past, [])) AS pts
  FROM h
),
p AS (
  SELECT candid, objectId, user_id, ms, pts[len(pts)].jd AS jd_last, unnest(pts) AS pt,
         unnest(range(len(pts))) AS pos
  FROM a
)"""

_LOG = """
log AS (
  SELECT *, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part,
         row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS off
  FROM events
),
bounds AS (SELECT topic, part, min(off) AS lo, max(off) + 1 AS hi FROM log GROUP BY topic, part),
lags AS (
  SELECT topic, part, lo, hi,
         CASE WHEN part <> 3 THEN hi // 2 END AS committed,
         CASE WHEN part <> 3 THEN hi // 2 ELSE 0 END AS "offset",
         CASE WHEN part <> 3 THEN hi - hi // 2 ELSE hi - lo END AS lag
  FROM bounds
)"""

_BULK = """
log AS (
  SELECT event_id, user_id % 4 AS part,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS off
  FROM events
),
spent AS (
  SELECT part, sum(n) OVER (ORDER BY part) - n AS before
  FROM (SELECT part, count(*) AS n FROM log GROUP BY part)
)"""

_HALF = f"""
WITH {_BULK}
SELECT CAST(log.part AS INTEGER) AS "partition", off AS "offset", event_id
FROM log JOIN spent ON log.part = spent.part
WHERE spent.before + off < (SELECT count(*) // 2 FROM events)"""

_PLAIN = "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events"

_RECEIVED = "'2024-02-01 12:00:00'"
_ISO_MS = "strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S.%g')"

_LEAPS = ", ".join(f"(epoch_us(TIMESTAMP '{day}') // 1000 + {s} * 1000, {s})" for day, s in LEAP_SECONDS)

_STORE = """
WITH m AS (
  SELECT event_id AS candid, event_type AS topic, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS magpsf FROM events
)
SELECT candid, topic, CASE WHEN topic IN ({revised}) THEN magpsf + 1 ELSE magpsf END AS magpsf,
       strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM m"""

_IMAGES = """
im AS (
  SELECT vec_id, 'Science' AS kind, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS px FROM embeddings
  UNION ALL
  SELECT vec_id, 'Template', list_transform(embedding, lambda x: -CAST(x AS DOUBLE)) FROM embeddings
  UNION ALL
  SELECT vec_id, 'Difference', list_transform(embedding, lambda x: CAST(x AS DOUBLE)) FROM embeddings
)"""

_ROUTED = """
cfg(topic, kind, channel, secret_name) AS (
  VALUES ('view', 'telegram', '@views', 'tg'), ('view', 'slack', '#views', 'sl'), ('click', 'telegram', '@clicks', ''),
         ('error', 'telegram', '', 'tg'), ('purchase', 'slack', '#sales', 'sl')
),
o AS (
  SELECT e.event_id AS candid, e.event_type AS topic, k.kind, cfg.channel, e.user_id, e.ts,
         CASE WHEN cfg.topic IS NULL THEN 'no entry for topic' WHEN cfg.secret_name = '' THEN 'no secret'
              WHEN cfg.channel = '' THEN 'no channel' ELSE 'routed' END AS route_status
  FROM events e
  JOIN (VALUES ('telegram'), ('slack')) AS k(kind) ON TRUE
  LEFT JOIN cfg ON cfg.topic = e.event_type AND cfg.kind = k.kind
)"""


def _relative(anchor: str) -> str:
    return f"""
WITH {_POINTS}
SELECT candid, CAST(len(pts) AS INTEGER) AS n,
       list_min(list_transform(pts, lambda x: x.jd - {anchor})) AS d_min,
       list_max(list_transform(pts, lambda x: x.jd - {anchor})) AS d_max,
       pts[1].jd - {anchor} AS d_first
FROM a"""


ORACLE = {
    "detections_per_object": f"""
WITH {_POINTS}
SELECT objectId, strftime(make_timestamp(ms * 1000), '%m') AS month,
       CASE pt.fid WHEN 1 THEN 'g' ELSE 'r' END AS band,
       count(*) FILTER (pt.magpsf IS NOT NULL) AS n_detections,
       count(*) FILTER (pt.magpsf IS NULL) AS n_limits,
       max(coalesce(pt.magpsf, pt.diffmaglim)) AS y_max
FROM p WHERE pt.fid IN (1, 2) GROUP BY ALL""",
    "alert_summary_ztf": f"""
WITH {_MEASURED}
SELECT {_ISO_MS.format(ms="ms")} AS emitted, {_RECEIVED} AS received, topic, objectId, props AS cdsxmatch, magpsf FROM m""",
    "alert_summary_lsst": f"""
WITH {_MEASURED}
SELECT {_ISO_MS.format(ms="ms - 37000")} AS emitted, {_RECEIVED} AS received, topic,
       CASE WHEN user_id % 5 <> 0 THEN objectId ELSE 'SSO-' || objectId END AS id_value,
       CASE WHEN user_id % 5 <> 0 THEN 'diaObjectId' ELSE 'SSO desgination' END AS id_name
FROM m""",
    "alert_key": """
WITH k AS (
  SELECT event_id AS candid, event_type = 'error' AS is_mma, user_id,
         CASE WHEN event_type = 'error' THEN 'survey_' || (['grb_bronze', 'grb_silver', 'grb_gold', 'gw_bronze'])[CAST(event_id % 4 + 1 AS INTEGER)]
              ELSE event_type END AS topic
  FROM events
)
SELECT candid, topic, is_mma, user_id || '_' || CASE WHEN is_mma THEN 'T' ELSE '' END || candid AS alert_key FROM k""",
    "poll_rows": f"""
SELECT {_RECEIVED} AS timestamp, event_type AS topic, CAST(user_id AS VARCHAR) AS objectId,
       CAST(event_id % 3 + 1 AS INTEGER) AS roid
FROM events""",
    "topic_catalogue": """
SELECT DISTINCT
  CASE event_type WHEN 'view' THEN 'ftransfer_view' WHEN 'click' THEN 'fxmatch_click'
                  WHEN 'signup' THEN 'survey_ztf_signup' ELSE event_type END AS topic,
  CASE event_type WHEN 'view' THEN 'datatransfer' WHEN 'click' THEN 'xmatch'
                  WHEN 'signup' THEN 'stats' ELSE 'livestream' END AS service
FROM events WHERE event_type <> 'error'""",
    "date_partitions": """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n
FROM events GROUP BY ALL""",
    "date_partitions_nested": """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n
FROM events GROUP BY ALL""",
    "partition_fallback": """
SELECT 'class' AS strategy, event_type AS value, count(*) AS n FROM events GROUP BY ALL
UNION ALL
SELECT 'date', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY ALL
UNION ALL
SELECT 'none', '', count(*) FROM events""",
    "jd_to_mjd": f"WITH {_MEASURED} SELECT event_id, jd - CAST(2400000.5 AS DOUBLE) AS mjd FROM m",
    "tai_to_utc": f"""
WITH leap(start_ms, s) AS (VALUES {_LEAPS}),
t AS (SELECT event_id, epoch_us(ts) // 1000 - (event_id % 60) * 365 * 86400000 AS ms FROM events)
SELECT event_id, {_ISO_MS.format(ms="ms - (SELECT max(s) FROM leap WHERE start_ms <= ms) * 1000")} AS utc FROM t""",
    "relative_days_last": _relative("pts[len(pts)].jd"),
    "relative_days_first": _relative("pts[1].jd"),
    "extract_field": f"""
WITH {_POINTS}
SELECT candid, CAST(len(pts) AS INTEGER) AS n, array_to_string(list_transform(pts, lambda x: x.fid), ',') AS fids,
       CAST(len(list_filter(pts, lambda x: x.magpsf IS NULL)) AS INTEGER) AS n_missing,
       CAST(coalesce(len(past), -1) AS INTEGER) AS n_absent
FROM a""",
    "lightcurve_long": f"""
WITH {_POINTS}
SELECT candid, objectId, CAST(pos AS INTEGER) AS pos, pt.jd AS time, pt.jd - jd_last AS days_from_last,
       CASE pt.fid WHEN 1 THEN 'g' ELSE 'r' END AS band,
       CASE WHEN pt.magpsf IS NULL THEN 'upperlim' ELSE 'valid' END AS tag,
       coalesce(pt.magpsf, pt.diffmaglim) AS y
FROM p WHERE pt.fid IN (1, 2)""",
    "lightcurve_lsst": f"""
WITH {_POINTS},
q AS (
  SELECT candid, pt.band AS band, pt.flux AS f, pt.flux_err AS e,
         pt.flux > 0 AND pt.flux_err > 0 OR pt.flux = 0 AND pt.flux_err > 0 AS shown
  FROM p
)
SELECT candid AS diaSourceId, band, count(*) AS n_points, count(*) FILTER (shown) AS n_shown,
       round(min(CASE WHEN shown AND f > 0 THEN 31.4 - 2.5 * log10(f) WHEN shown THEN 'inf'::DOUBLE END), 6) AS mag_min,
       round(max(CASE WHEN shown AND f > 0 THEN 2.5 / ln(10) * e / f END), 9) AS magerr_max
FROM q GROUP BY ALL""",
    "bands_present": f"""
WITH {_MEASURED}
SELECT DISTINCT CASE WHEN user_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) ELSE 'SSO-' || user_id END AS object_id, band FROM m""",
    "display_rows": f"""
WITH {_MEASURED}
SELECT '2024-02-01 12:00:00 | ' || topic || ' | ' || objectId || ' | ' || coalesce(props, '-') || ' | ' ||
       coalesce(CAST(CAST(round(magpsf, 3) AS DECIMAL(12, 3)) AS VARCHAR), '-') AS line FROM m""",
    "missing_ids": f"""
WITH {_MEASURED}
SELECT candid AS "offset", CASE WHEN candid % 3 <> 0 THEN objectId || '_' || candid
       ELSE 'offset:' || topic || ':1:' || candid END AS alert_key FROM m""",
    "partial_start_offsets": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset" FROM log WHERE topic = 'view' AND (part <> 0 OR off >= 5)""",
    "avro_codecs": _PLAIN,
    "many_versions": """
SELECT event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS label,
       CASE WHEN event_id % 2 = 0 THEN round(value, 6) END AS value_legacy FROM events""",
    "encode_missing_fields": "SELECT event_id, TRUE AS no_tags, TRUE AS no_more FROM events",
    "wider_schema": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset", CASE WHEN topic <> 'click' THEN 'props' END AS dropped FROM log""",
    "poison_keys": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset", topic = 'view' AS failed, CASE WHEN topic <> 'view' THEN event_id END AS event_id
FROM log""",
    "backlog_after_drain": f"""
WITH {_BULK},
b AS (SELECT CAST(part AS INTEGER) AS part, count(*) AS n FROM log GROUP BY part)
SELECT 'ftransfer_ztf_2024-01-01_1' AS topic, part AS "partition", n AS "offset", 0 AS lag FROM b
UNION ALL
SELECT 'ftransfer_ztf_2024-01-01_1', NULL, CAST(sum(n) AS BIGINT), 0 FROM b""",
    "backlog_from_progress": f"""
WITH {_BULK},
b AS (SELECT CAST(part AS INTEGER) AS part, count(*) AS n FROM log GROUP BY part),
l AS (SELECT part, CASE WHEN part = 3 THEN 0 ELSE n // 2 END AS done, CASE WHEN part = 3 THEN n ELSE n - n // 2 END AS lag FROM b)
SELECT 'ftransfer_ztf_2024-01-01_1' AS topic, part AS "partition", done AS "offset", lag FROM l
UNION ALL
SELECT 'ftransfer_ztf_2024-01-01_1', NULL, CAST(sum(done) AS BIGINT), CAST(sum(lag) AS BIGINT) FROM l""",
    "transfer_progress": """
WITH n AS (SELECT count(*) AS n, 1 + count(*) // 2 // 2 AS step FROM events)
SELECT (n + step - 1) // step AS n_batches, step AS largest, n AS n_messages, n AS returned FROM n""",
    "one_message": f"""
WITH {_LOG}
SELECT topic AS asked, topic, min(part) AS "partition", arg_min("offset", part) AS "offset" FROM lags WHERE lag > 0 GROUP BY topic
UNION ALL
SELECT 'nothing', NULL, NULL, NULL""",
    "gzip_files": _PLAIN,
    "first_records": """
WITH r AS (
  SELECT event_id, event_type,
         row_number() OVER (ORDER BY list_position(['view', 'signup', 'click', 'error', 'purchase'], event_type), event_id) AS n
  FROM events
)
SELECT event_id, event_type FROM r WHERE n <= (SELECT count(*) // 3 FROM events)""",
    "idle_poll": """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", user_id || '_' || event_id AS alert_key FROM events""",
    "settled_store": """
SELECT event_id AS candid, event_type AS topic, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       CASE WHEN event_id % 7 <> 0 THEN value END
       + CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 2 WHEN 'error' THEN 3 ELSE 0 END AS magpsf
FROM events""",
    "live_throttle": """
WITH cfg(topic, kind, channel) AS (VALUES ('view', 'telegram', '@views'), ('view', 'slack', '#views'), ('purchase', 'slack', '#sales'))
SELECT kind, channel, count(*) AS n, count(*) AS n_slots, TRUE AS spaced, TRUE AS several_batches
FROM events e JOIN cfg ON cfg.topic = e.event_type GROUP BY kind, channel""",
    "cleaned_images": """
WITH px AS (
  SELECT vec_id, vec_id + generate_subscripts(embedding, 1) - 1 AS place, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings
),
k(kind, top) AS (VALUES ('Science', 3.4028234663852886e38), ('Template', 1.7976931348623157e308), ('Difference', 1.7976931348623157e308)),
c AS (
  SELECT vec_id, kind, CASE WHEN place % 7 = 0 THEN 0 WHEN place % 11 = 0 THEN top WHEN place % 13 = 0 THEN -top ELSE v END AS v FROM px, k
)
SELECT vec_id AS diaSourceId, kind, max(v) AS top, min(v) AS bottom, CAST(count(*) FILTER (v = 0) AS INTEGER) AS n_zero,
       round(sum(v) FILTER (abs(v) < 1e30), 5) AS total
FROM c GROUP BY vec_id, kind""",
    "backlog_after_live": """
SELECT event_type AS topic, count(*) AS total_offset, 0 AS total_lag, count(*) AS topic_size FROM events GROUP BY event_type""",
    "limited_generation": f"""
WITH {_BULK} SELECT CAST(part AS INTEGER) AS "partition", off AS "offset", event_id FROM log""",
    "restart_latest": """
WITH log AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS part,
         row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY epoch_us(ts) // 1000, event_id) - 1 AS off
  FROM events
)
SELECT event_type AS topic, part AS "partition", user_id || '_' || event_id AS alert_key FROM log WHERE off % 2 = 1""",
    "archive_evolved_schema": f"""
WITH {_MEASURED}
SELECT candid, CAST(fid AS BIGINT) AS fid, CASE WHEN topic <> 'signup' THEN diffmaglim END AS diffmaglim,
       CASE WHEN topic = 'signup' THEN 'revised' END AS note FROM m""",
    "quality_tags": f"""
WITH {_MEASURED},
t AS (
  SELECT *, CASE WHEN magpsf IS NULL THEN 'upperlim' WHEN sigmapsf > 10 THEN 'badquality' ELSE 'valid' END AS tag FROM m
)
SELECT candid, tag, CASE fid WHEN 1 THEN 'g' ELSE 'r' END AS band,
       CASE tag WHEN 'upperlim' THEN diffmaglim ELSE magpsf END AS y,
       CASE WHEN tag <> 'upperlim' THEN sigmapsf END AS y_err
FROM t WHERE fid IN (1, 2)""",
    "flux_to_mag": f"""
WITH {_MEASURED}
SELECT event_id AS diaSourceId,
       CASE WHEN flux > 0 THEN 'finite' WHEN flux = 0 THEN 'inf' ELSE 'nan' END AS mag_kind,
       CASE WHEN flux > 0 THEN round(31.4 - 2.5 * log10(CASE WHEN flux > 0 THEN flux ELSE 1 END), 6) END AS mag,
       CASE WHEN flux <> 0 THEN 'finite' WHEN flux_err = 0 THEN 'nan' ELSE 'inf' END AS magerr_kind,
       CASE WHEN flux <> 0 THEN round(2.5 / ln(10) * flux_err / CASE WHEN flux <> 0 THEN flux ELSE 1 END, 6) END AS magerr,
       CASE WHEN flux = 0 THEN flux_err > 0 ELSE flux_err / CASE WHEN flux <> 0 THEN flux ELSE 1 END > 0 END AS shown
FROM m""",
    "object_history": f"""
WITH {_MEASURED}
SELECT objectId, jd AS jd, fid, magpsf, sigmapsf AS sigmapsf, diffmaglim
FROM m WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "indexed_history": f"""
WITH {_MEASURED}
SELECT objectId, jd AS jd, fid, magpsf, sigmapsf AS sigmapsf, diffmaglim
FROM m WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "legal_topic_name": """
SELECT doc_id, lower(regexp_replace(source || ' ' || lang, '[^\\p{L}]', '', 'g')) AS topic FROM documents""",
    "legal_topic_text": """
SELECT doc_id, lower(regexp_replace(text, '[^\\p{L}]', '', 'g')) AS letters FROM documents""",
    "markdown_escape": """
SELECT doc_id, regexp_replace(text, '([_*\\[\\]()~>#+\\-=|{}.!])', '\\\\\\1', 'g') AS escaped FROM documents""",
    "tag_topic_name": """
SELECT 'survey_' || source || '_lsst' AS topic, count(*) AS n FROM documents GROUP BY ALL""",
    "topic_log": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM log""",
    "offset_lag": f"""
WITH {_LOG} SELECT topic, part AS "partition", lo, hi, committed, "offset", lag FROM lags""",
    "offset_totals": f"""
WITH {_LOG}
SELECT topic, CAST(sum("offset") AS BIGINT) AS total_offset, CAST(sum(lag) AS BIGINT) AS total_lag,
       CAST(sum("offset") + sum(lag) AS BIGINT) AS topic_size
FROM lags GROUP BY topic""",
    "nonempty_partitions": f"""
WITH {_LOG} SELECT topic, part AS "partition", lag FROM lags WHERE committed IS NOT NULL OR lag > 0""",
    "last_offsets": f"""
WITH {_LOG} SELECT topic, part AS "partition", coalesce(committed, 0) AS committed FROM lags""",
    "partition_counts": f"""
WITH {_LOG},
asked AS (SELECT DISTINCT topic FROM log UNION SELECT r_name FROM region)
SELECT asked.topic, count(DISTINCT part) AS n_partitions FROM asked LEFT JOIN log ON log.topic = asked.topic GROUP BY asked.topic""",
    "partition_sizes": f"""
WITH {_LOG} SELECT topic, part AS "partition", hi - lo AS size FROM bounds""",
    "backlog_report": f"""
WITH {_LOG}
SELECT topic, part AS "partition", "offset", lag FROM lags WHERE topic IN ('view', 'click')
UNION ALL
SELECT topic, NULL, CAST(sum("offset") AS BIGINT), CAST(sum(lag) AS BIGINT) FROM lags WHERE topic IN ('view', 'click') GROUP BY topic""",
    "start_offsets": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset" FROM log WHERE topic = 'view' AND off >= 10 * (part + 1)""",
    "avro_roundtrip": f"""
WITH {_POINTS}
SELECT objectId, candid, topic, props AS cdsxmatch, jd AS jd, magpsf, CAST(coalesce(len(past), 0) AS INTEGER) AS n_history,
       array_to_string(list_transform(past, lambda x: x.fid), ',') AS history_fids
FROM a""",
    "avro_files_roundtrip": _PLAIN,
    "avro_files_union": """
SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value,
       CASE WHEN event_type <> 'click' THEN props END AS props
FROM events""",
    "multi_schema_union": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset", event_type = 'error' AS replayed, event_id, value,
       CASE WHEN event_type <> 'click' THEN props END AS props
FROM log""",
    "dead_letters": f"""
WITH {_LOG}
SELECT topic, part AS "partition", off AS "offset",
       CASE topic WHEN 'click' THEN '1.0' WHEN 'error' THEN '2.0' ELSE '' END AS schema_id,
       TRUE AS no_alert, topic <> 'error' AS unknown_schema
FROM log WHERE topic IN ('click', 'error', 'purchase')""",
    "schema_table": """
SELECT event_type AS topic, 'event' AS schema_name, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "drain_archive": _PLAIN,
    "drain_avro": _PLAIN,
    "drain_resume": f"""
WITH log AS (SELECT CAST(user_id % 4 AS INTEGER) AS part, value FROM events)
SELECT part AS "partition", 2 * count(*) AS n, count(*) AS n_offsets, count(*) - 1 AS last_offset,
       round(2 * sum(value), 2) AS total_value
FROM log GROUP BY part""",
    "bounded_limit": _HALF,
    "bounded_resume": _HALF,
    "live_stream": """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", user_id || '_' || event_id AS alert_key,
       CASE WHEN event_id % 7 <> 0 THEN value END AS magpsf
FROM events""",
    "archive_overwrite": _STORE.format(revised="'signup', 'purchase'"),
    "archive_merge": _STORE.format(revised="'signup', 'purchase'"),
    "archive_ignore": _STORE.format(revised="'signup'"),
    "latest_per_object": """
SELECT CAST(user_id AS VARCHAR) AS objectId, event_id AS candid, event_type AS topic
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1""",
    "cutout_stats": f"""
WITH {_IMAGES}
SELECT vec_id AS diaSourceId, kind, CAST(len(px) // 8 AS INTEGER) AS height, 8 AS width, CAST(len(px) AS INTEGER) AS n_finite,
       round(list_min(px), 6) AS min, round(list_max(px), 6) AS max, round(list_avg(px), 6) AS mean
FROM im""",
    "cutouts_long": """
WITH px AS (
  SELECT vec_id, len(embedding) // 8 AS height, unnest(range(len(embedding))) AS i, unnest(embedding) AS v FROM embeddings
)
SELECT vec_id AS diaSourceId, kind, height - 1 - i // 8 AS y, round(sum(sign * CAST(v AS DOUBLE)), 5) AS row_sum,
       round(max(sign * CAST(v AS DOUBLE)), 6) AS row_max
FROM px, (VALUES ('Science', 1), ('Template', -1), ('Difference', 1)) AS k(kind, sign) GROUP BY ALL""",
    "object_cutout": """
SELECT vec_id AS diaSourceId, CAST(len(embedding) // 8 AS INTEGER) AS height,
       round(list_sum(list_transform(embedding[-8:], lambda x: CAST(x AS DOUBLE))), 5) AS top_row_sum
FROM embeddings WHERE label = 1""",
    "plain_fits": """
SELECT vec_id AS diaSourceId, kind, 2880 + 2880 * CAST(ceil(len(embedding) * 4 / 2880) AS INTEGER) AS n_bytes, 'SIMPLE' AS head
FROM embeddings, (VALUES ('Science'), ('Template'), ('Difference')) AS k(kind)""",
    "notification_outbox": f"""
WITH {_ROUTED},
n AS (
  SELECT event_id,
         CAST(count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id
                             ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS INTEGER) AS n_points
  FROM events
)
SELECT candid, topic, kind, channel, route_status,
       chr(10) || '*Object ID*: ' ||
       CASE WHEN kind = 'telegram' THEN '[' || user_id || '](https://ztf.portal.example.org/' || user_id || ')'
            ELSE 'https://ztf.portal.example.org/' || user_id END ||
       chr(10) || '*Topic*: `' || topic || '`' || chr(10) || '    ' AS text,
       n_points
FROM o JOIN n ON n.event_id = o.candid""",
    "outbox_throttle": f"""
WITH {_ROUTED},
q AS (
  SELECT *, row_number() OVER (PARTITION BY kind, channel ORDER BY topic, candid) - 1 AS pos FROM o
)
SELECT candid, kind, channel,
       CASE WHEN route_status = 'routed' THEN
         strftime(TIMESTAMP '2024-02-01 12:00:00' + to_seconds(pos * CASE kind WHEN 'telegram' THEN 10 ELSE 2 END), '%Y-%m-%d %H:%M:%S')
       END AS not_before
FROM q""",
}
