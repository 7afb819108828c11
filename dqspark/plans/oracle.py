"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the rule definitions, not from the Spark code: doubles are
rounded to 6 places, timestamps formatted as text, sums cast to BIGINT.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%f'"

READINGS = """
readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS subject,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS entity,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS m1,
         CASE WHEN event_id % 211 = 0 THEN k * 20 ELSE k END AS m2,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 2 END AS m3,
         ts
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

CHECKED = READINGS + """,
checked AS (
  SELECT *,
         subject IS NULL AS missing_subject, entity IS NULL AS missing_entity,
         m1 IS NULL AS missing_m1, m2 IS NULL AS missing_m2,
         concat_ws(',', CASE WHEN subject IS NULL THEN 'subject' END,
                        CASE WHEN entity IS NULL THEN 'entity' END,
                        CASE WHEN m1 IS NULL THEN 'm1' END,
                        CASE WHEN m2 IS NULL THEN 'm2' END) AS missing_fields,
         (CASE WHEN subject IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN entity IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN m1 IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN m2 IS NOT NULL THEN 1 ELSE 0 END) AS completeness_score,
         CASE WHEN m1 IS NULL THEN NULL ELSE m1 BETWEEN 1 AND 150 END AS m1_valid,
         CASE WHEN m2 IS NULL THEN NULL ELSE m2 BETWEEN 5 AND 95 END AS m2_valid,
         CASE WHEN m3 IS NULL THEN NULL ELSE m3 BETWEEN 0 AND 45 END AS m3_valid
  FROM readings
)"""

SCORED = CHECKED + """,
stats AS (
  SELECT date_trunc('day', ts) AS w, entity, count(*) AS n,
         avg(m1) AS m1_mean, stddev_samp(m1) AS m1_stddev,
         avg(m2) AS m2_mean, stddev_samp(m2) AS m2_stddev
  FROM readings WHERE ts IS NOT NULL GROUP BY 1, 2
),
z AS (
  SELECT c.*, s.m1_mean, s.m1_stddev, s.m2_mean, s.m2_stddev,
         CASE WHEN s.m1_stddev IS NOT NULL AND s.m1_stddev > 0 THEN abs((c.m1 - s.m1_mean) / s.m1_stddev) ELSE 0 END AS m1_zscore,
         CASE WHEN s.m2_stddev IS NOT NULL AND s.m2_stddev > 0 THEN abs((c.m2 - s.m2_mean) / s.m2_stddev) ELSE 0 END AS m2_zscore
  FROM checked c LEFT JOIN stats s ON date_trunc('day', c.ts) = s.w AND c.entity = s.entity
),
flagged AS (SELECT *, m1_zscore > 3 AS m1_anomaly, m2_zscore > 3 AS m2_anomaly FROM z),
issued AS (
  SELECT *, (completeness_score < 4 OR m1_valid = false OR m2_valid = false OR m3_valid = false
             OR m1_anomaly = true OR m2_anomaly = true) AS has_issues
  FROM flagged
),
scored AS (
  SELECT *, CASE WHEN completeness_score < 4 THEN 25
                 WHEN has_issues = false THEN 100
                 WHEN m1_anomaly OR m2_anomaly THEN 50
                 WHEN m1_valid = false OR m2_valid = false OR m3_valid = false THEN 75
                 ELSE 100 END AS quality_score
  FROM issued
)"""

DAILY = SCORED + """,
daily AS (
  SELECT entity, CAST(ts AS DATE) AS date, count(*) AS total_records,
         count(*) FILTER (WHERE has_issues) AS records_with_issues,
         avg(quality_score) AS avg_quality_score, max(quality_score) AS max_quality_score,
         min(quality_score) AS min_quality_score, stddev_samp(quality_score) AS quality_variance
  FROM scored GROUP BY 1, 2
),
daily_m AS (
  SELECT *, records_with_issues / total_records * 100.0 AS issue_rate,
         CASE WHEN avg_quality_score >= 95 THEN 'excellent' WHEN avg_quality_score >= 85 THEN 'good'
              WHEN avg_quality_score >= 70 THEN 'fair' ELSE 'poor' END AS health_status
  FROM daily
)"""

DAILY_COLS = """entity, date, total_records, records_with_issues, round(avg_quality_score, 6) AS avg_quality_score,
  max_quality_score, min_quality_score, round(quality_variance, 6) AS quality_variance,
  round(issue_rate, 6) AS issue_rate, health_status"""

TRENDS = DAILY + """,
ma AS (
  SELECT *, avg(avg_quality_score) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_quality_score,
            avg(issue_rate) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_issue_rate
  FROM daily_m
),
tr AS (
  SELECT *, lag(ma7_quality_score, 1, 0.0) OVER (PARTITION BY entity ORDER BY date) AS prev_ma7 FROM ma
),
trends AS (
  SELECT *, CASE WHEN ma7_quality_score > prev_ma7 THEN 'improving' ELSE 'degrading' END AS trend_direction,
            ma7_quality_score - prev_ma7 AS quality_change
  FROM tr
)"""

# "+ 0.0" turns a rounded -0.0 (float noise below zero) into 0.0, as Spark's round does
TREND_COLS = DAILY_COLS + """, round(ma7_quality_score, 6) AS ma7_quality_score, round(ma7_issue_rate, 6) AS ma7_issue_rate,
  trend_direction, round(quality_change, 6) + 0.0 AS quality_change"""

LATEST = DAILY + """,
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date DESC) AS rn
                 FROM daily_m WHERE entity IS NOT NULL) t WHERE rn = 1
)"""

ISSUES = SCORED + """,
issues AS (
  SELECT subject, entity, m1, m2, m3, quality_score, completeness_score, m1_valid, m2_valid, m3_valid,
         m1_anomaly, m2_anomaly, ts AS detected_at,
         CASE quality_score WHEN 25 THEN 'critical' WHEN 50 THEN 'high' WHEN 75 THEN 'high' WHEN 100 THEN 'low' END AS severity
  FROM scored WHERE has_issues
)"""

ISSUE_COLS = f"""subject, entity, round(m1, 6) AS m1, m2, round(m3, 6) AS m3, quality_score, completeness_score,
  m1_valid, m2_valid, m3_valid, m1_anomaly, m2_anomaly, strftime(detected_at, {TS}) AS detected_at"""
ISSUE_ORDER = """detected_at DESC NULLS LAST, subject ASC NULLS LAST, entity ASC NULLS LAST, m1 ASC NULLS LAST,
  m2 ASC NULLS LAST, m3 ASC NULLS LAST, quality_score ASC NULLS LAST, completeness_score ASC NULLS LAST,
  m1_valid ASC NULLS LAST, m2_valid ASC NULLS LAST, m3_valid ASC NULLS LAST, m1_anomaly ASC NULLS LAST,
  m2_anomaly ASC NULLS LAST"""

DOCS = """
docs AS (
  SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

LINEITEM = """
li AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_returnflag, l_quantity, l_discount, l_tax, l_shipdate AS ship_ts,
         make_timestamp(epoch_us(l_shipdate) - epoch_us(l_shipdate) % 604800000000) AS w
  FROM lineitem
),
li_stats AS (
  SELECT w, l_returnflag, avg(l_quantity) AS q_mean, stddev_samp(l_quantity) AS q_sd,
         avg(l_discount) AS d_mean, stddev_samp(l_discount) AS d_sd
  FROM li WHERE ship_ts IS NOT NULL GROUP BY 1, 2
),
li_z AS (
  SELECT li.*,
    (CASE WHEN order_id IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN li.l_returnflag IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN l_quantity IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END) AS completeness_score,
    CASE WHEN l_quantity IS NULL THEN NULL ELSE l_quantity BETWEEN 1 AND 50 END AS q_valid,
    CASE WHEN l_discount IS NULL THEN NULL ELSE l_discount BETWEEN 0 AND 0.08 END AS d_valid,
    CASE WHEN l_tax IS NULL THEN NULL ELSE l_tax BETWEEN 0 AND 0.08 END AS t_valid,
    (CASE WHEN s.q_sd IS NOT NULL AND s.q_sd > 0 THEN abs((l_quantity - s.q_mean) / s.q_sd) ELSE 0 END) > 3 AS q_anom,
    (CASE WHEN s.d_sd IS NOT NULL AND s.d_sd > 0 THEN abs((l_discount - s.d_mean) / s.d_sd) ELSE 0 END) > 3 AS d_anom
  FROM li LEFT JOIN li_stats s ON li.w = s.w AND li.l_returnflag = s.l_returnflag
),
li_i AS (
  SELECT *, (completeness_score < 4 OR q_valid = false OR d_valid = false OR t_valid = false
             OR q_anom = true OR d_anom = true) AS has_issues
  FROM li_z
),
li_s AS (
  SELECT *, CASE WHEN completeness_score < 4 THEN 25 WHEN has_issues = false THEN 100
                 WHEN q_anom OR d_anom THEN 50
                 WHEN q_valid = false OR d_valid = false OR t_valid = false THEN 75 ELSE 100 END AS quality_score
  FROM li_i
)"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["json_decode"] = f"""
SELECT event_id,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS patient_id,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type END AS hospital,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE round(value, 6) END AS temperature,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_id % 101 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN strftime(date_trunc('second', ts), {TS})
       ELSE strftime(ts, {TS}) END AS "timestamp"
FROM events"""
    q["completeness_flags"] = f"""WITH {CHECKED}
SELECT event_id, missing_subject, missing_entity, missing_m1, missing_m2, missing_fields, completeness_score FROM checked"""
    q["completeness_labels"] = f"""WITH {DOCS},
c AS (
  SELECT *, doc_id IS NULL AS missing_doc_id, lang IS NULL AS missing_lang, quality IS NULL AS missing_quality,
         toxic IS NULL AS missing_toxic,
         concat_ws(',', CASE WHEN doc_id IS NULL THEN 'doc_id' END, CASE WHEN lang IS NULL THEN 'lang' END,
                        CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing_fields,
         (CASE WHEN doc_id IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN lang IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN toxic IS NOT NULL THEN 1 ELSE 0 END) AS completeness_score,
         CASE WHEN n_chars IS NULL THEN NULL ELSE n_chars BETWEEN 1 AND 100000 END AS n_chars_valid,
         CASE WHEN quality IS NULL THEN NULL ELSE quality BETWEEN 0 AND 1 END AS quality_valid,
         CASE WHEN toxic IS NULL THEN NULL ELSE toxic BETWEEN 0 AND 0 END AS toxic_valid
  FROM docs
),
i AS (SELECT *, (completeness_score < 4 OR n_chars_valid = false OR quality_valid = false OR toxic_valid = false) AS has_issues FROM c)
SELECT doc_id, lang, quality, toxic, missing_doc_id, missing_lang, missing_quality, missing_toxic, missing_fields,
       completeness_score, n_chars_valid, quality_valid, toxic_valid, has_issues,
       CASE WHEN completeness_score < 4 THEN 25 WHEN has_issues = false THEN 100
            WHEN n_chars_valid = false OR quality_valid = false OR toxic_valid = false THEN 75 ELSE 100 END AS quality_score
FROM i"""
    q["range_validity"] = f"""WITH {CHECKED}
SELECT event_id, m1_valid, m2_valid, m3_valid FROM checked"""
    q["null_percentage"] = f"""WITH {DOCS},
p AS (
  SELECT 'doc_id' AS field, avg(CASE WHEN doc_id IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS null_pct FROM docs
  UNION ALL SELECT 'lang', avg(CASE WHEN lang IS NULL THEN 1.0 ELSE 0.0 END) * 100 FROM docs
  UNION ALL SELECT 'quality', avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END) * 100 FROM docs
  UNION ALL SELECT 'toxic', avg(CASE WHEN toxic IS NULL THEN 1.0 ELSE 0.0 END) * 100 FROM docs
)
SELECT field, round(null_pct, 6) AS null_pct, null_pct <= 5.0 AS passed FROM p"""
    q["count_window_zscore"] = f"""WITH {READINGS},
r AS (
  SELECT event_id, entity, m1, m2,
         CASE WHEN entity IS NOT NULL THEN avg(m1) OVER w END AS m1_mean,
         CASE WHEN entity IS NOT NULL THEN stddev_samp(m1) OVER w END AS m1_stddev,
         CASE WHEN entity IS NOT NULL THEN avg(m2) OVER w END AS m2_mean,
         CASE WHEN entity IS NOT NULL THEN stddev_samp(m2) OVER w END AS m2_stddev
  FROM readings
  WINDOW w AS (PARTITION BY entity ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)
),
z AS (
  SELECT *, CASE WHEN m1_stddev IS NOT NULL AND m1_stddev > 0 THEN abs((m1 - m1_mean) / m1_stddev) ELSE 0 END AS m1_zscore,
            CASE WHEN m2_stddev IS NOT NULL AND m2_stddev > 0 THEN abs((m2 - m2_mean) / m2_stddev) ELSE 0 END AS m2_zscore
  FROM r
)
SELECT event_id, entity, round(m1_zscore, 6) AS m1_zscore, m1_zscore > 3 AS m1_anomaly,
       round(m2_zscore, 6) AS m2_zscore, m2_zscore > 3 AS m2_anomaly
FROM z"""
    q["window_stats"] = f"""WITH {READINGS}
SELECT strftime(date_trunc('day', ts), {TS}) AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, {TS}) AS window_end,
       entity, count(*) AS n,
       round(avg(m1), 6) AS m1_mean, round(stddev_samp(m1), 6) AS m1_stddev,
       round(avg(m2), 6) AS m2_mean, round(stddev_samp(m2), 6) AS m2_stddev
FROM readings WHERE ts IS NOT NULL GROUP BY date_trunc('day', ts), entity"""
    q["zscore_anomalies"] = f"""WITH {SCORED}
SELECT event_id, round(m1_mean, 6) AS m1_mean, round(m1_stddev, 6) AS m1_stddev, round(m2_mean, 6) AS m2_mean,
       round(m2_stddev, 6) AS m2_stddev, round(m1_zscore, 6) AS m1_zscore, m1_anomaly,
       round(m2_zscore, 6) AS m2_zscore, m2_anomaly
FROM flagged"""
    q["quality_score"] = f"""WITH {SCORED}
SELECT event_id, has_issues, quality_score FROM scored"""
    q["extract_issues"] = f"""WITH {ISSUES}
SELECT {ISSUE_COLS} FROM issues"""
    q["daily_metrics"] = f"""WITH {DAILY}
SELECT {DAILY_COLS} FROM daily_m"""
    q["daily_metrics_lineitem"] = f"""WITH {LINEITEM}
SELECT l_returnflag, CAST(ship_ts AS DATE) AS date, count(*) AS total_records,
       count(*) FILTER (WHERE has_issues) AS records_with_issues,
       round(avg(quality_score), 6) AS avg_quality_score, max(quality_score) AS max_quality_score,
       min(quality_score) AS min_quality_score, round(stddev_samp(quality_score), 6) AS quality_variance,
       round(count(*) FILTER (WHERE has_issues) / count(*) * 100.0, 6) AS issue_rate,
       CASE WHEN avg(quality_score) >= 95 THEN 'excellent' WHEN avg(quality_score) >= 85 THEN 'good'
            WHEN avg(quality_score) >= 70 THEN 'fair' ELSE 'poor' END AS health_status
FROM li_s GROUP BY 1, 2"""
    q["problem_orders_lineitem"] = f"""WITH {LINEITEM}
SELECT order_id, l_returnflag, count(*) AS count FROM li_s WHERE has_issues
GROUP BY order_id, l_returnflag ORDER BY count DESC, order_id ASC NULLS LAST, l_returnflag ASC NULLS LAST LIMIT 10"""
    q["trends_lineitem"] = f"""WITH {LINEITEM},
d AS (
  SELECT l_returnflag, CAST(ship_ts AS DATE) AS date, count(*) AS total_records,
         count(*) FILTER (WHERE has_issues) AS records_with_issues,
         avg(quality_score) AS avg_quality_score, max(quality_score) AS max_quality_score,
         min(quality_score) AS min_quality_score, stddev_samp(quality_score) AS quality_variance,
         count(*) FILTER (WHERE has_issues) / count(*) * 100.0 AS issue_rate
  FROM li_s GROUP BY 1, 2
),
m AS (
  SELECT *, CASE WHEN avg_quality_score >= 95 THEN 'excellent' WHEN avg_quality_score >= 85 THEN 'good'
                 WHEN avg_quality_score >= 70 THEN 'fair' ELSE 'poor' END AS health_status,
         avg(avg_quality_score) OVER (PARTITION BY l_returnflag ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_quality_score,
         avg(issue_rate) OVER (PARTITION BY l_returnflag ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_issue_rate
  FROM d
),
t AS (SELECT *, lag(ma7_quality_score, 1, 0.0) OVER (PARTITION BY l_returnflag ORDER BY date) AS prev FROM m)
SELECT l_returnflag, date, total_records, records_with_issues, round(avg_quality_score, 6) AS avg_quality_score,
       max_quality_score, min_quality_score, round(quality_variance, 6) AS quality_variance,
       round(issue_rate, 6) AS issue_rate, health_status, round(ma7_quality_score, 6) AS ma7_quality_score,
       round(ma7_issue_rate, 6) AS ma7_issue_rate,
       CASE WHEN ma7_quality_score > prev THEN 'improving' ELSE 'degrading' END AS trend_direction,
       round(ma7_quality_score - prev, 6) + 0.0 AS quality_change
FROM t"""
    q["trends"] = f"""WITH {TRENDS}
SELECT {TREND_COLS} FROM trends"""
    q["predicted_risk"] = f"""WITH {TRENDS}
SELECT entity, date, round(avg_quality_score, 6) AS avg_quality_score,
       CAST(CASE WHEN trend_direction = 'degrading' AND quality_variance > 10 THEN 0.8
            WHEN trend_direction = 'degrading' THEN 0.6
            WHEN trend_direction = 'improving' AND quality_variance < 5 THEN 0.2
            ELSE 0.4 END AS DOUBLE) AS predicted_issue_risk,
       trend_direction
FROM trends"""
    q["entity_comparison"] = f"""WITH {SCORED}
SELECT entity, count(*) AS total_records, CAST(sum(CASE WHEN has_issues THEN 1 ELSE 0 END) AS BIGINT) AS total_issues,
       round(avg(quality_score), 6) AS avg_quality_score,
       round(sum(CASE WHEN has_issues THEN 1 ELSE 0 END) / count(*) * 100.0, 6) AS issue_rate
FROM scored GROUP BY entity"""
    q["problem_subjects"] = f"""WITH {SCORED}
SELECT subject, entity, count(*) AS count FROM scored WHERE has_issues
GROUP BY subject, entity ORDER BY count DESC, subject ASC NULLS LAST, entity ASC NULLS LAST LIMIT 10"""
    q["daily_asof"] = TRENDS.replace(
        "FROM scored GROUP BY 1, 2", "FROM scored WHERE CAST(ts AS DATE) <= DATE '2024-01-15' GROUP BY 1, 2"
    ).join(["WITH ", f"\nSELECT {TREND_COLS} FROM trends WHERE date = DATE '2024-01-15'"])
    q["batch_summary"] = f"""WITH {SCORED}
SELECT 'entity' AS level, entity, count(*) AS records, count(*) FILTER (WHERE has_issues) AS flagged_issues,
       round(avg(quality_score), 6) AS avg_quality_score
FROM scored GROUP BY entity
UNION ALL
SELECT 'total', NULL, count(*), count(*) FILTER (WHERE has_issues), round(avg(quality_score), 6) FROM scored"""
    q["latest_metrics"] = f"""WITH {LATEST}
SELECT {DAILY_COLS} FROM latest"""
    q["metrics_for_entity"] = f"""WITH {LATEST}
SELECT {DAILY_COLS} FROM latest WHERE entity = 'click'"""
    q["metrics_by_status"] = f"""WITH {LATEST}
SELECT {DAILY_COLS} FROM latest WHERE lower(health_status) = 'good'"""
    q["critical_entities"] = f"""WITH {LATEST}
SELECT {DAILY_COLS} FROM latest
WHERE coalesce(issue_rate > 20, false) OR coalesce(lower(health_status) = 'poor', false)
      OR coalesce(avg_quality_score < 70, false)"""
    q["trend_lookup"] = f"""WITH {TRENDS},
lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date DESC) AS rn
                      FROM trends WHERE entity IS NOT NULL) t WHERE rn = 1),
keys AS (SELECT * FROM (VALUES ('click'), ('no_such_entity')) k(entity))
SELECT k.entity, lt.date, lt.total_records, lt.records_with_issues, round(lt.avg_quality_score, 6) AS avg_quality_score,
       lt.max_quality_score, lt.min_quality_score, round(lt.quality_variance, 6) AS quality_variance,
       round(lt.issue_rate, 6) AS issue_rate, lt.health_status, round(lt.ma7_quality_score, 6) AS ma7_quality_score,
       round(lt.ma7_issue_rate, 6) AS ma7_issue_rate, round(lt.quality_change, 6) + 0.0 AS quality_change,
       coalesce(lt.trend_direction, 'unknown') AS trend_direction
FROM keys k LEFT JOIN lt ON k.entity = lt.entity"""
    q["recent_issues"] = f"""WITH {ISSUES}
SELECT {ISSUE_COLS}, severity FROM issues ORDER BY {ISSUE_ORDER}, severity ASC NULLS LAST LIMIT 10"""
    q["issues_by_severity"] = f"""WITH {ISSUES}
SELECT {ISSUE_COLS}, severity FROM issues WHERE lower(severity) = 'high'
ORDER BY {ISSUE_ORDER}, severity ASC NULLS LAST LIMIT 20"""
    q["current_status"] = f"""WITH {SCORED},
b AS (
  SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id, count(*) AS records,
         count(*) FILTER (WHERE has_issues) AS flagged_issues, avg(quality_score) AS avg_quality_score
  FROM scored GROUP BY 1
),
v AS (
  SELECT *, TIMESTAMP '1970-01-01' + (batch_id + 1) * INTERVAL 1 DAY AS written_at FROM b
  WHERE TIMESTAMP '1970-01-01' + (batch_id + 1) * INTERVAL 1 DAY > TIMESTAMP '2024-01-31 00:04:00' - INTERVAL 300 SECOND
),
top AS (SELECT * FROM v ORDER BY batch_id DESC LIMIT 1),
one AS (SELECT 1 AS x)
SELECT CASE WHEN top.batch_id IS NULL THEN 'no_data' ELSE 'ok' END AS status, top.batch_id,
       strftime(top.written_at, {TS}) AS written_at, coalesce(top.records, 0) AS issues, top.flagged_issues,
       round(top.avg_quality_score, 6) AS avg_quality_score
FROM one LEFT JOIN top ON true"""
    q["fresh_metrics"] = f"""WITH {LATEST},
w AS (SELECT *, CAST(date AS TIMESTAMP) + INTERVAL 1 DAY AS written_at FROM latest)
SELECT {DAILY_COLS}, strftime(written_at, {TS}) AS written_at FROM w
WHERE written_at > TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 86400 SECOND"""
    q["lake_daily_asof"] = q["daily_asof"]
    q["monitor_latest"] = q["latest_metrics"]
    q["monitor_trend"] = q["trend_lookup"]
    q["monitor_issues"] = q["monitor_issues_windows"] = q["recent_issues"]
    q["monitor_issues_severity"] = q["issues_by_severity"]
    q["status_breakdown"] = f"""WITH {SCORED},
b AS (
  SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id, entity, count(*) AS records,
         count(*) FILTER (WHERE has_issues) AS flagged_issues, round(avg(quality_score), 6) AS avg_quality_score
  FROM scored WHERE ts IS NOT NULL GROUP BY 1, 2
)
SELECT batch_id, strftime(TIMESTAMP '1970-01-01' + (batch_id + 1) * INTERVAL 1 DAY, {TS}) AS written_at, entity, records,
       flagged_issues, avg_quality_score
FROM b WHERE batch_id = (SELECT max(batch_id) FROM b)"""
    q["issues_immediate"] = f"""WITH {CHECKED}
SELECT event_id, entity, missing_fields, completeness_score, CASE WHEN completeness_score < 4 THEN 25 ELSE 75 END AS quality_score
FROM checked WHERE completeness_score < 4 OR m1_valid = false OR m2_valid = false OR m3_valid = false"""
    q["stream_assess"] = f"""WITH {SCORED}
SELECT event_id, entity, round(m1_zscore, 6) AS m1_zscore, m1_anomaly, round(m2_zscore, 6) AS m2_zscore, m2_anomaly,
       has_issues, quality_score
FROM scored"""
    q["stream_summary"] = f"""WITH {SCORED}
SELECT 'entity' AS level, entity, count(*) AS records, count(*) FILTER (WHERE has_issues) AS flagged_issues,
       round(avg(quality_score), 6) AS avg_quality_score
FROM scored GROUP BY entity
UNION ALL
SELECT 'total', NULL, count(*), count(*) FILTER (WHERE has_issues), round(avg(quality_score), 6) FROM scored"""
    q["issue_json"] = f"""WITH {ISSUES}
SELECT '{{' || concat_ws(',',
    CASE WHEN subject IS NOT NULL THEN '"subject":"' || subject || '"' END,
    CASE WHEN entity IS NOT NULL THEN '"entity":"' || entity || '"' END,
    CASE WHEN m1 IS NOT NULL THEN '"m1":' || CAST(round(m1, 6) AS VARCHAR) END,
    CASE WHEN m2 IS NOT NULL THEN '"m2":' || CAST(m2 AS VARCHAR) END,
    CASE WHEN m3 IS NOT NULL THEN '"m3":' || CAST(round(m3, 6) AS VARCHAR) END,
    '"quality_score":' || CAST(quality_score AS VARCHAR),
    '"completeness_score":' || CAST(completeness_score AS VARCHAR),
    CASE WHEN m1_valid IS NOT NULL THEN '"m1_valid":' || CAST(m1_valid AS VARCHAR) END,
    CASE WHEN m2_valid IS NOT NULL THEN '"m2_valid":' || CAST(m2_valid AS VARCHAR) END,
    CASE WHEN m3_valid IS NOT NULL THEN '"m3_valid":' || CAST(m3_valid AS VARCHAR) END,
    CASE WHEN m1_anomaly IS NOT NULL THEN '"m1_anomaly":' || CAST(m1_anomaly AS VARCHAR) END,
    CASE WHEN m2_anomaly IS NOT NULL THEN '"m2_anomaly":' || CAST(m2_anomaly AS VARCHAR) END,
    '"detected_at":"' || strftime(detected_at, {TS}) || '"') || '}}' AS value
FROM issues"""
    q["published_documents"] = f"""WITH {TRENDS},
lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY date DESC) AS rn
                      FROM trends WHERE entity IS NOT NULL) t WHERE rn = 1)
SELECT entity AS key, '{{' || concat_ws(',',
    '"hospital":"' || entity || '"',
    '"avgQualityScore":' || CAST(round(avg_quality_score, 6) AS VARCHAR),
    '"issueRate":' || CAST(round(issue_rate, 6) AS VARCHAR),
    '"totalRecords":' || CAST(total_records AS VARCHAR),
    '"healthStatus":"' || health_status || '"',
    '"timestamp":"' || strftime(CAST(date AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%f') || '"') || '}}' AS value,
    'daily' AS kind
FROM lt
UNION ALL
SELECT entity, '{{' || concat_ws(',',
    '"hospital":"' || entity || '"',
    '"date":"' || strftime(date, '%Y-%m-%d') || '"',
    '"dailyScore":' || CAST(round(avg_quality_score, 6) AS VARCHAR),
    '"ma7Score":' || CAST(round(ma7_quality_score, 6) AS VARCHAR),
    '"trendDirection":"' || trend_direction || '"',
    '"qualityChange":' || CAST(round(quality_change, 6) + 0.0 AS VARCHAR),
    '"predictionRisk":' || CASE WHEN trend_direction = 'degrading' AND quality_variance > 10 THEN '0.8'
                                WHEN trend_direction = 'degrading' THEN '0.6'
                                WHEN trend_direction = 'improving' AND quality_variance < 5 THEN '0.2'
                                ELSE '0.4' END) || '}}', 'trend'
FROM lt"""
    q["stream_restart"] = q["stream_late"] = q["lake_compacted"] = q["stream_assess"]
    q["daily_incremental"] = q["trends"]
    q["count_window_steps"] = q["count_window_zscore"]
    q["problem_subjects_sketch"] = q["problem_subjects"]
    q["problem_orders_sketch"] = q["problem_orders_lineitem"]
    q["daily_incremental_problems"] = q["problem_subjects"]
    q["stream_late_issues"] = f"""WITH {SCORED}
SELECT entity, quality_score, count(*) AS issues FROM scored WHERE has_issues GROUP BY entity, quality_score"""
    # windows are days: one is closed when the greatest time so far, less the watermark, has passed its end
    q["stream_progress"] = """WITH e AS (
  SELECT *, epoch_us(CAST(ts AS TIMESTAMP)) AS us FROM events
),
cut AS (SELECT us AS mid FROM (SELECT us, row_number() OVER (ORDER BY us) AS i, count(*) OVER () AS n FROM e WHERE us IS NOT NULL) WHERE i = CAST(ceil(n * 0.5) AS BIGINT)),
dealt AS (SELECT CASE WHEN event_id % 10 = 0 THEN 2 WHEN us < mid THEN 0 ELSE 1 END AS batch_id, us FROM e, cut),
batches AS (SELECT batch_id, count(*) AS records, count(*) FILTER (WHERE us IS NULL) AS timeless_records, max(us) AS newest FROM dealt GROUP BY batch_id),
seen AS (SELECT *, max(newest) OVER (ORDER BY batch_id) AS max_us, coalesce(max(newest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000000, -4000000000000000000) AS closed FROM batches)
SELECT s.batch_id, s.records, (SELECT count(*) FROM dealt d WHERE d.batch_id = s.batch_id AND d.us - d.us % 86400000000 + 86400000000 <= s.closed) AS late_records,
       s.timeless_records, strftime(make_timestamp(s.max_us), '%Y-%m-%d %H:%M:%S.%f') AS max_time
FROM seen s"""
    return q


def oracle_sql() -> dict[str, str]:
    return _sql()
