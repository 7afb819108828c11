"""The Monitor lookups over what the stream and the daily job wrote."""

import datetime as dt
import tempfile

from dqspark.plans.daily import run_daily
from dqspark.plans.monitor import Monitor
from dqspark.streaming import StreamSinks, start_assessment
from dqspark.sources import decode_records, text_stream

from test_streaming import EVENT_RULES, _records, _write_lines


def test_monitor_over_stream_and_daily_outputs(spark):
    root = tempfile.mkdtemp(prefix="dq-mon-")
    _write_lines(f"{root}/in", _records())
    sinks = StreamSinks(lake=f"{root}/lake", issues=f"{root}/issues", summary=f"{root}/summary")
    q = start_assessment(decode_records(text_stream(spark, f"{root}/in"), ingest_col=None), EVENT_RULES, sinks,
                         f"{root}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    run_daily(spark, f"{root}/lake", f"{root}/pub", EVENT_RULES)
    m = Monitor(spark, EVENT_RULES, f"{root}/pub", lake=f"{root}/lake", issues=f"{root}/issues", summary=f"{root}/summary")

    assert m.all_metrics().count() == 3
    assert m.daily_metrics("H1").count() == 1 and m.daily_metrics("nope").count() == 0
    assert m.trend("nope").first()["trend_direction"] == "unknown"
    recent = m.recent_issues(5).collect()
    assert len(recent) == 5 and isinstance(recent[0]["detected_at"], dt.datetime)
    assert recent[0]["detected_at"] >= recent[-1]["detected_at"]
    sev = m.issues_by_severity("CRITICAL", 100).collect()
    assert sev and all(r["severity"] == "critical" and r["quality_score"] == 25 for r in sev)
    assert m.current_status().first()["status"] == "ok"  # just written: inside the 300 s TTL
    far = dt.datetime.now() + dt.timedelta(hours=1)
    assert m.current_status(as_of=far).first()["status"] == "no_data"
    assert m.metrics_by_status("EXCELLENT").count() + m.metrics_by_status("good").count() \
        + m.metrics_by_status("fair").count() + m.metrics_by_status("poor").count() == 3
    m.critical().collect()
