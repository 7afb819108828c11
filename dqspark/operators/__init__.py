"""DataFrame -> DataFrame operators (usable with ``df.transform``)."""

from .assess import (  # noqa: F401
    assess,
    assess_rows,
    attach_anomalies,
    extract_issues,
    issue_json,
    row_issues,
    score_only,
    window_stats,
    with_severity,
)
from .metrics import (  # noqa: F401
    batch_summary,
    daily_metrics,
    entity_comparison,
    entity_comparison_from_daily,
    null_percentage,
    problem_subjects,
    problem_subjects_sketch,
)
from .serving import (  # noqa: F401
    critical_entities,
    current_status,
    daily_documents,
    trend_documents,
    fresh,
    issues_by_severity,
    latest_per_entity,
    metrics_by_status,
    metrics_for_entity,
    recent_issues,
    status_breakdown,
    trend_lookup,
)
from .trends import daily_report, predict_risk, trends  # noqa: F401
from .rolling import count_window_anomalies, count_window_step  # noqa: F401,E402
