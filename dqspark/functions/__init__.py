"""Column-expression builders compiled from ``Rules`` (all Spark built-ins)."""

from .checks import (  # noqa: F401
    anomaly_columns,
    completeness_score,
    is_incomplete,
    missing_fields,
    missing_flags,
    null_percentage,
    validity_flags,
    zscore,
)
from .scoring import (  # noqa: F401
    has_issues,
    health_status,
    is_critical,
    issue_rate,
    issue_risk,
    quality_score,
    severity,
    trend_direction,
)
