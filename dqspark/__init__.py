"""dqspark: rule-driven data-quality assessment and monitoring on Spark."""

from .rules import Range, Rules, vitals_rules  # noqa: F401
from .session import ensure_conf, local_session, work_dir  # noqa: F401
