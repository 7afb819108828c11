"""Declarative data-quality rules.

A ``Rules`` object is a small driver-side description (which columns are
required, which value ranges are valid, which measures get a windowed
z-score check) that the ``functions`` package compiles into Spark
``Column`` expressions.  Nothing here touches data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping


ANOMALY_KEYS = {"z_score_threshold", "fields", "window_duration", "watermark", "window_size"}
# Short names used for derived columns where a rule file gives none.
DEFAULT_PREFIXES = {"age": "age", "bp_systolic": "bp", "temperature": "temp"}


@dataclass(frozen=True)
class Range:
    min: float
    max: float

    def __post_init__(self) -> None:
        if self.min > self.max:
            raise ValueError(f"range min {self.min} > max {self.max}")


@dataclass(frozen=True)
class Rules:
    """Rule set plus the column roles the operators need.

    ``entity``   – the column statistics and metrics are grouped by (a hospital).
    ``subject``  – the column that identifies who a record is about (a patient).
    ``time``     – event/ingestion time column used for windows and daily dates.
    ``required`` – columns whose NULL makes a record incomplete (order kept in
                   ``missing_fields``).
    ``ranges``   – inclusive valid range per column; NULL stays NULL.
    ``anomaly``  – measures that get a windowed z-score check.
    """

    required: tuple[str, ...]
    ranges: tuple[tuple[str, Range], ...] = ()
    anomaly: tuple[str, ...] = ()
    z_threshold: float = 3.0
    entity: str = "hospital"
    subject: str = "patient_id"
    time: str = "ingestion_time"
    window: str = "5 minutes"
    watermark: str = "10 minutes"
    max_null_pct: float = 5.0
    row_window: int = 1000
    prefixes: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if not self.required:
            raise ValueError("at least one required field")
        if len(set(self.required)) != len(self.required):
            raise ValueError("duplicate required field")
        names = [n for n, _ in self.ranges]
        if len(set(names)) != len(names):
            raise ValueError("duplicate range rule")
        if self.z_threshold <= 0:
            raise ValueError("z_threshold must be positive")
        if self.row_window < 2:
            raise ValueError("row_window must be at least 2")

    @property
    def n_required(self) -> int:
        return len(self.required)

    @property
    def range_fields(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.ranges)

    def prefix(self, name: str) -> str:
        """Short name used for derived columns (``<prefix>_valid`` ...)."""
        return dict(self.prefixes).get(name, name)

    def range_of(self, name: str) -> Range:
        return dict(self.ranges)[name]

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any], **roles: Any) -> "Rules":
        """Build from the nested mapping layout of a YAML rule file::

            completeness: {required_fields: [...]}
            validity: {field: {min: .., max: ..}, ...}
            anomaly_detection: {z_score_threshold: 3, fields: [...], window_size: 1000}

        Without ``fields`` the measures checked for anomalies are the required
        fields that have a valid range.  Without ``prefixes`` derived columns
        get the default short names.  Unknown keys are refused.

        ``window_size`` is the row count of the count-window check (X2);
        ``max_null_pct`` under ``completeness`` feeds the null-percentage check.
        """
        known = {"completeness": {"required_fields", "max_null_pct"}, "validity": None, "anomaly_detection": ANOMALY_KEYS, "consistency": None, "prefixes": None}
        for part, body in spec.items():
            if part not in known:
                raise ValueError(f"unknown rule section {part!r}")
            if known[part] is not None and (odd := set(body or {}) - known[part]):
                raise ValueError(f"unknown keys in {part!r}: {sorted(odd)}")
        required = tuple(spec["completeness"]["required_fields"])
        ranges = tuple(
            (name, Range(float(r["min"]), float(r["max"])))
            for name, r in (spec.get("validity") or {}).items()
        )
        ad = spec.get("anomaly_detection") or {}
        kwargs: dict[str, Any] = dict(roles)
        if "z_score_threshold" in ad:
            kwargs["z_threshold"] = float(ad["z_score_threshold"])
        if ad:
            bounded = {n for n, _ in ranges}
            if "fields" in ad or "anomaly" not in kwargs:
                kwargs["anomaly"] = tuple(ad["fields"]) if "fields" in ad else tuple(f for f in required if f in bounded)
        if "window_duration" in ad:
            kwargs["window"] = ad["window_duration"]
        if "watermark" in ad:
            kwargs["watermark"] = ad["watermark"]
        if "window_size" in ad:
            kwargs["row_window"] = int(ad["window_size"])
        kwargs["prefixes"] = tuple((spec["prefixes"] if "prefixes" in spec else DEFAULT_PREFIXES).items())
        if "max_null_pct" in spec.get("completeness", {}):
            kwargs["max_null_pct"] = float(spec["completeness"]["max_null_pct"])
        return cls(required=required, ranges=ranges, **kwargs)

    @classmethod
    def from_yaml(cls, path: str, **roles: Any) -> "Rules":
        try:
            import yaml  # type: ignore
        except ImportError as e:  # pragma: no cover - optional dependency
            raise ImportError("PyYAML is not installed; use Rules.from_dict") from e
        with open(path) as fh:
            return cls.from_dict(yaml.safe_load(fh), **roles)


# The default vital-signs rule set.  These must equal the
# source application's rule file for identical scores.
#   required: patient_id, hospital, age, bp_systolic
#   age 0..120, bp_systolic 70..250, temperature 35..42 (inclusive)
#   z-score threshold 3 on age and bp_systolic, 5-minute window, 10-minute watermark
#   derived-column prefixes: age -> age, bp_systolic -> bp, temperature -> temp
VITALS_SPEC: dict[str, Any] = {
    "completeness": {"required_fields": ["patient_id", "hospital", "age", "bp_systolic"]},
    "validity": {
        "age": {"min": 0, "max": 120},
        "bp_systolic": {"min": 70, "max": 250},
        "temperature": {"min": 35, "max": 42},
    },
    "anomaly_detection": {"z_score_threshold": 3, "fields": ["age", "bp_systolic"]},
    "prefixes": DEFAULT_PREFIXES,
}


def vitals_rules(**roles: Any) -> Rules:
    return Rules.from_dict(VITALS_SPEC, **roles)
