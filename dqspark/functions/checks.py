"""Row-level check expressions (completeness, range validity, z-score).

Each function returns ``Column`` expressions only; operators put them into a
single ``select`` so Catalyst sees one projection and whole-stage codegen
covers all checks.  All of them keep SQL three-valued logic: a NULL input
gives a NULL validity flag, never ``false``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import Rules


def missing_flags(rules: Rules) -> list[Column]:
    """``missing_<f>`` = ``f IS NULL`` per required field (empty string is present)."""
    return [F.col(f).isNull().alias(f"missing_{f}") for f in rules.required]


def missing_fields(rules: Rules) -> Column:
    """Comma list of missing required fields in rule order, ``""`` when none."""
    return F.concat_ws(
        ",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in rules.required]
    ).alias("missing_fields")


def completeness_score(rules: Rules) -> Column:
    """Number of required fields present (0 .. n)."""
    total = None
    for f in rules.required:
        term = F.when(F.col(f).isNotNull(), F.lit(1)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return total.alias("completeness_score")


def is_incomplete(rules: Rules) -> Column:
    return F.col("completeness_score") < F.lit(rules.n_required)


def validity_flags(rules: Rules) -> list[Column]:
    """``<prefix>_valid``: NULL -> NULL, inside the inclusive range -> true, else false."""
    out = []
    for name, rng in rules.ranges:
        c = F.col(name)
        out.append(
            F.when(c.isNull(), F.lit(None).cast("boolean"))
            .otherwise(c.between(F.lit(rng.min), F.lit(rng.max)))
            .alias(f"{rules.prefix(name)}_valid")
        )
    return out


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """``|x - mean| / sd`` when the window has a positive stddev, else 0.

    A window of one row (stddev NULL) or of equal values (stddev 0) yields 0;
    a NULL value with a usable stddev yields NULL.
    """
    return F.when(sd.isNotNull() & (sd > F.lit(0.0)), F.abs((x - mean) / sd)).otherwise(
        F.lit(0.0)
    )


def anomaly_columns(rules: Rules) -> list[Column]:
    """``<prefix>_zscore`` and ``<prefix>_anomaly`` (strict ``>`` threshold)."""
    out = []
    for m in rules.anomaly:
        p = rules.prefix(m)
        z = zscore(F.col(m), F.col(f"{p}_mean"), F.col(f"{p}_stddev"))
        out.append(z.alias(f"{p}_zscore"))
        out.append((z > F.lit(float(rules.z_threshold))).alias(f"{p}_anomaly"))
    return out


def null_percentage(field: str) -> Column:
    """Share of NULLs in ``field`` as a percentage (aggregate)."""
    return (F.avg(F.col(field).isNull().cast("double")) * F.lit(100.0)).alias(
        f"{field}_null_pct"
    )
