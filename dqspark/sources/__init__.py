"""Sources and sinks: table readers, record decode, the date-partitioned lake."""

from .decode import ISO_TS, PATIENT_SCHEMA, decode_records, text_stream, topic_source  # noqa: F401
from .lake import publish, read_lake, stamp, with_date, write_lake, compact_lake  # noqa: F401
from .tables import (  # noqa: F401
    DOCUMENT_RULES,
    LINEITEM_RULES,
    READINGS_RULES,
    event_readings,
    labelled_documents,
    lineitem_readings,
    readings_from_events,
    table,
)
