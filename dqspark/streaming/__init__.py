"""Structured Streaming: the single-query fan-out pipeline and its sinks."""

from .pipeline import (  # noqa: F401
    StreamSinks,
    await_any,
    batch_writer,
    finish,
    issues_stream_writer,
    run_stream,
    start_assessment,
    open_rows,
    write_open_rows,
)
from .staged import StagedWindows, read_progress  # noqa: F401
