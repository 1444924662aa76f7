from .runner import (
    Output,
    StreamJob,
    StreamTable,
    await_streams,
    run_fan_out,
    run_stream,
    run_streams,
    start_fan_out,
    start_stream,
    stream_snapshot,
)

__all__ = [
    "Output",
    "StreamJob",
    "StreamTable",
    "await_streams",
    "run_fan_out",
    "run_stream",
    "run_streams",
    "start_fan_out",
    "start_stream",
    "stream_snapshot",
]
