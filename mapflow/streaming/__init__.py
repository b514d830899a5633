from .stream_merge import stream_merge, stream_partitions, stream_rollup
from .windows import late_rows, stream_windows, windowed

__all__ = ["late_rows", "stream_merge", "stream_partitions", "stream_rollup", "stream_windows", "windowed"]
