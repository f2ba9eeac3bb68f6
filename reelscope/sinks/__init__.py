from reelscope.sinks.jdbc import as_sink, count_written, write_jdbc, write_numbered_names

__all__ = ["as_sink", "count_written", "write_jdbc", "write_numbered_names"]
