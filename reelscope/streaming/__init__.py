"""Streaming use of the same analyses.

The analyses this library reproduces are batch jobs over files; there is no
window, watermark or custom state to carry over.  Because every analysis
takes plain DataFrames, the aggregating ones run unchanged on a streaming
frame in ``complete`` output mode: ``read_dat_stream`` watches a folder of
``::`` files and decodes new lines with the batch parser.
"""

from reelscope.streaming.sources import checkpoint_location, read_dat_stream

__all__ = ["checkpoint_location", "read_dat_stream"]
