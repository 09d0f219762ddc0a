"""Structured Streaming twins of the batch pipelines.

Stateless pipelines run unchanged on streaming DataFrames. Pipelines with state
are ``foreachBatch`` jobs over keyed state tables (``jobs.py``, ``state.py``): each
micro-batch looks up the keys of its records, runs the batch plan, and publishes
its outputs and the rows it changed with one commit.
"""

from .sources import StreamDomain, stream_table
from .sinks import Progress, keyed_records, run_available_now, start_every, write_each_batch
from .jobs import Job, final_state, output, run_job, start_job

__all__ = ["StreamDomain", "stream_table", "keyed_records", "run_available_now", "start_every",
           "write_each_batch", "Progress", "Job", "run_job", "start_job", "output", "final_state"]
