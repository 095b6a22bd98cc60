"""docmart: turn nested content snapshots carrying HTML into a star schema, on Spark.

Layout
------
functions/  column expressions (native Catalyst text functions, two Arrow helpers)
operators/  DataFrame -> DataFrame operators (routing, relational HTML mining, dims/facts)
sources/    scans and sinks (dated JSON landing, snapshots, audited publish)
streaming/  incremental file ingestion with Structured Streaming
plans/      end-to-end jobs (raw -> staging -> consume) and the registered queries
"""

from docmart.session import get_session, scratch, shared_dir

__all__ = ["get_session", "scratch", "shared_dir"]
