"""martline: batch sales analytics on Spark.

Sources -> checks -> cleaning -> joins/enrichment -> star schema -> BI marts,
all expressed with the DataFrame / SQL / Structured Streaming APIs.
"""

from martline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
