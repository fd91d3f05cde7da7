"""The corpus pipeline: documents to packed training sequences, in the five stages of STAGES.

The stages and run() are in quillmill.llm.pipeline, so that the package works when it is shipped alone.
"""

from quillmill.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
