"""ledgerlark: retail quality and revenue analytics as Spark DataFrame jobs.

Layout
------
``functions``  pure Column expressions (cleaning, parsing, predicates)
``sources``    scans of the source feed and raw tables, sinks, staged publish
``operators``  normalisation, quality gate, warehouse marts, mart reads
``plans``      the gated batch job and the query catalogue
"""

from ledgerlark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
