"""Every query of the catalogue; the modules register theirs on import."""

from quillstone.plans import papers, records  # noqa: F401
from quillstone.plans.catalogue import ORACLE_SQL, QUERIES, coverage_report

__all__ = ["ORACLE_SQL", "QUERIES", "coverage_report"]
