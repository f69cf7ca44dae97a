"""tidegate: metadata-driven ingestion, registry look-ups and customer-record scoring on Spark."""

from tidegate.meta import Meta
from tidegate.session import build_session

__all__ = ["Meta", "build_session"]
