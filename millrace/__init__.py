"""millrace: feature and customer-data work as Spark DataFrame operators."""

from millrace.session import get_session, scratch_path, size_shuffles

__all__ = ["get_session", "scratch_path", "size_shuffles"]
