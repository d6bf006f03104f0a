"""tidemark — a Spark-native market-data lakehouse.

Planning (which symbol-months to fetch), classification and idempotent
landing of raw vendor responses into Bronze, normalisation, validation and
deduplication into Silver, and Gold aggregates / features / regime signals,
all expressed with DataFrame and SQL built-ins.
"""

from tidemark.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
