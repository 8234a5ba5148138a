"""fleetline: a Spark-native device-telemetry analytics engine.

Raw deliveries (a log of JSON envelopes) are decoded, validated, routed,
de-duplicated, enriched and stored; state tables, read queries, retention
roll-ups, dead-letter triage and SLO evaluations are DataFrame jobs over
the stored tables.  Every function takes and returns DataFrames, so the same
code runs in a batch job and inside a Structured Streaming ``foreachBatch``.
"""

from fleetline.session import get_session, prepare_session

__all__ = ["get_session", "prepare_session"]
