"""fleetdw: a PySpark car-rental star schema.

Four independently designed operational sources are extracted, conformed to one
model, loaded into a star schema with insert-ignore semantics and surrogate keys,
checked against declared data-quality rules and served as fleet-management reports.

Layout:
    sources/    source table shapes and readers (Parquet layout, JDBC), the driver-table
                adapter (test data), extracts E1-E24
    functions/  column expressions: whole-day spans, smart date keys, calendar, exact rounding
    operators/  insert_ignore / upsert, surrogate keys, size-checked dimension lookups
    plans/      transform T1-T7, star store loads (ignore / update, optional persisted
                staging), reports R1-R4, Markov M1-M4, source views V1-V5, DQ Q1-Q10
    streaming/  the same insert-ignore load driven by Structured Streaming micro-batches
    checks/     DuckDB SQL oracle used by the correctness gate
"""

from fleetdw.schemas import AS_OF, SYS_A, SYS_B, SYS_C, SYS_D, SYSTEMS

__all__ = ["AS_OF", "SYS_A", "SYS_B", "SYS_C", "SYS_D", "SYSTEMS"]
