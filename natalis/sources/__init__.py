from natalis.sources.fixtures import (
    deaths,
    fact_day,
    patient_summary_wide,
    person,
    scored_documents,
)
from natalis.sources.store import read_node, read_table, write_node

__all__ = [
    "deaths",
    "fact_day",
    "patient_summary_wide",
    "person",
    "read_node",
    "read_table",
    "scored_documents",
    "write_node",
]
