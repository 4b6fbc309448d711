from tidemark.sources.entities import configured, entities
from tidemark.sources.landing import land, landed_between, landed_schema, load_landed, load_landed_days
from tidemark.sources.tables import LoadReport, Tables, create_tables

__all__ = [
    "LoadReport",
    "Tables",
    "configured",
    "create_tables",
    "entities",
    "land",
    "landed_between",
    "landed_schema",
    "load_landed",
    "load_landed_days",
]
