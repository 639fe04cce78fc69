"""Readers: tables (Parquet / JDBC), JSON documents, GeoJSON, JSON lines."""

from roadloom.sources.tables import read_table, read_jdbc, read_snapshot_keys  # noqa: F401
from roadloom.sources.documents import (  # noqa: F401,E402
    read_customer_envelopes,
    read_documents,
    read_geojson,
    read_json_documents,
    read_json_lines,
)
