"""Sources and sinks: schemas, TSV / GeoJSON readers, writers and stored layouts, test adapters."""

from staylens.sources.feature_collections import read_geojson_split
from staylens.sources.readers import read_geojson_features, read_geojson_seq, read_tsv
from staylens.sources.sinks import write_delimited

__all__ = ["read_geojson_features", "read_geojson_seq", "read_geojson_split", "read_tsv", "write_delimited"]
