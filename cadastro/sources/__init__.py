"""Scans of raw registry files and table sinks."""

from .delimited import (
    CODEBOOK_OPTIONS,
    HEADERED_OPTIONS,
    POSITIONAL_OPTIONS,
    ddl_schema,
    read_checked,
    read_codebook,
    read_data,
    read_headered,
    read_lookup_set,
    read_positional,
    string_schema,
)
from .sinks import SAVE_MODES, Stage, stage, write_clustered, write_split, write_table

__all__ = [
    "CODEBOOK_OPTIONS", "HEADERED_OPTIONS", "POSITIONAL_OPTIONS", "SAVE_MODES", "Stage", "ddl_schema",
    "read_checked", "read_codebook", "read_data", "read_headered", "read_lookup_set", "read_positional", "stage",
    "string_schema", "write_clustered", "write_split", "write_table",
]
