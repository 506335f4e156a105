"""Readers and writers for landed files."""

from casestar.sources.readers import read_facts, read_geometries, read_lookup  # noqa: F401
from casestar.sources.sinks import (  # noqa: F401
    export_facts,
    export_json,
    export_tsv,
    read_tsv_export,
    write_snapshot,
)
