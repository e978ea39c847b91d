"""Readers: file selection, payload and delimited scans, lineage columns, incremental extracts, catalog."""

from .capture import read_capture, write_capture  # noqa: F401
from .catalog import catalog_columns, catalog_tables  # noqa: F401
from .extract_log import ExtractLog, extract_new  # noqa: F401
from .files import (  # noqa: F401
    name_matches,
    read_delimited,
    read_json_array,
    read_json_payload,
    read_matching,
    read_sheets,
    sheet_layouts,
    typed_fields,
)
from .generations import read_generations  # noqa: F401
from .incremental import incremental, next_watermark  # noqa: F401
from .json_split import read_large_json_array  # noqa: F401
from .lineage import with_lineage  # noqa: F401
