"""Sources: delimited files, the registry, staging text and ZIP archives."""

from .archives import extract_archives  # noqa: F401
from .files import file_headers, list_files, read_delimited, read_registry, read_staging  # noqa: F401
