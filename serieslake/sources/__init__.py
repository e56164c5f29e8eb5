from serieslake.sources.documents import flatten, read_documents
from serieslake.sources.landing import (
    extract_links,
    land_release,
    landed_content,
    landed_files,
    parse_listing,
    table_fingerprint,
    version_path,
)
from serieslake.sources.text import read_padded, split_malformed, stream_padded, write_padded

__all__ = [
    "extract_links", "flatten", "land_release", "landed_content", "landed_files", "parse_listing", "read_documents",
    "read_padded", "split_malformed", "stream_padded", "table_fingerprint", "version_path", "write_padded",
]
