from serieslake.functions.fingerprint import byte_length, sha256, valid_utf8
from serieslake.functions.text import (
    clean,
    fold_dots,
    instant,
    label,
    or_text,
    present,
    resolve_link,
    to_type,
    unparsed,
)

__all__ = [
    "byte_length", "clean", "fold_dots", "instant", "label", "or_text", "present", "resolve_link", "sha256",
    "to_type", "unparsed", "valid_utf8",
]
