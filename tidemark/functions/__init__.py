from .expressions import (
    case_of,
    column,
    flag,
    lsn_bytes,
    lsn_hex,
    null_safe_match,
    person_name,
    same_key,
    watermark_text,
)

__all__ = [
    "case_of",
    "column",
    "flag",
    "lsn_bytes",
    "lsn_hex",
    "null_safe_match",
    "person_name",
    "same_key",
    "watermark_text",
]
