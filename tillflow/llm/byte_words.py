"""Words of UTF-8 bytes: runs of ASCII letters, digits and all characters beyond ASCII.

Only A-Z is lower-cased.  Every byte of a character beyond ASCII is 0x80 or more, so the
bytes can be mapped and split without decoding: a pass in C per text.
"""

from __future__ import annotations

import pyarrow as pa

_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
# Upper-case letters to lower case, every separator to a space.
TABLE = bytes(lower if lower in _KEPT or lower >= 0x80 else 0x20
              for lower in bytes(range(256)).lower())


def byte_words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null becomes empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [t or b"" for t in values.cast(pa.binary()).to_pylist()]
