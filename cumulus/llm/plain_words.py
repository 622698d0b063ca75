"""Words of letters and digits: runs of 0-9, a-z (A-Z lower-cased) and anything beyond ASCII."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Bytes of a word stay, A-Z are lower-cased, all others become spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(data: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, lower-cased; of none for null."""
    return data.translate(_FOLD).split() if data else []


def places(text: str) -> list[tuple[int, int]]:
    """Start and end of each word in code points."""
    return [m.span() for m in _WORD.finditer(text)]


def raw_texts(batch: pa.RecordBatch, column: str) -> Iterable[bytes | None]:
    """A string column as UTF-8 bytes, without a detour over Python strings."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def in_parts(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that Python objects of few texts exist at a time."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)
