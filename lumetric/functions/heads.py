"""The first record of delimited files, from their first bytes alone. Runs inside Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs

FIRST_BYTES = 1 << 14
LINE = re.compile(r"\s*+([^\r\n]++)(?=[\r\n])")
# Quotes hide line breaks in a field that starts with one.
FIELD = r'(?:"(?:[^"]++|"")*+"[^,\r\n]*+|(?!")[^,\r\n]*+)'
RECORD = re.compile(rf"\s*+({FIELD}(?:,{FIELD})*+)(?=[\r\n])")


def first_record(read, quoted_breaks: bool) -> str | None:
    """The first record that is not blank, None where there is none; reads on only until it is complete."""
    data, size, pattern = b"", FIRST_BYTES, RECORD if quoted_breaks else LINE
    while True:
        more = read(size)
        data, size = data + more, 2 * size
        # A last line break ends a last line that has none.
        text = data.decode("utf-8", "replace") + ("" if more else "\n")
        found = pattern.match(text)
        if found or not more:
            return found.group(1) if found else None


def headers(batches: Iterator[pa.RecordBatch], quoted_breaks: bool) -> Iterator[pa.RecordBatch]:
    """(file, header, read) of the files named; ``read`` is false where the store can't be opened from here."""
    for batch in batches:
        rows = []
        for file in batch.column("file").to_pylist():
            try:
                system, path = fs.FileSystem.from_uri(file)
                with system.open_input_stream(path, compression="detect", buffer_size=FIRST_BYTES) as stream:
                    rows.append((file, first_record(stream.read, quoted_breaks), True))
            except (OSError, pa.ArrowException):
                rows.append((file, None, False))
        kinds = [pa.string(), pa.string(), pa.bool_()]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "header", "read"])
