import struct
import sys
import zlib
from pathlib import Path

import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import lumetric.functions.heads  # noqa: E402
import lumetric.functions.images  # noqa: E402
import lumetric.operators.boosting  # noqa: E402
from lumetric.session import local_session  # noqa: E402

cloudpickle.register_pickle_by_value(lumetric.functions.heads)
cloudpickle.register_pickle_by_value(lumetric.functions.images)
cloudpickle.register_pickle_by_value(lumetric.operators.boosting)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(shared),
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


def png(pixels) -> bytes:
    """A PNG of rows of (r, g, b), (r, g, b, a) or single grey values."""

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    first = pixels[0][0]
    grey = isinstance(first, int)
    colour = 0 if grey else {3: 2, 4: 6}[len(first)]
    lines = b"".join(
        b"\0" + bytes(row if grey else [v for pixel in row for v in pixel]) for row in pixels
    )
    head = struct.pack(">IIBBBBB", len(pixels[0]), len(pixels), 8, colour, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", head)
        + chunk(b"IDAT", zlib.compress(lines))
        + chunk(b"IEND", b"")
    )


def solid(colour, width, height) -> bytes:
    return png([[colour] * width] * height)


@pytest.fixture
def rows():
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
