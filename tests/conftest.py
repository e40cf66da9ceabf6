import os
import struct
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hydrolens.session import get_session

    session = get_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.default.parallelism": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_png(path, pixels):
    """RGB or grey uint8 array as a PNG, written independently of the package."""
    pixels = np.ascontiguousarray(pixels, np.uint8)
    height, width = pixels.shape[:2]
    raw = b"".join(b"\0" + pixels[i].tobytes() for i in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
