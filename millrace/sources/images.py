"""Image columns to pixel vectors."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.files import shared_files


def pixel_vector(image: Column, width: int, height: int) -> Column:
    """Gray pixel values (0-255) of an image resized to ``width`` x ``height``.

    ``image`` is Spark's image struct.  Gray is the mean of the colour channels
    (transparency ignored); each target cell takes the source pixel under its centre.
    A null image, or one without pixels, has a null vector.
    """

    @F.pandas_udf("array<double>")
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors = []
            for h, w, channels, data in zip(
                batch["height"], batch["width"], batch["nChannels"], batch["data"]
            ):
                if not data or h <= 0 or w <= 0:
                    vectors.append(None)
                    continue
                h, w, channels = int(h), int(w), int(channels)  # nulls beside them make them reals
                pixels = np.frombuffer(data, dtype=np.uint8).reshape(h, w, channels)
                rows = ((np.arange(height) + 0.5) * h / height).astype(int)
                cols = ((np.arange(width) + 0.5) * w / width).astype(int)
                cells = pixels[rows][:, cols, : min(channels, 3)]
                vectors.append(cells.mean(axis=2).ravel())
            yield pd.Series(vectors)

    return extract(
        F.struct(
            image["height"].alias("height"),
            image["width"].alias("width"),
            image["nChannels"].alias("nChannels"),
            image["data"].alias("data"),
        )
    )


# Fixed values of the PNG format: the signature and the header's last five bytes (8 bits, gray, defaults).
PNG_START, PNG_GRAY = b"\x89PNG\r\n\x1a\n", b"\x08\x00\x00\x00\x00"


def png(pixels: np.ndarray) -> bytes:
    """A gray image file of a two-dimensional array of bytes."""
    height, width = pixels.shape
    lines = b"".join(b"\x00" + line.tobytes() for line in pixels.astype(np.uint8))

    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">II", width, height) + PNG_GRAY
    return PNG_START + part(b"IHDR", header) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def encode_png(pixels: Column, width: int, height: int) -> Column:
    """PNG files as binary values, from arrays of ``width`` x ``height`` gray values of 0 to 255."""

    @F.pandas_udf("binary")
    def encode(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else png(np.asarray(v, np.uint8).reshape(height, width)))

    return encode(pixels)


def sink_files(df: DataFrame, path: str, name: str, data: str) -> None:
    """Write the binary column ``data`` of every row to its own file ``path/<name>``.

    The folder must be one that all nodes share.  A file gets its name when it is whole and
    a task that is repeated writes the same files again.  Rows without data get none.
    """
    files = shared_files(df.sparkSession, path)

    def write(rows) -> None:
        system, root = files()
        system.create_dir(root, recursive=True)
        for row in rows:
            partial = f"{root}/_{row[0]}.{uuid.uuid4().hex}"
            with system.open_output_stream(partial) as out:
                out.write(bytes(row[1]))
            system.move(partial, f"{root}/{row[0]}")

    df.select(name, data).filter(F.col(data).isNotNull()).foreachPartition(write)
