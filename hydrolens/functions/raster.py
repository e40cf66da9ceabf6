"""Numpy helpers for single images, used inside Arrow batches. Images are height x width x 3, RGB."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Channel statistics (RGB) the models were trained with.
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def from_spark(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Bytes of Spark's image source (BGR, BGRA or grey) as RGB."""
    raw = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(raw, 3, axis=2) if channels == 1 else raw[:, :, 2::-1]


def grey(rgb: np.ndarray) -> np.ndarray:
    """Luma of an RGB image, rounded."""
    return np.rint(rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def _taps(size: int, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each target pixel: the two source pixels around its centre and the weight of the second."""
    centre = np.clip((np.arange(target) + 0.5) * size / target - 0.5, 0, size - 1)
    low = np.floor(centre).astype(int)
    return low, np.minimum(low + 1, size - 1), centre - low


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with pixel centres aligned; whole numbers stay whole numbers, rounded."""
    if image.shape[:2] == (height, width):
        return image
    y0, y1, wy = _taps(image.shape[0], height)
    x0, x1, wx = _taps(image.shape[1], width)
    extra = (1,) * (image.ndim - 2)
    wy, wx = wy.reshape(-1, 1, *extra), wx.reshape(1, -1, *extra)
    source = image.astype(np.float64)
    rows = source[y0] * (1 - wy) + source[y1] * wy
    out = rows[:, x0] * (1 - wx) + rows[:, x1] * wx
    return np.floor(out + 0.5).astype(image.dtype) if np.issubdtype(image.dtype, np.integer) else out.astype(image.dtype)


def normalise(rgb: np.ndarray, mean=MEAN, std=STD) -> np.ndarray:
    return ((rgb / 255.0 - np.array(mean)) / np.array(std)).astype(np.float32)


def denormalise(values: np.ndarray, mean=MEAN, std=STD) -> np.ndarray:
    return (np.clip(values * np.array(std) + np.array(mean), 0, 1) * 255).astype(np.uint8)


def probabilities(logits) -> np.ndarray:
    return 1 / (1 + np.exp(-np.asarray(logits, np.float64)))


def water(p: np.ndarray) -> np.ndarray:
    """Where the probability is strictly above one half."""
    return p > 0.5


def paint(shape: tuple, *layers: tuple[np.ndarray, tuple[int, int, int]]) -> np.ndarray:
    """A black canvas with each mask filled in its colour, later ones on top."""
    canvas = np.zeros(shape, np.uint8)
    for where, colour in layers:
        canvas[where] = colour
    return canvas


def blend(base: np.ndarray, top: np.ndarray, alpha: float) -> np.ndarray:
    """(1 - alpha) of the base plus alpha of the top, rounded."""
    return np.rint(base * (1 - alpha) + top * alpha).clip(0, 255).astype(np.uint8)


def png(image: np.ndarray) -> bytes:
    """8-bit grey or RGB image as PNG bytes."""
    height, width = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(height, -1)
    body = zlib.compress(np.hstack([np.zeros((height, 1), np.uint8), rows]).tobytes(), 6)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", body) + chunk(b"IEND", b"")
