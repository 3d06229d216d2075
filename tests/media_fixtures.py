"""Tiny media writers for tests (no imaging/audio libraries needed)."""

import json
import struct
import wave
import zlib

import numpy as np


def png_bytes(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def checkerboard(size=256, cell=8) -> np.ndarray:
    y, x = np.indices((size, size))
    g = (((y // cell) + (x // cell)) % 2 * 255).astype(np.uint8)
    return np.stack([g, g, g], axis=-1)


def box_blur(img: np.ndarray, k=9) -> np.ndarray:
    pad = k // 2
    a = np.pad(img.astype(np.float64), ((pad, pad), (pad, pad), (0, 0)), mode="edge")
    out = np.zeros_like(img, dtype=np.float64)
    for dy in range(k):
        for dx in range(k):
            out += a[dy:dy + img.shape[0], dx:dx + img.shape[1]]
    return np.rint(out / (k * k)).astype(np.uint8)


def wav_bytes(samples: np.ndarray, rate=16000, channels=1) -> bytes:
    import io
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return buf.getvalue()


def write_jsonl(path, rows):
    with open(path, "w") as fp:
        for r in rows:
            fp.write(json.dumps(r, ensure_ascii=False) + "\n")
