"""The msgpack format for JSON-like values, so that no extra package is needed on the workers."""

from __future__ import annotations

import struct

# Type bytes of the published format. kind -> (byte, struct code of the length or value)
_INTS = ((0xCC, ">B"), (0xCD, ">H"), (0xCE, ">I"), (0xCF, ">Q"), (0xD0, ">b"), (0xD1, ">h"), (0xD2, ">i"), (0xD3, ">q"))
_SIZED = {"bin": ((0xC4, ">B"), (0xC5, ">H"), (0xC6, ">I")), "str": ((0xD9, ">B"), (0xDA, ">H"), (0xDB, ">I")), "list": ((0xDC, ">H"), (0xDD, ">I")), "map": ((0xDE, ">H"), (0xDF, ">I"))}
_SHORT = {"str": (0xA0, 32), "list": (0x90, 16), "map": (0x80, 16)}


def _head(kind: str, n: int) -> bytes:
    base, most = _SHORT.get(kind, (0, 0))
    if n < most:
        return bytes([base | n])
    for byte, code in _SIZED[kind]:
        if n < 1 << 8 * struct.calcsize(code):
            return bytes([byte]) + struct.pack(code, n)
    raise ValueError("too long")


def pack(x: object) -> bytes:
    """Bytes of None, booleans, numbers, text, bytes, lists and maps."""
    if x is None:
        return b"\xc0"
    if isinstance(x, bool):
        return b"\xc3" if x else b"\xc2"
    if isinstance(x, int):
        if -32 <= x < 128:
            return struct.pack(">b" if x < 0 else ">B", x)
        for byte, code in _INTS[:4] if x >= 0 else _INTS[4:]:
            bits = 8 * struct.calcsize(code)
            if (0 <= x < 1 << bits) if x >= 0 else x >= -(1 << bits - 1):
                return bytes([byte]) + struct.pack(code, x)
        raise ValueError("an integer above 64 bits")
    if isinstance(x, float):
        return b"\xcb" + struct.pack(">d", x)
    if isinstance(x, str):
        data = x.encode("utf-8", "surrogatepass")
        return _head("str", len(data)) + data
    if isinstance(x, (bytes, bytearray)):
        return _head("bin", len(x)) + bytes(x)
    if isinstance(x, (list, tuple)):
        return _head("list", len(x)) + b"".join(map(pack, x))
    if isinstance(x, dict):
        return _head("map", len(x)) + b"".join(pack(k) + pack(v) for k, v in x.items())
    raise TypeError(type(x).__name__)


def unpack(data: bytes) -> object:
    """The one value that ``data`` holds; ValueError where it holds none, more, or a type that JSON lacks."""
    x, at = _read(data, 0)
    if at != len(data):
        raise ValueError("bytes after the value")
    return x


def _take(data: bytes, at: int, n: int) -> tuple[bytes, int]:
    if at + n > len(data):
        raise ValueError("the value is cut short")
    return data[at : at + n], at + n


def _number(data: bytes, at: int, code: str) -> tuple[int | float, int]:
    part, at = _take(data, at, struct.calcsize(code))
    return struct.unpack(code, part)[0], at


def _body(kind: str, data: bytes, at: int, n: int) -> tuple[object, int]:
    if kind == "str":
        part, at = _take(data, at, n)
        return part.decode("utf-8", "surrogatepass"), at
    if kind == "bin":
        part, at = _take(data, at, n)
        return part.decode("utf-8", "replace"), at
    items = []
    for _ in range(n if kind == "list" else 2 * n):
        x, at = _read(data, at)
        items.append(x)
    return (items if kind == "list" else dict(zip(items[::2], items[1::2], strict=True))), at


def _read(data: bytes, at: int) -> tuple[object, int]:
    first, at = _take(data, at, 1)
    b = first[0]
    if b < 0x80 or b >= 0xE0:
        return (b if b < 0x80 else b - 256), at
    if b in (0xC0, 0xC2, 0xC3):
        return {0xC0: None, 0xC2: False, 0xC3: True}[b], at
    if b in (0xCA, 0xCB):
        return _number(data, at, ">f" if b == 0xCA else ">d")
    for kind, (base, most) in _SHORT.items():
        if base <= b < base + most:
            return _body(kind, data, at, b - base)
    for byte, code in _INTS:
        if b == byte:
            return _number(data, at, code)
    for kind, forms in _SIZED.items():
        for byte, code in forms:
            if b == byte:
                n, at = _number(data, at, code)
                return _body(kind, data, at, n)
    raise ValueError(f"type byte {b:#x}")
