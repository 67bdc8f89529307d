"""The first file of a 7z archive as a stream, in any Python process: no staging by the driver, memory of one buffer.

Read are archives whose first folder has one coder: copied, LZMA, LZMA2 or bzip2, which is what dumps are packed with.
"""

from __future__ import annotations

import bz2
import io
import lzma
import struct

_SIGNATURE = b"7z\xbc\xaf\x27\x1c"
# Fixed values of the format: property ids and coder ids.
_END, _HEADER, _STREAMS, _PACK, _UNPACK, _SUB, _SIZE, _CRC, _FOLDER, _CODER_SIZES, _COUNTS, _ENCODED = 0x00, 0x01, 0x04, 0x06, 0x07, 0x08, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x17
_COPY, _LZMA2, _LZMA, _BZIP2 = b"\x00", b"\x21", b"\x03\x01\x01", b"\x04\x02\x02"
_BUFFER = 1 << 20


class _Fields(io.BytesIO):
    def byte(self) -> int:
        got = self.read(1)
        if not got:
            raise ValueError("7z header ends early")
        return got[0]

    def number(self) -> int:
        """The leading one bits of the first byte tell how many bytes follow; its other bits are the highest."""
        first, value = self.byte(), 0
        for i in range(8):
            if not first & (0x80 >> i):
                return value | (first & ((0x80 >> i) - 1)) << (8 * i)
            value |= self.byte() << (8 * i)
        return value

    def digests(self, n: int) -> None:
        known = n
        if not self.byte():
            known = sum(bin(b).count("1") for b in self.read((n + 7) // 8))
        self.read(4 * known)


def _coder(f: _Fields) -> tuple[bytes, bytes]:
    """(method, properties) of a folder's only coder."""
    if f.number() != 1:
        raise ValueError("7z: folders of several coders are not read")
    flags = f.byte()
    method = f.read(flags & 15)
    if flags & 0x10 and (f.number(), f.number()) != (1, 1):
        raise ValueError("7z: coders of several streams are not read")
    return method, f.read(f.number()) if flags & 0x20 else b""


def _streams(f: _Fields) -> tuple[int, int, tuple[bytes, bytes], int]:
    """(position, packed size, coder, size) of the first file's stream."""
    at = packed = size = 0
    coder, counts, sizes = None, [1], []
    while (kind := f.number()) != _END:
        if kind == _PACK:
            at, n = f.number(), f.number()
            while (k := f.number()) != _END:
                if k == _SIZE:
                    packed = [f.number() for _ in range(n)][0] if n else 0
                elif k == _CRC:
                    f.digests(n)
        elif kind == _UNPACK:
            while (k := f.number()) != _END:
                if k == _FOLDER:
                    n = f.number()
                    if f.byte():
                        raise ValueError("7z: external folders are not read")
                    coders = [_coder(f) for _ in range(n)]
                    coder, counts = coders[0] if coders else None, [1] * n
                elif k == _CODER_SIZES:
                    sizes = [f.number() for _ in counts]
                elif k == _CRC:
                    f.digests(len(counts))
        elif kind == _SUB:
            size = 0
            while (k := f.number()) != _END:
                if k == _COUNTS:
                    counts = [f.number() for _ in counts]
                elif k == _SIZE and counts and counts[0] > 1:
                    size = f.number()
                    break  # what follows concerns the other files
                else:
                    break
            break
    if coder is None:
        raise ValueError("7z: no file in the archive")
    return at, packed, coder, size or (sizes[0] if sizes else 0)


def _decoder(method: bytes, props: bytes):
    if method == _COPY:
        return None
    if method == _LZMA:
        rest, dictionary = props[0], struct.unpack("<I", props[1:5])[0]
        return lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA1, "dict_size": max(dictionary, 4096), "lc": rest % 9, "lp": rest // 9 % 5, "pb": rest // 45}])
    if method == _LZMA2:
        k = props[0]
        return lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA2, "dict_size": 0xFFFFFFFF if k == 40 else (2 | k & 1) << (k // 2 + 11)}])
    if method == _BZIP2:
        return bz2.BZ2Decompressor()
    raise ValueError(f"7z: method {method.hex()} is not read")


class _Stream(io.RawIOBase):
    def __init__(self, file, at: int, packed: int, coder: tuple[bytes, bytes], size: int):
        self.file, self.left, self.rest, self.decoder = file, packed, size, _decoder(*coder)
        file.seek(at)

    def readable(self):
        return True

    def readinto(self, buffer):
        want = min(len(buffer), self.rest)
        while want:
            data = b""
            if self.decoder is None or self.decoder.needs_input:
                data = self.file.read(min(self.left, want if self.decoder is None else _BUFFER))
                self.left -= len(data)
                if not data:
                    raise EOFError("7z: the archive ends early")
            out = data if self.decoder is None else self.decoder.decompress(data, want)
            if out:
                buffer[: len(out)] = out
                self.rest -= len(out)
                return len(out)
        return 0

    def close(self):
        self.file.close()
        super().close()


def open_7z(path: str) -> io.BufferedReader:
    """The archive's first file, decompressed as it is read."""
    file = open(path, "rb")  # noqa: SIM115
    try:
        start = file.read(32)
        if start[:6] != _SIGNATURE:
            raise ValueError(f"{path}: not a 7z archive")
        offset, size = struct.unpack("<QQ", start[12:28])
        file.seek(32 + offset)
        f = _Fields(file.read(size))
        if not size:
            raise ValueError(f"{path}: no file in the archive")
        while (kind := f.number()) == _ENCODED:
            at, packed, coder, length = _streams(f)
            f = _Fields(io.BufferedReader(_Stream(open(path, "rb"), 32 + at, packed, coder, length)).read())  # noqa: SIM115
        if kind != _HEADER or f.number() != _STREAMS:
            raise ValueError(f"{path}: no file in the archive")
        at, packed, coder, length = _streams(f)
    except BaseException:
        file.close()
        raise
    return io.BufferedReader(_Stream(file, 32 + at, packed, coder, length), _BUFFER)
