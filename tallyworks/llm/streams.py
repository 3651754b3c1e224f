"""Plain bytes of stored archives, from plain files and from gzip members with or without a skip length."""

from __future__ import annotations

import struct
import zlib

#: Head of a gzip member whose extra field ``sl`` gives its compressed and plain lengths.
HEAD = struct.Struct("<4sIBBHBBHII")
#: Least bytes read and inflated at a time.
STEP = 4096


class Plain:
    """A file's bytes in order; what isn't wanted is passed over."""

    def __init__(self, file):
        self.file, self.at, self.end = file, 0, file.size()
        self.held = bytearray()

    def more(self, hint: int = STEP) -> bytes:
        """Some of the next bytes; none at the end."""
        data = self.file.read_at(min(max(hint, STEP), self.end - self.at), self.at) if self.at < self.end else b""
        self.at += len(data)
        return data

    def fill(self, hint: int = STEP) -> bool:
        data = self.more(hint)
        self.held += data
        return bool(data)

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.fill(n - len(self.held)):
                raise ValueError("the archive is cut short")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, n: int) -> None:
        here = min(n, len(self.held))
        del self.held[:here]
        self.pass_over(n - here)

    def pass_over(self, n: int) -> None:
        if n > self.end - self.at:
            raise ValueError("the archive is cut short")
        self.at += n

    def head(self, most: int | None = None) -> tuple[bytes, int] | None:
        """The next header block and where what follows it begins; None if there is none within ``most`` bytes."""
        looked = 0
        while True:
            ends = [(a, a + len(mark)) for mark in (b"\n\r\n", b"\n\n") if (a := self.held.find(mark, looked, most)) >= 0]
            if ends:
                a, after = min(ends)
                return bytes(self.held[:a]).rstrip(b"\r"), after
            looked = max(0, len(self.held) - 2)
            if (most is not None and len(self.held) >= most) or not self.fill():
                return None

    def next_record(self) -> bool:
        """Go to the next byte that isn't a line break; False at the end."""
        while True:
            rest = self.held.lstrip(b"\r\n")
            if rest:
                del self.held[: len(self.held) - len(rest)]
                return True
            self.held.clear()
            if not self.fill():
                return False


class Gzip(Plain):
    """The bytes that a file of gzip members holds; a member that gives its lengths can be left early."""

    def __init__(self, file):
        super().__init__(file)
        self.raw = b""
        self.inflate = None
        self.length: int | None = None

    def _read(self, hint: int) -> bool:
        data = super().more(hint)
        self.raw += data
        return bool(data)

    def _begin(self) -> bool:
        while len(self.raw) < HEAD.size and self._read(STEP):
            pass
        if not self.raw:
            return False
        self.start = self.at - len(self.raw)
        if self.raw[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {self.start}")
        self.size = self.length = None
        if len(self.raw) >= HEAD.size:
            magic, *_, s, l, width, size, length = HEAD.unpack(self.raw[: HEAD.size])
            if magic == b"\x1f\x8b\x08\x04" and (s, l, width) == (ord("s"), ord("l"), 8):
                self.size, self.length = size, length
        self.out, self.inflate = 0, zlib.decompressobj(16 + zlib.MAX_WBITS)
        return True

    def more(self, hint: int = STEP) -> bytes:
        while True:
            if self.inflate is None and not self._begin():
                return b""
            whole = bool(self.raw) or self._read(hint)
            out = self.inflate.decompress(self.raw, max(hint, STEP))
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            else:
                self.raw = self.inflate.unconsumed_tail
                if not whole and not out:
                    raise ValueError("the archive is cut short")
            if out:
                self.out += len(out)
                return out

    def pass_over(self, n: int) -> None:
        while n > 0:
            # all of ``held`` is used up; a record that ends its member, but for four line break bytes, is left at once
            if self.inflate is not None and self.length is not None and n <= self.length - self.out <= n + 4:
                follows = self.start + self.size
                behind = follows - (self.at - len(self.raw))
                self.raw, self.at = (self.raw[behind:], self.at) if behind <= len(self.raw) else (b"", follows)
                self.inflate = None
                return
            data = self.more(1 << 16)
            if not data:
                raise ValueError("the archive is cut short")
            self.held += data[n:]
            n -= len(data)


def opened(file) -> Plain:
    """A stream over an open file, by its first bytes."""
    return Gzip(file) if file.size() >= 2 and file.read_at(2, 0) == b"\x1f\x8b" else Plain(file)
