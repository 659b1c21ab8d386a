"""Compressed sizes under raw-content zstandard dictionaries."""

from __future__ import annotations

import zstandard

#: Bytes that are compressed at a time, each piece with the dictionary in reach.
PIECE = 4096
LEVEL = 6


class Sizes:
    """Size of a text under one dictionary; pieces of a long text are compressed one by one."""

    def __init__(self, dictionary: bytes = b"", level: int = LEVEL):
        more = {}
        if len(dictionary) >= 8:
            content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            more = {"dict_data": content, "write_dict_id": False}
        self._compress = zstandard.ZstdCompressor(
            level=level, write_content_size=False, write_checksum=False, **more
        ).compress

    def __call__(self, data: bytes) -> int:
        if len(data) <= PIECE:
            return len(self._compress(data))
        return sum(len(self._compress(data[i : i + PIECE])) for i in range(0, len(data), PIECE))
