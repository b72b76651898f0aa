"""Words of a text in blocks, so that a text of any length needs the memory of one block (or of its longest word)."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK = 1 << 20


def word_blocks(data: bytes, word: re.Pattern, gap: re.Pattern, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Matches of ``word`` in order. ``gap`` matches one byte that no word holds; blocks end there, at ``size`` bytes or later."""
    start = 0
    while start < len(data):
        cut = gap.search(data, start + size)
        end = cut.start() if cut else len(data)
        yield word.findall(data, start, end)
        start = end
