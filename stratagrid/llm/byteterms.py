"""Words of UTF-8 bytes through one translate table: letters lowered, separators blanked, then split."""

from __future__ import annotations

from collections.abc import Iterator

STRETCH = 1 << 20  # bytes split at once, so that a very long text never becomes one list of words


def translate_table(ranges: list[tuple[int, int]]) -> bytes:
    """Maps A-Z to a-z and the given inclusive byte ranges to a space."""
    table = bytearray(range(256))
    for upper in range(65, 91):
        table[upper] = upper + 32
    for low, high in ranges:
        for byte in range(low, high + 1):
            table[byte] = 32
    return bytes(table)


#: Words of letters and bytes beyond ASCII.
LETTERS = translate_table([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: The same with digits.
LETTERS_DIGITS = translate_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def words(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a whole text in order, a stretch of about ``STRETCH`` bytes at a time."""
    blanked = text.translate(table)
    begin = 0
    while begin < len(blanked):
        end = blanked.find(b" ", begin + STRETCH)
        if begin == 0 and end < 0:
            yield blanked.split()
            return
        end = len(blanked) if end < 0 else end
        yield blanked[begin:end].split()
        begin = end
