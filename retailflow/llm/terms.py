"""Terms of whole texts: maximal runs of chosen ASCII characters and of everything beyond ASCII."""

from collections.abc import Iterator

PIECE_BYTES = 8 << 20  # of one text that are split at once

# Letters A-Z are lowered; bytes of no term become spaces. UTF-8 keeps ASCII apart from the
# bytes of other characters, so runs of bytes are runs of characters.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in bytes(range(256)).lower())
LETTERS_DIGITS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def term_lists(raw: bytes | None, kind: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    if not raw:
        return
    if len(raw) <= PIECE_BYTES:
        yield raw.translate(kind).split()
        return
    start, held = 0, b""
    while start < len(raw):
        piece = held + raw[start : start + PIECE_BYTES].translate(kind)
        start += PIECE_BYTES
        # What follows the last gap may go on in the next piece.
        gap = piece.rfind(b" ") + 1 if start < len(raw) else len(piece)
        held = piece[gap:]
        yield piece[:gap].split()
