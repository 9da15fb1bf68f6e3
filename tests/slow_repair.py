"""Size repair of packed pieces, a plain function over the pieces of one section."""

from __future__ import annotations

# Minimum of a piece and ceiling of two joined pieces, in estimated tokens (fixed values).
CHUNK_MIN = 400
CHUNK_MERGE_MAX = 960


def _size(units: int) -> int:
    return -(-units // 4)


class _Piece:
    """Paragraphs with their UTF-16 sizes, so joins need not be built to be measured."""

    def __init__(self, texts: list[str], sizes: list[int]):
        self.texts, self.sizes = texts, sizes

    @property
    def tokens(self) -> int:
        return _size(sum(self.sizes) + 2 * (len(self.sizes) - 1))

    def __add__(self, other: "_Piece") -> "_Piece":
        return _Piece(self.texts + other.texts, self.sizes + other.sizes)

    def split(self, at: int) -> tuple["_Piece", "_Piece"]:
        return _Piece(self.texts[:at], self.sizes[:at]), _Piece(self.texts[at:], self.sizes[at:])


def _even_split(both: _Piece) -> int:
    """Paragraph boundary that leaves the two sides closest in size."""
    each = [_size(s) for s in both.sizes]
    total, left, gaps = sum(each), 0, []
    for t in each[:-1]:
        left += t
        gaps.append(abs(2 * left - total))
    return gaps.index(min(gaps)) + 1


def _rebalanced(row: list[_Piece], i: int) -> bool:
    sides = [j for j in (i - 1, i + 1) if 0 <= j < len(row)]
    if not sides:
        return False
    # The larger neighbour; on equal size the following one.
    j = max(sides, key=lambda s: (row[s].tokens, s))
    if len(row[j].texts) < 2:
        return False
    a, b = min(i, j), max(i, j)
    both = row[a] + row[b]
    if sum(_size(s) for s in both.sizes) < 2 * CHUNK_MIN:
        return False
    first, second = both.split(_even_split(both))
    if min(first.tokens, second.tokens) < CHUNK_MIN:
        return False
    row[a], row[b] = first, second
    return True


def _repair_once(row: list[_Piece]) -> bool:
    changed, i = False, 0
    while i < len(row):
        if row[i].tokens < CHUNK_MIN:
            home = next(
                (
                    j
                    for j in (i - 1, i)
                    if 0 <= j and j + 1 < len(row) and (row[j] + row[j + 1]).tokens <= CHUNK_MERGE_MAX
                ),
                None,
            )
            if home is not None:
                row[home : home + 2] = [row[home] + row[home + 1]]
                changed = True
                continue
            if _rebalanced(row, i):
                changed = True
                continue
        i += 1
    return changed


def repair_pieces(pieces: list[list[str]]) -> list[list[str]]:
    """Bring pieces under the minimum up to size: join a neighbour when the two fit,
    else share paragraphs with the larger neighbour, else leave. Two passes at most."""
    row = [_Piece(list(p), [len(t.encode("utf-16-be")) // 2 for t in p]) for p in pieces]
    if _repair_once(row):
        _repair_once(row)
    return [p.texts for p in row]


def repair_sections(sections):
    """Repair every packed section of a row; a section given as None stays None."""
    if sections is None:
        return None
    return [None if p is None else repair_pieces([list(piece) for piece in p]) for p in sections]
