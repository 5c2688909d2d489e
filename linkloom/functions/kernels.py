"""Similarities of tokens and of token lists over whole Arrow batches, in numpy; no loop over rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Positions that a bit mask holds; longer tokens are compared one pair at a time.
BITS = 64
#: Cells of the table of masks; vocabularies with more different characters are compared one pair at a time.
CELLS = 1 << 24
#: Pairs of tokens that are compared at once, about.
PAIRS = 1 << 15


def jaro_of(a: str, b: str) -> float:
    """One pair, of any length. Transpositions are counted in whole pairs."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, own = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(i - reach, 0), min(i + reach + 1, len(b))):
            if free[j] and b[j] == c:
                free[j] = False
                own.append(c)
                break
    m = len(own)
    if not m:
        return 0.0
    off = sum(x != y for x, y in zip(own, [c for c, f in zip(b, free, strict=True) if not f], strict=True))
    return (m / len(a) + m / len(b) + (m - off // 2) / m) / 3


class Tokens:
    """A vocabulary, laid out for comparing pairs of its tokens by their numbers."""

    def __init__(self, words: pa.LargeStringArray):
        self.words = words
        self.size = pc.utf8_length(words).to_numpy().astype(np.int64)
        most = int(self.size.max(initial=1))
        off = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        raw = words.buffers()[2].slice(off[0], off[-1] - off[0]).to_pybytes() if len(words) and words.buffers()[2] is not None else b""
        code = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        letters, code = np.unique(code, return_inverse=True)
        begin = np.cumsum(self.size) - self.size
        row = np.repeat(np.arange(len(words)), self.size)
        place = np.arange(len(code)) - np.repeat(begin, self.size)
        blank = len(letters)
        #: Characters by number; behind the end, one that no token has.
        self.chars = np.full((len(words), most + 1), blank, np.int64)
        self.chars[row, place] = code
        self.masks = None
        if (blank + 1) * len(words) <= CELLS:
            self.masks = np.zeros((len(words), blank + 1), np.uint64)
            low = place < BITS
            np.bitwise_or.at(self.masks, (row[low], code[low]), np.uint64(1) << place[low].astype(np.uint64))

    def jaro(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for i in range(0, len(x), PAIRS):
            out[i : i + PAIRS] = self._jaro(x[i : i + PAIRS], y[i : i + PAIRS])
        return out

    def _jaro(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Matches are kept as bit masks: of y's free places in reach that hold the character, the lowest is taken."""
        nx, ny = self.size[x], self.size[y]
        if self.masks is None:
            return np.array([jaro_of(self.words[i].as_py(), self.words[j].as_py()) for i, j in zip(x.tolist(), y.tolist(), strict=True)], np.float64)
        one, full = np.uint64(1), np.uint64(2**64 - 1)
        reach = np.maximum(np.maximum(nx, ny) // 2 - 1, 0)
        used, own = np.zeros(len(x), np.uint64), np.zeros(len(x), np.uint64)
        for i in range(min(int(nx.max(initial=0)), BITS)):
            low = np.minimum(np.maximum(i - reach, 0), BITS - 1).astype(np.uint64)
            high = np.maximum(BITS - 1 - i - reach, 0).astype(np.uint64)
            free = self.masks[y, self.chars[x, i]] & (full << low) & (full >> high) & ~used
            bit = free & (~free + one)
            used |= bit
            own |= (bit != 0).astype(np.uint64) << np.uint64(i)
        m = np.bitwise_count(own).astype(np.int64)
        off = np.zeros(len(x), np.int64)
        left, right = own.copy(), used.copy()
        for _ in range(int(m.max(initial=0))):
            a, b = left & (~left + one), right & (~right + one)
            live = a != 0
            i, j = (np.bitwise_count(np.where(live, p - one, 0)).astype(np.int64) for p in (a, b))
            off += live & (self.chars[x, i] != self.chars[y, j])
            left, right = left ^ a, right ^ b
        some = np.maximum(m, 1)
        out = np.where(m > 0, (m / np.maximum(nx, 1) + m / np.maximum(ny, 1) + (m - off // 2) / some) / 3, 0.0)
        out[(x == y) & (nx > 0)] = 1.0
        for k in np.flatnonzero(np.maximum(nx, ny) > BITS):
            out[k] = jaro_of(self.words[int(x[k])].as_py(), self.words[int(y[k])].as_py())
        return out

    def prefix(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix, four at most."""
        out, same = np.zeros(len(x), np.int64), np.ones(len(x), bool)
        for k in range(min(4, self.chars.shape[1] - 1)):
            same &= (self.chars[x, k] == self.chars[y, k]) & (k < self.size[x])
            out += same
        return out

    def jaro_winkler(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        j = self.jaro(x, y)
        return j + 0.1 * self.prefix(x, y) * (1 - j)

    def similarity(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal tokens 1; an initial against a token that begins with it at least 0.95."""
        initial = ((self.size[x] == 1) | (self.size[y] == 1)) & (self.chars[x, 0] == self.chars[y, 0])
        out = np.maximum(self.jaro_winkler(x, y), np.where(initial, 0.95, 0.0))
        out[x == y] = 1.0
        return out

    def similarities(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The same; where the pairs repeat much, from a matrix of the tokens that occur."""
        (xs, i), (ys, j) = (np.unique(z, return_inverse=True) for z in (x, y))
        if len(xs) * len(ys) > len(x):
            return self.similarity(x, y)
        matrix = self.similarity(np.repeat(xs, len(ys)), np.tile(ys, len(xs)))
        return matrix[i * len(ys) + j]


def numbered(*columns: pa.Array) -> tuple[Tokens, list[np.ndarray]]:
    """The vocabulary of string arrays, and each one's tokens by number (null: as an empty one)."""
    whole = pa.concat_arrays([c.cast(pa.large_string()).fill_null("") for c in columns]).dictionary_encode()
    at = whole.indices.to_numpy()
    cut = np.cumsum([len(c) for c in columns])[:-1]
    return Tokens(whole.dictionary), np.split(at, cut)


def lists(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A list column's members, and where each row's begin and how many there are (null: none)."""
    column = column.cast(pa.large_list(pa.large_string()))
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    n = np.diff(off)
    if column.null_count:
        n = np.where(np.asarray(column.is_valid()), n, 0)
    return column.values, off[:-1], n


def name_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """For each token its best match on the other side, averaged, both ways, averaged; null if a side is empty."""
    (va, at, na), (vb, bt, nb) = lists(a), lists(b)
    vocabulary, (ta, tb) = numbered(va, vb)
    out, some = np.zeros(len(a)), np.flatnonzero((na > 0) & (nb > 0))
    work = np.cumsum(na[some] * nb[some])
    for part in np.split(some, np.searchsorted(work, np.arange(PAIRS, work[-1] if len(work) else 0, PAIRS))):
        if not len(part):
            continue
        ma, mb = na[part], nb[part]
        cells = ma * mb
        begin = np.cumsum(cells) - cells
        inside = np.arange(cells.sum()) - np.repeat(begin, cells)
        width = np.repeat(mb, cells)
        i, j = inside // width, inside % width
        sim = vocabulary.similarities(ta[np.repeat(at[part], cells) + i], tb[np.repeat(bt[part], cells) + j])
        rows = np.maximum.reduceat(sim, np.flatnonzero(j == 0))
        # The same cells by column: cell (j, i) of a pair is its cell i * width + j.
        height = np.repeat(ma, cells)
        turned = np.repeat(begin, cells) + inside % height * width + inside // height
        columns = np.maximum.reduceat(sim[turned], np.flatnonzero(inside % height == 0))
        mean = [np.add.reduceat(best, np.cumsum(m) - m) / m for best, m in ((rows, ma), (columns, mb))]
        out[part] = (mean[0] + mean[1]) / 2
    return pa.array(out, mask=(na == 0) | (nb == 0))
