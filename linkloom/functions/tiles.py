"""Levels of whole blocks of pairs in numpy: a column's values are numbered once a batch, and a pair costs some operations on small integers.

Rows are named by two index arrays that broadcast: (n, 1) and (1, k) for all pairs of a block, or twice (n,) for single pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa

from linkloom.functions import kernels

#: Pairs that are held as a matrix at once, about.
TILE = 1 << 18
#: Blocks with fewer pairs are compared as single pairs, many blocks together.
FEW = 1 << 10
#: Bytes of token rows that a block keeps, of similarities and as spread over names.
KEPT = 1 << 26
#: Pairs of tokens that are compared at once, about: what the caches hold.
CELLS = 1 << 16
#: Pairs of names whose levels are told at once, about.
NAMED = 1 << 16
#: How far a similarity in single precision may be from a threshold and still be computed again in double precision.
NEAR = 1e-5


class Vectors:
    """Tokens against which others are compared one by one: for each character the places that hold it, as a bit mask a token.

    A comparison is a run of operations on whole columns for many tokens of one length at once, without a gather of cells.
    """

    def __init__(self, words: list[str], bits: int, exact: bool = False):
        self.exact = exact
        self.kind = {16: np.uint16, 32: np.uint32, 64: np.uint64}[bits]
        self.size = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        letters, code = np.unique(code, return_inverse=True)
        self.at = {chr(c): i for i, c in enumerate(letters.tolist())}
        self.masks = np.zeros((len(letters) + 1, len(words)), self.kind)  # the last: a letter that none has
        place = np.arange(len(code)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        np.bitwise_or.at(self.masks, (code, np.repeat(np.arange(len(words)), self.size)), (np.uint64(1) << place.astype(np.uint64)).astype(self.kind))
        self.lengths, self.length_of = np.unique(self.size, return_inverse=True)
        self.windows: dict[tuple[int, int], np.ndarray] = {}
        self.inverse = (1 / np.maximum(self.size, 1)).astype(np.float32)

    def window(self, n: int, i: int) -> np.ndarray:
        """The places of each token that character i of a token of length n may match."""
        if (n, i) not in self.windows:
            masks = []
            for k in self.lengths.tolist():
                reach = max(max(n, k) // 2 - 1, 0)
                masks.append(sum(1 << j for j in range(max(i - reach, 0), min(i + reach + 1, k))))
            self.windows[n, i] = np.array(masks, self.kind)[self.length_of]
        return self.windows[n, i]

    def similarities(self, xs: list[str]) -> np.ndarray:
        """kernels.Tokens.similarity of each x, all of one length, with each token, in single precision (exact: its very value) (x, token)."""
        kind, n, shape = self.kind, len(xs[0]), (len(xs), len(self.size))
        if not n or not shape[1]:
            return np.zeros(shape, np.float64 if self.exact else np.float32)
        letter = [np.array([self.at.get(x[i], len(self.at)) for x in xs]) for i in range(n)]
        free = np.full(shape, np.iinfo(kind).max, kind)
        bit, low, mask, some, m = np.empty(shape, kind), np.empty(shape, kind), np.empty(shape, kind), np.empty(shape, bool), np.zeros(shape, np.uint8)
        hits = []
        prefix, same, first = np.zeros(shape, np.uint8), np.ones(shape, bool), None
        for i in range(n):
            np.take(self.masks, letter[i], axis=0, out=mask, mode="clip")
            if i < 4:
                np.bitwise_and(mask, kind(1 << i), out=bit)
                np.not_equal(bit, 0, out=some)
                same &= some
                prefix += same.view(np.uint8)
                first = same.copy() if not i else first
            np.bitwise_and(mask, self.window(n, i), out=bit)
            bit &= free
            np.negative(bit, out=low)
            bit &= low
            free ^= bit
            hit = bit != 0
            m += hit.view(np.uint8)
            hits.append(hit)
        used, off = np.invert(free, out=free), np.zeros(shape, np.uint8)
        for i, hit in enumerate(hits):  # the k-th match on one side against the k-th on the other
            np.negative(used, out=low)
            low &= used
            np.multiply(low, hit, out=low)
            used ^= low
            np.take(self.masks, letter[i], axis=0, out=mask, mode="clip")
            np.bitwise_and(low, mask, out=bit)
            np.not_equal(low, bit, out=some)
            off += some.view(np.uint8)
        if self.exact:  # the kernel's operations in its order
            k = m.astype(np.float64)
            jaro = k / n
            jaro += k / np.maximum(self.size, 1)
            jaro += (m - (off >> 1)) / np.maximum(k, 1)
            jaro /= 3
            jaro += 0.1 * prefix * (1 - jaro)
            return np.maximum(jaro, 0.95, out=jaro, where=first if n == 1 else first & (self.size == 1))
        k = m.astype(np.float32)
        jaro = k * (self.inverse + np.float32(1 / n))
        off >>= 1
        m -= off
        np.maximum(k, np.float32(1), out=k)
        jaro += np.divide(m, k, out=k)
        jaro *= np.float32(1 / 3)
        np.multiply(prefix, np.float32(0.1), out=k)
        k *= 1 - jaro
        jaro += k
        return np.maximum(jaro, np.float32(0.95), out=jaro, where=first if n == 1 else first & (self.size == 1))


class Vocabulary:
    """All tokens of a block's right side, of any length; in order of length there is least to move."""

    def __init__(self, words: list[str], exact: bool = False):
        size = np.array([len(w) for w in words], np.int64)
        self.words, self.parts, self.kind = words, [], np.float64 if exact else np.float32
        for low, high in ((-1, 16), (16, 64)):
            own = np.flatnonzero((size > low) & (size <= high))
            if len(own):
                run = own[-1] - own[0] == len(own) - 1
                self.parts.append((slice(own[0], own[-1] + 1) if run else own, Vectors([words[i] for i in own], high, exact)))
        self.long = np.flatnonzero(size > 64)

    def similarity(self, x: str) -> np.ndarray:
        return self.similarities([x])[0]

    def similarities(self, xs: list[str]) -> np.ndarray:
        """Of each x with each token (x, token), and behind the last 0."""
        out = np.zeros((len(xs), len(self.words) + 1), self.kind)
        by: dict[int, list[int]] = {}
        for k, x in enumerate(xs):
            by.setdefault(len(x), []).append(k)
        for n, rows in by.items():
            for own, vectors in self.parts if n <= 64 else ():
                step = max(1, CELLS // len(vectors.size))
                for a in range(0, len(rows), step):
                    some = rows[a : a + step]
                    for k, got in zip(some, vectors.similarities([xs[k] for k in some]), strict=True):
                        out[k, own] = got
            for k in rows:
                for i in self.long if n <= 64 else range(len(self.words)):
                    out[k, i] = one_similarity(xs[k], self.words[i])
        return out


def one_similarity(x: str, y: str) -> float:
    j = kernels.jaro_of(x, y)
    p = next((k for k in range(min(4, len(x), len(y))) if x[k] != y[k]), min(4, len(x), len(y)))
    j += 0.1 * p * (1 - j)
    return max(j, 0.95) if min(len(x), len(y)) == 1 and x[0] == y[0] else j


def padded(code: np.ndarray, begin: np.ndarray, n: np.ndarray, fill: float = -1) -> np.ndarray:
    """Lists as the columns of a matrix (place, row)."""
    out = np.full((max(1, int(n.max(initial=0))), len(n)), fill, code.dtype)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[place, row] = code[np.repeat(begin, n) + place]
    return out


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Rounded as the engine rounds, by the decimal digits of the value; these are looked at where it may be half-way."""
    scale = 10.0**digits
    y = x * scale
    with np.errstate(invalid="ignore"):  # what is not finite stays so
        whole = np.floor(y)
        part = y - whole
        out = (whole + (part >= 0.5)) / scale
        near = np.flatnonzero((np.abs(part - 0.5) < 1e-3) | (np.abs(y) > 1e12))
    for k in near:
        if np.isfinite(x.flat[k]):
            out.flat[k] = float(Decimal(repr(float(x.flat[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


def small(code: np.ndarray) -> np.ndarray:
    return code.astype(np.int16 if code.max(initial=0) < 1 << 15 else np.int32)


def one_edit(a: str, b: str) -> bool:
    """One character put in, left out or changed, or two neighbours swapped."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    if len(a) != len(b):
        a, b = sorted((a, b), key=len)
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


class Batch:
    """Rows of both sides, columns numbered together; of a null or empty value the number is -1 on the left and -2 on the right."""

    def __init__(self, table: pa.Table):
        self.table, self.made, self.block = table, {}, None

    def column(self, name: str) -> pa.Array:
        return self.table[name].combine_chunks()

    def once(self, key: object, make):
        if key not in self.made:
            self.made[key] = make()
        return self.made[key]

    # Values.

    def flat(self, name: str) -> np.ndarray:
        def make() -> np.ndarray:
            return small(self.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False))

        return self.once(("flat", name), make)

    def equal(self, name: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        c = self.flat(name)
        return self._same(c[i], c[j])

    @staticmethod
    def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a == np.where(b < 0, b.dtype.type(-2), b)

    def null(self, name: str) -> np.ndarray:
        """Whether a row has no value, or no member."""
        if pa.types.is_list(self.table.schema.field(name).type) or pa.types.is_large_list(self.table.schema.field(name).type):
            return self.once(("null", name), lambda: kernels.lists(self.column(name))[2] == 0)
        return self.once(("null", name), lambda: self.column(name).is_null().to_numpy(zero_copy_only=False))

    def apart(self, out: np.ndarray, name: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """out with -1 where a side has no value."""
        gone = self.null(name)
        if gone[i].any():
            out[np.broadcast_to(gone[i], out.shape)] = -1
        if gone[j].any():
            out[np.broadcast_to(gone[j], out.shape)] = -1
        return out

    # Sets.

    def sets(self, name: str) -> tuple[np.ndarray, list[str]]:
        """The members' numbers (place, row), and the members."""

        def make() -> tuple[np.ndarray, list[str]]:
            values, begin, n = kernels.lists(self.column(name))
            whole = values.cast(pa.large_string()).dictionary_encode()
            return padded(small(whole.indices.to_numpy(zero_copy_only=False)), begin, n), whole.dictionary.to_pylist()

        return self.once(("sets", name), make)

    def overlap(self, name: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether two sets share a member."""
        return self._shared(self.sets(name)[0], i, j)

    def _shared(self, m: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros(np.broadcast_shapes(i.shape, j.shape), bool)
        for a in m:
            a = a[i]
            if limit is not None:
                a = np.where(a < limit, a, a.dtype.type(-1))
            if (a < 0).all():
                continue
            for b in m:
                b = b[j]
                if (b >= 0).any():
                    out |= self._same(a, b)
        return out

    def ranked(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """The members' ranks in order of bytes, as sets() has their numbers, and the rank of each number."""

        def make() -> tuple[np.ndarray, np.ndarray]:
            m, words = self.sets(name)
            rank = np.full(len(words) + 1, -1, m.dtype)
            rank[sorted(range(len(words)), key=lambda k: words[k].encode())] = np.arange(len(words))
            return rank[m], rank

        return self.once(("ranked", name), make)

    def below(self, name: str, key: str, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether two sets share a member that comes, in order of bytes, before the group's key, which is a member of both."""
        m, rank = self.ranked(name)

        def make() -> np.ndarray:
            at = {w: rank[k] for k, w in enumerate(self.sets(name)[1])}
            return np.array([at[w] for w in self.column(key).to_pylist()], m.dtype)

        return self._shared(m, i, j, self.once(("below", name, key), make)[i])

    def below_member(self, name: str, member: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The same, of single pairs with a member (by number) each."""
        m, rank = self.ranked(name)
        return self._shared(m, i, j, rank[member])

    def members(self, name: str, many: bool) -> tuple[np.ndarray, np.ndarray]:
        """A column's values, or its sets' members, each once a row, by number, and their rows in order."""
        if not many:
            code = self.flat(name)
            row = np.flatnonzero(code >= 0)
            return code[row].astype(np.int64), row
        m = self.sets(name)[0]
        some = m >= 0
        for p in range(1, len(m)):
            for q in range(p):
                some[p] &= m[q] != m[p]
        row, place = np.nonzero(some.T)
        return m[place, row].astype(np.int64), row

    def near(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of members that are one edit apart, as ordered keys (both ways), and the members in one."""

        def make() -> tuple[np.ndarray, np.ndarray]:
            _, words = self.sets(name)
            by: dict[str, list[int]] = {}
            for k, w in enumerate(words):
                for v in {w, *(w[:p] + w[p + 1 :] for p in range(len(w)))}:
                    by.setdefault(v, []).append(k)
            got = {(a, b) for x in by.values() if len(x) > 1 for a in x for b in x if a < b and one_edit(words[a], words[b])}
            keys = np.array(sorted({a * len(words) + b for p in got for a, b in (p, p[::-1])}), np.int64)
            some = np.zeros(len(words) + 1, bool)
            some[[x for p in got for x in p]] = True
            return keys, some

        return self.once(("near", name), make)

    def any_near(self, name: str, i: np.ndarray, j: np.ndarray) -> np.ndarray | None:
        """Whether members of two sets are one edit apart; None: nowhere."""
        keys, some = self.near(name)
        if not len(keys):
            return None
        m, words = self.sets(name)
        out = np.zeros(np.broadcast_shapes(i.shape, j.shape), bool)
        for a in m:
            for b in m:
                if some[a[i]].any() and some[b[j]].any():
                    both = np.isin(a[i].astype(np.int64) * len(words) + b[j], keys) & (a[i] >= 0) & (b[j] >= 0)
                    out |= both
        return out

    # Names.

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names by number, and a row of each."""

        def make() -> tuple[np.ndarray, np.ndarray]:
            tokens, tf = self.sets("name_tokens")[0], self.sets("tf_tokens")[0]
            values, begin, n = kernels.lists(self.column("tf_bits"))
            bits = padded(values.cast(pa.float64()).to_numpy(zero_copy_only=False), begin, n, np.nan).view(np.int64)
            rows = np.ascontiguousarray(np.vstack([tokens.astype(np.int64), tf.astype(np.int64), bits]).T)
            _, first, code = np.unique(rows.view(f"V{8 * rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
            return code.ravel(), first

        return self.once("names", make)

    def shared_bits(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of rows i and j (one by one): the summed bits of the left one's tokens that the right one has, each token once."""
        m, _ = self.sets("tf_tokens")
        bits = self.once("bits", self._bits)
        out = np.zeros(len(i))
        for k, a in enumerate(m):
            a = a[i]
            shared = np.zeros(len(i), bool)
            for b in m:
                shared |= a == b[j]
            shared &= a >= 0
            for earlier in m[:k]:
                shared &= earlier[i] != a
            out += np.where(shared, bits[min(k, len(bits) - 1)][i], 0.0)
        return half_up(out, 9)

    def _bits(self) -> np.ndarray:
        values, begin, n = kernels.lists(self.column("tf_bits"))
        return padded(values.cast(pa.float64()).to_numpy(zero_copy_only=False), begin, n, 0.0)

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        column = self.once("tokens", lambda: self.column("name_tokens"))
        return half_up(kernels.name_similarity(column.take(pa.array(i)), column.take(pa.array(j))).fill_null(0.0).to_numpy(zero_copy_only=False), 9)

    def name_levels(self, i: np.ndarray, j: np.ndarray, cuts: tuple[float, ...], level) -> np.ndarray:
        """level(similarity's place among cuts, from 0 for the highest; shared bits), -1 without a name.

        Distinct names of a block are compared once, in single precision; those near a cut again in double precision.
        """
        code, row = self.names()
        if i.ndim == 1:
            key, at = np.unique(code[i].astype(np.int64) * len(row) + code[j], return_inverse=True)
            a, b = row[key // len(row)], row[key % len(row)]
            return self._named(a, b, self.exact(a, b), cuts, level)[at.ravel()]
        matrix, left, right = self.block
        return np.take(matrix[left[code[i.ravel()]]], right[code[j.ravel()]], axis=1)

    def name_values_of(self, i: np.ndarray, j: np.ndarray, cuts: tuple[float, ...], level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """name_values() of single pairs."""
        code, row = self.names()
        key, at = np.unique(code[i].astype(np.int64) * len(row) + code[j], return_inverse=True)
        a, b = row[key // len(row)], row[key % len(row)]
        sim, gone = self.exact(a, b), self.null("name_tokens")
        out = np.where(gone[a] | gone[b], np.nan, sim), self.shared_bits(a, b), self._named(a, b, sim, cuts, level)
        return tuple(x[at.ravel()] for x in out)

    def _named(self, a: np.ndarray, b: np.ndarray, sim: np.ndarray, cuts: tuple[float, ...], level) -> np.ndarray:
        place = sum((sim < c).astype(np.int8) for c in cuts)
        out = np.full(len(a), level(len(cuts), 0.0), np.int8)
        some = np.flatnonzero(place < len(cuts))
        if len(some):
            out[some] = level(place[some], self.shared_bits(a[some], b[some]))
        gone = self.null("name_tokens")
        out[gone[a] | gone[b]] = -1
        return out

    def begin(self, i: np.ndarray, j: np.ndarray, cuts: tuple[float, ...], level) -> None:
        """Compares the distinct names of a block, rows i against rows j."""
        code, row = self.names()
        xs, ys = np.unique(code[i]), np.unique(code[j])
        left, right = (np.zeros(len(row), np.int64) for _ in "lr")
        left[xs], right[ys] = np.arange(len(xs)), np.arange(len(ys))
        out = np.full((len(xs), len(ys)), level(len(cuts), 0.0), np.int8)
        low = min(cuts) - NEAR
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        n_found = 0

        def tell() -> None:
            nonlocal found, n_found
            k = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
            to, s = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found]).astype(np.float64)
            a, b = row[xs[k]], row[ys[to]]
            close = np.flatnonzero(np.min([np.abs(s - c) for c in cuts], axis=0) <= NEAR)
            if len(close):
                s[close] = self.exact(a[close], b[close])
            out[k, to] = self._named(a, b, s, cuts, level)
            found, n_found = [], 0

        for k, order, sim in self.compared(xs, ys):
            some = np.flatnonzero(sim >= low)
            if len(some):
                found.append((k, order[some], sim[some]))
                n_found += len(some)
                if n_found >= NAMED:
                    tell()
        if found:
            tell()
        gone = self.null("name_tokens")
        out[gone[row[xs]]] = -1
        out[:, gone[row[ys]]] = -1
        self.block = out, left, right

    def compared(self, xs: np.ndarray, ys: np.ndarray, exact: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each name xs[k] with a token: k, and its similarity with the names ys[order], as k, order, similarity."""
        _, row = self.names()
        tokens, words = self.sets("name_tokens")
        size = (tokens >= 0).sum(0)
        order = np.argsort(-size[row[ys]], kind="stable")  # the longest first: a place is held by the first so many names
        own = tokens[:, row[ys[order]]]
        used = np.array(sorted(np.unique(own[own >= 0]).tolist(), key=lambda k: len(words[k])), np.int64)
        at = np.zeros(len(words) + 1, np.int64)
        at[used] = np.arange(len(used))
        held_by = (own >= 0).sum(1)
        own = at[np.concatenate([p[:n] for p, n in zip(own, held_by.tolist(), strict=True)])]
        ends = np.cumsum(held_by)
        places = [(a, b, b - a) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True) if b > a]
        vocabulary, width = Vocabulary([words[k] for k in used], exact), len(ys)
        kind = vocabulary.kind
        wide = np.dtype(kind).itemsize
        n_right = np.maximum(size[row[ys[order]]], 1).astype(kind)
        most = max(8, KEPT // (wide * len(own) + 1))
        for names, rows_of in self.slabs(tokens[:, row[xs]], max(8, KEPT // (wide * (len(used) + 1)))):
            similar = vocabulary.similarities([words[t] for t in rows_of])
            held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for k in names:
                rows = columns = None
                mine = [rows_of[t] for t in tokens[:, row[xs[k]]].tolist() if t >= 0]
                for t in mine:
                    if t not in held:
                        if len(held) >= most:
                            held.pop(next(iter(held)))
                        cells = np.take(similar[t], own)
                        best = np.zeros(width, kind)
                        for a, b, n in places:
                            np.maximum(best[:n], cells[a:b], out=best[:n])
                        held[t] = cells, best
                    cells, best = held[t]
                    rows = best if rows is None else rows + best
                    columns = cells if columns is None else np.maximum(columns, cells)
                sim = np.zeros(width, kind)
                for a, b, n in places:
                    sim[:n] += columns[a:b]
                sim /= n_right
                sim += rows / len(mine) if exact else rows * np.float32(1 / len(mine))
                sim *= kind(0.5)
                yield k, order, sim

    def name_values(self, i: np.ndarray, j: np.ndarray, cuts: tuple[float, ...], level) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of rows i with all rows j, some of i after others: these, and similarity (nan without a name), shared bits and level of each pair, as matrices.

        Distinct names are compared once, in double precision.
        """
        code, row = self.names()
        xs, left = np.unique(code[i], return_inverse=True)
        ys, right = np.unique(code[j], return_inverse=True)
        by_name, upto = np.argsort(left, kind="stable"), np.append(0, np.cumsum(np.bincount(left, minlength=len(xs))))
        gone, bare = self.null("name_tokens"), self.null("name_tokens")[row[ys]]
        tf, _ = self.sets("tf_tokens")
        member, of = tf[:, row[ys]].T.ravel(), np.repeat(np.arange(len(ys)), len(tf))
        member, of = np.unique(np.stack([member, of])[:, member >= 0], axis=1) if (member >= 0).any() else (np.empty(0, np.int64),) * 2
        new = np.flatnonzero(np.append(True, member[1:] != member[:-1])) if len(member) else []
        holders = dict(zip(member[new].tolist(), np.split(of, new[1:]), strict=True)) if len(member) else {}
        bits = self.once("bits", self._bits)
        last = level(len(cuts), 0.0)
        names: list[int] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_rows, step = 0, max(1, TILE // max(1, len(j)))

        def parts() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
            rows, own = np.concatenate([by_name[upto[k] : upto[k + 1]] for k in names]), np.repeat(np.arange(len(names)), [upto[k + 1] - upto[k] for k in names])
            whole = [np.array(x) for x in zip(*held, strict=True)]
            for a in range(0, len(rows), step):
                yield (i[rows[a : a + step]], *[np.take(x[own[a : a + step]], right, axis=1) for x in whole])

        def each() -> Iterator[tuple[int, np.ndarray]]:
            for k, order, sim in self.compared(xs, ys, True) if not bare.all() else ():
                out = np.full(len(ys), np.nan)
                out[order] = half_up(sim, 9)
                out[bare] = np.nan
                yield k, out
            for k in np.flatnonzero(gone[row[xs]] | bare.all()):
                yield int(k), np.full(len(ys), np.nan)

        for k, sim in each():
            shared, mine, some = np.zeros(len(ys)), tf[:, row[xs[k]]].tolist(), []
            for p, t in enumerate(mine):
                if t in holders and t not in mine[:p]:
                    shared[holders[t]] += bits[min(p, len(bits) - 1), row[xs[k]]]
                    some.append(holders[t])
            if some:
                some = some[0] if len(some) == 1 else np.unique(np.concatenate(some))
                shared[some] = half_up(shared[some], 9)
            gamma = np.full(len(ys), last, np.int8)
            near = np.flatnonzero(sim >= min(cuts))
            if len(near):
                gamma[near] = level(sum((sim[near] < c).astype(np.int8) for c in cuts), shared[near])
            gamma[np.isnan(sim)] = -1
            names.append(k)
            held.append((sim, shared, gamma))
            n_rows += int(upto[k + 1] - upto[k])
            if n_rows >= step:
                yield from parts()
                names, held, n_rows = [], [], 0
        if names:
            yield from parts()

    @staticmethod
    def slabs(tokens: np.ndarray, most: int) -> Iterator[tuple[list[int], dict[int, int]]]:
        """Names (columns of tokens, but those without any) in runs with about so many distinct tokens at most, and these, numbered."""
        names, known = [], {}
        for k, mine in enumerate(tokens.T.tolist()):
            mine = [t for t in mine if t >= 0]
            if not mine:
                continue
            if names and len(known) + len(mine) > most:
                yield names, known
                names, known = [], {}
            for t in mine:
                known.setdefault(t, len(known))
            names.append(k)
        if names:
            yield names, known
