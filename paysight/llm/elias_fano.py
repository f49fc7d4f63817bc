"""Elias-Fano sequences and an n-gram trie over them, searched for whole arrays of queries at once.

A trie level stores the last words of its n-grams, range by range in order of their contexts. Adding
the last value of the ranges before makes a level one rising sequence, so it takes about two bits an
entry above the bits that its average gap needs. Ranges are found by rising pointers, coded alike.
Probabilities are codes into a small table of values.
"""

from __future__ import annotations

import io
import tempfile

import numpy as np

WORD = 64
SLICE = 1 << 16  # numbers whose bits are laid out at a time; a multiple of 64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` (at most 32) bits, end to end in 64-bit words."""
    if not width:
        return np.zeros(1, np.uint64)
    held = []
    for k in range(0, len(values), SLICE):
        bits = (values[k : k + SLICE, None].astype(np.uint64) >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        held.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
    size = sum(map(len, held))
    return np.concatenate([*held, np.zeros(16 - size % 8, np.uint8)]).view(np.uint64)


def _unpack(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.int64)
    bit = at * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(WORD) - shift) & np.uint64(63)), np.uint64(0))
    return ((low | high) & np.uint64((1 << width) - 1)).astype(np.int64)


# Place of the k-th one in a byte, for every byte and k: entry 8 * byte + k.
_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8)] for b in range(256)], np.uint8).ravel()
_EACH = np.uint64(0x0101010101010101)  # times a byte: that byte in all eight
_TOP = np.uint64(0x8080808080808080)
_BYTE, _EIGHT = np.uint64(0xFF), np.uint64(8)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Bit of the k-th one of each 64-bit word."""
    k = k.astype(np.uint64)
    # ones up to and with each byte, a byte each
    ones = np.bitwise_count(word.astype("<u8").view(np.uint8)).view("<u8") * _EACH
    # bytes that end at or before the k-th one: their top bit survives
    shift = np.bitwise_count(((k * _EACH | _TOP) - ones) & _TOP).astype(np.uint64) * _EIGHT
    prior = ((ones << _EIGHT) >> shift) & _BYTE
    own = (word >> shift) & _BYTE
    return shift.astype(np.int64) + _SELECT[(own * _EIGHT + (k - prior)).astype(np.int64)]


def _ones_from(high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many ones follow each other from a bit on; 64 or more count as 64. The last word is followed by zeros."""
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    after = np.where(word + 1 < len(high), high[np.minimum(word + 1, len(high) - 1)], np.uint64(0))
    bits = (high[word] >> shift) | ((after << ((np.uint64(WORD) - shift) & np.uint64(63))) * (shift > 0))
    # below the lowest zero there are only ones
    return np.bitwise_count(bits & ~(bits + np.uint64(1))).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of whole numbers; arrays may be memory maps."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.n, self.universe, self.width = (int(x) for x in arrays["head"])
        self.high, self.low = arrays["high"], arrays["low"]
        self.ones, self.zeros = arrays["ones"], arrays["zeros"]

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = min(32, max(0, (universe // max(1, n)).bit_length() - 1))
        size = (universe >> width) + n + 2
        bits = np.zeros(-(-size // WORD) * WORD, np.uint8)
        bits[(values >> width) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.cumsum(np.bitwise_count(high), dtype=np.int64)
        head = np.array([n, universe, width], np.int64)
        zeros = WORD * np.arange(1, len(high) + 1) - ones
        return cls({"head": head, "high": high, "low": _pack(values & ((1 << width) - 1), width), "ones": ones.astype(np.int32), "zeros": zeros.astype(np.int32)})

    def get(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, at, side="right")
        prior = np.where(word > 0, self.ones[word - 1], 0)
        place = WORD * word + _select_in_word(self.high[word], at - prior)
        return ((place - at) << self.width) | _unpack(self.low, at, self.width)

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries whose upper bits are below ``high``, those before the high-th zero, and those with bits up to it."""
        k = high - 1
        first, place = self._zero(k)
        ones = _ones_from(self.high, place + 1)
        long = np.flatnonzero(ones >= WORD)
        ones[long] = self._zero(high[long])[0] - first[long]
        return first, first + ones

    def _zero(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ones before the k-th zero, and its place; -1 comes before all."""
        inner = np.maximum(k, 0)
        word = np.searchsorted(self.zeros, inner, side="right")
        prior = np.where(word > 0, self.zeros[word - 1], 0)
        place = WORD * word + _select_in_word(~self.high[word], inner - prior)
        return np.where(k < 0, 0, place - inner), np.where(k < 0, -1, place)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The first entry equal to each value, or -1: successor search by halving its bucket."""
        out = np.full(len(values), -1, np.int64)
        live = np.flatnonzero((values >= 0) & (values < self.universe)) if self.n else np.zeros(0, np.int64)
        high = values[live] >> self.width
        first, end = self._bucket(high)
        stop = end.copy()
        want = values[live] & ((1 << self.width) - 1)
        open_ = np.flatnonzero(first < stop)
        while len(open_):
            a, z = first[open_], stop[open_]
            middle = (a + z) >> 1
            less = _unpack(self.low, middle, self.width) < want[open_]
            first[open_] = a = np.where(less, middle + 1, a)
            stop[open_] = z = np.where(less, z, middle)
            open_ = open_[a < z]
        inside = np.flatnonzero(first < end)
        inside = inside[_unpack(self.low, first[inside], self.width) == want[inside]]
        out[live[inside]] = first[inside]
        return out


def quantise(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Codes and table: values in 2**bits groups of equal size by rank, each replaced by its group's mean."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    distinct, inverse, n = np.unique(values, return_inverse=True, return_counts=True)
    if len(distinct) <= 1 << bits:
        return inverse.astype(np.uint8), distinct
    group = (np.cumsum(n) - n) * (1 << bits) // len(values)
    group = np.unique(group, return_inverse=True)[1]
    table = np.bincount(group, distinct * n) / np.bincount(group, n)
    return group[inverse].astype(np.uint8), table


class Level:
    """Ranges of rising values: range r holds entries pointers[r] to pointers[r + 1]."""

    def __init__(self, pointers: EliasFano, values: EliasFano):
        self.pointers, self.values = pointers, values

    @classmethod
    def of(cls, context: np.ndarray, value: np.ndarray, contexts: int) -> Level:
        """From entries sorted by context, then value."""
        pointers = np.searchsorted(context, np.arange(contexts + 1))
        last = np.where(pointers[1:] > pointers[:-1], value[np.maximum(pointers[1:] - 1, 0)] + 1 if len(value) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)])
        return cls(EliasFano.of(pointers), EliasFano.of(value + base[context] if len(value) else value))

    def start(self, context: np.ndarray) -> np.ndarray:
        return self.pointers.get(context)

    def find(self, context: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The entry of a value in the range of its context, or -1. Quick where equal contexts follow each other."""
        out = np.full(len(context), -1, np.int64)
        if not len(context) or not self.values.n:
            return out
        turns = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        each = context[turns]
        # where a context's range begins and, next to it, where it ends; one is the other where contexts follow each other
        apart = np.append(each[1:] != each[:-1] + 1, True)
        begin = np.arange(len(each)) + np.cumsum(apart) - apart
        points = np.empty(len(each) + np.count_nonzero(apart), np.int64)
        points[begin] = each
        points[begin + 1] = each + 1
        at = self.pointers.get(points)
        # a range ends with its last entry + 1, which is what the next range's values count from
        ends = np.where(at > 0, self.values.get(np.maximum(at - 1, 0)) + 1, 0)
        base = ends[begin]
        most = ends[begin + 1] - base - 1
        run = np.repeat(np.arange(len(turns)), np.diff(np.append(turns, len(context))))
        some = np.flatnonzero(value <= most[run])
        out[some] = self.values.find(value[some] + base[run[some]])
        return out


class Trie:
    """N-grams of one order as paths of words, each with a coded log10 probability."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        part = lambda name: EliasFano({k.split("/")[1]: v for k, v in arrays.items() if k.startswith(name + "/")})
        self.arrays = arrays
        self.levels = [Level(part(f"ptr{k}"), part(f"val{k}")) for k in range(int(arrays["order"][0]))]

    @classmethod
    def of(cls, words: list[np.ndarray], log10: np.ndarray) -> Trie:
        """From the n-grams' words, one array per place, sorted by the first, then the next, without repeats."""
        arrays = {"order": np.array([len(words)], np.int64)}
        n = len(log10)
        context, contexts = np.zeros(n, np.int64), 1
        new = np.zeros(n, bool)
        new[:1] = True
        for k, word in enumerate(words):
            new[1:] |= word[1:] != word[:-1]
            level = Level.of(context[new], word[new], contexts)
            for name, seq in ((f"ptr{k}", level.pointers), (f"val{k}", level.values)):
                arrays |= {f"{name}/{key}": v for key, v in seq.arrays.items()}
            context = np.cumsum(new) - 1
            contexts = int(new.sum())
        arrays["code"], arrays["table"] = quantise(log10)
        return cls(arrays)

    def find(self, words: list[np.ndarray]) -> np.ndarray:
        """The entry of each n-gram, or -1: from level to level, by successor search in its context's range."""
        n = len(words[0])
        new, prefix, entry = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(1, np.int64)
        new[:1] = True
        for level, word in zip(self.levels, words):
            new[1:] |= word[1:] != word[:-1]
            first = np.flatnonzero(new)  # neighbours with the same words up to here are searched once
            context = entry[prefix[first]]
            some = np.flatnonzero(context >= 0)
            entry = np.full(len(first), -1, np.int64)
            entry[some] = level.find(context[some], word[first[some]])
            prefix = np.cumsum(new) - 1
        return entry[prefix]

    def log10(self, words: list[np.ndarray], absent: float) -> np.ndarray:
        """The n-grams' coded values, ``absent`` for those that the trie lacks."""
        at = self.find(words)
        out = np.full(len(at), absent)
        out[at >= 0] = self.arrays["table"][self.arrays["code"][at[at >= 0]]]
        return out

    def dump(self) -> bytes:
        """All arrays as one file, each at a multiple of 64 bytes so that it can be mapped."""
        out, index = io.BytesIO(), []
        for name, array in self.arrays.items():
            out.write(b"\0" * (-out.tell() % 64))
            index.append((name, array.dtype.str, len(array), out.tell()))
            out.write(np.ascontiguousarray(array).tobytes())
        head = repr(index).encode()
        return len(head).to_bytes(8, "little") + head + b"\0" * (-(8 + len(head)) % 64) + out.getvalue()

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        """The trie over a memory map of a nameless temporary file, which goes with the process."""
        import ast

        size = int.from_bytes(data[:8], "little")
        index = ast.literal_eval(data[8 : 8 + size].decode())
        offset = 8 + size + -(8 + size) % 64
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        view = lambda kind, n, at: whole[offset + at : offset + at + n * np.dtype(kind).itemsize].view(kind).view(np.ndarray)
        return cls({name: view(kind, n, at) for name, kind, n, at in index})
