"""Values that are computed once and kept, in bounded memory."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_BYTES = 24 << 20  # of keys and values in each of two generations
EACH = 180  # bytes that a pair takes besides its characters
EACH_IN_ARRAYS = 32  # the same, of those held in arrays
LONGEST = 256  # characters of a key; longer ones are computed anew


@contextmanager
def no_collection() -> Iterator[None]:
    """For code that makes many lists but no cycles, so that Python need not look for any."""
    looks = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if looks:
            gc.enable()


class Remembered(dict):
    """Values by key, computed when missing; keys not used for long go when there are too many.

    Keys and values are texts or bytes. What is kept is bounded by its bytes, not by its
    number, and a long key is never kept.
    """

    def __init__(self, compute: Callable[[Hashable], object] | None = None, most: int | None = None):
        super().__init__()
        self._compute, self._most, self._older, self._held = compute, most, {}, 0

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        self[key] = value
        return value

    def __setitem__(self, key, value):
        if len(key) > LONGEST:
            return
        super().__setitem__(key, value)
        self._grown(EACH + len(key) + len(value))

    def _grown(self, size: int) -> None:
        self._held += size
        if self._held > (self._most or MOST_BYTES):
            self._older, self._held = dict(self), 0
            self.clear()

    def __contains__(self, key) -> bool:
        return super().__contains__(key) or key in self._older

    def known(self, keys: Iterable) -> dict:
        """Those of the keys that are held, with their values; they count as used."""
        out, again = {}, {}
        younger, older = self.get, self._older.get
        for key in keys:
            value = younger(key)
            if value is None:
                value = again[key] = older(key)
                if value is None:
                    del again[key]
                    continue
            out[key] = value
        self.keep(again)
        return out

    def keep(self, pairs: dict) -> None:
        """Hold many pairs at once."""
        for some in batched(pairs.items(), 4096):
            short = {key: value for key, value in some if len(key) <= LONGEST}
            self.update(short)
            self._grown(EACH * len(short) + sum(map(len, short)) + sum(map(len, short.values())))


class RememberedNumbers:
    """32-bit numbers by string, asked for and held in arrays, so that what is known costs no Python object.

    When there is too much, the strings asked for most lately stay, in half of the memory, and no long ones.
    """

    def __init__(self, most: int | None = None):
        self._most, self._calls, self._bytes = most, 0, 0
        self._hold(pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, "<u4"), np.empty(0, np.int64))

    def _hold(self, keys: pa.LargeStringArray, size: np.ndarray, numbers: np.ndarray, used: np.ndarray) -> None:
        self._keys, self._size, self._numbers, self._used = keys, size, numbers, used

    def __len__(self) -> int:
        return len(self._keys)

    def of(self, keys: pa.LargeStringArray, compute: Callable[[list[str]], dict[str, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all keys end to end, and where each key's begin (and the last's end).

        ``compute`` gets the distinct keys that are not held; of bytes it returns, each four are a number.
        """
        encoded = pa.concat_arrays([self._keys, keys]).dictionary_encode()
        code, distinct = encoded.indices.to_numpy()[len(self) :], encoded.dictionary  # first those held, as they were
        added = distinct.slice(len(self))
        with no_collection():
            new = added.to_pylist()
            made = compute(new) if new else {}
            made = list(map(made.__getitem__, new))
        size = np.concatenate((self._size, np.fromiter(map(len, made), np.int64, len(made)) // 4))
        numbers = np.concatenate((self._numbers, np.frombuffer(b"".join(made), "<u4")))
        self._calls += 1
        used = np.append(self._used, np.zeros(len(new), np.int64))
        used[code] = self._calls
        self._bytes += int(_bytes_held(added, size[len(self) :]).sum())
        self._hold(distinct, size, numbers, used)
        out = _lists(numbers, size, code)
        if self._bytes > (self._most or MOST_BYTES):
            self._forget()
        return out

    def _forget(self) -> None:
        each = _bytes_held(self._keys, self._size)
        each[pc.utf8_length(self._keys).to_numpy() > LONGEST] = self._most or MOST_BYTES
        late = np.argsort(-self._used, kind="stable")
        late = late[each[late] < (self._most or MOST_BYTES)]
        kept = np.sort(late[np.cumsum(each[late]) <= (self._most or MOST_BYTES) // 2])
        numbers, _ = _lists(self._numbers, self._size, kept)
        self._bytes = int(each[kept].sum())
        self._hold(self._keys.take(pa.array(kept)), self._size[kept], numbers, self._used[kept])


def _bytes_held(keys: pa.LargeStringArray, size: np.ndarray) -> np.ndarray:
    return EACH_IN_ARRAYS + pc.binary_length(keys).to_numpy() + 4 * size


def _lists(numbers: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that codes name, end to end, and their edges; ``size`` is the length of each list in ``numbers``."""
    begin, length = (np.cumsum(size) - size)[code], size[code]
    edge = np.concatenate(([0], np.cumsum(length)))
    return numbers[np.repeat(begin - edge[:-1], length) + np.arange(edge[-1])], edge
