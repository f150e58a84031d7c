"""Encoding of whole texts by way of their units (words with the space before them).

The pre-tokenisers and vocabularies used here never join characters across a
single space between two printable characters, so the ids of a text are the ids
of its units in order.  Units of a batch are split and told apart in Arrow, each
distinct one is encoded by the tokenizers library or found in a table of bounded
size, and the ids of the batch are gathered with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CACHED_UNITS = 350_000     # memory bound of a worker's table
UNITS_AT_ONCE = 8_192          # units given to the library at a time
SLICE_CHARS = 4_000_000        # characters handled at a time

# Printable ASCII and Latin letters: on both sides of a space they make it a boundary.
_EDGE = "[!-~À-ɏ]"
_OTHER = r"[^\n -~À-ɏ]|  | \n|\n |^ | $"
_SPACE_LED = re.compile(f"(?<={_EDGE})(?= {_EDGE})")
_SPACE_BETWEEN = re.compile(f"(?<={_EDGE}) (?={_EDGE})")
_CUT = "\x01"


def _split(texts: pa.Array, other: str, fast: Callable[[pa.Array], pa.Array], slow: re.Pattern) -> pa.Array:
    """Lists of units: by ``fast`` for texts without ``other``, by ``slow`` for the rest."""
    rest = pc.match_substring_regex(texts, other)
    if not pc.any(rest).as_py():
        return fast(texts)
    plain = fast(texts.filter(pc.invert(rest)))
    odd = pa.array([slow.split(t) for t in texts.filter(rest).to_pylist()], plain.type)
    odd_mask = rest.to_numpy(zero_copy_only=False)
    order = np.where(odd_mask, len(plain) + np.cumsum(odd_mask) - 1, np.cumsum(~odd_mask) - 1)
    return pa.concat_arrays([plain, odd]).take(pa.array(order))


def split_space_led(texts: pa.Array) -> pa.Array:
    """Units with the space before them; a line end between printable characters is its own."""

    def fast(plain: pa.Array) -> pa.Array:
        cut = pc.replace_substring(pc.replace_substring(plain, " ", _CUT + " "), "\n", f"{_CUT}\n{_CUT}")
        return pc.split_pattern(cut, _CUT)

    return _split(texts, _OTHER + r"|\n\n|^\n|\n$", fast, _SPACE_LED)


_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WORD_END = "[0-9A-Za-zÀ-ÖØ-öø-ɏ]$"      # letters and digits only


def cut_punctuation(units: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
    """(units without the ASCII punctuation after their last letter or digit, which units have
    any, that of each of those): byte-level pre-tokenisers cut there."""
    trimmed = pc.utf8_rtrim(units, characters=_PUNCTUATION)
    heads = pc.if_else(pc.match_substring_regex(trimmed, _WORD_END), trimmed, units)
    sizes = pc.utf8_length(heads).to_numpy()
    with_end = np.flatnonzero(sizes < pc.utf8_length(units).to_numpy())
    ends = [u[n:] for u, n in zip(units.take(pa.array(with_end)).to_pylist(), sizes[with_end].tolist())]
    return heads, with_end, ends


def split_between(texts: pa.Array) -> pa.Array:
    """Units without the single space between them."""
    return _split(texts, _OTHER, lambda plain: pc.split_pattern(plain, " "), _SPACE_BETWEEN)


def keep_whole(texts: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), texts)


class UnitTable:
    """Ids of units and, by unit, the flags (two bits) that ``encode`` gives with them.

    The table stops growing at MAX_CACHED_UNITS; units met after that are encoded
    where they occur, so memory is bounded and no unit is left out.  ``cut`` divides
    units in two where both halves are units of their own; fewer are distinct then."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[list[int]], list[int]]],
                 cut: Callable[[pa.Array], tuple[pa.Array, np.ndarray, list[str]]] | None = None):
        self._encode, self._cut = encode, cut
        self.known = pa.array([], pa.string())
        self.rows = _pack([], [])

    def _lookup(self, units: pa.Array):
        """(row of each of the distinct units, table of rows) for this call."""
        if not len(units):
            return np.zeros(0, np.int64), self.rows
        units = units.cast(pa.string())
        at = pc.fill_null(pc.index_in(units, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at, self.rows
        at[missing] = len(self.known) + np.arange(len(missing))
        unseen = units.take(pa.array(missing))
        new = unseen.to_pylist()
        packs = [_pack(*self._encode(new[i:i + UNITS_AT_ONCE])) for i in range(0, len(new), UNITS_AT_ONCE)]
        room = max(0, MAX_CACHED_UNITS - len(self.known))
        table = _join(self.rows, *packs)
        if room:
            self.known = pa.concat_arrays([self.known, unseen.take(pa.array(np.arange(min(room, len(new)))))])
            self.rows = table if room >= len(new) else _first(table, len(self.known))
        return at, table

    def _lookup_cut(self, units: pa.Array):
        """(row of each distinct unit, row of its second half or -1, table of rows)."""
        if self._cut is None:
            found, table = self._lookup(units)
            return found, None, table
        heads, with_end, ends = self._cut(units)
        halves = pa.concat_arrays([heads, pa.array(ends, heads.type)]).dictionary_encode()
        found, table = self._lookup(halves.dictionary)
        found = found[halves.indices.to_numpy()]
        second = np.full(len(heads), -1)
        second[with_end] = found[len(heads):]
        return found[:len(heads)], second, table

    def encode(self, texts: pa.Array, split: Callable[[pa.Array], pa.Array],
               tail: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text, per text the bits that all its units have).
        ``texts`` has no nulls; ``tail`` is appended to every text."""
        lists = split(texts)
        counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        found, second, table = self._lookup_cut(coded.dictionary)
        rows = found[at]
        if second is not None:           # second halves follow the first ones
            after = second[at]
            has = after >= 0
            seen = np.concatenate([[0], np.cumsum(has)])
            place = np.arange(len(rows)) + seen[:-1]
            both = np.empty(len(rows) + seen[-1], np.int64)
            both[place] = rows
            both[place[has] + 1] = after[has]
            last = np.cumsum(counts)
            rows, counts = both, counts + seen[last] - seen[last - counts]
        if tail is not None:             # a unit of its own after each text
            table = _join(table, _pack([[tail]], [3]))
            rows = np.insert(rows, np.cumsum(counts), len(table[1]) - 1)
            counts += 1
        ids, starts, lengths, flags = table
        last = np.cumsum(counts)
        first = last - counts
        n = lengths[rows]
        ends = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        places = np.repeat(starts[rows] - ends[:-1], n)
        places += np.arange(ends[-1])
        bits = np.full(len(texts), 3)
        for k in (0, 1):
            lacks = np.flatnonzero(~flags[rows] >> k & 1) if not (flags >> k & 1).all() else []
            if len(lacks):
                bits[np.searchsorted(last, lacks, side="right")] &= ~(1 << k)
        return ids[places], ends[last] - ends[first], bits


def _pack(lists: list[list[int]], flags: list[int]):
    """(ids, start and length by row, flags by row)."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))
    return ids, np.cumsum(lengths) - lengths, lengths, np.array(flags, np.int64)


def _join(*tables):
    """One table of the rows of all, in order."""
    before = np.cumsum([0] + [len(t[0]) for t in tables])
    return (np.concatenate([t[0] for t in tables]), np.concatenate([t[1] + n for t, n in zip(tables, before)]),
            np.concatenate([t[2] for t in tables]), np.concatenate([t[3] for t in tables]))


def _first(table, n: int):
    """The first ``n`` rows, without the memory of the rest."""
    ids, starts, lengths, flags = table
    return ids[:starts[n - 1] + lengths[n - 1]].copy(), starts[:n].copy(), lengths[:n].copy(), flags[:n].copy()


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[pa.Array]:
    """The texts of a batch (null as empty) in runs of about ``chars`` characters."""
    texts = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + chars)))
        yield texts.slice(start, end - start)
        start = end


def list_array(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
