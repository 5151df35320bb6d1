"""Words of whole batches of texts as numbers, in Arrow and numpy.

Two things are kept apart. Names are exact: equal names mean equal words, or equal runs of words, within
one batch, and whatever an operator returns rests on them. Hashes mean the same in every batch, and only
deal rows out or pick samples; two different words with one hash cost work, not results.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Products of two ranges of names stay below this, so that a pair of names is one 64-bit number.
_PACKED = 1 << 62


class Words(NamedTuple):
    """The words of consecutive texts: each one's place among the distinct words, and words per text."""

    number: np.ndarray
    known: pa.StringArray
    per_text: np.ndarray


def words(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words between ASCII white space, as they are or with A-Z lower-cased; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)
    # White space at a text's ends leaves empty words there.
    solid = pc.greater(pc.binary_length(flat), 0)
    upto = np.concatenate([[0], np.cumsum(solid.to_numpy(zero_copy_only=False))])
    coded = flat.filter(solid).dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.diff(upto[offsets]))


def hashes(known: pa.StringArray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return digests(known.cast(pa.binary()).to_pylist())


def digests(known: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in known), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def odd(seed: int, n: int | None = None) -> np.ndarray:
    """Random odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(1)


def runs(hashed: np.ndarray, length: int, seed: int = 3) -> np.ndarray:
    """Hash of the run of `length` words that starts at each word; len(hashed) - length + 1 of them."""
    n = max(0, len(hashed) - length + 1)
    base = odd(seed)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * base + hashed[k : k + n]
    return mix(out)


def _pair(left: np.ndarray, right: np.ndarray, most_left: int, most_right: int) -> tuple[np.ndarray, int]:
    n = min(len(left), len(right))
    left, right = left[:n], right[:n]
    if most_left * most_right >= _PACKED and most_left > n:
        seen, left = np.unique(left, return_inverse=True)
        most_left = len(seen)
    if most_left * most_right >= _PACKED:
        seen, right = np.unique(right, return_inverse=True)
        most_right = len(seen)
    return left * most_right + right, most_left * most_right


def names(number: np.ndarray, length: int) -> np.ndarray:
    """A name for the run of `length` words at each word. Runs have equal names only where they are equal,
    and names are in the order of the runs: runs of 1, 2, 4, ... words are named by pairs of names."""
    if len(number) < length:
        return np.zeros(0, np.int64)
    part, most, span = number, int(number.max()) + 1, 1
    out, range_, taken = None, 1, 0
    rest = length
    while rest:
        if rest & 1:
            out, range_ = (part, most) if out is None else _pair(out, part[taken:], range_, most)
            taken += span
        rest >>= 1
        if rest:
            part, most = _pair(part, part[span:], most, most)
            span *= 2
    return out[: len(number) - length + 1]


def inside(per_text: np.ndarray, length: int) -> np.ndarray:
    """First words of the runs of `length` words that lie in one text."""
    last = np.repeat(np.cumsum(per_text), per_text)
    return np.flatnonzero(np.arange(len(last)) + length <= last)


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text, name, first word), by text and name. A text of fewer words
    is one shingle; names of other widths are apart."""
    text = np.repeat(np.arange(len(found.per_text)), found.per_text)
    starts = np.cumsum(found.per_text) - found.per_text
    named = names(found.number, width)
    at = inside(found.per_text, width)
    owner, name = [text[at]], [named[at]]
    place = [at]
    base = int(named.max()) + 1 if len(named) else 0
    for k in range(1, width):
        short = np.flatnonzero(found.per_text == k)
        if len(short):
            own = names(found.number, k)[starts[short]]
            _, own = np.unique(own, return_inverse=True)
            owner.append(short)
            name.append(own + base)
            place.append(starts[short])
            base += int(own.max()) + 1
    owner, name, place = np.concatenate(owner), np.concatenate(name), np.concatenate(place)
    by = np.argsort(owner * base + name) if len(found.per_text) * base < _PACKED else np.lexsort((name, owner))
    owner, name, place = owner[by], name[by], place[by]
    new = np.ones(len(by), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
    return owner[new], name[new], place[new]
