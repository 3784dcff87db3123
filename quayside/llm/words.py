"""Words and word shingles of Arrow text columns as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once in a batch.
AT_ONCE = 4 << 20
#: Fixed odd factors and shifts that mix word hashes into a shingle's.
FACTOR, FACTOR2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(31)


def hashed_words(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and where each text's words start (one more offset than texts).

    Words are runs of anything but space and U+0009 to U+000D, with A-Z lower-cased. Null and empty texts have none.
    """
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(trimmed)
    counts = np.where(pc.equal(trimmed, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    flat = flat.filter(pc.not_equal(flat, ""))
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    if not len(flat):
        return np.zeros(0, np.uint64), offsets
    coded = flat.dictionary_encode()
    key = f"{seed:016d}"
    hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), hash_key=key, categorize=False)
    return hashes[coded.indices.to_numpy()], offsets


def mixed(hashes: np.ndarray) -> np.ndarray:
    out = hashes * FACTOR
    out ^= out >> SHIFT
    out *= FACTOR2
    out ^= out >> SHIFT
    return out


def unmixed(hashes: np.ndarray) -> np.ndarray:
    """The hashes that :func:`mixed` made these of."""
    out = hashes
    for factor in (FACTOR2, FACTOR):
        out = (out ^ out >> SHIFT ^ out >> SHIFT + SHIFT) * np.uint64(pow(int(factor), -1, 1 << 64))
    return out


def joined_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, one for each position that n words follow."""
    count = max(0, len(words) - n + 1)
    out = np.full(count, n, np.uint64)
    for j in range(n):
        out = mixed(out + words[j : j + count])
    return out


def shingle_sets(texts: pa.Array, n: int, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word shingles; of the whole sequence if it has fewer words; none without words."""
    words, offsets = hashed_words(texts, seed)
    shingles = joined_hashes(words, n)
    sets = []
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        if stop - start >= n:
            sets.append(np.unique(shingles[start : stop - n + 1]))
        else:
            sets.append(joined_hashes(words[start:stop], int(stop - start)) if stop > start else np.zeros(0, np.uint64))
    return sets


def slices(texts: pa.Array, most: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Start and stop of runs of texts with at most ``most`` bytes, or of one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes):
        yield start, len(sizes)


def sliced(texts: pa.Array, *others: pa.Array, most: int | None = None) -> Iterator[tuple[pa.Array, ...]]:
    """The columns of a batch in slices of bounded bytes of text, copied out of it, so that memory doesn't follow the length of texts times the rows of a batch."""
    for start, stop in slices(texts, *(() if most is None else (most,))):
        rows = pa.array(range(start, stop), pa.int64())
        yield tuple(column.take(rows) for column in (texts, *others))


def longs(hashes: np.ndarray) -> np.ndarray:
    """The same bits as signed numbers, as Spark's long has them."""
    return hashes.view(np.int64)
