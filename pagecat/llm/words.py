"""Words and word n-grams of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import functools
import sys

import numpy as np

# Bytes that part words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finalizer of SplitMix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))
_BASE = 0x5851F42D4C957F2D


def powers(n: int) -> np.ndarray:
    """1, b, b**2 … of an odd base, modulo 2**64."""
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def grouped(texts: list[bytes | None], size: int = 1 << 20):
    """Runs of texts of about ``size`` bytes: (number of the first one, texts). A longer text stands alone, whole."""
    first, held, group = 0, 0, []
    for k, text in enumerate(texts):
        group.append(text or b"")
        held += len(group[-1])
        if held >= size:
            yield first, group
            first, held, group = k + 1, 0, []
    if group:
        yield first, group


def words(texts: list[bytes], parted: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in a row: hash of each word with A-Z lower-cased, its start and end (bytes from the start of its own text),
    and per text the number of its first word (one entry more than texts)."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    gap = parted[joined]
    inside = ~gap
    begin = np.flatnonzero(inside & np.concatenate(([True], gap[:-1])))
    end = np.flatnonzero(gap & np.concatenate(([False], inside[:-1])))
    if not len(begin):
        return np.zeros(0, np.uint64), begin, end, np.zeros(len(texts) + 1, np.int64)
    length = end - begin
    chars = joined[inside]
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(len(chars)) - np.repeat(first, length)
    value = _BYTE[LOWER[chars]] * powers(int(length.max()))[place]
    hashes = mix(np.add.reduceat(value, first) + length.astype(np.uint64))
    numbers = np.searchsorted(begin, at)
    owner = at[np.repeat(np.arange(len(texts)), np.diff(numbers))]
    return hashes, begin - owner, end - owner, numbers


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Per code point the value of its folded letter or digit, whether it is none, whether it folds to several, and the values of
    those. Folded are capitals, so a text in capitals has the words of the text itself (STRASSE for straße)."""
    size = sys.maxunicode + 1
    code, gap, wide, several = np.arange(size, dtype=np.uint64), np.ones(size, bool), np.zeros(size, bool), {}
    for c in range(size):
        if (char := chr(c)).isalnum():
            gap[c] = False
            folded = [ord(x) for x in char.upper().casefold() if x.isalnum()]
            code[c] = folded[0] if folded else c
            if len(folded) > 1:
                wide[c], several[c] = True, mix(np.array(folded, np.uint64))
    return mix(code), gap, wide, several


def letter_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, for runs of Unicode's letters and digits in any case; starts and ends in code points."""
    value, parted, wide, several = _letters()
    joined = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    values, gap, own = value[joined], parted[joined], None
    if len(more := np.flatnonzero(wide[joined])):
        rest = [several[c][1:] for c in joined[more].tolist()]
        after = np.repeat(more + 1, [len(x) for x in rest])
        values, gap, own = np.insert(values, after, np.concatenate(rest)), np.insert(gap, after, False), np.insert(np.arange(len(gap)), after, after - 1)
    inside = ~gap
    begin = np.flatnonzero(inside & np.concatenate(([True], gap[:-1])))
    end = np.flatnonzero(gap & np.concatenate(([False], inside[:-1])))
    if not len(begin):
        return np.zeros(0, np.uint64), begin, end, np.zeros(len(texts) + 1, np.int64)
    length = end - begin
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
    hashes = mix(np.add.reduceat(values[inside] * powers(int(length.max()))[place], first) + length.astype(np.uint64))
    if own is not None:
        begin, end = own[begin], own[end]
    numbers = np.searchsorted(begin, at)
    owner = at[np.repeat(np.arange(len(texts)), np.diff(numbers))]
    return hashes, begin - owner, end - owner, numbers


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; the last n - 1 places hold none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    steps = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total += hashes[k:len(hashes) - n + 1 + k] * steps[k]
    return mix(total + np.uint64(n))


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """Per text its distinct n-word shingles, sorted, in 48 bits; of fewer words the whole sequence as one; of none, none."""
    hashes, _, _, numbers = words(texts)
    grams = ngrams(hashes, n)
    out = []
    for a, b in zip(numbers[:-1], numbers[1:], strict=True):
        own = grams[a:b - n + 1] if b - a >= n else ngrams(hashes[a:b], int(b - a)) if b > a else grams[:0]
        out.append(np.unique(own >> np.uint64(16)))
    return out


def pack(shingles: np.ndarray) -> bytes:
    """Six bytes for each."""
    return np.ascontiguousarray(shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def pieces(text: bytes, parted: np.ndarray = SPACE, size: int = 1 << 20):
    """A text in slices of about ``size`` bytes, each ending where a word ends: a long text is taken apart, its words are not."""
    data, at = np.frombuffer(text, np.uint8), 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and not (gap := parted[data[end:end + size]]).any():
            end += size
        if end >= len(text):
            break
        end += int(gap.argmax())
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes], size: int = 1 << 20) -> list[np.ndarray]:
    """Per text the hashes of its words. The room needed beyond them is bounded, however long a text is."""
    out: list[np.ndarray] = []
    for _, group in grouped(texts, size):
        if len(group) == 1:
            out.append(np.concatenate([words([p])[0] for p in pieces(group[0], SPACE, size)]))
        else:
            hashes, _, _, numbers = words(group)
            out += [hashes[a:b] for a, b in zip(numbers[:-1], numbers[1:], strict=True)]
    return out


def wide_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """As ``shingle_sets``, in 64 bits."""
    return [np.unique(ngrams(h, min(n, len(h)) or 1)) for h in word_hashes(texts)]
