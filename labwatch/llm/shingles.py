"""Word shingles as sorted 64-bit hashes, and parity sketches of them."""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from xxhash import xxh3_64_intdigest

from labwatch.llm.common import mix64

ODD = np.uint64(0x9E3779B97F4A7C15)
# Bits of a folded sketch per difference that a linked pair may have; unlike sets then differ in far more bits.
FOLD = 3
LARGEST_FOLD = 1 << 16


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words, sorted; fewer words count as one run, none as no run.

    A-Z are lower-cased; words are separated by blank, tab, line feed, vertical tab, form feed and carriage return.
    """
    split = text.lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(xxh3_64_intdigest, split, repeat(1)), np.uint64, len(split))
    runs = max(1, len(words) - size + 1)
    used = min(size, len(words))
    mixed = words[:runs] + np.uint64(used)
    for k in range(1, used):
        mixed = mixed * ODD
        mixed ^= mixed >> np.uint64(29)
        mixed += words[k : k + runs]
    mixed = mix64(mixed)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def set_digest(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a sorted set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


class Bands:
    """Size bands for a Jaccard threshold ``num / den``: their upper ends and how many sketch segments each uses.

    Sets of sizes a and b reach the threshold only if they differ in at most (a + b) (den - num) / (den + num)
    elements. A band has more segments than any such pair with its larger set in the band can differ in, so the two
    sketches have an equal segment; ``spare`` makes room for segments that no element falls into.
    """

    def __init__(self, num: int, den: int, growth: float = 1.5, spare: float = 0.17):
        self.num, self.den, self.growth, self.spare = num, den, growth, spare
        self.ends = [1]

    def band(self, size: int) -> int:
        while self.ends[-1] < size:
            self.ends.append(max(self.ends[-1] + 1, int(self.ends[-1] * self.growth)))
        return int(np.searchsorted(self.ends, size))

    def most_different(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def segments(self, band: int) -> tuple[int, int]:
        """The largest difference in the band, and its number of segments."""
        most = self.most_different(self.ends[band], self.ends[band])
        return most, most + 1 + int(self.spare * most)

    def bands_of(self, size: int) -> range:
        """The set's own band and those of larger sets it may link with."""
        return range(self.band(size), self.band(max(size, size * self.den // self.num)) + 1)


def segment_keys(shingles: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """Join keys of a set's parity sketch in a band: two sets that may link share at least one.

    The sketch has a segment of 2**56 bits for each residue of the hash; an element flips one bit of one segment. A
    key is the exclusive or of its odd bits' hashes, so it is equal when band, segment and all bits are.

    Segments without elements are left out where the others are more than the band's largest difference: among so
    many one stays untouched. Otherwise all of them are keys, so that a pair meets if either set leaves none out.
    """
    most, count = bands.segments(band)
    segment = shingles % np.uint64(count)
    order = np.argsort(segment, kind="stable")
    segment = segment[order]
    starts = np.concatenate(([0], np.nonzero(segment[1:] != segment[:-1])[0] + 1))
    bits = np.bitwise_xor.reduceat(mix64(shingles[order] >> np.uint64(8)), starts)
    place = segment[starts]
    if len(place) <= most:
        rest = np.setdiff1d(np.arange(count, dtype=np.uint64), place)
        place, bits = np.concatenate((place, rest)), np.concatenate((bits, np.zeros(len(rest), np.uint64)))
    return mix64(bits ^ mix64((place + np.uint64((band + 1) << 40)) * ODD)).view(np.int64)


def folded_sketch(shingles: np.ndarray, bands: Bands) -> bytes:
    """The parity sketch folded to a power of two of bits, at least 512: sets differ in no fewer elements than bits."""
    size = len(shingles)
    bits = 512
    while bits < min(FOLD * bands.most_different(size, size * bands.den // bands.num), LARGEST_FOLD):
        bits *= 2
    odd = np.bincount((shingles >> np.uint64(8)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold_to(sketch: bytes, words: int) -> np.ndarray:
    """A folded sketch as ``words`` 64-bit integers, halved by exclusive or as often as needed."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, "<u8").reshape(-1, words), axis=0)


def similar_enough(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets of distinct hashes reach the Jaccard threshold ``num / den``, exactly."""
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return den * shared >= num * (len(both) - shared)
