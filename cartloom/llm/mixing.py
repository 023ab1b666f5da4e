"""Online logistic mixing of hashed-context bit predictors, for texts as bytes.

Texts are coded bit by bit, each followed by a byte that no UTF-8 text holds, so the probabilities of all texts sum
to one. The bits of a byte are its word in a prefix code made from the counts of bytes in the training texts, so that frequent
bytes take few decisions. A predictor knows, for a hash of its context and the bits of the byte read so far, how often the training
texts went on with a one. The log-odds of all predictors are added with weights that are chosen by whether the longest
context is known. Training reads the texts online: every bit is predicted by what was learnt before it, its error refines the weights, and
only then it is counted; errors are summed over a block's bits at one place of their words. In scoring, weights are refined after every bit.
They start from the learnt ones every SEGMENT bytes of a text, contexts do not: segments are
scored side by side, and a segment's bits depend on its own text alone, whichever rows share its slice.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np

from .arrays import SPACED, row_slices

BITS = 17  # slots of a predictor for each place in a byte's word: 2 ** BITS
PLACES = 8  # later places share the last one's slots
LONGEST = 16  # bits of a byte's word
ORDERS = (3,)  # bytes before; further contexts are the word so far, alone and with the word before it
CONTEXTS = len(ORDERS) + 2
END = 0xFF
SEGMENT = 512
PIECE = 1 << 19
SLOTS = PLACES * CONTEXTS << BITS
TILE = 16  # bits of every segment that are fetched at once
LOGGED = 8  # bits whose probabilities are multiplied before a logarithm is taken

_STEP, _SPREAD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SHIFT = np.uint32(32 - BITS)
_PART = (np.arange(CONTEXTS, dtype=np.uint32) << np.uint32(BITS))[:, None]
_SCALE = np.float32(1 / 12)  # log-odds are kept in these steps in one byte
_BASE = np.uint32(0x01000193)
_UNDO = np.uint32(pow(int(_BASE), -1, 1 << 32))
_CODES = np.random.default_rng(7).integers(1, 1 << 32, 256, dtype=np.uint32)
_LEAST = 0.4  # added to both counts
WEIGHT, RATE = 0.4, np.float32(0.02 * float(_SCALE) ** 2)
MOST = np.float32(8)  # log-odds of the mixture
REFINED = 1 << 13  # bits of a block, at one place of their words
_FIRM = 1e5  # how firmly training starts from WEIGHT: as after some hundred bits


def with_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = offsets + np.arange(len(offsets))
    full = np.full(out[-1], END, np.uint8)
    full[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = data
    return full, out


def contexts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint32[CONTEXTS, bytes]: hashes of what stands before each byte of a slice; `data` holds the end bytes."""
    out = np.empty((CONTEXTS, len(data)), np.uint32)
    for low, high in row_slices(offsets, PIECE):
        part = offsets[low : high + 1]
        _contexts(data[part[0] : part[-1]], part - part[0], out[:, part[0] : part[-1]])
    return out


def _contexts(data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    n = len(data)
    past = np.zeros(n, np.uint32)
    for k in range(1, 5):
        past[k:] |= data[: n - k].astype(np.uint32) << np.uint32(8 * (k - 1))
    firsts = offsets[:-1]
    for k in range(4):  # nothing is read from before the row
        at = firsts[firsts + k < offsets[1:]] + k
        past[at] &= np.uint32((1 << 8 * k) - 1)
    for i, k in enumerate(ORDERS):
        h = (past & np.uint32((1 << 8 * k) - 1)) * np.uint32(0x9E3779B1) + np.uint32(k)
        h ^= h >> np.uint32(15)
        h *= _SPREAD
        out[i] = h
    start = np.zeros(n, bool)
    start[1:] = ~SPACED[data[:-1]]
    start[firsts] = True
    word = np.maximum.accumulate(np.where(start, np.arange(n, dtype=np.int32), np.int32(0)))
    starts = np.flatnonzero(start).astype(np.int32)
    before = np.r_[np.int32(0), starts[:-1]]
    opens = np.isin(starts, firsts, assume_unique=True)
    before[opens] = starts[opens]
    last = np.repeat(before, np.diff(np.r_[starts, n]))
    # Hashes of ranges from sums of codes times powers: a range's sum times the inverse power of its start.
    sums = np.zeros(n + 1, np.uint32)
    back = powers(_UNDO, n)
    np.cumsum(_CODES[data] * powers(_BASE, n), dtype=np.uint32, out=sums[1:])
    for i, low in ((-2, word), (-1, last)):
        h = (sums[:-1] - sums[low]) * back[low]
        h ^= h >> np.uint32(15)
        h *= _SPREAD
        h ^= h >> np.uint32(13)
        out[i] = h


_held: dict[int, np.ndarray] = {}


def powers(base: np.uint32, n: int) -> np.ndarray:
    held = _held.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, PIECE + 1), base, np.uint32)
        held[0] = 1
        held = np.multiply.accumulate(held, dtype=np.uint32)
        if n <= PIECE + 1:
            _held[int(base)] = held
    return held[:n]


def slots(base: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Slots of all predictors, after one another, for the bits read so far of a byte's word (`node`, a one before them)."""
    out = base ^ (node * _STEP)
    out *= _SPREAD
    out >>= _SHIFT
    out += _PART
    return out


class Code(NamedTuple):
    """A prefix code of the 256 bytes: the bits of each word, as a number, and how many they are."""

    word: np.ndarray
    length: np.ndarray


def code_of(counts: np.ndarray) -> Code:
    """The prefix code with the fewest bits for 256 counts, which are flattened until no word is longer than LONGEST."""
    counts = [int(n) + 1 for n in counts]
    while True:
        heap = [(n, byte, (byte,)) for byte, n in enumerate(counts)]
        heapq.heapify(heap)
        length = np.zeros(256, np.uint8)
        while len(heap) > 1:
            (n, tie, few), (m, _, more) = heapq.heappop(heap), heapq.heappop(heap)
            length[list(few + more)] += 1
            heapq.heappush(heap, (n + m, tie, few + more))
        if length.max() <= LONGEST:
            break
        counts = [n // 2 + 1 for n in counts]
    word, following, before = np.zeros(256, np.uint32), 0, 0
    for byte in np.argsort(length, kind="stable"):
        following <<= int(length[byte]) - before
        word[byte], before = following, int(length[byte])
        following += 1
    return Code(word, length)


def _decisions(data: np.ndarray, base: np.ndarray, code: Code):
    """For every place in a word: its slots' place, itself, where the bytes stand whose words reach it, slots, and the word's bit."""
    word, length = code.word[data], code.length[data].astype(np.uint32)
    at, k = np.arange(len(data)), 0
    while len(at):
        bits = word >> (length - np.uint32(k + 1))
        bit = bits & np.uint32(1)
        bits >>= np.uint32(1)
        bits |= np.uint32(1 << k)
        yield min(k, PLACES - 1), k, at, slots(base, bits), bit
        k += 1
        some = np.flatnonzero(length > k)
        if len(some) < len(at):
            at, word, length, base = at[some], word[some], length[some], base.take(some, axis=1)


def count(counts: np.ndarray, data: np.ndarray, offsets: np.ndarray, code: Code) -> None:
    """Add the bits of a slice of texts to int64[PLACES, 2 * CONTEXTS << BITS]: zeros and ones of each slot."""
    learn(counts, None, None, data, offsets, code)


class Mixer:
    """Weights of the predictors, in steps of log-odds, where the longest context is unknown and where it is known.

    A Newton step follows each block of bits, against the curvature of all blocks so far.
    """

    def __init__(self):
        self.weights = np.full((2, CONTEXTS), WEIGHT * float(_SCALE))
        self.curvature = np.tile(np.eye(CONTEXTS) * _FIRM, (2, 1, 1))

    def refine(self, x: np.ndarray, bit: np.ndarray) -> None:
        """Predict bits from float32[CONTEXTS, n] log-odds, and move the weights by the errors."""
        known = (x[-1] != 0).astype(np.float32)
        total, extra = np.array([self.weights[0], self.weights[1] - self.weights[0]], np.float32) @ x
        extra *= known
        total += extra
        np.clip(total, -MOST, MOST, out=total)
        np.negative(total, out=total)
        np.exp(total, out=total)
        total += np.float32(1)
        np.reciprocal(total, out=total)
        bent = np.empty((CONTEXTS + 1, len(bit)), np.float32)
        np.subtract(bit, total, out=bent[-1])
        total *= np.float32(1) - total
        np.multiply(x, total, out=bent[:-1])
        both = np.empty((2, CONTEXTS, CONTEXTS + 1))
        both[1] = _products(x, bent)
        # The longest context has no part in what is left: its log-odds are 0 there.
        bent *= np.float32(1) - known
        both[0] = _products(x, bent)
        both[1] -= both[0]
        self.curvature += both[:, :, :-1]
        self.weights += np.linalg.solve(self.curvature, both[:, :, -1:])[..., 0]


def _products(x: np.ndarray, bent: np.ndarray) -> list[list[float]]:
    return [[float(np.dot(a, b)) for b in bent] for a in x]


def together(mixers: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights of several mixers' (weights, curvature), each counting as much as it has learnt."""
    if not mixers:
        return Mixer().weights
    pulls = sum(np.einsum("sij,sj->si", curvature, weights) for weights, curvature in mixers)
    return np.linalg.solve(sum(curvature for _, curvature in mixers), pulls[..., None])[..., 0]


def learn(counts: np.ndarray, odds: np.ndarray | None, mixer: Mixer | None, data: np.ndarray, offsets: np.ndarray, code: Code) -> None:
    """Refine `mixer` by the bits of a slice of texts, predicted under `odds`, and add them to `counts` (see `count`)."""
    data, offsets = with_ends(data, offsets)
    low = 2 << BITS
    for k, _, _, cell, bit in _decisions(data, contexts(data, offsets), code):
        for first in range(0, 0 if odds is None else len(bit), REFINED):
            some = slice(first, first + REFINED)
            mixer.refine(odds[k].take(cell[:, some]).astype(np.float32), bit[some].astype(np.float32))
        cell <<= np.uint32(1)
        cell |= bit
        for c in range(CONTEXTS):
            counts[k, c * low : (c + 1) * low] += np.bincount(cell[c] - np.uint32(c * low), minlength=low)


def _log_odds(counts: np.ndarray) -> np.ndarray:
    odds = np.log((counts[..., 1] + _LEAST) / (counts[..., 0] + _LEAST))
    return np.clip(np.rint(odds / _SCALE), -127, 127).astype(np.int8)


_ODDS = _log_odds(np.arange(1 << 16).astype("<u2").view(np.uint8).reshape(-1, 2).astype(float))


def log_odds(counts: np.ndarray) -> np.ndarray:
    """int8 log-odds of a one for int64[..., 2] counts; 0 where nothing is known."""
    few = np.minimum(counts, 255).astype(np.uint8).view("<u2")[..., 0]
    out = _ODDS.take(few)
    many = few >> 8 == 255
    many |= few & 255 == 255
    out[many] = _log_odds(counts[many])
    return out


def _segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of all segments."""
    size = np.diff(offsets)
    parts = -(-size // SEGMENT)
    row = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = offsets[row] + nth * SEGMENT
    return row, start, np.minimum(offsets[row + 1] - start, SEGMENT)


def _looked_up(data: np.ndarray, offsets: np.ndarray, odds: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Each bit's log-odds and itself, in four bytes read as one number, and where the bits of every byte start."""
    first = np.zeros(len(data) + 1, np.int64)
    np.cumsum(code.length[data], out=first[1:])
    held = np.zeros(first[-1] + TILE, np.uint32)
    for low, high in row_slices(offsets, PIECE):
        a, b = offsets[low], offsets[high]
        base = contexts(data[a:b], offsets[low : high + 1] - a)
        for k, nth, at, cell, bit in _decisions(data[a:b], base, code):
            at = first[a:b].take(at)
            at += nth
            found = odds[k].take(cell).view(np.uint8)
            bit <<= np.uint32(8)
            for c in reversed(range(CONTEXTS)):
                bit |= found[c]
                if c:
                    bit <<= np.uint32(8)
            held[at] = bit
    return held, first


def bits_of(data: np.ndarray, offsets: np.ndarray, odds: np.ndarray, code: Code, start_from: np.ndarray | None = None) -> np.ndarray:
    """Bits that each row's text takes, under int8[PLACES, CONTEXTS << BITS] log-odds and the weights of a `Mixer`."""
    rows = len(offsets) - 1
    data, offsets = with_ends(data, offsets)
    held, first = _looked_up(data, offsets, odds, code)
    row, start, length = _segments(offsets)
    length = first[start + length] - first[start]
    order = np.argsort(-length, kind="stable")
    row, start, length = row[order], first[start[order]], length[order]
    lanes = len(row)
    first_weights = (Mixer().weights if start_from is None else start_from).astype(np.float32)
    # Two sets of weights: without and with a count for the longest context, whose own weight counts in the second only.
    plain_weights = np.repeat(np.r_[first_weights[0, :-1], first_weights[1, -1]][:, None], lanes, 1)
    extra_weights = np.repeat((first_weights[1] - first_weights[0])[:-1, None], lanes, 1)
    spent, product = np.zeros(lanes), np.ones(lanes, np.float32)
    active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), "left")
    one = np.float32(1)
    begun = lanes
    room = np.empty((3, CONTEXTS, lanes), np.float32)
    ahead = np.lib.stride_tricks.sliding_window_view(held, TILE)
    fetched, seen = np.empty((CONTEXTS + 1, TILE, lanes), np.float32), np.empty((TILE, lanes), np.float32)
    for t, n in enumerate(active):
        if t % LOGGED == 0:
            spent[:begun] -= np.log2(product[:begun])
            product[:begun] = 1
            begun = n
        here = t % TILE
        if here == 0:
            tile = ahead[start[:n] + t].view(np.int8)
            fetched[:, :, :n] = tile.reshape(n, TILE, CONTEXTS + 1).transpose(2, 1, 0)
            np.abs(fetched[-2, :, :n], out=seen[:, :n])
            np.minimum(seen[:, :n], one, out=seen[:, :n])
        x, bit, known = fetched[:-1, here, :n], fetched[-1, here, :n], seen[here, :n]
        mixed, step, total = room[0, :, :n], room[1, :-1, :n], room[2, 0, :n]
        plain, extra = plain_weights[:, :n], extra_weights[:, :n]
        np.multiply(extra, known, out=mixed[:-1])
        mixed[:-1] += plain[:-1]
        mixed[:-1] *= x[:-1]
        np.multiply(x[-1], plain[-1], out=mixed[-1])
        np.add(mixed[0], mixed[1], out=total)
        for c in range(2, CONTEXTS):
            total += mixed[c]
        np.maximum(total, -MOST, out=total)
        np.minimum(total, MOST, out=total)
        np.negative(total, out=total)
        np.exp(total, out=total)
        total += one
        np.reciprocal(total, out=total)
        error = np.subtract(bit, total, out=total)
        np.abs(error, out=bit)
        np.subtract(one, bit, out=bit)  # the probability of this bit
        product[:n] *= bit
        error *= RATE
        x *= error
        # Weights are kept as those of unknown contexts and what known ones add to them.
        np.multiply(x[:-1], known, out=step)
        x[:-1] -= step
        plain += x
        step -= x[:-1]
        extra += step
    spent[:begun] -= np.log2(product[:begun])
    return np.bincount(row, spent, minlength=rows)
