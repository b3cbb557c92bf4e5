"""Adaptive context-mixing range coder for token ids.

A stream of ids is cut into blocks of ``BLOCK`` ids.  Every block is coded on
its own: models start empty, and its header carries the number of ids and
checksums of the ids and of the code.  Blocks are coded side by side, one
numpy lane each, so a step of the coder handles one id of every block.

An id gets its share of the range from a mixture of three predictions:

* order 2: the id that followed the last two ids before (hashed table),
* order 1: the id that followed the last id before,
* order 0: how often each id has occurred in the block so far,

and a uniform rest for ids that none of them knows.  The mixing weights
depend on how often the two contexts have been right lately and on whether
they agree; they adapt to which prediction was right in the block.  Weights
and order-0 counts take effect at fixed steps (``_REFRESH``).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 8192  # ids in a block
LANES = 1024  # most blocks coded side by side
MAGIC = b"CMX1"
_HEADER = "<4sIII"  # magic, ids, crc32 of the ids, crc32 of the code
_HEADER_SIZE = struct.calcsize(_HEADER)

_VOCAB = 1 << 16  # ids are below
_TOTAL_BITS = 24  # shares are of 2**24
_REST = 1 << 18  # least share of order 0 and of the uniform rest
_TABLE = 12  # log2 of the slots of a context table
_REFRESH = (64, 256, *range(1024, BLOCK, 1024))
_CHUNK = 64  # steps whose shares are computed at once
_MIX = 32  # mixing contexts: trust in order 2 (0-3), in order 1 (0-3), agreement

_EMPTY = _VOCAB << 2  # slot: id and trust; this id does not occur


def _first_counts() -> np.ndarray:
    """Counts that the mixing starts with: a context's trust speaks for it."""
    out = np.ones((_MIX, 4), dtype=np.int64)
    for mix in range(_MIX):
        order2, order1, agree = mix >> 3, mix >> 1 & 3, mix & 1
        out[mix, 0] = order2 * order2 + (2 if agree and order2 else 0)
        out[mix, 1] = 0 if agree else order1 * order1
    return out


_HASHES = np.arange(1, _VOCAB + 1, dtype=np.uint32) * np.uint32(0x9E3779B1)  # of all ids
_C2, _SHIFT2, _SHIFT = np.uint32(0x85EBCA77), np.uint32(7), np.uint32(32 - _TABLE)


def _slots(key: np.ndarray, before: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Slots of the contexts (order 2, order 1) in the lanes' tables; ``key``
    and ``before`` are the hashed last id and the one before it."""
    both = np.empty((*key.shape[:-1], 2, key.shape[-1]), dtype=np.uint32)
    first = both[..., 0, :]
    np.right_shift(before, _SHIFT2, out=first)
    np.bitwise_xor(first, key, out=first)
    np.multiply(first, _C2, out=first)
    both[..., 1, :] = key
    np.right_shift(both, _SHIFT, out=both)
    return both + base


def _learned(entry: np.ndarray, trust: np.ndarray, hit: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Table entries after ``ids`` came: a hit adds trust, a miss takes some,
    and a slot with little of it takes the new id."""
    right = hit.view(np.int8)
    new = entry - 1
    new += right + right
    np.minimum(new, entry | 3, out=new)
    return np.where((trust < 2) > hit, (ids << 2) + 1, new)


class _Lanes:
    """Model state of ``n`` blocks coded side by side.

    ``mixture`` has a row for each mixing context: where the shares of order
    2, order 1, order 0 and the rest begin, and the sizes of one part of each
    (order 0 has a part for each id so far, the rest one for each possible
    id)."""

    def __init__(self, n: int):
        self.lane = np.arange(n, dtype=np.int32) * _MIX
        self.table = np.full((2 * n) << _TABLE, _EMPTY, dtype=np.int32)  # order 2, then order 1
        self.base = np.arange(2 * n, dtype=np.int64).reshape(2, n) << _TABLE
        self.counts = np.tile(_first_counts().ravel(), n)
        self.refresh(0)

    def refresh(self, size: int) -> None:
        """Take the mixing counts so far; ``size`` ids are in order 0."""
        counts = self.counts.reshape(-1, 4)
        share = counts * ((1 << _TOTAL_BITS) - 2 * _REST) // counts.sum(axis=1, keepdims=True)
        share[:, 2] += _REST
        upto = np.cumsum(share[:, :3], axis=1)
        each = share[:, 2] // size if size else np.zeros(len(share), np.int64)
        rest = ((1 << _TOTAL_BITS) - upto[:, 2]) // _VOCAB
        unit = np.maximum(np.stack([share[:, 0], share[:, 1], each, rest], axis=1), 1)
        self.mixture = np.concatenate([np.zeros((len(unit), 1), np.int64), upto, unit], axis=1).astype(np.int32)

    def count(self, mix: np.ndarray, which: np.ndarray, live: np.ndarray) -> None:
        """Count the routes that were taken since the last refresh: mixing
        context and route by step and lane, number of lanes of each step."""
        at = (mix << 2) + which
        at = at.ravel() if live.min(initial=at.shape[1]) == at.shape[1] else at[np.arange(at.shape[1]) < live[:, None]]
        self.counts += np.bincount(at, minlength=len(self.counts))


class _Ranks:
    """Order 0 of blocks whose ids are known: how often each id of a block
    has occurred, by its rank among the block's different ids."""

    def __init__(self, seen: np.ndarray, sizes: np.ndarray):
        self.rank = np.zeros(seen.shape, dtype=np.uint16)
        self.counts = []
        there, number = np.zeros(_VOCAB, dtype=bool), np.zeros(_VOCAB, dtype=np.uint16)
        for lane, size in enumerate(sizes.tolist()):
            ids = seen[lane, :size]
            there[ids] = True
            different = np.flatnonzero(there)
            there[different] = False
            number[different] = np.arange(len(different))
            self.rank[lane, :size] = number[ids]
            self.counts.append(np.zeros(len(different), dtype=np.int64))

    def parts(self, begin: int, end: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where its ids begin in the sorted ids before ``begin``, how many
        there are) for each id from there, a row a lane; then count them."""
        first, size = np.zeros((2, len(sizes), end - begin), dtype=np.int32)
        for lane, upto in enumerate(np.minimum(sizes, end).tolist()):
            rank, counts = self.rank[lane, begin:upto], self.counts[lane]
            if begin:
                first[lane, :upto - begin] = (np.cumsum(counts) - counts).take(rank)
                size[lane, :upto - begin] = counts.take(rank)
            counts += np.bincount(rank, minlength=len(counts))
        return first, size


def _sorted_runs(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run in its lane at each place of the lanes' sorted ids, runs before
    each lane, runs): of a run of equal ids the id, where it begins (from bit
    16) and how long it is (from bit 32)."""
    size = seen.shape[1]
    ordered = np.sort(seen, axis=1)
    new = np.ones(ordered.shape, dtype=bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=new[:, 1:])
    begin = np.flatnonzero(new)
    run = np.diff(begin, append=ordered.size)
    before = np.searchsorted(begin, np.arange(len(seen)) * size)
    number = (np.arange(len(begin)) - np.repeat(before, np.diff(before, append=len(begin)))).astype(np.uint16)
    return np.repeat(number, run), before, run << 32 | (begin % size) << 16 | ordered.ravel()[begin]


def _carried(digits: np.ndarray) -> np.ndarray:
    """24-bit digits of a code whose digits may be one bit too long."""
    while True:
        over = digits >> 24
        if not over.any():
            return digits
        digits &= 0xFFFFFF
        digits[:-1] += over[1:]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Code of each block of ids (below 65,536; at most ``BLOCK`` a block)."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order], dtype=np.int64)
    n, steps = len(blocks), int(sizes.max(initial=0))
    seen = np.zeros((n, steps), dtype=np.uint16)
    for row, i in enumerate(order):
        seen[row, :len(blocks[i])] = blocks[i]
    state, ranks = _Lanes(n), _Ranks(seen, sizes)
    low, span = np.zeros(n, dtype=np.int64), np.full(n, (1 << 56) - 1, dtype=np.int64)
    digits = np.zeros((n, steps + 2), dtype=np.int32)
    out, used = digits.reshape(-1), np.arange(n, dtype=np.int64) * (steps + 2)
    edges = [0, *(e for e in _REFRESH if e < steps), steps]
    for begin, end in zip(edges, edges[1:]):
        m = int(np.searchsorted(-sizes, -begin))  # lanes that have this many ids
        if begin:
            state.refresh(begin)
        firsts, numbers = ranks.parts(begin, end, sizes[:m])
        mixes, routes = np.zeros((2, end - begin, m), dtype=np.int32)
        lives = np.searchsorted(-sizes, -np.arange(begin, end))  # lanes with an id at each step
        for b in range(begin, end, _CHUNK):
            e = min(b + _CHUNK, end)
            past = np.zeros((e - b + 2, m), dtype=np.int32)
            past[max(2 - b, 0):] = seen[:m, max(b - 2, 0):e].T
            ids, keys = past[2:], _HASHES.take(past)
            slots = _slots(keys[1:-1], keys[:-2], state.base[:, :m])
            entries = np.empty(slots.shape, dtype=np.int32)
            for t, (s, slot, entry) in enumerate(zip(ids, slots, entries)):
                state.table.take(slot, out=entry, mode="clip")
                state.table[slot] = _learned(entry, entry & 3, entry >> 2 == s, s)
            order2, order1 = entries[:, 0], entries[:, 1]
            guess2, guess1 = order2 >> 2, order1 >> 2
            # part of the share of order 0 (or of the rest): which one, how many
            first, number = (np.ascontiguousarray(x[:, b - begin:e - begin].T) for x in (firsts, numbers))
            known = number > 0
            hit2, hit1 = guess2 == ids, guess1 == ids
            guessed = hit2 | hit1
            mix = ((order2 & 3) << 3) + ((order1 & 3) << 1) + (guess2 == guess1) + state.lane[:m]
            which = np.where(guessed, ~hit2, 3 - known)
            mixes[b - begin:e - begin], routes[b - begin:e - begin] = mix, which
            at = (mix << 3) + which
            unit = state.mixture.take(at + 4)
            cums = (state.mixture.take(at) + unit * np.where(guessed, 0, np.where(known, first, ids))).astype(np.int64)
            parts = (unit * np.where(guessed | ~known, 1, number)).astype(np.int64)
            for live, cum, part in zip(lives[b - begin:e - begin].tolist(), cums, parts):
                r = span[:live] >> _TOTAL_BITS
                low[:live] += r * cum[:live]
                np.multiply(r, part[:live], out=span[:live])
                full = np.flatnonzero(span[:live] < (1 << 32))
                if len(full):
                    value, where = low[full], used[full]
                    out[where] = value >> 32
                    used[full] = where + 1
                    low[full] = (value & 0xFFFFFFFF) << 24
                    span[full] <<= 24
        state.count(mixes, routes, lives)
    out[used] = (low + 0xFFFFFFFF) >> 32
    coded: list[bytes] = [b""] * n
    used -= np.arange(n) * (steps + 2) - 1
    for row, i in enumerate(order):
        ids, code = blocks[i], b""
        if len(ids):
            code = _carried(digits[row, :used[row]]).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes().rstrip(b"\0")
        coded[i] = struct.pack(_HEADER, MAGIC, len(ids), zlib.crc32(np.asarray(ids, dtype="<u4").tobytes()), zlib.crc32(code)) + code
    return coded


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """Ids of each block; a damaged block raises ``ValueError``."""
    heads = []
    for block in coded:
        if len(block) < _HEADER_SIZE:
            raise ValueError("token block is cut off")
        magic, size, ids_crc, code_crc = struct.unpack_from(_HEADER, block)
        if magic != MAGIC or size > BLOCK or zlib.crc32(block[_HEADER_SIZE:]) != code_crc:
            raise ValueError("token block is damaged")
        heads.append((size, ids_crc))
    order = sorted(range(len(coded)), key=lambda i: -heads[i][0])
    sizes = np.array([heads[i][0] for i in order], dtype=np.int64)
    n, steps = len(coded), int(sizes.max(initial=0))
    width = max((len(b) for b in coded), default=0) // 3 + 4
    code = np.zeros((n, 7 + 3 * width), dtype=np.uint8)
    for row, i in enumerate(order):
        body = np.frombuffer(coded[i], dtype=np.uint8, offset=_HEADER_SIZE)
        code[row, :len(body)] = body
    value = np.zeros(n, dtype=np.int64)
    for b in range(7):
        value = value << 8 | code[:, b]
    triples = code[:, 7:].reshape(n, width, 3).astype(np.int32)
    digits = (triples[:, :, 0] << 16 | triples[:, :, 1] << 8 | triples[:, :, 2]).reshape(-1)
    del code, triples
    at = np.arange(n, dtype=np.int64) * width
    span = np.full(n, (1 << 56) - 1, dtype=np.int64)
    seen = np.zeros((n, steps), dtype=np.uint16)
    state = _Lanes(n)
    key = before = _HASHES.take(np.zeros(n, dtype=np.int32))
    # by route: id, and of the parts of its share which one and how many
    ids4, part4, number4 = np.zeros((4, n), np.int32), np.zeros((4, n), np.int32), np.ones((4, n), np.int32)
    columns = np.arange(n)
    rows = columns * 8
    edges = [0, *(e for e in _REFRESH if e < steps), steps]
    for begin, end in zip(edges, edges[1:]):
        m = int(np.searchsorted(-sizes, -begin))
        if begin:
            state.refresh(begin)
        run_of, base, runs = _sorted_runs(seen[:m, :begin]) if begin else np.zeros((3, n), np.int64)
        first, last = columns * begin, max(begin - 1, 0)
        ids = np.zeros((end - begin, n), dtype=np.int32)
        mixes, routes = np.zeros((2, end - begin, m), dtype=np.int32)
        lives = np.searchsorted(-sizes, -np.arange(begin, end))  # lanes with an id at each step
        steps_of = [0, *(np.flatnonzero(np.diff(lives)) + 1).tolist(), len(lives)] if len(lives) else []
        for b, e in zip(steps_of, steps_of[1:]):  # steps with the same lanes
            m = int(lives[b])
            low, width, where, lane, bases = value[:m], span[:m], at[:m], state.lane[:m], state.base[:, :m]
            guess, old, rest = ids4[:2, :m], ids4[2, :m], ids4[3, :m]
            old_part, rest_part, old_number = part4[2, :m], part4[3, :m], number4[2, :m]
            column, row, firsts, run_base = columns[:m], rows[:m], first[:m], base[:m]
            key, before = key[:m], before[:m]
            for t in range(b, e):
                slot = _slots(key, before, bases)
                entry = state.table.take(slot)
                np.right_shift(entry, 2, out=guess)
                trust = entry & 3
                mix = (trust[0] << 3) + (trust[1] << 1)
                mix += lane
                mix += np.multiply(guess[0] == guess[1], 1, dtype=np.int32)
                r = width >> _TOTAL_BITS
                x = (low // r).astype(np.int32)
                mixture = state.mixture.take(mix, axis=0)
                which = (x >= mixture[:, 1]).view(np.int8) + (x >= mixture[:, 2]).view(np.int8) + (x >= mixture[:, 3]).view(np.int8)
                place = which + row
                cum = mixture.take(place)
                place += 4
                unit = mixture.take(place)
                np.minimum((x - cum) // unit, _VOCAB - 1, out=rest)
                rest_part[:] = rest
                run = runs.take(run_of.take(np.minimum(rest, last) + firsts) + run_base)
                np.bitwise_and(run, 0xFFFF, out=old, casting="unsafe")
                np.bitwise_and(run >> 16, 0xFFFF, out=old_part, casting="unsafe")
                np.right_shift(run, 32, out=old_number, casting="unsafe")
                place = np.multiply(which, n, dtype=np.int64)
                place += column
                s = ids4.take(place)
                cum += unit * part4.take(place)
                unit *= number4.take(place)
                low -= r * cum
                np.multiply(r, unit, out=width)
                full = (width < (1 << 32)).astype(np.int64)
                shift = full * 24
                width <<= shift
                low <<= shift
                low |= digits.take(where) * full
                where += full
                ids[t, :m] = s
                mixes[t, :m], routes[t, :m] = mix, which
                state.table[slot] = _learned(entry, trust, guess == s, s)
                before, key = key, _HASHES.take(s)
        seen[:, begin:end] = ids.T
        state.count(mixes, routes, lives)
    found: list[np.ndarray] = [np.zeros(0, np.uint16)] * n
    for row, i in enumerate(order):
        size, ids_crc = heads[i]
        found[i] = seen[row, :size]
        if zlib.crc32(found[i].astype("<u4").tobytes()) != ids_crc:
            raise ValueError("token block does not decode to its checksum")
    return found
