"""Compressed token-id files: a context-mixing model drives a range coder, many blocks at a time.

File format. A file is Parquet whose rows are segments of whole documents in key order:
`segment` (binary), plus the first key. A segment is little-endian:

    4s magic "PKT1", u32 version (3), u32 documents, u32 block ids, u32 blocks, u32 model bytes
    documents x u32                     ids of each document, its end id included
    blocks x (u32 bytes, u32 crc32 of the ids as u32)
    the model that blocks start with (see Model.pack)
    the blocks' payloads: range-coded words

All blocks but the last hold `block ids` ids. Each block is coded on its own: its mixture starts from the segment's
model, which is read before, and learns from the block's ids only. So blocks are coded and decoded side by side, one id
of every block per step, and damage to a payload stays within a block.

Model. Three orders: order 2 (the id foretold after the last two ids, by hashed pair), order 1 (the id foretold after the
last id) and order 0, which has two sources: counts of the block's earlier ids, brought up to date at powers of two and
every EVERY ids, and counts over the segment of the ids that neither other order foretells there. Orders 2 and 1
start with what most often follows in the segment; what follows in the block then changes the guess and how sure it is.
Their mixture is P(s) = w2 [s = c2] + w1 [s = c1] + wb fb(s) + w0 f0(s). The weights depend on the state: how sure orders
2 and 1 are, in eight classes each, and whether they agree. They start with the segment's shares of right guesses and adapt
per block to how often each was right in that state; wb and w0 adapt to how often the block's counts were used.
Rare ids are one escape to the model, followed by the bits of the id, which go through the coder too. All arithmetic is
on integers below 2**53, so coder and decoder agree on any machine.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.order import running_starts
from prepkit.llm.shared import col, map_arrow, new_dir, slices, width
from prepkit.llm.tokens import encoder

BLOCK = 2048
"""Ids of a block."""

LANES = 4096
"""Blocks that are coded side by side; bounds a task's memory."""

STEPS = 8
"""Steps between changes of the weight of a block's own counts; the encoder works out their intervals at once."""

EVERY = 512
"""Steps between updates of a block's own counts, after those at powers of two."""

OWN = [n for n in range(16, BLOCK) if n % EVERY == 0 or (n < EVERY and n & (n - 1) == 0)]
"""Steps at which a block's own counts are brought up to date; multiples of STEPS."""

SLOTS = 2048
"""Contexts of each order that a block remembers; one that loses its place starts anew with the segment's guess."""

APART = 16
"""Unused places between the blocks' memories, lest the same context of all blocks shares a line of the processor's cache."""

MOST_IDS = 1 << 15
"""Ids that a segment's model tells apart; the rarest beyond, and those met once, are escapes."""

SCALE = 24
"""The range is cut into 1 << SCALE units: 256 shares for the mixture, each of 65536 for order 0."""

TOTAL = 1 << SCALE
SHARE0 = 1 << 16
LIMITS = np.array([0.03, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8])
"""Shares of right guesses between the eight classes."""

RATE = 5
"""A weight moves by 1 / (1 << RATE) of its distance at each id in its state."""

CHUNK = 1 << 15
"""Ids of a segment that are counted at once."""

STATES = 128
MIX = 40503  # odd: spreads the last id but one over the slots
SURE = 7  # bits of a guess that say how sure it is; the id is above them
GUESS = 1 << 19  # guesses are below; in a block's memory the context is above
EMPTY = 2**32 - 1  # of a memory: above all guesses with the mark of any context
MOST = 255 << 8  # weights of orders 2 and 1, of 65536: at least 2 of 256 shares are left to order 0
MAGIC = b"PKT1"
HEADER = struct.Struct("<4s5I")


def _followers(context: np.ndarray, after: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context below `size`, what most often comes after it, and the class of how often."""
    best, kind = np.zeros(size, np.int64), np.zeros(size, np.int64)
    if len(after):
        pairs = np.empty(len(after), np.uint32)  # both are below 1 << 16
        for a in range(0, len(after), CHUNK):
            pairs[a:a + CHUNK] = context[a:a + CHUNK].astype(np.uint32) << 16 | after[a:a + CHUNK]
        pairs.sort()
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        n = np.diff(np.append(first, len(pairs)))
        pairs = pairs[first].astype(np.int64)
        held = pairs >> 16
        begin = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        most = np.maximum.reduceat(n << 16 | pairs & 0xFFFF, begin)
        best[held[begin]] = most & 0xFFFF
        # One sight proves nothing: a guess is as sure as it would be after one more id.
        kind[held[begin]] = np.searchsorted(LIMITS, ((most >> 16) - 0.5) / np.add.reduceat(n, begin), side="right")
    return best, kind


class Model:
    """What the blocks of a segment start with. Ids are places in `table`; the place behind its end is the escape."""

    def __init__(self, table: np.ndarray, bits: int, id_bits: int, tables: list[np.ndarray], weights: np.ndarray, f0: np.ndarray):
        self.table, self.bits, self.id_bits, self.tables = table, bits, id_bits, tables
        self.weights = weights.astype(np.uint32)  # by state, of 65536: order 2 in the lower 16 bits, order 1 above
        self._fill(f0)
        best1, kind1, best2, kind2 = (t.astype(np.uint32) for t in tables)
        self.one, self.two = best1 << 3 | kind1, best2 << 3 | kind2

    def _fill(self, f0: np.ndarray) -> None:
        self.f0 = f0.astype(np.int64)
        self.start0 = np.cumsum(self.f0) - self.f0
        # Of each of order 0's shares: the place that holds it, where that one starts and its size, side by side.
        self.held0 = np.repeat(np.arange(len(self.f0)) | self.start0 << 16 | self.f0 << 32, self.f0)

    @classmethod
    def fit(cls, ids: np.ndarray) -> tuple[Model, np.ndarray, np.ndarray]:
        """(model of the ids, the ids as places in its table, the guesses of order 2 and order 1 for each)."""
        id_bits = max(1, int(ids.max(initial=0)).bit_length())
        if id_bits <= 20:
            counts = sum((np.bincount(ids[a:a + (1 << 20)], minlength=1 << id_bits) for a in range(0, len(ids), 1 << 20)),
                         np.zeros(1 << id_bits, np.int64))
            names = np.flatnonzero(counts > 1)
            counts = counts[names]
        else:
            names, counts = np.unique(ids, return_counts=True)
            names, counts = names[counts > 1].astype(np.int64), counts[counts > 1]
        if len(names) > MOST_IDS:
            names = np.sort(names[np.argsort(-counts, kind="stable")[:MOST_IDS]])
        escape = len(names)
        places = np.full(1 << min(id_bits, 20), escape, np.uint16)
        if id_bits <= 20:
            places[names] = np.arange(escape)
        bits = max(4, min(16, len(ids).bit_length() - 6))
        mask = (1 << bits) - 1
        at, slots = np.empty(len(ids), np.uint16), np.empty(max(0, len(ids) - 2), np.uint16)
        for a in range(0, len(ids), CHUNK):
            some = ids[a:a + CHUNK].astype(np.int64)
            if id_bits <= 20:
                at[a:a + CHUNK] = places.take(some)
            else:
                found = np.searchsorted(names, some)
                at[a:a + CHUNK] = np.where(np.append(names, -1)[found] == some, found, escape)
        one, two = at[1:-1], at[:-2]
        for a in range(0, len(slots), CHUNK):
            slots[a:a + CHUNK] = (two[a:a + CHUNK].astype(np.int64) * MIX ^ one[a:a + CHUNK]) & mask
        tables = [*_followers(at[:-1], at[1:], escape + 1), *_followers(slots, at[2:], mask + 1)]
        model = cls(names.astype(np.uint32), bits, id_bits, tables, np.zeros(STATES), np.ones(escape + 1))
        seen, rest = np.zeros(3 * STATES, np.int64), np.zeros(escape + 1, np.int64)
        guesses = np.zeros((2, len(at)), np.uint32)
        for a in range(0, max(0, len(at) - 2), CHUNK):
            now = at[2:][a:a + CHUNK]
            g2, g1 = guesses[:, 2:][:, a:a + CHUNK] = model.guess(two[a:a + CHUNK].astype(np.int64) * MIX, one[a:a + CHUNK])
            not2 = g2 >> 3 != now
            not1 = not2 & (g1 >> 3 != now)
            both = np.concatenate([g2, g1])
            seen += np.bincount(_state(both & SURE, both >> 3) + STATES * (not2.astype(np.int64) + not1), minlength=3 * STATES)
            rest += np.bincount(now[not1], minlength=escape + 1)
        n2, n1, n0 = seen.reshape(3, STATES) + [[0], [0], [1]]
        n = n2 + n1 + n0
        weights = (MOST - 1) * n2 // n | (MOST - 1) * n1 // n << 16
        spare = SHARE0 - len(rest)
        f0 = 1 + rest * spare // max(1, int(rest.sum()))
        f0[np.argmax(f0)] += SHARE0 - int(f0.sum())
        # A block begins anew, as if after two ids at place 0.
        for step, begin in enumerate((at[::BLOCK], at[1::BLOCK])):
            before = at[::BLOCK][:len(begin)] * step
            guesses[:, step::BLOCK] = model.guess(np.zeros_like(before), before)
        return cls(model.table, bits, id_bits, tables, weights, f0), at, guesses

    def guess(self, mixed: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What orders 2 and 1 foretell over the segment, each with its class, after the last id and the one before, which
        comes as its product with MIX."""
        return self.two.take((mixed ^ one) & (1 << self.bits) - 1), self.one.take(one)

    def pack(self) -> bytes:
        """zlib of u32 ids, u32 bits of a slot, u32 bits of an id, the table as u32 steps, f0 as u16 less 1, the guesses of
        order 1 and 2 as u16, their classes as u8, the weights as u32 per state."""
        best1, kind1, best2, kind2 = self.tables
        steps = np.diff(self.table.astype(np.int64), prepend=0)
        return zlib.compress(b"".join([
            struct.pack("<3I", len(self.table), self.bits, self.id_bits), steps.astype("<u4").tobytes(),
            (self.f0 - 1).astype("<u2").tobytes(), best1.astype("<u2").tobytes(), best2.astype("<u2").tobytes(),
            kind1.astype("u1").tobytes(), kind2.astype("u1").tobytes(), self.weights.astype("<u4").tobytes()]), 3)

    @classmethod
    def unpack(cls, data: bytes) -> Model:
        try:
            raw = zlib.decompress(data)
        except zlib.error as e:
            raise ValueError("the model fails its checksum") from e
        n, bits, id_bits = struct.unpack_from("<3I", raw)
        at, found = 12, []
        for kind, size in (("<u4", n), ("<u2", n + 1), ("<u2", n + 1), ("<u2", 1 << bits), ("u1", n + 1), ("u1", 1 << bits),
                           ("<u4", STATES)):
            found.append(np.frombuffer(raw, kind, size, at))
            at += found[-1].nbytes
        steps, f0, best1, best2, kind1, kind2, weights = found
        table = np.cumsum(steps.astype(np.int64)).astype(np.uint32)
        return cls(table, bits, id_bits, [best1, kind1, best2, kind2], weights, f0.astype(np.int64) + 1)


def _state(sure: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The state of the weights: how sure the guesses of orders 2 and 1, in a row, are, and whether they name one id."""
    m = len(ids) // 2
    return (sure[:m] << 4 | sure[m:] << 1 | (ids[:m] == ids[m:])).astype(np.int64)


class Mixture:
    """The mixed prediction of every block, which learns from the block's ids: `look`, then `shares`, then `learn`.

    What concerns orders 2 and 1 is one row: all lanes' order 2, then their order 1.
    """

    FADE = np.uint32((0xFFFF >> RATE) * 0x10001)  # keeps a weight's bits out of the other's when both are shifted
    STEP = np.uint32((MOST >> RATE) - 1)  # so that both together stay below MOST
    ONE = np.uint32(1)

    def __init__(self, model: Model, lanes: int):
        row = np.arange(lanes)
        self.bases = np.arange(2 * lanes) * (SLOTS + APART)
        self.memory = np.full(2 * lanes * (SLOTS + APART), EMPTY, np.uint32)
        self.row = row * (STATES + APART)
        self.weights = np.tile(np.pad(model.weights, (0, APART)), lanes)
        self.own = np.full(lanes, SHARE0 >> 2)  # the part of order 0 that the block's own counts get, of 65536

    def narrow(self, lanes: int) -> None:
        """Go on with so many lanes."""
        if lanes < len(self.row):
            self.bases = np.concatenate([self.bases[:lanes], self.bases[len(self.row):][:lanes]])
            self.row, self.own = self.row[:lanes], self.own[:lanes]

    def places(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in memory, marks that tell contexts there apart) of contexts."""
        return (contexts & SLOTS - 1) + self.bases, ((contexts & -SLOTS) << 8).astype(np.uint32)

    def look(self, at: np.ndarray, marks: np.ndarray, counted: np.ndarray) -> None:
        """Take the guesses of orders 2 and 1 for the next id, and their weights: the block's own guess after a context that
        it has had, else the one counted over the segment."""
        self.at, self.marks = at, marks
        found = self.memory.take(at, mode="clip")
        np.bitwise_xor(found, marks, out=found)
        np.putmask(found, found >= GUESS, counted)
        self.guess, self.ids, self.sure = found, found >> 3, found & SURE
        self.state = _state(self.sure, self.ids)
        self.state += self.row
        self.weight = self.weights.take(self.state, mode="clip")

    def learn(self, now: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Take in the ids that came, and the guesses of them that a block begins with; both once for each order. Returns whether
        each order was right."""
        right = self.ids == now
        hits, m = right.astype(np.uint32), len(self.row)
        entry = hits << 1
        entry -= self.ONE
        entry += self.guess  # more sure by 1 where right, else less
        np.minimum(entry, self.guess | SURE, out=entry)
        np.putmask(entry, right < (self.sure < 2), new)
        entry ^= self.marks
        self.memory[self.at] = entry
        fade = self.weight >> RATE
        fade &= self.FADE
        np.subtract(self.weight, fade, out=fade)
        # A right order 1 counts where order 2 is wrong.
        fade += np.maximum(hits[:m] * self.STEP, hits[m:] * self.STEP << 16 & hits[:m] - self.ONE)
        self.weights[self.state] = fade
        return right

    def shares(self, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(w2, w2 + w1 in units; shares of the block's counts, of `n` ids, and of the segment's, in 65536 units)."""
        w2 = (weight & 0xFFFF).astype(np.int64)
        most = w2 + (weight >> 16) >> 8
        rest, both = 256 - most, most << 16
        own = 1 + ((rest - 2) * self.own >> 16) if n else np.zeros_like(rest)
        return np.minimum(w2 << 8, both), both, own, rest - own

    def weigh(self, used: np.ndarray, own: np.ndarray) -> None:
        """Adapt the block's counts' part of order 0 to how often, of `used` times, they were what gave the id."""
        self.own = self.own + ((own << 16) - used * self.own >> RATE)


def _turned(rows: np.ndarray) -> np.ndarray:
    """Rows as columns; some at a time, as lines of the processor's cache are then read once."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for a in range(0, len(rows), 32):
        out[:, a:a + 32] = rows[a:a + 32].T
    return out


def _own_counts(blocks: np.ndarray) -> np.ndarray:
    """By step and lane: how many ids of a block, when its counts were last brought up to date, were at lesser places than the
    step's and, in the upper 16 bits, at the same place."""
    lanes, steps = blocks.shape
    out = np.zeros((steps, lanes), np.uint32)
    if steps <= OWN[0]:
        return out
    for a in range(0, lanes, 64):
        rows = blocks[a:a + 64]
        keys = np.sort(rows.astype(np.uint32) << 16 | np.arange(steps, dtype=np.uint32), axis=1)
        order = (keys & 0xFFFF).astype(np.int64)
        keys >>= 16
        first = np.ones(rows.shape, bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        edges = np.append(np.flatnonzero(first), rows.size)
        sizes = np.diff(edges)
        before = np.arange(len(rows))[:, None]
        at = (order + before * steps).ravel()
        begin, end = np.empty(rows.shape, np.int32), np.empty(rows.shape, np.int32)
        begin.ravel()[at], end.ravel()[at] = np.repeat(edges[:-1], sizes), np.repeat(edges[1:], sizes)
        order = order.astype(np.int16)
        upto = np.zeros(rows.size + 1, np.int32)
        for n, stop in zip(OWN, [*OWN[1:], steps], strict=True):
            if n < steps:
                np.cumsum(order.ravel() < n, out=upto[1:])
                less, most = upto.take(begin[:, n:stop]), upto.take(end[:, n:stop])
                out[n:stop, a:a + 64] = (less - before * n | most - less << 16).T
    return out


def _own_table(history: np.ndarray) -> np.ndarray:
    """Blocks' earlier ids (by step and lane) in order, block by block: the place, the number of ids at lesser places
    and at the same, side by side as in `held0`."""
    n, lanes = history.shape
    out = np.empty(lanes * n, np.int64)
    for a in range(0, lanes, 256):
        held = np.sort(history[:, a:a + 256].T, axis=1, kind="stable")
        first = np.ones(held.shape, bool)
        first[:, 1:] = held[:, 1:] != held[:, :-1]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, held.size))
        out[a * n:a * n + held.size] = np.repeat(held.ravel()[starts].astype(np.int64) | starts % n << 16 | sizes << 32, sizes)
    return out


def _rounds(lanes: int, steps: int, last: int) -> Iterator[tuple[int, int, int, int]]:
    """(from step, to step, lanes, ids in the blocks' own counts); the last block may be shorter than the others."""
    for begin, end, m in [(0, last, lanes), (last, steps, lanes - 1)] if lanes > 1 else [(0, last, 1)]:
        while begin < end:
            stop = min(end, (begin // STEPS + 1) * STEPS)
            yield begin, stop, m, max((n for n in OWN if n <= begin), default=0)
            begin = stop


def _id_parts(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of the parts in which the bits of an escaped id are coded."""
    return [(16, bits - 16), (0, 16)] if bits > 16 else [(0, bits)]


class Words:
    """The range coder's words of every lane: 48-bit range, 16-bit words, of which one may get a carry as a 17th bit until the end."""

    def __init__(self, lanes: int, room: int):
        self.low, self.span = np.zeros(lanes, np.int64), np.full(lanes, (1 << 48) - 1)
        self.first = np.arange(lanes) * room
        self.at, self.words = self.first.copy(), np.zeros(lanes * room, np.uint32)

    def shift(self, short: np.ndarray) -> None:
        """Put out words of the lanes, some of those whose range has become short."""
        while len(short):
            some, places = self.low[short], self.at[short]
            self.words[places] = some >> 32
            self.at[short] = places + 1
            self.low[short] = (some & 0xFFFFFFFF) << 16
            wide = self.span[short] << 16
            self.span[short] = wide
            short = short[wide < 1 << 32]

    def plain(self, lanes: np.ndarray, ids: np.ndarray, id_bits: int) -> None:
        """Code the bits of ids that the model does not know."""
        for lowest, bits in _id_parts(id_bits):
            unit = self.span[lanes] >> bits
            self.low[lanes] += unit * (ids >> lowest & (1 << bits) - 1)
            self.span[lanes] = unit
            self.shift(lanes[unit < 1 << 32])

    def close(self) -> list[bytes]:
        for shift in (32, 16, 0):
            self.words[self.at] = self.low >> shift & (0xFFFF if shift < 32 else -1)
            self.at += 1
        used = self.at - self.first
        words = self.words.reshape(len(used), -1)[:, :int(used.max())]
        carry = words >> 16
        while carry.any():
            words &= 0xFFFF
            words[:, :-1] += carry[:, 1:]
            carry = words >> 16
        words = words.astype("<u2")
        return [words[i, :n].tobytes() for i, n in enumerate(used.tolist())]


def encode_blocks(blocks: np.ndarray, guesses: np.ndarray, rare: np.ndarray, last: int, model: Model) -> list[bytes]:
    """Range-coded words of blocks (rows of places), of which the last has `last` ids.

    `guesses` are those of order 2 and order 1 over the segment, each as rows; `rare` the ids at escapes, block by block.
    """
    lanes, steps = blocks.shape
    own = _own_counts(blocks)
    lane, step = (blocks == len(model.table)).nonzero()
    lane, step = lane[:len(rare)], step[:len(rare)]  # the rest is behind the end of the last block
    order = np.argsort(step, kind="stable")
    escaped, escapes = lane[order], rare[order].astype(np.int64)
    upto = np.searchsorted(step[order], np.arange(steps + 1))
    coder = Words(lanes, 2 * steps + 8 + 2 * int(np.bincount(lane, minlength=1).max()))
    columns, counted2, counted1 = _turned(blocks), _turned(guesses[0]), _turned(guesses[1])
    mixture = Mixture(model, lanes)
    for begin, end, m, n in _rounds(lanes, steps, last):
        mixture.narrow(m)
        past = np.zeros((end - begin + 2, m), np.int64)
        past[2 - min(begin, 2):] = columns[max(0, begin - 2):end, :m]
        now, one = past[2:], past[1:-1]
        at, marks = mixture.places(np.concatenate([(past[:-2] * MIX ^ one) & (1 << model.bits) - 1, one], 1))
        counted = np.concatenate([counted2[begin:end, :m], counted1[begin:end, :m]], 1)
        came = np.tile(now.astype(np.uint32), 2)
        new = came << 3 | 1
        right, weight = np.empty(came.shape, bool), np.empty(now.shape, np.uint32)
        for i in range(len(now)):
            mixture.look(at[i], marks[i], counted[i])
            weight[i] = mixture.weight
            right[i] = mixture.learn(came[i], new[i])
        w2, both, mine, rest = mixture.shares(weight, n)
        start, size = both + (mine << 16) + model.start0.take(now) * rest, model.f0.take(now) * rest
        is2, is1 = right[:, :m] & (w2 > 0), right[:, m:] & (both > w2)
        if n:
            unit = mine * (SHARE0 // n)
            counts = own[begin:end, :m].astype(np.int64)
            mass = (counts >> 16) * unit
            better = mass > size
            np.copyto(start, both + (counts & 0xFFFF) * unit, where=better)
            np.copyto(size, mass, where=better)
            used = ~(is2 | is1)
            mixture.weigh(used.sum(0), (used & better).sum(0))
        start, size = np.where(is1, w2, start), np.where(is1, both - w2, size)
        start, size = np.where(is2, 0, start), np.where(is2, w2, size)
        low, span = coder.low[:m], coder.span[:m]
        for i in range(len(now)):
            unit = span >> SCALE
            low += unit * start[i]
            np.multiply(unit, size[i], out=span)
            coder.shift((span < 1 << 32).nonzero()[0])
            a, b = upto[begin + i], upto[begin + i + 1]
            if b > a:
                coder.plain(escaped[a:b], escapes[a:b], model.id_bits)
    return coder.close()


def decode_blocks(payloads: list[bytes], steps: int, last: int, model: Model) -> np.ndarray:
    """The blocks (rows of ids) of `steps` ids behind the words; the last has `last` ids.

    A broken payload may point beyond the ids and is found by its checksum.
    """
    lanes, escape = len(payloads), len(model.table)
    lengths = np.array([len(p) // 2 for p in payloads])
    words = np.frombuffer(b"".join([*payloads, bytes(16 * steps + 64)]), "<u2").astype(np.int64)
    at = np.cumsum(lengths) - lengths
    code = words[at] << 32 | words[at + 1] << 16 | words[at + 2]
    at += 3
    span = np.full(lanes, (1 << 48) - 1)

    def shift(short: np.ndarray) -> None:
        while len(short):
            places = at[short]
            code[short] = (code[short] << 16 | words.take(places, mode="clip")) & (1 << 48) - 1
            at[short] = places + 1
            wide = span[short] << 16
            span[short] = wide
            short = short[wide < 1 << 32]

    mixture, counted_to, table = Mixture(model, lanes), 0, model.held0
    out, plain = np.zeros((steps, lanes), np.uint16), []
    none = np.zeros(lanes, np.int64)
    for begin, end, m, n in _rounds(lanes, steps, last):
        code_, span_ = code[:m], span[:m]
        mixture.narrow(m)
        if n > counted_to:
            counted_to, table = n, np.concatenate([model.held0, _own_table(out[:n, :m])])
        one = out[begin - 1, :m].astype(np.int64) if begin else none[:m]
        mixed = out[begin - 2, :m].astype(np.int64) * MIX if begin > 1 else none[:m]
        context, counted, came = np.empty(2 * m, np.int64), np.empty(2 * m, np.uint32), np.empty(2 * m, np.uint32)
        rows, foretold, of_own = SHARE0 + np.arange(m) * n, np.empty((end - begin, m), bool), np.empty((end - begin, m), bool)
        for step in range(begin, end):
            context[:m], context[m:] = (mixed ^ one) & (1 << model.bits) - 1, one
            model.two.take(context[:m], out=counted[:m], mode="clip")
            model.one.take(context[m:], out=counted[m:], mode="clip")
            mixture.look(*mixture.places(context), counted)
            w2, both, mine, rest = mixture.shares(mixture.weight, n)
            unit = span_ >> SCALE
            slot = (code_ / unit).astype(np.int64)  # exact: both are below 2**53, the quotient below 2**24
            is1, is2, from0 = slot < both, slot < w2, both
            if n:
                from0 = both + (mine << 16)
                own = slot < from0
                foretold[step - begin], of_own[step - begin] = is1, own
                from0, rest = np.where(own, both, from0), np.where(own, mine * (SHARE0 // n), rest)
                place = ((slot - from0) / rest).astype(np.int64) + own * rows
            else:
                place = ((slot - from0) / rest).astype(np.int64)
            held = table.take(place, mode="clip")
            start, size = from0 + (held >> 16 & 0xFFFF) * rest, (held >> 32) * rest
            now = np.where(is1, np.where(is2, mixture.ids[:m], mixture.ids[m:]), held & 0xFFFF)
            low = np.where(is2, 0, w2)
            start, size = np.where(is1, low, start), np.where(is1, np.where(is2, w2, both) - low, size)
            code_ -= unit * start
            np.multiply(unit, size, out=span_)
            shift((span_ < 1 << 32).nonzero()[0])
            out[step, :m] = now
            some = (now == escape).nonzero()[0]
            if len(some):
                ids = np.zeros(len(some), np.int64)
                for lowest, bits in _id_parts(model.id_bits):
                    unit = span[some] >> bits
                    part = np.minimum(code[some] // unit, (1 << bits) - 1)
                    code[some] -= part * unit
                    span[some] = unit
                    shift(some[unit < 1 << 32])
                    ids |= part << lowest
                plain.append((some, step, ids))
            came[:m] = came[m:] = now
            mixture.learn(came, came << 3 | 1)
            mixed, one = one * MIX, now
        if n:
            mixture.weigh((~foretold).sum(0), (of_own & ~foretold).sum(0))
    ids = np.append(model.table, np.uint32(0)).take(np.minimum(out.T, escape))
    for some, step, found in plain:
        ids[some, step] = found
    return ids


def encode_segment(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Documents' ids in a row, and the number of ids of each, in the file format."""
    ids = np.ascontiguousarray(ids, "<u4")
    model, at, guesses = Model.fit(ids)
    n = -(-len(ids) // BLOCK)
    payloads = []
    for first in range(0, n, LANES):
        here = slice(first * BLOCK, (first + LANES) * BLOCK)
        size = len(at[here])
        lanes = -(-size // BLOCK)
        steps = min(BLOCK, size)
        blocks, before = np.zeros(lanes * steps, at.dtype), np.zeros((2, lanes * steps), guesses.dtype)
        blocks[:size], before[:, :size] = at[here], guesses[:, here]
        payloads += encode_blocks(blocks.reshape(lanes, steps), before.reshape(2, lanes, steps),
                                  ids[here][at[here] == len(model.table)], size - (lanes - 1) * BLOCK, model)
    table = b"".join(
        struct.pack("<2I", len(p), zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK].tobytes())) for i, p in enumerate(payloads))
    packed = model.pack()
    head = HEADER.pack(MAGIC, 3, len(counts), BLOCK, n, len(packed))
    return b"".join([head, np.asarray(counts, "<u4").tobytes(), table, packed, *payloads])


def decode_segment(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of a segment; raises if it is not in the format or a block fails its checksum."""
    magic, version, documents, block, n, model_bytes = HEADER.unpack_from(segment)
    if magic != MAGIC or version != 3:
        raise ValueError("not a segment of token ids")
    at = HEADER.size
    counts = np.frombuffer(segment, "<u4", documents, at).astype(np.int64)
    at += 4 * documents
    table = np.frombuffer(segment, "<u4", 2 * n, at).reshape(n, 2).astype(np.int64)
    at += 8 * n
    model = Model.unpack(segment[at:at + model_bytes])
    ends = at + model_bytes + np.cumsum(table[:, 0])
    payloads = [segment[a:b] for a, b in zip((ends - table[:, 0]).tolist(), ends.tolist(), strict=True)]
    total, parts = int(counts.sum()), []
    for first in range(0, n, LANES):
        some = payloads[first:first + LANES]
        size = min(total - first * block, len(some) * block)
        blocks = decode_blocks(some, min(block, size), size - (len(some) - 1) * block, model)
        parts.append(blocks.ravel()[:size])
    ids = np.concatenate([np.empty(0, np.uint32), *parts])
    for i in range(n):
        if zlib.crc32(ids[i * block:(i + 1) * block].astype("<u4").tobytes()) != table[i, 1]:
            raise ValueError(f"block {i} fails its checksum")
    return ids, counts


# ---- files ----

SEGMENT_IDS = 2560 * BLOCK
"""A segment is closed when it has so many ids; documents are never cut, so a longer one has a segment of its own."""


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, names, counts, ids, n = TaskContext.get().partitionId(), [], [], [], 0
    segment, at = 0, 0

    def close() -> pa.RecordBatch:
        row = encode_segment(np.concatenate(ids), np.concatenate(counts))
        keys = pa.concat_arrays(names)
        lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([at], pa.int64()),
             pa.array([n], pa.int64()), lists, pa.array([row], pa.binary())],
            ["part", "segment", "start", "n", "keys", "data"])

    for whole in batches:
        for batch in slices(whole, "text"):
            found, sizes = encoder(path).encode(batch["text"])
            ends = np.cumsum(sizes + 1)
            stream = np.full(int(ends[-1]), end_id, np.uint32)
            body = np.ones(len(stream), bool)
            body[ends - 1] = False
            stream[body] = found
            names.append(batch["id"])
            counts.append(sizes + 1)
            ids.append(stream)
            n += len(stream)
            if n >= SEGMENT_IDS:
                yield close()
                segment, at = segment + 1, at + n
                names, counts, ids, n = [], [], [], 0
    if n:
        yield close()


def write_files(df: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode every whole text (null: empty), append `end_id`, and write the ids in key order (null first) under `path`.

    Texts are dealt out by key ranges; each task writes one file of segments. Spark commits whole files only,
    so a task that is run again leaves no trace.
    """
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text"))
    dealt = rows.repartitionByRange(width(df), "id").sortWithinPartitions("id")
    map_arrow(dealt, lambda batches: _segments(batches, tokenizer, end_id), (
        f"part int, segment int, start long, n long, keys array<{df.schema[key].dataType.simpleString()}>, data binary"
    )).write.option("compression", "uncompressed").parquet(path)


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, counts = decode_segment(batch["data"][i].as_py())
            ends = np.cumsum(counts)
            raw = ids.astype("<u4").tobytes()
            rows = [raw[4 * (e - c):4 * e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            starts = batch["at"][i].as_py() + ends - counts
            columns = [batch["keys"][i].values, pa.array(starts), pa.array(counts),
                       pa.array([zlib.crc32(r) for r in rows], pa.int64())]
            names = ["id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(rows, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def read_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) per document of the files under `path`, in no set order.

    `start` counts the ids of all documents before: starts within a part are in the files, and the parts'
    totals, one row each, are summed up. Every block is decoded and held against its checksum.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n").alias("total"))
    starts = running_starts(totals, "part", "total", [], "before").select("part", "before")
    placed = files.join(F.broadcast(starts), "part").select(
        (F.col("start") + F.col("before")).alias("at"), "keys", "data")
    kind = files.schema["keys"].dataType.elementType.simpleString()
    schema = f"id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return map_arrow(placed, lambda batches: _read(batches, with_ids), schema)


def round_trip(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Write the files to a new shared folder and read them back; see `write_files` and `read_files`."""
    path = new_dir(df.sparkSession, "token-files")
    write_files(df, path, tokenizer, key, text, end_id)
    return read_files(df.sparkSession, path).withColumnRenamed("id", key)
