"""Operator 9, language-model scoring by logistic context mixing.

A byte is coded as the bits of a Huffman code, root first; there is one code for each byte before, and for each of the ``PAIR_CODES`` most frequent pairs of bytes
before.  Five predictors give each bit's log-odds: tables of counts
under hashed contexts, which are the last one, two, three and four bytes and the word so far.  They and a bias are combined by weights of one of sixteen sets;
which one is a gate's choice, made from which of the three long contexts were met in training and from whether the bit is a byte's first.  Every bit refines
the weights of its set, from a text's first bit to its last; no text is cut.  The sum of bits, with one end symbol, gives the text's log10 probability,
and over its bytes the bits a byte.

Training counts over all training documents in two passes, first words and bytes, then the bits under each context, within each task first and then
in Spark.  The tables grow with the training bytes by the power 0.6, as distinct contexts do (Heaps), up to 32 million places (``CAPS``): that is what an executor
holds, 32 MB to score and 252 MB to count; beyond it more contexts share a place.  In scoring the texts of a batch are lanes, longest
first; one numpy step takes one bit of every lane that goes on, and blocks of lanes bound the memory; long texts are dealt to tasks of their own, so that
lanes are many there too.

Beside it the smoothed unigram score: token counts come from Spark over all training documents; the most frequent ``HEAD_WORDS`` go to executors
as sorted hash arrays, and tokens beyond them meet their counts in a shuffled join.  A token is known by a 64-bit polynomial hash.

Null text: empty, so only the end.  Null doc_id: a training document.  Repeated rows: each trains and is scored.  Empty table: no
rows.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
from math import exp, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, saved
from .words import SPACE, Powers, Words, slices

HEAD_WORDS = 1_000_000
FOLDS = 10
SMOOTHING = 0.1
END_BYTE = b"\xff"  # in no UTF-8 text
END_TOKEN = np.uint64(0x9E3779B97F4A7C15)

KINDS = 5
#: Bits of each context's number of rows less those that the corpus asks for, and at most; the first context has a row for each code.
SHIFTS, CAPS = (None, -4, -2, -1, 0), (None, 16, 17, 18, 19)
GROWTH = 0.6
#: Places between two rows; a row's nodes from there on, which are rare ones, share the next rows' places.
ROW, LONGEST_ROW = 32, 256
SETS, INPUTS = 16, 8
#: Inputs are log-odds in twelfths; at most so many make a sum.
SCALE, MOST = 12.0, 12.0
DOUBT, RATE = 0.3, 0.02
STEP = RATE / SCALE**2
FIRST_WEIGHTS = (0.0, 0.1, 0.25, 0.4, 0.4, 0.0, 0.0, 0.0)
PAIR_CODES = 512
BLOCK, LEAST_STEP, CHUNK = 1 << 17, 16, 1 << 15
#: Steps whose inputs are laid out at once, and whose costs make one logarithm.
TOGETHER = 32
#: Lanes up to which a loop over their bits is faster.
FEW = 8
#: Bytes beyond which a text is long, and bytes of long texts for one task: put together, they are lanes of like length.
LONG_TEXT, LONG_PART = 1 << 14, 1 << 25
FLUSH = 1 << 22
_ODD = np.uint32(0x9E3779B1)
_BASE = 0x01000193


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Contexts:
    """Numbers of the rows that each byte's contexts own.  The first context has a row for each code, counted for the last byte alone."""

    def __init__(self, total: int, codes: int = 256):
        asked = round(GROWTH * np.log2(total + 2))
        self.bits = [0] + [min(cap, max(8, asked + s)) for s, cap in zip(SHIFTS[1:], CAPS[1:], strict=True)]
        self.strides = [LONGEST_ROW] + [ROW] * (KINDS - 1)
        self.starts = np.cumsum([0, LONGEST_ROW * codes, *((ROW << b) + LONGEST_ROW for b in self.bits[1:])])
        self.size = int(self.starts[-1])
        self.powers = Powers(_BASE, np.uint32)

    def begins(self, rows: list[np.ndarray]) -> np.ndarray:
        """(bytes, contexts) where the rows of all but the first context begin in the table."""
        out = np.empty((len(rows[0]), KINDS - 1), np.int64)
        for k, own in enumerate(rows):
            np.add(own * ROW, self.starts[k + 1], out=out[:, k])
        return out

    def rows(self, b: np.ndarray, before: np.ndarray, begins: np.ndarray, carry: tuple[np.ndarray, np.ndarray]) -> tuple[list[np.ndarray], tuple]:
        """Rows (one array for each context but the first) of the bytes ``b`` of blocks that begin at ``begins``, and what the words at the blocks' ends carry on.

        ``before`` holds the four bytes before each byte, the latest in the low bits; ``carry`` the hash and the base's power of the word that
        each block goes on with.
        """
        word, carry = self.word_rows(b, before, begins, carry)
        return [*(self.byte_rows(before, j) for j in (2, 3, 4)), word], carry

    def word_rows(self, b: np.ndarray, before: np.ndarray, begins: np.ndarray, carry: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple]:
        """Rows of the word so far."""
        n = len(b)
        up, down = self.powers(n + 1)
        sums = np.zeros(n + 1, np.uint32)
        np.cumsum((b.astype(np.uint32) + np.uint32(1)) * up[:-1], dtype=np.uint32, out=sums[1:])
        starts = np.zeros(n + 1, np.int64)  # of the word that each byte, or a block's end, goes on with
        starts[1:] = np.where(SPACE[b], np.arange(1, n + 1), 0)
        at_end = starts[np.append(begins[1:], n)]
        starts[begins] = begins
        np.maximum.accumulate(starts, out=starts)
        ends = np.append(begins[1:], n)
        at_end = np.maximum(at_end, starts[ends - 1])
        hashed = (sums[:-1] - sums[starts[:-1]]) * down[starts[:-1]]
        tails = (sums[ends] - sums[at_end]) * down[at_end]
        powers = up[ends - at_end]
        first = at_end == begins
        tails = np.where(first, carry[0] + carry[1] * tails, tails)
        powers = np.where(first, carry[1] * powers, powers)
        if carry[0].any():
            inside = np.flatnonzero(starts[:-1] == np.repeat(begins, ends - begins))
            lane = np.searchsorted(begins, inside, side="right") - 1
            hashed[inside] = carry[0][lane] + carry[1][lane] * hashed[inside]
        hashed = hashed * np.uint32(257) + (before & np.uint32(0xFFFF))  # what a row counts belongs to one code
        word = ((hashed ^ (hashed >> np.uint32(15))) * _ODD) >> np.uint32(32 - self.bits[4])
        return word.astype(np.int64), (tails, powers)

    def byte_rows(self, before: np.ndarray, n: int) -> np.ndarray:
        """Rows of the last ``n`` bytes."""
        return ((before & np.uint32(0xFFFFFFFF >> (32 - 8 * n))) * _ODD >> np.uint32(32 - self.bits[n - 1])).astype(np.int64)


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, the four before each, and where texts begin; every text has four zeros before it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    wide = np.frombuffer(b"".join(texts), np.uint8)
    past = np.zeros(len(wide), np.uint32)
    for j in range(1, 5):
        past[j:] |= wide[:-j].astype(np.uint32) << np.uint32(8 * (j - 1))
    keep = np.ones(len(wide), bool)
    ends = np.cumsum(sizes)
    for j in range(4):
        keep[ends - sizes + j] = False
    return wide[keep], past[keep], ends - sizes - 4 * np.arange(len(texts))


def _fresh(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(n, np.uint32), np.ones(n, np.uint32)


class Code:
    """Huffman codes over the 256 byte values: inner nodes on each value's path and the bits taken there.  Nodes are numbered from the root, heavy ones first.

    ``of`` gives the number of the code by the two bytes before; a value under a code is a symbol.
    """

    def __init__(self, counts: np.ndarray, pairs: dict[int, np.ndarray]):
        """``counts`` (256, 256): how often a byte follows another; ``pairs``: how often bytes follow two.  Each code also knows bytes that never did."""
        every = counts.sum(axis=0)
        floor = every * 64 // max(1, int(every.sum())) + 1
        common = self._paths(every + 1)
        found = [self._paths(own * 256 + floor) if own.any() else common for own in [*counts, *pairs.values()]]
        self.of = np.arange(1 << 16) & 255
        self.of[list(pairs)] = 256 + np.arange(len(pairs))
        self.last = np.append(np.arange(256), np.array([p & 255 for p in pairs], np.int64))  # the byte before, of each code
        flat = [p for paths in found for p in paths]
        self.__setstate__((self.of, self.last, *(np.array(x, np.uint8) for x in ([len(p) for p in flat], [node for p in flat for node, _ in p], [bit for p in flat for _, bit in p]))))

    def __getstate__(self) -> tuple:
        return self.of.astype(np.int16), self.last, self.lengths.astype(np.uint8), self.nodes.astype(np.uint8), self.bits.astype(np.uint8)

    def __setstate__(self, state: tuple) -> None:
        self.of, self.last = (x.astype(np.int64) for x in state[:2])
        self.lengths, self.nodes, self.bits = state[2].astype(np.int64), state[3].astype(np.int32), state[4].astype(np.int8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def symbols(self, before: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.of[before & 0xFFFF] << 8) | b

    def first_odds(self, counts: np.ndarray) -> np.ndarray:
        """The first context's part of the table: what follows the last byte, at the nodes of every code."""
        at = np.repeat(np.arange(len(self.lengths)) >> 8, self.lengths) * LONGEST_ROW + self.nodes
        times = np.repeat(counts[self.last].ravel(), self.lengths)
        return log_odds(*(np.bincount(at, times * (self.bits == bit), LONGEST_ROW * len(self.last)) for bit in (0, 1)))

    @staticmethod
    def _paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
        heap = [(int(n), i, i) for i, n in enumerate(counts)]
        heapq.heapify(heap)
        kids: list[tuple[int, int]] = []
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            kids.append((a[2], b[2]))
            heapq.heappush(heap, (a[0] + b[0], 256 + len(kids) - 1, 256 + len(kids) - 1))
        paths: list = [None] * 256
        stack: list[tuple[int, list[tuple[int, int]]]] = [(510, [])]
        while stack:
            node, path = stack.pop()
            if node < 256:
                paths[node] = path
            else:
                for bit in (0, 1):
                    stack.append((kids[node - 256][bit], [*path, (510 - node, bit)]))
        return paths

    def spread(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every bit of the symbols: which one it belongs to, and its place in the codes' paths."""
        lengths = self.lengths[symbols]
        owner = np.repeat(np.arange(len(symbols)), lengths)
        path = np.arange(len(owner)) + np.repeat(self.starts[symbols] - (np.cumsum(lengths) - lengths), lengths)
        return owner, path


def log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Twelfths of log-odds as int8; 0 is kept for what was never met."""
    n0, n1 = n0.astype(np.float64), n1.astype(np.float64)
    odds = np.log((n1 + 0.1) / (n0 + 0.1)) * ((n1 + n0) / (n1 + n0 + DOUBT))
    out = np.clip(np.rint(odds * SCALE), -127, 127)
    return np.where((out == 0) & (n0 + n1 > 0), 1, out).astype(np.int8)


class Mixer:
    """The trained table and the code; inputs are negated for bits that are 1."""

    def __init__(self, contexts: Contexts, code: Code, table: np.ndarray):
        self.__setstate__((contexts, code, table))

    def __getstate__(self) -> tuple:
        return self.contexts, self.code, self.table

    def __setstate__(self, state: tuple) -> None:
        self.contexts, self.code, self.table = state
        code, table = self.code, self.table
        # What a path's place alone tells: the first context's input, and the bias.
        owner = np.repeat(np.arange(len(code.lengths)) >> 8, code.lengths)
        known = np.zeros((len(owner), INPUTS), np.int8)
        known[:, 0] = table[owner * LONGEST_ROW + code.nodes]
        known[:, KINDS] = SCALE
        known[code.bits != 0] *= np.int8(-1)
        self.known = known.view(np.int64).ravel()
        self.wide = np.repeat(np.arange(LONGEST_ROW), KINDS - 1).view(f"V{8 * (KINDS - 1)}")  # each node for the contexts that are looked up

    def inputs(self, symbols: np.ndarray, begins: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every bit: the eight inputs, negated where the bit is 1; the number of its set of weights, after ``sets`` of its byte; and bits up to each byte."""
        owner, path = self.code.spread(symbols)
        packed = self.known.take(path)
        at = begins.view(self.wide.dtype).ravel().take(owner).view(np.int64)
        at += self.wide.take(self.code.nodes.take(path)).view(np.int64)
        found = self.table.take(at)
        ones = (packed << (8 * (INPUTS - 1 - KINDS)) >> 63).astype(np.int32).view(np.int8)  # the bias is negative: -1 for each context
        found ^= ones
        found -= ones
        packed |= found.view(np.uint32).astype(np.int64) << 8
        upto = np.append(0, np.cumsum(self.code.lengths[symbols]))
        # A context was met if it knows the root, which is a byte's first bit.
        firsts = upto[:-1]
        roots = packed.take(firsts)
        own = sets.astype(np.int32)
        for j in range(2, KINDS):
            own += (roots & (0xFF << 8 * j) != 0).view(np.int8) << np.int8(j - 2)
        gate = own.take(owner)
        gate[firsts] = own + 8
        return packed.view(np.int8).reshape(-1, INPUTS), gate, upto

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text with its end; equal texts are mixed once."""
        numbers = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        raws = [b"\0\0\0\0" + t + END_BYTE for t in sorted(numbers, key=len, reverse=True)]
        sizes = np.array([len(x) - 4 for x in raws], np.int64)
        lanes = len(raws)
        weights = np.tile(np.array(FIRST_WEIGHTS, np.float32) / np.float32(SCALE), (lanes * SETS, 1))
        cost, carry, at = np.zeros(lanes), _fresh(lanes), 0
        while lanes := int(np.searchsorted(-sizes, -at, side="left")):
            step = max(LEAST_STEP, (BLOCK if lanes > FEW else BLOCK // 8) // lanes)
            own = [x[at : at + step + 4] for x in raws[:lanes]]
            b, before, begins = _flat(own)
            rows, carry = self.contexts.rows(b, before, begins, (carry[0][:lanes], carry[1][:lanes]))
            counts = np.diff(np.append(begins, len(b)))
            packed, sets, upto = self.inputs(self.code.symbols(before, b), self.contexts.begins(rows), np.repeat(np.arange(lanes) * SETS, counts))
            mix = _mix if lanes > FEW else _mix_few
            cost[:lanes] += mix(packed, sets, upto[begins], upto[begins + counts], weights)
            at += step
        found = dict(zip((x[4:-1] for x in raws), cost.tolist(), strict=True))
        return np.array([found[t] for t in texts])


def _mix(packed: np.ndarray, sets: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bits that each lane costs: its inputs are ``packed[begin:end]``; the weights, of inputs in twelfths of log-odds, are refined in place."""
    lengths = end - begin
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = begin[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    lanes, upto = len(order), np.append(0, np.cumsum(active))
    # Bits by step: all lanes' first ones, then all second ones.
    place = begin.take(np.arange(upto[-1]) - np.repeat(upto[:-1], active))
    place += np.repeat(np.arange(len(active)), active)
    cost, seen = np.zeros(lanes), np.ones((TOGETHER, lanes), np.float32)
    rows, bits = weights.view("V32").ravel(), packed.view(np.int64).ravel()
    z, ones, step = np.empty(lanes, np.float32), np.ones(INPUTS, np.float32), np.full((1, INPUTS), STEP, np.float32)
    w, products = (np.empty((lanes, INPUTS), np.float32) for _ in range(2))
    most, one, n = np.full(lanes, MOST, np.float32), np.ones(lanes, np.float32), -1  # whole arrays: quicker than numbers
    take_row, put_row, times, dot, least, exp_, plus, over, less = rows.take, rows.put, np.multiply, np.dot, np.minimum, np.exp, np.add, np.divide, np.subtract
    for first in range(0, len(active), TOGETHER):
        ends = upto[first : first + TOGETHER + 1]
        own = place[ends[0] : ends[-1]]
        inputs, chosen = bits.take(own).view(np.int8).reshape(-1, INPUTS).astype(np.float32), sets.take(own).astype(np.int64)
        lo = 0
        for k, still in enumerate(active[first : first + TOGETHER].tolist()):
            if still != n:
                n = still
                ownw, ownp, ownz, ownm, own1 = w[:n], products[:n], z[:n], most[:n], one[:n]
                roww, narrow = ownw.view("V32").ravel(), ownz[:, None]
            hi = lo + n
            x, rows_of = inputs[lo:hi], chosen[lo:hi]
            take_row(rows_of, out=roww, mode="clip")
            times(ownw, x, ownp)
            dot(ownp, ones, ownz)
            least(ownz, ownm, ownz)
            exp_(ownz, ownz)  # (1 - p) / p
            over_p = plus(ownz, own1, seen[k, :n])
            over(ownz, over_p, ownz)
            dot(narrow, step, ownp)
            times(ownp, x, ownp)
            less(ownw, ownp, ownw)
            put_row(rows_of, roww)
            lo = hi
        cost += np.log2(np.multiply.reduce(seen, axis=0, dtype=np.float64))
        seen.fill(1.0)
    out = np.empty(lanes)
    out[order] = cost
    return out


def _mix_few(packed: np.ndarray, sets: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The same for so few lanes that a loop over their bits is faster."""
    out = np.zeros(len(begin))
    for lane, (lo, hi) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        rows = weights[lane * SETS : (lane + 1) * SETS].astype(np.float64).tolist()
        product, bits = 1.0, 0.0
        for k, (a, b, c, d, e, f, _, _) in zip((sets[lo:hi] - lane * SETS).tolist(), packed[lo:hi].tolist(), strict=True):
            w = rows[k]
            z = w[0] * a + w[1] * b + w[2] * c + w[3] * d + w[4] * e + w[5] * f
            u = exp(z if z < MOST else MOST)
            product *= 1 + u
            if product > 1e200:
                bits += log2(product)
                product = 1.0
            u *= STEP / (1 + u)
            w[0] -= u * a
            w[1] -= u * b
            w[2] -= u * c
            w[3] -= u * d
            w[4] -= u * e
            w[5] -= u * f
        weights[lane * SETS : (lane + 1) * SETS] = rows
        out[lane] = bits + log2(product)
    return out


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how often each occurs."""
    keys.sort()
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[head], np.diff(np.append(head, len(keys))).astype(np.int32)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _values(column) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.binary())]


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("string"))


def count_words(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over all training rows: kind 0 counts tokens by hash, kind 1 bytes with the two before them, kind 2 bytes of long texts."""

    def rows(kind, keys, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n)], names=["kind", "key", "n"])

    def run(batches):
        hashed, held, met, ends, long, words = [], 0, [], 0, 0, Words()

        def flush():
            keys, n = np.unique(np.concatenate(hashed), return_counts=True)
            return rows(0, keys.view(np.int64), n.astype(np.int64))

        for batch in batches:
            texts = _values(batch.column(0))
            ends += len(texts)
            long += sum(len(t) for t in texts if len(t) > LONG_TEXT)
            for lo, hi in slices(texts):
                own, _ = words(texts[lo:hi])
                b, before, _ = _flat([b"\0\0\0\0" + t + END_BYTE for t in texts[lo:hi]])
                met.append(_counted((before & np.uint32(0xFFFF)) << np.uint32(8) | b))
                if len(met) > 16:
                    met = [_summed(met)]
                hashed.append(own)
                held += len(own)
                if held >= FLUSH:
                    yield flush()
                    hashed, held = [], 0
        if held:
            yield flush()
        if ends:
            yield rows(0, np.array([END_TOKEN]).view(np.int64), np.array([ends]))
            keys, n = _summed(met)
            yield rows(1, keys.astype(np.int64), n)
            yield rows(2, np.zeros(1, np.int64), np.array([long]))

    return _training(docs).mapInArrow(run, "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def count_bits(docs: DataFrame, contexts: Contexts, code: Code) -> DataFrame:
    """(chunk, odds): the log-odds of ``CHUNK`` places at a time, from the counts of all training rows."""
    shared = docs.sparkSession.sparkContext.broadcast((contexts, code))

    def counted(batches):
        contexts, code = shared.value
        counts = np.zeros(2 * contexts.size, np.int32)  # of zeros and ones at each place

        def add(symbols, times, rows):
            """``times`` for every bit of the symbols, under each context's row."""
            owner, path = code.spread(symbols)
            place, times = 2 * code.nodes.take(path) + code.bits.take(path), times.take(owner)
            for k, own in rows:
                at = ((own * contexts.strides[k] + int(contexts.starts[k])) * 2).take(owner)
                at += place
                np.add.at(counts, at, times)

        for batch in batches:
            texts = _values(batch.column(0))
            for lo, hi in slices(texts, 1 << 21):
                b, before, begins = _flat([b"\0\0\0\0" + t + END_BYTE for t in texts[lo:hi]])
                word, _ = contexts.word_rows(b, before, begins, _fresh(len(begins)))
                word = word.astype(np.uint64) << np.uint64(24) | ((before & np.uint32(0xFFFF)) << np.uint32(8) | b)
                keys, times = _counted(before.astype(np.uint64) << np.uint64(8) | b)
                past = (keys >> np.uint64(8)).astype(np.uint32)
                add(code.symbols(past, (keys & np.uint64(0xFF)).astype(np.int64)), times, [(n - 1, contexts.byte_rows(past, n)) for n in (2, 3, 4)])
                keys, times = _counted(word)
                past = (keys >> np.uint64(8)).astype(np.uint32)
                add(code.symbols(past, (keys & np.uint64(0xFF)).astype(np.int64)), times, [(4, (keys >> np.uint64(24)).astype(np.int64))])
        pair = counts.reshape(-1, 2)
        for lo in range(0, contexts.size, CHUNK):
            own = pair[lo : lo + CHUNK]
            at = np.flatnonzero(own.any(axis=1))
            if len(at):
                kind = np.min_scalar_type(int(own.max()))
                blobs = [at.astype(np.uint16).tobytes(), *(own[at, j].astype(kind).tobytes() for j in (0, 1))]
                yield pa.RecordBatch.from_arrays([pa.array([lo // CHUNK], pa.int32()), pa.array([kind.itemsize], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=["chunk", "width", "at", "n0", "n1"])

    def merged(batches):
        chunk, sums = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([log_odds(sums[0], sums[1]).tobytes()], pa.binary())], names=["chunk", "odds"])

        for batch in batches:
            for own, width, at, *n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != chunk:
                    if chunk is not None:
                        yield done()
                    chunk, sums = own, np.zeros((2, CHUNK), np.int64)
                at = np.frombuffer(at, np.uint16)
                for j in (0, 1):
                    sums[j][at] += np.frombuffer(n[j], f"<u{width}")
        if chunk is not None:
            yield done()

    parts = _training(docs).mapInArrow(counted, "chunk int, width int, at binary, n0 binary, n1 binary")
    return parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merged, "chunk int, odds binary")


class Head:
    """The head's words by hash: sorted, with an index by their top bits."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int, floor: float):
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.worth = np.append(np.log10(counts[order] + SMOOTHING), np.log10(SMOOTHING)) - np.log10(floor)
        self.shift = np.uint64(64 - max(8, int(np.log2(len(keys) + 1))))
        self.index = np.searchsorted(keys[order], np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is; -1 for those of no word in the head."""
        at = self.index[(hashes >> self.shift).astype(np.int64)]
        out = np.full(len(hashes), -1)
        left = np.arange(len(hashes))
        while len(left):
            own, want = self.keys[at], hashes[left]
            out[left[own == want]] = at[own == want]
            more = (own < want) & (at < len(self.keys) - 1)
            left, at = left[more], at[more] + 1
        out[out == len(self.keys) - 1] = -1
        return out


def _code(triples: DataFrame) -> tuple[Code, np.ndarray, int]:
    """The code, how often a byte follows another, and the number of bytes."""
    last = np.zeros(1 << 16, np.int64)
    for r in triples.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key")).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows
        last[r["key"]] = r["n"]
    by_pair = triples.withColumn("pair", F.shiftright("key", 8))
    top = by_pair.groupBy("pair").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "pair").limit(PAIR_CODES)
    pairs: dict[int, np.ndarray] = {}
    for r in by_pair.join(F.broadcast(top), "pair").orderBy(F.desc("all"), "pair").collect():  # at most 256 for each of them
        pairs.setdefault(r["pair"], np.zeros(256, np.int64))[r["key"] & 255] = r["n"]
    return Code(last.reshape(256, 256), pairs), last.reshape(256, 256), int(last.sum())


def train(docs: DataFrame, head_words: int = HEAD_WORDS) -> tuple[dict, DataFrame | None]:
    """The model, of bounded size, and the counts of words beyond its head (None if the head has all)."""
    counts = saved(count_words(docs))
    words = counts.where("kind = 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tail = None
    if distinct > head_words:
        least = words.groupBy("n").count().orderBy(F.desc("n"))
        seen, bar = 0, 0
        for r in least.toLocalIterator():
            seen += r["count"]
            if seen > head_words:
                bar = r["n"]
                break
        tail = saved(words.where((F.col("n") <= bar) & (F.col("key") != int(END_TOKEN.view(np.int64)))).select("key", "n"))
        words = words.where((F.col("n") > bar) | (F.col("key") == int(END_TOKEN.view(np.int64))))
    head = words.select("key", "n").toArrow()
    code, last, n_bytes = _code(counts.where("kind = 1").select("key", "n"))
    long = counts.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    discard(counts)
    contexts = Contexts(n_bytes, len(code.last))
    table = np.zeros(-(-contexts.size // CHUNK) * CHUNK, np.int8)
    for r in count_bits(docs, contexts, code).toLocalIterator():  # 32 KB a row, and together no more than the table
        table[r["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(r["odds"], np.int8)
    table[: contexts.starts[1]] = code.first_odds(last)
    floor = total + SMOOTHING * (distinct + 1)
    return {"keys": head.column("key").to_numpy(), "n": head.column("n").to_numpy(), "total": total, "floor": floor, "long": long, "mixer": Mixer(contexts, code, table)}, tail


def score(docs: DataFrame, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row."""
    model, tail = train(docs, head_words)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    total, floor = model["total"], model["floor"]
    has_tail = tail is not None
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        head, words = Head(m["keys"], m["n"], m["total"], m["floor"]), Words()
        end, unknown = float(head.worth[head(np.array([END_TOKEN]))][0]), float(head.worth[-1])
        task, number = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            texts = _values(batch.column(2))
            n_tokens, n_known, base, rest, cuts = [], [], [], [], [np.zeros(1, np.int64)]
            for lo, hi in slices(texts):
                hashes, counts = words(texts[lo:hi])
                at = head(hashes)
                ends = np.append(0, np.cumsum(counts))
                known = np.append(0, np.cumsum(at >= 0))[ends]
                worth = np.where(at >= 0, head.worth[at], unknown)
                n_tokens.append(counts + 1)
                n_known.append(np.diff(known) + 1)
                base.append(np.array([worth[a:b].sum() + end for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]))
                if has_tail:
                    rest.append(hashes[at < 0].view(np.int64))
                    cuts.append(cuts[-1][-1] + np.cumsum(counts - np.diff(known)))
            bits = m["mixer"].text_bits(texts)
            join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            columns = [
                pa.array(range(task + number, task + number + len(texts)), pa.int64()), batch.column(0), batch.column(1),
                pa.array(join(n_tokens), pa.int64()), pa.array(join(n_known), pa.int64()), pa.array(join(base), pa.float64()), pa.array(-bits * np.log10(2)),
                pa.array(bits / np.array([len(t) + 1 for t in texts])),
                pa.ListArray.from_arrays(pa.array(join(cuts), pa.int32()), pa.array(join(rest), pa.int64())) if has_tail else pa.nulls(len(texts), pa.list_(pa.int64())),
            ]
            number += len(texts)
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits_per_byte", "rest"])

    schema = f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, bits_per_byte double, rest array<bigint>"
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    if model["long"]:
        is_long = F.coalesce(F.octet_length("text") > LONG_TEXT, F.lit(False))
        texts = texts.where(~is_long).union(texts.where(is_long).repartition(-(-model["long"] // LONG_PART)))
    rows = texts.mapInArrow(run, schema)
    if has_tail:
        rows = saved(rows)
        each = rows.select("row", F.explode("rest").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
        gain = each.join(tail, "key").groupBy("row").agg(
            F.sum("times").alias("more"), F.sum(F.col("times") * (F.log10(F.col("n") + SMOOTHING) - F.log10(F.lit(SMOOTHING)))).alias("gain")
        )
        rows = rows.join(gain, "row", "left").withColumn("n_known", F.col("n_known") + F.coalesce("more", F.lit(0))).withColumn("base_score", F.col("base_score") + F.coalesce("gain", F.lit(0.0)))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")
