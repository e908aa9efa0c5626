"""Adaptive context-mixing range coder for token ids, many blocks in lockstep.

A block carries its sorted distinct ids as its alphabet and codes places in it.
Three models predict each id:

* order 2: the id that last followed the two ids before it (a hashed table),
* order 1: the id that last followed the id before it,
* order 0: frequencies of all ids of the alphabet.

Each of the two higher orders counts for how long its prediction has held.
These two counts and whether both predict the same id choose a set of mixing
weights: the shares of order 2's id, of order 1's id and of order 0's
distribution.  Weights and order-0 frequencies are learned from the block's own
ids and refreshed at the positions ``REFRESH``; the predicted ids learn at every
position.  The mixture, an interval of ``1 << 2 * BITS`` parts, drives a range
coder with a 64-bit state and 32-bit output words.  Only integer arithmetic is
used, so any machine decodes what another encoded.  Every block starts afresh.

The encoder knows all ids, so it finds contexts and predictions of many blocks
by sorting, and only the coder's state goes position by position; the decoder
goes through all blocks of a call in lockstep, the longest first.
"""

from __future__ import annotations

import struct

import numpy as np

BITS = 12
TOTAL = 1 << BITS
#: Most ids of a block: the alphabet must fit in the order-0 total.
BLOCK_IDS = TOTAL
SLOTS = 1 << 12
REFRESH = (16, 56, 128, 256, 480, 896, 1664, 2752)
#: Weight of one occurrence against the start weight 1 of every id of the alphabet.
STEP = 4
_U, _V = np.uint64, np.uint32
_LEAST, _WORD = _U(1 << 32), _U(32)

# A context's entry is (1 + the place of the id that last followed) << 5 and the number of times in a row that it did, up
# to 3: at bit 3 in the table of order 2 and at bit 1 in that of order 1, so that both and a bit for agreement make a state.
HELD, STATES, _RUNS = 3, 32, 31
_BY_TWO, _BY_ONE = np.int32(128), np.int32(64)
_AGAIN = {at: np.array([*(min((d >> at) + 1, HELD) << at for d in range(32)), 1 << at], np.int32) for at in (1, 3)}


def _states() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each state: start weights of the three outcomes, and whether order 2 and order 1 can be an outcome."""
    state = np.arange(STATES)
    two, one, agree = state >> 3, state >> 1 & 3, state & 1
    start = np.stack(
        (np.array([0, 3, 14, 40])[two], np.where(agree, 0, np.array([0, 1, 4, 12])[one]), np.full(STATES, 16)), axis=1
    )
    return start, two > 0, (one > 0) & (agree == 0)


_START, _CAN_TWO, _CAN_ONE = _states()


def _weights(seen: np.ndarray) -> np.ndarray:
    """Ends of the shares of order 2's and of order 1's id, packed, from the outcomes (lanes, STATES, 3) seen."""
    weight = seen * 8 + _START
    total = weight.sum(axis=2)
    two = np.where(_CAN_TWO, 1 + weight[:, :, 0] * (TOTAL - 16) // total, 0)
    one = np.where(_CAN_ONE, 1 + weight[:, :, 1] * (TOTAL - 16) // total, 0)
    return (two | (two + one) << 16).astype(_V)


def _cumulative(seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cumulative order-0 frequencies (lanes, width + 1) from occurrences (lanes, width); TOTAL from a lane's alphabet on."""
    lanes, width = seen.shape
    alphabet = np.minimum(np.arange(width + 1, dtype=np.int32), sizes[:, None])
    upto = np.zeros((lanes, width + 1), np.int32)
    np.cumsum(seen, axis=1, out=upto[:, 1:])
    upto *= np.int32(STEP)
    upto += alphabet
    # upto * (TOTAL - sizes) // total by doubles: with the half a quotient is 1 / 2 / total, over 2**-16, from whole
    # numbers at least, and its error is below 2**-38 on any machine
    total = np.maximum(upto[:, -1:], 1).astype(np.float64)
    share = upto * ((TOTAL - sizes[:, None]) / total)
    share += 0.5 / total
    upto = share.astype(np.int32)
    upto += alphabet
    return upto


def _stops(most: int) -> list[int]:
    return [0, *(p for p in REFRESH if p < most), most]


def _entries(context: np.ndarray, symbol: np.ndarray, at: int) -> np.ndarray:
    """The table entry of each position's context before it, for positions in a row; symbol: 1 + place."""
    n = len(context)
    bits = max(n - 1, 1).bit_length()
    kind = _V if (int(context.max(initial=0)) + 1) << bits <= 1 << 32 else _U
    order = np.sort(context.astype(kind) << kind(bits) | np.arange(n, dtype=kind))
    context, order = order >> kind(bits), (order & kind((1 << bits) - 1)).astype(np.int64)
    own = symbol.take(order)
    known = context[1:] == context[:-1]
    fresh = np.ones(n, bool)
    fresh[1:] = ~(known & (own[1:] == own[:-1]))
    place = np.arange(n, dtype=np.int32)
    run = np.minimum(place - np.maximum.accumulate(place * fresh), HELD - 1)
    out = np.zeros(n, np.int32)
    out[order[1:]] = (own[:-1] << 5 | (run[:-1] + 1) << at) * known
    return out


def _intervals(ids: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and width of each position's interval; ids: places in the alphabet (lanes, most)."""
    lanes, most = ids.shape
    lane = np.arange(lanes, dtype=np.int32)[:, None]
    symbol = ids + np.int32(1)
    before, two = np.zeros_like(ids), np.zeros_like(ids)
    before[:, 1:], two[:, 2:] = symbol[:, :-1], symbol[:, :-2]
    first = _entries((lane * (int(sizes.max(initial=0)) + 1) + before).ravel(), symbol.ravel(), 1).reshape(lanes, most)
    second = _entries(
        (lane * SLOTS + ((before * 0x1B5 ^ two * 0x5A4D) & (SLOTS - 1))).ravel(), symbol.ravel(), 3
    ).reshape(lanes, most)
    state = (first | second) & _RUNS | (first ^ second < 32)
    hit_two, hit_one = second >> 5 == symbol, first >> 5 == symbol
    outcome = 2 - 2 * hit_two.view(np.int8) - (hit_one & ~hit_two).view(np.int8)
    start, width = np.empty((lanes, most), _V), np.empty((lanes, most), _V)
    seen, count = np.zeros((lanes, STATES, 3), np.int64), np.zeros((lanes, int(sizes.max(initial=1))), np.int32)
    inside = None if lanes and int(length[-1]) == most else np.arange(most) < length[:, None]
    stops = _stops(most)
    for a, b in zip(stops[:-1], stops[1:]):
        at = lane * STATES + state[:, a:b]
        ends = _weights(seen).take(at)
        end_two, end_one = ends & _V(0xFFFF), ends >> _V(16)
        upto = _cumulative(count, sizes)
        out, own = outcome[:, a:b], lane * (upto.shape[1]) + ids[:, a:b]
        low = upto.take(own).astype(_V)
        rest = _V(TOTAL) - end_one
        begin, size = (end_one << _V(BITS)) + rest * low, rest * (upto.take(own + 1).astype(_V) - low)
        hit = out < 2
        by_one = out[hit] == 1
        begin[hit] = (end_two[hit] << _V(BITS)) * by_one
        size[hit] = np.where(by_one, end_one[hit] - end_two[hit], end_two[hit]) << _V(BITS)
        start[:, a:b], width[:, a:b] = begin, size
        if b < most:
            at *= 3
            at += out
            own -= lane
            if inside is None:
                at, own = at.ravel(), own[out == 2]
            else:
                at, own = at[inside[:, a:b]], own[inside[:, a:b] & (out == 2)]
            seen += np.bincount(at, minlength=seen.size).reshape(seen.shape)
            count += np.bincount(own, minlength=count.size).reshape(count.shape).astype(np.int32)
    return start, width


def pack_alphabet(ids: np.ndarray) -> bytes:
    """Ascending distinct ids below 1 << 32: their last bits, and the others as unary steps."""
    n, top = len(ids), int(ids[-1]) if len(ids) else 0
    cut = max((top // max(n, 1)).bit_length() - 1, 0)
    high = np.zeros((top >> cut) + n + 1, bool)
    high[(ids >> cut) + np.arange(n)] = True
    low = (ids[:, None] >> np.arange(cut) & 1).astype(bool)
    return struct.pack("<HBI", n, cut, len(high)) + np.packbits(high).tobytes() + np.packbits(low.ravel()).tobytes()


def unpack_alphabet(raw: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The ids, and where their bytes end."""
    n, cut, long = struct.unpack_from("<HBI", raw, at)
    middle = at + 7 + -(-long // 8)
    end = middle + -(-n * cut // 8)
    if end > len(raw):
        raise ValueError("damaged alphabet of a block")
    high = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, middle - at - 7, at + 7), count=long))
    if len(high) != n:
        raise ValueError("damaged alphabet of a block")
    low = np.unpackbits(
        np.frombuffer(raw, np.uint8, end - middle, middle), count=n * cut
    ).reshape(n, cut).astype(np.int64)
    return (high - np.arange(n)) << cut | low @ (np.int64(1) << np.arange(cut)), end


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct ids, and the place of each id among them."""
    if len(ids) == 0 or int(ids.max()) >= 1 << 16:
        return np.unique(ids, return_inverse=True)
    order = np.sort(ids.astype(np.uint16), kind="stable")  # numpy sorts 16 bits by radix
    alphabet = order[np.concatenate(([True], order[1:] != order[:-1]))].astype(np.int64)
    place = np.empty(int(alphabet[-1]) + 1, np.int32)
    place[alphabet] = np.arange(len(alphabet))
    return alphabet, place.take(ids)


def encode(blocks: list[np.ndarray], lanes_at_once: int = 16) -> list[bytes]:
    """Each block of at most BLOCK_IDS ids (0 to 2**32 - 1) as bytes; ValueError for others."""
    for own in blocks:
        if len(own) > BLOCK_IDS or (len(own) and (int(own.min()) < 0 or int(own.max()) >= 1 << 32)):
            raise ValueError(f"a block holds at most {BLOCK_IDS} ids from 0 to 4294967295")
    lanes = len(blocks)
    order = sorted(range(lanes), key=lambda k: -len(blocks[k]))
    length = np.array([len(blocks[k]) for k in order], np.int64)
    most = int(length.max(initial=0))
    starts, widths = np.empty((most, lanes), _V), np.empty((most, lanes), _V)
    heads: list[bytes] = []
    for a in range(0, lanes, lanes_at_once):
        b = min(a + lanes_at_once, lanes)
        ids, sizes = np.zeros((b - a, most), np.int32), np.zeros(b - a, np.int32)
        for row in range(a, b):
            alphabet, place = _alphabet(blocks[order[row]])
            ids[row - a, : len(place)], sizes[row - a] = place, len(alphabet)
            heads.append(pack_alphabet(alphabet))
        start, width = _intervals(ids, length[a:b], sizes)
        starts[:, a:b], widths[:, a:b] = start.T, width.T
    low, span = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    room = most * 2 * BITS // 32 + 6  # a position takes 2 * BITS bits at most
    out = np.zeros((room, lanes), _U)  # carries are added to words and passed on at the end
    flat, used = out.ravel(), np.arange(lanes, dtype=np.int64) + lanes
    live, shift = np.searchsorted(-length, -np.arange(most), side="left").tolist(), _U(2 * BITS)
    for t, n in enumerate(live):
        part, own = span[:n], low[:n]
        part >>= shift
        move = starts[t, :n] * part
        own += move
        over = (own < move).nonzero()[0]
        if len(over):
            flat[used[over] - lanes] += _U(1)
        part *= widths[t, :n]
        go = (part < _LEAST).nonzero()[0]
        if len(go):
            at, value = used[go], own[go]
            flat[at] = value >> _WORD
            used[go] = at + lanes
            own[go] = value << _WORD
            part[go] <<= _WORD
    for down in (_WORD, _U(0)):
        flat[used] = low >> down & _U(0xFFFFFFFF)
        used += lanes
    for k in range(int(used.max(initial=0)) // max(lanes, 1), 0, -1):
        out[k - 1] += out[k] >> _WORD
    words, used = np.ascontiguousarray(out.astype("<u4").T), used // max(lanes, 1)
    done: list[bytes] = [b""] * lanes
    for row, k in enumerate(order):
        done[k] = heads[row] + words[row, 1 : used[row]].tobytes()
    return done


def decode(parts: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The blocks that ``encode`` was given."""
    lanes = len(parts)
    order = sorted(range(lanes), key=lambda k: -lengths[k])
    length = np.array([lengths[k] for k in order], np.int64)
    most = int(length.max(initial=0))
    alphabets, coded = [], []
    for k in order:
        alphabet, end = unpack_alphabet(parts[k])
        alphabets.append(alphabet)
        coded.append(np.frombuffer(parts[k], "<u4", (len(parts[k]) - end) // 4, end))
    sizes = np.array([len(x) for x in alphabets], np.int32)
    if most > BLOCK_IDS or (sizes > TOTAL).any() or (sizes < np.minimum(length, 1)).any():
        raise ValueError("damaged block of ids")
    width, room = int(sizes.max(initial=1)), max((len(x) for x in coded), default=0) + 2
    words = np.zeros((lanes, room), _V)
    for row, own in enumerate(coded):
        words[row, : len(own)] = own
    words = words.ravel()
    lane = np.arange(lanes, dtype=np.int64)
    read = lane * room + 2
    code, span = words[read - 2].astype(_U) << _WORD | words[read - 1], np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    one, two = np.zeros(lanes * (width + 1), np.int32), np.zeros(lanes * SLOTS, np.int32)
    base_one, base_two, base_state, base_table, base_place = lane * (width + 1), lane * SLOTS, lane * STATES, lane * TOTAL, lane * width
    seen, count = np.zeros((lanes, STATES, 3), np.int64), np.zeros((lanes, width), np.int32)
    ids, noted = np.zeros((most, lanes), np.int16), np.zeros((most, lanes), np.int8)
    before, last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    live = np.searchsorted(-length, -np.arange(most), side="left").tolist()
    last_word, stops, most_point = len(words) - 1, _stops(most), _U((1 << 2 * BITS) - 1)
    twelve, sixteen, low_half, total = _V(BITS), _V(16), _V(0xFFFF), _V(TOTAL)
    for a, b in zip(stops[:-1], stops[1:]):
        ends_table = _weights(seen).ravel()
        upto = _cumulative(count, sizes)
        each = np.diff(upto, axis=1)
        frequency = (upto[:, :-1] << 16 | each).view(_V).ravel()
        # the place of each part; only blocks without ids, which come last, have no parts
        table = np.repeat(np.tile(np.arange(width, dtype=np.int16), lanes), each.ravel())
        for t in range(a, b):
            n = live[t]
            prev, far = before[:n], last[:n]
            at_one = base_one[:n] + prev
            far ^= prev * 0x1B5
            far &= SLOTS - 1
            at_two = base_two[:n] + far
            first, second = one.take(at_one), two.take(at_two)
            state = (first | second) & _RUNS
            state |= (first ^ second) < 32
            ends = ends_table.take(base_state[:n] + state)
            end_one = ends >> sixteen
            part = span[:n] >> _U(2 * BITS)
            point = np.minimum(code[:n] // part, most_point).astype(_V)
            offset, rest = end_one << twelve, total - end_one
            # as if order 0 gave all ids; the few that a higher order gave are put right below
            hit = (point < offset).nonzero()[0]
            own = point - offset
            own[hit] = 0
            own //= rest
            symbol = table.take(base_table[:n] + own)
            own = frequency.take(base_place[:n] + symbol)
            start = own >> sixteen
            start *= rest
            start += offset
            own &= low_half
            own *= rest
            if len(hit):
                end_two = ends.take(hit)
                by_one = end_two >> sixteen
                end_two &= low_half
                by_one -= end_two
                by_two = point.take(hit) >> twelve < end_two
                symbol[hit] = (np.where(by_two, second.take(hit), first.take(hit)) >> 5) - 1
                start[hit] = (end_two << twelve) * ~by_two
                own[hit] = np.where(by_two, end_two, by_one) << twelve
                state[hit] = state.take(hit) - np.where(by_two, _BY_TWO, _BY_ONE)  # outcomes in the two highest bits: -2 order 2, -1 order 1
            code[:n] -= start * part
            np.multiply(own, part, out=span[:n])
            go = (span[:n] < _LEAST).nonzero()[0]
            if len(go):
                where = read.take(go)
                code[go] = code.take(go) << _WORD | words.take(np.minimum(where, last_word))
                where += 1
                read[go] = where
                span[go] = span.take(go) << _WORD
            ids[t, :n] = symbol
            noted[t, :n] = state
            symbol = symbol.astype(np.int32) + 1
            entry = symbol << 5
            first ^= entry
            second ^= entry
            one[at_one] = entry | _AGAIN[1].take(np.minimum(first.view(_V), _V(32)))
            two[at_two] = entry | _AGAIN[3].take(np.minimum(second.view(_V), _V(32)))
            np.multiply(prev, 0x5A4D, out=far)
            before[:n] = symbol
        if b < most:
            own = noted[a:b]
            at, plain = (lane << 8) + own.view(np.uint8), own >= 0
            if live[b - 1] < lanes:
                inside = np.arange(a, b)[:, None] < length
                at, plain = at[inside], plain & inside
            # by the outcome in the two highest bits and the state: 0 for order 0, 2 for order 2, 3 for order 1
            new = np.bincount(at.ravel(), minlength=lanes << 8).reshape(lanes, 4, 2 * STATES)
            seen += new[:, [2, 3, 0], :STATES].transpose(0, 2, 1)
            count += np.bincount(
                (base_place + ids[a:b])[plain], minlength=count.size
            ).reshape(count.shape).astype(np.int32)
    done: list[np.ndarray] = [np.zeros(0, np.int64)] * lanes
    ids = np.ascontiguousarray(ids.T)
    for row, k in enumerate(order):
        done[k] = alphabets[row][np.minimum(ids[row, : length[row]], max(int(sizes[row]) - 1, 0))]
    return done
