"""Byte-level BPE over Arrow text columns: vectorised pre-tokens, each distinct one encoded once.

``pretokens`` finds the byte-level pattern's pieces (contractions, runs of
letters, of numbers, of other characters, each with one leading blank, and
white space) for many texts at once.  ``LibraryIds`` gives ids by the
tokenizers library, ``RankCounter`` counts symbols by rank-synchronous merging.
Both keep what they found for a piece in a table from which pieces that didn't
come again are dropped at a fixed size; a piece is found by its hash and then compared byte by byte.  A text that
holds an added special token is handed to the library whole.  A long text is
worked through in slices cut where a piece surely begins.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from functools import lru_cache

import numpy as np

from wearlake.llm import textvec as tv

_U = np.uint64
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Pieces kept in a table before those that came once since the last time are dropped.
CACHE_PIECES = 1_000_000
#: The first two bytes of white space beyond ASCII, and of what lies beside it.
_SPACE_LEADS = (0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)
#: Bytes of a text worked through at once.
SLICE = 1 << 21


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    # white space: the characters with the White_Space property (fixed values)
    out[
        [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    ] = SPACE
    return out


def _kinds(data: np.ndarray, at: np.ndarray | None) -> np.ndarray:
    """Classes of the characters of valid UTF-8 that begin at ``at`` (None: at every byte)."""
    table = _classes()
    if at is None:
        return table[:128].take(data)
    lead = data.take(at)
    kind = table[:256].take(lead)
    wide = np.flatnonzero(lead >= 0xC0)
    place, first = at[wide], lead[wide].astype(np.int32)
    length = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first & (0x7F >> length)
    for j in range(1, 4):
        more = np.flatnonzero(length > j)
        code[more] = code[more] << 6 | data[place[more] + j] & 0x3F
    kind[wide] = table[code]
    return kind


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all pieces (texts cut at ``offsets``), and for each text the index of its first piece (n + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80) if int(data.max()) >= 128 else None
    byte, kind = data if at is None else data.take(at), _kinds(data, at)
    n = len(byte)
    edges = offsets[:-1][np.diff(offsets) > 0]  # first characters of texts
    edges = edges if at is None else np.searchsorted(at, edges)
    start = np.empty(n, bool)  # a run of one class begins
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[edges] = True
    # white space: the last character of a run before other text stands alone, or leads the next piece if it is a blank
    space = kind == SPACE
    ends = space.copy()
    ends[:-1] &= ~space[1:]
    ends[edges[1:] - 1] = False
    ends[-1] = False
    ends = np.flatnonzero(ends)
    start[ends] = True
    led = ends[byte.take(ends) == 32] + 1
    start[led] = False
    # contractions: an apostrophe that begins a piece
    quote = np.flatnonzero(byte == 39)
    quote = quote[start[quote] & (quote < n - 1)] if len(quote) else quote
    if len(quote):
        first = np.ones(n + 3, bool)
        first[:n] = False
        first[edges] = True
        pad = np.concatenate((byte, np.zeros(3, np.uint8)))
        b1, b2 = pad[quote + 1], pad[quote + 2]
        one = np.isin(b1, np.frombuffer(b"stmd", np.uint8)) & ~first[quote + 1]
        two = ~first[quote + 1] & ~first[quote + 2] & (
            ((b1 == 114) & (b2 == 101)) | ((b1 == 118) & (b2 == 101)) | ((b1 == 108) & (b2 == 108))
        )
        for k, width in ((quote[one], 2), (quote[two & ~one], 3)):
            start[k + 1] = False
            inside = k + width
            inside = inside[inside < n]
            start[inside] |= kind[inside] == LETTER
    starts = np.flatnonzero(start)
    starts = starts if at is None else at.take(starts)
    return starts, np.searchsorted(starts, offsets, side="left")


class _Model:
    """The parts of a tokenizer file that are needed on an executor."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre[
            "add_prefix_space"
        ] or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        self.specials = [x["content"].encode() for x in spec["added_tokens"]]
        self.leads = np.zeros(max(model["vocab"].values()) + 1, bool)  # ids whose bytes begin with a blank, which the byte-level alphabet writes as code point 288
        self.leads[[i for t, i in model["vocab"].items() if t[0] == chr(288)]] = True
        self.vocab, self.merges = model["vocab"], [
            tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]
        ]


@lru_cache(4)
def model(path: str) -> _Model:
    return _Model(path)


def slices(data: np.ndarray, most: int | None = None) -> list[int]:
    """Cuts of one text, 0 and its size included, about ``most`` bytes apart where that can be.

    A piece begins at a blank that stands between a character other than white
    space and a letter, number or other character; only blanks between two
    printable ASCII characters are taken.
    """
    most, cuts = most or SLICE, [0]
    while len(data) - cuts[-1] > most:
        at = cuts[-1] + most
        for reach in (4096, len(data)):
            part = data[at : at + reach + 1]
            good = (part[1:-1] == 32) & (part[:-2] > 32) & (part[:-2] < 127) & (part[2:] > 32) & (part[2:] < 127)
            if good.any():
                break
        else:
            break
        cuts.append(at + 1 + int(np.argmax(good)))
    return [*cuts, len(data)]


class _Column:
    """Numbers that are appended to; ``all`` is those there are, without a copy."""

    def __init__(self, kind: type, first: int = 0):
        self.room, self.size = np.zeros(1024, kind), first

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.size]

    def append(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.size + len(more)), self.room.dtype)
            room[: self.size] = self.all
            self.room = room
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)


def _ragged(begin: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each of many runs in a row."""
    return np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))


class _Pieces:
    """Distinct pieces in an open hash table, extended in batches.  Pieces with equal hashes are told apart by their bytes."""

    def __init__(self, path: str):
        self.model = model(path)
        self.clear()

    def clear(self) -> None:
        self.keys, self.words, self.begin_words, self.sizes = _Column(_U), _Column(_U), _Column(np.int64, 1), _Column(np.int64)
        self.again = _Column(bool)  # pieces that came again after their first block, since the last time of dropping
        self.table = np.full(1 << 21, -1, np.int32)  # more than 4 places a piece
        self.odd: dict[bytes, int] = {}  # pieces whose hash another piece has

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece with each hash, -1 for none."""
        mask = _U(len(self.table) - 1)
        place = hashes & mask
        out = self.table.take(place.astype(np.int64))
        if not self.keys.size:
            return out
        left = np.flatnonzero((out >= 0) & (self.keys.all.take(out, mode="clip") != hashes))
        while len(left):
            place[left] = place[left] + _U(1) & mask
            out[left] = self.table.take(place[left].astype(np.int64))
            left = left[(out[left] >= 0) & (self.keys.all.take(out[left], mode="clip") != hashes[left])]
        return out

    def enter(self, hashes: np.ndarray, pieces: np.ndarray) -> None:
        """Put new pieces with different hashes in the table."""
        mask = _U(len(self.table) - 1)
        place = (hashes & mask).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.table[place[left]] < 0]
            self.table[place[free]] = pieces[free]
            left = left[self.table[place[left]] != pieces[left]]
            place[left] = place[left] + 1 & len(self.table) - 1

    def append(
        self, hashes: np.ndarray, words: np.ndarray, begin: np.ndarray, data: np.ndarray, starts: np.ndarray,
        ends: np.ndarray,
    ) -> np.ndarray:
        """Add pieces; returns their numbers."""
        first = self.keys.size
        self.keys.append(hashes)
        self.again.append(np.zeros(len(hashes), bool))
        number = np.diff(begin)
        self.words.append(words[_ragged(begin[:-1], number)])
        self.begin_words.append(self.begin_words.all[-1] + np.cumsum(number))
        self.sizes.append(ends - starts)
        self.add(data, starts, ends)
        return np.arange(first, self.keys.size)

    def renew(self) -> None:
        """Drop the pieces that didn't come again, or all if that leaves more than half of CACHE_PIECES."""
        stay = self.again.all.copy()
        stay[list(self.odd.values())] = False
        stay = np.flatnonzero(stay)
        if len(stay) > CACHE_PIECES // 2:
            stay = stay[:0]
        hashes, sizes, found = self.keys.all[stay], self.sizes.all[stay], self.found(stay)
        begin = self.begin_words.all[stay]
        number = self.begin_words.all[stay + 1] - begin
        words = self.words.all[_ragged(begin, number)]
        self.clear()
        self.keys.append(hashes)
        self.again.append(np.zeros(len(stay), bool))
        self.words.append(words)
        self.begin_words.append(np.cumsum(number))
        self.sizes.append(sizes)
        self.put_back(*found)
        while 4 * len(stay) > len(self.table):
            self.table = np.full(2 * len(self.table), -1, np.int32)
        self.enter(hashes, np.arange(len(stay), dtype=np.int32))

    def resolve(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each piece; new pieces are added."""
        if self.keys.size > CACHE_PIECES:
            self.renew()
        size = ends - starts
        words, begin = tv.span_words(data, starts, ends)
        hashes = tv.hash_words(words, begin, size)
        slot = self.find(hashes)
        new = np.flatnonzero(slot < 0)
        self.again.all[slot if not len(new) else slot[slot >= 0]] = True
        if len(new):
            _, where = np.unique(hashes[new], return_index=True)
            pick = np.sort(new[where])
            while 4 * (self.keys.size + len(pick)) > len(self.table):  # many new pieces at once
                self.table = np.full(2 * len(self.table), -1, np.int32)
                plain = np.setdiff1d(np.arange(self.keys.size), np.fromiter(self.odd.values(), np.int64, len(self.odd)))
                self.enter(self.keys.all[plain], plain.astype(np.int32))
            number = begin[pick + 1] - begin[pick]
            own = np.concatenate((np.zeros(1, np.int64), np.cumsum(number)))
            added = self.append(hashes[pick], words[_ragged(begin[pick], number)], own, data, starts[pick], ends[pick])
            self.enter(hashes[pick], added.astype(np.int32))
            slot[new] = self.find(hashes[new])
        number = np.diff(begin)
        stored = self.words.all.take(
            np.repeat(self.begin_words.all[slot] - begin[:-1], number) + np.arange(len(words)), mode="clip"
        )
        wrong = self.sizes.all[slot] != size
        differing = np.flatnonzero(stored != words)
        if len(differing):
            wrong[np.searchsorted(begin, differing, side="right") - 1] = True
        for k in np.flatnonzero(wrong).tolist():
            piece = data[starts[k] : ends[k]].tobytes()
            if piece not in self.odd:
                own = slice(int(begin[k]), int(begin[k + 1]))
                self.odd[piece] = int(
                    self.append(
                        hashes[k : k + 1], words[own], np.array([0, own.stop - own.start]), data, starts[k : k + 1],
                        ends[k : k + 1],
                    )[0]
                )
            slot[k] = self.odd[piece]
        return slot

    def with_special(self, data: np.ndarray, offsets: np.ndarray) -> set[int]:
        """Texts in which an added special token occurs."""
        rows, raw = set(), None
        for special in self.model.specials:
            raw = data.tobytes() if raw is None else raw
            at = raw.find(special)
            while at >= 0:
                t = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(special) <= offsets[t + 1]:
                    rows.add(t)
                at = raw.find(special, at + 1)
        return rows


class LibraryIds(_Pieces):
    """Ids of whole texts; each distinct piece goes through the tokenizers library once."""

    def clear(self) -> None:
        super().clear()
        self.begin, self.length, self.flat = _Column(np.int64), _Column(np.int64), _Column(np.uint32)

    def found(self, stay: np.ndarray) -> tuple[np.ndarray, ...]:
        """What was found for some pieces, for ``put_back`` once they are numbered anew."""
        length = self.length.all[stay]
        return length, self.flat.all[_ragged(self.begin.all[stay], length)]

    def put_back(self, length: np.ndarray, flat: np.ndarray) -> None:
        self.begin.append(np.cumsum(length) - length)
        self.length.append(length)
        self.flat.append(flat)

    def library(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has.

        Pieces that begin with a blank and go on with something else are joined,
        since the pattern parts them again where they were joined; a joined text
        that doesn't come back in as many pieces is done piece by piece.
        """
        n, size, most = len(starts), ends - starts, max(len(data) - 1, 0)
        second, third = data.take(np.minimum(starts + 1, most)), data.take(np.minimum(starts + 2, most))
        joined = (size > 1) & (data.take(starts) == 32) & (second > 32)
        for lead, more in _SPACE_LEADS:
            joined &= (second != lead) | (third != more)
        joins, alone = np.flatnonzero(joined), [np.flatnonzero(~joined)]
        raw = data[_ragged(starts[joins], size[joins])].tobytes()
        upto = np.concatenate(([0], np.cumsum(size[joins])))
        flat, sizes, rows = [], np.zeros(n, np.int64), []
        groups = [joins[k : k + 256] for k in range(0, len(joins), 256)]
        cuts = [*upto[:-1:256].tolist(), len(raw)]
        for own, coded in zip(
            groups,
            self.model.library.encode_batch_fast(
                [raw[x:y].decode() for x, y in zip(cuts[:-1], cuts[1:])] if groups else [], add_special_tokens=False
            ),
        ):
            ids = np.array(coded.ids, np.uint32)
            heads = np.flatnonzero(self.model.leads[np.minimum(ids, len(self.model.leads) - 1)])
            if len(heads) == len(own):
                sizes[own] = np.diff(np.append(heads, len(ids)))
                flat.append(ids)
                rows.append(own)
            else:
                alone.append(own)
        alone = np.concatenate(alone)
        for k in range(0, len(alone), 20_000):  # encodings of a part at a time are kept
            own = alone[k : k + 20_000]
            texts = [data[x:y].tobytes().decode() for x, y in zip(starts[own].tolist(), ends[own].tolist())]
            ids = [x.ids for x in self.model.library.encode_batch_fast(texts, add_special_tokens=False)]
            sizes[own] = np.fromiter(map(len, ids), np.int64, len(ids))
            flat.append(np.fromiter((i for x in ids for i in x), np.uint32, int(sizes[own].sum())))
            rows.append(own)
        found, rows = np.concatenate([np.zeros(0, np.uint32), *flat]), np.concatenate([alone[:0], *rows])
        begin = np.empty(n, np.int64)
        begin[rows] = np.cumsum(sizes[rows]) - sizes[rows]
        return found[_ragged(begin, sizes)], sizes

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        for k in range(0, len(starts), 50_000):
            ids, sizes = self.library(data, starts[k : k + 50_000], ends[k : k + 50_000])
            self.begin.append(self.flat.size + np.cumsum(sizes) - sizes)
            self.length.append(sizes)
            self.flat.append(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the index of each text's first (n + 1 values)."""
        if len(offsets) == 2 and len(data) > SLICE:
            cuts = slices(data)
            ids = np.concatenate(
                [self._encode(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts[:-1], cuts[1:])]
            )
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, first = pretokens(data, offsets)
        ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
        slot = self.resolve(data, starts, ends) if len(starts) else starts
        size = self.length.all[slot] if len(starts) else np.zeros(0, np.int64)
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat.all[:0]
        if len(starts):
            ids = self.flat.all.take(np.repeat(self.begin.all[slot] - upto[:-1], size) + np.arange(upto[-1]))
        begin = upto[first]
        special = self.with_special(data, offsets)
        if special:
            parts = [ids[begin[t] : begin[t + 1]] for t in range(len(offsets) - 1)]
            for t in special:
                text = data[offsets[t] : offsets[t + 1]].tobytes().decode()
                parts[t] = np.array(self.model.library.encode(text, add_special_tokens=False).ids, np.uint32)
            begin = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
            ids = np.concatenate(parts)
        return ids, begin


class RankCounter(_Pieces):
    """Symbols per text by rank-synchronous merging of ragged arrays of pieces."""

    def __init__(self, path: str):
        super().__init__(path)
        vocab = self.model.vocab
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256 on (fixed rule)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        char = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.symbol = np.array([vocab[char[b]] for b in range(256)], np.int64)
        pair = np.array([vocab[a] << 32 | vocab[b] for a, b in self.model.merges], np.int64)
        rank = np.arange(len(pair))
        made = np.array([vocab[a + b] for a, b in self.model.merges], np.int64)
        order = np.argsort(pair)
        self.pair, self.rank, self.made = pair[order], rank[order], made[order]

    def clear(self) -> None:
        super().clear()
        self.count = _Column(np.int64)

    def found(self, stay: np.ndarray) -> tuple[np.ndarray, ...]:
        return (self.count.all[stay],)

    def put_back(self, count: np.ndarray) -> None:
        self.count.append(count)

    def merged(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """How many symbols each of n sequences keeps.  symbols: all sequences in a row; owner: the sequence of each, ascending."""
        kept = np.zeros(n, np.int64)
        none = np.int64(1 << 40)
        while len(symbols):
            joint = owner[1:] == owner[:-1]
            key = symbols[:-1] << 32 | symbols[1:]
            slot = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            rank = np.where(joint & (self.pair[slot] == key), self.rank[slot], none)
            rank = np.append(rank, none)
            head = np.flatnonzero(np.concatenate(([True], ~joint)))
            lowest = np.minimum.reduceat(rank, head)
            size = np.diff(np.append(head, len(symbols)))
            live = lowest < none
            done = ~live
            kept[owner[head[done]]] = size[done]
            if not live.any():
                break
            hit = (rank == np.repeat(lowest, size)) & np.repeat(live, size)
            # a run of overlapping hits (a a a): every second one from the left counts
            where = np.flatnonzero(hit)
            fresh = np.concatenate(([True], where[1:] != where[:-1] + 1))
            turn = np.arange(len(where)) - np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
            where = where[turn % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = self.made[slot[where]]
            keep = np.repeat(live, size)
            keep[where + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return kept

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size = ends - starts
        upto = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(starts - upto[:-1], size) + np.arange(upto[-1])
        count = self.merged(self.symbol[data[at]], np.repeat(np.arange(len(size)), size), len(size))
        self.count.append(count)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        if len(offsets) == 2 and len(data) > SLICE:
            cuts = slices(data)
            return np.array(
                [sum(int(self._counts(data[a:b], np.array([0, b - a]))[0]) for a, b in zip(cuts[:-1], cuts[1:]))]
            )
        return self._counts(data, offsets)

    def _counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, first = pretokens(data, offsets)
        upto = np.zeros(1, np.int64)
        if len(starts):
            slot = self.resolve(data, starts, np.concatenate((starts[1:], [len(data)])))
            upto = np.concatenate((upto, np.cumsum(self.count.all[slot])))
        out = upto[first[1:]] - upto[first[:-1]]
        for t in self.with_special(data, offsets):
            parts = [data[offsets[t] : offsets[t + 1]].tobytes()]
            for special in self.model.specials:
                parts = [y for x in parts for y in x.split(special)]
            pieces = len(parts) - 1
            for part in parts:
                if part:
                    pieces += int(self._counts(np.frombuffer(part, np.uint8), np.array([0, len(part)]))[0])
            out[t] = pieces
        return out


@lru_cache(4)
def library_ids(path: str) -> LibraryIds:
    """One per worker process."""
    return LibraryIds(path)


@lru_cache(4)
def rank_counter(path: str) -> RankCounter:
    """One per worker process."""
    return RankCounter(path)
