"""Byte-pair merging on public vocabulary files: a counter and an encoder, both exact to the tokenizers library.

Files of two kinds are read: byte-level BPE whose words keep a leading space, and lower-cased
BPE whose words end in a suffix and whose white space is dropped.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import RecentCache, slices, word_units

#: The White_Space characters of Unicode, which the patterns' \s stands for.
WHITE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_GAP = f"[{WHITE}]"
_INK = f"[^{WHITE}]"

#: A piece of this many symbols or more goes to the heap, as the scan for the minimum is quadratic.
LONG_PIECE = 200
#: Bytes of text whose distinct words are encoded together.
SLICE_BYTES = 8 << 20
#: Pieces that are merged together, which bounds the arrays.
BATCH_PIECES = 30_000
_NONE = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merges:
    """Vocabulary and merge ranks of one file; symbols are ids, a pair is the key left << 20 | right."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        if len(vocab) >= 1 << 20:
            raise ValueError("vocabulary of more than 2**20 symbols")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.rank: dict[int, int] = {}
        self.made = array("l")
        for r, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in model["merges"]):
            self.rank[vocab[a] << 20 | vocab[b]] = r
            self.made.append(vocab[a + b])
        stand_in = byte_alphabet()
        self.first = [vocab[c] for c in stand_in]
        self.last = [vocab[c + self.suffix] for c in stand_in]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["content"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("only added tokens that match their plain text are supported")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        of = {c: b for b, c in enumerate(stand_in)}
        self.bytes_of: dict[int, bytes] = {i: bytes(of[c] for c in t.removesuffix(self.suffix)) if self.suffix else bytes(of[c] for c in t) for t, i in vocab.items()}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})

    def symbols(self, piece: str) -> list[int]:
        """The initial symbols of a piece: one for each UTF-8 byte, the last with the word-end suffix."""
        raw = piece.encode("utf-8", "surrogatepass")
        first = self.first
        out = [first[b] for b in raw]
        if out:
            out[-1] = self.last[raw[-1]]
        return out

    def merge_heap(self, sym: list[int]) -> tuple[list[int], int]:
        """Heap and linked list: pops the lowest-ranked adjacent pair, leftmost first, until none is left.

        Returns the symbol slots (-1 where one was merged away) and the number of merges made.
        """
        n, get, made = len(sym), self.rank.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := get(sym[i] << 20 | sym[i + 1])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if sym[i] < 0 or j >= n or get(sym[i] << 20 | sym[j]) != r:
                continue  # an entry whose pair has gone
            here = sym[i] = made[r]
            sym[j] = -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get(here << 20 | sym[k])) is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := get(sym[h] << 20 | here)) is not None:
                heappush(heap, r << 32 | h)
        return sym, merges

    def count_piece(self, piece: str) -> int:
        """Tokens of one piece: initial symbols minus merges."""
        sym = self.symbols(piece)
        return len(sym) - self.merge_heap(sym)[1] if len(sym) > 1 else len(sym)

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece: parts and adjacent ranks in contiguous arrays, the least rank found by a scan."""
        parts = self.symbols(piece)
        if len(parts) >= LONG_PIECE:
            return [x for x in self.merge_heap(parts)[0] if x >= 0]
        get, made = self.rank.get, self.made
        ranks = [get(a << 20 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            here = parts[i] = made[least]
            del parts[i + 1], ranks[i]  # the boundary between the two goes
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | here, _NONE)
            if i < len(ranks):
                ranks[i] = get(here << 20 | parts[i + 1], _NONE)
        return parts


class BatchMerger:
    """Merges many pieces at once: one merge of the least-ranked pair, leftmost first, for each piece a round."""

    def __init__(self, merges: Merges):
        self.merges = merges
        pairs = np.fromiter(merges.rank, np.int64, len(merges.rank))
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.ranks = np.fromiter(merges.rank.values(), np.int32, len(pairs))[order]
        self.made = np.array(merges.made, np.int32)
        self.first, self.last = np.array(merges.first, np.int32), np.array(merges.last, np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _FAR)

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece; none is empty."""
        raws = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list[bytes] = [b""] * len(raws)
        long = [i for i, r in enumerate(raws) if len(r) >= LONG_PIECE]
        for i in long:
            out[i] = array("I", self.merges.encode_piece(pieces[i])).tobytes()
        of = np.array([i for i, r in enumerate(raws) if len(r) < LONG_PIECE], np.int64)
        if not len(of):
            return out
        size = np.fromiter((len(raws[i]) for i in of), np.int64, len(of))
        raw = np.frombuffer(b"".join(raws[i] for i in of), np.uint8)
        end = np.cumsum(size) - 1
        sym = self.first[raw]
        sym[end] = self.last[raw[end]]
        rank = np.full(len(sym), _FAR, np.int32)
        rank[:-1] = self._rank(sym[:-1], sym[1:])
        rank[end] = _FAR
        while len(size):
            start = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, start)
            going = least < _FAR
            if not going.all():
                whole = np.repeat(going, size)
                rest = sym[~whole].astype(np.uint32).tobytes()
                at = 0
                for i, n in zip(of[~going].tolist(), (4 * size[~going]).tolist()):
                    out[i] = rest[at : at + n]
                    at += n
                sym, rank, size, of, least = sym[whole], rank[whole], size[going], of[going], least[going]
                if not len(size):
                    break
            piece = np.repeat(np.arange(len(size)), size)
            at = np.flatnonzero(rank == np.repeat(least, size))
            at = at[np.concatenate([[True], piece[at[1:]] != piece[at[:-1]]])]
            sym[at] = self.made[least]
            stays = np.ones(len(sym), bool)
            stays[at + 1] = False
            ends = at + 1 == np.cumsum(size) - 1  # the part merged away was the last
            sym, rank, size = sym[stays], rank[stays], size - 1
            at = at - np.arange(len(at))
            open_ = at[~ends]
            rank[at[ends]] = _FAR
            rank[open_] = self._rank(sym[open_], sym[open_ + 1])
            before = at[at > np.cumsum(size) - size]
            rank[before - 1] = self._rank(sym[before - 1], sym[before])
        return out


_FAR = np.int32(2**31 - 1)
_STOPS = frozenset(".,;:!?")


def _lower(text: str) -> str:
    """Lower case of each character by itself: no rule for a final sigma."""
    return text.lower() if "\u03a3" not in text else "".join(c.lower() for c in text)


class _Splitter:
    """Cuts texts into units that tokenise independently of what surrounds them, and units into pieces."""

    def __init__(self, merges: Merges):
        self.merges = merges
        if merges.suffix:
            self.units = regex.compile(f"{_INK}+")
            self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        else:
            self.units = regex.compile(rf" ?{_INK}+|{_GAP}+(?!{_INK})|{_GAP}+")
            self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.odd = regex.compile(r"[\x1c-\x1f]")

    def unit_pieces(self, unit: str) -> list[str]:
        if self.merges.suffix:
            if not unit.isascii():
                unit = unicodedata.normalize("NFC", unit)
            unit = _lower(unit)
            if unit.isalpha():
                return [unit]
            if unit[-1:] in _STOPS and unit[:-1].isalpha():
                return [unit[:-1], unit[-1]]
        return self.pieces.findall(unit)

    def odd_texts(self, texts: pa.Array) -> list[int]:
        """Those with special strings or control characters that only some splitters part at."""
        pattern = "|".join([r"[\x1c-\x1f]", *map(re.escape, self.merges.special)])
        return np.flatnonzero(pc.match_substring_regex(texts, pattern).fill_null(True).to_numpy(zero_copy_only=False)).tolist()

    def of(self, text: str) -> list[str]:
        """White space parts the units of either kind; str.split() also parts at four control characters."""
        if self.merges.suffix and not self.odd.search(text):
            return text.split()
        return self.units.findall(text)


class TokenCounter:
    """Counts tokens without making identifiers; `limit` bounds the cached units and pieces."""

    def __init__(self, path: str, limit: int = 250_000):
        self.merges = Merges(path)
        self.split = _Splitter(self.merges)
        self.piece = RecentCache(self.merges.count_piece, limit)
        self.unit = RecentCache(lambda u: sum(map(self.piece.__getitem__, self.split.unit_pieces(u))), limit)

    def _plain(self, text: str) -> int:
        return sum(map(self.unit.__getitem__, self.split.of(text)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if (m := self.merges).specials and any(s in text for s in m.special):
            parts = m.specials.split(text)
            return sum(1 if i % 2 else self._plain(x) for i, x in enumerate(parts))
        return self._plain(text)

    def count_all(self, texts: pa.Array) -> list[int]:
        """Counts of many texts; each distinct unit of a slice is looked up once."""
        if not self.merges.suffix:
            return [self.count(x.as_py()) for x in texts]
        out: list[int] = []
        for part in slices(texts):
            odd = self.split.odd_texts(part)
            starts, units = word_units(part)
            each = np.fromiter(map(self.unit.__getitem__, units.dictionary.to_pylist()), np.int64, len(units.dictionary))
            upto = np.concatenate([[0], np.cumsum(each[units.indices.to_numpy()])])
            counts = (upto[starts[1:]] - upto[starts[:-1]]).tolist()
            for i in odd:
                counts[i] = self.count(part[i].as_py())
            out += counts
        return out


class Encoder:
    """Encodes whole texts into packed little-endian 32-bit ids and back."""

    def __init__(self, path: str, limit: int = 250_000):
        self.merges = Merges(path)
        self.split = _Splitter(self.merges)
        self.piece = RecentCache(lambda p: array("I", self.merges.encode_piece(p)).tobytes(), limit)
        self.unit = RecentCache(lambda u: b"".join(map(self.piece.__getitem__, self.split.unit_pieces(u))), limit)
        self.table = self.merges.bytes_of
        self.batch = BatchMerger(self.merges)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.unit.__getitem__, self.split.of(text)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, four bytes each."""
        if not text:
            return b""
        if (m := self.merges).specials and any(s in text for s in m.special):
            parts = m.specials.split(text)
            return b"".join(array("I", [m.special[x]]).tobytes() if i % 2 else self._plain(x) for i, x in enumerate(parts))
        return self._plain(text)

    def _units(self, units: list[str]) -> pa.LargeBinaryArray:
        """Ids of distinct units; each distinct piece of theirs is merged once."""
        index: dict[str, int] = {}
        flat: list[int] = []
        ends: list[int] = [0]
        split, known = self.split.unit_pieces, index.setdefault
        for u in units:
            lower = u.lower()
            if lower.isalpha() and u.isascii():
                flat.append(known(lower, len(index)))
            elif u:
                flat += [known(p, len(index)) for p in split(u)]
            ends.append(len(flat))
        distinct = list(index)
        index.clear()
        made = [x for i in range(0, len(distinct), BATCH_PIECES) for x in self.batch.encode(distinct[i : i + BATCH_PIECES])]
        pieces = pa.array(made, pa.large_binary()).take(pa.array(flat, pa.int64()))
        offsets = _offsets(pieces)[np.array(ends, np.int64)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(units), [None, pa.py_buffer(offsets), pieces.buffers()[2]])

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of many texts, in their order. Each distinct unit of a slice is encoded once, and no cache outlives it."""
        if not self.merges.suffix:
            yield from (self.encode(x.as_py()) for x in texts)
            return
        for part in slices(texts, SLICE_BYTES):
            odd = set(self.split.odd_texts(part))
            starts, units = word_units(part)
            ids = self._units(units.dictionary.to_pylist()).take(units.indices)
            data = memoryview(ids.buffers()[2] or b"")
            bounds = _offsets(ids)[starts].tolist()
            for i in range(len(part)):
                yield self.encode(part[i].as_py()) if i in odd else bytes(data[bounds[i] : bounds[i + 1]])

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; only a vocabulary without word ends can be undone exactly."""
        return b"".join(map(self.table.__getitem__, array("I", ids))).decode("utf-8", "replace")


def _offsets(column: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)


_COUNTERS: dict[tuple, TokenCounter] = {}
_ENCODERS: dict[tuple, Encoder] = {}


def counter(path: str, limit: int = 250_000) -> TokenCounter:
    """One counter for each worker process, kept for its later tasks."""
    if (path, limit) not in _COUNTERS:
        _COUNTERS[path, limit] = TokenCounter(path, limit)
    return _COUNTERS[path, limit]


def encoder(path: str, limit: int = 250_000) -> Encoder:
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = Encoder(path, limit)
    return _ENCODERS[path, limit]
