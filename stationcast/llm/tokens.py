"""Token ids of whole texts by a public tokenizer file, with each distinct piece of text encoded once per worker.

A byte-level BPE of this family never lets a token span a single blank that stands between two other
characters, so a text may be cut before such blanks and the ids of the pieces joined. The pieces repeat, so
most are looked up. Added tokens (`<|endoftext|>`) have their own ids wherever a text holds them, as in the
tokenizer's plain call; the text is cut round them. `tests/llm` compares this with the tokenizer's own result on whole texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stationcast.llm.support import per_process, runs

TOKENIZER = "byte_bpe_50k.json"
#: Distinct pieces that a worker remembers (about 50 bytes each); its memory is emptied when it is full.
REMEMBERED = 2_000_000
#: Bytes of a piece that the table of known pieces holds in its key.
KEY_BYTES = 15

#: Pieces that are encoded as one text.
JOINED = 1024
#: How a byte-level vocabulary writes the blank.
BLANK = "\u0120"

_ODD = r"\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_ODD_ARROW = r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
#: Pieces that are encoded on their own; for Arrow.
_ALONE = r"^$| |[\t\n\r]$|" + _ODD_ARROW
#: Texts that may not be cut at each of their blanks; for Arrow.
_UNEVEN = r"^ | $|  | [\t\n\r]|[\t\n\r] |" + _ODD_ARROW
_CUT = re.compile(rf"(?<=[^\s{_ODD}]) (?=[^\s{_ODD}])")
#: Letters, then punctuation that is no apostrophe; for Arrow.
_WORD_END = r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)(?P<end>[!-&(-/:-@\[-`{-~]+)$"
def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class PieceTable:
    """Numbers of pieces, in open addressing over arrays. A key is a piece's bytes and its size, so equal keys are equal
    pieces; longer ones are in a dictionary."""

    def __init__(self):
        self.bits, self.size, self.long = 16, 0, {}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros((1 << self.bits, 2), np.uint64)
        self.numbers = np.full(1 << self.bits, -1, np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def keys_of(pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of pieces that are short enough, and which those are."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        sizes = np.diff(offsets)
        short = np.flatnonzero(sizes <= KEY_BYTES)
        data = pieces.buffers()[2]
        data = np.concatenate([np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), np.zeros(KEY_BYTES + 1, np.uint8)])
        columns = np.arange(KEY_BYTES + 1)
        found = data[offsets[short][:, None] + columns]
        found[columns >= sizes[short][:, None]] = 0
        found[:, KEY_BYTES] = sizes[short]
        return found.view(np.uint64), short

    def find(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """The number of each piece, -1 where it is not known."""
        out = np.full(len(pieces), -1, np.int64)
        keys, short = self.keys_of(pieces)
        if len(short) < len(pieces):
            rest = np.delete(np.arange(len(pieces)), short)
            out[rest] = [self.long.get(p, -1) for p in pieces.take(pa.array(rest)).to_pylist()]
        at, left, mask = self._places(keys), np.arange(len(short)), (1 << self.bits) - 1
        while len(left):
            numbers = self.numbers[at]
            same = (self.keys[at] == keys[left]).all(axis=1) & (numbers >= 0)
            out[short[left[same]]] = numbers[same]
            go = ~same & (numbers >= 0)
            left, at = left[go], (at[go] + 1) & mask
        return out

    def _insert(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        at, left, mask = self._places(keys), np.arange(len(keys)), (1 << self.bits) - 1
        while len(left):
            free = self.numbers[at] < 0
            # of several that want one place, the last to be written has it
            self.numbers[at[free]] = numbers[left[free]]
            won = self.numbers[at] == numbers[left]
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) & mask

    def add(self, pieces: pa.LargeStringArray) -> None:
        """Numbers distinct pieces that are not known yet, in turn."""
        keys, short = self.keys_of(pieces)
        numbers = np.arange(self.size, self.size + len(pieces), dtype=np.int32)
        if 2 * (self.size + len(pieces)) > 1 << self.bits:
            held = self.numbers >= 0
            old = self.keys[held], self.numbers[held]
            self.bits = (2 * (self.size + len(pieces))).bit_length()
            self._clear()
            self._insert(*old)
        self._insert(keys, numbers[short])
        if len(short) < len(pieces):
            rest = np.delete(np.arange(len(pieces)), short)
            self.long.update(zip(pieces.take(pa.array(rest)).to_pylist(), numbers[rest].tolist()))
        self.size += len(pieces)


class Encoder:
    """Ids of texts as unsigned integers of `width` bytes in the machine's byte order."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.tokenizer.model._resize_cache(0)  # every piece comes once
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.leads = np.array([(name or "").startswith(BLANK) for name in names])
        added = {t.content: t for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = sorted(added, key=len, reverse=True)
        self.around = re.compile(f"({'|'.join(map(re.escape, self.added))})")
        self.separate = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.first: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """No piece after a blank is known. Those that are have a number; their ids lie one after another."""
        self.known = PieceTable()
        self.ids, self.places = np.empty(1 << 16, self.dtype), np.zeros(1 << 12, np.int64)

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _keep(self, pieces: pa.LargeStringArray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Numbers new pieces, whose ids lie one after another."""
        n = self.known.size
        begin = int(self.places[n])
        if begin + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:begin], np.empty(begin // 2 + len(ids) + (1 << 16), self.dtype)])
        if n + len(pieces) >= len(self.places):
            self.places = np.concatenate([self.places[: n + 1], np.zeros(n // 2 + len(pieces) + (1 << 14), np.int64)])
        self.ids[begin : begin + len(ids)] = ids
        self.places[n + 1 : n + 1 + len(pieces)] = begin + np.cumsum(sizes)
        self.known.add(pieces)

    @staticmethod
    def _joined(source: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The stretches of the source one after another."""
        ends = np.cumsum(sizes)
        return source[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _of(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Numbers of distinct pieces after a blank. A run of letters and the punctuation after it are tokens apart, so only
        new runs of letters are left to encode."""
        if self.known.size + 2 * len(pieces) > REMEMBERED:
            self._forget()
        out = self.known.find(pieces)
        missing = np.flatnonzero(out < 0)
        if not len(missing):
            return out
        new = pieces.take(pa.array(missing))
        parts = pc.extract_regex(new, _WORD_END)
        split = parts.is_valid()
        two, words, ends = new.filter(split), *(parts.filter(split).field(x) for x in ("word", "end"))
        whole = pa.concat_arrays([new.filter(pc.invert(split)), words]).unique()
        self._learn(whole.filter(pa.array(self.known.find(whole) < 0)))
        if len(two):
            ends = ends.dictionary_encode()
            texts = ends.dictionary.to_pylist()
            for e in set(texts) - self.ends.keys():
                self.ends[e] = self._ids(e)
            tails = [np.frombuffer(self.ends[e], self.dtype) for e in texts]
            begin = int(self.places[self.known.size])
            bounds = np.cumsum([begin, *map(len, tails)])
            of, at = self.known.find(words), ends.indices.to_numpy()
            # word, end, word, end
            begins = np.stack([self.places[of], bounds[at]], axis=1).ravel()
            sizes = np.stack([self.places[of + 1], bounds[at + 1]], axis=1).ravel() - begins
            ids = self._joined(np.concatenate([self.ids[:begin], *tails]), begins, sizes)
            self._keep(two, ids, sizes[::2] + sizes[1::2])
        out[missing] = self.known.find(new)
        return out

    def _learn(self, pieces: pa.LargeStringArray) -> None:
        """Many pieces are encoded as one text, whose ids are cut again before those that begin with a blank."""
        alone = pc.match_substring_regex(pieces, _ALONE)
        plain, rest = pieces.filter(pc.invert(alone)), [pieces.filter(alone)]
        for i in range(0, len(plain), JOINED):
            part = plain.slice(i, JOINED)
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part.to_pylist())], add_special_tokens=False)[0].ids, self.dtype)
            starts = np.flatnonzero(self.leads[ids])
            if len(starts) == len(part):
                self._keep(part, ids, np.diff(starts, append=len(ids)))
            else:
                rest.append(part)
        for part in rest:
            if len(part):
                ids = [np.frombuffer(self._ids(" " + p), self.dtype) for p in part.to_pylist()]
                self._keep(part, np.concatenate(ids), np.array([len(x) for x in ids]))

    def _first(self, piece: str) -> bytes:
        if len(self.first) > REMEMBERED:
            self.first = {}
        if piece not in self.first:
            self.first[piece] = self._ids(piece)
        return self.first[piece]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in the texts' order."""
        holds = [any(map(t.__contains__, self.added)) for t in texts]
        if not any(holds):
            return self._encode(texts)
        if not self.separate:  # added tokens that take or need something beside them
            found = iter(self._encode([t for t, h in zip(texts, holds) if not h]))
            return [self._ids(t) if h else next(found) for t, h in zip(texts, holds)]
        parts = [self.around.split(t) if h else [t] for t, h in zip(texts, holds)]
        found = iter(self._encode([x for part in parts for x in part[::2]]))
        return [b"".join(self._first(x) if k % 2 else next(found) for k, x in enumerate(part)) for part in parts]

    def _encode(self, texts: list[str]) -> list[bytes]:
        """`encode` of texts without added tokens."""
        column = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(column, _UNEVEN).to_pylist()
        lists = pc.split_pattern(column, " ")
        if any(uneven):
            lists = pa.array([_CUT.split(t) if u else x for x, u, t in zip(lists.to_pylist(), uneven, texts)], pa.large_list(pa.large_string()))
        if not len(lists):
            return []
        offsets, pieces = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        codes, distinct = pieces.indices.to_numpy(), pieces.dictionary
        starts = offsets[:-1]
        # the first piece of a text has no blank before it: its ids stand behind those of the other pieces
        inside = np.ones(len(codes), bool)
        inside[starts] = False
        used = np.zeros(len(distinct), bool)
        used[codes[inside]] = True
        numbers, wanted = np.zeros(len(distinct), np.int64), np.flatnonzero(used)
        numbers[wanted] = self._of(distinct.take(pa.array(wanted)))
        firsts = [np.frombuffer(self._first(p), self.dtype) for p in distinct.take(pa.array(codes[starts])).to_pylist()]
        known = self.known.size
        end = int(self.places[known])
        places = np.concatenate([self.places[: known + 1], end + np.cumsum([len(x) for x in firsts])])
        numbers = numbers[codes]
        numbers[starts] = known + np.arange(len(starts))
        sizes = places[numbers + 1] - places[numbers]
        out = self._joined(np.concatenate([self.ids[:end], *firsts]), places[numbers], sizes)
        ends = np.cumsum(sizes)
        bounds = [0, *ends[offsets[1:] - 1].tolist()]
        return [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def encoder(path: str) -> Encoder:
    return per_process(f"encoder:{path}", lambda: Encoder(path))


def encoded(texts: Iterable[str | None], path: str) -> Iterator[bytes]:
    """Ids of each text in turn; null is empty."""
    for run in runs(texts, 1 << 22):
        yield from encoder(path).encode(run)


def crc_of_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
