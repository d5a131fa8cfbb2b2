"""Token ids of whole texts with a public tokenizer file, faster than text by text.

The ids are the ``tokenizers`` library's. Its byte-level pre-tokenizer cuts a text into pieces that are encoded on their
own, so each distinct piece is encoded once per worker and then looked up, in arrays: Latin texts are cut and their pieces
found by numpy, on whole bytes, never by a hash alone.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .hashing import mix

#: Letters of Latin scripts; a text with any other letter, digit or white space goes to the library as a whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_ODD = re.compile(rf"[^\x20-\x7e\n{_LETTERS}]")
#: What the pre-tokenizer tells apart in such texts, by byte: letters, digits, other signs, white space.
_KIND = np.full(256, 2, np.uint8)
_KIND[[c for c in range(256) if c >= 128 or chr(c).isalpha()]] = 0
_KIND[48:58] = 1
_KIND[[10, 32]] = 3
#: Pieces that a worker remembers before it starts anew, the most bytes of one (a longer one has a dictionary), and pieces met at a time.
_MOST, _LONGEST, _AT_ONCE = 1_500_000, 24, 1 << 18
#: Masks of the first bytes of a long.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Texts with other characters are handed over in groups of about so many characters.
_GROUP = 1 << 20
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, added: bool = False):
        """added: what reads like an added token becomes its id, as the library does unless told otherwise."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = not added
        contents = sorted({t.content for t in self.model.get_added_tokens_decoder().values() if t.content}, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, contents))) if added and contents else None
        pre = str(self.model.pre_tokenizer)
        self.by_piece = pre.startswith("ByteLevel(") and "add_prefix_space=False" in pre and "use_regex=True" in pre and self.model.normalizer is None
        size = self.model.get_vocab_size()
        self.n_bytes = np.array([len(self.model.id_to_token(i) or "") for i in range(size)])
        self._forget()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        """An empty table of pieces: their bytes as longs, places of their ids in one array, and slots by hash."""
        self.n, self.n_ids = 0, 0
        self.keys = np.zeros((_LONGEST // 8, 1 << 16), np.uint64)
        self.at, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.slots = np.full(1 << 18, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[0]
        for more in keys[1:]:
            mixed = mix(mixed) ^ more
        return (mix(mixed) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for new ones."""
        out = np.full(keys.shape[1], -1, np.int64)
        todo, slot = np.arange(keys.shape[1]), self._hash(keys)
        while len(todo):
            found = self.slots[slot]
            same = found >= 0
            for own, asked in zip(self.keys, keys):
                same &= own[found] == asked[todo]
            out[todo[same]] = found[same]
            on = (found >= 0) & ~same
            todo, slot = todo[on], (slot[on] + 1) & (len(self.slots) - 1)
        return out

    def _place(self, first: int) -> None:
        """Gives the pieces from the first on a slot, all of them if the slots become more."""
        if 2 * self.n > len(self.slots):
            self.slots = np.full(4 * len(self.slots), -1, np.int32)
            first = 0
        todo = np.arange(first, self.n)
        todo = todo[self.keys[0, todo] != 0]
        slot = self._hash(self.keys[:, todo])
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            on = self.slots[slot] != todo
            todo, slot = todo[on], (slot[on] + 1) & (len(self.slots) - 1)

    def _add(self, pieces: list[bytes], keys: np.ndarray | None) -> np.ndarray:
        """Numbers of new pieces, whose ids are learned. Pieces without keys are found by the dictionary."""
        ids, counts = self._learn(pieces)
        first, n_ids = self.n, self.n_ids
        self.n, self.n_ids = first + len(pieces), n_ids + len(ids)
        if self.n > len(self.at):
            more = 2 * self.n
            self.keys = np.concatenate([self.keys[:, :first], np.zeros((len(self.keys), more - first), np.uint64)], axis=1)
            self.at, self.count = (np.concatenate([x[:first], np.zeros(more - first, np.int64)]) for x in (self.at, self.count))
        if self.n_ids > len(self.ids):
            self.ids = np.concatenate([self.ids[:n_ids], np.zeros(2 * self.n_ids - n_ids, np.uint32)])
        self.ids[n_ids : self.n_ids] = ids
        self.count[first : self.n] = counts
        self.at[first : self.n] = n_ids + np.cumsum(counts) - counts
        if keys is None:
            self.keys[:, first : self.n] = 0
            self.long.update(zip(pieces, range(first, self.n)))
            self.long_bytes += sum(map(len, pieces))
        else:
            self.keys[:, first : self.n] = keys
            self._place(first)
        return np.arange(first, self.n)

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pieces, one after another, and the number of each piece's ids.

        Pieces without white space, but for a space in front, keep their borders when joined, with a line feed before
        those that have no space there, so they go as one text.
        """
        out: list[np.ndarray | None] = [None] * len(pieces)
        joined = [k for k, p in enumerate(pieces) if not p.isspace()]
        parts = [pieces[k] if pieces[k][0] == 32 else b"\n" + pieces[k] for k in joined]
        text = b"".join(parts).decode()
        if joined and not (self.added and self.added.search(text)):
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.n_bytes[ids])
            upto = np.cumsum([len(p) for p in parts])
            own = np.array([pieces[k][0] != 32 for k in joined])
            last = np.minimum(np.searchsorted(ends, upto, "left") + 1, len(ends))
            start = np.append(0, last[:-1]) + own
            feeds = np.append(0, upto[:-1])[own] + 1
            if len(ids) and (ends[last - 1] == upto).all() and (ends[start[own] - 1] == feeds).all():
                if len(joined) == len(pieces):
                    feed = np.zeros(len(ids), bool)
                    feed[start[own] - 1] = True
                    return ids[~feed], last - start
                for k, i, j in zip(joined, start.tolist(), last.tolist()):
                    out[k] = ids[i:j]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, raw in zip(rest, self._whole([pieces[k].decode() for k in rest]) if rest else []):
            out[k] = np.frombuffer(raw, "<u4")
        return np.concatenate(out), np.array([len(ids) for ids in out], np.int64)

    def _met(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of UTF-8 text, one after another, and how many each has. At least 24 bytes follow the last piece."""
        base = start[0]
        data = data[base : start[-1] + size[-1] + _LONGEST]
        start = start - base
        longs = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
        keys = np.zeros((_LONGEST // 8, len(start)), np.uint64)
        keys[0] = longs[start] & _MASKS[np.minimum(size, 8)]
        for j in range(1, len(keys)):
            more = np.flatnonzero(size > 8 * j)
            keys[j, more] = longs[start[more] + 8 * j] & _MASKS[np.minimum(size[more] - 8 * j, 8)]
        short = size <= _LONGEST
        if self.n > _MOST or self.n_ids > 8 * _MOST or self.long_bytes > 8 * _MOST:
            self._forget()
        number = self._find(keys)
        new = np.flatnonzero((number < 0) & short)
        if len(new):
            order = np.lexsort(keys[:, new])
            sorted_ = keys[:, new[order]]
            change = np.append(True, (sorted_[:, 1:] != sorted_[:, :-1]).any(axis=0))
            heads = new[order[change]]
            raw = data.tobytes()
            added = self._add([raw[i : i + n] for i, n in zip(start[heads].tolist(), size[heads].tolist())], keys[:, heads])
            number[new[order]] = added[np.cumsum(change) - 1]
        far = np.flatnonzero(~short)
        if len(far):
            pieces = [data[i : i + n].tobytes() for i, n in zip(start[far].tolist(), size[far].tolist())]
            fresh = [p for p in dict.fromkeys(pieces) if p not in self.long]
            if fresh:
                self._add(fresh, None)
            number[far] = [self.long[p] for p in pieces]
        count = self.count[number]
        ends = np.cumsum(count)
        return self.ids[np.repeat(self.at[number] - ends + count, count) + np.arange(ends[-1])], count

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of Latin letters, digits and ASCII signs, from those of their pieces, as the pre-tokenizer cuts them."""
        raw = [t.encode() for t in texts]
        bounds = np.cumsum([0, *map(len, raw)])
        n = int(bounds[-1])
        if not n:
            return [b""] * len(texts)
        data = np.frombuffer(b"".join(raw) + bytes(_LONGEST), np.uint8)
        kind = _KIND[data[:n]]
        edge = np.zeros(n + 3, bool)
        edge[bounds] = True
        edge[n:] = True
        cut = edge.copy()
        cut[1:n] |= kind[1:] != kind[:-1]
        after = np.flatnonzero(cut[1:n] & ~edge[1:n] & (kind[:-1] == 3)) + 1
        cut[after - 1] = True
        cut[after[data[after - 1] == 32]] = False
        quote = np.flatnonzero((data[:n] == 39) & cut[:n])
        quote = quote[~edge[quote + 1]]
        one = quote[np.isin(data[quote + 1], np.frombuffer(b"stmd", np.uint8))]
        two = quote[~edge[quote + 2]]
        pair = data[two + 1].astype(np.int32) << 8 | data[two + 2]
        two = two[np.isin(pair, [p[0] << 8 | p[1] for p in (b"re", b"ve", b"ll")])]
        for found, letters in ((one, 1), (two, 2)):
            cut[found + 1] = False
            cut[found + 1 + letters] = True
        start = np.flatnonzero(cut[:n])
        size = np.diff(np.append(start, n))
        met = [self._met(data, start[k : k + _AT_ONCE], size[k : k + _AT_ONCE]) for k in range(0, len(start), _AT_ONCE)]
        ids = np.concatenate([m[0] for m in met]).astype("<u4").tobytes()
        ends = np.append(0, np.cumsum(np.concatenate([m[1] for m in met])))
        upto = (4 * ends[np.searchsorted(start, bounds)]).tolist()
        return [ids[i:j] for i, j in zip(upto, upto[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. What no text before had is encoded together, once for all texts given."""
        out: list[bytes] = [b""] * len(texts)
        odd = [k for k, text in enumerate(texts) if not self.by_piece or _ODD.search(text) or (self.added and self.added.search(text))]
        skip = set(odd)
        plain = [k for k in range(len(texts)) if k not in skip]
        for k, ids in zip(plain, self._by_piece([texts[k] for k in plain]) if plain else []):
            out[k] = ids
        group, size = [], 0
        for at, k in enumerate(odd, 1):
            group.append(k)
            size += len(texts[k])
            if size > _GROUP or at == len(odd):
                for i, ids in zip(group, self._whole([texts[i] for i in group])):
                    out[i] = ids
                group, size = [], 0
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, with the library's default for added tokens."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]


def encoded(path: str, column: pa.Array, chars: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """Ids of a text column in groups of about so many characters: (index of the first text, ids). Nulls are empty."""
    model, group, first, size = encoder(path), [], 0, 0
    for k, text in enumerate(column):
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= chars:
            yield first, model.encode(group)
            group, first, size = [], k + 1, 0
    if group:
        yield first, model.encode(group)
