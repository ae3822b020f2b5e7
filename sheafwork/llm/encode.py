"""Fast token ids: every distinct piece of text is encoded once by the tokenizers library.

The pre-tokenizers of the byte-level and of the word vocabulary never join a
character and the white space after it, nor a letter and an ASCII
character after it that is no letter. So a text may be cut there, and its ids
are the ids of the pieces, one after another. Pieces are kept in a hash table
(64-bit keys) that grows with them; past a bound it starts anew, and only the
pieces of one call can take it beyond. A new piece that is one word of letters goes to
the library's model, all others in one call to the whole tokenizer, between
special tokens. Texts with characters outside Latin-1, with unusual white
space or with special-token marks are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from sheafwork.llm.textops import byte_hashes, lower_ascii

#: Slots of a worker's table at first, and those beyond which it starts anew before it takes more pieces.
FIRST_SLOTS = 1 << 14
TABLE_SLOTS = 1 << 22

_letter = np.zeros(256, dtype=bool)
_letter[65:91] = _letter[97:123] = True
_ascii_other = np.zeros(256, dtype=bool)
_ascii_other[0x21:0x7F] = True
_ascii_other &= ~_letter
_plain = np.zeros(256, dtype=bool)
_plain[[0x0A, 0xC2, 0xC3]] = True
_plain[0x20:0x7F] = True
_plain[0x80:0xC0] = True

_word = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# Byte-level vocabularies spell bytes without a printable Latin-1 sign as U+0100 and on.
_shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_spelled = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _shown)}

_loaded: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


class PieceEncoder:
    def __init__(self, path: str, slots: int = TABLE_SLOTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special]
        self.mark_id, self.mark = max((i, t.content) for i, t in special)
        #: Lower-casing vocabularies here also drop white space.
        self.words_only = "Lowercase" in json.dumps(json.loads(self.tokenizer.to_str())["normalizer"])
        self.most_slots = slots
        self._clear()

    def _clear(self) -> None:
        self._make(min(FIRST_SLOTS, self.most_slots))
        self.ids = np.zeros(1 << 16, np.uint16)
        self.n_ids = self.n_keys = 0

    def _make(self, slots: int) -> None:
        self.slots = slots
        self.keys = np.zeros(slots, np.uint64)
        self.at = np.zeros(slots, np.int32)
        self.size = np.zeros(slots, np.int32)

    def _room(self, n: int) -> None:
        """At least three slots for each of ``n`` keys."""
        if 3 * n <= self.slots:
            return
        held = np.flatnonzero(self.keys)
        keys, at, size = self.keys[held], self.at[held], self.size[held]
        self._make(1 << int(3 * n - 1).bit_length())
        self._put(keys, at, size)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another (uint32), and the first id of each (n + 1)."""
        n = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        odd = self._odd_texts(data, offsets)
        original, data = data, lower_ascii(data) if self.words_only else data
        starts = self._cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        if odd.any():
            keep = ~odd[np.searchsorted(offsets, starts, "right") - 1]
            starts, ends = starts[keep], ends[keep]
        if self.words_only:
            starts, ends = self._without_space(data, starts, ends)
        flat, counts = self._lookup(data, starts, ends)
        doc = np.searchsorted(offsets, starts, "right") - 1
        sizes = np.bincount(doc, weights=counts, minlength=n).astype(np.int64)
        if odd.any():
            return self._with_odd(original, offsets, odd, flat, sizes)
        return flat.astype(np.uint32), np.append(0, np.cumsum(sizes))

    def _with_odd(self, data, offsets, odd, flat, sizes):
        which = np.flatnonzero(odd)
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in which]
        whole = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        first = np.append(0, np.cumsum(sizes))
        parts, last = [], 0
        for i, ids in zip(which, whole):
            parts += [flat[last : first[i]].astype(np.uint32), ids]
            last = first[i]
            sizes[i] = len(ids)
        parts.append(flat[last:].astype(np.uint32))
        return np.concatenate(parts), np.append(0, np.cumsum(sizes))

    def _odd_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bad = ~_plain[data]
        # C2 80 .. C2 A0 hold control characters and the no-break space.
        bad[:-1] |= (data[:-1] == 0xC2) & (data[1:] <= 0xA0)
        bad[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        at = np.flatnonzero(bad)
        odd = np.zeros(len(offsets) - 1, dtype=bool)
        odd[np.searchsorted(offsets, at, "right") - 1] = True
        return odd

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space = (data == 0x20) | (data == 0x0A)
        letter = _letter[data]
        # Latin-1 letters: C3 80 .. C3 BF without the signs for times and division.
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (~space[:-1] & space[1:]) | (letter[:-1] & _ascii_other[data[1:]])
        # A line end between two words is a piece; in a longer run it is not.
        cut[2:] |= ~space[:-2] & (data[1:-1] == 0x0A) & ~space[2:]
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def _without_space(self, data, starts, ends):
        """White space stands first in a piece; only what follows has ids."""
        kept = np.append(0, np.cumsum((data != 0x20) & (data != 0x0A)))
        size = kept[ends] - kept[starts]
        return (ends - size)[size > 0], ends[size > 0]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        mask = np.uint64(self.slots - 1)
        slot = (h & mask).astype(np.int64)
        found = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        while len(todo):
            have = self.keys[slot[todo]]
            hit = have == h[todo]
            found[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (have != 0)]
            slot[todo] = (slot[todo] + 1) & int(mask)
        return found

    def _lookup(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        h = byte_hashes(data, starts, ends)
        h[h == 0] = 1
        slot = self._find(h)
        if (slot < 0).any():
            missing = np.flatnonzero(slot < 0)
            new, pick = np.unique(h[missing], return_index=True)
            if self.n_keys and 3 * (self.n_keys + len(new)) > self.most_slots:
                self._clear()
                missing = np.arange(len(h))
                new, pick = np.unique(h, return_index=True)
            pick = missing[pick]
            grown = self.slots
            self._room(self.n_keys + len(new))
            self._add(new, [data[s:e].tobytes().decode() for s, e in zip(starts[pick], ends[pick])])
            if self.slots != grown:
                missing = np.arange(len(h))
            slot[missing] = self._find(h[missing])
        counts = self.size[slot].astype(np.int64)
        total = int(counts.sum())
        begin = np.cumsum(counts) - counts
        index = np.arange(total) + np.repeat(self.at[slot] - begin, counts)
        return self.ids[index], counts

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        one = self.tokenizer.model.tokenize
        found: list[list[int] | None] = []
        rest = []
        for piece in pieces:
            if _word.fullmatch(piece):
                if self.words_only:
                    piece = piece.lower()
                spelled = piece.encode().decode("latin-1").translate(_spelled)
                found.append([t.id for t in one(spelled)])
            else:
                found.append(None)
                rest.append(piece)
        if rest:
            ids = self.tokenizer.encode_batch_fast([self.mark.join(rest)], add_special_tokens=False)[0].ids
            groups: list[list[int]] = [[]]
            for i in ids:
                if i == self.mark_id:
                    groups.append([])
                else:
                    groups[-1].append(i)
            assert len(groups) == len(rest)
            others = iter(groups)
            found = [next(others) if f is None else f for f in found]
        sizes = np.array([len(f) for f in found], np.int64)
        return np.array([i for f in found for i in f], np.uint16), sizes

    def _add(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids, sizes = self._encode_pieces(pieces)
        at = self.n_ids + np.cumsum(sizes) - sizes
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self._put(keys, at, sizes)
        self.n_keys += len(keys)

    def _put(self, keys: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> None:
        """Open addressing: keys that meet in one slot go on to the next, round by round."""
        slot = (keys & np.uint64(self.slots - 1)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == 0
            _, one = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][one]
            self.keys[slot[put]] = keys[put]
            self.at[slot[put]], self.size[slot[put]] = at[put], sizes[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = np.where(self.keys[slot[todo]] == 0, slot[todo], (slot[todo] + 1) & (self.slots - 1))
