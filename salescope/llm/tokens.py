"""Token ids of whole texts with a public tokenizer file.

A byte-pair tokenizer splits a text into pieces before it merges, and always
at white space that follows a visible character. So a text is cut there, each
distinct cut is encoded once per worker, and the ids of the text are those of
its cuts, joined. Texts with white space beyond ASCII, or with the string of an
added token such as <|endoftext|>, are encoded as they are.
What a worker remembers is bounded and starts anew when full, which changes
nothing but the speed.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from .common import Words, span_hashes

#: distinct cuts that a worker remembers
REMEMBERED = 2_500_000
#: new cuts that are encoded as one text
_JOINED = 512


class Encoder:
    """Ids of texts, as the tokenizer gives them for each whole text: none are
    added to it, and the string of an added token is that token."""

    _made: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker's encoder for a file, kept between tasks."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # whether white space leaves no trace and case none: then cuts are lower-cased words
        self.bare = not self._ids(" \n ") and self._ids("Ab") == self._ids("ab")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # bytes of text that each id stands for: byte-level tokens have a character a byte
        vocab = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(token.removesuffix("</w>") if self.bare else token)
        self._forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        self.key = np.zeros(0, np.uint64)                    # sorted hashes of known cuts
        self.entry = np.zeros(0, np.int64)                   # their entries
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as uint32, row offsets into them) of an array without nulls."""
        w = Words(texts, lower=False, hashed=False)
        data, at, first = w.data, w.at, w.first
        rows = len(at) - 1
        start, end = w.start, w.end
        if not self.bare:
            # a cut takes the white space before its word; what follows the last word is a cut too
            start = np.concatenate([[0], end])[:len(end)]
            head = first[:-1][np.diff(first) > 0]
            start[head] = at[:-1][np.diff(first) > 0]
            done = np.where(np.diff(first) > 0, end[first[1:] - 1] if len(end) else 0, at[:-1])
            tail = done < at[1:]
            place = first[1:][tail]
            start, end = np.insert(start, place, done[tail]), np.insert(end, place, at[1:][tail])
            first = first + np.concatenate([[0], np.cumsum(tail)])
        hashes = span_hashes(data, start, end, lower=self.bare)
        inverse, unique = pd.factorize(hashes)
        sample = np.zeros(len(unique), np.int64)
        sample[inverse] = np.arange(len(hashes))
        order = np.argsort(unique)
        entry = np.zeros(len(unique), np.int64)
        entry[order] = self._entries(unique[order], sample[order], data, start, end)
        entry = entry[inverse]
        count = self.count[entry]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(self.start[entry] - total[:-1], count) + np.arange(total[-1])]
        offsets = total[first]
        odd = np.union1d(_odd_rows(data, at), self._added_rows(texts)).astype(np.int64)
        return self._redone(texts, ids, offsets, odd) if len(odd) else (ids, offsets)

    def _added_rows(self, texts: pa.Array) -> np.ndarray:
        """Rows with the string of an added token, in any case: cuts that are
        remembered by their lower case share an entry with it."""
        found = np.zeros(len(texts), bool)
        for content in self.added:
            found |= pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found)

    def _redone(self, texts: pa.Array, ids: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        for i in odd:
            each[i] = np.array(self._ids(texts[int(i)].as_py()), np.uint32)
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])

    def _entries(self, unique: np.ndarray, sample: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.key) + len(unique) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.key, unique)
        new = np.ones(len(unique), bool)
        inside = place < len(self.key)
        new[inside] = self.key[place[inside]] != unique[inside]
        if new.any():
            raw = data.tobytes()
            cuts = [raw[a:b].decode() for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())]
            known = len(self.start)
            self._learn(cuts)
            self.key = np.insert(self.key, place[new], unique[new])
            self.entry = np.insert(self.entry, place[new], known + np.arange(len(cuts)))
            place = np.searchsorted(self.key, unique)
        return self.entry[place]

    def _learn(self, cuts: list[str]) -> None:
        count = np.zeros(len(cuts), np.int64)
        if self.bare:
            together, alone = range(len(cuts)), []
        else:
            visible = [c[0].isspace() and not c[-1].isspace() for c in cuts]
            together = [i for i, v in enumerate(visible) if v]
            alone = [i for i, v in enumerate(visible) if not v]
        parts, order = [], []
        for lo in range(0, len(together), _JOINED):
            group = together[lo:lo + _JOINED]
            got = self._group([cuts[i] for i in group])
            if got is None:
                alone = [*alone, *group]
                continue
            parts.append(got[0])
            count[list(group)] = got[1]
            order.extend(group)
        for i in alone:
            ids = np.array(self._ids(cuts[i]), np.uint32)
            parts.append(ids)
            count[i] = len(ids)
            order.append(i)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        order = np.array(order, np.int64)
        start = np.zeros(len(cuts), np.int64)
        start[order] = self.used + np.cumsum(count[order]) - count[order]
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.used], np.zeros(max(len(ids), self.used) + 1, np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.start, self.count = np.concatenate([self.start, start]), np.concatenate([self.count, count])

    def _group(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Many cuts encoded as one text: (ids, ids of each cut); None where
        the places of the tokens do not tell the cuts apart."""
        if self.bare:
            text = " ".join(cuts)
            seen = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
            parts = seen.split(" ")
            if len(parts) != len(cuts):
                return None
        else:
            text, parts = "".join(cuts), cuts
        ids = np.array(self._ids(text), np.uint32)
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in parts])
        tokens = np.cumsum(self.size[ids])
        at = np.searchsorted(tokens, ends)
        if not len(tokens) or at[-1] >= len(tokens) or (tokens[at] != ends).any():
            return None
        return ids, np.diff(np.concatenate([[0], at + 1]))


def _odd_rows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows with white space beyond ASCII, or with the separators U+001C to
    U+001F, which not every pattern takes for white space."""
    found = np.flatnonzero((data >= 0x1C) & (data <= 0x1F) | (data == 0xC2) | (data >= 0xE1) & (data <= 0xE3))
    if not len(found):
        return found
    d = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = d[found].astype(np.int64), d[found + 1].astype(np.int64), d[found + 2].astype(np.int64)
    code = np.where(a < 0x20, a, np.where(a == 0xC2, b, (a & 15) << 12 | (b & 63) << 6 | c & 63))
    odd = (code <= 0x1F) | (code == 0x85) | (code == 0xA0) | (code == 0x1680) | (code >= 0x2000) & (code <= 0x200A)
    odd |= np.isin(code, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
    return np.unique(np.searchsorted(at, found[odd], "right") - 1)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)
