"""Whole texts to token ids, with the tokenizers library behind a memo of segments.

Texts are cut, in numpy over many texts at once, where no token can cross:
around white space as the vocabularies' patterns treat it, and between ASCII
characters of different classes (letters, digits, others) in words without an
apostrophe. A segment's ids are the same alone and in its text, so each worker
has a segment encoded once and keeps its ids, found by a 64-bit hash and proved
by a second one. Texts with other white space or control characters, where cuts
aren't safe, are encoded whole. New segments are encoded many to a string and
their ids told apart by a token's first character or word end; where the counts
disagree, one by one.

The memo is bounded by ``MEMO`` segments: when it is full, those not seen for
longest go, so it holds what is frequent and never grows with the input.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from siltmill.llm import words as W

MEMO, GROUP = 800_000, 64
_CLASS = np.array([0 if chr(b).isalpha() and b < 128 else 1 if 48 <= b <= 57 else 3 if b >= 128 or b == 39 else 2 for b in range(256)], np.int8)
_SPACE = np.isin(np.arange(256), [9, 10, 13, 32])
_CONTROL = np.isin(np.arange(256), [0, 11, 12, 28, 29, 30, 31])
_BARE = W.U(0x94D049BB133111EB)
_SECOND = {True: W.mix(W._VALUE ^ W.U(0xBF58476D1CE4E5B9)), False: W.mix(W._RAW_VALUE ^ W.U(0xBF58476D1CE4E5B9))}


def _odd(buf: np.ndarray, marks: bool) -> np.ndarray:
    """Places of characters around which cuts aren't safe: controls, white space beyond ASCII, joiners, and combining marks if asked for."""
    out = [np.flatnonzero(_CONTROL[buf])]
    p = np.flatnonzero((buf == 0xC2) | (buf >= 0xE1) & (buf <= 0xE3) | (buf == 0xEF) | (marks & ((buf == 0xCC) | (buf == 0xCD))))
    if len(p):
        a, b, c = buf[p], buf[np.minimum(p + 1, len(buf) - 1)], buf[np.minimum(p + 2, len(buf) - 1)]
        bad = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & ((b == 0x9A) & (c == 0x80) | (b == 0xA0) & (c == 0x8E)) | (a == 0xEF) & (b == 0xBB) & (c == 0xBF)
        bad |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8D) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & ((c == 0x9F) | (c == 0xA0))) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        bad |= (a == 0xCC) | (a == 0xCD)
        out.append(p[bad])
    return np.concatenate(out)


class Encoder:
    """Ids of texts; special tokens' strings are ordinary text."""

    lower = False

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.encode_special_tokens = True
        vocab = self.tk.get_vocab()
        self.size = max(vocab.values()) + 1
        self.flag = np.zeros(self.size, bool)
        for t, i in vocab.items():
            self.flag[i] = self._marked(t)
        self.keys, self.proof = np.zeros(0, W.U), np.zeros(0, W.U)
        self.at, self.n, self.seen = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)
        self.time = 0

    def _marked(self, token: str) -> bool:
        raise NotImplementedError

    def _segments(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and kinds of segments: 0 alone, 1 with a blank before, 2 white space."""
        raise NotImplementedError

    def one(self, text: str) -> np.ndarray:
        return np.array(self.tk.encode(text, add_special_tokens=False).ids, np.uint32)

    def _cuts(self, buf: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the parts of words (runs of ``inside`` bytes)."""
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        edge[1:-1] |= inside[1:] != inside[:-1]
        c = _CLASS[buf]
        turn = (c[1:] != c[:-1]) & (c[1:] < 3) & (c[:-1] < 3)
        quote = np.flatnonzero(buf == 39)
        if len(quote):
            # none in a word with an apostrophe
            at = np.flatnonzero(edge)
            word = np.searchsorted(at, quote, "right")
            held = np.zeros(len(at) + 1, bool)
            held[word] = True
            turns = np.flatnonzero(turn) + 1
            turn[turns[held[np.searchsorted(at, turns, "right")]] - 1] = False
        edge[1:-1] |= turn & inside[1:] & inside[:-1]
        at = np.flatnonzero(edge)
        at = at[at < len(buf)]
        end = np.append(at[1:], len(buf))
        own = inside[at]
        return at[own], end[own]

    def _sorts(self, parts: list[bytes], kinds: np.ndarray) -> list[tuple[np.ndarray, dict | None]]:
        """New segments in sorts that are encoded alike: which, and how ``_grouped`` takes them (None: one by one)."""
        raise NotImplementedError

    def _single(self, parts: list[bytes], blank: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments encoded one by one, one's behind another's, and how many each has."""
        texts = [" " * blank + p.decode("utf-8", "replace") for p in parts]
        got = [e.ids for e in self.tk.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)

    def _grouped(self, parts: list[bytes], lead: bytes = b"", between: bytes = b" ", drop: int | None = None, ends: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The same from groups that are encoded as one string each. A flagged id begins a segment or, with ``ends``, ends it; ``drop`` stands before each."""
        groups = [parts[i : i + GROUP] for i in range(0, len(parts), GROUP)]
        texts = [(lead + between.join(g)).decode("utf-8", "replace") for g in groups]
        every_id, every_n = [], []
        for group, e in zip(groups, self.tk.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            mark = ids == drop if drop is not None else self.flag[ids]
            at = np.flatnonzero(mark)
            if len(at) != len(group) or at[-1] != len(ids) - 1 if ends else len(at) != len(group) or at[0]:
                ids, n = self._single(group, blank=lead == b" ")
            else:
                n = np.diff(at, prepend=-1) if ends else np.diff(at, append=len(ids))
                if drop is not None:
                    ids, n = ids[~mark], n - 1
            every_id.append(ids)
            every_n.append(n)
        return np.concatenate(every_id), np.concatenate(every_n)

    def _learn(self, keys: np.ndarray, proof: np.ndarray, parts: list[bytes], kinds: np.ndarray) -> None:
        at, n, size = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), len(self.ids)
        held = [self.ids]
        for own, how in self._sorts(parts, kinds):
            if len(own):
                chosen = [parts[i] for i in own.tolist()]
                ids, k = self._single(chosen) if how is None else self._grouped(chosen, **how)
                n[own], at[own] = k, size + np.cumsum(k) - k
                size += len(ids)
                held.append(ids)
        self.ids = np.concatenate(held)
        place = np.searchsorted(self.keys, keys)
        put = lambda old, new: np.insert(old, place, new)
        self.keys, self.proof, self.at, self.n = put(self.keys, keys), put(self.proof, proof), put(self.at, at), put(self.n, n)
        self.seen = put(self.seen, self.time)

    def _shrink(self) -> None:
        """Keep the half that was seen last."""
        keep = np.sort(np.argsort(self.seen, kind="stable")[-(MEMO // 2) :])
        _, x = W.expand(self.at[keep], self.at[keep] + self.n[keep])
        self.ids, n = self.ids[x], self.n[keep]
        self.keys, self.proof, self.seen, self.n, self.at = self.keys[keep], self.proof[keep], self.seen[keep], n, np.cumsum(n) - n

    def _run(self, buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        count = len(offsets) - 1
        odd = np.zeros(count, bool)
        odd[np.searchsorted(offsets, _odd(buf, self.lower), "right") - 1] = True
        start, end, kind = self._segments(buf, offsets)
        on = ~odd[np.searchsorted(offsets, start, "right") - 1] if odd.any() else slice(None)
        start, end, kind = start[on], end[on], kind[on]
        key = W.hashes(buf, start, end, W._VALUE if self.lower else W._RAW_VALUE) ^ np.where(kind == 1, W.U(0), _BARE)
        self.time += 1
        if len(self.keys) > MEMO:
            self._shrink()
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        proof = W.hashes(buf, start[first], end[first], _SECOND[self.lower])
        place = np.searchsorted(self.keys, distinct)
        near = np.minimum(place, max(len(self.keys) - 1, 0))
        known = self.keys[near] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        if (bad := known & (self.proof[near] != proof) if len(self.keys) else known).any():  # two segments with one hash: texts with the new one are encoded whole
            odd[np.searchsorted(offsets, start[bad[inverse]], "right") - 1] = True
        if not known.all():
            new = np.flatnonzero(~known)
            raw = (W.LOWER[buf] if self.lower else buf).tobytes()
            parts = [raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            self._learn(distinct[new], proof[new], parts, kind[first[new]])
            place = np.searchsorted(self.keys, distinct)
        self.seen[place] = self.time
        entry = place[inverse]
        n = self.n[entry]
        _, x = W.expand(self.at[entry], self.at[entry] + n)
        ids = self.ids[x]
        cut = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(start, offsets)]
        out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.one(buf[offsets[i] : offsets[i + 1]].tobytes().decode())
        return out

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, ids of each text) of runs of texts; a null is an empty text."""
        buf, offsets = W.buffer_of(texts)
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + W.CHUNK, "right")) - 1)
            part = buf[offsets[i] : offsets[j]]
            yield i, self._run(part, offsets[i : j + 1] - offsets[i]) if len(part) else [np.zeros(0, np.uint32)] * (j - i)
            i = j


class ByteLevel(Encoder):
    """Keeps white space: a blank before a word is the word's, other white space stands alone."""

    def _marked(self, token: str) -> bool:
        return token.startswith("Ġ")

    def _segments(self, buf, offsets):
        blank = _SPACE[buf]
        start, end = self._cuts(buf, ~blank, offsets)
        text_start = np.zeros(len(buf) + 1, bool)
        text_start[offsets] = True
        led = (start > 0) & ~text_start[start]
        kind = np.where(led & (buf[np.maximum(start - 1, 0)] == 32), 1, 0)
        # white space runs: all of one at a text's end; else all but the last character, and that one unless it is a blank
        edge = np.zeros(len(buf) + 1, bool)
        edge[1:-1] = blank[1:] != blank[:-1]
        edge |= text_start
        at = np.flatnonzero(edge)
        at = at[at < len(buf)]
        close = np.append(at[1:], len(buf))
        own = blank[at]
        a, b = at[own], close[own]
        last = text_start[b] | (b == len(buf))
        body_end = np.where(last, b, b - 1)
        tail = ~last & (buf[b - 1] != 32)
        body = body_end > a
        starts = np.concatenate([start, a[body], b[tail] - 1])
        ends = np.concatenate([end, body_end[body], b[tail]])
        kinds = np.concatenate([kind, np.full(int(body.sum()) + int(tail.sum()), 2)])
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order], kinds[order]

    def _sorts(self, parts, kinds):
        newline = int(self.one("\n")[0])
        return [(np.flatnonzero(kinds == 0), {"lead": b"\n", "between": b"\n", "drop": newline}), (np.flatnonzero(kinds == 1), {"lead": b" "}), (np.flatnonzero(kinds == 2), None)]


class WordEnds(Encoder):
    """Drops white space and lower-cases; ASCII letters are lower-cased before, as no mark follows them that they could compose with."""

    lower = True

    def _marked(self, token: str) -> bool:
        return token.endswith("</w>")

    def _segments(self, buf, offsets):
        start, end = self._cuts(buf, ~_SPACE[buf], offsets)
        return start, end, np.zeros(len(start), np.int64)

    def _sorts(self, parts, kinds):
        plain = np.array([p.isalpha() or not p.isascii() and p.decode("utf-8", "replace").isalpha() for p in parts])
        return [(np.flatnonzero(plain), {"ends": True}), (np.flatnonzero(~plain), None)]


_HELD: dict[tuple[str, str], Encoder] = {}


def encoder(kind: type[Encoder], path: str) -> Encoder:
    """This worker's encoder of a vocabulary file, kept over its tasks."""
    key = (kind.__name__, path)
    if key not in _HELD:
        _HELD[key] = kind(path)
    return _HELD[key]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
