"""Byte-level BPE in linear time by backtracking over longest matches.

A token sequence is what BPE's merges give if and only if each adjacent pair is: the two tokens side
by side must themselves encode to those two tokens. So the encoder walks the bytes, takes the
longest vocabulary entry at each place (Aho-Corasick states over the vocabulary), checks it against
the last token in a pair-compatibility table, and falls back to shorter prefixes of the match; when
none fits it takes the last token back and marks the place as a dead end. Each place dies at most
once, which makes the walk linear in the length.

Texts are first cut by the vocabulary's public pre-tokenisation pattern. Short pieces repeat a lot,
so their encodings are kept per worker; long stretches without a break are encoded each time.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import regex

#: The pre-tokenisation pattern published with the vocabulary, its white space spelt out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}++| ?\p{{N}}++| ?[^{SPACE}\p{{L}}\p{{N}}]++|[{SPACE}]++$|[{SPACE}]+(?=[{SPACE}])|[{SPACE}]++"
#: Bytes of a piece up to which its encoding is kept, and the number of pieces kept in a worker.
KEEP_BYTES, KEEP_PIECES = 48, 400_000


def vocabulary(path: str) -> list[bytes]:
    """Tokens by id of a file with a base64 token and a rank in each line."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, open(path, "rb"))}
    return [ranks[i] for i in range(len(ranks))]


class Encoder:
    """Encoder and decoder for one vocabulary of mergeable byte strings in rank order."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.offsets = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self._tables()
        self.compatible: dict[int, bool] = {}
        self.find = regex.compile(PATTERN).findall
        self.cache = _Pieces(self)

    def _tables(self) -> None:
        """Longest proper prefix of each token, the pair each was merged from, and the merge of pairs."""
        ids = self.ids
        self.longest = max(map(len, self.tokens))
        self.shorter = [-1] * len(self.tokens)
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(self.tokens))]
        self.merge: dict[tuple[int, int], int] = {}
        for i, t in enumerate(self.tokens):
            self.shorter[i] = next((p for cut in range(len(t) - 1, 0, -1) if (p := ids.get(t[:cut])) is not None), -1)
        for i, t in enumerate(self.tokens):  # in rank order: the merges of lower ids are complete
            if len(t) == 1:
                continue
            # the last merge joins the prefix and suffix that stand side by side when only lower ranks merge
            prefix = self.shorter[i]
            while prefix >= 0:
                rest = ids.get(t[len(self.tokens[prefix]) :])
                if rest is not None and prefix < i and rest < i and self._pair(prefix, rest):
                    self.parts[i] = (prefix, rest)
                    self.merge[prefix, rest] = i
                    break
                prefix = self.shorter[prefix]
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()

    def _pair(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` side by side stay as they are.

        Undo the younger of the two again and again: if at some point the ends that touch would have
        merged before the younger one was made, the pair can't stand.
        """
        parts, merge = self.parts, self.merge
        bound = len(self.tokens) + 1
        while True:
            made = merge.get((left, right))
            if made is not None and made < bound:
                return False
            undo_left = left > right
            if undo_left and parts[left][0] == left:
                undo_left = False
            elif not undo_left and parts[right][0] == right:
                if parts[left][0] == left:
                    return True
                undo_left = True
            if undo_left:
                bound, left = left, parts[left][1]
            else:
                if parts[right][0] == right:
                    return True
                bound, right = right + 1, parts[right][0]

    def fits(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            known = self.compatible[key] = self._pair(left, right)
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        known = self.ids.get(data)
        if known is not None:
            return [known]
        n = len(data)
        longest = [0] * n
        for end, (i, size) in self.automaton.iter(data.decode("latin-1")):
            start = end - size + 1
            if size > 1:
                longest[start] = i + 1  # matches that begin at a place come in order of their ends
        ids, tokens, shorter, fits = self.ids, self.tokens, self.shorter, self.fits
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, (longest[0] - 1 if longest[0] else ids[data[:1]])
        while at < n:
            while True:
                end = at + len(tokens[token])
                if alive[end] and (not out or fits(out[-1], token)):
                    out.append(token)
                    at = end
                    if at < n:
                        token = longest[at] - 1 if longest[at] else ids[data[at : at + 1]]
                    break
                token = shorter[token]
                if token < 0:
                    alive[at] = 0
                    token = out.pop()
                    at -= len(tokens[token])
                    # the token taken back led to a dead end: its end is marked, a shorter one is next
        return out

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as consecutive 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.find(text)))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty or null one."""
        return np.frombuffer(self.encode_packed(text), np.int32).tolist() if text else []

    def pieces(self, text: str) -> list[str]:
        return self.find(text)

    def decode(self, ids) -> str:
        """Text of ids by the offset table: every byte's place in the blob of all tokens is computed at once."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        return self.blob[places].tobytes().decode("utf-8", "replace")


class _Pieces(dict):
    """Packed ids by piece; short ones are kept."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        # a lone surrogate can't be UTF-8; it counts as the replacement sign
        data = piece.encode("utf-8", "replace") if piece.isprintable() else piece.encode("utf-8", "surrogatepass").decode("utf-8", "replace").encode()
        packed = np.array(self.encoder.encode_bytes(data), np.int32).tobytes()
        if len(data) <= KEEP_BYTES:
            if len(self) >= KEEP_PIECES:
                self.clear()
            self[piece] = packed
        return packed


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one per worker process."""
    return Encoder(vocabulary(path))
