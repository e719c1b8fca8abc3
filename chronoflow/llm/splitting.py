"""Splitting long texts at natural boundaries into pieces under a token limit, with overlap.

For each text the prefix sums of its tokens' lengths give the offset at which each token ends. Its
paragraph ends, sentence ends, clause ends and word ends are sorted arrays of token numbers. From a
piece's start the last boundary within the limit is found by binary search, strongest kind first; a
strong kind counts only if it leaves the piece at least half full. Where the text has no boundary
the piece is cut at the limit. The next piece starts ``overlap`` tokens before the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoflow.llm.bpe import Encoder, encoder

#: White space with a line break; with two or more it ends a paragraph.
BREAKS = regex.compile(r"[^\S\n\r]*(?:\r\n|\n|\r)\s*+")
#: Kinds of boundaries by pattern, after paragraphs and lines, strongest first: the match's end is the place of the cut.
SENTENCE = regex.compile(r"[.!?…][\p{Pe}\p{Pf}\"']*(?=\s)|[。！？｡]")
CLAUSE = regex.compile(r"[,;:–—](?=\s|$)|[、，；]")
SPACE = regex.compile(r"\s++")


#: All kinds, strongest first.
KINDS = ("paragraph", "line", "sentence", "clause", "word")


def boundaries(text: str, kind: str) -> list[int]:
    """Sorted places (characters) of one kind of boundary."""
    if kind == "paragraph":
        return [m.start() for m in BREAKS.finditer(text) if m.start() and (g := m.group()).count("\n") + g.count("\r") - g.count("\r\n") > 1]
    if kind == "line":
        return [m.start() for m in BREAKS.finditer(text) if m.start()]
    if kind == "word":
        return [m.start() for m in SPACE.finditer(text) if m.start()]
    return [m.end() for m in (SENTENCE if kind == "sentence" else CLAUSE).finditer(text)]


def token_ends(own: Encoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(character offset at which each token ends, whether the token ends between characters)."""
    ids = np.frombuffer(own.encode_packed(text), np.int32)
    ends = np.cumsum(own.offsets[ids + 1] - own.offsets[ids])
    if text.isascii():
        return ends, np.ones(len(ends), bool)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    lead = (data & 0xC0) != 0x80
    chars = np.cumsum(lead)
    whole = np.append(lead[1:], True)
    return chars[ends - 1], whole[ends - 1]


def cuts(own: Encoder, text: str, limit: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """Pieces (start, end, tokens, kind of the cut at the end) of a text, as character offsets."""
    ends, whole = token_ends(own, text)
    n = len(ends)
    if n <= limit:
        return [(0, len(text), n, "end")] if n else []
    # numbers of tokens after which a cut leaves whole characters
    places = np.flatnonzero(whole) + 1
    sought: dict[str, np.ndarray] = {}

    def tokens_before(kind: str) -> np.ndarray:
        if kind not in sought:  # weaker kinds are sought only in texts that need them
            at = np.array(boundaries(text, kind), np.int64)
            i = np.minimum(np.searchsorted(ends, at), n - 1)
            sought[kind] = i[(ends[i] == at) & whole[i]] + 1
        return sought[kind]

    out, start, done = [], 0, 0
    while True:
        begin = int(ends[start - 1]) if start else 0
        if n - start <= limit:
            out.append((begin, len(text), n - start, "end"))
            return out
        top, low = start + limit, max(start + overlap, done)
        end, kind = 0, "hard"
        for fill in (limit // 2, 0):
            for name in KINDS:
                at = tokens_before(name)
                i = np.searchsorted(at, top, "right") - 1
                if i >= 0 and at[i] > max(low, start + fill):
                    end, kind = int(at[i]), name
                    break
            if end:
                break
        if not end:
            i = np.searchsorted(places, top, "right") - 1
            end = int(places[i]) if i >= 0 else 0
            if end <= done:  # a character of several tokens right after the overlap: go on without it
                start = done
                continue
        out.append((begin, int(ends[end - 1]), end - start, kind))
        done = end
        i = np.searchsorted(places, end - overlap, "right") - 1
        back = int(places[i]) if i >= 0 else 0
        start = back if back > start else end


def split_texts(df: DataFrame, key: str, text: str, path: str, limit: int = 512, overlap: int = 64) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``stop`` (characters), ``tokens``, ``cut``, ``text``.

    A text within the limit is one piece; null and empty texts give none. A piece has at most
    ``limit`` tokens; consecutive pieces share ``overlap`` tokens, or the few more that a character of
    several tokens takes (none where a piece is no longer than the overlap). Repeated rows are split
    once each. Other columns are not read.
    """
    if not (0 <= overlap < limit and limit >= 8):
        raise ValueError("the limit must be 8 or more, the overlap from 0 to under it")
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))
    kind = narrow.schema["k"].dataType.simpleString()

    def run(batches):
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            step = 256  # long texts grow by their overlaps: hand them on in small batches
            for at in range(0, len(texts), step):
                rows, cols = [], ([], [], [], [], [], [])
                for i, t in enumerate(texts[at : at + step]):
                    for p, (start, stop, tokens, how) in enumerate(cuts(own, t, limit, overlap) if t else ()):
                        rows.append(at + i)
                        for col, v in zip(cols, (p, start, stop, tokens, how, t[start:stop])):
                            col.append(v)
                types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, y) for c, y in zip(cols, types))], ["k", "piece", "start", "stop", "tokens", "cut", "text"])

    out = narrow.mapInArrow(run, f"k {kind}, piece int, start int, stop int, tokens int, cut string, text string")
    return out.withColumnRenamed("k", key)
