"""Text decoded with the wrong character encoding: detection and repair of the damaged spans.

For every pair (written as, read as) the garbled sequences of the letters and signs of a repertoire are
computed once, and all of them go into one multi-pattern automaton, which decides every row:

* UTF-8 read in a one-byte encoding: a sequence of two to four signs a letter. Matches are taken
  leftmost and longest. A match is *hard* if it holds a sign that is no letter; that does not occur
  inside words. Matches of letters only are *soft*: they need a capital lead as UTF-8's first bytes give
  it, a neighbour (another match they touch), another accepted match in the text, or a text without any
  capital, whose garbled forms have lost theirs.
* One-byte Cyrillic read in another one-byte set: a sign a letter, so the sequences are letter pairs.
  Matches of one pair of encodings that overlap from end to end of a word make a candidate. Candidates
  of all pairs of encodings are weighed by how usual their letters and letter pairs are (of the
  corpus, with the letters' known frequencies as a prior) against the word as it stands; the pair of
  encodings that gains most over the text wins if it gains enough, and takes short words beside the others along.
* One-byte Western letters read in another one-byte set: the sequences are a small letter followed by
  a sign, a Greek letter or a capital in the place of a letter.
* Letters that were lost: replacement signs, question marks in the place of a letter, lead bytes at
  the end of the text.

Only accepted spans are replaced, so correct text around them stays as it is. Repair is repeated until
nothing is accepted any more, which undoes text that was misread any number of times.

A question mark stands for a lost letter if it touches the letters of a word; a single one does not if
it closes a question (its sentence begins with a question word) or begins the query of an address.
"""

from __future__ import annotations

import functools
import json
import math
from collections import defaultdict

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings as which UTF-8 is read. Soft matches count only for the first group.
COMMON = ("cp1252", "latin-1", "cp1250", "mac_roman", "cp1251")
OTHERS = ("cp1254", "cp1257", "iso8859-2", "iso8859-15", "cp437", "cp850", "koi8-r")
#: One-byte Cyrillic (written as, read as).
CYRILLIC = (("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp1251", "cp1252"), ("koi8-r", "cp1252"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1252"))
#: One-byte Western (written as, read as).
WESTERN = (("cp1252", "mac_roman"), ("cp1252", "cp437"), ("mac_roman", "cp1252"))
#: Letters and signs that texts are expected to hold (Latin, Greek, Cyrillic, punctuation), and those further off (more Latin, Hebrew, Arabic, currencies); for the commonest readings kana and Han too.
REPERTOIRE = [chr(c) for r in ((0x80, 0x180), (0x218, 0x21C), (0x384, 0x3CF), (0x400, 0x460), (0x490, 0x492), (0x2010, 0x2027), (0x2030, 0x203B)) for c in range(*r)] + ["№", "™", "−", "\ufffd", "\ufeff"]
FURTHER = [chr(c) for r in ((0x180, 0x218), (0x21C, 0x250), (0x5D0, 0x5EB), (0x621, 0x64B), (0x1E00, 0x1F00), (0x20A0, 0x20C0)) for c in range(*r)]
WIDE = [chr(c) for r in ((0x3001, 0x3003), (0x3041, 0x30FF), (0x4E00, 0xA000)) for c in range(*r)]
#: Letters by Unicode that sit in no word here: a match with one is hard. Quotes and dashes, which may follow any word.
SIGNS, TAILS = "ªºƒˆ", "“”’–—…"
LETTERS = [chr(c) for c in range(0x410, 0x450)] + ["Ё", "ё"]
ACCENTED = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
LEADS = "ÂÃÄÅÐÑĂĹ"
#: How often Russian has each letter, in hundredths of a percent.
FREQUENT = dict(zip("оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", (1097, 845, 801, 735, 670, 626, 547, 473, 454, 440, 349, 321, 298, 281, 262, 201, 190, 174, 170, 165, 159, 144, 121, 97, 94, 73, 64, 48, 36, 32, 26, 4, 4)))
#: Logarithms: what a sign that is no Cyrillic letter counts, a word in capitals, a word of mixed case; what a pair of encodings must gain over the text.
ODD, CAPITALS, MIXED, GAIN = -6.9, -1.0, -8.0, 6.0
#: Letters that the known frequencies count for beside the corpus's letter pairs.
PRIOR = 200
#: First words that make a sentence a question.
ASKING = regex.compile(r"(?i)^[^\p{L}]*(who|whom|whose|what|when|where|why|how|which|does|did|is|are|was|were|will|would|can|could|should|wer|was|wann|wo|warum|wie|welche[rs]?|qui|que|quoi|quand|où|pourquoi|comment|quien|quién|qué|cuándo|dónde|cómo)\b")


def misread(data: bytes, encoding: str) -> str | None:
    """Bytes read in a one-byte encoding; bytes it leaves undefined become control characters."""
    return "".join(map(_table(encoding).__getitem__, data))


@functools.cache
def _table(encoding: str) -> tuple[str, ...]:
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return tuple(out)


class Repair:
    """The automaton of all garbled sequences. ``pairs`` counts the letter pairs of the corpus's Cyrillic words."""

    def __init__(self, pairs: dict[str, int] | None = None):
        import ahocorasick

        forms: dict[str, dict] = defaultdict(dict)

        def add(form: str, original: str, case: bool, soft_ok: bool, encoding: str) -> None:
            hard = not form.isalpha() or any(c in SIGNS for c in form)
            if case and hard and form[-1] in TAILS:
                hard, soft_ok = False, True  # a small letter and a closing quote
            if form != original and len(form) > 1 and not form.isascii():
                # hard, soft, or soft only beside hard ones of its encoding
                rank = 2 if hard else 1 if soft_ok else 0
                own = forms[form].setdefault("utf-8", (rank, {}))
                if rank > own[0]:
                    own = forms[form]["utf-8"] = (rank, own[1])
                own[1].setdefault(encoding, original)

        # what was misread once may be misread again: all that the encodings can give
        usual = dict.fromkeys([*REPERTOIRE, *(misread(bytes([b]), e) for e in COMMON for b in range(0x80, 0x100))])
        rest = dict.fromkeys([*FURTHER, *(misread(bytes([b]), e) for e in OTHERS for b in range(0x80, 0x100))])
        plain = []
        for known in (usual, [c for c in rest if c not in usual]):
            for encoding in (*COMMON, *OTHERS):
                for ch in (*known, *WIDE) if known is not usual and encoding in COMMON[:2] else known:
                    form = misread(ch.encode("utf-8"), encoding)
                    # a form that ends in blank can't be told from text that has one there
                    if form.strip(" ") == form:
                        add(form, ch, False, encoding in COMMON, encoding)
                        plain.append((form, ch, encoding))
        for form, ch, encoding in plain:  # texts whose case was changed afterwards
            if ch.isalpha() and encoding in COMMON and ch < "\u0250":
                add(form.lower(), ch.lower(), True, True, encoding)
                if not form.upper().isalpha():
                    add(form.upper(), ch.upper(), True, False, encoding)
        self.back: dict[tuple[str, str], dict[int, str]] = {}
        for pair in CYRILLIC:
            own = {c: misread(c.encode(pair[0]), pair[1]) for c in LETTERS if self._writes(c, pair[0])}
            self.back[pair] = {ord(v): k for k, v in own.items()}
            for a, x in own.items():
                for b, y in own.items():
                    if not (a.islower() and b.isupper()):
                        forms[x + y].setdefault("byte", []).append(pair)
        for written, read in WESTERN:
            for ch in ACCENTED:
                if ch.islower() and self._writes(ch, written):
                    x = misread(ch.encode(written), read)
                    if len(x) == 1 and x != ch and not x.isascii() and not (x.islower() and x < "\u0250") and x not in "’“”‘—–…•·°":
                        for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
                            forms[c + x].setdefault("west", ch)
        letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x180))]
        forms["�"]["lost"] = "sign"
        for c in letters:
            forms["?" + c]["lost"] = "before"
            for end in " ,;)”’":
                forms[f"{c}?{end}"]["lost"] = "after"
        for lead in LEADS:
            for c in "abcdefghijklmnopqrstuvwxyz":
                forms[f"{c}{lead}\0"]["lost"] = "cut"
        for lead in ("â\0", "ã\0", "â€\0", "ã€\0"):
            forms[lead]["lost"] = "cut"
        self.automaton = ahocorasick.Automaton()
        for form, what in forms.items():
            self.automaton.add_word(form, (len(form), what))
        self.automaton.make_automaton()
        whole, first = defaultdict(int), defaultdict(int)
        for ab, n in (pairs or {}).items():
            whole[ab] += n
            first[ab[0]] += n
        total = sum(FREQUENT.values())
        self.letter = {c: math.log(n / total) for c, n in FREQUENT.items()}
        self.pair = {a + b: math.log((whole[a + b] + PRIOR * FREQUENT[b] / total) / (first[a] + PRIOR)) for a in FREQUENT for b in FREQUENT}

    @staticmethod
    def _writes(c: str, encoding: str) -> bool:
        try:
            c.encode(encoding)
        except UnicodeEncodeError:
            return False
        return True

    def _usual(self, word: str) -> float:
        """How usual a word's letters and pairs are (a logarithm)."""
        low = word.lower()
        out = sum(self.pair[a + b] if a + b in self.pair else ODD for a, b in zip(low, low[1:])) + self.letter.get(low[0], ODD)
        if not word[1:].islower() and len(word) > 1:
            out += CAPITALS if word.isupper() else MIXED
        return out

    def _words(self, text: str, hits: dict[tuple[str, str], list[int]]) -> list[tuple[int, int, str]]:
        """Spans of one-byte Cyrillic from the starts of its letter pairs, for the pair of encodings that gains most."""
        best: tuple[float, tuple, list] = (GAIN, (), [])
        for pair, starts in hits.items():
            runs, table = [], self.back[pair]
            for s in starts:
                if runs and runs[-1][1] == s + 1:
                    runs[-1][1] = s + 2
                elif not runs or runs[-1][1] <= s:
                    runs.append([s, s + 2])
            gain, spans, long = 0.0, [], False
            for s, e in runs:
                if s and text[s - 1].isalpha() or e < len(text) and text[e].isalpha():
                    continue
                word = text[s:e].translate(table)
                more = self._usual(word) - self._usual(text[s:e])
                if more > 0:
                    gain += more
                    spans.append((s, e, word))
                    long |= e - s > 2
            if long and gain > best[0]:
                best = (gain, pair, spans)
        _, pair, spans = best
        if not spans:
            return []
        # short words beside accepted ones
        table, out = self.back[pair], list(spans)
        for s, e, _ in spans:
            for at, step in ((s - 1, -1), (e, 1)):
                while 0 <= at < len(text) and text[at] in " -,.":
                    at += step
                one = at
                while 0 <= one < len(text) and ord(text[one]) in table and not text[one].isascii():
                    one += step
                lo, hi = (one + 1, at + 1) if step < 0 else (at, one)
                if 0 < hi - lo < 3 and not (lo and text[lo - 1].isalpha()) and not (hi < len(text) and text[hi].isalpha()) and not any(lo < b and a < hi for a, b, _ in out):
                    word = text[lo:hi].translate(table)
                    if self._usual(word) > self._usual(text[lo:hi]):
                        out.append((lo, hi, word))
        return out

    def _lost(self, text: str, hits: list[tuple[int, int, str]]) -> bool:
        """Whether letters are lost at one of the places found."""
        marks = set()
        for start, end, kind in hits:
            if kind in ("sign", "cut"):
                return True
            at = start if kind == "before" else start + 1
            if kind == "after" and not regex.match(r"[ ,;)”’]+[\w(“]", text[at + 1 :]):
                continue
            if regex.match(r"\?[\w.%-]+=", text[at:]):  # the query of an address
                continue
            marks.add(at)
        if len(marks) == 1:
            (at,) = marks
            sentence = regex.split(r"[.!?]\s", text[:at])[-1]
            return not ASKING.search(sentence)
        return bool(marks)

    def search(self, text: str) -> tuple[list[tuple[int, int, str]], bool]:
        """Damaged spans (start, end, original), without overlaps, and whether letters are lost."""
        best: dict[int, tuple] = {}
        pairs: dict[tuple[str, str], list[int]] = defaultdict(list)
        west, lost, soft, n = [], [], [], len(text)
        for last, (size, what) in self.automaton.iter(text + "\0"):
            start, end = last - size + 1, last + 1
            if "utf-8" in what:
                if not what["utf-8"][0]:
                    soft.append((start, end, what["utf-8"][1]))
                elif start not in best or best[start][0] < end:
                    best[start] = (end, *what["utf-8"])
            for pair in what.get("byte", ()):
                pairs[pair].append(start)
            if "west" in what:
                west.append((start + 1, end, what["west"]))
            if "lost" in what:
                lost.append((start, end, what["lost"]))
        chosen, at = [], 0
        for start in sorted(best):
            if start >= at:
                end, rank, originals = best[start]
                chosen.append((start, end, rank, originals))
                at = end
        out, waiting, small = [], [], text.islower()
        for i, (start, end, rank, originals) in enumerate(chosen):
            touches = (i and chosen[i - 1][1] == start) or (i + 1 < len(chosen) and chosen[i + 1][0] == end)
            if rank == 2 or touches or text[start] in LEADS or small and text[end - 1] not in TAILS:
                out.append((start, end, originals))
            else:
                waiting.append((start, end, originals))
        if out:
            out += waiting
        # the encoding that explains most of them decides what each stands for
        votes: dict[str, int] = defaultdict(int)
        for _, _, originals in out:
            for encoding in originals:
                votes[encoding] += 1
        order = sorted(votes, key=lambda e: -votes[e])
        taken = {i for s, e, _ in out for i in range(s, e)}
        if order and order[0] in OTHERS:
            for s, e, originals in sorted(soft, key=lambda x: (x[0], -x[1])):
                if order[0] in originals and taken.isdisjoint(range(s, e)):
                    out.append((s, e, originals))
                    taken.update(range(s, e))
        spans = []
        for s, e, originals in out:
            inside = s > 0 and text[s - 1].islower()  # of equal readings one without a capital inside the word
            spans.append((s, e, originals[min(originals, key=lambda k: (-votes[k], inside and originals[k].isupper()))]))
        for s, e, original in self._words(text, pairs) if pairs else ():
            if not taken.issuperset(range(s, e)):
                spans = [x for x in spans if x[1] <= s or x[0] >= e]
                spans.append((s, e, original))
                taken.update(range(s, e))
        if not spans:
            for s, e, original in west:
                if e < n and text[e] in "abcdefghijklmnopqrstuvwxyz" or text[s].isalpha() and not text[e : e + 1].isalpha() and text[s - 2 : s].islower() and s > 1:
                    spans.append((s, e, original))
        return sorted(spans), bool(lost) and self._lost(text, lost)

    def repair(self, text: str) -> tuple[str, bool, bool]:
        """(text with damaged spans restored, whether any was found, whether letters are lost)."""
        found, seen = False, set()
        while True:
            spans, lost = self.search(text)
            if not spans or text in seen:
                return text, found, lost or found and bool(STRAY.search(text))
            seen.add(text)
            found, parts, at = True, [], 0
            for start, end, original in spans:
                parts += [text[at:start], original]
                at = end
            text = "".join(parts) + text[at:]


#: Lead bytes left inside a word: what followed them is gone.
STRAY = regex.compile(rf"(?<=[a-z])[{LEADS}](?=[a-z ,.;)]|$)")
#: Signs without which nothing can be found.
SUSPECT = regex.compile(r"[^\x00-\x7f]|\?[\w ,;)]")


@functools.lru_cache(4)
def repairer(pairs: str = "{}") -> Repair:
    """One automaton per worker process."""
    return Repair(json.loads(pairs))


def letter_pairs(df: DataFrame, text: str) -> dict[str, int]:
    """How often letters follow each other in Cyrillic words of ordinary case: at most 33 x 33 counts."""
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"(?<![\p{L}])[А-Яа-яЁё][а-яё]+(?![\p{L}])"), F.lit(0))
    low = df.where(F.col(f"`{text}`").rlike("[а-я]{2}")).select(F.explode(words).alias("w")).select(F.lower("w").alias("w"))
    pairs = low.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("p"))
    return {r.p: r.n for r in pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}


def repair_encoding(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows whose text was decoded wrongly: ``key``, ``restored`` (text), ``complete`` (no letter is lost).

    Null, empty and intact texts give no row; repeated rows give one each; other columns are not
    read. Whole texts are searched. One pass counts letter pairs, a second repairs; nothing but the
    counts is shuffled.
    """
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))
    pairs = json.dumps(letter_pairs(narrow, "x"), sort_keys=True)

    def run(batches):
        own = repairer(pairs)
        for batch in batches:
            rows, restored, complete = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if not t or not SUSPECT.search(t):
                    continue
                fixed, found, lost = own.repair(t)
                if found or lost:
                    rows.append(i)
                    restored.append(fixed)
                    complete.append(not lost)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(restored, pa.string()), pa.array(complete, pa.bool_())], ["k", "restored", "complete"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, restored string, complete boolean").select(F.col("k").alias(key), "restored", "complete")
