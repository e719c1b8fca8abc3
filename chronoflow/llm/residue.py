"""Template residue and error-page text, by TF-IDF containment of labelled exemplars.

Labelled exemplars of residue (unfilled places, filler and draft text, error pages, notices that
scripts, cookies, a login or a check is needed; ``residue_labels``) are kept in an inverted index
from token to exemplars. A text's tokens retrieve the exemplars of which they hold a heavy token,
without which the threshold can't be met. For each, the share of the exemplar's TF-IDF mass that
lies within one window of the text is its containment. Texts with a containment of the threshold or
more are excluded.

Tokens are words and, where signs stand with them, the form of what stands between blanks: letters
as a, capitals as A, numbers as 0, so that ``${ruler}`` gives "ruler" and "${a}". Unfilled places are
exemplars like the others: a form counts for what the corpus makes it weigh.

The mass that containment is measured against is at least ``LEAST`` (what a token weighs that one
text in a hundred holds), so tokens that the corpus uses freely decide nothing alone, and at most
that of ``PASSAGE`` mean tokens of the exemplar, so a list of filler words need not stand whole.

There is one threshold for all exemplars. It is learned on each run with the corpus's weights: every
labelled text is scored against an index without it, every labelled look-alike against the whole
index, and the threshold lies where both are told apart best (see ``learn``).

Document frequencies come from the whole table: one pass counts the index's tokens (under two
thousand), a second scores every text.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoflow.llm import residue_labels as L

#: Tokens per window beyond those of the exemplar: room for names where it has "…", else for a stray sign or word.
SLACK, CLOSE = 14, 1
#: Least mass of an exemplar, and most, in mean tokens of it.
LEAST, PASSAGE = math.log(100), 7
#: Steps of the threshold.
GRID = 100

CHUNK = regex.compile(r"[\p{L}\p{N}_{}\[\]<>%$@#|=]+(?:\.[\p{L}\p{N}_]+[\p{L}\p{N}_{}\[\]<>%$@#|=]*)*")
WORD = regex.compile(r"[\p{L}\p{N}]+")
NAME = regex.compile(r"[\p{L}\p{N}]+(?:[_.]+[\p{L}\p{N}]+)*")


def _form(m: regex.Match) -> str:
    x = m.group()
    one = "0" if x.isdigit() else "A" if x.isupper() else "a"
    return f"{one}_{one}" if "_" in x else one


@functools.lru_cache(50_000)
def _chunk(chunk: str) -> tuple[str, ...]:
    words = tuple(w.lower() for w in WORD.findall(chunk))
    if chunk.isalnum():
        return words
    form = NAME.sub(_form, chunk)
    return words + (form,) if form.strip("aA0") not in ("", "_", ".") else words


def tokens(text: str) -> list[str]:
    """Words in small letters, and forms of what signs stand with."""
    return [t for chunk in CHUNK.findall(text) for t in _chunk(chunk)]


def exemplar_tokens(text: str) -> list[str]:
    """Tokens of an exemplar: "…" or NAME among signs stands for any name, of which only the form counts."""
    out = []
    for chunk in regex.findall(r"\S+", text):
        if regex.search(r"…|NAME", chunk) and regex.search(r"[{}\[\]<>%$@#_|=]", chunk):
            out += [t for t in tokens(chunk.replace("…", "qz")) if t not in ("qz", "name")]
        else:
            out += tokens(chunk.replace("…", " "))
    return out


class Index:
    """Inverted index of exemplars with the weights a corpus gives their tokens; ``need`` is the threshold."""

    def __init__(self, exemplars: tuple[str, ...], frequency: dict[str, int], texts: int, need: float):
        idf = lambda t: math.log((texts + 1) / (frequency.get(t, 0) + 1)) + 0.1
        least = min(LEAST, 0.5 * math.log(texts + 1))
        self.exemplars, self.rows = exemplars, []
        self.lists: dict[str, list[int]] = defaultdict(list)
        self.heads: dict[str, list[int]] = defaultdict(list)
        for n, text in enumerate(exemplars):
            own = defaultdict(int)
            for t in exemplar_tokens(text):
                own[t] += 1
            weights = {t: c * idf(t) for t, c in own.items()}
            size, whole = sum(own.values()), sum(weights.values())
            mass = max(least, min(whole, whole / max(size, 1) * PASSAGE))
            width = min(size, PASSAGE if size > 4 * PASSAGE else size) + (SLACK if "…" in text else CLOSE)
            self.rows.append((own, {t: idf(t) for t in own}, mass, width))
            # a match must hold one of the heaviest tokens: what the others weigh falls short of the threshold
            rest = whole
            for t in sorted(own, key=lambda t: (-weights[t], t)):
                if rest >= need * mass - 1e-9:
                    self.heads[t].append(n)
                rest -= weights[t]
                self.lists[t].append(n)

    def best(self, text: str, without: int = -1) -> tuple[float, int]:
        """(containment, exemplar) of the best window, below the threshold only as far as it was looked for."""
        found = tokens(text)
        hits = [(i, t) for i, t in enumerate(found) if t in self.lists]
        best, which = 0.0, -1
        for n in sorted({n for _, t in hits if t in self.heads for n in self.heads[t]}):
            if n == without:
                continue
            own, idf, mass, width = self.rows[n]
            first, held, inside = 0, 0.0, defaultdict(int)
            places = [(i, t) for i, t in hits if t in own]
            for i, t in places:
                inside[t] += 1
                if inside[t] <= own[t]:
                    held += idf[t]
                while places[first][0] <= i - width:
                    out = places[first][1]
                    if inside[out] <= own[out]:
                        held -= idf[out]
                    inside[out] -= 1
                    first += 1
                if held / mass > best:
                    best, which = held / mass, n
        return min(best, 1.0), which


def flat(labels: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(text for texts in labels.values() for text in texts))


def vocabulary(exemplars: tuple[str, ...]) -> frozenset[str]:
    return frozenset(t for text in exemplars for t in exemplar_tokens(text))


def held_out(exemplars: tuple[str, ...], frequency: dict[str, int], texts: int) -> list[float]:
    """Containment of every labelled text in the best exemplar but itself. Ways to write places, which have nothing in common, are left out."""
    index = Index(exemplars, frequency, texts, 0.0)
    return [index.best(text, n)[0] for n, text in enumerate(exemplars) if not regex.search(r"[{}\[\]<>%$@#_|=]", text)]


def learn(exemplars: tuple[str, ...], lookalikes: tuple[str, ...], frequency: dict[str, int], texts: int) -> float:
    """The threshold with the fewest errors, as shares of held-out residue and of look-alikes; the middle of the best."""
    index = Index(exemplars, frequency, texts, 0.0)
    good = [index.best(x)[0] for x in lookalikes]
    bad = held_out(exemplars, frequency, texts)
    errors = [sum(s < t for s in bad) / len(bad) + sum(s >= t for s in good) / max(len(good), 1) for t in (k / GRID for k in range(1, GRID + 1))]
    best = [k for k, e in enumerate(errors, 1) if e <= min(errors) + 1e-9]
    return best[len(best) // 2] / GRID


class Model:
    """Exemplars with the weights that a table gives their tokens, and the threshold. Small: it travels to the workers as it is."""

    def __init__(self, exemplars: tuple[str, ...], frequency: dict[str, int], texts: int, need: float):
        self.exemplars, self.frequency, self.texts, self.need = exemplars, tuple(sorted(frequency.items())), texts, need
        self._own: Index | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_own": None}

    @classmethod
    def fit(cls, df: DataFrame, text: str, labels: dict[str, tuple[str, ...]] | None = None, lookalikes: tuple[str, ...] = L.LOOKALIKES, threshold: float | None = None) -> Model:
        """Count the exemplars' tokens over all texts and learn the threshold from the labels unless one is given."""
        exemplars = flat(labels if labels is not None else L.labelled())
        words = vocabulary(exemplars)

        def count(batches):
            seen: dict[str, int] = defaultdict(int)
            for batch in batches:
                for t in batch.column(0).to_pylist():
                    if t:
                        seen[""] += 1
                        for w in words.intersection(tokens(t)):
                            seen[w] += 1
            yield pa.RecordBatch.from_pydict({"t": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        # as many rows as the exemplars have tokens
        counted = df.select(F.col(f"`{text}`").alias("x")).mapInArrow(count, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
        frequency = {r.t: r.n for r in counted.collect()}
        total = frequency.pop("", 0)
        return cls(exemplars, frequency, total, threshold if threshold is not None else learn(exemplars, lookalikes, frequency, total))

    def best(self, text: str) -> tuple[float, str] | None:
        """(containment, exemplar) of a text that is residue, else None."""
        if self._own is None:  # built once per task
            self._own = _index(self.exemplars, self.frequency, self.texts, self.need)
        score, n = self._own.best(text)
        return (score, self.exemplars[n]) if score >= self.need - 1e-9 else None


def residue(df: DataFrame, key: str, text: str, labels: dict[str, tuple[str, ...]] | None = None, lookalikes: tuple[str, ...] = L.LOOKALIKES, threshold: float | None = None) -> DataFrame:
    """Rows that are residue: ``key``, ``exemplar`` and ``coverage`` (its containment).

    The threshold is learned from the labels unless one is given. Null, empty and wordless texts give
    no row; repeated rows give one each; an empty table gives none. Whole texts are scored, however
    long; other columns are not read.
    """
    model = Model.fit(df, text, labels, lookalikes, threshold)
    narrow = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x"))

    def run(batches):
        for batch in batches:
            rows, which, coverage = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t and (hit := model.best(t)):
                    rows.append(i)
                    which.append(hit[1])
                    coverage.append(hit[0])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(which, pa.string()), pa.array(coverage, pa.float64())], ["k", "exemplar", "coverage"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, exemplar string, coverage double").select(F.col("k").alias(key), "exemplar", "coverage")


@functools.lru_cache(4)
def _index(exemplars, frequency, total, need) -> Index:
    return Index(exemplars, dict(frequency), total, need)
