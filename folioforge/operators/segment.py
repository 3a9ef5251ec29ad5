"""Word segmentation: the most probable path through a lattice of dictionary words.

Runs of letters, which may be many words without a space, are cut into dictionary words and unknown words. A
dictionary word has the probability of its count; an unknown one that of one count, times those of its characters by their frequency in the
dictionary, times that of its length, which is geometric. Hashes find all dictionary words in a run;
the best path is found over the places of a run from left to right, an unknown word being a state of its own, so the
time is linear in the run and in the words found in it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.automaton import Hashed, streams
from folioforge.session import ship

#: Words of a lexicon, the commonest first; it goes to all executors.
MOST_WORDS = 500_000
#: Characters of the runs whose words a task remembers, and texts that it cuts together.
REMEMBERED, ROWS = 1 << 21, 256
RUN = r"[^\W\d_]+"


class Lexicon:
    """Log probabilities of words and characters."""

    def __init__(self, counts: dict[str, int]):
        counts = {w: n for w, n in counts.items() if w and n > 0}
        total = sum(counts.values()) + 1
        self.words = {w: math.log(n / total) for w, n in counts.items()}
        chars: dict[str, int] = {}
        for w, n in counts.items():
            for c in w:
                chars[c] = chars.get(c, 0) + n
        # one count is left for each character that the dictionary has, and one for all others
        every = sum(chars.values()) + len(chars) + 1
        stop = sum(counts.values()) / (sum(n * len(w) for w, n in counts.items()) + 1) if counts else 0.5
        stop = min(max(stop, 0.01), 0.9)
        self.chars = {c: math.log((n + 1) / every) + math.log(1 - stop) for c, n in chars.items()}
        self.other = math.log(1 / every) + math.log(1 - stop)
        self.begin = math.log(1 / total)
        self.end = math.log(stop)

    def unknown(self, word: str) -> float:
        """Of a word that isn't in the dictionary."""
        return self.begin + sum(self.chars.get(c, self.other) for c in word) + self.end


def lexicon(counts: DataFrame, word_col: str = "word", count_col: str = "n", most: int = MOST_WORDS) -> Lexicon:
    """From a table of words and counts; repeated words add up. Beyond ``most`` words the rarest are left out."""
    summed = counts.where(F.col(word_col) != "").groupBy(F.col(word_col).alias("w")).agg(F.sum(count_col).alias("n"))
    held = summed.where("n > 0").orderBy(F.desc("n"), "w").limit(most).toArrow()
    return Lexicon(dict(zip(held.column("w").to_pylist(), held.column("n").to_pylist(), strict=True)))


class Segmenter:
    """Cuts runs by a lexicon."""

    def __init__(self, held: Lexicon, run: str = RUN):
        self.held, self.run, self.remembered = held, re.compile(run), {}
        self.size = 0
        self.terms = sorted(held.words)
        coded = [t.encode() for t in self.terms]
        self.scores = [held.words[t] for t in self.terms]
        self.found = Hashed(coded)

    def learn(self, runs: list[str]) -> None:
        """The paths of runs, from now on remembered."""
        data = [r.encode() for r in runs]
        for own, starts, stream in streams(data):
            end, term = self.found.occurrences(stream)
            # bytes that begin a character, counted up to each place of the stream
            first = np.concatenate(([0], np.cumsum((np.frombuffer(stream, dtype=np.uint8) & 0xC0) != 0x80)))
            text = np.searchsorted(starts, end, side="left") - 1
            order = np.lexsort((term, end, text))
            end, term, text = first[end[order]], term[order].tolist(), text[order]
            cuts = np.searchsorted(text, np.arange(len(own) + 1)).tolist()
            place = (end - first[starts[text]]).tolist() if len(end) else []
            for k, a, b in zip(own, cuts, cuts[1:]):
                self.remembered[runs[k]] = self._path(runs[k], place[a:b], term[a:b])

    def _path(self, run: str, ends: list[int], terms: list[int]) -> list[str]:
        """Of equal paths the one whose last word is longest; a dictionary word goes before an unknown one."""
        held, n = self.held, len(run)
        best, came = [0.0] + [-math.inf] * n, [0] * (n + 1)
        unknown, since = -math.inf, 0  # the best path that is inside an unknown word, and where that began
        k = 0
        for j in range(1, n + 1):
            fresh = best[j - 1] + held.begin
            if fresh > unknown:
                unknown, since = fresh, j - 1
            unknown += held.chars.get(run[j - 1], held.other)
            top, at = unknown + held.end, since
            while k < len(ends) and ends[k] == j:
                start = j - len(self.terms[terms[k]])
                score = best[start] + self.scores[terms[k]]
                if score > top or score == top and start <= at:
                    top, at = score, start
                k += 1
            best[j], came[j] = top, at
        out, j = [], n
        while j:
            out.append(run[came[j] : j])
            j = came[j]
        return out[::-1]

    def __call__(self, texts: list[str | None]) -> list[list[str] | None]:
        runs = [None if t is None else self.run.findall(t) for t in texts]
        new = {r for own in runs if own for r in own} - self.remembered.keys()
        if sum(map(len, new)) + self.size > REMEMBERED:
            self.remembered.clear()
            self.size = 0
            new = {r for own in runs if own for r in own}
        if new:
            self.size += sum(map(len, new))
            self.learn(sorted(new))
        return [None if own is None else [w for r in own for w in self.remembered[r]] for own in runs]


def segmenter(spark, held: Lexicon, run: str = RUN) -> Callable[[Column], Column]:
    """A function from a text column to its words, an array of strings; null for null. It serves as a tokenizer of ``mining.tokens``."""
    ship(spark)
    sent, made = spark.sparkContext.broadcast(held), []

    def words(texts: pa.Array) -> pa.Array:
        if not made:  # once a task
            made.append(Segmenter(sent.value, run))
        kind = pa.list_(pa.string())
        lots = [pa.array(made[0](texts.slice(k, ROWS).to_pylist()), type=kind) for k in range(0, len(texts), ROWS)]
        return pa.concat_arrays(lots) if lots else pa.array([], type=kind)

    return F.arrow_udf(words, "array<string>")
