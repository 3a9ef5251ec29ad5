"""Name recognition: an averaged structured perceptron with Viterbi decoding, trained on texts that a glossary labels.

A glossary of (term, kind) labels the texts that hold its terms, and the perceptron learns what names look like and what
stands around them, so it finds names that the glossary lacks. Training is by iterative parameter mixing over all texts:
they are dealt to parts by a hash of their id, more parts where there are more texts; in each round every part starts from
the mixed weights, goes over its texts once, and the parts' weights are averaged. What is summed over the parts are whole numbers,
so weights are the same in every run. Weights have a fixed size, whatever the number of texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import ship

TOKEN = re.compile(r"\w+(?:['’]\w+)*|[^\w\s]")
#: Where a sentence ends, and how long one may be.
_END, LONGEST = frozenset(".!?\n"), 200
BUCKETS = 1 << 16
#: Sentences that a learner decodes side by side before it moves its weights, and characters of a part at most, about.
SIDE, PART = 64, 16_000_000


def sentences(text: str) -> Iterator[list[tuple[str, int, int]]]:
    """(token, start, end) by sentence."""
    own: list[tuple[str, int, int]] = []
    at = 0
    for m in TOKEN.finditer(text):
        if own and (len(own) >= LONGEST or "\n" in text[at : m.start()]):
            yield own
            own = []
        own.append((m[0], m.start(), m.end()))
        at = m.end()
        if m[0] in _END:
            yield own
            own = []
    if own:
        yield own


def shape(token: str) -> str:
    """Kinds of characters, runs of one kind as one."""
    return re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in token[:32]))


def feature_table(tokens: list[str]) -> np.ndarray:
    """Hashed features, a row a token."""
    shapes, low = ["^", *map(shape, tokens), "$"], ["^", *(t.lower() for t in tokens), "$"]
    rows = []
    for i, token in enumerate(tokens, 1):
        names = (
            "b", f"w{low[i]}", f"s{shapes[i]}", f"p{token[:3]}", f"e{token[-3:]}", f"l{low[i - 1]}", f"r{low[i + 1]}", f"k{shapes[i - 1]}/{shapes[i]}", f"n{shapes[i]}/{shapes[i + 1]}",
            f"L{low[i - 1]}/{shapes[i]}", f"R{low[i + 1]}/{shapes[i]}", f"f{i == 1}/{shapes[i]}",
        )
        rows.append([zlib.crc32(n.encode()) % BUCKETS for n in names])
    return np.array(rows, dtype=np.int64).reshape(len(tokens), -1)


@dataclass
class Model:
    """Tags are "O" and, for each kind, its beginning (B-kind) and inside (I-kind)."""

    kinds: tuple[str, ...]
    emit: np.ndarray
    step: np.ndarray

    @property
    def tags(self) -> list[str]:
        return ["O", *(f"{p}-{k}" for k in self.kinds for p in "BI")]


def blank(kinds: tuple[str, ...]) -> Model:
    n = 1 + 2 * len(kinds)
    return Model(kinds, np.zeros((BUCKETS, n)), np.zeros((n + 1, n)))  # the last row: before the first token


def allowed(n: int) -> np.ndarray:
    """Steps that the tags allow: the inside of a kind follows its beginning or inside."""
    out = np.zeros((n + 1, n))
    for inside in range(2, n, 2):
        out[:, inside] = -np.inf
        out[[inside - 1, inside], inside] = 0
    return out


def decode(emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best tags by Viterbi; of equals the first. emit: a row a token. step: scores with ``allowed`` added."""
    best, came = step[-1] + emit[0], []
    inner = step[:-1]
    for row in emit[1:]:
        score = best[:, None] + inner
        came.append(score.argmax(axis=0))
        best = score.max(axis=0) + row
    out = [int(best.argmax())]
    for back in reversed(came):
        out.append(int(back[out[-1]]))
    return np.array(out[::-1], dtype=np.int64)


def side_by_side(emit: np.ndarray, begin: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> np.ndarray:
    """As ``decode``, sentence beside sentence, the longest first; tags of all tokens."""
    order = np.argsort(-sizes, kind="stable")
    at, left = begin[order], -sizes[order]
    best, inner = step[-1] + emit[at], step[:-1]
    came = []
    for k in range(1, int(sizes.max(initial=1))):
        n = int(np.searchsorted(left, -k, side="left"))  # sentences of more than k tokens
        score = best[:n, :, None] + inner
        came.append(score.argmax(axis=1))
        best[:n] = score.max(axis=1) + emit[at[:n] + k]
    tag, flat = best.argmax(axis=1), np.zeros(len(emit), dtype=np.int64)
    for k in range(len(came), 0, -1):
        n = len(came[k - 1])
        flat[at[:n] + k] = tag[:n]
        tag[:n] = came[k - 1][np.arange(n), tag[:n]]
    flat[at] = tag
    return flat


class Glossary:
    """Finds terms among tokens: at each place the longest."""

    def __init__(self, terms: list[tuple[str, str]]):
        self.by_first: dict[str, list[tuple[list[str], str]]] = {}
        for term, kind in sorted(terms):
            tokens = TOKEN.findall(term)
            if tokens:
                self.by_first.setdefault(tokens[0], []).append((tokens, kind))
        for own in self.by_first.values():
            own.sort(key=lambda x: -len(x[0]))

    def tags(self, tokens: list[str], number: dict[str, int]) -> np.ndarray:
        out, i = np.zeros(len(tokens), dtype=np.int64), 0
        while i < len(tokens):
            for own, kind in self.by_first.get(tokens[i], ()):
                if tokens[i : i + len(own)] == own:
                    out[i] = number[f"B-{kind}"]
                    out[i + 1 : i + len(own)] = number[f"I-{kind}"]
                    i += len(own) - 1
                    break
            i += 1
        return out


class Learner:
    """One pass of the averaged perceptron. Sums of weights over time come from what each update is worth to the end."""

    def __init__(self, model: Model):
        self.model = Model(model.kinds, model.emit.copy(), model.step.copy())
        self.emit_sum, self.step_sum = np.zeros_like(model.emit), np.zeros_like(model.step)
        self.ok, self.n = allowed(model.step.shape[1]), 0

    def see(self, table: np.ndarray, tags: np.ndarray, begin: np.ndarray | None = None, sizes: np.ndarray | None = None) -> None:
        """A sentence, or sentences that begin at ``begin``: all are decoded by the weights as they are, then these move."""
        emit, step = self.model.emit, self.model.step
        begin, sizes = (np.array([0]), np.array([len(tags)])) if begin is None else (begin, sizes)
        got = side_by_side(emit[table].sum(axis=1), begin, sizes, step + self.ok)
        if (got != tags).any():
            wrong = np.flatnonzero(got != tags)
            for own, sign in ((tags, 1.0), (got, -1.0)):
                rows = table[wrong].ravel()
                at = np.repeat(own[wrong], table.shape[1])
                before = np.concatenate(([0], own[:-1]))
                before[begin] = len(self.model.step) - 1
                for held, summed, place in ((emit, self.emit_sum, (rows, at)), (step, self.step_sum, (before, own))):
                    np.add.at(held, place, sign)
                    np.add.at(summed, place, sign * self.n)
        self.n += 1

    def mean(self) -> Model:
        """The weights' average over the pass."""
        n = max(1, self.n)
        return Model(self.model.kinds, self.model.emit - self.emit_sum / n, self.model.step - self.step_sum / n)


def fit(texts: DataFrame, glossary: DataFrame, *, id_col: str, text_col: str = "text", parts: int = 8, rounds: int = 5, terms: int = 200_000) -> Model:
    """Trains on all texts: on every sentence that holds a term and, to balance the tags, for each the next one that doesn't.

    glossary: (term, kind); beyond ``terms`` rows it is refused. There are ``parts`` parts, or one for each ``PART`` characters. The
    driver gets a row for each weight that moved, whatever the number of texts and parts.
    """
    spark = texts.sparkSession
    ship(spark)
    rows = glossary.where("term is not null and kind is not null").select("term", "kind").distinct().limit(terms + 1).collect()
    if len(rows) > terms:
        raise ValueError(f"a glossary of over {terms} terms")
    kinds = tuple(sorted({r["kind"] for r in rows}))
    held = spark.sparkContext.broadcast(sorted((r["term"], r["kind"]) for r in rows))
    whole = texts.where(F.col(text_col).isNotNull())
    parts = max(parts, (whole.agg(F.sum(F.length(text_col))).first()[0] or 0) // PART + 1)
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    own = whole.select(key.alias("key"), F.col(text_col).alias("text")).withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))
    dealt = own.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "text")
    model = blank(kinds)
    total = Model(kinds, np.zeros_like(model.emit), np.zeros_like(model.step))
    made = pa.schema([("at", pa.int64()), ("end", pa.int64()), ("mean", pa.int64())])
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, number = Glossary(held.value), {t: k for k, t in enumerate(sent.value.tags)}
            learner, part, reader = None, None, Reader(sent.value)
            found: list[list[tuple[str, int, int]]] = []
            own_tags: list[np.ndarray] = []
            tokens = spare = 0

            def learn() -> None:
                nonlocal tokens
                if found:
                    table, begin, sizes = reader.table(found)
                    tags = np.concatenate(own_tags)
                    for k in range(0, len(found), SIDE):
                        own, size = begin[k : k + SIDE], sizes[k : k + SIDE]
                        a, z = own[0], own[-1] + size[-1]
                        learner.see(table[a:z], tags[a:z], own - a, size)
                found.clear()
                own_tags.clear()
                tokens = 0

            for batch in batches:
                for p, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    if p != part:
                        if learner is not None:
                            learn()
                            yield from _moved(learner, sent.value, made)
                        learner, part, spare = Learner(sent.value), p, 0
                    for sentence in sentences(text):
                        tags = names.tags([t for t, _, _ in sentence], number)
                        held_one = bool(tags.any())
                        if not held_one and not spare:
                            continue
                        spare += 1 if held_one else -1
                        found.append(sentence)
                        own_tags.append(tags)
                        tokens += len(sentence)
                        if tokens >= Reader.TOKENS:
                            learn()
            if learner is not None:
                learn()
                yield from _moved(learner, sent.value, made)

        sums = dealt.mapInArrow(run, "at long, end long, mean long").groupBy("at").agg(F.sum("end").alias("end"), F.sum("mean").alias("mean")).toArrow()
        at, end, mean = (sums.column(c).to_numpy() for c in ("at", "end", "mean"))
        seen = at < 0
        if not seen.any():
            return model
        learners, steps = int(end[seen][0]), int(mean[seen][0])
        start, total = model, _plus(total, 1 / rounds, model)
        model = _plus(start, 1 / learners, at=at[~seen], by=end[~seen])
        total = _plus(total, 1 / (rounds * steps), at=at[~seen], by=mean[~seen])
    return total


def _moved(learner: Learner, start: Model, made: pa.Schema) -> Iterator[pa.RecordBatch]:
    """By weight how far it is from the start at the end, and on average times the steps: whole numbers; at -1 the learner and its steps."""
    if learner.n:
        flat = lambda m: np.concatenate((m.emit.ravel(), m.step.ravel()))
        end = np.rint(flat(learner.model) - flat(start)).astype(np.int64)
        mean = learner.n * end - np.concatenate((learner.emit_sum.ravel(), learner.step_sum.ravel())).astype(np.int64)
        at = np.flatnonzero((end != 0) | (mean != 0))
        columns = (np.append(at, -1), np.append(end[at], 1), np.append(mean[at], learner.n))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], schema=made)


def _plus(model: Model, share: float, other: Model | None = None, *, at: np.ndarray | None = None, by: np.ndarray | None = None) -> Model:
    """The model with a share of another, or of what ``by`` has for the weights ``at``, added."""
    if other is not None:
        return Model(model.kinds, model.emit + other.emit * share, model.step + other.step * share)
    flat = np.concatenate((model.emit.ravel(), model.step.ravel()))
    flat[at] += by * share
    return Model(model.kinds, flat[: model.emit.size].reshape(model.emit.shape), flat[model.emit.size :].reshape(model.step.shape))


def names_in(text: str, model: Model, ok: np.ndarray | None = None) -> list[tuple[str, str, int, int]]:
    """(name, kind, start, end) in the text."""
    ok = allowed(model.step.shape[1]) if ok is None else ok
    out = []
    for sentence in sentences(text):
        tags = decode(model.emit[feature_table([t for t, _, _ in sentence])].sum(axis=1), model.step + ok)
        out.extend(_spans(text, model, sentence, tags))
    return out


def _spans(text: str, model: Model, sentence: list[tuple[str, int, int]], tags: np.ndarray) -> Iterator[tuple[str, str, int, int]]:
    first = None
    for i, tag in enumerate([*tags.tolist(), 0]):
        if first is not None and (tag == 0 or tag % 2 == 1):
            a, b = sentence[first][1], sentence[i - 1][2]
            yield text[a:b], model.kinds[(tags[first] - 1) // 2], a, b
            first = None
        if tag and tag % 2 == 1:
            first = i


class Reader:
    """``names_in`` of many texts at a time: words and pairs of words have their features hashed once, and sentences are decoded side by side.

    Weights add up in the order of ``feature_table``, so sums are the same to the last bit.
    """

    #: Words that are remembered, and tokens that are decoded together.
    MOST, TOKENS = 50_000, 100_000

    def __init__(self, model: Model):
        self.model, self.ok = model, allowed(model.step.shape[1])
        self.words: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.words.clear()
        self.held, self.own, self.low, self.shape = [], [], [], []  # by word: what its own features weigh, these, its lower case, its shape
        self.lows, self.shapes, self.pairs = {}, {}, {}
        self.low_names, self.shape_names = [], []
        for mark in "^$":  # before and after a sentence
            self._word(mark, mark, mark)

    def _word(self, token: str, low: str, kind: str) -> int:
        own = [zlib.crc32(name.encode()) % BUCKETS for name in ("b", f"w{low}", f"s{kind}", f"p{token[:3]}", f"e{token[-3:]}")]
        held = self.model.emit[own[0]]
        for at in own[1:]:
            held = held + self.model.emit[at]
        self.held.append(held)
        self.own.append(own)
        for value, known, names, out in ((low, self.lows, self.low_names, self.low), (kind, self.shapes, self.shape_names, self.shape)):
            if value not in known:
                known[value] = len(names)
                names.append(value)
            out.append(known[value])
        return len(self.held) - 1

    def word(self, token: str) -> int:
        at = self.words.get(token)
        if at is None:
            at = self.words[token] = self._word(token, token.lower(), shape(token))
        return at

    def _pairs(self, kind: str, first: np.ndarray, second: np.ndarray, n: int, name: Callable[[int, int], str]) -> np.ndarray:
        """The feature that each pair of numbers names; ``second`` is below ``n``."""
        pairs, at = np.unique(first.astype(np.int64) * n + second, return_inverse=True)
        known, rows = self.pairs, []
        for pair in pairs.tolist():
            a, b = divmod(pair, n)
            key = (kind, a, b)
            if key not in known:
                known[key] = zlib.crc32(name(a, b).encode()) % BUCKETS
            rows.append(known[key])
        return np.array(rows, dtype=np.int64)[at]

    def _columns(self, found: list[list[tuple[str, int, int]]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Of sentences, which aren't empty: words by number, features of pairs, where sentences begin, their sizes."""
        if len(self.words) > self.MOST or len(self.pairs) > 4 * self.MOST:
            self.forget()
        sizes = np.array([len(s) for s in found], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        word = np.fromiter((self.word(t) for s in found for t, _, _ in s), dtype=np.int64, count=int(sizes.sum()))
        last = begin + sizes - 1
        before, after = np.concatenate(([0], word[:-1])), np.concatenate((word[1:], [1]))
        before[begin], after[last] = 0, 1
        opens = np.zeros(len(word), dtype=np.int64)
        opens[begin] = 1
        lows, shapes = np.array(self.low), np.array(self.shape)
        low, kind, n = self.low_names, self.shape_names, len(self.shape_names)
        own = shapes[word]
        columns = [
            self._pairs("l", lows[before], np.zeros_like(own), 1, lambda a, b: f"l{low[a]}"),
            self._pairs("r", lows[after], np.zeros_like(own), 1, lambda a, b: f"r{low[a]}"),
            self._pairs("k", shapes[before], own, n, lambda a, b: f"k{kind[a]}/{kind[b]}"),
            self._pairs("n", own, shapes[after], n, lambda a, b: f"n{kind[a]}/{kind[b]}"),
            self._pairs("L", lows[before], own, n, lambda a, b: f"L{low[a]}/{kind[b]}"),
            self._pairs("R", lows[after], own, n, lambda a, b: f"R{low[a]}/{kind[b]}"),
            self._pairs("f", opens, own, n, lambda a, b: f"f{bool(a)}/{kind[b]}"),
        ]
        return word, columns, begin, sizes

    def table(self, found: list[list[tuple[str, int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``feature_table`` of sentences, one after the other; where they begin, their sizes."""
        word, columns, begin, sizes = self._columns(found)
        return np.column_stack([np.array(self.own)[word], *columns]), begin, sizes

    def tags(self, found: list[list[tuple[str, int, int]]]) -> list[np.ndarray]:
        """Tags of sentences, which aren't empty."""
        word, columns, begin, sizes = self._columns(found)
        emit = np.array(self.held)[word]
        for column in columns:
            emit += self.model.emit[column]
        return self._decode(emit, begin, sizes)

    def _decode(self, emit: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        return np.split(side_by_side(emit, begin, sizes, self.model.step + self.ok), begin[1:])

    def __call__(self, texts: list[str | None]) -> list[list[tuple[str, str, int, int]] | None]:
        out: list[list | None] = [None if t is None else [] for t in texts]
        own, found, tokens = [], [], 0
        for k, text in enumerate(texts):
            for sentence in sentences(text or ""):
                own.append(k)
                found.append(sentence)
                tokens += len(sentence)
                if tokens >= self.TOKENS:
                    self._put(out, texts, own, found)
                    own, found, tokens = [], [], 0
        if found:
            self._put(out, texts, own, found)
        return out

    def _put(self, out: list, texts: list[str], own: list[int], found: list[list[tuple[str, int, int]]]) -> None:
        for k, sentence, tags in zip(own, found, self.tags(found), strict=True):
            if tags.any():
                out[k].extend(_spans(texts[k], self.model, sentence, tags))


def recognizer(spark, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to its names, an array of (name, kind, start, end); null for null."""
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("name", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    held: list[Reader] = []

    def found(texts: pa.Array) -> pa.Array:
        if not held:  # once a task
            held.append(Reader(sent.value))
        rows = [None if own is None else [dict(zip(("name", "kind", "start", "end"), x, strict=True)) for x in own] for own in held[0](texts.to_pylist())]
        return pa.array(rows, type=kind)

    return F.arrow_udf(found, "array<struct<name: string, kind: string, start: long, end: long>>")


def name_tokens(spark, model: Model, kind: str | None = None) -> Callable[[Column], Column]:
    """A tokenizer of ``mining.tokens`` that gives the names, all or of one kind."""
    found = recognizer(spark, model)
    return lambda c: F.transform(F.filter(found(c), lambda x: F.lit(kind is None) | (x["kind"] == kind)), lambda x: x["name"])
