"""External models behind a callable: batches, retries, passes, prompts. Offline there is a stub."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (system prompt, user text) -> text
Model = Callable[[str, str], str]


def echo(system: str, text: str) -> str:
    """A deterministic stand-in for a model."""
    return f"[{len(system)}] {text}"


def server_delay(message: str, least: float = 10.0, default: float = 30.0) -> float:
    m = re.search(r"retry in ([\d.]+)s", message) or re.search(r"retryDelay[^\d]*(\d+)s", message)
    return max(least, float(m[1]) if m else default)


def with_retries(model: Model, *, attempts: int = 5, backoff: float = 2.0, sleep: Callable[[float], None] = time.sleep, limited: Callable[[Exception], bool] = lambda e: "429" in str(e)) -> Model:
    """The model with ``attempts`` tries; waits backoff^(k - 1) seconds, or what a rate limit asks for."""

    def call(system: str, text: str) -> str:
        for k in range(1, attempts + 1):
            try:
                return model(system, text)
            except Exception as error:
                if k == attempts:
                    raise
                sleep(server_delay(str(error)) if limited(error) else backoff ** (k - 1))
        raise AssertionError

    return call


def passes(*steps: tuple[Model, str]) -> Model:
    """Models one after the other, each with its own system prompt; the first takes the caller's if its own is empty."""

    def call(system: str, text: str) -> str:
        for model, own in steps:
            text = model(own or system, text)
        return text

    return call


def keep_on_error(model: Model) -> Model:
    """The text itself where the model fails."""

    def call(system: str, text: str) -> str:
        try:
            return model(system, text)
        except Exception:
            return text

    return call


def map_model(df: DataFrame, model: Model, *, text_col: str, prompt_col: str | None = None, out_col: str = "result") -> DataFrame:
    """``df`` with the model's answer to each text; null texts stay null. Put filters and distinct before this.

    Only texts and prompts go to Python; the other columns, ids of any type among them, stay as they are.
    """

    def answers(texts: pa.Array, prompts: pa.Array) -> pa.Array:
        both = zip(texts.to_pylist(), prompts.to_pylist(), strict=True)
        return pa.array([None if t is None else model(p or "", t) for t, p in both], type=pa.string())

    ask = F.arrow_udf(answers, "string").asNondeterministic()  # each text is asked about once
    return df.withColumn(out_col, ask(F.col(text_col), F.col(prompt_col) if prompt_col else F.lit("")))


def map_chunks(chunks: DataFrame, key: str, model: Model, *, chunk_col: str = "chunk", prompt_col: str | None = None) -> DataFrame:
    """(key, results): the chunks (key, idx, chunk) answered in parallel and put in order again."""
    answered = map_model(chunks, model, text_col=chunk_col, prompt_col=prompt_col)
    ordered = F.sort_array(F.collect_list(F.struct("idx", "result")))
    return answered.groupBy(key).agg(F.transform(ordered, lambda r: r["result"]).alias("results"))


def prompt(preamble: str, rules: list[str], never: list[str], translations: list[tuple[str, str]], title: Column) -> Column:
    """A system prompt: preamble, rules, terms to keep (sorted, each once), pairs, and the row's title."""
    parts = [preamble, *(f"- {r}" for r in rules)]
    if never:
        parts.append("Keep: " + ", ".join(sorted(set(never))))
    parts += [f"{a} => {b}" for a, b in translations]
    return F.concat(F.lit("\n".join(parts) + "\nTitle: "), F.coalesce(title, F.lit("")))
