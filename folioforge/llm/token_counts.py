"""Token counts without token ids.

A byte-level BPE splits a text into pre-tokens by a fixed pattern and merges inside each of them alone,
so a text's tokens are the sum over its pre-tokens.

1. Every document becomes a bag: its distinct pre-tokens with their frequencies.
2. The distinct pre-tokens of all documents, which combine before the shuffle, make one table, and the
   pieces of each are counted once. No ids are kept.
3. The table is joined to the bags and summed per document.

The table is counted. Up to ``MOST_ROWS`` rows and ``MOST_BYTES`` bytes it is broadcast, and a bag is
summed where it stands. Beyond, the pre-tokens that stand in the most documents, within those bounds,
are broadcast and only the others are joined by a shuffle: they are rare by choice, so neither the rows
moved nor a key among them is large. Bags are made again for the join rather than written, since a bag
is about as large as its text.

Texts in which Unicode versions may differ on letters, digits and spaces are split by the library
itself in Python, all others on the JVM. A special token's string inside a text is one token, as the
library has it, and splits the text around it. Null texts count as empty: 0 bytes, 0 tokens. Repeated
rows each get their own result.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import map_rows, staged, text_of

MOST_ROWS = 1_000_000
MOST_BYTES = 64_000_000
#: Up to here the letter, digit and space classes are the same in all Unicode versions in use.
UNSTABLE = r"[^\x00-ɏ‐-…]"


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed value: the vocabulary files' pre-token pattern for Java. Alternatives that can't begin alike stand
#: in the order of how common they are.
PRETOKEN = r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"


class PieceCounter:
    """One vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()

    def special(self) -> str | None:
        """A pattern of the special strings, longest first; it reads the same in Java."""
        found = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        return "|".join("".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in s) for s in found) or None

    def split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def split_texts(rows: DataFrame, vocabulary: str) -> DataFrame:
    """The columns of ``rows`` but its text, a number for the row, and specials (special strings) and tokens
    (the pre-tokens). The numbers hold within one plan."""
    special = piece_counter(tokenizer_path(vocabulary)).special()
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = F.split("text", special, -1) if special else F.array("text")
    odd = F.col("text").rlike(UNSTABLE)
    kept = [c for c in rows.columns if c != "text"]

    def start():
        counter = piece_counter(tokenizer_path(vocabulary))
        return lambda parts: [[[p for part in own for p in counter.split(part)] for own in parts]]

    plain = rows.where(~odd).select(*kept, parts.alias("parts"))
    tokens = F.flatten(F.transform("parts", lambda p: F.regexp_extract_all(p, F.lit(PRETOKEN), F.lit(0))))
    plain = plain.select(*kept, (F.size("parts") - 1).alias("specials"), tokens.alias("tokens"), F.lit(0).alias("branch"))
    others = rows.where(odd).select(*kept, parts.alias("parts")).withColumn("specials", F.size("parts") - 1)
    others = map_rows(others, [*kept, "specials"], start, "tokens array<string>").withColumn("branch", F.lit(1))
    return _fixed(plain.unionByName(others), "tokens")


def with_bags(rows: DataFrame) -> DataFrame:
    """tokens become bag, an array of (token, freq): the tokens in order, cut where the next one differs."""
    line = _fixed(rows.withColumn("tokens", F.sort_array("tokens")), "tokens")
    n = F.size("tokens")
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.get("tokens", i).eqNullSafe(F.get("tokens", i - 1)))
    line = _fixed(line.withColumn("first", F.when(n > 0, first).otherwise(F.array().cast("array<int>"))), "first")
    after = F.concat(F.slice("first", 2, F.size("first")), F.array(n))
    cut = F.zip_with("first", F.when(n > 0, after).otherwise(F.col("first")), lambda a, b: F.struct(F.get("tokens", a).alias("token"), (b - a).alias("freq")))
    return line.withColumn("bag", cut).drop("tokens", "first")


def _fixed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the column behind a generator: it is computed once a row, and no filter or projection
    above is rewritten into what makes it."""
    others = [c for c in rows.columns if c != column]
    return rows.select(*others, F.inline(F.array(F.struct(column))))


def vocabulary_of(split: DataFrame, vocabulary: str) -> DataFrame:
    """(token, docs, pieces): every distinct pre-token, in how many documents it stands, and its pieces."""
    distinct = split.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("docs"))

    def start():
        counter = piece_counter(tokenizer_path(vocabulary))
        return lambda tokens: [counter.count(tokens)]

    counted = distinct.withColumn("text", F.col("token"))
    return staged(map_rows(counted, ["token", "docs"], start, "pieces long"), "token-pieces")


def commonest(pieces: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, bool]:
    """(the pre-tokens of most documents within both bounds, whether these are all)."""
    level = F.floor(F.log2("docs")).cast("int")
    held = pieces.groupBy(level.alias("k")).agg(F.count("*").alias("n"), F.sum(F.octet_length("token") + 16).alias("size")).collect()  # a row for each power of two
    least, rows, size = 64, 0, 0
    for r in sorted(held, key=lambda r: -r.k):
        rows, size = rows + r.n, size + r["size"]
        if rows > most_rows or size > most_bytes:
            return pieces.where(level >= least), False
        least = r.k
    return pieces, True


def token_counts(
    docs: DataFrame,
    *,
    vocabulary: str = "byte_bpe_50k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    most_rows: int = MOST_ROWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > limit) for every row."""
    text = text_of(text_col)
    split = split_texts(docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")), vocabulary)
    pieces = vocabulary_of(split, vocabulary)
    common, whole = commonest(pieces.select("token", "pieces", "docs"), most_rows, most_bytes)
    key = ["branch", "row", "id", "n_bytes", "specials"]
    pairs = with_bags(split).select(*key, F.inline_outer("bag"))
    tokens = F.coalesce(F.sum(F.col("freq") * F.col("pieces")), F.lit(0)).alias("n_tokens")
    met = pairs.join(F.broadcast(common.select("token", "pieces")), "token", "left")
    if whole:
        out = met.groupBy(*key).agg(tokens)
    else:
        # a row for each document, and one for each of its pre-tokens that the broadcast lacks
        rest = F.when(F.col("pieces").isNull(), F.col("token")).alias("rest")
        sums = staged(met.groupBy(*key, rest).agg(tokens, F.sum("freq").alias("freq")), "token-sums")
        rare = pieces.join(F.broadcast(common.select("token")), "token", "left_anti").select("token", "pieces")
        more = sums.where("rest is not null").join(rare, F.col("rest") == F.col("token")).select(*key, (F.col("freq") * F.col("pieces")).alias("n_tokens"))
        out = sums.where("rest is null").select(*key, "n_tokens").union(more).groupBy(*key).agg(F.sum("n_tokens").alias("n_tokens"))
    total = F.col("n_tokens") + F.col("specials")
    return out.select(F.col("id").alias(id_col), "n_bytes", total.cast("long").alias("n_tokens"), (total > limit).alias("over_limit"))
