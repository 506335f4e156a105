"""Token counts by trie-shared dynamic programming.

Texts are cut into pre-tokens; a pre-token's tokens are its best segmentation
under a unigram model: the pieces of a public vocabulary, each scored by its
rank (Zipf's law). The distinct pre-tokens of a batch are put in a trie of
bytes, and the forward pass (best score, fewest tokens, of the text up to a
byte) is worked out once per trie node, so pre-tokens that begin alike share it.
A pre-token's token count is stored at the node where it ends.

The trie lives as long as a task, up to ``MAX_NODES`` nodes, then a new one is
begun; pre-tokens over ``LONG`` bytes are worked out beside the trie with
a window of the longest piece's length, so memory stays bounded for any text.

Edge cases: null and empty texts have no tokens; any text can be cut, as every
single byte is a piece; repeated rows and null ids are counted one by one; an
empty table gives an empty result. Extra columns pass through ``count_tokens``.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: contractions, letters, digits, other signs (with the blank before
#: them), white space.
PRE_TOKEN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MAX_NODES = 1 << 20
LONG = 128
SCALE = 1 << 20     # scores are whole numbers, so sums are exact

COUNTS = T.StructType([T.StructField(n, T.LongType(), False) for n in ("n_tokens", "n_pretokens", "n_bytes")])
COUNTS_ARROW = pa.struct([pa.field(n, pa.int64(), False) for n in ("n_tokens", "n_pretokens", "n_bytes")])


def read_vocabulary(lines: Iterator[str]) -> dict[bytes, int]:
    """Piece -> score from lines of base64 piece and rank. A piece at rank r is
    taken to be 1 / (r + 1) as frequent as the first; missing bytes rank last."""
    ranks = {}
    for line in lines:
        if line.strip():
            piece, rank = line.split()
            ranks[base64.b64decode(piece)] = int(rank)
    worst = max(ranks.values(), default=0) + 1
    for b in range(256):
        ranks.setdefault(bytes([b]), worst)
    return {p: -round(SCALE * math.log((r + 2) * math.log(worst + 2))) for p, r in ranks.items()}


class Trie:
    """Forward scores of all prefixes that the pre-tokens seen so far have."""

    def __init__(self, scores: dict[bytes, int]):
        self.longest = max(map(len, scores))
        # Every ending of a piece, with the score of those that are pieces: looking
        # back from a byte stops as soon as no piece ends that way.
        self.tails: dict[bytes, int | None] = {p[i:]: None for p in scores for i in range(len(p))}
        self.tails.update(scores)
        self.terminal: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[int, int]] = [{}]
        self.best: list[tuple[int, int]] = [(0, 0)]     # per node: score, minus the number of tokens
        self.terminal.clear()

    def step(self, text: bytes, end: int, before: list[tuple[int, int]]) -> tuple[int, int]:
        """Forward value at ``end``; ``before[-k]`` is the value k bytes earlier."""
        get, top = self.tails.get, None
        for k in range(1, min(end, self.longest, len(before)) + 1):
            s = get(text[end - k:end], 0)
            if s == 0:
                break
            if s is not None:
                at = before[-k]
                value = (at[0] + s, at[1] - 1)
                if top is None or value > top:
                    top = value
        return top

    def count(self, token: bytes) -> int:
        """Tokens of a pre-token."""
        known = self.terminal.get(token)
        if known is not None:
            return known
        if len(token) > LONG:
            path = [(0, 0)]
            for end in range(1, len(token) + 1):
                path = [*path[-self.longest:], self.step(token, end, path)]
            return -path[-1][1]
        if len(self.best) > MAX_NODES:
            self.clear()
        node, path, children, best = 0, [self.best[0]], self.children, self.best
        for end, byte in enumerate(token, 1):
            child = children[node].get(byte)
            if child is None:
                child = len(best)
                children[node][byte] = child
                children.append({})
                best.append(self.step(token, end, path))
            node = child
            path.append(best[node])
        self.terminal[token] = -best[node][1]
        return self.terminal[token]


def pre_tokens(text: str | None) -> list[str]:
    return PRE_TOKEN.findall(text or "")


def count_tokens(df: DataFrame, vocabulary: dict[bytes, int], text: str = "text", out: str = "tokens") -> DataFrame:
    """``df`` plus struct ``out`` (n_tokens, n_pretokens, n_bytes) of its text.
    The vocabulary (some ten thousand pieces) is broadcast."""
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([*df.schema.fields, T.StructField(out, COUNTS, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for b in batches:
            made = []
            for t in b.column(b.schema.get_field_index(text)):
                found = Counter(pre_tokens(t.as_py()))
                tokens = size = 0
                for p, n in found.items():
                    raw = p.encode("utf-8", "surrogatepass")
                    tokens += n * trie.count(raw)
                    size += n * len(raw)
                made.append({"n_tokens": tokens, "n_pretokens": found.total(), "n_bytes": size})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, COUNTS_ARROW)], schema=pa.schema(
                [*b.schema, pa.field(out, COUNTS_ARROW, False)]))

    return df.mapInArrow(run, schema)


def load_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, encoding="ascii") as f:
        return read_vocabulary(f)


def token_report(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """Per document: tokens, pre-tokens and bytes of its whole text."""
    counted = count_tokens(docs.select("doc_id", "text"), load_vocabulary(vocabulary_path), out="__tokens")
    return counted.select("doc_id", *[F.col("__tokens")[n].alias(n) for n in COUNTS.names])
