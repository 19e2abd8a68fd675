"""Problem 8: token ids of every text under a public byte-level BPE tokenizer.

Two tiers. A pre-token that is itself in the vocabulary is resolved by one probe of a minimal perfect
hash over the vocabulary. The rest go through byte-pair merging with a heap of candidate merges over
a linked list of bytes, O(n log n) for a piece of n bytes however long it is. Both tiers see each
distinct piece of a batch once. The vocabulary file is read on each worker from a path all nodes have.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pre-tokenizer pattern of this vocabulary family (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_M = (1 << 64) - 1


def _mix(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


def _hash(key: bytes) -> int:
    """64-bit hash of a byte string (its bytes as one number, folded and mixed)."""
    h = len(key) * 0x9E3779B97F4A7C15 & _M
    for i in range(0, len(key), 8):
        h = _mix(h ^ int.from_bytes(key[i : i + 8], "little"))
    return h


class PerfectHash:
    """Minimal perfect hash by hash and displace: keys share a bucket, each bucket a displacement.

    ``slot`` gives every key its own place in 0..n-1 and any place to strangers, so a probe compares.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 2)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for k in keys:
            h = _hash(k)
            members[h % self.buckets].append(h)
        self.shift = [0] * self.buckets
        taken, free = bytearray(n), 0
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            own = members[b]
            if not own:
                break
            if len(own) == 1:  # any free place will do
                free = taken.index(0, free)
                taken[free], self.shift[b] = 1, -free - 1
                continue
            d = 0
            while True:
                place = {((h >> 20) + (h >> 42 | 1) * d & _M) % n for h in own}
                if len(place) == len(own) and not any(taken[p] for p in place):
                    break
                d += 1
            self.shift[b] = d
            for p in place:
                taken[p] = 1

    def slot(self, key: bytes) -> int:
        h = _hash(key)
        d = self.shift[h % self.buckets]
        return -d - 1 if d < 0 else ((h >> 20) + (h >> 42 | 1) * d & _M) % self.n


class Tokenizer:
    """Byte-level BPE over a rank file (one base64 token and its rank a line)."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        keys = [base64.b64decode(a) for a, _ in pairs]
        self.table = PerfectHash(keys)
        self.keys: list[bytes] = [b""] * len(keys)
        self.ids = [0] * len(keys)
        for k, (_, rank) in zip(keys, pairs, strict=True):
            s = self.table.slot(k)
            self.keys[s], self.ids[s] = k, int(rank)
        self.ranks = dict(zip(keys, (int(r) for _, r in pairs), strict=True))
        self.pattern = regex.compile(pattern)

    def whole(self, piece: bytes) -> int | None:
        """Id of a piece that is in the vocabulary (tier one)."""
        s = self.table.slot(piece)
        return self.ids[s] if self.keys[s] == piece else None

    def merged(self, piece: bytes) -> list[int]:
        """Ids by byte-pair merging: lowest rank first, leftmost among equals (tier two)."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # the part that begins at i ends at end[i]; linked list of parts
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n:
                continue
            j = end[i]
            if end[j] != stop:  # one side has grown since
                continue
            end[i], alive[j] = stop, False
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode("utf-8", "replace")
        one = self.whole(raw)
        return (one,) if one is not None else tuple(self.merged(raw))

    def encode(self, text: str | None, memo: dict[str, tuple[int, ...]]) -> list[int]:
        out: list[int] = []
        for p in self.pattern.findall(text or ""):
            got = memo.get(p)
            if got is None:
                got = self.piece(p)
                if len(memo) < 200_000 and len(p) < 64:  # bounds the memo's memory, not the result
                    memo[p] = got
            out.extend(got)
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each worker process and vocabulary."""
    return Tokenizer(path)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``id_col, ids`` for each row: token ids without special tokens.

    Null and empty texts have no ids: an empty list. Strings of special tokens are ordinary text.
    Texts are read whole; rows are kept as they are, repeated ones too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, memo = tokenizer(path), {}
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "ids": [tok.encode(t, memo) for t in b["_text"]]})

    rows = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    return spread(rows).mapInPandas(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids array<int>")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``id_col, tokens``: the size of each text in tokens; 0 for null and empty texts."""
    return encoded(docs, id_col, text_col, path).select(f"`{id_col}`", F.size("ids").cast("bigint").alias("tokens"))
