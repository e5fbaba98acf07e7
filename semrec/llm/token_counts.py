"""Token counts under a byte-level BPE by rank-synchronous array merging.

Distinct pre-tokens of a batch are held as one ragged numpy array (flat symbol
ids plus sequence numbers).  In every round each sequence's lowest-rank pair is
merged at all its places at once; a sequence without a mergeable pair is done.
The surviving symbols are counted; no ids are kept.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, text_of

#: Pre-tokens whose count a worker remembers; beyond that it starts afresh.
CACHED = 700_000
#: Bytes beyond which a pre-token's places are kept by rank instead of passed over in every round.
LONG = 4096
#: Pre-tokens merged together in one ragged array.
ROWS_PER_ROUND = 200_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """Pair ranks of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.byte_id = np.zeros(256, dtype=np.int64)
        for ch, b in byte_alphabet().items():
            self.byte_id[b] = vocab[ch]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len,
                                                                         reverse=True))))
        self.odd_blanks = regex.compile(r"\s \s|^ \s|^ $")

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        left = np.zeros(len(tokens), dtype=np.int64)
        long = np.fromiter((len(t) > LONG for t in tokens), dtype=bool, count=len(tokens))
        for i in np.flatnonzero(long):
            left[i] = self._count_long(tokens[i])
        if not long.all():
            left[~long] = self._count_ragged([t for t in tokens if len(t) <= LONG])
        return left

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, the number of merges where there is none."""
        pair = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.merged))

    def _count_long(self, token: bytes) -> int:
        """As :meth:`_count_ragged` for one very long sequence: places wait by the rank of the pair that starts
        there, and a round touches only the places of the lowest rank and their neighbours."""
        sym = self.byte_id[np.frombuffer(token, dtype=np.uint8)]
        n, none = len(sym), len(self.merged)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1: no neighbour
        rank = np.r_[self._ranked(sym[:-1], sym[1:]), none]
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < none]
            order = np.argsort(rank[places], kind="stable")
            places = places[order]
            values, first = np.unique(rank[places], return_index=True)
            for value, part in zip(values.tolist(), np.split(places, first[1:])):
                if value not in waiting:
                    waiting[value] = []
                    heapq.heappush(ranks, value)
                waiting[value].append(part)

        wait(np.arange(n - 1))
        left = n
        while ranks:
            lowest = heapq.heappop(ranks)
            hit = np.unique(np.concatenate(waiting.pop(lowest)))
            hit = hit[rank[hit] == lowest]
            if not len(hit):
                continue
            # overlapping places (a a a): within a chain of neighbours take every other one
            chain = np.r_[True, after[hit[:-1]] != hit[1:]]
            start = np.maximum.accumulate(np.where(chain, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            gone = after[hit]
            sym[hit] = self.merged[lowest]
            rank[gone] = none
            after[hit] = after[gone]
            inner = after[hit] < n
            before[after[hit][inner]] = hit[inner]
            left -= len(hit)
            # a new symbol's pairs rank behind the merge that made it
            touched = np.unique(np.r_[hit, before[hit]])
            touched = touched[touched >= 0]
            rank[touched] = none
            paired = touched[after[touched] < n]
            rank[paired] = self._ranked(sym[paired], sym[after[paired]])
            wait(touched)
        return left

    def _count_ragged(self, tokens: list[bytes]) -> np.ndarray:
        size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        sym = self.byte_id[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), size)
        left = size.copy()
        none = len(self.merged)
        while len(sym) > 1:
            pair = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (seq[:-1] == seq[1:]), self.ranks[at], none)
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, none], first)
            run = np.diff(np.r_[first, len(sym)])
            mine = np.repeat(lowest, run)
            hit = np.flatnonzero((rank == mine[:-1]) & (rank < none))
            if not len(hit):
                break
            # overlapping places (a a a): within a chain of neighbours take every other one
            chain = np.r_[True, np.diff(hit) != 1]
            start = np.maximum.accumulate(np.where(chain, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            sym = sym.copy()
            sym[hit] = self.merged[rank[hit]]
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            np.subtract.at(left, seq[hit], 1)
            alive = np.repeat(lowest < none, run)  # finished sequences leave the array
            keep &= alive
            sym, seq = sym[keep], seq[keep]
        return left


class TokenCounter:
    """Counts of whole texts, remembering the counts of blank-separated chunks."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.head: dict[str, int] = {}  # chunk without a blank before it
        self.tail: dict[str, int] = {}  # chunk after one blank

    def _learn(self, chunks: set[str], lead: str, known: dict[str, int]) -> None:
        new = [c for c in chunks if c not in known]
        if not new:
            return
        split = [self.table.pattern.findall(lead + c) for c in new]
        index: dict[str, int] = {}
        for parts in split:
            for p in parts:
                index.setdefault(p, len(index))
        tokens = [p.encode("utf-8", "surrogatepass") for p in index]
        counts = np.concatenate([self.table.counts(tokens[i:i + ROWS_PER_ROUND])
                                 for i in range(0, len(tokens), ROWS_PER_ROUND)] or
                                [np.zeros(0, dtype=np.int64)]).tolist()
        for c, parts in zip(new, split):
            known[c] = sum([counts[index[p]] for p in parts])

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text.

        A blank after a non-blank or before one always starts a pre-token, so a
        text splits there; the few texts with other runs of blanks are taken whole.
        """
        if len(self.head) + len(self.tail) > CACHED:
            self.head.clear()
            self.tail.clear()
        specials, heads, tails = [], set(), set()
        plans = []
        for text in texts:
            parts = self.table.special.split(text)
            specials.append(len(parts) - 1)
            plan = []
            for part in parts:
                if self.table.odd_blanks.search(part):
                    plan.append((part, []))
                    heads.add(part)
                elif part:
                    first, *rest = part.split(" ")
                    plan.append((first, rest))
                    heads.add(first)
                    tails.update(rest)
            plans.append(plan)
        self._learn(heads, "", self.head)
        self._learn(tails, " ", self.tail)
        head, tail = self.head, self.tail
        return [n + sum([head[f] + sum([tail[r] for r in rest]) for f, rest in plan])
                for n, plan in zip(specials, plans)]


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str) -> TokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024,
                 text_col: str = "text", batch_texts: int = 500) -> DataFrame:
    """``docs`` without its text, plus ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``vocabulary`` is a byte-level BPE file; special strings in a text count as
    the one special token.  A null text is empty: 0 bytes, 0 tokens.  Texts and runs without
    blanks may be of any length.  Repeated
    rows stay, an empty frame gives an empty one, and input columns with the
    names of the results are replaced.
    """
    rest = [f for f in docs.schema.fields
            if f.name not in (text_col, "n_bytes", "n_tokens", "over_limit")]
    schema = T.StructType([*rest, T.StructField("n_tokens", T.LongType()),
                           T.StructField("__bytes", T.LongType())])

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(batch.num_columns - 2).to_pylist()
            counts: list[int] = []
            for i in range(0, len(texts), batch_texts):
                counts += counter.count_all(texts[i:i + batch_texts])
            cols = [batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(counts, pa.int64()), batch.column(batch.num_columns - 1)],
                names=[*(f.name for f in rest), "n_tokens", "__bytes"])

    text = text_of(text_col)
    src = python_ready(docs).select(*[F.col(f"`{f.name}`") for f in rest], text.alias("__text"),
                                    F.octet_length(text).cast("bigint").alias("__bytes"))
    return (src.mapInArrow(count, schema)
            .withColumnRenamed("__bytes", "n_bytes")
            .withColumn("over_limit", F.col("n_tokens") > limit))
