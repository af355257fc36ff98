"""Texts packed into containers of a fixed number of tokens, window by window in a given mixture.

Sizes come from a public tokenizer.  A text larger than a container is cut into
full containers and a rest.  The pieces are spread over shards of bounded size
by hash.  In a shard a deficit round-robin over the queues (one a value of a
mixture column) fills window after window to the target token proportions; what
a queue is owed is carried to the next window and, through the token sums of
all shards before, to the next shard.  A window's pieces go, largest first, to
the open container they fit best; containers stay open for some windows.

Defined results: null and empty texts have no tokens and no container; a null
queue is a queue of its own; copies are packed each; no text that fits a
container is split.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Tokens of a container, containers of a window, windows a container stays open, tokens of a shard.
CAPACITY, WINDOW, OPEN_WINDOWS, SHARD_TOKENS = 2048, 64, 6, 4_000_000
#: The vocabulary used unless another path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_LOADED: dict = {}


def tokenizer(path: str = VOCABULARY):
    """The byte-level BPE of a rank file; loaded once a worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def sized(docs: DataFrame, key: str, text: str, queue: str, path: str = VOCABULARY) -> DataFrame:
    """(key, queue, n_tokens) of texts with at least one token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            encode = tokenizer(path).encode_ordinary
            yield pd.DataFrame({key: batch[key], "queue": batch["queue"], "n_tokens": [len(encode(t)) for t in batch["_text"]]})

    texts = docs.select(key, F.coalesce(F.col(queue).cast("string"), F.lit("")).alias("queue"), F.col(text).alias("_text")).where("_text <> ''")
    return texts.mapInPandas(run, f"{key} {docs.schema[key].dataType.simpleString()}, queue string, n_tokens bigint")


def pack(items: list[tuple[str, int, object]], targets: dict[str, float], owed: dict[str, float], capacity: int = CAPACITY, window: int = WINDOW) -> Iterator[tuple[int, int, object]]:
    """(window, container, item) for the (queue, tokens, item) of a shard; owed: the deficits carried in."""
    queues: dict[str, deque] = {}
    for q, n, item in items:
        queues.setdefault(q, deque()).append((n, item))
    deficit = {q: owed.get(q, 0.0) for q in queues}
    open_: list[tuple[int, int, int]] = []  # (free tokens, container, window it was opened in), sorted
    number, at = 0, 0
    while queues:
        left = window * capacity
        share = sum(targets.get(q, 0.0) for q in queues) or 1.0
        taken = []
        for q in list(queues):
            # a queue that has run dry leaves its share to the others
            deficit[q] += window * capacity * (targets.get(q, 0.0) / share if share else 1 / len(queues))
        progress = True
        while progress and left > 0:
            progress = False
            for q in sorted(queues, key=lambda q: (-deficit[q], q)):
                n, item = queues[q][0]
                if n <= deficit[q] or not taken and q == max(queues, key=lambda q: (deficit[q], q)):
                    queues[q].popleft()
                    deficit[q] -= n
                    left -= n
                    taken.append((n, item))
                    progress = True
                    if not queues[q]:
                        del queues[q]
                        break
        for n, item in sorted(taken, key=lambda x: -x[0]):
            k = bisect_left(open_, (n, -1, -1))
            if k < len(open_):
                free, container, since = open_.pop(k)
            else:
                free, container, since = capacity, number, at
                number += 1
            yield since, container, item
            if free > n:
                insort(open_, (free - n, container, since))
        at += 1
        open_ = [o for o in open_ if at - o[2] < OPEN_WINDOWS]


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", queue: str = "doc_part", capacity: int = CAPACITY, targets: dict[str, float] | None = None, path: str = VOCABULARY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(container_id, window_id, key, piece_no, queue, n_tokens).  targets: token proportions of the queues; those of all documents by default."""
    sizes = cut(sized(docs, key, text, queue, path))
    pieces = sizes.select(key, "queue", F.posexplode(F.expr(f"transform(sequence(0, int((n_tokens - 1) div {capacity})), i -> least({capacity}L, n_tokens - i * {capacity}L))")).alias("piece_no", "n_tokens"))
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, ceil(total / shard_tokens))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64(key, "piece_no"), F.lit(shards)).cast("int"))
    # a few numbers a shard and queue: the tokens that it will have taken once it is packed
    sums = pieces.groupBy("shard", "queue").agg(F.sum("n_tokens").alias("n")).collect()
    by: dict[str, int] = {}
    for r in sums:
        by[r.queue] = by.get(r.queue, 0) + r.n
    given = {q: n / total for q, n in by.items()} if targets is None else {q: targets.get(q, 0.0) / (sum(targets.values()) or 1.0) for q in by}
    carried: list[dict[str, float]] = [{q: 0.0 for q in by}]
    for s in range(shards - 1):
        own = {r.queue: r.n for r in sums if r.shard == s}
        carried.append({q: carried[-1][q] + given[q] * sum(own.values()) - own.get(q, 0) for q in by})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        group = group.sort_values([key, "piece_no"], kind="stable")
        rows = list(group[[key, "piece_no", "queue", "n_tokens"]].itertuples(index=False, name=None))
        out = [(shard * 10**9 + c, shard * 10**9 + w, *r) for w, c, r in pack([(r[2], r[3], r) for r in rows], given, carried[shard], capacity)]
        return pd.DataFrame(out, columns=["container_id", "window_id", key, "piece_no", "queue", "n_tokens"])

    return pieces.groupBy("shard").applyInPandas(run, f"container_id bigint, window_id bigint, {key} {docs.schema[key].dataType.simpleString()}, piece_no int, queue string, n_tokens bigint")


def fill(packing: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(container_id, n_items, n_tokens, unused) of every container."""
    return packing.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_tokens")).withColumn("unused", F.lit(capacity) - F.col("n_tokens"))
