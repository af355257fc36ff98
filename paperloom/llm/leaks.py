"""Held-out test passages inside corpus documents, found by spaced-seed hashing.

A seed is a fixed mask over token positions, some of which it ignores.  The
hashes of the test items' masked windows are joined with those of the corpus;
around each hit the overlap is verified on its diagonal, tolerating
substituted tokens.  An overlap starts at a short window that holds a token
rare in the corpus, or at a run of ``RUN`` tokens, whatever their frequency;
like-built sentences share no such run.  Stock sentences are taken out after
the verification: a sentence of an item is stock if more texts than a rare
token may have hold it without another sentence of that item.

All frequencies count distinct texts, so copies of a leaked text don't make
its wording usual.  Texts that hold an item beyond one sentence don't count in
its tokens' frequencies either: tokens that get rare by this are planted in a
second pass.  The test items are joined in blocks of at most ``BLOCK_TOKENS``
tokens, the size that is broadcast; any number of blocks is handled.

Defined results: null and empty texts on either side match nothing; copies of
a text count each; an item shorter than ``RUN`` that has no rare token is found
only as a whole, and not below the length of a seed; an item of one sentence
that many distinct texts hold is a stock sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Fixed masks: token offsets of a window that are compared.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 5), (0, 1, 4, 5))
#: A token is rare if at most this share of documents holds it, and at least this count.
RARE_SHARE, RARE_LEAST = 0.005, 3
#: Tokens of an exact run that starts an overlap without a rare token; tokens of the largest sentence.
RUN, SENTENCE = 16, 60
#: Share of an item's tokens that must be covered; loss of score at which an overlap ends.
COVERED, DROP = 0.33, 5
#: Tokens of test items joined at a time.
BLOCK_TOKENS = 1_000_000
TOKEN = re.compile(r"\w+")
STOP = re.compile(r"(?<=[.!?。！？])\s+|\n\s*\n")
# each branch begins with a letter of its own, so that a search skips to these
SOFT = re.compile(r"­|-(?<=[a-z]-)\s*\n\s*(?=[a-z])|‐(?<=[a-z]‐)\s*\n\s*(?=[a-z])")


def tokens(text: str | None) -> list[str]:
    """Lower-case word tokens; a word broken by a hyphen at a line end is one token."""
    return TOKEN.findall(SOFT.sub("", text).lower()) if text else []


def sentence_sizes(text: str) -> list[int]:
    """The tokens of each sentence; longer ones than ``SENTENCE`` count in equal parts."""
    out = []
    for part in STOP.split(SOFT.sub("", text)):
        n = len(tokens(part))
        out += [len(x) for x in np.array_split(np.arange(n), -(-n // SENTENCE))] if n else []
    return out


class Block:
    """Test items of a bounded number of tokens, with their vocabulary and, once rare tokens are known, their seeds."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        self.tokens = [np.array([self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in tokens(own)], np.int64) for _, own in items]
        #: The sentence of each token.
        self.sentences = [np.repeat(np.arange(len(n)), n) for n in (sentence_sizes(own) for _, own in items)]
        self.telling = np.array([False, *(not t.isdigit() and len(t) > 2 for t in self.vocabulary)])
        self.rare = self.asked = np.zeros(len(self.telling), bool)
        self.seeds: list[tuple[tuple[int, ...], bool, np.ndarray, np.ndarray, np.ndarray]] = []

    def keys(self, at: np.ndarray, mask: tuple[int, ...], holding: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(place, key) of the windows without a token outside the vocabulary; with ``holding``, of those that hold one of these places."""
        n = len(at) - mask[-1]
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if holding is not None:
            ok = np.zeros(len(at), bool)
            for o in mask:
                ok[holding[holding >= o] - o] = True
            where = np.flatnonzero(ok[:n])
            for o in mask:
                where = where[at[where + o] > 0]
        elif mask[-1] + 1 == len(mask):  # a run
            known = np.concatenate([[0], np.cumsum(at > 0, dtype=np.int32)])
            where = np.flatnonzero(known[len(mask) :] - known[: -len(mask)] == len(mask))
        else:
            ok = np.ones(n, bool)
            for o in mask:
                ok &= at[o : o + n] > 0
            where = np.flatnonzero(ok)
        key = np.zeros(len(where), np.uint64)
        at = at.astype(np.uint64)
        for o in mask:
            key = (key ^ at[where + o]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return where, (key >> np.uint64(1)).astype(np.int64)

    def plant(self, rare: np.ndarray, asked: np.ndarray | None = None) -> None:
        """Seeds where a token is rare, and all long runs; with ``asked``, only seeds where one of these tokens is rare."""
        self.rare, self.asked = rare, np.ones(len(rare), bool) if asked is None else asked
        short = {len(at) for at in self.tokens if len(MASKS[0]) <= len(at) < RUN}
        masks = [(m, False, None) for m in MASKS]
        if asked is None:
            masks += [(tuple(range(RUN)), True, None), *((tuple(range(n)), True, n) for n in sorted(short))]
        self.seeds = []
        for mask, long, size in masks:
            key, item, place = [], [], []
            for k, at in enumerate(self.tokens):
                if size is not None and len(at) != size:
                    continue
                where, own = self.keys(at, mask)
                if not long:
                    telling = np.zeros(len(where), bool)
                    for o in mask:
                        telling |= (rare & self.asked)[at[where + o]]
                    where, own = where[telling], own[telling]
                key.append(own), item.append(np.full(len(where), k)), place.append(where)
            key, item, place = map(np.concatenate, (key, item, place))
            order = np.argsort(key, kind="stable")
            self.seeds.append((mask, long, key[order], item[order], place[order]))

    def encode(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(t, 0) for t in tokens(text)], np.int32)

    def hits(self, texts: list[np.ndarray]) -> dict[int, dict[tuple[int, int, bool], dict[int, int]]]:
        """The starts of overlaps by text, and by item, diagonal and kind: place and length in the item.  All texts are searched at once, a zero between them."""
        texts = [at if self.asked[at].any() else at[:0] for at in texts]
        ends = np.cumsum([len(at) + 1 for at in texts])
        whole = np.concatenate([np.append(at, 0) for at in texts])
        out: dict[int, dict[tuple[int, int, bool], dict[int, int]]] = {}
        # a short seed holds a rare token
        rare = np.flatnonzero((self.rare & self.asked)[whole])
        for mask, long, key, item, place in self.seeds:
            if not len(key):
                continue
            where, own = self.keys(whole, mask, None if long else rare)
            if not len(own):
                continue
            lo = np.searchsorted(key, own, "left")
            hit = np.flatnonzero(key[np.minimum(lo, len(key) - 1)] == own)
            where, lo, hi = where[hit], lo[hit], np.searchsorted(key, own[hit], "right")
            text = np.searchsorted(ends, where, "right")
            where = where - np.where(text > 0, ends[text - 1], 0)
            for t, p, i, j in zip(text.tolist(), where.tolist(), lo.tolist(), hi.tolist()):
                starts = out.setdefault(t, {})
                for k, x in zip(item[i:j].tolist(), place[i:j].tolist()):
                    starts.setdefault((k, p - x, long), {})[x] = mask[-1] + 1
        return out

    def overlaps(self, at: np.ndarray, starts: dict[tuple[int, int, bool], dict[int, int]]) -> dict[int, list[tuple[bool, np.ndarray, np.ndarray]]]:
        """The overlaps of each item with a document's encoded tokens: (started by a long run, tokens that agree, tokens of its starts)."""
        out: dict[int, list[tuple[bool, np.ndarray, np.ndarray]]] = {}
        for (k, shift, long), places in starts.items():
            own = self.tokens[k]
            lo, hi = max(0, -shift), min(len(own), len(at) - shift)
            same = np.zeros(len(own), bool)
            same[lo:hi] = own[lo:hi] == at[lo + shift : hi + shift]
            done = 0
            for start in sorted(places):
                if start < done:
                    continue
                a, done = extent(same, start)
                agree, first = np.zeros(len(own), bool), np.zeros(len(own), bool)
                agree[a:done] = same[a:done]
                for p, n in places.items():
                    if a <= p < done:
                        first[p : p + n] = True
                out.setdefault(k, []).append((long, agree, first))
        return out

    def touched(self, k: int, agree: np.ndarray) -> np.ndarray:
        """The sentences of an item of which at least half of the tokens agree."""
        return np.flatnonzero(2 * np.bincount(self.sentences[k][agree], minlength=self.sentences[k][-1] + 1) >= np.bincount(self.sentences[k]))

    def share(self, k: int, found: list[tuple[bool, np.ndarray, np.ndarray]], stock: set[int]) -> float:
        """The covered share of an item; a long run starts an overlap only if it is as long without stock sentences."""
        usual = np.isin(self.sentences[k], list(stock))
        least = max(1, min(RUN, int((~usual).sum())))
        covered = np.zeros(len(self.tokens[k]), bool)
        for long, agree, first in found:
            if not long or (first & ~usual).sum() >= least:
                covered |= agree
        return float(covered.mean())


def extent(same: np.ndarray, start: int) -> tuple[int, int]:
    """The overlap around ``start``: extended both ways while matches outweigh substitutions."""
    ends = []
    for part in (same[start:], same[:start][::-1]):
        score = best = end = 0
        for i, agrees in enumerate(part.tolist(), 1):
            score += 1 if agrees else -1
            if score > best:
                best, end = score, i
            elif best - score >= DROP:
                break
        ends.append(end)
    return start - ends[1], start + max(ends[0], 1)


def blocks(items: DataFrame, key: str, text: str, size: int = BLOCK_TOKENS) -> Iterator[Block]:
    """The test items in blocks, streamed through the driver one partition at a time."""
    held, n = [], 0
    for r in items.select(key, text).where(F.col(text).isNotNull()).orderBy(key).toLocalIterator():
        own = len(tokens(r[1]))
        if own:
            held.append((r[0], r[1]))
            n += own
        if n >= size:
            yield Block(held)
            held, n = [], 0
    if held:
        yield Block(held)


def packed(found: list[tuple[bool, np.ndarray, np.ndarray]]) -> tuple[list[bool], list[bytes], list[bytes]]:
    return [x for x, _, _ in found], [np.packbits(x).tobytes() for _, x, _ in found], [np.packbits(x).tobytes() for _, _, x in found]


def unpacked(long, agree, first, n: int) -> list[tuple[bool, np.ndarray, np.ndarray]]:
    bits = lambda x: np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
    return [(bool(x), bits(y), bits(z)) for x, y, z in zip(long, agree, first)]


def leaked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(key, item_key, covered): documents holding at least ``COVERED`` of an item's tokens in specific overlaps."""
    spark = docs.sparkSession
    docs = docs.select(key, text).where(F.col(text).isNotNull())
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    out = spark.createDataFrame([], f"{key} {kind}, {item_key} {item_kind}, covered double")
    for block in blocks(items, item_key, item_text, block_tokens):
        sent = spark.sparkContext.broadcast(block)

        def encode(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own = sent.value
            for batch in batches:
                batch["at"] = [own.encode(t).tobytes() for t in batch[text]]
                yield batch[[key, "same", "at"]]

        # texts are told apart by their digests, so that each distinct text is counted and matched once
        encoded = cut(docs.select(key, text, F.md5(text).alias("same")).mapInPandas(encode, f"{key} {kind}, same string, at binary"))
        texts = cut(encoded.select("same", "at").dropDuplicates(["same"]))
        limit = max(RARE_LEAST, RARE_SHARE * texts.count())
        number = frequencies(texts, len(block.telling))
        block.plant(block.telling & (number <= limit))
        found = cut(matches(texts, block))
        turned = block.telling & (number > limit) & (number - own_hits(found, block, len(number)) <= limit)
        if turned.any():
            block.plant(block.rare | turned, turned)
            again = matches(texts, block)
            merged = found.unionByName(again).groupBy("same", "item")
            found = cut(merged.agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("long", "agree", "first")]))
        hits = judged(found, block, limit)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"item int, {item_key} {item_kind}")
        out = out.unionByName(encoded.select(key, "same").join(hits, "same").join(F.broadcast(ids), "item").select(key, item_key, "covered"))
    return out


def frequencies(texts: DataFrame, size: int) -> np.ndarray:
    """The number of texts with each token of a block's vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            for at in batch["at"]:
                n[np.unique(np.frombuffer(at, np.int32))] += 1
        yield pd.DataFrame({"token": np.flatnonzero(n), "n": n[n > 0]})

    return gathered(texts.select("at").mapInPandas(run, "token int, n bigint"), size)


def gathered(counted: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect():  # at most the block's vocabulary
        out[r.token] = r.n
    return out


def matches(texts: DataFrame, block: Block) -> DataFrame:
    """(same, item, long, agree, first): the overlaps of each text with each item, at its place in the block."""
    sent = texts.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            if not len(batch):
                continue
            ats = [np.frombuffer(at, np.int32) for at in batch["at"]]
            rows = [(batch["same"].iat[t], k, *packed(found)) for t, starts in own.hits(ats).items() for k, found in own.overlaps(ats[t], starts).items()]
            yield pd.DataFrame(rows, columns=["same", "item", "long", "agree", "first"])

    return texts.mapInPandas(run, "same string, item int, long array<boolean>, agree array<binary>, first array<binary>")


def own_hits(found: DataFrame, block: Block, size: int) -> np.ndarray:
    """The number of texts that hold each token within an item of which they hold more than one sentence."""
    sent = found.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            rows = []
            for h, k, *found in batch[["same", "item", "long", "agree", "first"]].itertuples(index=False, name=None):
                agree = np.logical_or.reduce([x for _, x, _ in unpacked(*found, len(own.tokens[k]))])
                if len(own.touched(k, agree)) > 1:
                    rows += [(h, int(t)) for t in np.unique(own.tokens[k][agree])]
            yield pd.DataFrame(rows, columns=["same", "token"])

    return gathered(found.mapInPandas(run, "same string, token int").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("n")), size)


def judged(found: DataFrame, block: Block, limit: float) -> DataFrame:
    """(same, item, covered): the items that each text holds, without stock sentences that more than ``limit`` texts hold."""
    sent = found.sparkSession.sparkContext.broadcast(block)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            rows = []
            for k, *found in batch[["item", "long", "agree", "first"]].itertuples(index=False, name=None):
                touched = own.touched(k, np.logical_or.reduce([x for _, x, _ in unpacked(*found, len(own.tokens[k]))]))
                if len(touched) == 1:
                    rows.append((k, int(touched[0])))
            yield pd.DataFrame(rows, columns=["item", "sentence"])

    stock: dict[int, set[int]] = {}
    votes = found.mapInPandas(vote, "item int, sentence int").groupBy("item", "sentence").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    for r in votes.collect():  # at most the sentences of the block
        stock.setdefault(r["item"], set()).add(r["sentence"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            rows = [(h, k, own.share(k, unpacked(*found, len(own.tokens[k])), stock.get(k, set()))) for h, k, *found in batch[["same", "item", "long", "agree", "first"]].itertuples(index=False, name=None)]
            yield pd.DataFrame([r for r in rows if r[2] >= COVERED], columns=["same", "item", "covered"])

    return found.mapInPandas(run, "same string, item int, covered double")
