"""Texts decoded with a wrong character encoding: found and, where possible, restored.

Near-twins are words that agree once their non-ASCII characters are stripped.
Each rare spelling is aligned with the most frequent spelling of its skeleton;
the runs between the common ASCII anchors give pairs (original, garbled), and
a pair of encodings is learned when it explains such pairs on enough different
skeletons.  The learned mappings are then applied to every non-ASCII word: a
word is garbled if undoing a mapping yields a word of the corpus that is more
frequent, or if the undone bytes form valid multi-byte text that the garbled
spelling, with its stray symbols, can't be by chance.  Replacement and control
characters are garbled in any case.  Frequencies count distinct texts, so that
copies of a garbled text don't make its spellings usual.

Defined results: null and empty texts are not garbled; all copies of a garbled
text are found; a text without repair keeps its wording.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, cut

# Encodings that texts are stored in, and encodings they get decoded with by mistake.
STORED = ["utf-8", "cp1252", "latin-1", "mac_roman", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859-5", "cp437", "cp850", "cp852", "cp1254", "iso8859-9", "iso8859-15", "mac_latin2", "euc_jp", "shift_jis"]
DECODED = ["cp1252", "latin-1", "mac_roman", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "cp852", "cp1254", "iso8859-5", "iso8859-15", "mac_cyrillic", "mac_latin2"]
MULTIBYTE = {"utf-8", "euc_jp", "shift_jis"}
#: Different skeletons a pair of encodings must explain, share of the best pair's skeletons that is enough, and ASCII letters of a skeleton.
MIN_SKELETONS, SKELETON_LETTERS = 2, 3
#: How much more frequent the undone word must be, and the non-ASCII characters that a word needs where only frequency tells.
MORE_FREQUENT, TELLING_CHARS = 3.0, 3
#: The same for a word of fewer telling characters, and the non-ASCII characters of a word without skeleton that teach a mapping.
FAR_MORE_FREQUENT, TEACHING_CHARS = 50.0, 5
WORD = re.compile(r"(?:[A-Za-z0-9]*[^\x00-\x7f]+[A-Za-z0-9]*)+")
RUN = re.compile(r"[^\x00-\x7f]+")
CERTAIN = re.compile("[\x80-\x84\x86-\x9f�]")


@cache
def _byte_of(codec: str) -> dict[str, int]:
    """Character -> byte of a single-byte codec; bytes it leaves undefined stand for themselves, as lenient decoders have it."""
    out = {}
    for b in range(255, -1, -1):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


@cache
def _char_of(codec: str) -> list[str]:
    table = [chr(b) for b in range(256)]
    for ch, b in _byte_of(codec).items():
        table[b] = ch
    return table


def garble(text: str, stored: str, decoded: str) -> str | None:
    """text stored in one encoding and decoded with another."""
    try:
        raw = text.encode(stored) if stored in MULTIBYTE else bytes(_byte_of(stored)[c] for c in text)
    except (UnicodeEncodeError, KeyError):
        return None
    return "".join(_char_of(decoded)[b] for b in raw)


@cache
def _undo(word: str, stored: str, decoded: str) -> str | None:
    table = _byte_of(decoded)
    try:
        raw = bytes(table[c] for c in word)
        return raw.decode(stored) if stored in MULTIBYTE else "".join(_char_of(stored)[b] for b in raw)
    except (KeyError, UnicodeDecodeError):
        return None


def undo(word: str, stored: str, decoded: str) -> str | None:
    """The original of a garbled word, also if it was garbled twice; None where the bytes don't fit."""
    out = _undo(word, stored, decoded)
    if out is None or out == word:
        return None
    if stored == "utf-8":
        for _ in range(2):
            again = _undo(out, stored, decoded)
            if again is None or again == out or again.isascii():
                break
            out = again
    return out


def words(text: str | None) -> set[str]:
    """The words of a text that hold a non-ASCII character."""
    return set(WORD.findall(text)) if text and not text.isascii() else set()


def skeleton(word: str) -> str:
    """A word without its non-ASCII characters, case kept."""
    return RUN.sub("", word)


def aligned(original: str, garbled: str) -> list[tuple[str, str]]:
    """Pairs of non-ASCII runs between the same ASCII anchors of two words with one skeleton; [] if the anchors differ."""
    a, b = (re.split(r"([^\x00-\x7f]+)", w) for w in (original, garbled))
    if a[::2] != b[::2]:
        return []
    return [(x, y) for x, y in zip(a[1::2], b[1::2]) if x != y]


@cache
def explaining(original: str, garbled: str) -> list[tuple[str, str]]:
    """The pairs of encodings that turn one run into the other."""
    return [(s, d) for s in STORED for d in DECODED if s != d and garble(original, s, d) == garbled]


def odd(word: str) -> bool:
    """Whether a word holds a sign that words of no language hold: a symbol, a control, an inner capital after a small letter of another kind."""
    inner = word.strip("°±µ×–—‘’“”„…")
    if any(unicodedata.category(c)[0] in "SCZ" or unicodedata.category(c) in ("No", "Po", "Pi", "Pf", "Ps", "Pe", "Lm", "Pd") or c in "ªº" for c in inner if not c.isascii()):
        return any(unicodedata.category(c)[0] == "L" and not c.isascii() for c in word) or len(RUN.sub("", inner)) < len(inner) - 1
    return False


def japanese(text: str) -> bool:
    return all("぀" <= c <= "ヿ" or "一" <= c <= "鿿" or c in "々、。「」・ー" or c.isascii() for c in text) and any("぀" <= c <= "ヿ" for c in text)


def valid_by_itself(word: str, original: str, stored: str) -> bool:
    """Whether undone multi-byte text is evidence without a frequency."""
    if any(unicodedata.category(c)[0] == "C" or c == "�" for c in original):
        return False
    if stored == "utf-8":
        return len(original) < len(word) and odd(word)
    return stored in MULTIBYTE and len(RUN.sub("", word)) + 4 <= len(word) and japanese(original)


def times_more(word: str, stored: str, alone: bool) -> float | None:
    """How many times more frequent than the word its original must be; None where frequency tells nothing."""
    bare = skeleton(word)
    if alone or stored == "utf-8" or len(word) - len(bare) >= TELLING_CHARS or len(bare) >= SKELETON_LETTERS:
        return MORE_FREQUENT
    return FAR_MORE_FREQUENT if len(bare) >= 2 or bare and odd(word) else None


def doc_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, same, word): the distinct non-ASCII words of each document, with a hash of its text; ASCII documents never leave the JVM."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, h, w) for k, h, t in zip(batch[key], batch["same"], batch[text]) for w in words(t)]
            yield pd.DataFrame(rows, columns=[key, "same", "word"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.xxhash64(text).alias("same"), text).where(F.col(text).rlike(r"[^\x00-\x7f]")).mapInPandas(run, f"{key} {kind}, same bigint, word string")


def learned_pairs(vocabulary: DataFrame) -> list[tuple[str, str]]:
    """The pairs of encodings learned from near-twins.  vocabulary: (word, n).  At most len(STORED) * len(DECODED) rows reach the driver."""
    skeletons = vocabulary.withColumn("skeleton", F.regexp_replace("word", r"[^\x00-\x7f]+", "")).where(F.length("skeleton") >= SKELETON_LETTERS)
    best = skeletons.groupBy("skeleton").agg(F.max_by("word", F.struct("n", "word")).alias("original"), F.max("n").alias("most"))
    twins = skeletons.join(best, "skeleton").where(f"word <> original and most >= n * {MORE_FREQUENT}").select("skeleton", "original", "word")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for s, o, w in zip(batch["skeleton"], batch["original"], batch["word"]):
                runs = aligned(o, w)
                fits = [set(explaining(x, y)) for x, y in runs]
                out += [(s, *p) for p in (set.intersection(*fits) if fits else ())]
            yield pd.DataFrame(out, columns=["skeleton", "stored", "decoded"])

    def unaligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, n, s, d, u) for w, n in zip(batch["word"], batch["n"]) for s in STORED for d in DECODED if s != d and (u := undo(w, s, d)) is not None]
            yield pd.DataFrame(rows, columns=["skeleton", "n", "stored", "decoded", "original"])

    # words of another script have an empty skeleton: all their characters are aligned one by one
    bare = vocabulary.where(rf"word rlike '^[^\\x00-\\x7f]{{{TEACHING_CHARS},}}$'")
    undone = bare.mapInPandas(unaligned, "skeleton string, n bigint, stored string, decoded string, original string")
    undone = undone.join(vocabulary.select(F.col("word").alias("original"), F.col("n").alias("most")), "original").where(f"most >= n * {MORE_FREQUENT}")
    explained = twins.mapInPandas(run, "skeleton string, stored string, decoded string").unionByName(undone.select("skeleton", "stored", "decoded"))
    counts = explained.groupBy("stored", "decoded").agg(F.countDistinct("skeleton").alias("n")).where(f"n >= {MIN_SKELETONS}")
    return [(r.stored, r.decoded) for r in counts.orderBy(F.desc("n"), "stored", "decoded").collect()]


def garbled_words(vocabulary: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(word, original): the garbled words of the vocabulary; original is null where it can't be regained."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for w, n in zip(batch["word"], batch["n"]):
                certain = bool(CERTAIN.search(w))
                tries = {}
                for k, (s, d) in enumerate(pairs):
                    u = undo(w, s, d)
                    if u is not None and not any(unicodedata.category(c)[0] == "C" for c in u):
                        alone = valid_by_itself(w, u, s)
                        need = 0.0 if certain else times_more(w, s, alone)
                        if need is not None and u not in tries:
                            tries[u] = (k, alone, need)
                out += [(w, n, u, alone, k, need) for u, (k, alone, need) in tries.items()]
                if certain:
                    out.append((w, n, None, True, len(pairs), 0.0))
            yield pd.DataFrame(out, columns=["word", "n", "original", "alone", "rank", "need"])

    tried = vocabulary.mapInPandas(run, "word string, n bigint, original string, alone boolean, rank int, need double")
    known = vocabulary.select(F.col("word").alias("original"), F.col("n").alias("most"))
    judged = tried.join(known, "original", "left").withColumn("seen", F.coalesce(F.col("most") >= F.col("n") * F.col("need"), F.lit(False)))
    judged = judged.where("seen or alone")
    best = F.max_by("original", F.struct(F.col("original").isNotNull().alias("a"), F.col("seen").alias("b"), F.coalesce("most", F.lit(0)).alias("c"), (-F.col("rank")).alias("d")))
    return judged.groupBy("word").agg(best.alias("original"))


def garbled_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, word, original): every garbled word of every document."""
    own = cut(doc_words(docs, key, text))
    vocabulary = cut(own.select("word", "same").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    wrong = cut(garbled_words(vocabulary, learned_pairs(vocabulary)))
    return own.join(broadcast_checked(wrong), "word").select(key, "word", "original")


def restored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, restored_text, n_garbled, n_restored) of the affected documents, each garbled word replaced by its original."""
    wrong = garbled_documents(docs, key, text)
    mapping = wrong.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", F.coalesce("original", "word")))).alias("_map"), F.count(F.lit(1)).alias("n_garbled"), F.count("original").alias("n_restored"))

    @F.pandas_udf("string")
    def repair(t: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([WORD.sub(lambda x, of=dict(of): of.get(x.group(), x.group()), s) for s, of in zip(t, m)])

    return docs.select(key, text).join(mapping, key).select(key, repair(text, "_map").alias("restored_text"), "n_garbled", "n_restored")
