"""Variant spellings of one author linked.

Distinct names are parsed into a family part and given parts; which of two bare
words is the family name is told by how often each stands before or after a
comma or beside initials in the whole table.  Family parts one edit apart, a
swap of neighbours being one, are found without loss by what they share when a
letter is left out or all are put in order, however usual they are.  Candidates
sharing a family class and the letter of the given name are verified by
Monge-Elkan similarity and vetoed where given names or initials contradict;
near families whose spelled-out given names all contradict are kept apart;
stars (most linked spelling first) make clusters.  MinHash bands over padded
q-grams, which these keys replace, keep to a recall and compare far more pairs.

Defined results: null and blank names are ignored; a name is compared as stored,
so two strings that differ in case or blanks are two spellings; a name without
a partner is in no pair.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, shuffled

# Short forms of given names, and words of organisations with their abbreviations told by prefix.
SHORT_FORMS = """alex,sandy,sasha,xander:alexander; andy:andrew; tony:anthony; ben,benny,benji:benjamin; lottie,charlie,carlotta:charlotte; dima,mitya:dmitri; liz,beth,lizzie,betty,eliza,lisa:elizabeth;
paco,pancho,frank:francisco; fritz,fred,freddy,freddie:frederick; beppe,peppe,pino:giuseppe; greg:gregory; bella,isa,izzy:isabella; jenny,jen,jenn:jennifer; hans,hannes,jo:johannes; pepe:jose; kate,kathy,katie,kat,kitty:katherine;
lena,magda,leni:magdalena; peggy,maggie,meg,greta,madge,marge:margaret; max:maximilian; nick,nicky,nico,klaus:nicholas; penny:penelope; bob,rob,robbie,bobby,bert:robert; roz,ros,rosie:rosalind; susi,susie,sue,susan:susanne;
ted,teddy,theo:theodore; ula,ulla:urszula; vicky,vicki,vic,tori:victoria; bill,will,billy,willy,liam:william; jim,jimmy,jamie:james; mike,mick:michael; tom,tommy:thomas; dick,rick,rich:richard; dan,danny:daniel; dave:david; joe,joey:joseph;
sam:samuel; steve:stephen; matt:matthew; chris:christopher; pat,patty:patricia; ed,eddie:edward; harry,hank:henry; jack,johnny:john; kostya:konstantin; misha:mikhail; volodya,vova:vladimir; kolya:nikolai; lukasz,luke,luc:lukas; olya:olga; inge:ingrid; quin:quentin; jorg:jurgen; lou:louis; ron:ronald; ken:kenneth; tim:timothy; abby:abigail; becky:rebecca; debbie:deborah; sally:sarah; nat:natalie; val:valerie; vince:vincent; walt:walter; gus:august; gabe:gabriel; nate:nathaniel; zach:zachary"""
ORGANISATION = re.compile(r"\b(?:inst|consort|collab|group|laborat|lab|centre|center|univ|network|dept|depart|society|council|agency|initiative|catal|spectrosc|resea?rch|working|materials|coupling|synthesis)", re.I)
SUFFIX = re.compile(r"[\s,]+(?:jr|sr|iii|ph\.?d)\.?$", re.I)
FILLERS = {"the", "for", "on", "of", "and", "de", "in"}
ABBREVIATED = {"lab", "grp", "int", "res", "org", "soc", "sci"}
PARTICLES = {"van", "von", "de", "der", "den", "del", "della", "di", "da", "la", "le", "el", "al", "ter", "ten", "zu", "dos", "du"}
FORMAL = {s.strip(): formal.strip() for group in SHORT_FORMS.replace("\n", "").split(";") for shorts, formal in [group.split(":")] for s in shorts.split(",")}
#: q-gram length, similarity of family parts and the recall wanted there, most bands.
Q, SIMILARITY, RECALL, MOST_BANDS = 2, 0.45, 0.99, 40
#: Monge-Elkan similarity that verifies a pair.
VERIFIED = 0.84


def bands_and_rows(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """The most selective banding whose collision curve 1 - (1 - s^r)^b reaches the recall within ``most`` bands."""
    best = (1, 1)
    for r in range(1, 8):
        b = next((b for b in range(1, most + 1) if 1 - (1 - similarity**r) ** b >= recall), None)
        if b:
            best = (b, r)
    return best


def folded(s: str) -> str:
    """Lower case without accents; ae, oe, ue as one letter, so that both ways to write an umlaut agree."""
    s = s.lower() if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s.lower().replace("ø", "o").replace("ı", "i").replace("ł", "l").replace("ß", "ss").replace("đ", "d")) if not unicodedata.combining(c))
    return re.sub(r"([aou])e(?![aeiou])", r"\1", s)


def is_initials(word: str) -> bool:
    """J., J.-P., JP, J-P, J-PE, WL: capitals only, without a vowelled word's length."""
    letters = re.sub(r"[^\w]", "", word)
    return 0 < len(letters) <= 3 and letters.isupper() and (len(letters) <= 2 or not re.fullmatch(r"\w{3}", word))


def split_name(name: str) -> dict | None:
    """organisation: its words; else family and given as lists of raw words, and how sure the order is."""
    s = SUFFIX.sub("", re.sub(r"\s+", " ", name).strip())
    if not s:
        return None
    if ORGANISATION.search(s) and len(re.findall(r"\w+", s)) >= 3 or (len(re.findall(r"[\w-]{4,}", s)) >= 4 and not re.search(r"\b(?:van|von|de|der|el|al)\b", s, re.I)):
        return {"organisation": [w for w in re.findall(r"\w+", folded(s)) if w not in FILLERS and (len(w) > 3 or w in ABBREVIATED)]}
    if "," in s:
        family, _, given = s.partition(",")
        return {"family": family.split(), "given": given.split(), "sure": bool(given.strip())}
    parts = s.split(" ")
    if len(parts) == 1:
        return {"family": parts, "given": [], "sure": False}
    start = [i for i, w in enumerate(parts) if w.lower().strip(".") in PARTICLES]
    lead = [is_initials(w) for w in parts]
    if start and start[0] > 0:
        return {"family": parts[start[0] :], "given": parts[: start[0]], "sure": True}
    if start:  # particles first: the name, then what follows it
        k = start[-1] + 2
        return {"family": parts[:k], "given": parts[k:], "sure": True}
    if lead[0] and not lead[-1]:
        k = next(i for i, x in enumerate(lead) if not x)
        return {"family": parts[k:], "given": parts[:k], "sure": True}
    if lead[-1] and not lead[0]:
        k = len(parts) - next(i for i, x in enumerate(lead[::-1]) if not x)
        if k == 1:
            return {"family": parts[:1], "given": parts[1:], "sure": True}
        return {"family": parts[:1], "given": parts[1:], "sure": False}
    if len(parts) > 2 and any(lead[1:-1]):
        return {"family": parts[-1:], "given": parts[:-1], "sure": True}
    return {"family": parts[-1:], "given": parts[:-1], "sure": False}


def family_key(words: list[str]) -> str:
    return "".join(re.findall(r"\w+", folded(" ".join(words))))


def given_parts(words: list[str]) -> tuple[str, str, str]:
    """(full, initials, after): the spelled-out given name, the letters of all given parts, those after the spelled-out part."""
    spelled, letters, after = [], "", ""
    for w in words:
        for part in re.split(r"[-.\s]+", w):
            clean = re.sub(r"[^\w]", "", part)
            if not clean:
                continue
            if len(clean) == 1 or is_initials(part) and clean.isupper():
                low = folded(clean)
                letters += low
                after += low
            else:
                camel = re.findall(r"[A-Z][a-z]+", clean) if re.fullmatch(r"(?:[A-Z][a-z]+){2,}", clean) else [clean]
                for c in camel:
                    spelled.append(folded(c))
                    letters += spelled[-1][:1]
                    after = ""
    if len(spelled) == 1 and spelled[0] in FORMAL:  # the parts of a double name are no short forms
        formal = FORMAL[spelled[0]]
        return formal, letters.replace(spelled[0][0], formal[0], 1), after
    return "".join(spelled), letters, after


def levenshtein(a: str, b: str, most: int = 3) -> int:
    """Edit distance with neighbouring swaps as one, most + 1 beyond that."""
    if a == b:
        return 0
    # an edit changes at most two members of the set of letters
    if abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
        return most + 1
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, rows[-2][j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        rows.append(row)
    return min(rows[-1][-1], most + 1)


def near(a: str, b: str) -> float:
    """Similarity of two words: an edit or two of a long word, an abbreviation, an initial."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    short, long_ = sorted((a, b), key=len)
    if long_.startswith(short):
        return 0.9 if len(short) == 1 or len(short) >= 3 else 0.5
    d = levenshtein(a, b, 2)
    most = 0 if len(long_) < 4 else 1 if len(long_) < 8 else 2
    return 1 - d / len(long_) if d <= most else 0.0


def abbreviates(short: str, long_: str) -> bool:
    """Whether a shortened word keeps letters of another in order, from its first on."""
    rest = iter(long_)
    return 3 <= len(short) < len(long_) and short[0] == long_[0] and all(c in rest for c in short)


def near_word(a: str, b: str) -> float:
    """The same for words of organisations, which are also shortened inside."""
    short, long_ = sorted((a, b), key=len)
    return max(near(a, b), 0.85 if abbreviates(short, long_) else 0.0)


def monge_elkan(a: list[str], b: list[str], near=near) -> float:
    """The mean of the best word similarities, taken from the side with fewer words."""
    if len(a) > len(b):
        a, b = b, a
    return sum(max(near(x, y) for y in b) for x in a) / len(a) if a else 0.0


def same_author(a: dict, b: dict) -> bool:
    """Whether two parsed names may denote one author; both share a family class already."""
    if (a["organisation"] is not None) != (b["organisation"] is not None):
        return False
    if a["organisation"] is not None:
        x, y = list(a["organisation"]), list(b["organisation"])
        return len(x) == len(y) and monge_elkan(x, y, near_word) >= VERIFIED and min(max(near_word(w, v) for v in y) for w in x) >= 0.6
    if not a["letters"] or not b["letters"]:
        return False
    if a["full"] and b["full"]:
        d = levenshtein(a["full"], b["full"], 2)
        if d > 1 or d and min(len(a["full"]), len(b["full"])) < 3:
            return False
        if a["after"] and b["after"] and a["after"] != b["after"]:
            return False
    else:
        x, y = sorted((a["letters"], b["letters"]), key=len)
        if not y.startswith(x):
            return False
    return monge_elkan([a["family"], a["full"] or a["letters"][:1]], [b["family"], b["full"] or b["letters"][:1]]) >= VERIFIED


def parsed_names(names: DataFrame) -> DataFrame:
    """names: distinct (name).  (name, organisation, family, full, letters, after, head): head is what is banded; an organisation may have several."""

    key = lambda w: family_key(w) if w else None

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n in batch["name"]:
                p = split_name(n)
                if p and "organisation" in p:
                    rows.append((n, p["organisation"], None, None, None, True, None, None, None))
                elif p:
                    # the other reading of an unsure name: its first word, or its first as the family name
                    other = [p["family"], p["given"]] if p["sure"] else [p["given"][:1] if p["family"] == n.split()[-1:] else n.split()[-1:], p["family"] + p["given"][1:] if p["family"] == n.split()[-1:] else n.split()[:-1]]
                    rows.append((n, None, p["family"], p["given"], other, p["sure"], key(p["family"]), None if p["sure"] else key(other[0]), [key([w]) for w in p["given"]] if p["sure"] else None))
            yield pd.DataFrame(rows, columns=["name", "organisation", "a", "b", "other", "sure", "ka", "kb", "kg"])

    split = names.mapInPandas(first, "name string, organisation array<string>, a array<string>, b array<string>, other array<array<string>>, sure boolean, ka string, kb string, kg array<string>")
    split = cut(split)
    persons = split.where("organisation is null").drop("organisation")
    # how often a word is surely a family name, and surely a given name, over all names
    family = persons.where("sure").groupBy(F.col("ka").alias("word")).agg(F.count(F.lit(1)).alias("as_family"))
    given = persons.where("sure").select(F.explode("kg").alias("word")).where("length(word) > 1").groupBy("word").agg(F.count(F.lit(1)).alias("as_given"))
    seen = family.join(given, "word", "full").select("word", F.coalesce("as_family", F.lit(0)).alias("f"), F.coalesce("as_given", F.lit(0)).alias("g"))
    sure, unsure = persons.where("sure"), persons.where("not sure")
    for side in "ab":
        unsure = unsure.join(shuffled(seen.select(F.col("word").alias(f"k{side}"), F.col("f").alias(f"f{side}"), F.col("g").alias(f"g{side}"))), f"k{side}", "left").na.fill(0, [f"f{side}", f"g{side}"])
    swap = (F.col("fb") + F.col("ga")) > (F.col("fa") + F.col("gb"))
    unsure = unsure.select("name", F.when(swap & (F.size("other") == 2), F.col("other")[0]).otherwise(F.col("a")).alias("a"), F.when(swap & (F.size("other") == 2), F.col("other")[1]).otherwise(F.col("b")).alias("b"))
    both = sure.select("name", "a", "b").unionByName(unsure).withColumn("organisation", F.lit(None).cast("array<string>"))
    both = both.unionByName(split.where("organisation is not null").select("name", "a", "b", "organisation"))

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n, o, a, b in zip(batch["name"], batch["organisation"], batch["a"], batch["b"]):
                if o is not None:
                    # its own word, and any that isn't a known one of organisations, such as a misspelled one
                    own = sorted(w for w in o if not ORGANISATION.match(w) and w[:4] not in KNOWN) or sorted(o)
                    rows += [(n, sorted(o), None, None, None, None, w) for w in own]
                else:
                    full, letters, after = given_parts(list(b))
                    family = family_key(list(a))
                    rows.append((n, None, family, full, letters, after, family))
            yield pd.DataFrame(rows, columns=["name", "organisation", "family", "full", "letters", "after", "head"])

    return both.mapInPandas(second, "name string, organisation array<string>, family string, full string, letters string, after string, head string").where("head <> ''")


#: Beginnings of the other words that organisations share.
KNOWN = {"grp", "netw", "res", "lab", "appl", "appr", "chem", "reac", "info", "data", "mate", "synt", "work", "rese", "spec", "coup", "cata", "cons", "coll", "inst", "labo", "netw", "grou"}


def minhashes(head: str, bands: int, rows: int) -> list[int]:
    """One hash a band over the padded q-grams of a word."""
    padded = "#" * (Q - 1) + head + "#" * (Q - 1)
    grams = np.array([hash_text(padded[i : i + Q]) for i in range(len(padded) - Q + 1)], np.uint64)
    seeds = np.arange(1, bands * rows + 1, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        h = (grams[None, :] + seeds * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h = ((h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(1)
        least = h.min(axis=1).reshape(bands, rows)
        out = least[:, 0]
        for r in range(1, rows):
            out = (out * np.uint64(31)) ^ least[:, r]
    return [int(x) for x in (out >> np.uint64(1)).astype(np.int64)]


def hash_text(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s)


def edit_keys(w: Column) -> Column:
    """Hashes of which words one edit apart share one: of the word, of the word without each of its letters, and of its letters in order, for swaps."""
    n = F.length(w)
    without = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, n))))
    return F.array_distinct(F.concat(F.array(F.xxhash64(w), F.xxhash64(F.lit("letters"), F.array_sort(F.split(w, "")))), without))


def one_edit(a: str, b: str) -> Column:
    """Whether two words are one edit apart, a swap of neighbours being one."""
    v, w = F.col(a), F.col(b)
    swap = F.exists(F.sequence(F.lit(1), F.greatest(F.length(v) - 1, F.lit(1))), lambda i: F.concat(v.substr(F.lit(1), i - 1), v.substr(i + 1, F.lit(1)), v.substr(i, F.lit(1)), v.substr(i + 2, F.length(v))) == w)
    return (F.levenshtein(v, w, 1) == 1) | (F.length(v) == F.length(w)) & (v != w) & swap


def family_links(heads: DataFrame) -> DataFrame:
    """heads: (head, n spellings).  (head, class): each head with itself and with every more usual head it may misspell, however many spellings either has."""
    keyed = heads.where("length(head) >= 4").select("head", "n", F.explode(edit_keys(F.col("head"))).alias("key"))
    pairs = keyed.join(shuffled(keyed.select("key", F.col("head").alias("class"), F.col("n").alias("m"))), "key").where("head <> class and (m > n or m = n and class < head)")
    return pairs.where(one_edit("head", "class")).select("head", "class").distinct().unionByName(heads.select("head", F.col("head").alias("class")))


def apart(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(head, class, letter): near families whose spelled-out given names of one letter, in two spellings or more, all contradict each other, so that initials don't link them."""
    other = classes.where("head <> class")
    own = rows.where("full <> ''").select("head", "letter", "full").join(shuffled(other.select("head").union(other.select("class")).distinct()), "head").groupBy("head", "letter").agg(F.collect_set("full").alias("own"), F.count(F.lit(1)).alias("n"))
    both = other.join(own.where("n > 1").drop("n"), "head").join(own.select(F.col("head").alias("class"), "letter", F.col("own").alias("its")), ["class", "letter"])
    agree = F.exists("own", lambda f: F.exists("its", lambda g: F.levenshtein(f, g, 2) >= 0))
    return both.where(~agree).select("head", "class", "letter")


def links(parsed: DataFrame) -> DataFrame:
    """(a, b) with a < b: verified pairs of names."""
    heads = cut(parsed.groupBy("head").agg(F.count(F.lit(1)).alias("n")))
    classes = cut(family_links(heads))
    fields = ["name", "organisation", "family", "full", "letters", "after"]
    rows = parsed.withColumn("letter", F.coalesce(F.substring("letters", 1, 1), F.lit("")))
    rows = rows.join(classes, "head").join(shuffled(apart(rows, classes)), ["head", "class", "letter"], "left_anti").select("class", "letter", F.struct(*fields).alias("x"))
    pairs = rows.select("class", "letter", F.col("x").alias("a")).join(rows.select("class", "letter", F.col("x").alias("b")), ["class", "letter"]).where("a.name < b.name")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(a["name"], b["name"]) for a, b in zip(batch["a"], batch["b"]) if same_author(a, b)]
            yield pd.DataFrame(out, columns=["a", "b"])

    return pairs.select("a", "b").mapInPandas(verify, "a string, b string").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(name, center): star clusters.  Names with most links become centers first; linked names join the best center beside them."""
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    # rank: more links first, then longer and smaller names, so that spelled-out names lead
    rank = lambda d, n: F.struct(F.col(d).alias("d"), F.length(n).alias("l"), F.col(n).alias("n"))
    both = both.join(degree, "a").join(degree.select(F.col("a").alias("b"), F.col("d").alias("e")), "b")
    open_ = cut(both.select("a", "b", rank("d", "a").alias("ra"), rank("e", "b").alias("rb")))
    done = None
    while True:
        top = open_.groupBy("a").agg(F.first("ra").alias("ra"), F.max("rb").alias("best"))
        centers = top.where("ra > best").select(F.col("a").alias("center"))
        taken = open_.join(centers, F.col("b") == F.col("center"), "left_semi").groupBy("a").agg(F.max("rb").alias("rb")).select(F.col("a").alias("name"), F.col("rb")["n"].alias("center"))
        step = cut(taken.unionByName(centers.select(F.col("center").alias("name"), "center")))
        if step.isEmpty():
            return done if done is not None else step
        done = step if done is None else done.unionByName(step)
        gone = step.select(F.col("name").alias("a"))
        open_ = cut(open_.join(gone, "a", "left_anti").join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b", "ra", "rb"))


def clusters(refs: DataFrame, authors: str = "authors") -> DataFrame:
    """(name, center): every spelling that has a partner, with its cluster."""
    names = refs.select(F.explode(authors).alias("name")).where("trim(name) <> ''").distinct()
    return stars(cut(links(cut(parsed_names(names)))))


def variants(clustered: DataFrame) -> DataFrame:
    """(name_a, name_b): all pairs of spellings of a cluster, name_a < name_b in code point order."""
    a, b = (clustered.select("center", F.col("name").alias(f"name_{s}")) for s in "ab")
    return a.join(b, "center").where("name_a < name_b").select("name_a", "name_b")
