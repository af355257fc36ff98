"""Quantities written in running text, in one unit a kind.

A grammar finds numbers (digits in local notations, powers of ten, words),
ranges and lists with the unit they are stated in.  A comma before three digits
may group thousands or start decimals, which is the choice between a unit and
its thousandth, so such a quantity has two combinations of number and unit.
Among all combinations of a record the one with the smallest sum of residuals
is taken.  Residuals are those of the physical identities amount = mass / molar
mass and concentration = amount / volume, on a log scale, in units of the
spread that they have over all records where nothing is open; and a constant
for each number that is not in the notation of the record.  Each mass is held
against the amount nearest to it in its sentence and each amount against the
nearest volume, so the links are trees and the smallest sum is found exactly.
Where the best combination with another reading comes nearer than ``MARGIN``
the value is flagged as not unique.

``resolved`` does the same for columns of a table whose units are unknown.

Defined results: null and empty texts state nothing; a quantity repeated in a
text is given once; numbers without a unit, ratios of units, percentages and
compound labels are no quantities; an undecided comma groups thousands.
"""

from __future__ import annotations

import itertools
import json
import re
from bisect import bisect
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import log10

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

# The units read, by kind, as spelling -> factor to the common unit.
MICRO = "[µμu]"
MASS = {r"kilograms?|kgs?": Fraction(10**9), r"milligrams?|mgs?": Fraction(1000), rf"micrograms?|{MICRO}gs?": Fraction(1), r"nanograms?|ng": Fraction(1, 1000), r"grams?|grs?\b\.?|g": Fraction(10**6)}
AMOUNT = {r"millimol(?:e?s|es?)?|mmol|mMol": Fraction(10**6), rf"micromol(?:es?|s)?|{MICRO}mol": Fraction(1000), r"nanomol(?:es?|s)?|nmol": Fraction(1), r"kmol": Fraction(10**12), r"moles?|mol": Fraction(10**9)}
VOLUME = {r"millilit(?:re|er)s?|m[lL]|ccm?|cm\s?[³3]": Fraction(1000), rf"microlit(?:re|er)s?|{MICRO}[lL]": Fraction(1), r"lit(?:re|er)s?|[lL]": Fraction(10**6)}
TIME = {r"seconds?|secs?|s": Fraction(1), r"minutes?|mins?": Fraction(60), r"hours?|hrs?|h": Fraction(3600), r"days?|d": Fraction(86400), r"weeks?": Fraction(604800)}
PRESSURE = {r"mbar|hPa": Fraction(100), r"bars?": Fraction(100000), r"kPa": Fraction(1000), r"MPa": Fraction(10**6), r"atm(?:ospheres?)?": Fraction(101325), r"[tT]orrs?": Fraction(101325, 760), r"mm\s?Hg": Fraction("133.322387415"), r"psi": Fraction("6894.757293168"), r"Pa": Fraction(1)}
DEGREE = r"(?:°|º|deg(?:rees?)?\b\.?)"
TEMPERATURE = {rf"℃|{DEGREE}\s*(?:C(?:elsius)?|centigrade)": "C", rf"℉|{DEGREE}\s*F(?:ahrenheit)?": "F", r"K|[kK]elvins?": "K"}
KINDS = {"mass": MASS, "amount": AMOUNT, "volume": VOLUME, "temperature": TEMPERATURE, "time": TIME, "pressure": PRESSURE}
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
#: What may head a compound or figure label, and what follows a label that stands alone in brackets.
LABEL_HEAD = re.compile(r"(?:compounds?|products?|no\.|fig(?:ure|s)?\.?|scheme|table|entry|entries|ref(?:s|\.)?|sec\.?|cpd\.?)\s*$", re.I)
LABEL_TAIL = re.compile(r"\)\s*(?:was |were |is |has |had )?(?:precipitat|crystalli|form|obtain|isolat|elut|separat|deposit|result|appear)")
#: What the identities expect (log10 of g/mol and of mol/L) and their spread while no record tells; the least spread, and that of a molar mass stated beside.
EXPECTED, SPREAD, LEAST_SPREAD = {"molar": 2.5, "molarity": -0.7}, 0.3, 0.05
#: Residual of a number that isn't in the notation of its record: three powers of ten at the spread above.
NOTATION = 3 / SPREAD
#: Combinations whose sums of residuals differ by less are both possible.
MARGIN = 1.0

WORDS = {w: i for i, w in enumerate(ONES)} | {t: 10 * i for i, t in enumerate(TENS, 2)} | {f"{t}{j}{ONES[o]}": 10 * i + o for i, t in enumerate(TENS, 2) for o in range(1, 10) for j in "- "}
SPACE = "[ \\u00a0\\u2007\\u2009\\u202f]"
DIGITS = rf"(?:\d{{1,3}}(?:(?:{SPACE}|['’])\d{{3}})+(?:[.,]\d+)?|\d{{1,3}}(?:,\d{{3}}){{2,}}(?:\.\d+)?|\d{{1,3}}(?:\.\d{{3}}){{2,}}(?:,\d+)?|\d{{1,3}},\d{{3}}\.\d+|\d{{1,3}}\.\d{{3}},\d+|\d+(?:[.,]\d+)?)"
POWER = r"(?:\s?[×x*·]\s?10(?:\s?\^\s?\{?[-−–+]?\d+\}?|[⁻⁺]?[⁰¹²³⁴⁵⁶⁷⁸⁹]+)|[eE][-−–+]?\d+(?![\w]))"
WORD = "(?:" + "|".join(sorted(WORDS, key=len, reverse=True)) + r")\b"
SIGN = r"(?:(?<![\w.,°)])(?:minus\s+|[-−–]\s?))"
NUMBER = rf"(?:{SIGN}?{DIGITS}{POWER}?|(?:minus\s+)?(?i:{WORD}))"
JOIN = r"(?:\s*[-–−—~]\s*|\s+(?:to|and|or|until|through)\s+|\s*,\s+(?:and\s+|or\s+)?)"
UNITS = {f"{kind}{k}": spelling for kind, of in KINDS.items() for k, spelling in enumerate(of)}
UNIT = "(?:" + "|".join(f"(?P<{k}>{v})" for k, v in UNITS.items()) + r")(?![\w³²⁻°])"
PLAIN_UNIT = "(?:" + "|".join(UNITS.values()) + ")"
RATIO = rf"(?!\s*(?:/|%|(?:[·⋅]\s?)?{PLAIN_UNIT}\s?(?:\^?[-−–]1\b|⁻¹))|\^?[-−–]\d)"
STATED = re.compile(rf"(?<![\w.,/^])(?<!\d[-–])(?P<numbers>{NUMBER}(?:{JOIN}{NUMBER})*)(?P<gap>\s*){UNIT}{RATIO}")
SHARED = re.compile(rf"(?:\(\s*{UNIT}\s*\)|\b(?:all )?in {UNIT.replace('(?P<', '(?P<in_')})\s*:\s*(?P<list>(?:[^\d\n.;,:]*?\s{NUMBER}(?:\s*[;,]\s*(?:and\s+)?|\s+and\s+)?)+)")
ONE = re.compile(NUMBER)
#: Where a digit or a number word ends before a unit, the letters and signs of a list of numbers read backwards, and what must stand in a text with a shared unit.
ENDS = re.compile(r"(?<=[\d⁰¹²³⁴⁵⁶⁷⁸⁹}])\s*(?=(?:" + "|".join(UNITS.values()) + r")(?![\w³²⁻°]))")
#: The same for number words, over lower-case text.
WORD_ENDS = re.compile(r"(?:one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|teen|ty|zero)\s+(?=(?:" + "|".join(UNITS.values()).lower() + r")(?![\w³²⁻°]))")
BACK = re.compile(r"(?:[\d\s.,'’+\-−–—~×x*·^{}eE⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺\u00a0]|dna|ro|ot|litnu|hguorht|sunim)*")
BACK_WORDS = re.compile(r"(?:[\d\s.,'’+\-−–—~×x*·^{}⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺\u00a0A-Za-z])*")
SHARED_HINT = re.compile(r"(?:\)|in \w{1,12})\s*:")
MOLAR = re.compile(rf"\bM\s*=\s*({DIGITS})\s*g\s*/\s*mol")
SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[A-Z\d(])|\n\s*\n")
POWERED = re.compile(POWER + "$")
GROUPED = re.compile(rf"{SPACE}|['’]")
BY_NAME = {f"{kind}{k}": unit for kind, of in KINDS.items() for k, unit in enumerate(of.values())}
SUPERSCRIPT = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")


def notations(number: str) -> list[tuple[int, int, str]]:
    """(mantissa, power of ten, notation) of the values a number may have; the notation is '' (plain), 'point', 'comma' or 'group'."""
    s = number.strip()
    negative = re.match(r"minus\s+|[-−–]\s?", s)
    sign, s = (-1, s[negative.end() :]) if negative else (1, s)
    if s.lower() in WORDS:
        return [(sign * WORDS[s.lower()], 0, "")]
    scale = 0
    if not s[-1].isdigit() or "10" in s or "e" in s or "E" in s:
        power = POWERED.search(s)
        if power:
            s, tail = s[: power.start()], power.group().translate(SUPERSCRIPT)
            exponent = re.search(r"([-−–+]?)\s?(\d+)\}?$", re.sub(r"^\s?[×x*·]\s?10", "", tail))
            scale = int(exponent.group(2)) * (-1 if exponent.group(1) and exponent.group(1) in "-−–" else 1)
    s = GROUPED.sub("", s)

    def value(digits: str, mark: str, notation: str) -> tuple[int, int, str]:
        whole, _, rest = digits.partition(mark) if mark else (digits, "", "")
        return (sign * int(whole + rest), scale - len(rest), notation)

    if "," in s and "." in s:
        return [value(s.replace(",", ""), ".", "")] if s.rindex(".") > s.rindex(",") else [value(s.replace(".", ""), ",", "")]
    if s.count(",") > 1 or s.count(".") > 1:
        return [value(re.sub("[.,]", "", s), "", "")]
    if "." in s:
        return [value(s, ".", "point")]
    if "," in s:
        decimal = value(s, ",", "comma")
        return [decimal, value(s.replace(",", ""), "", "group")] if re.fullmatch(r"[1-9]\d{0,2},\d{3}", s) else [decimal]
    return [value(s, "", "")]


def to_base(kind: str, mantissa: int, power: int, unit: object) -> int:
    """A value in the common unit of its kind, rounded to a whole number, halves to even."""
    factor, shift = (unit, 0) if kind != "temperature" else {"C": (Fraction(1000), 273150), "K": (Fraction(1000), 0), "F": (Fraction(5000, 9), Fraction(-160000, 9) + 273150)}[unit]
    top, bottom = mantissa * factor.numerator * 10 ** max(power, 0), factor.denominator * 10 ** max(-power, 0)
    if kind == "temperature":
        return round(Fraction(top, bottom) + shift)
    whole, rest = divmod(top, bottom)
    return whole + (2 * rest > bottom or 2 * rest == bottom and whole % 2)


@lru_cache(1 << 16)
def readings(number: str, name: str) -> tuple[tuple[int, str], ...]:
    """(value in the common unit, notation) of the readings of a number stated in a unit; name: its group in the grammar."""
    kind = name.rstrip("0123456789").removeprefix("in_")
    unit = BY_NAME[name.removeprefix("in_")]
    values = ((to_base(kind, m, p, unit), n) for m, p, n in notations(number))
    return tuple((v, n) for v, n in values if kind != "temperature" or v >= 0)


def _label(text: str, match: re.Match) -> bool:
    """A compound or figure label such as (3g), (No. 4d) or Fig. 2h rather than a quantity."""
    if not re.fullmatch(r"\d{1,4}[a-zA-Z]", match.group()):
        return False
    before = text[max(0, match.start() - 14) : match.start()]
    return bool(LABEL_HEAD.search(before)) or before.endswith("(") and bool(LABEL_TAIL.match(text, match.end()))


def _ends(text: str) -> list[tuple[int, re.Pattern]]:
    """The places where a number ends before a unit, each with what its list of numbers may be made of."""
    found = [(m.start(), BACK) for m in ENDS.finditer(text)]
    low = text.lower()
    if len(low) != len(text):  # a letter whose small form is longer
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    words = [(m.start() + 1, BACK_WORDS) for m in WORD_ENDS.finditer(low)]
    return sorted(found + words, key=lambda x: x[0]) if words else found


def stated(text: str) -> list[tuple[int, str, tuple[tuple[int, str], ...]]]:
    """(place, kind, readings) of every number that has a unit.

    The grammar is only tried where a number ends before a unit, from where the list of numbers that ends there can begin.
    """
    out = []
    if ":" in text and SHARED_HINT.search(text):
        for m in SHARED.finditer(text):
            name = next(k for k, v in m.groupdict().items() if v is not None and k != "list")
            out += [(m.start("list") + n.start(), name.rstrip("0123456789").removeprefix("in_"), readings(n.group(), name)) for n in ONE.finditer(m["list"])]
    done = 0
    for end, back in _ends(text):
        if end < done:
            continue
        start = max(done, end - back.match(text[done:end][::-1]).end())
        m = STATED.search(text, start)
        while m and m.end("numbers") < end:
            m = STATED.search(text, m.end())
        if not m:
            continue
        done = m.end()
        if not _label(text, m):
            kind = m.lastgroup.rstrip("0123456789")
            out += [(m.start() + n.start(), kind, readings(n.group(), m.lastgroup)) for n in ONE.finditer(m["numbers"])]
    return [x for x in out if x[2]]


def linked(found: list[tuple[int, str, tuple]], text: str) -> list[tuple[int, int, str, float | None]]:
    """(of, to, identity, what it expects): each mass with the nearest amount of its sentence, each amount with the nearest volume."""
    cuts = [m.start() for m in SENTENCE.finditer(text)]
    molar = [(bisect(cuts, m.start()), log10(float(m.group(1).replace(",", ".")) or 1)) for m in MOLAR.finditer(text)] if " M" in text or "(M" in text else []
    where = [bisect(cuts, place) for place, *_ in found]
    out = []
    for kind, other, identity in (("mass", "amount", "molar"), ("amount", "volume", "molarity")):
        for i, (place, k, _) in enumerate(found):
            near = [j for j, x in enumerate(found) if k == kind and x[1] == other and where[j] == where[i]]
            if near:
                out.append((i, min(near, key=lambda j: (abs(found[j][0] - place), j)), identity, next((m for s, m in molar if s == where[i] and identity == "molar"), None)))
    return out


def _log_ratio(identity: str, a: int, b: int) -> float | None:
    """log10 of g/mol, or of mol/L, of two values in common units."""
    if a <= 0 or b <= 0:
        return None
    return log10(a / b) + (3 if identity == "molar" else -3)


def chosen(found: list[tuple[int, str, tuple]], links: list[tuple[int, int, str, float | None]], spread: dict[str, tuple[float, float]]) -> list[tuple[int, bool]]:
    """(reading, whether it is unique) of each quantity, by the smallest sum of residuals over all combinations.

    spread: for each identity the log10 it has and its spread.
    """
    below: dict[int, list] = {}
    for i, j, identity, expected in links:
        below.setdefault(j, []).append((i, identity, expected))
    roots = set(range(len(found))) - {i for i, *_ in links}

    def cost(i: int, k: int, style: str, fixed: dict[int, int]) -> float:
        """The least sum of a quantity with reading k and of all that hang on it."""
        value, notation = found[i][2][k]
        total = NOTATION if notation in ("comma", "point", "group") and (notation == "comma") != (style == "comma") else 0.0
        for child, identity, expected in below.get(i, ()):
            least = None
            for c in (fixed[child],) if child in fixed else range(len(found[child][2])):
                own = cost(child, c, style, fixed)
                ratio = _log_ratio(identity, found[child][2][c][0], value)
                if ratio is not None:
                    mean, width = spread[identity] if expected is None else (expected, LEAST_SPREAD)
                    own += abs(ratio - mean) / max(width, LEAST_SPREAD)
                least = own if least is None else min(least, own)
            total += least
        return total

    def whole(fixed: dict[int, int]) -> float:
        return min(sum(min(cost(i, k, style, fixed) for k in ((fixed[i],) if i in fixed else range(len(found[i][2])))) for i in roots) for style in ("comma", "point"))

    out = [(0, True)] * len(found)
    for i, (_, _, values) in enumerate(found):
        if len(values) > 1:
            sums = [whole({i: k}) for k in range(len(values))]
            best = min(range(len(sums)), key=sums.__getitem__)
            unique = all(s - sums[best] >= MARGIN for k, s in enumerate(sums) if k != best)
            out[i] = (best if unique else len(values) - 1, unique)
    return out


def picked(found: list[tuple[int, str, tuple]], choice: list[tuple[int, bool]]) -> set[tuple[str, int, bool]]:
    """The distinct quantities with the chosen readings; one that is stated uniquely anywhere is unique."""
    unique: dict[tuple[str, int], bool] = {}
    for (_, q, values), (k, u) in zip(found, choice):
        unique[q, values[k][0]] = unique.get((q, values[k][0]), False) or u
    return {(q, v, u) for (q, v), u in unique.items()}


def parsed(df: DataFrame, key: str = "record_id", text: str = "text") -> DataFrame:
    """(key, sure, open, logs): one row a text: its quantities; in a text with a number of several readings, all of them with their links; else the identities' log ratios.  No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t in zip(batch[key], batch[text]):
                found = stated(t)
                if not found:
                    continue
                if any(len(r) > 1 for *_, r in found):
                    rows.append((k, [], json.dumps([found, linked(found, t)]), []))
                    continue
                sure = [{"quantity": q, "base_value": v} for q, v in {(q, r[0][0]) for _, q, r in found}]
                kinds = {q for _, q, _ in found}
                pairs = linked(found, t) if "amount" in kinds and len(kinds & {"mass", "volume"}) else []
                logs = [{"identity": n, "log": x} for i, j, n, e in pairs if e is None and (x := _log_ratio(n, found[i][2][0][0], found[j][2][0][0])) is not None]
                rows.append((k, sure, None, logs))
            yield pd.DataFrame(rows, columns=[key, "sure", "open", "logs"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).where(f"{text} <> ''").mapInPandas(run, f"{key} {kind}, sure array<struct<quantity:string,base_value:bigint>>, open string, logs array<struct<identity:string,log:double>>")


def spreads(parsed_texts: DataFrame) -> dict[str, tuple[float, float]]:
    """The median and the median deviation of each identity's log over all texts; two rows reach the driver."""
    logs = parsed_texts.select(F.explode("logs").alias("l")).select("l.*")
    medians = {r.identity: r.m for r in logs.groupBy("identity").agg(F.percentile_approx("log", 0.5).alias("m")).collect()}
    if not medians:
        return {n: (e, SPREAD) for n, e in EXPECTED.items()}
    middle = F.element_at(F.create_map(*[F.lit(x) for kv in medians.items() for x in kv]), F.col("identity"))
    widths = {r.identity: r.w for r in logs.groupBy("identity").agg(F.percentile_approx(F.abs(F.col("log") - middle), 0.5).alias("w")).collect()}
    return {n: (medians.get(n, e), max(widths.get(n, SPREAD), LEAST_SPREAD)) for n, e in EXPECTED.items()}


def quantities(text: str | None, spread: dict[str, tuple[float, float]] | None = None) -> set[tuple[str, int, bool]]:
    """The distinct (quantity, value in the common unit, whether its reading is unique) of one text."""
    found = stated(text) if text else []
    return picked(found, chosen(found, linked(found, text), spread or {n: (e, SPREAD) for n, e in EXPECTED.items()})) if found else set()


def normalised(df: DataFrame, key: str = "record_id", text: str = "text") -> DataFrame:
    """(key, quantity, base_value, is_unique): the distinct quantities of each row's text.  No shuffle but for two medians."""
    texts = cut(parsed(df, key, text))
    spread = spreads(texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, o in zip(batch[key], batch["open"]):
                found, links = json.loads(o)
                rows += [(k, *x) for x in picked(found, chosen(found, links, spread))]
            yield pd.DataFrame(rows, columns=[key, "quantity", "base_value", "is_unique"])

    kind = df.schema[key].dataType.simpleString()
    sure = texts.select(key, F.explode("sure").alias("q")).select(key, "q.*", F.lit(True).alias("is_unique"))
    opened = texts.where("open is not null").select(key, "open").mapInPandas(run, f"{key} {kind}, quantity string, base_value bigint, is_unique boolean")
    return sure.unionByName(opened)


def resolved(df: DataFrame, units: dict[str, dict[str, float]], identities: list[dict[str, float]], margin: float = MARGIN, spread: float = SPREAD) -> DataFrame:
    """df with the columns ``unit`` (column -> unit), ``residual`` and ``is_unique``: the combination of units with the least sum of log residuals.

    units: for each column its possible units with their factors to the common
    one.  identities: products of powers of columns that are 1 in common units,
    such as {"mass": 1, "density": -1, "volume": -1}.  A null or a value that is
    not positive leaves its identities out; a row without any identity keeps the
    first units and is flagged.  All combinations stand in one expression, no
    shuffle; their number is the product of the numbers of units.
    """
    names = list(units)
    log: dict[str, Column] = {n: F.log10(F.when(F.col(n) > 0, F.col(n).cast("double"))) for n in names}
    sums = [sum((F.lit(float(p)) * log[n] for n, p in i.items()), F.lit(0.0)) for i in identities]
    tries = []
    for k, combination in enumerate(itertools.product(*units.values())):
        shift = {n: log10(units[n][u]) for n, u in zip(names, combination)}
        parts = [F.abs(s + F.lit(float(sum(p * shift[n] for n, p in i.items())))) for s, i in zip(sums, identities)]
        total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)) / spread
        tries.append(F.struct(total.alias("residual"), F.lit(k).alias("k"), F.create_map(*[F.lit(x) for nu in zip(names, combination) for x in nu]).cast("map<string,string>").alias("unit")))
    known = F.coalesce(*sums).isNotNull() if sums else F.lit(False)
    # maps can't be sorted: the order is by residual and place
    ranked = F.array_sort(F.array(*[F.struct(t["residual"], t["k"]) for t in tries]))
    d = df.withColumn("_r", ranked)
    gap = F.get(F.col("_r"), F.lit(1))["residual"] - F.col("_r")[0]["residual"] if len(tries) > 1 else F.lit(float("inf"))
    best = F.get(F.array(*[t["unit"] for t in tries]), F.col("_r")[0]["k"])
    return d.select(*df.columns, best.alias("unit"), F.col("_r")[0]["residual"].alias("residual"), (known & (gap >= margin)).alias("is_unique"))
