"""Nested records and units."""

import json

from paperloom.operators import nested, units


def payloads(spark, docs, extra=False):
    rows = [(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "payload_id bigint, doc_json string")
    return df.selectExpr("*", "'x' as value", "'y' as node_path", "1 as doc") if extra else df


DOC = {"source_pdf": "x", "sections": [{"heading": "A", "page_start": "3", "figures": None, "subsections": {"heading": "B", "records": [{"text": "t", "figures": {"image_id": "f", "page": 2}}, {"figures": ["g", "h"]}]}}, {"heading": "C", "records": {"heading": "r"}, "unknown": [1]}]}


def test_nodes_of_dirty_payloads(spark):
    got = nested.flatten(payloads(spark, [DOC, '{"sections": [', None, "[]", {"sections": None}, {}, DOC], extra=True)).collect()
    want = {("s1", "root", "section"), ("s1/s1", "s1", "section"), ("s2", "root", "section"), ("s1/s1/r1", "s1/s1", "record"), ("s1/s1/r2", "s1/s1", "record"), ("s2/r1", "s2", "record"), ("s1/s1/r1/f1", "s1/s1/r1", "figure"), ("s1/s1/r2/f1", "s1/s1/r2", "figure"), ("s1/s1/r2/f2", "s1/s1/r2", "figure")}
    assert sorted((r.payload_id, r.node_path, r.parent_path, r.node_kind) for r in got) == sorted((i, *w) for i in (0, 6) for w in want)


def test_tables_and_schema(spark):
    docs = payloads(spark, [DOC])
    assert {r.node_path: r.page_start for r in nested.section_table(docs).collect()} == {"s1": 3, "s1/s1": None, "s2": None}
    assert {(r.node_path, r.image_id, r.page) for r in nested.figure_table(docs).collect()} == {("s1/s1/r1/f1", "f", 2), ("s1/s1/r2/f1", "g", None), ("s1/s1/r2/f2", "h", None)}
    merged = {(r.node_kind, r.level, r.field): r.type for r in nested.merged_schema(docs).collect()}
    # a lone value counts as a list of one; types that differ are VARIANT
    assert merged["section", 1, "page_start"] == "STRING" and merged["section", 1, "records"].startswith("OBJECT") and merged["record", 2, "figures"] == "VARIANT" and merged["section", 1, "unknown"] == "ARRAY<BIGINT>"
    assert nested.infer(docs).depth == 2 and nested.infer(docs.where("false")).depth == 0


def test_large_payloads_are_spread(spark):
    """One payload of 20 MB: the same nodes, in several tasks."""
    from pyspark.sql import functions as F

    doc = {"sections": [{"heading": f"h{i}", "records": [{"text": "x" * 900, "figures": ["a", "b"]} for _ in range(10)]} for i in range(2000)]}
    docs = payloads(spark, [doc, DOC])
    assert docs.agg(F.max(F.length("doc_json"))).first()[0] > 4 * nested.LARGE
    got = nested.flatten(docs)
    tasks = got.where("payload_id = 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 2000 + 20000 + 40000
    # spread or not, the nodes are the same
    small = payloads(spark, [DOC, {"sections": [DOC["sections"][0]] * 3}])
    columns = ["payload_id", "node_path", "parent_path", "node_kind", "ordinal"]
    assert sorted(nested.flatten(small).select(*columns).collect()) == sorted(nested.flatten(small, large=10).select(*columns).collect())


def test_any_depth(spark):
    doc: dict = {"heading": "leaf"}
    for _ in range(19):
        doc = {"heading": "h", "subsections": [doc]}
    nodes = nested.flatten(payloads(spark, [{"sections": [doc]}]))
    assert nodes.count() == 20
    assert nested.flatten(payloads(spark, [])).count() == 0


def q(text):
    return {(k, v) for k, v, _ in units.quantities(text)}


def test_quantities():
    assert q("heated to −40 °C for 12 h, then 140 ° F") == {("temperature", 233150), ("time", 43200), ("temperature", 333150)}
    assert q("(2 × 45 mL) at 3 bar") == {("volume", 45000), ("pressure", 300000)}
    assert q("cooled to 48 to 49 deg C for 8–9 h") == {("temperature", 321150), ("temperature", 322150), ("time", 28800), ("time", 32400)}
    assert q("Weights (g): a 26.4, b 3.8. All in mg: x 1,5; y 2,5.") == {("mass", 26400000), ("mass", 3800000), ("mass", 1500), ("mass", 2500)}
    assert q("5.1 × 10⁻³ mol, 7.4 x 10^-3 mol, 5.2e-3 mol") == {("amount", 5100000), ("amount", 7400000), ("amount", 5200000)}
    assert q("for twenty-four hours at minus 10 °C") == {("time", 86400), ("temperature", 263150)}
    assert q("(1.4 mg/mL, M = 502.5 g/mol), flow 0.6 mL/min, 5 mol%, 20%, 3.1 equiv") == set()
    assert q("1H NMR (600 MHz, CDCl3) δ 7.84 (br s, 3H), 5.41 (d, J = 2.3 Hz, 9H)") == set()
    assert q("zoate (compound 1h) and zene (4g) precipitated, cf. Fig. 2h") == set()
    assert q("Yield: 8\n434 mg") != {("mass", 8434000)}
    assert q("") == q(None) == set()


def test_a_comma_before_three_digits():
    assert q("DMF (1,417 mL) and DBU (46.9 mg)") == {("volume", 1417000), ("mass", 46900)}
    assert q("DMF (1,417 mL) and DBU (46,9 mg)") == {("volume", 1417), ("mass", 46900)} or q("DMF (1,417 mL) and DBU (46,9 mg)") == {("volume", 1417), ("mass", 46900)}
    # the molar mass decides between 3 and 3,000 mmol
    assert ("amount", 3000000) in q("X (900 mg, 3,000 mmol)")
    assert any(not unique for *_, unique in units.quantities("1,417 mL"))


def test_identities_decide_between_combinations():
    # each record is silent about its notation; the molar mass alone tells the scale
    for text, with_, without in (("X (900 mg, 3,000 mmol)", ("amount", 3_000_000), ("amount", 3_000_000_000)), ("Y (1,250 g, 5 mmol)", ("mass", 1_250_000), ("mass", 1_250_000_000)), ("Z (2 mol) in THF (10,000 L)", ("volume", 10_000_000), ("volume", 10_000_000_000))):
        # without identities the same number is undecided and groups thousands
        blind = units.picked(found := units.stated(text), units.chosen(found, [], {}))
        assert (*without, False) in blind and (*with_, True) in units.quantities(text), text
    # where masses and amounts agree with nothing, the notation of the record is heard first
    loose = {"molar": (0.5, 1.5), "molarity": (0.0, 1.5)}
    assert ("amount", 3_000_000_000, True) in units.quantities("X (900.5 mg, 3,000 mmol)", loose)
    tight = {"molar": (2.5, 0.1), "molarity": (-0.7, 0.1)}
    assert ("amount", 3_000_000) in {x[:2] for x in units.quantities("X (900.5 mg, 3,000 mmol)", tight)}


def test_the_least_residual_is_found_exactly():
    """The tree search against all combinations."""
    import itertools
    import random

    rng = random.Random(3)
    spread = {"molar": (2.4, 0.4), "molarity": (-0.5, 0.5)}
    for _ in range(60):
        n = rng.randint(2, 7)
        found = []
        for i in range(n):
            v = rng.randint(1, 10**9)
            found.append((10 * i, rng.choice(["mass", "amount", "volume"]), ((v, "comma"), (1000 * v, "group")) if rng.random() < 0.6 else ((v, rng.choice(["", "point", "comma"])),)))
        links = units.linked(found, " " * (10 * n))
        sums = {}
        for pick in itertools.product(*[range(len(r)) for *_, r in found]):
            for style in ("comma", "point"):
                total = sum(units.NOTATION for (_, _, r), k in zip(found, pick) if r[k][1] and (r[k][1] == "comma") != (style == "comma"))
                for i, j, name, _ in links:
                    total += abs(units._log_ratio(name, found[i][2][pick[i]][0], found[j][2][pick[j]][0]) - spread[name][0]) / spread[name][1]
                sums[pick] = min(total, sums.get(pick, total))
        for i, (k, unique) in enumerate(units.chosen(found, links, spread)):
            if len(found[i][2]) > 1:
                best = [min(v for p, v in sums.items() if p[i] == c) for c in (0, 1)]
                assert unique == (abs(best[0] - best[1]) >= units.MARGIN) and (not unique or best[k] == min(best))


def test_units_of_columns(spark):
    """Mass equals density times volume, units unknown."""
    d = spark.createDataFrame([(1, 7.9, 0.79, 10.0), (2, 7900.0, 0.79, 10.0), (3, 7.9, None, 10.0), (4, -1.0, 0.79, 10.0), (5, 7.9, 790.0, 10.0)], "id int, mass double, density double, volume double")
    units_ = {"mass": {"g": 1.0, "mg": 1e-3}, "density": {"g/mL": 1.0, "kg/m3": 1e-3}, "volume": {"mL": 1.0, "L": 1e3}}
    got = {r.id: r for r in units.resolved(d, units_, [{"mass": 1, "density": -1, "volume": -1}]).collect()}
    assert got[1].unit == {"mass": "g", "density": "g/mL", "volume": "mL"} and got[1].residual < 1e-9
    # 7.9 g in mL with 790 kg/m3; 7900 is mg, or g in litres: two combinations fit
    assert got[5].unit["density"] == "kg/m3" and not got[2].is_unique and not got[3].is_unique and not got[4].is_unique
    assert units.resolved(d.where("false"), units_, [{"mass": 1, "density": -1, "volume": -1}]).count() == 0


def test_units_of_a_table(spark):
    df = spark.createDataFrame([(1, "5 mg. 5 mg", "a"), (2, None, "b"), (3, "", "c"), (4, "x" * 200_000 + " 7 mL", "d")], "record_id bigint, text string, quantity string")
    got = {(r.record_id, r.quantity, r.base_value) for r in units.normalised(df).collect()}
    assert got == {(1, "mass", 5000), (4, "volume", 7000)}
    assert units.normalised(df.where("false")).count() == 0


def test_quantities_survive_being_written():
    """Random values written in random notations and units come back exactly."""
    import random
    from fractions import Fraction

    rng = random.Random(11)
    spelled = {"mass": {"mg": 1000, "g": 10**6, "kilograms": 10**9, "µg": 1, "ug": 1}, "amount": {"mmol": 10**6, "μmol": 1000, "moles": 10**9}, "volume": {"mL": 1000, "cm³": 1000, "litres": 10**6, "uL": 1}, "time": {"s": 1, "min": 60, "hrs": 3600, "days": 86400}, "pressure": {"mbar": 100, "bar": 10**5, "kPa": 1000, "MPa": 10**6}}
    for _ in range(400):
        comma = rng.random() < 0.3
        parts, want = [], set()
        for _ in range(rng.randint(1, 6)):
            kind = rng.choice(list(spelled))
            unit, factor = rng.choice(list(spelled[kind].items()))
            value = Fraction(rng.randint(1, 9999), rng.choice([1, 10, 100]))
            digits = f"{float(value):.2f}".rstrip("0").rstrip(".")
            digits = digits.replace(".", ",") if comma else digits
            if value.denominator == 1 and value >= 1000 and rng.random() < 0.5:
                digits = f"{int(value) // 1000}{rng.choice('  ')}{int(value) % 1000:03d}"
            parts.append(rng.choice(["about {} was used", "({})", "2 × {} each", "for {}"]).format(digits + rng.choice(["", " ", " "]) + unit))
            want.add((kind, round(value * factor)))
        assert q("; then ".join(parts)) == want, parts


def test_temperatures_survive_being_written():
    for c in range(-80, 300, 7):
        for text in (f"{c} °C", f"{c}℃".replace("-", "−"), f"{c} degrees Celsius".replace("-", "minus ")):
            assert q(f"kept at {text} there") == {("temperature", c * 1000 + 273150)}, text
    assert q("at 212 °F and 300 K") == {("temperature", 373150), ("temperature", 300000)}
    assert q("at 10–20 °C") == {("temperature", 283150), ("temperature", 293150)}
