"""Deeply nested JSON documents to flat tables of sections, records and figures.

The schema is inferred first: one pass merges, for every level and kind of
node, the types of all fields, with a lone value counted as a list of one.  The
merged schema tells how many levels there are, which child lists each kind has
and what type each field gets.  Then each array level is exploded into the rows
of the next: a row carries its own fields, its path (the surrogate key), its
parent's path and its place, and only rows that still have lists carry them.
Payloads of more than ``LARGE`` characters are spread over all tasks after every
level, so that one huge payload is not the work of one task; the others need no
shuffle.

Defined results: a payload that is null, cut off or no JSON object has no
nodes; a missing or null list has no nodes; a lone value where a list is usual
is a list of one; null elements keep their place and are nodes; repeated
payloads each keep their own nodes; a field of another type than the merged one
is null.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a payload from which on its nodes are spread over tasks level by level.
LARGE = 4_000_000
#: The lists of a payload, and of each kind of node: key, kind of its elements, letter of their paths.
ROOT = ("sections", "section", "s")
LISTS = {"section": (("subsections", "section", "s"), ("records", "record", "r"), ("figures", "figure", "f")), "record": (("figures", "figure", "f"),), "figure": ()}


def as_list(value: str, key: str) -> str:
    """SQL: the list under ``key`` of a variant object as array<variant>; a lone value counts as a list of one."""
    at = f"try_variant_get({value}, '$.{key}', 'variant')"
    return f"CASE WHEN {at} IS NULL OR is_variant_null({at}) THEN CAST(array() AS array<variant>) ELSE coalesce(try_variant_get({value}, '$.{key}', 'array<variant>'), array({at})) END"


def parsed(df: DataFrame, json: str = "doc_json") -> DataFrame:
    """df with the column ``doc``: the payload as VARIANT, null unless it is complete JSON."""
    return df.withColumn("doc", F.try_parse_json(F.col(json)))


def fields_of(schema: str | None) -> dict[str, str]:
    """The fields of an OBJECT<...> or ARRAY<OBJECT<...>> type with their types; none for another type."""
    schema = (schema or "").removeprefix("ARRAY<")
    if not schema.startswith("OBJECT<"):
        return {}
    inner, out, depth, start, quoted = schema[7 : schema.rindex(">") - (schema.count("<") < schema.count(">"))] + ",", {}, 0, 0, False
    for i, ch in enumerate(inner):
        quoted ^= ch == "`"
        depth += (ch == "<") - (ch == ">") if not quoted else 0
        if ch == "," and depth == 0 and not quoted:
            name, _, kind = inner[start:i].strip().rpartition(": ") if "<" not in inner[start:i] else inner[start:i].strip().partition(": ")
            out[name.strip("`")] = kind
            start = i + 1
    return out


@dataclass
class Merged:
    """The merged schema: for each section level, the fields of its sections, of their records, and of both's figures; and the size of the largest payload."""

    levels: list[dict[str, str]] = field(default_factory=list)
    largest: int = 0

    @property
    def depth(self) -> int:
        return len(self.levels)

    def fields(self, kind: str) -> dict[str, str]:
        """The fields of a kind over all levels; types that differ become VARIANT."""
        out: dict[str, str] = {}
        for level in self.levels:
            for name, t in fields_of(level.get(kind)).items():
                out[name] = t if out.get(name, t) in (t, "VOID") else out[name] if t == "VOID" else "VARIANT"
        return out

    def has(self, level: int, kind: str, key: str) -> bool:
        """Whether any node of a kind at a level has a list (or lone value) under a key."""
        return 0 <= level < self.depth and fields_of(self.levels[level].get(kind)).get(key, "VOID") != "VOID"


def infer(df: DataFrame, json: str = "doc_json", step: int = 8) -> Merged:
    """The merged schema of all payloads, in one pass; one row reaches the driver.  ``step`` levels are looked at, and twice as many as long as the last has nodes."""
    depth = step
    while True:
        # top sections are looked at one by one, so that no row holds a whole payload for every level
        d = parsed(df.select(json), json).selectExpr(f"length({json}) AS size", f"explode_outer({as_list('doc', ROOT[0])}) AS top")
        d = d.selectExpr("size", "CASE WHEN top IS NULL THEN CAST(array() AS array<variant>) ELSE array(top) END AS section0")
        below = lambda of, key: f"flatten(transform({of}, v -> {as_list('v', key)}))"
        for k in range(depth):
            d = d.selectExpr("*", f"{below(f'section{k}', 'records')} AS record{k}", f"{below(f'section{k}', 'subsections')} AS section{k + 1}")
        figures = [f"concat({below(f'section{k}', 'figures')}, {below(f'record{k}', 'figures')}) AS figure{k}" for k in range(depth)]
        d = d.selectExpr("*", *figures)
        # deeper lists are told by the next level, so only a node's own fields are merged here
        kinds = [f"{kind}{k}" for k in range(depth) for kind in LISTS]
        nodes = F.expr(f"to_variant_object(struct({', '.join(kinds)}))")
        row = d.agg(F.schema_of_variant_agg(nodes).alias("merged"), F.max(F.size(f"section{depth}")).alias("more"), F.max("size").alias("largest")).first()
        if not row["more"]:
            types = fields_of(row["merged"])
            found = [{kind: types.get(f"{kind}{k}", "VOID") for kind in LISTS} for k in range(depth)]
            while found and found[-1]["section"] in ("ARRAY<VOID>", "VOID"):
                found.pop()
            return Merged(found, row["largest"] or 0)
        depth *= 2


def _type(kind: str) -> str:
    """The column type of a merged type: whole numbers, also where some are typed as text, as int; the rest as text."""
    return "int" if kind.startswith("BIGINT") else "string"


def flatten(df: DataFrame, key: str = "payload_id", json: str = "doc_json", schema: Merged | None = None, wanted: dict[str, str] | None = None, large: int = LARGE) -> DataFrame:
    """Every node: (key, node_path, parent_path, node_kind, ordinal, wanted fields).  (key, parent_path) points to the parent.

    wanted: field -> type; the field "$" is a node's own value, as ``itself``.
    """
    df, wanted = df.select(key, json), wanted or {}
    schema = schema or infer(df, json)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ["node_path", "parent_path", "node_kind", "ordinal", *("itself" if w == "$" else w for w in wanted)]

    def nodes(lists: str, parent: str, path: str, kind: str, letter: str, open_: bool) -> str:
        """The elements of a list as nodes; their lists travel on only until they are exploded."""
        values = [f"try_variant_get(x, '{'$' if w == '$' else f'$.{w}'}', '{t}')" for w, t in wanted.items()]
        values = [f"{path} || '{letter}' || (i + 1)", parent, f"'{kind}'", "i + 1", *values]
        rest = "x" if open_ else "CAST(NULL AS variant)"
        return f"transform({lists}, (x, i) -> struct({', '.join(f'{v} AS `{n}`' for v, n in zip(values, own))}, {rest} AS rest))"

    def children(kind: str, level: int) -> list[str]:
        out = []
        for at, child, letter in LISTS[kind]:
            if schema.has(level, kind, at):
                below = level + (child == "section")
                open_ = any(schema.has(below, child, k) for k, *_ in LISTS[child])
                out.append(nodes(as_list("n.rest", at), "n.node_path", "n.node_path || '/'", child, letter, open_))
        return out

    def grown(d: DataFrame, spread: bool) -> DataFrame:
        d = parsed(d, json).selectExpr(key, f"explode({nodes(as_list('doc', ROOT[0]), "'root'", "''", ROOT[1], ROOT[2], True)}) AS n")
        closed = f"array(struct({', '.join(f'n.`{c}`' for c in own)}, CAST(NULL AS variant) AS rest))"
        # the records of a level are opened in the step after it, so their figures need one step more
        for level in range(schema.depth + 1):
            # a stated number, so that adaptive execution doesn't put them into one task again
            d = d.repartition(tasks, key, "n.node_path") if spread else d
            cases = [f"WHEN n.node_kind = '{kind}' THEN concat({closed}, {', '.join(lists)})" for kind in LISTS if (lists := children(kind, level if kind == "section" else level - 1))]
            if cases:
                d = d.selectExpr(key, f"explode(CASE WHEN n.rest IS NULL THEN {closed} {' '.join(cases)} ELSE {closed} END) AS n")
        return d.select(key, *[F.col(f"n.{c}") for c in own])

    if schema.largest <= large:
        return grown(df, False)
    size = F.length(json)
    return grown(df.where(size <= large), False).unionByName(grown(df.where(size > large), True))


def merged_schema(df: DataFrame, key: str = "payload_id", json: str = "doc_json") -> DataFrame:
    """(node_kind, field, type, level): the merged type of every field of every kind at every level."""
    schema = infer(df, json)
    rows = [(kind, level + 1, name, t) for level, own in enumerate(schema.levels) for kind in LISTS for name, t in fields_of(own[kind]).items()]
    return df.sparkSession.createDataFrame(rows, "node_kind string, level int, field string, type string")


def _table(df: DataFrame, kind: str, names: tuple[str, ...], key: str, json: str) -> DataFrame:
    schema = infer(df, json)
    typed = schema.fields(kind)
    # a number that some payloads give as text is still a number
    wanted = {n: "int" if n in ("page_start", "page") else "string" if n == "$" else _type(typed.get(n, "STRING")) for n in names}
    return flatten(df, key, json, schema, wanted).where(F.col("node_kind") == kind)


def section_table(df: DataFrame, key: str = "payload_id", json: str = "doc_json") -> DataFrame:
    """Sections with heading, first page (also where typed as text) and preamble."""
    return _table(df, "section", ("heading", "page_start", "preamble"), key, json).select(key, "node_path", "parent_path", "ordinal", "heading", "page_start", "preamble")


def record_table(df: DataFrame, key: str = "payload_id", json: str = "doc_json") -> DataFrame:
    """Records with heading, first page and text, tied to their section."""
    return _table(df, "record", ("heading", "page_start", "text"), key, json).select(key, "node_path", "parent_path", "ordinal", "heading", "page_start", "text")


def figure_table(df: DataFrame, key: str = "payload_id", json: str = "doc_json") -> DataFrame:
    """Figures, given as a name or as an object with image_id and page."""
    d = _table(df, "figure", ("image_id", "page", "$"), key, json)
    return d.select(key, "node_path", "parent_path", "ordinal", F.coalesce("image_id", "itself").alias("image_id"), "page")
