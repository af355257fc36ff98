"""The queries of the layout engine in SQL, as chains of named subqueries over the given tables."""

from __future__ import annotations

import re

from ..functions.rules import APPENDIX_PREFIX, BLANK, CAPTION_WORDS, CHEMISTRY_TERMS, TOP_LEVEL_NAMES
from ..operators.elements import PER_PAGE
from ..sources.fixtures import LINE_WORDS

DOC = "paper_id, source"
PAGE = f"{DOC}, page_number"
BLOCK = f"{PAGE}, block_ord"
LINE = f"{BLOCK}, line_ord"
BOX, BBOX = "x0, y0, x1, y1", "bx0, by0, bx1, by1"
CHEM = ", ".join(f"'{t}'" for t in CHEMISTRY_TERMS)


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def words(t: str) -> str:
    return f"list_filter(string_split_regex({t}, '{BLANK}+'), lambda w: w <> '')"


def n_words(t: str) -> str:
    return f"CAST(len({words(t)}) AS INTEGER)"


def caps(t: str) -> str:
    return f"(upper({t}) = {t} AND lower({t}) <> {t})"


def caption(t: str) -> str:
    return f"regexp_matches({t}, '(?i)^({CAPTION_WORDS})\\.?{BLANK}*\\p{{Nd}}+{BLANK}*[.|:]')"


def numbered(t: str) -> str:
    return f"regexp_matches({t}, '^\\p{{Nd}}{{1,3}}\\.{BLANK}+[^\\s]')"


def sentence(t: str) -> str:
    return f"(regexp_matches({t}, '[.?!]$') AND NOT {caps(t)} AND {n_words(t)} > 3)"


def key(t: str) -> str:
    return strip(f"regexp_replace({t}, '{BLANK}*\\p{{Nd}}{{1,4}}$', '')")


def top_level(t: str) -> str:
    bare = f"regexp_replace({t}, '(?i){APPENDIX_PREFIX}', '')"
    return f"regexp_matches(regexp_replace({strip(bare)}, '[.:]+$', ''), '(?i)^({TOP_LEVEL_NAMES})$')"


def label(t: str) -> str:
    p = f"(?i)^({CAPTION_WORDS})\\.?{BLANK}*(\\p{{Nd}}+)"
    return f"CASE WHEN regexp_matches({t}, '{p}') THEN regexp_extract({t}, '{p}', 1) || ' ' || regexp_extract({t}, '{p}', 2) END"


def fold(piece: str, order: str, group: str) -> str:
    """Pieces of a group in order: (joined text); the window function needs the number of pieces, so pieces come with ``_last``."""
    return f"string_agg(CASE WHEN _last THEN {piece} WHEN regexp_matches({piece}, '[a-z]-$') THEN left({piece}, length({piece}) - 1) ELSE {piece} || ' ' END, '' ORDER BY {order})"


def overlap(box: str) -> str:
    """Whether one image of the page covers two fifths of a box; i is the image."""
    x0, y0, x1, y1 = box.split(", ")
    w, h = f"(least({x1}, i.x1) - greatest({x0}, i.x0))", f"(least({y1}, i.y1) - greatest({y0}, i.y0))"
    area = f"(({x1} - {x0}) * ({y1} - {y0}))"
    return f"(CASE WHEN {w} <= 0 OR {h} <= 0 OR {area} <= 0 THEN 0 ELSE {w} * {h} / {area} END) >= CAST(0.4 AS DOUBLE)"


D = lambda x: f"CAST({x} AS DOUBLE)"

CHAIN: dict[str, str] = {
    "pages": f"SELECT {PAGE}, width, height FROM layout_pages",
    "clean": f"SELECT *, {strip("replace(text, 'ß', 'ss')")} AS t FROM text_blocks WHERE text IS NOT NULL AND bbox IS NOT NULL",
    "placed": f"SELECT {PAGE}, CAST(row_number() OVER (PARTITION BY {PAGE} ORDER BY block_uid) - 1 AS INTEGER) AS block_ord, bbox[1] AS bx0, bbox[2] AS by0, bbox[3] AS bx1, bbox[4] AS by1, t AS text FROM clean WHERE t <> ''",
    "kinds": f"SELECT *, {caption('text')} AS cap, by0 < 40 AS head, NOT {caption('text')} AND NOT by0 < 40 AND {n_words('text')} <= 8 AND NOT regexp_matches(text, '[.?!;]$') AS heading FROM placed",
    "blocks": f"SELECT {BLOCK}, {BBOX}, text, CASE WHEN head THEN {D(8)} WHEN cap THEN {D(9)} WHEN heading AND {caps('text')} THEN {D(13)} WHEN heading AND {numbered('text')} THEN {D(12)} WHEN heading AND contains(text, ':') THEN {D(10.5)} WHEN heading THEN {D(10.24)} ELSE {D(10)} END AS size, heading AS bold, heading AND block_ord % 3 = 1 AS marked FROM kinds",
    "parts": f"SELECT *, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS pi FROM blocks",
    "chunks": f"SELECT *, unnest(range(0, (len(ws) - 1) // {LINE_WORDS} + 1)) AS k FROM (SELECT *, {words('part')} AS ws FROM parts) WHERE len(ws) > 0",
    "numbered_lines": f"SELECT *, array_to_string(ws[{LINE_WORDS} * k + 1 : {LINE_WORDS} * k + {LINE_WORDS}], ' ') AS line, CAST(row_number() OVER (PARTITION BY {BLOCK} ORDER BY pi, k) - 1 AS INTEGER) AS line_ord, count(*) OVER (PARTITION BY {BLOCK}) AS n FROM chunks",
    "split_lines": f"SELECT *, bx0 AS x0, by0 + line_ord * ((by1 - by0) / n) AS y0, bx1 AS x1, by0 + (line_ord + 1) * ((by1 - by0) / n) AS y1, regexp_extract(line, '^([^ ]+)', 1) AS w1, substring(line, length(regexp_extract(line, '^([^ ]+)', 1)) + 1) AS rest, marked AND line_ord = 0 AS has_mark FROM numbered_lines",
    "weights": "SELECT *, ltrim(rest, ' ') AS r, length(w1) AS nf, length(ltrim(rest, ' ')) AS nr, bold OR length(w1) % 5 = 0 AS first_bold FROM split_lines",
    "doms": "SELECT *, CASE WHEN has_mark AND nf <= 1 AND nr <= 1 THEN 0 WHEN nf >= nr THEN 1 ELSE 2 END AS dom FROM weights",
    "styled": "SELECT *, CASE dom WHEN 0 THEN false WHEN 1 THEN first_bold ELSE bold END AS dom_bold FROM doms",
    "lines": f"SELECT {LINE}, {strip("CASE WHEN has_mark THEN '■' ELSE '' END || line")} AS text, CASE WHEN dt = '' THEN {strip("CASE WHEN has_mark THEN '■' ELSE '' END || line")} ELSE dt END AS dominant_text, size, dom_bold AS bold, has_mark AND dom > 0 AND dom_bold AND first_bold AS has_marker, {BOX}, {BBOX} FROM (SELECT *, {strip(f"CASE WHEN has_mark AND NOT dom_bold THEN '■' ELSE '' END || CASE WHEN first_bold = dom_bold OR w1 IN ({CHEM}) THEN w1 ELSE '' END || CASE WHEN rest <> '' AND (bold = dom_bold OR r IN ({CHEM})) THEN rest ELSE '' END")} AS dt FROM styled)",
    "images": f"SELECT {PAGE}, CAST(ord AS INTEGER) AS image_ord, source || '_p' || page_number || '_raster' || ord AS image_id, 'embedded_raster' AS kind, CAST(b[1] AS DOUBLE) AS x0, CAST(b[2] AS DOUBLE) AS y0, CAST(b[3] AS DOUBLE) AS x1, CAST(b[4] AS DOUBLE) AS y1 FROM pages, (VALUES (0, [50, 130, 280, 200]), (1, [320, 130, 550, 205])) v(ord, b) WHERE page_number % 3 = 0",
    "buckets": f"SELECT {DOC}, round_even(size * 2, 0) / 2 AS bucket, sum(length(text)) AS chars, min((page_number, block_ord, line_ord)) AS seen FROM lines GROUP BY ALL",
    "body": f"SELECT DISTINCT {DOC}, coalesce(b.bucket, {D(10)}) AS body_size FROM (SELECT DISTINCT {DOC} FROM pages) LEFT JOIN (SELECT {DOC}, bucket FROM buckets QUALIFY row_number() OVER (PARTITION BY {DOC} ORDER BY chars DESC, seen) = 1) b USING ({DOC})",
    "keyed": f"SELECT {PAGE}, 'text' AS kind, text AS value FROM lines UNION SELECT {PAGE}, 'key', {key('text')} FROM lines WHERE {key('text')} <> ''",
    "repeats": f"SELECT {DOC}, kind, value, count(*) AS n_pages FROM keyed JOIN (SELECT {DOC}, count(*) AS total FROM pages GROUP BY ALL) USING ({DOC}) GROUP BY {DOC}, kind, value, total HAVING count(*) >= greatest(2, floor(total * {D(0.3)}))",
    "marked_lines": f"SELECT l.*, width, coalesce(l.y1 < p.height * {D(0.05)} OR l.y0 > p.height * (1 - {D(0.05)}), false) OR EXISTS (FROM repeats r WHERE r.paper_id = l.paper_id AND r.source = l.source AND r.kind = 'text' AND r.value = l.text) OR EXISTS (FROM repeats r WHERE r.paper_id = l.paper_id AND r.source = l.source AND r.kind = 'key' AND r.value = {key('l.text')}) AS furniture FROM lines l LEFT JOIN pages p USING ({PAGE})",
    "firsts": f"SELECT m.*, body_size, row_number() OVER (PARTITION BY {BLOCK} ORDER BY line_ord) = 1 AS first FROM marked_lines m JOIN body USING ({DOC}) WHERE NOT furniture",
    "parens": f"SELECT {LINE}, min(depth) FILTER (i < n) >= 1 AND max(depth) FILTER (i = n) = 0 AS whole FROM (SELECT *, sum(CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY {LINE} ORDER BY i) AS depth FROM (SELECT {LINE}, length(text) AS n, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM lines WHERE starts_with(text, '(') AND ends_with(text, ')'))) GROUP BY ALL",
    "eligible": f"SELECT f.*, round_even(size * 2, 0) / 2 AS size_bucket, {numbered('dominant_text')} AS numbered, {caps('dominant_text')} AS all_caps, bold AND length(text) < 120 AND {n_words('text')} <= 20 AND NOT {sentence('text')} AND NOT coalesce(whole, false) AND (size >= body_size * {D(1.02)} OR first AND size >= body_size * {D(0.98)}) AS eligible FROM firsts f LEFT JOIN parens USING ({LINE})",
    "contents": f"SELECT DISTINCT {PAGE} FROM lines WHERE bold AND regexp_matches({strip('text')}, '(?i)^(table of )?contents$')",
    "levels": f"SELECT {DOC}, size_bucket, numbered, all_caps, has_marker, n_blocks, CAST(row_number() OVER (PARTITION BY {DOC} ORDER BY size_bucket DESC, numbered DESC, all_caps DESC, has_marker DESC) AS INTEGER) AS level FROM (SELECT {DOC}, size_bucket, numbered, all_caps, has_marker, body_size, count(DISTINCT (page_number, {BBOX})) AS n_blocks, bool_or(page_number <> 1) AS beyond FROM eligible e WHERE eligible AND NOT EXISTS (FROM contents c WHERE c.paper_id = e.paper_id AND c.source = e.source AND c.page_number = e.page_number) GROUP BY ALL) WHERE beyond AND n_blocks >= CASE WHEN size_bucket >= body_size * {D(1.02)} THEN 2 ELSE 4 END QUALIFY level <= 6",
    "classified": f"SELECT e.*, CASE WHEN eligible THEN coalesce(v.level, CASE WHEN {top_level('dominant_text')} THEN 1 END) END AS level FROM eligible e LEFT JOIN (SELECT * EXCLUDE (n_blocks) FROM levels) v USING ({DOC}, size_bucket, numbered, all_caps, has_marker)",
    "in_figure": f"SELECT DISTINCT {LINE} FROM lines l JOIN (SELECT {PAGE}, x0 AS ix0, y0 AS iy0, x1 AS ix1, y1 AS iy1 FROM images) i USING ({PAGE}) WHERE {overlap('l.x0, l.y0, l.x1, l.y1').replace('i.x', 'i.ix').replace('i.y', 'i.iy')}",
    "all_blocks": f"SELECT DISTINCT {BLOCK}, {BBOX}, width, EXISTS (FROM images i WHERE i.paper_id = l.paper_id AND i.source = l.source AND i.page_number = l.page_number AND {overlap('l.bx0, l.by0, l.bx1, l.by1')}) AS in_figure FROM lines l JOIN pages USING ({PAGE})",
    "gaps": f"SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY {PAGE}) AS n, lag(bx0) OVER w AS before FROM all_blocks WHERE NOT in_figure WINDOW w AS (PARTITION BY {PAGE} ORDER BY bx0, block_ord)",
    "splits": f"SELECT {PAGE}, mid AS split_x FROM (SELECT *, (bx0 + before) / 2 AS mid, bx0 - before AS gap FROM gaps WHERE bx0 > before AND CAST(rn - 1 AS DOUBLE) / n BETWEEN {D(0.2)} AND {D(0.8)} QUALIFY row_number() OVER (PARTITION BY {PAGE} ORDER BY bx0 - before DESC, rn) = 1) WHERE n >= 4 AND gap >= width * {D(0.08)}",
    "survivors": f"SELECT *, coalesce(level, 0) AS kind, CASE WHEN level IS NOT NULL THEN dominant_text ELSE text END AS piece FROM classified c WHERE (level IS NOT NULL AND length(dominant_text) > 2) OR {n_words('text')} > 8 OR NOT EXISTS (FROM in_figure i WHERE i.paper_id = c.paper_id AND i.source = c.source AND i.page_number = c.page_number AND i.block_ord = c.block_ord AND i.line_ord = c.line_ord)",
    "islands": f"SELECT *, sum(CASE WHEN kind = before THEN 0 ELSE 1 END) OVER (PARTITION BY {BLOCK} ORDER BY line_ord) AS unit_ord FROM (SELECT *, lag(kind) OVER (PARTITION BY {BLOCK} ORDER BY line_ord) AS before FROM survivors)",
    "units": f"SELECT {BLOCK}, CAST(unit_ord AS BIGINT) AS unit_ord, CAST(kind AS INTEGER) AS kind, {BBOX}, {fold('piece', 'line_ord', BLOCK)} AS text FROM (SELECT *, line_ord = max(line_ord) OVER (PARTITION BY {BLOCK}, unit_ord) AS _last FROM islands) GROUP BY {BLOCK}, unit_ord, kind, {BBOX}",
    "whole": f"SELECT *, string_agg(text, ' ' ORDER BY unit_ord) OVER (PARTITION BY {BLOCK} ORDER BY unit_ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole FROM units",
    "typed": f"SELECT {BLOCK}, unit_ord, {BBOX}, CASE WHEN {caption('whole')} THEN 'figure_caption' WHEN kind > 0 THEN 'heading' || kind ELSE 'body' END AS type, CASE WHEN NOT {caption('whole')} AND kind > 0 THEN kind END AS level, CASE WHEN {caption('whole')} THEN whole ELSE text END AS text FROM whole WHERE NOT {caption('whole')} OR unit_ord = 1",
    "elements": f"SELECT *, CAST(page_number AS BIGINT) * {PER_PAGE} + row_number() OVER (PARTITION BY {PAGE} ORDER BY col, by0, block_ord, unit_ord) AS elem_ord FROM (SELECT t.*, CASE WHEN split_x IS NULL OR bx0 < split_x THEN 0 ELSE 1 END AS col FROM typed t LEFT JOIN splits USING ({PAGE}))",
    "linked": f"SELECT *, coalesce(type = 'body' AND ptype = 'body' AND NOT regexp_matches(ptext, '[.?!:;]$'), false) AS link FROM (SELECT *, lag(type) OVER w AS ptype, lag(text) OVER w AS ptext FROM elements WINDOW w AS (PARTITION BY {DOC} ORDER BY elem_ord))",
    "chains": f"SELECT *, sum(CAST(NOT link AS INTEGER)) OVER (PARTITION BY {DOC} ORDER BY elem_ord) AS chain FROM linked",
    "starts": f"SELECT *, NOT link OR first_value((page_number, col)) OVER (PARTITION BY {DOC}, chain ORDER BY elem_ord) = (page_number, col) AS start FROM chains",
    "paras": f"SELECT *, sum(CAST(start AS INTEGER)) OVER (PARTITION BY {DOC} ORDER BY elem_ord) AS para FROM starts",
    "stitched": f"SELECT {DOC}, min(elem_ord) AS elem_ord, arg_min(page_number, elem_ord) AS page_number, arg_min(type, elem_ord) AS type, arg_min(level, elem_ord) FILTER (start) AS level, arg_min(bx0, elem_ord) AS bx0, arg_min(by0, elem_ord) AS by0, arg_min(bx1, elem_ord) AS bx1, arg_min(by1, elem_ord) AS by1, CAST(count(*) AS INTEGER) AS n_fragments, {fold('text', 'elem_ord', DOC)} AS text FROM (SELECT *, elem_ord = max(elem_ord) OVER (PARTITION BY {DOC}, para) AS _last FROM paras) GROUP BY {DOC}, para",
    "heads": f"SELECT {DOC}, elem_ord AS node_id, CASE WHEN {top_level('text')} THEN 1 ELSE level END AS level, text AS heading, page_number AS page_start FROM stitched WHERE level IS NOT NULL",
    "parented": f"SELECT h.*, (SELECT max(p.node_id) FROM heads p WHERE p.paper_id = h.paper_id AND p.source = h.source AND p.node_id < h.node_id AND p.level < h.level) AS parent_id FROM heads h",
    "walked": f"SELECT {DOC}, node_id, parent_id, level, heading, page_start, 1 AS depth, lpad(CAST(node_id AS VARCHAR), 20, '0') AS own, '' AS above, [node_id] AS line FROM parented WHERE parent_id IS NULL UNION ALL SELECT c.paper_id, c.source, c.node_id, c.parent_id, c.level, c.heading, c.page_start, w.depth + 1, lpad(CAST(c.node_id AS VARCHAR), 20, '0'), w.above || '0' || w.own, list_append(w.line, c.node_id) FROM walked w JOIN parented c ON c.paper_id = w.paper_id AND c.source = w.source AND c.parent_id = w.node_id",
    "opened": f"SELECT *, last_value(CASE WHEN level IS NOT NULL THEN elem_ord END IGNORE NULLS) OVER (PARTITION BY {DOC} ORDER BY elem_ord) AS node_id FROM stitched WHERE type <> 'figure_caption'",
    "paragraphs": f"SELECT {DOC}, node_id, elem_ord AS para_ord, text FROM opened WHERE type = 'body'",
    "node_texts": f"SELECT {DOC}, node_id, string_agg(text, chr(10) ORDER BY para_ord) AS text FROM paragraphs WHERE node_id IS NOT NULL GROUP BY ALL",
    "nodes": f"SELECT w.*, parent_id IS NOT NULL AND NOT EXISTS (FROM parented c WHERE c.paper_id = w.paper_id AND c.source = w.source AND c.parent_id = w.node_id) AS is_record, coalesce(text, '') AS text FROM walked w LEFT JOIN node_texts USING ({DOC}, node_id)",
    "timeline": f"SELECT {DOC}, node_id, page_start, row_number() OVER (PARTITION BY {DOC} ORDER BY page_start, above || CAST(CAST(is_record AS INTEGER) AS VARCHAR) || own) AS rank FROM nodes",
    "attached": f"SELECT i.paper_id, i.source, i.page_number, image_ord, image_id, (SELECT arg_max(t.node_id, t.rank) FROM timeline t WHERE t.paper_id = i.paper_id AND t.source = i.source AND t.page_start <= i.page_number) AS node_id FROM images i",
    "caps": f"SELECT {PAGE}, elem_ord, text, {BBOX} FROM (SELECT {PAGE}, elem_ord, text, type, {BBOX} FROM stitched) WHERE type = 'figure_caption'",
    "near": f"SELECT {DOC}, elem_ord, image_id FROM caps JOIN images USING ({PAGE}) QUALIFY row_number() OVER (PARTITION BY {DOC}, elem_ord ORDER BY least(bx1, x1) - greatest(bx0, x0) <= 0, greatest(0, by0 - y1, y0 - by1), image_ord) = 1",
    "draws": "SELECT 'd' || (l_orderkey % 1000) AS paper_id, 'main' AS source, CAST(l_orderkey AS INTEGER) AS page_number, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS draw_ord, l_linenumber % 4 AS cell, (l_linenumber % 4 % 2) * 300 + 100 - l_quantity AS x0, (l_linenumber % 4 // 2) * 400 + 100 - l_quantity AS y0, CAST((l_linenumber % 4 % 2) * 300 + 101 + l_partkey % 50 AS DOUBLE) AS x1, CAST((l_linenumber % 4 // 2) * 400 + 101 + l_suppkey % 50 AS DOUBLE) AS y1, l_returnflag FROM lineitem",
    "cells": f"SELECT {PAGE}, cell, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, min(draw_ord) AS first_ord FROM draws WHERE l_returnflag <> 'R' GROUP BY ALL HAVING (max(x1) - min(x0)) * (max(y1) - min(y0)) >= 2000",
    "popped": f"SELECT {DOC}, min(node_id) AS node_id FROM walked WHERE depth = 1 AND lower(heading) = 'outlook' AND source = 'main' AND paper_id IN (SELECT paper_id FROM bib_refs WHERE NOT ends_with(paper_id, '9')) GROUP BY ALL",
}


def chained(final: str) -> str:
    """The final statement after the subqueries it needs."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CHAIN:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+\(*{name}\b", sql):
                needed.add(name)
                visit(CHAIN[name])

    visit(final)
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({CHAIN[n]})" for n in CHAIN if n in needed) + " " + final if needed else final


FINAL: dict[str, str] = {
    "layout_pages": f"SELECT {PAGE}, width, height FROM layout_pages",
    "layout_blocks": f"SELECT {BLOCK}, {BBOX}, text, size, bold, marked FROM blocks",
    "layout_lines": f"SELECT {LINE}, text, dominant_text, size, bold, has_marker, {BOX}, {BBOX} FROM lines",
    "text_blocks_scan": f"SELECT block_uid, {strip('text')} AS text FROM text_blocks WHERE text IS NOT NULL AND {strip('text')} <> ''",
    "raw_page_summary": "SELECT source, n_pages, coalesce(n_blocks, 0) AS n_blocks, coalesce(n_images, 0) AS n_images FROM (SELECT source, count(*) AS n_pages FROM pages GROUP BY ALL) LEFT JOIN (SELECT source, count(*) AS n_blocks FROM blocks GROUP BY ALL) USING (source) LEFT JOIN (SELECT source, count(*) AS n_images FROM images GROUP BY ALL) USING (source)",
    "page_images": f"SELECT {PAGE}, image_ord, image_id, kind, {BOX} FROM images",
    "line_flags": f"SELECT {LINE}, {numbered('dominant_text')} AS numbered, {caps('dominant_text')} AS all_caps, {sentence('dominant_text')} AS sentence_like, regexp_matches({strip('dominant_text')}, '(?i)^(table of )?contents$') AS contents_label, {caption('dominant_text')} AS caption, regexp_matches(dominant_text, '[.?!:;]$') AS terminated, {n_words('dominant_text')} AS n_words FROM lines",
    "caption_labels": f"SELECT {LINE}, {label('text')} AS label FROM lines WHERE {caption('text')}",
    "parenthetical_texts": "SELECT record_id, starts_with(part, '(') AND ends_with(part, ')') AND coalesce(min(depth) FILTER (i < length(part)) >= 1, false) AND max(depth) FILTER (i = length(part)) = 0 AS parenthetical FROM (SELECT record_id, part, i, sum(CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY record_id ORDER BY i) AS depth FROM (SELECT record_id, part, unnest(string_split(part, '')) AS c, generate_subscripts(string_split(part, ''), 1) AS i FROM (SELECT record_id, regexp_extract(heading, '(\\([^:]*)', 1) AS part FROM si_records WHERE heading IS NOT NULL) WHERE part <> '')) GROUP BY record_id, part",
    "furniture_keys": f"SELECT {LINE}, {key('text')} AS furniture_key FROM lines",
    "top_level_names": f"SELECT {LINE}, {top_level('dominant_text')} AS top_level, lower(trim(text, '■ ')) = 'references' AS \"references\" FROM lines WHERE bold",
    "size_buckets": f"SELECT round_even(size * 2, 0) / 2 AS size_bucket, {numbered('dominant_text')} AS numbered, {caps('dominant_text')} AS all_caps, has_marker, count(*) AS n_lines FROM lines GROUP BY ALL",
    "dominant_spans": f"SELECT {LINE}, dom AS span_ord, CASE dom WHEN 0 THEN '■' WHEN 1 THEN w1 ELSE rest END AS text, size, dom_bold AS bold FROM styled",
    "line_markers": f"SELECT {LINE}, text, dominant_text FROM lines WHERE has_marker",
    "body_size": f"SELECT {DOC}, body_size FROM body",
    "furniture_texts": f"SELECT {DOC}, kind, value, n_pages FROM repeats",
    "furniture_lines": f"SELECT {LINE}, furniture FROM marked_lines",
    "contents_pages": f"SELECT DISTINCT {PAGE} FROM lines WHERE bold AND lower(text) IN ('acknowledgements', 'contents', 'table of contents')",
    "heading_candidates": f"SELECT {LINE}, first, size_bucket, numbered, all_caps, has_marker FROM eligible WHERE eligible",
    "heading_levels": f"SELECT {DOC}, size_bucket, numbered, all_caps, has_marker, n_blocks, level FROM levels",
    "classified_lines": f"SELECT {LINE}, CAST(level AS INTEGER) AS level FROM classified",
    "visible_drawings": f"SELECT {PAGE}, draw_ord, {BOX} FROM draws WHERE l_returnflag <> 'R' AND x1 > x0 AND y1 > y0",
    "figure_regions": f"SELECT {PAGE}, CAST(fig_ord AS INTEGER) AS fig_ord, source || '_p' || page_number || '_fig' || fig_ord AS image_id, {BOX} FROM (SELECT *, row_number() OVER (PARTITION BY {PAGE} ORDER BY round_even(y0, 0), x0, first_ord) - 1 AS fig_ord FROM (SELECT {PAGE}, greatest(x0, 0) AS x0, greatest(y0, 0) AS y0, least(x1, 600) AS x1, least(y1, 800) AS y1, first_ord FROM cells) WHERE x1 > x0 AND y1 > y0)",
    "lines_in_figures": f"SELECT {LINE} FROM in_figure",
    "column_splits": f"SELECT {PAGE}, split_x FROM splits",
    "block_columns": f"SELECT {BLOCK}, in_figure, CASE WHEN split_x IS NULL OR bx0 < split_x THEN 0 ELSE 1 END AS col FROM all_blocks LEFT JOIN splits USING ({PAGE})",
    "page_units": f"SELECT {BLOCK}, unit_ord, kind, text FROM units",
    "reading_order": f"SELECT {DOC}, elem_ord, page_number, col, type, text FROM elements",
    "stitched_elements": f"SELECT {DOC}, elem_ord, page_number, type, n_fragments, text FROM stitched",
    "section_tree": f"SELECT {DOC}, node_id, parent_id, CAST(level AS INTEGER) AS level, depth, heading, page_start FROM walked",
    "section_paragraphs": f"SELECT {DOC}, node_id, para_ord, text FROM paragraphs WHERE node_id IS NOT NULL",
    "front_matter": f"SELECT {DOC}, para_ord, text FROM paragraphs WHERE node_id IS NULL",
    "section_summary": f"SELECT w.paper_id, w.source, w.node_id, CAST(w.level AS INTEGER) AS level, w.heading, w.page_start, (SELECT count(*) FROM paragraphs p WHERE p.paper_id = w.paper_id AND p.source = w.source AND p.node_id = w.node_id) AS n_paragraphs, (SELECT count(*) FROM parented p WHERE p.paper_id = w.paper_id AND p.source = w.source AND p.parent_id = w.node_id) AS n_subsections FROM walked w",
    "caption_figures": f"SELECT {DOC}, elem_ord, {label('text')} AS label, text AS caption, page_number, image_id FROM caps LEFT JOIN near USING ({DOC}, elem_ord)",
    "references_parsed": f"SELECT paper_id, CAST(ref_uid % 64 AS INTEGER) AS shard, CAST(row_number() OVER (PARTITION BY paper_id, ref_uid % 64 ORDER BY ref_uid) - 1 AS INTEGER) AS ref_ord, id, coalesce(nullif({strip('title')}, ''), nullif({strip('journal')}, '')) AS title, coalesce(array_to_string(list_filter(list_transform(authors, lambda a: array_to_string(list_filter(string_split(a, ' '), lambda w: w <> ''), ' ')), lambda a: a <> ''), '; '), '') AS authors, nullif({strip('journal')}, '') AS journal, nullif({strip('volume')}, '') AS volume, nullif({strip('issue')}, '') AS issue, pages, year, nullif({strip('doi')}, '') AS doi, nullif({strip('publisher')}, '') AS publisher FROM bib_refs WHERE NOT ends_with(paper_id, '9')",
    "references_fallback": f"SELECT w.paper_id, w.source, w.node_id, CASE WHEN lower(w.heading) = 'outlook' THEN '■ References' ELSE w.heading END AS heading FROM walked w LEFT JOIN (SELECT {DOC}, node_id AS gone FROM popped) USING ({DOC}) WHERE gone IS NULL OR NOT list_contains(w.line, gone)",
    "references_head": "SELECT paper_id, count(*) AS n_references, string_agg(id, ',' ORDER BY n) FILTER (n <= 3) AS first_ids FROM (SELECT paper_id, id, row_number() OVER (PARTITION BY paper_id ORDER BY ref_uid) AS n FROM bib_refs) GROUP BY paper_id",
    "si_nodes": f"SELECT {DOC}, node_id, is_record, heading, page_start, CAST(length(text) AS INTEGER) AS n_chars FROM nodes",
    "si_records_flat": f"SELECT {DOC}, node_id, heading, page_start, text FROM nodes WHERE is_record",
    "si_timeline": f"SELECT {DOC}, node_id, rank FROM timeline",
    "si_figure_attach": f"SELECT {DOC}, node_id, string_agg(image_id, ',' ORDER BY page_number, image_ord) AS figures FROM attached WHERE node_id IS NOT NULL GROUP BY ALL",
    "si_record_counts": f"SELECT {DOC}, count(*) FILTER (is_record) AS n_records, count(*) FILTER (NOT is_record) AS n_sections, CAST(coalesce(sum(length(text)) FILTER (is_record), 0) AS BIGINT) AS n_chars FROM nodes GROUP BY ALL",
}


def oracle_sql() -> dict[str, str]:
    return {name: chained(sql) for name, sql in FINAL.items()}
