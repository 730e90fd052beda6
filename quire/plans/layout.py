"""Queries of reading order, links and boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as T
from quire.operators import contract, evidence, links, nested, order
from quire.sources.tables import table


def _blocks(spark, sf_dir):
    """Blocks of each run's pages, rows delivered twice once."""
    return nested.blocks(table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"]))


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "run_pages").select("run_id", "page_number", "width", "height").dropDuplicates(["run_id", "page_number"])


def reading_order_blocks(spark, sf_dir):
    return order.block_order(_blocks(spark, sf_dir)).select("run_id", "page_number", "block_no", "block_id", "reading_order")


def reading_order_tree(spark, sf_dir):
    """Regions, nations and customers as a tree; two regions also name the first nation, which is skipped there."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    edges = (
        nation.selectExpr("concat('r', n_regionkey) AS parent", "CAST(n_nationkey AS BIGINT) AS ord", "concat('n', n_nationkey) AS child")
        .unionByName(nation.where("n_nationkey < 2").selectExpr("concat('r', n_regionkey) AS parent", "CAST(100 AS BIGINT) AS ord", "concat('n', 0) AS child"))
        .unionByName(customer.selectExpr("concat('n', c_nationkey) AS parent", "c_custkey AS ord", "concat('c', c_custkey) AS child"))
    )
    roots = table(spark, sf_dir, "region").selectExpr("concat('r', r_regionkey) AS root", "concat('r', r_regionkey) AS node")
    return order.tree_order(edges, roots)


def item_ordinals(spark, sf_dir):
    items = _blocks(spark, sf_dir).withColumn("exported", F.col("block_label").isin("image", "table"))
    return order.item_ordinals(items).select("run_id", "page_number", "block_no", "item_id", "export_name")


def artifact_binding(spark, sf_dir):
    pages = table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"])
    bindings = pages.select("run_id", "page_number", F.explode(F.concat(F.coalesce("images", F.array()), F.coalesce("tables", F.array()))).alias("a")).select(
        "run_id", "page_number", F.col("a.block_id").alias("block_id"), F.col("a.artifact_path").alias("artifact_path")
    )
    blocks = _blocks(spark, sf_dir).select("run_id", "page_number", "block_no", "block_id", contract.block_kind(F.col("block_label")).alias("kind"))
    return links.bind_artifacts(blocks, bindings)


def caption_join(spark, sf_dir):
    """Texts of the captions that follow a table or picture of a contract."""
    e = nested.elements(table(spark, sf_dir, "parsed_documents").dropDuplicates(["document_id"]))
    near = e.where("kind IN ('table', 'picture')").select("document_id", "element_id", F.explode(F.array(F.lit(-1), F.lit(1))).alias("step"), "element_no")
    references = near.select("document_id", "element_id", F.col("step").alias("ord"), (F.col("element_no") + F.col("step")).alias("ref"))
    captions = e.where("kind = 'caption'").select("document_id", F.col("element_no").alias("ref"), "text")
    return links.caption_texts(references, captions)


def missing_references(spark, sf_dir):
    """Artifact ids that elements name and their documents lack, and sources of pages that the source table lacks."""
    documents = table(spark, sf_dir, "parsed_documents")
    named = nested.artifact_links(documents).selectExpr("'artifact' AS kind", "document_id", "artifact_id AS ref").distinct()
    known = nested.artifacts(documents).selectExpr("'artifact' AS kind", "document_id", "artifact_id AS ref").distinct()
    return links.missing_references(named, known, "kind", "document_id", "ref")


def iou_match(spark, sf_dir):
    pages = nested.read_pages(table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"]).select("run_id", "document_id", "page_number", "page_json"))
    raw = table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"]).select(
        "run_id", "page_number", F.from_json("page_json", "layout_boxes ARRAY<STRUCT<coordinate: ARRAY<DOUBLE>, label: STRING>>").alias("p"))
    boxes = raw.join(pages.select("run_id", "page_number"), ["run_id", "page_number"], "left_semi").select("run_id", "page_number", F.posexplode("p.layout_boxes").alias("i", "b")).select(
        "run_id", "page_number", F.col("b.label").alias("label"), (F.col("i") + 1).alias("box_no"), *[F.col("b.coordinate")[i].alias(s) for i, s in enumerate(("x0", "y0", "x1", "y1"))])
    blocks = _blocks(spark, sf_dir).select("run_id", "page_number", F.col("block_label").alias("label"), "block_no", *[F.col("block_bbox")[i].alias(s) for i, s in enumerate(("x0", "y0", "x1", "y1"))])
    return links.match_boxes(boxes, blocks)


def _box(made, keys):
    return made.select(*keys, "x0", "y0", "x1", "y1", *[c for c in ("clamped", "expanded", "valid", "problem") if c in made.columns])


def bbox_normalize(spark, sf_dir):
    """Line items as boxes around the edges of a page of 100 by 50."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2 - 1.25).alias("l"), (F.col("l_discount") * 500 - 0.75).alias("t"), (F.col("l_tax") * 1260 - 0.25).alias("r"), F.col("l_quantity").alias("b"))
    box = G.page_box(F.col("l"), F.col("t"), F.col("r"), F.col("b"), F.lit(100.0), F.lit(50.0))
    return _box(li.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in box.items()]), ["l_orderkey", "l_linenumber"])


def bbox_expand(spark, sf_dir):
    """Flat and full intervals of line items."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).alias("low"), (F.col("l_quantity") - 1 + F.when(F.col("l_tax") > 0.04, 0).otherwise(3)).alias("high"))
    e = G.expand(F.col("low"), F.col("high"), F.lit(49.0))
    return li.select("l_orderkey", "l_linenumber", e.low.alias("x0"), e.high.alias("x1"), e.changed.alias("expanded"), e.valid.alias("valid"))


def block_boxes(spark, sf_dir):
    b = _blocks(spark, sf_dir).join(_pages(spark, sf_dir), ["run_id", "page_number"])
    x = [F.get("block_bbox", F.lit(i)) for i in range(4)]
    box = G.block_box(*x, F.col("width"), F.col("height"))
    return b.select("run_id", "page_number", "block_no", *[v.alias(k) for k, v in box.items()])


def bbox_scale_1000(spark, sf_dir):
    b = _blocks(spark, sf_dir).join(_pages(spark, sf_dir), ["run_id", "page_number"])
    x = [F.get("block_bbox", F.lit(i)) for i in range(4)]
    box = G.from_thousandths(*x, F.col("width"), F.col("height"))
    return b.select("run_id", "page_number", "block_no", *[v.alias(k) for k, v in box.items()])


def polygon_box(spark, sf_dir):
    """The four corners of each block's box, turned, as a polygon, boxed again."""
    b = _blocks(spark, sf_dir).where("size(block_bbox) = 4")
    points = F.expr("array(array(block_bbox[2], block_bbox[1]), array(block_bbox[0], block_bbox[1]), array(block_bbox[0], block_bbox[3]), array(block_bbox[2], block_bbox[3]))")
    return b.select("run_id", "page_number", "block_no", *[v.alias(k) for k, v in G.polygon_box(points).items()])


def union_box(spark, sf_dir):
    """The box around all provenance boxes of an element's pages."""
    return nested.provenance(table(spark, sf_dir, "parsed_documents")).groupBy("document_id", "page_number").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def _chunks(spark, sf_dir):
    """Lines of native pages as text chunks placed by their number, with some captions made of bare numbers."""
    p = table(spark, sf_dir, "native_text_pages").where("text IS NOT NULL").select("document_id", "page_number", "text").distinct()
    lines = p.select("document_id", "page_number", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    return lines.select(
        "document_id", "page_number", "i", F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"), (F.col("i") % 7 * 100).cast("double").alias("x"),
        (790 - F.col("i") * 12).cast("double").alias("y"), F.lit(10.0).alias("font_size"), "text",
    )


def label_extract(spark, sf_dir):
    found = evidence.labels(_chunks(spark, sf_dir))
    return order.label_order(found).select("document_id", "page_number", "object_type", "label_number", "matched_text", "label_form", "label_no")


def label_bbox(spark, sf_dir):
    found = evidence.labels(_chunks(spark, sf_dir))
    return found.select("document_id", "page_number", "i", "x0", "y0", "x1", "y1", "x_normalized", "y_normalized")


def page_text_concat(spark, sf_dir):
    return contract.page_texts(_blocks(spark, sf_dir))


def kind_map(spark, sf_dir):
    return _blocks(spark, sf_dir).select("run_id", "page_number", "block_no", contract.block_kind(F.col("block_label")).alias("kind"), contract.element_kind(F.col("block_label")).alias("primary_kind"))


def element_ids(spark, sf_dir):
    return _blocks(spark, sf_dir).select("run_id", "page_number", "block_no", T.block_element_id(F.col("page_number"), F.col("block_id"), F.col("block_order")).alias("element_id"))


def _bindings(spark, sf_dir):
    pages = table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"])
    one = lambda c: pages.select("run_id", "page_number", F.lit(c).alias("collection"), F.posexplode(c).alias("place", "a"))
    return one("images").unionByName(one("tables")).select("run_id", "page_number", "collection", "place", F.col("a.block_id").alias("block_id"), F.col("a.artifact_path").alias("artifact_path"))


def binding_problems(spark, sf_dir):
    """Bindings with some paths in capitals, some without a known suffix, and one page's bindings given twice."""
    b = _bindings(spark, sf_dir)
    b = b.withColumn("artifact_path", F.when(F.col("page_number") % 5 == 0, F.replace("artifact_path", F.lit(".png"), F.lit(".gif"))).when(F.col("page_number") % 3 == 0, F.upper("artifact_path")).otherwise(F.col("artifact_path")))
    return links.binding_problems(b.unionByName(b.where("page_number = 2").withColumn("artifact_path", F.concat(F.lit("x/"), "artifact_path"))))


def page_artifact_ids(spark, sf_dir):
    return order.page_artifact_ids(_bindings(spark, sf_dir)).select("run_id", "page_number", "collection", "block_id", "artifact_id")


def artifact_ids(spark, sf_dir):
    a = nested.artifacts(table(spark, sf_dir, "parsed_documents")).where("kind IN ('image', 'table_csv')").select("document_id", F.expr("IF(kind = 'image', 'image', 'table')").alias("collection"), "path").distinct()
    return order.artifact_ids(a)


def normalized_blocks(spark, sf_dir):
    return contract.normalized_blocks(_blocks(spark, sf_dir)).select("run_id", "page_number", "block_no", "block_id", "block_order", "parser_block_order")


def provenance_boxes(spark, sf_dir):
    """Boxes of elements under the rule for their pages' sizes."""
    d = table(spark, sf_dir, "parsed_documents").dropDuplicates(["document_id"])
    pages = d.select("document_id", F.explode("pages").alias("p")).select("document_id", F.col("p.page_number").alias("page_number"), F.col("p.width").alias("width"), F.col("p.height").alias("height"))
    b = nested.provenance(d).withColumnsRenamed({"x0": "l", "y0": "b", "x1": "r", "y1": "t"}).join(pages, ["document_id", "page_number"], "left")
    # a tenth of the boxes reach over the page's edge, and some have no height
    b = b.withColumn("r", F.expr("IF(provenance_no = 1 AND length(element_id) % 2 = 0, width + 0.25, r)")).withColumn("t", F.expr("IF(page_number % 4 = 0, b, t)"))
    box = G.page_box(F.col("l"), F.col("t"), F.col("r"), F.col("b"), F.col("width"), F.col("height"))
    return b.select("document_id", "element_id", "provenance_no", "page_number", *[v.alias(k) for k, v in box.items()])


def box_counters(spark, sf_dir):
    """How many boxes of each document were clamped, grown and rejected."""
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))
    return provenance_boxes(spark, sf_dir).groupBy("document_id").agg(n(F.col("clamped")).alias("clamped"), n(F.col("expanded")).alias("expanded"), n(F.col("problem").isNotNull()).alias("rejected"))


QUERIES = {f.__name__: f for f in (
    reading_order_blocks, reading_order_tree, item_ordinals, artifact_binding, caption_join, missing_references, iou_match, bbox_normalize, bbox_expand, block_boxes, bbox_scale_1000, polygon_box, union_box,
    label_extract, label_bbox, page_text_concat, kind_map, element_ids, binding_problems, page_artifact_ids, artifact_ids, normalized_blocks,
    provenance_boxes, box_counters)}

_BLOCKS = """(SELECT run_id, document_id, page_number, width, height, CAST(i + 1 AS INTEGER) AS block_no, b->>'$.block_id' AS block_id, b->>'$.block_label' AS block_label, b->>'$.block_content' AS block_content,
    CAST(b->>'$.block_order' AS BIGINT) AS block_order, CAST(b->'$.block_bbox' AS DOUBLE[]) AS bb
  FROM (SELECT *, json_extract(page_json, '$.parsing_res_list[' || i || ']') AS b FROM (SELECT *, unnest(range(0, CAST(coalesce(json_array_length(page_json, '$.parsing_res_list'), 0) AS BIGINT))) AS i
    FROM (SELECT DISTINCT ON (run_id, page_number) * FROM run_pages WHERE json_valid(page_json)) u) s) t)"""
_ALL_PAGES = "(SELECT DISTINCT ON (run_id, page_number) * FROM run_pages)"


def _kinds(value: str, pairs: dict[str, str]) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " ELSE 'other' END"


_EXPANDED = """CASE WHEN {hi} > {lo} THEN {lo} ELSE (CASE WHEN least({lim}, greatest(0.0, {lo} - 0.25) + 0.5) - greatest(0.0, {lo} - 0.25) < 0.5 THEN greatest(0.0, least({lim}, greatest(0.0, {lo} - 0.25) + 0.5) - 0.5) ELSE greatest(0.0, {lo} - 0.25) END) END"""
_EXPANDED_HI = "CASE WHEN {hi} > {lo} THEN {hi} ELSE least({lim}, greatest(0.0, {lo} - 0.25) + 0.5) END"


def _grown(lo: str, hi: str, lim: str) -> tuple[str, str, str]:
    return _EXPANDED.format(lo=lo, hi=hi, lim=lim), _EXPANDED_HI.format(lo=lo, hi=hi, lim=lim), f"({hi} > {lo} OR ({lo} >= 0 AND {lo} <= {lim} AND {lim} >= 0.5))"


_X, _Y = _grown("cx0", "cx1", "100.0"), _grown("cy0", "cy1", "50.0")
_BX, _BY = _grown("bx0", "bx1", "width"), _grown("by0", "by1", "height")
_L = _grown("low", "high", "49.0")
_CHUNKS = """(SELECT document_id, page_number, i, (i % 7 * 100)::DOUBLE AS x, (790 - i * 12)::DOUBLE AS y, trim(regexp_replace(line, '[\\s\\p{Z}\\x{1c}-\\x{1f}\\x{85}]+', ' ', 'g')) AS line
  FROM (SELECT document_id, page_number, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM (SELECT DISTINCT document_id, page_number, text FROM native_text_pages WHERE text IS NOT NULL) p) s)"""
_TABLE = "(?i)^\\s*table\\s+(\\d+)(?:(\\s*[.:])|(\\s+(?:continued|cont\\.?)(?:\\s+on\\s+(?:the\\s+)?next\\s+page)?\\s*$)|(\\s*$))"
_FIGURE = "(?i)^\\s*fig(?:ure)?\\.?\\s*(\\d+)\\s*[.:]"
_LABELS = f"""(SELECT *, length(matched_text) AS n FROM (SELECT *, CASE WHEN regexp_matches(line, '{_TABLE}') THEN 'table' WHEN regexp_matches(line, '{_FIGURE}') THEN 'figure' END AS object_type,
    CAST(CASE WHEN regexp_matches(line, '{_TABLE}') THEN regexp_extract(line, '{_TABLE}', 1) WHEN regexp_matches(line, '{_FIGURE}') THEN regexp_extract(line, '{_FIGURE}', 1) END AS BIGINT) AS label_number,
    CASE WHEN regexp_matches(line, '{_TABLE}') THEN regexp_extract(line, '{_TABLE}', 0) WHEN regexp_matches(line, '{_FIGURE}') THEN regexp_extract(line, '{_FIGURE}', 0) END AS matched_text,
    CASE WHEN regexp_matches(line, '{_TABLE}') THEN CASE WHEN regexp_extract(line, '{_TABLE}', 2) <> '' THEN 'punctuated' WHEN regexp_extract(line, '{_TABLE}', 3) <> '' THEN 'continued' ELSE 'bare' END END AS label_form
  FROM {_CHUNKS} c) d WHERE object_type IS NOT NULL)"""

_BINDINGS = f"""(SELECT run_id, page_number, collection, CAST(place AS INTEGER) AS place, a.block_id AS block_id, a.artifact_path AS artifact_path FROM (SELECT run_id, page_number, 'images' AS collection, unnest(images) AS a, unnest(range(0, len(images))) AS place
  FROM {_ALL_PAGES} p UNION ALL SELECT run_id, page_number, 'tables', unnest(tables), unnest(range(0, len(tables))) FROM {_ALL_PAGES} p) s)"""
_PX, _PY = _grown("cx0", "cx1", "width"), _grown("cy0", "cy1", "height")
_PROVENANCE_BOXES = f"""
WITH d AS (SELECT DISTINCT ON (document_id) * FROM parsed_documents), g AS (SELECT document_id, p.page_number AS page_number, p.width AS width, p.height AS height FROM (SELECT document_id, unnest(pages) AS p FROM d) s),
e AS (SELECT document_id, e.element_id AS element_id, unnest(e.provenance) AS p, unnest(range(1, 1 + len(e.provenance))) AS n FROM (SELECT document_id, unnest(elements) AS e FROM d) s),
b AS (SELECT e.document_id, element_id, CAST(n AS INTEGER) AS provenance_no, p.page_number AS page_number, width, height, p.bbox.x0 AS l, p.bbox.y0 AS b, CASE WHEN n = 1 AND length(element_id) % 2 = 0 THEN width + 0.25 ELSE p.bbox.x1 END AS r,
  CASE WHEN p.page_number % 4 = 0 THEN p.bbox.y0 ELSE p.bbox.y1 END AS t FROM e LEFT JOIN g ON g.document_id = e.document_id AND g.page_number = e.p.page_number),
s AS (SELECT *, least(l, r) AS sx0, greatest(l, r) AS sx1, least(t, b) AS sy0, greatest(t, b) AS sy1 FROM b),
c AS (SELECT *, least(greatest(sx0, 0.0), width) AS cx0, least(greatest(sx1, 0.0), width) AS cx1, least(greatest(sy0, 0.0), height) AS cy0, least(greatest(sy1, 0.0), height) AS cy1,
  CASE WHEN l IS NULL OR t IS NULL OR r IS NULL OR b IS NULL THEN 'invalid_box' WHEN width IS NULL OR height IS NULL THEN 'unknown_page' WHEN sx0 < -0.5 OR sy0 < -0.5 OR sx1 > width + 0.5 OR sy1 > height + 0.5 THEN 'outside_page' END AS problem FROM s)
SELECT document_id, element_id, provenance_no, page_number, CASE WHEN problem IS NULL THEN {_PX[0]} END AS x0, CASE WHEN problem IS NULL THEN {_PY[0]} END AS y0, CASE WHEN problem IS NULL THEN {_PX[1]} END AS x1, CASE WHEN problem IS NULL THEN {_PY[1]} END AS y1,
  problem IS NULL AND (cx0 <> sx0 OR cx1 <> sx1 OR cy0 <> sy0 OR cy1 <> sy1) AS clamped, problem IS NULL AND (NOT cx1 > cx0 OR NOT cy1 > cy0) AS expanded, problem FROM c
"""

SQL = {
    "reading_order_blocks": f"""
SELECT run_id, page_number, block_no, block_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY page_number, place, block_no) - 1 AS INTEGER) AS reading_order
FROM (SELECT *, CASE WHEN bool_or(block_order IS NULL) OVER (PARTITION BY run_id, page_number) THEN block_no ELSE block_order END AS place FROM {_BLOCKS} b) p
""",
    "reading_order_tree": """
WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS parent, CAST(n_nationkey AS BIGINT) AS ord, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'r' || n_regionkey, 100, 'n0' FROM nation WHERE n_nationkey < 2
  UNION ALL SELECT 'n' || c_nationkey, c_custkey, 'c' || c_custkey FROM customer),
w AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS node, CAST([] AS BIGINT[]) AS path, 0 AS depth FROM region UNION ALL
  SELECT w.root, e.child, list_append(w.path, e.ord), w.depth + 1 FROM w JOIN e ON w.node = e.parent)
SELECT root, node, CAST(row_number() OVER (PARTITION BY root ORDER BY path) - 1 AS INTEGER) AS reading_order FROM (SELECT root, node, min(path) AS path FROM w WHERE depth > 0 GROUP BY ALL) f
""",
    "item_ordinals": f"""
SELECT run_id, page_number, block_no, 'item-' || (row_number() OVER (PARTITION BY run_id ORDER BY page_number, block_no) - 1) AS item_id,
  CASE WHEN block_label IN ('image', 'table') THEN printf('page-%04d-%s-%03d', page_number, block_label, CAST(sum(CASE WHEN block_label IN ('image', 'table') THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, page_number ORDER BY block_no) AS INTEGER)) END AS export_name
FROM {_BLOCKS} b
""",
    "artifact_binding": f"""
WITH a AS (SELECT run_id, page_number, a.block_id AS block_id, min(a.artifact_path) AS artifact_path FROM (SELECT run_id, page_number, unnest(list_concat(coalesce(images, []), coalesce(tables, []))) AS a FROM {_ALL_PAGES} p) s GROUP BY ALL),
b AS (SELECT run_id, page_number, block_no, block_id, {_kinds("block_label", contract.BLOCK_KINDS)} AS kind FROM {_BLOCKS} b)
SELECT b.run_id, b.page_number, b.block_no, b.block_id, CASE WHEN kind IN ('table', 'picture') AND artifact_path IS NULL THEN 'other' ELSE kind END AS kind,
  CASE WHEN kind IN ('table', 'picture') THEN artifact_path END AS artifact_path, kind IN ('table', 'picture') AND artifact_path IS NULL AS artifact_missing
FROM b LEFT JOIN a ON a.run_id = b.run_id AND a.page_number = b.page_number AND a.block_id = b.block_id
""",
    "caption_join": """
WITH e AS (SELECT document_id, unnest(elements) AS e, unnest(range(1, 1 + len(elements))) AS n FROM (SELECT DISTINCT ON (document_id) * FROM parsed_documents) d),
r AS (SELECT document_id, e.element_id AS element_id, s AS ord, n + s AS ref FROM e, (VALUES (-1), (1)) v(s) WHERE e.kind IN ('table', 'picture'))
SELECT r.document_id, r.element_id, string_agg(c.e.text, chr(10) ORDER BY r.ord, c.e.text) AS caption FROM r JOIN e c ON c.document_id = r.document_id AND c.n = r.ref AND c.e.kind = 'caption' GROUP BY ALL
""",
    "missing_references": """
WITH n AS (SELECT DISTINCT document_id, unnest(e.artifact_ids) AS ref FROM (SELECT document_id, unnest(elements) AS e FROM parsed_documents) s),
k AS (SELECT DISTINCT document_id, a.artifact_id AS ref FROM (SELECT document_id, unnest(artifacts) AS a FROM parsed_documents) s)
SELECT 'artifact' AS kind, document_id, ref FROM n WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.document_id = n.document_id AND k.ref = n.ref)
""",
    "iou_match": f"""
WITH l AS (SELECT run_id, page_number, CAST(i + 1 AS INTEGER) AS box_no, b->>'$.label' AS label, CAST(b->'$.coordinate' AS DOUBLE[]) AS c FROM (SELECT *, json_extract(page_json, '$.layout_boxes[' || i || ']') AS b
  FROM (SELECT *, unnest(range(0, CAST(coalesce(json_array_length(page_json, '$.layout_boxes'), 0) AS BIGINT))) AS i FROM (SELECT DISTINCT ON (run_id, page_number) * FROM run_pages WHERE json_valid(page_json)) u) s) t),
p AS (SELECT l.run_id, l.page_number, l.label, l.box_no, b.block_no, least(c[3], bb[3]) - greatest(c[1], bb[1]) AS w, least(c[4], bb[4]) - greatest(c[2], bb[2]) AS h, (c[3] - c[1]) * (c[4] - c[2]) + (bb[3] - bb[1]) * (bb[4] - bb[2]) AS areas
  FROM l JOIN {_BLOCKS} b ON l.run_id = b.run_id AND l.page_number = b.page_number AND l.label = b.block_label),
o AS (SELECT *, CASE WHEN w <= 0 OR h <= 0 OR areas - w * h <= 0 THEN 0.0 ELSE w * h / (areas - w * h) END AS overlap FROM p),
r AS (SELECT *, rank() OVER (PARTITION BY run_id, page_number, label, box_no ORDER BY overlap DESC) AS k, count(*) OVER (PARTITION BY run_id, page_number, label, box_no, overlap) AS ties FROM o WHERE overlap >= 0.75)
SELECT l.run_id, l.page_number, l.label, l.box_no, r.block_no, r.overlap FROM l LEFT JOIN r ON r.k = 1 AND r.ties = 1 AND l.run_id = r.run_id AND l.page_number = r.page_number AND l.label = r.label AND l.box_no = r.box_no
""",
    "bbox_normalize": f"""
WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity * 2 - 1.25 AS l, l_discount * 500 - 0.75 AS t, l_tax * 1260 - 0.25 AS r, l_quantity AS b FROM lineitem),
s AS (SELECT *, least(l, r) AS sx0, greatest(l, r) AS sx1, least(t, b) AS sy0, greatest(t, b) AS sy1 FROM b),
c AS (SELECT *, least(greatest(sx0, 0.0), 100.0) AS cx0, least(greatest(sx1, 0.0), 100.0) AS cx1, least(greatest(sy0, 0.0), 50.0) AS cy0, least(greatest(sy1, 0.0), 50.0) AS cy1,
  CASE WHEN sx0 < -0.5 OR sy0 < -0.5 OR sx1 > 100.5 OR sy1 > 50.5 THEN 'outside_page' END AS problem FROM s)
SELECT l_orderkey, l_linenumber, CASE WHEN problem IS NULL THEN {_X[0]} END AS x0, CASE WHEN problem IS NULL THEN {_Y[0]} END AS y0, CASE WHEN problem IS NULL THEN {_X[1]} END AS x1, CASE WHEN problem IS NULL THEN {_Y[1]} END AS y1,
  problem IS NULL AND (cx0 <> sx0 OR cx1 <> sx1 OR cy0 <> sy0 OR cy1 <> sy1) AS clamped, problem IS NULL AND (NOT cx1 > cx0 OR NOT cy1 > cy0) AS expanded, problem FROM c
""",
    "bbox_expand": f"""
WITH i AS (SELECT l_orderkey, l_linenumber, l_quantity - 1 AS low, l_quantity - 1 + CASE WHEN l_tax > 0.04 THEN 0 ELSE 3 END AS high FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN {_L[2]} THEN {_L[0]} END AS x0, CASE WHEN {_L[2]} THEN {_L[1]} END AS x1, NOT high > low AS expanded, {_L[2]} AS valid FROM i
""",
    "block_boxes": f"""
WITH b AS (SELECT run_id, page_number, block_no, width, height, bb[1] AS bx0, bb[2] AS by0, bb[3] AS bx1, bb[4] AS by1 FROM {_BLOCKS} b),
c AS (SELECT *, CASE WHEN bx0 IS NULL OR by0 IS NULL OR bx1 IS NULL OR by1 IS NULL THEN 'invalid_box' WHEN bx1 < bx0 OR by1 < by0 THEN 'inverted' WHEN bx0 < 0 OR by0 < 0 OR bx1 > width OR by1 > height THEN 'outside_page'
  WHEN NOT ({_BX[2]} AND {_BY[2]}) THEN 'not_expandable' END AS problem FROM b)
SELECT run_id, page_number, block_no, CASE WHEN problem IS NULL THEN {_BX[0]} END AS x0, CASE WHEN problem IS NULL THEN {_BY[0]} END AS y0, CASE WHEN problem IS NULL THEN {_BX[1]} END AS x1, CASE WHEN problem IS NULL THEN {_BY[1]} END AS y1,
  problem IS NULL AND (bx1 = bx0 OR by1 = by0) AS expanded, problem FROM c
""",
    "bbox_scale_1000": f"""
WITH b AS (SELECT run_id, page_number, block_no, width, height, bb, coalesce(bb[1] >= 0 AND bb[2] >= 0 AND bb[3] <= 1000 AND bb[4] <= 1000 AND bb[3] > bb[1] AND bb[4] > bb[2], false) AS valid FROM {_BLOCKS} b)
SELECT run_id, page_number, block_no, CASE WHEN valid THEN bb[1] * width / 1000 END AS x0, CASE WHEN valid THEN bb[2] * height / 1000 END AS y0, CASE WHEN valid THEN bb[3] * width / 1000 END AS x1, CASE WHEN valid THEN bb[4] * height / 1000 END AS y1, valid FROM b
""",
    "polygon_box": f"SELECT run_id, page_number, block_no, least(bb[1], bb[3]) AS x0, least(bb[2], bb[4]) AS y0, greatest(bb[1], bb[3]) AS x1, greatest(bb[2], bb[4]) AS y1 FROM {_BLOCKS} b WHERE len(bb) = 4",
    "union_box": """
SELECT document_id, p.page_number AS page_number, min(p.bbox.x0) AS x0, min(p.bbox.y0) AS y0, max(p.bbox.x1) AS x1, max(p.bbox.y1) AS y1
FROM (SELECT document_id, unnest(e.provenance) AS p FROM (SELECT document_id, unnest(elements) AS e FROM parsed_documents) s) t GROUP BY ALL
""",
    "label_extract": f"SELECT document_id, page_number, object_type, label_number, matched_text, label_form, CAST(row_number() OVER (PARTITION BY document_id ORDER BY page_number, y DESC, x, object_type, label_number) AS INTEGER) AS label_no FROM {_LABELS} l",
    "label_bbox": f"""
SELECT document_id, page_number, CAST(i AS INTEGER) AS i, greatest(0.0, x / 600) AS x0, greatest(0.0, (800 - (y + 10)) / 800) AS y0, least(1.0, (x + greatest(10.0, least(240.0, n * 10.0 * 0.6))) / 600) AS x1, least(1.0, (800 - (y - greatest(1.0, 10.0 * 0.25))) / 800) AS y1,
  x / 600 AS x_normalized, (800 - y) / 800 AS y_normalized FROM {_LABELS} l
""",
    "page_text_concat": f"SELECT run_id, page_number, string_agg(block_content, chr(10) || chr(10) ORDER BY block_no) AS text FROM {_BLOCKS} b WHERE block_content <> '' GROUP BY run_id, page_number",
    "kind_map": f"SELECT run_id, page_number, block_no, {_kinds('block_label', contract.BLOCK_KINDS)} AS kind, {_kinds('block_label', contract.ELEMENT_KINDS)} AS primary_kind FROM {_BLOCKS} b",
    "element_ids": f"""
SELECT run_id, page_number, block_no, 'block-' || page_number || '-' || coalesce(CASE WHEN regexp_full_match(block_id, '[A-Za-z0-9][A-Za-z0-9._-]{{0,159}}') THEN block_id ELSE NULL END,
  CASE WHEN block_id IS NULL THEN NULL ELSE CASE WHEN regexp_matches(trim(regexp_replace(block_id, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), '^[A-Za-z0-9]') THEN trim(regexp_replace(block_id, '[^A-Za-z0-9._-]+', '_', 'g'), '_')[1:159] ELSE 'id-' || sha256(block_id)[1:16] END END,
  CAST(block_order AS VARCHAR), 'unknown') AS element_id FROM {_BLOCKS} b
""",
    "binding_problems": """
WITH b AS {B}, c AS (SELECT * REPLACE (CASE WHEN page_number % 5 = 0 THEN replace(artifact_path, '.png', '.gif') WHEN page_number % 3 = 0 THEN upper(artifact_path) ELSE artifact_path END AS artifact_path) FROM b),
d AS (SELECT * FROM c UNION ALL SELECT * REPLACE ('x/' || artifact_path AS artifact_path) FROM c WHERE page_number = 2)
SELECT *, CASE WHEN count(*) OVER (PARTITION BY run_id, page_number, block_id) > 1 THEN 'duplicate_binding' WHEN count(*) OVER (PARTITION BY run_id, artifact_path) > 1 THEN 'destination_conflict'
  WHEN NOT CASE WHEN collection = 'tables' THEN lower(artifact_path) LIKE '%.csv' ELSE regexp_matches(lower(artifact_path), '\\.(png|jpg|jpeg|webp)$') END THEN 'suffix' END AS problem FROM d
""".replace("{B}", _BINDINGS),
    "page_artifact_ids": f"""
SELECT run_id, page_number, collection, block_id, rtrim(collection, 's') || '-' || (row_number() OVER (PARTITION BY run_id, collection ORDER BY page_number, place, artifact_path) - 1) AS artifact_id FROM {_BINDINGS} b
""",
    "artifact_ids": """
WITH a AS (SELECT DISTINCT document_id, CASE WHEN a.kind = 'image' THEN 'image' ELSE 'table' END AS collection, a.path AS path FROM (SELECT document_id, unnest(artifacts) AS a FROM parsed_documents) s WHERE a.kind IN ('image', 'table_csv'))
SELECT *, collection || '-' || (row_number() OVER (PARTITION BY document_id, collection ORDER BY string_split(path, '/')[-1], path) - 1) AS artifact_id FROM a
""",
    "normalized_blocks": f"""
SELECT run_id, page_number, block_no, CASE WHEN regexp_full_match(block_id, '-?[0-9]+') THEN block_id ELSE CAST(block_no - 1 AS VARCHAR) END AS block_id, CAST(block_no - 1 AS BIGINT) AS block_order, block_order AS parser_block_order FROM {_BLOCKS} b
""",
    "provenance_boxes": _PROVENANCE_BOXES,
    "box_counters": f"""
SELECT document_id, CAST(sum(CAST(coalesce(clamped, false) AS BIGINT)) AS BIGINT) AS clamped, CAST(sum(CAST(coalesce(expanded, false) AS BIGINT)) AS BIGINT) AS expanded, count(problem) AS rejected FROM ({_PROVENANCE_BOXES}) b GROUP BY document_id
""",
}
