"""Operators on small fixtures: nulls, ties, repeats, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import contract, evidence, incremental, links, nested, order, quality, validate
from quire.sources import packages, sinks

DOCUMENT = (
    "document_id STRING, elements ARRAY<STRUCT<element_id: STRING, kind: STRING, reading_order: INT, provenance: ARRAY<STRUCT<page_number: INT, bbox: STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE, unit: STRING, origin: STRING>, "
    "parser_element_ref: STRING>>, artifact_ids: ARRAY<STRING>, text: STRING>>, artifacts ARRAY<STRUCT<artifact_id: STRING, kind: STRING, path: STRING, media_type: STRING, content_sha256: STRING>>, e STRING, known STRING, child_id STRING"
)
PAGE = "run_id STRING, document_id STRING, page_number INT, page_json STRING, page STRING, b STRING"


def nested_rows(spark):
    place = (1, (0.0, 0.0, 1.0, 1.0, "pt", "top-left"), "#/1")
    documents = [
        ("d1", [("e1", "text", 0, [place, None, place], ["a1", "a1", "a9", None], "x"), None, (None, None, None, None, None, None)], [("a1", "image", "p", "m", "s"), None], "c", "c", "c"),
        ("d1", [("e1", "text", 0, [place, None, place], ["a1", "a1", "a9", None], "x"), None, (None, None, None, None, None, None)], [("a1", "image", "p", "m", "s"), None], "c", "c", "c"),
        ("d2", None, None, None, None, None), (None, [], [], None, None, None),
    ]
    pages = [
        ("r1", "d1", 1, '{"parsing_res_list": [{"block_id": 7, "block_content": "\\u4e2d"}, null, {"block_id": "b"}, {}]}', "c", "c"), ("r1", "d1", 2, '{"parsing_res_list": [{"block_id": 1', None, None),
        ("r1", "d1", 3, None, None, None), ("r1", "d1", 4, "[]", None, None), ("r1", None, 5, '{"parsing_res_list": null}', None, None),
    ]
    return spark.createDataFrame(documents, DOCUMENT), spark.createDataFrame(pages, PAGE)


def test_nested_links(spark):
    documents, pages = nested_rows(spark)
    got = {tuple(r) for r in nested.parent_child_links(documents, pages).collect()}
    assert got == {("provenance", "d1", "e1", "1"), ("provenance", "d1", "e1", "3"), ("artifact", "d1", "e1", "a1"), ("block", "r1", "1", "7"), ("block", "r1", "1", "b"), ("block", "r1", "1", None)}
    assert nested.blocks(pages).where("block_id = '7'").collect()[0]["block_content"] == "中"
    assert nested.elements(documents).count() == 4 and nested.artifact_links(documents).where("NOT resolved").count() == 2


@pytest.mark.parametrize(("field", "value", "got"), [
    ("block_bbox", '{"x0": 1, "y0": "2", "x1": 3.5, "y1": 4}', [1.0, 2.0, 3.5, 4.0]), ("block_bbox", '["1", 2, 3, "x"]', [1.0, 2.0, 3.0, None]), ("block_bbox", '"none"', None), ("block_bbox", "7", None),
    ("block_order", '"1"', 1), ("block_order", "1.0", 1), ("block_order", "1.5", None), ("block_order", "{}", None), ("block_id", "1.5", "1.5"), ("block_id", '{"a":1}', '{"a":1}'), ("block_label", "[1]", "[1]"), ("block_content", "3", "3"),
])
def test_no_block_is_lost_for_a_field_of_another_type(spark, field, value, got):
    page = '{"width": "595.5", "height": [1], "page_index": "2.0", "ocr_lines": {}, "parsing_res_list": ["x", 3, {"block_id": "a", "%s": %s}, [1], {"block_id": "b"}]}' % (field, value)
    pages = spark.createDataFrame([("r", "d", 1, page, None, None)], PAGE)
    rows = nested.blocks(pages).orderBy("block_no").collect()
    assert [r["block_no"] for r in rows] == [3, 5] and rows[0][field] == got and rows[1]["block_id"] == "b"
    read = nested.read_pages(pages).collect()[0]["page"]
    assert (read["width"], read["height"], read["page_index"], read["ocr_lines"]) == (595.5, None, 2, None)


def test_links_of_a_document_with_many_artifacts(spark):
    names = [f"a{i}" for i in range(300)]
    row = ("d", [(f"e{i}", "k", 0, None, [names[i], f"x{i}"], None) for i in range(300)], [(n, "i", "p", "m", "s") for n in names], None, None, None)
    rows = nested.artifact_links(spark.createDataFrame([row], DOCUMENT)).collect()
    assert len(rows) == 600 and all(r["resolved"] == r["artifact_id"].startswith("a") for r in rows)


def test_nested_empty(spark):
    documents, pages = nested_rows(spark)
    assert nested.parent_child_links(documents.limit(0), pages.limit(0)).count() == 0


def test_tree_order_skips_repeats_and_ends_cycles(spark):
    edges = spark.createDataFrame([("b", 0, "g"), ("b", 1, "t1"), ("g", 0, "t2"), ("g", 1, "t1"), ("t1", 0, "b")], "parent STRING, ord BIGINT, child STRING")
    roots = spark.createDataFrame([("d", "b")], "root STRING, node STRING")
    got = {r["node"]: r["reading_order"] for r in order.tree_order(edges, roots, deepest=8).where("node <> 'b'").orderBy("reading_order").collect()}
    assert list(got) == ["g", "t2", "t1"]


def test_tree_order_reaches_any_depth(spark):
    edges = spark.createDataFrame([(str(i), 0, str(i + 1)) for i in range(120)] + [("120", 0, "0"), ("120", 1, "last")], "parent STRING, ord BIGINT, child STRING")
    roots = spark.createDataFrame([("d", "0")], "root STRING, node STRING")
    got = [r["node"] for r in order.tree_order(edges, roots).orderBy("reading_order").collect()]
    assert got == [*map(str, range(1, 121)), "last"]


def test_block_order_with_missing_order_keeps_places(spark):
    b = spark.createDataFrame([("r", 1, 1, 5), ("r", 1, 2, 3), ("r", 2, 1, 9), ("r", 2, 2, None), ("r", 2, 3, 1)], "run_id STRING, page_number INT, block_no INT, block_order BIGINT")
    got = [(r["page_number"], r["block_no"]) for r in order.block_order(b).orderBy("reading_order").collect()]
    assert got == [(1, 2), (1, 1), (2, 1), (2, 2), (2, 3)]


def test_match_boxes_rejects_ties(spark):
    schema = "run_id STRING, page_number INT, label STRING, {} INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE"
    boxes = spark.createDataFrame([("r", 1, "t", 1, 0.0, 0.0, 10.0, 10.0), ("r", 1, "t", 2, 50.0, 0.0, 60.0, 10.0), ("r", 1, "x", 3, 0.0, 0.0, 10.0, 10.0)], schema.format("box_no"))
    blocks = spark.createDataFrame([("r", 1, "t", 1, 0.0, 0.0, 10.0, 9.0), ("r", 1, "t", 2, 0.0, 0.0, 10.0, 9.0), ("r", 1, "t", 3, 50.0, 0.0, 60.0, 9.0)], schema.format("block_no"))
    assert {r["box_no"]: r["block_no"] for r in links.match_boxes(boxes, blocks).collect()} == {1: None, 2: 3, 3: None}


def test_gate_decisions(spark):
    schema = "document_id STRING, status STRING, flags ARRAY<STRING>, ocr_used BOOLEAN, ocr_mean DOUBLE, low_confidence_pages INT, page_count INT, uncovered INT, characters_per_page DOUBLE, lost_share DOUBLE, cjk_space_share DOUBLE, empty_tables INT, sparse_tables INT, source_matches BOOLEAN, readable BOOLEAN, encrypted BOOLEAN, source_page_count INT, scan_pages INT, low_resolution_pages INT, unclassified_pages INT"
    base = dict(status="succeeded", flags=[], ocr_used=False, ocr_mean=None, low_confidence_pages=0, page_count=3, uncovered=0, characters_per_page=50.0, lost_share=0.0, cjk_space_share=0.0, empty_tables=0, sparse_tables=0, source_matches=True, readable=True, encrypted=False, source_page_count=3, scan_pages=0, low_resolution_pages=0, unclassified_pages=0)
    cases = {
        "ok": {}, "spaced": {"cjk_space_share": 0.02}, "scan": {"flags": ["ocr_confidence_unavailable"], "low_resolution_pages": 3, "scan_pages": 3, "ocr_used": True}, "short": {"page_count": 2},
        "locked": {"status": "failed", "readable": False, "encrypted": True, "page_count": 0, "characters_per_page": 0.0}, "partial": {"status": "partial", "page_count": 1}, "hash": {"source_matches": False},
        "unknown": {k: None for k in ("source_matches", "readable", "encrypted", "source_page_count", "scan_pages")},
    }
    rows = [tuple({"document_id": k, **base, **v}[c.split()[0]] for c in schema.split(", ")) for k, v in cases.items()]
    got = {r["document_id"]: (r["decision"], r["route_action"], r["reason_codes"]) for r in quality.gate(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        "ok": ("accept", "publish", []), "unknown": ("accept", "publish", []), "spaced": ("review", "publish", ["cjk_internal_space_ratio_above_policy"]),
        "scan": ("review", "publish", ["ocr_confidence_unavailable", "scan_resolution_below_policy"]), "short": ("reject", "fallback", ["source_contract_page_count_mismatch"]),
        "locked": ("reject", "fallback", ["parse_failed", "source_pdf_encrypted"]), "partial": ("reject", "fallback", ["partial_parse", "partial_source_contract_page_count_mismatch"]), "hash": ("reject", "fallback", ["source_hash_mismatch"]),
    }


def test_ocr_confidence_weighs_lines(spark):
    lines = spark.createDataFrame([("d", 1, 0.9), ("d", 1, 0.5), ("d", 2, 0.9), ("d", 2, 0.5), ("d", 3, None)], "document_id STRING, page_number INT, score DOUBLE")
    r = quality.ocr_confidence(lines, 0.75).collect()[0]
    assert round(r["mean_confidence"], 6) == 0.7 and r["low_confidence_pages"] == [1, 2]


def test_route(spark):
    side = "document_id STRING, route_action STRING, failure_code STRING"
    p = spark.createDataFrame([("a", "publish", None), ("b", "fallback", None), ("c", "fallback", None), ("d", None, "PARSER_RUN_FAILED")], side)
    f = spark.createDataFrame([("b", "publish", None), ("c", "fallback", None), ("d", "publish", None)], side)
    assert {r[0]: r[1] for r in quality.route(p, f).collect()} == {"a": "selected_primary", "b": "selected_fallback", "c": "degraded", "d": "selected_fallback"}
    assert {r[0] for r in quality.needs_fallback(p).collect()} == {"b", "c", "d"}


def test_labels(spark):
    texts = ["Table 4. Results", "Table 4  continued", "table 12", "Fig. 7: Forest plot", "Figure 7 Forest", "a Table 4."]
    rows = [("d", 1, 600.0, 800.0, 50.0, 700.0 - i, 10.0, t) for i, t in enumerate(texts)]
    found = evidence.labels(spark.createDataFrame(rows, "document_id STRING, page_number INT, page_width DOUBLE, page_height DOUBLE, x DOUBLE, y DOUBLE, font_size DOUBLE, text STRING"))
    got = [(r["object_type"], r["label_number"], r["label_form"]) for r in order.label_order(found).orderBy("label_no").collect()]
    assert got == [("table", 4, "punctuated"), ("table", 4, "continued"), ("table", 12, "bare"), ("figure", 7, None)]
    assert validate.label(found).where("size(violations) > 0").count() == 0


def test_text_views(spark):
    v = spark.createDataFrame([("same", "abc", "abc"), ("other", "abc", "xyz"), ("blind", "abc", ""), ("mute", "", "abc")], "document_id STRING, parsed STRING, native STRING")
    got = {r["document_id"]: r["decision"] for r in evidence.text_route(evidence.compare_views(v)).collect()}
    assert got == {"same": "native_primary", "other": "unresolved", "blind": "visual_primary", "mute": "native_primary"}


def test_set_difference_and_inventory(spark):
    schema = "run_id STRING, path STRING, byte_size BIGINT, content_sha256 STRING"
    a = spark.createDataFrame([("r", "x", 1, "s"), ("r", "y", None, "s"), ("q", "x", 1, "s")], schema)
    b = spark.createDataFrame([("r", "x", 1, "t"), ("r", "y", None, "s"), ("r", "z", 1, "s")], schema)
    assert {(r[1], r[2]) for r in links.set_difference(a, b, ["run_id", "path"], ["byte_size", "content_sha256"]).where("run_id = 'r'").collect()} == {("x", "changed"), ("z", "untracked")}
    assert {r[0]: r[1] for r in incremental.inventory_agrees(a, b).collect()} == {"r": False, "q": False}


def test_best_attempt_keeps_first_partial(spark):
    rows = [("a", 1, "partial", True, ["X", "PARSE_TIMEOUT"]), ("a", 2, "failed", False, ["Y"]), ("b", 1, "failed", False, ["X"]), ("b", 2, "succeeded", True, []), ("c", 1, "partial", False, None)]
    got = {r[0]: (r[1], r[2], r[3], r[4]) for r in contract.best_attempt(spark.createDataFrame(rows, "document_id STRING, attempt_no INT, status STRING, has_document BOOLEAN, errors ARRAY<STRING>")).collect()}
    assert got["a"] == (1, "partial", ["PDF_PARTIAL_PARSE", "PARSE_TIMEOUT", "PDF_PARTIAL_PARSE"], []) and got["b"] == (2, "succeeded", [], ["X"]) and got["c"][1] == "failed"


def test_strict_raises_first_violation(spark):
    c = spark.createDataFrame([("a", []), ("b", ["x", "y"])], "document_id STRING, violations ARRAY<STRING>")
    with pytest.raises(validate.ViolationError, match="b: x"):
        validate.strict(c, "document_id")
    assert validate.strict(c.limit(1), "document_id").count() == 1


def test_files_and_parsers(spark, tmp_path):
    for name in ("a.pdf", "~$b.pdf", "c.PDF", "d.txt"):
        (tmp_path / name).write_bytes(name.encode())
    files = packages.documents(spark, str(tmp_path))
    assert {r["name"] for r in files.collect()} == {"a.pdf", "c.PDF"}
    assert packages.inventory(spark, str(tmp_path)).count() == 4

    class Bad:
        def parse(self, name, content, options):
            raise RuntimeError(f"timed out at /home/me/{name}")

    class Good:
        def parse(self, name, content, options):
            return packages.Attempt("succeeded" if name == "a.pdf" else "partial", [content.decode()])

    rows = packages.parse(files, [("one", Bad), ("two", Good)]).orderBy("path", "attempt_no").collect()
    assert [r["status"] for r in rows] == ["failed", "succeeded", "failed", "partial"]
    assert rows[0]["errors"][0]["code"] == "PARSE_TIMEOUT" and "/home" not in rows[0]["errors"][0]["message"]


def test_publish_refuses_and_replaces(spark, tmp_path):
    df = spark.createDataFrame([("r1", 1), ("r2", 2)], "run_id STRING, n INT")
    sinks.publish({"runs": df}, str(tmp_path / "p"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.publish({"runs": df}, str(tmp_path / "p"))
    sinks.replace_runs(spark, df, str(tmp_path / "q"))
    sinks.replace_runs(spark, df.where("run_id = 'r1'").withColumn("n", F.lit(9)), str(tmp_path / "q"))
    assert {(r["run_id"], r["n"]) for r in spark.read.parquet(str(tmp_path / "q")).collect()} == {("r1", 9), ("r2", 2)}


def test_gate_over_a_stream(spark, data, tmp_path):
    from quire.plans.quality import contract_measures
    from quire.streaming import gate

    contracts = spark.read.parquet(f"{data}/parsed_documents.parquet")
    contracts.limit(10).write.parquet(str(tmp_path / "in"))
    gate.gate_stream(gate.arriving(spark, str(tmp_path / "in"), contracts.schema), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = quality.gate(contract_measures(spark.read.parquet(str(tmp_path / "in"))))
    assert got.count() == 10 and got.exceptAll(want.select(got.columns)).count() == 0


def test_small_rules(spark):
    rows = spark.createDataFrame([("failed", None, None, None), ("partial", True, True, False), ("succeeded", True, True, True)], "status STRING, a BOOLEAN, b BOOLEAN, c BOOLEAN")
    assert [r[0] for r in rows.select(validate.full_request(F.col("status"), F.col("a"), F.col("b"), F.col("c"))).collect()] == [True, False, True]
    scores = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (float("nan"),), (None,)], "s DOUBLE")
    assert [r[0] for r in scores.select(validate.confidence(F.col("s"))).collect()] == [True, True, False, False, False]
    pages = spark.createDataFrame([("partial", 1, 0.0, 5.0), ("succeeded", 0, 5.0, 5.0), ("succeeded", 1, 5.0, 5.0), ("partial", None, 5.0, 5.0)], "status STRING, page_number INT, width DOUBLE, height DOUBLE")
    assert [r["action"] for r in validate.usable_pages(pages).collect()] == ["drop", "error", "keep", "drop"]
    swaps = F.array(F.struct(F.lit("a").alias("old"), F.lit("bb").alias("new")), F.struct(F.lit("b").alias("old"), F.lit("c").alias("new")), F.struct(F.lit("").alias("old"), F.lit("x").alias("new")))
    assert spark.range(1).select(T.replace_by_map(F.lit("aba"), swaps)).collect()[0][0] == "ccccc"


def test_page_payloads_name_each_problem(spark):
    page = "STRUCT<page_index: BIGINT, page_count: BIGINT, width: DOUBLE, height: DOUBLE>"
    rows = [("ok", 1, 5.0, 6.0, (0, 2, 5.0, 6.0)), ("ok", 2, 5.0, 6.0, (1, 2, 5.0, 6.0)), ("bad", 1, 5.0, 6.0, None), ("bad", 2, 5.0, 6.0, (2, 1, 5.0, 7.0)), ("bad", 2, 5.0, 6.0, (1, 3, 5.0, 6.0))]
    got = {r["run_id"]: r["violations"] for r in validate.page_payloads(spark.createDataFrame(rows, f"run_id STRING, page_number INT, width DOUBLE, height DOUBLE, page {page}")).collect()}
    assert got == {"ok": [], "bad": ["unreadable_page", "page_index", "page_size", "duplicate_page", "page_count_varies"]}


def test_page_images(spark):
    rows = [("d", 1, "p/1.png", "s", "s", 10, 10, 5.0, 5.0), ("d", 0, "../x", "s", "t", 0, 10, 5.0, None)]
    df = spark.createDataFrame(rows, "document_id STRING, page_number INT, image_path STRING, image_sha256 STRING, actual_sha256 STRING, width_pixels INT, height_pixels INT, width_points DOUBLE, height_points DOUBLE")
    assert [r["violations"] for r in validate.page_images(df).orderBy("page_number", ascending=False).collect()] == [[], ["page_number", "image_path", "image_sha256", "pixels", "points"]]


def test_binding_problems(spark):
    rows = [("r", 1, "images", "a", "x.PNG"), ("r", 1, "images", "b", "y.gif"), ("r", 1, "tables", "c", "t.csv"), ("r", 2, "tables", "c", "t.csv"), ("r", 3, "images", "d", "1.png"), ("r", 3, "images", "d", "2.png")]
    got = [r["problem"] for r in links.binding_problems(spark.createDataFrame(rows, "run_id STRING, page_number INT, collection STRING, block_id STRING, artifact_path STRING")).orderBy("page_number", "block_id").collect()]
    assert got == [None, "suffix", "destination_conflict", "destination_conflict", "duplicate_binding", "duplicate_binding"]


GATE = (
    "document_id STRING, status STRING, flags ARRAY<STRING>, ocr_used BOOLEAN, ocr_mean DOUBLE, low_confidence_pages INT, page_count INT, uncovered INT, characters_per_page DOUBLE, lost_share DOUBLE, "
    "cjk_space_share DOUBLE, empty_tables INT, sparse_tables INT, source_matches BOOLEAN, readable BOOLEAN, encrypted BOOLEAN, source_page_count INT, scan_pages INT, low_resolution_pages INT, unclassified_pages INT"
)
SOUND = dict(status="succeeded", flags=[], ocr_used=True, ocr_mean=0.9, low_confidence_pages=0, page_count=2, uncovered=0, characters_per_page=100.0, lost_share=0.0, cjk_space_share=0.0, empty_tables=0, sparse_tables=0,
             source_matches=True, readable=True, encrypted=False, source_page_count=2, scan_pages=0, low_resolution_pages=0, unclassified_pages=0)


def test_every_code_of_the_gate(spark):
    odd = {
        "source_hash_mismatch": dict(source_matches=False), "source_pdf_encrypted": dict(readable=False, encrypted=True), "source_pdf_unreadable": dict(readable=False), "parse_failed": dict(status="failed"),
        "partial_parse": dict(status="partial"), "ocr_low_confidence_pages": dict(low_confidence_pages=1), "ocr_mean_confidence_below_policy": dict(ocr_mean=0.84), "ocr_required_but_disabled": dict(scan_pages=1, ocr_used=False),
        "partial_source_contract_page_count_mismatch": dict(status="partial", source_page_count=3), "source_contract_page_count_mismatch": dict(source_page_count=3), "no_pages_with_parsed_content": dict(uncovered=2),
        "parsed_page_coverage_incomplete": dict(uncovered=1), "replacement_character_ratio_above_policy": dict(lost_share=0.006), "ocr_confidence_unavailable": dict(flags=["ocr_confidence_unavailable"]),
        "scan_resolution_below_policy": dict(low_resolution_pages=1), "source_pages_without_classifiable_content": dict(unclassified_pages=1), "text_density_below_policy": dict(characters_per_page=19.0),
        "cjk_internal_space_ratio_above_policy": dict(cjk_space_share=0.02), "empty_table_artifact": dict(empty_tables=1), "sparse_table_artifact": dict(sparse_tables=1),
    }
    names = [x.split()[0] for x in GATE.split(", ")]
    rows = [tuple({"document_id": code, **SOUND, **change}[n] for n in names) for code, change in odd.items()] + [tuple({"document_id": "sound", **SOUND}[n] for n in names)]
    rows.append(tuple({"document_id": "unknown", "status": "succeeded"}.get(n) for n in names))
    got = {r["document_id"]: r for r in quality.gate(spark.createDataFrame(rows, GATE)).collect()}
    assert len(odd) == 20 and got["sound"]["decision"] == got["unknown"]["decision"] == "accept"
    for code in odd:
        extra = ["partial_parse"] if code.startswith("partial_source") else []
        assert got[code]["reason_codes"] == sorted([code, *extra]), code


def test_zipped_lines_of_any_length(spark):
    df = spark.createDataFrame([(["a", "b"], [0.5], [[1.0], [2.0]]), ([], [0.5], [[1.0]]), (None, [0.5], [[1.0]])], "t ARRAY<STRING>, s ARRAY<DOUBLE>, b ARRAY<ARRAY<DOUBLE>>")
    got = [r[0] for r in df.select(contract.zipped_lines(F.col("t"), F.col("s"), F.col("b"))).collect()]
    assert [None if x is None else [tuple(y) for y in x] for x in got] == [[("a", 0.5, [1.0])], [], None]


def test_footnotes_follow_captions(spark):
    items = spark.createDataFrame([("d", "table", ["T1", " "], ["n1", None, "n2"]), ("d", "text", ["x"], ["y"]), ("d", "image", None, None)], "document_id STRING, kind STRING, captions ARRAY<STRING>, footnotes ARRAY<STRING>")
    got = [(r["row_no"], r["label"], r["caption"]) for r in contract.with_captions(items).collect()]
    assert got == [(0, "table", None), (1, "table_title", "T1"), (2, "caption", "n1"), (3, "caption", "n2"), (0, "other", None), (0, "image", None)]


def test_pages_before_a_failure_are_kept(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"a")

    class Stream:
        def parse(self, name, content, options):
            yield "page 1"
            yield "page 2"
            raise RuntimeError("page 3 is broken")

    class Nothing:
        def parse(self, name, content, options):
            return packages.Attempt("succeeded", page_count=0)

    class Rich:
        def parse(self, name, content, options):
            return packages.Attempt("succeeded", ["p"], texts=["t", None], images=[b"i", None], page_count=2)

    attempts = packages.parse(packages.documents(spark, str(tmp_path)), [("stream", Stream), ("nothing", Nothing), ("rich", Rich)])
    rows = attempts.orderBy("attempt_no").collect()
    assert [(r["status"], r["pages"], r["page_count"]) for r in rows] == [("partial", ["page 1", "page 2"], None), ("failed", [], None), ("succeeded", ["p"], 2)]
    assert [(r["page_number"], r["text"]) for r in packages.native_texts(attempts).collect()] == [(1, "t")]
    assert [(r["page_number"], bytes(r["image"]), r["scale"]) for r in packages.page_images(attempts).collect()] == [(1, b"i", 2.0)]
    with pytest.raises(ValueError):
        packages.page_images(attempts, 5.0)


def test_json_files_are_read_strictly(spark, tmp_path):
    for name, text in (("good", b'{"a": 1}'), ("list", b"[1]"), ("bad", b'{"a"'), ("latin", b'{"a": "\xe9"}')):
        (tmp_path / f"{name}.json").write_bytes(text)
    got = {r["path"].rsplit("/", 1)[1]: r["problem"] for r in packages.json_files(spark, str(tmp_path)).collect()}
    assert got == {"good.json": None, "list.json": "no_object", "bad.json": "unreadable", "latin.json": "unreadable"}


def test_content_packages(spark, tmp_path):
    for name, middle, content in (
        ("good", '{"pdf_info": [{"page_idx": 0, "page_size": [10, 20]}]}', '[{"type": "text", "text": "a", "page_idx": 0}]'),
        ("odd", '{"pdf_info": [{"page_idx": 0, "page_size": [10, 0]}, {"page_idx": 0, "page_size": [1, 1]}]}', '[{"type": "text", "page_idx": 7}]'),
        ("bare", None, None),
    ):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text("{}")
        if middle:
            (tmp_path / name / f"{name}_middle.json").write_text(middle)
            (tmp_path / name / f"{name}_content_list.json").write_text(content)
    pages, items, problems = packages.content_packages(spark, str(tmp_path))
    assert pages.count() == 3 and items.where("text = 'a'").count() == 1
    got = {(r["package"].rsplit("/", 1)[1], r["problem"]) for r in problems.collect()}
    assert got == {("odd", "page_size"), ("odd", "page_index"), ("odd", "unknown_page"), ("bare", "page_files"), ("bare", "no_content_list")}


def test_a_version_with_violations_is_not_published(spark, tmp_path):
    df = spark.createDataFrame([("r1", 1)], "run_id STRING, n INT")
    with pytest.raises(ValueError, match="violations"):
        sinks.publish({"runs": df}, str(tmp_path), checks={"runs": lambda t: t.where("n < 5")})
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, str(tmp_path), "runs")
    sinks.publish({"runs": df}, str(tmp_path), checks={"runs": lambda t: t.where("n < 0")})
    sinks.publish({"runs": df.withColumn("n", F.lit(2))}, str(tmp_path), replace=True)
    assert [r["n"] for r in sinks.published(spark, str(tmp_path), "runs").collect()] == [2]


def test_tables_as_csv_and_markdown(spark):
    import csv
    import io

    cells = [("t", 1, 1, "a"), ("t", 1, 2, 'b "q", c'), ("t", 2, 1, None), ("t", 2, 2, "x\ny")]
    text = sinks.table_csv(spark.createDataFrame(cells, "artifact_id STRING, row_no INT, column_no INT, cell STRING"), "artifact_id").first()["csv"]
    assert text.startswith("﻿") and list(csv.reader(io.StringIO(text[1:]))) == [["a", 'b "q", c'], ["", "x\ny"]]
    got = {r["document_id"]: r["problem"] for r in sinks.markdown(spark.createDataFrame([("d", "# T"), ("e", " "), ("f", None)], "document_id STRING, text STRING")).collect()}
    assert got == {"d": None, "e": "empty_text", "f": "empty_text"}
