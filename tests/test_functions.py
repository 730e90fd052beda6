import pytest
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as T
from quire.functions import trees


def one(spark, **columns):
    return spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).collect()[0]


def test_safe_message_hides_paths_and_names(spark):
    m = F.lit("cannot read /home/anna/x/report.pdf (C:\\Users\\anna\\y): bad\x07 report.pdf Traceback (most recent call last): secret")
    got = one(spark, m=T.safe_message(m, F.lit("/home/anna/x/report.pdf"), F.lit("report.pdf")))["m"]
    assert "anna" not in got and "secret" not in got and "report" not in got and "\x07" not in got
    assert one(spark, m=T.safe_message(F.lit("  ")))["m"] == T.NO_DETAIL
    assert len(one(spark, m=T.safe_message(F.repeat(F.lit("x"), F.lit(900))))["m"]) == 500


def test_error_codes_in_order(spark):
    for text, code in (("Timed out, password needed", "PDF_ENCRYPTED"), ("timeout: out of memory", "PARSE_TIMEOUT"), ("Out of memory", "RESOURCE_EXHAUSTED"), ("?", "PDF_PARSE_FAILED")):
        assert one(spark, c=T.error_code(F.lit(text)))["c"] == code


def test_line_count_as_python(spark):
    for t in ("", "a", "a\n", "a\r\nb", "\n\n", "a\x0bb\x1c", "a\x85", "ab\r"):
        assert one(spark, n=T.line_count(F.lit(t)))["n"] == len(t.splitlines()), repr(t)


def test_python_rounding(spark):
    for x, places in ((2.675, 2), (1.005, 2), (12.345, 2), (0.125, 2)):
        assert one(spark, r=T.python_round(places)(F.lit(x)))["r"] == round(x, places)


def test_cjk_spaces(spark):
    r = one(spark, wide=T.cjk_internal_spaces(F.lit("中 文\t解 a 析")), narrow=T.cjk_internal_spaces(F.lit("中 文\t解 a 析"), T.CJK_SPACE_IN_EVIDENCE))
    assert (r["wide"], r["narrow"]) == (2, 1)


def test_identifiers(spark):
    assert one(spark, s=T.identifier_suffix(F.lit("hdr shared")))["s"] == "hdr_shared"
    assert one(spark, s=T.identifier_suffix(F.lit("中文")))["s"].startswith("id-")
    assert one(spark, s=T.block_element_id(F.lit(2), F.lit("0"), F.lit(7)))["s"] == "block-2-0"
    assert one(spark, s=T.block_element_id(F.lit(2), F.lit(None).cast("string"), F.lit(7)))["s"] == "block-2-7"
    assert one(spark, s=T.output_directory(F.lit("a b/c:d/My  file.pdf")))["s"].startswith("a_b/c_d/My_file_")


def test_compact_and_similarity(spark):
    assert one(spark, c=T.compact_text(F.lit("ｆｕｌｌ 　Å")))["c"] == "fullÅ"
    assert one(spark, s=T.order_similarity(F.lit("abcd"), F.lit("bcda")))["s"] == 0.75


@pytest.mark.parametrize("low, high, limit, want", [(10.0, 10.0, 100.0, (9.75, 10.25)), (0.0, 0.0, 100.0, (0.0, 0.5)), (100.0, 100.0, 100.0, (99.5, 100.0)), (3.0, 4.0, 100.0, (3.0, 4.0)), (-1.0, -1.0, 100.0, (None, None)), (0.1, 0.1, 0.2, (None, None))])
def test_expand(spark, low, high, limit, want):
    e = G.expand(F.lit(low), F.lit(high), F.lit(limit))
    r = one(spark, a=e.low, b=e.high)
    assert (r["a"], r["b"]) == want


def test_page_box_clamps_and_rejects(spark):
    box = lambda *v: one(spark, **{k: c for k, c in G.page_box(*[F.lit(x) for x in v], F.lit(100.0), F.lit(50.0)).items()})
    r = box(0.0, 10.0, 100.11, 0.0)
    assert r["clamped"] and r["x1"] == 100.0 and r["problem"] is None
    assert box(-1.0, 1.0, -1.0, 2.0)["problem"] == "outside_page"
    assert box(float("nan"), 1.0, 2.0, 2.0)["problem"] == "non_finite"
    r = box(10.0, 5.0, 10.0, 7.0)
    assert r["expanded"] and r["x1"] - r["x0"] == 0.5


def test_block_box_is_strict(spark):
    box = lambda *v: one(spark, **G.block_box(*[F.lit(x) for x in v], F.lit(100.0), F.lit(50.0)))["problem"]
    assert box(5.0, 1.0, 4.0, 2.0) == "inverted" and box(0.0, 0.0, 100.1, 2.0) == "outside_page" and box(1.0, 1.0, 1.0, 1.0) is None


def test_scan_resolution(spark):
    r = one(spark, s=G.scan_like(*map(F.lit, (0, 1, 1654.0, 2339.0, 595.44, 842.04))), d=G.image_dpi(*map(F.lit, (1654.0, 2339.0, 595.44, 842.04))))
    assert r["s"] and round(r["d"], 2) == 200.0


def test_trees(spark):
    r = one(spark, c=trees.clean_tree(F.lit('{"filename": "x", "a": [{"uri": "data:1", "b": "data:2"}], "p": "/home/u/f"}')), f=trees.has_forbidden_key(F.lit('{"a": [{"traceback": 1}]}')), s=trees.plain_settings(F.lit('{"a": 1, "b": {"c": 1}, "d": ["x"]}')))
    assert r["c"]["json"] == '{"a": [{"b": "[binary-data-removed]"}], "p": "/home/u/f"}' and r["c"]["problem"] == "absolute_path"
    assert r["f"] and r["s"] == '{"a": 1, "d": ["x"]}'
    spans = trees.ocr_spans({"para_blocks": [{"spans": [{"content": "a", "score": 0.5, "bbox": [0, 0, 1, 1]}], "lines": [{"spans": [{"content": "b", "score": 2, "bbox": [0, 0, 1, 1]}, {"content": "c", "score": 1, "bbox": [0, 0, 0, 1]}]}]}], "discarded_blocks": [{"spans": [{"content": "d", "score": 1, "bbox": [0, 0, 2, 1]}]}]})
    assert [s["text"] for s in spans] == ["a", "d"]


def test_tables_in_text(spark):
    cells = list(trees.CsvCells.func().eval('\ufeffa,"b\nc"\n1\n')) if hasattr(trees.CsvCells, "func") else None
    assert cells == [(1, 1, "a"), (1, 2, "b\nc"), (2, 1, "1")]
    html = "<table><tr><th colspan=2>A</th></tr><tr><td rowspan=2>x</td><td>1</td></tr><tr><td>2</td></tr></table>"
    assert [r[2] for r in trees.HtmlCells.func().eval(html, 1)] == ["A", "A", "x", "1", "x", "2"]
    assert list(trees.HtmlCells.func().eval(html + html, 0)) == []
