import pytest

from quire.llm import scans

SCHEMA = "tab STRING, document_id STRING, page_number INT, part_no INT, label STRING, text STRING, kind STRING, shape STRING"
BODY = "The turbine hall required a second inspection before the annual handover, so that the well-known depot lists the readings.\nThe monitoring well met every requirement, with a mean of 12.5 mm."
CHINESE = "检修台账仍处于长期控制范围内，余量为毫米。采样队未出现可测的漂移。"


def rows():
    out = []
    for d in range(60):
        for p in range(1, 4):
            out.append(("native_text_pages", f"d{d}", p, 0, None, f"Report on basin {'ABCDEFGH'[d % 8]}x{d}\n{BODY}\n{CHINESE}\n— {p} —"))
    return out


def special():
    return [
        ("native_text_pages", "s", 1, 0, None, "Own Title\nThe turbine hall required a second inspec-\ntion before the annual handover, with the well-\nknown depot lists the rcadings and 1S.5 mm.\n检修台账仍处于长期控制范围内\nPage 1 of 2"),
        ("native_text_pages", "s", 2, 0, None, "Own Title\nThe monitoring wcll met every requirement\nVorbraush Works · TW-4438    2"),
        ("parsed_documents", "s", 0, 0, None, "# Own Title\n\nThe annual handover\n\nVORBRAUSH WORKS\n\n2\n\nOwn Title\n\n## 1 Method"),
        ("run_pages", "s", 1, 1, "doc_title", "Own Title"), ("run_pages", "s", 2, 1, "header", "Own Title"), ("run_pages", "s", 2, 2, "number", "— 2 —"), ("run_pages", "s", 2, 3, "text", "The annual hand¬\nover"),
        ("run_pages", "s", 3, 1, "text", None), ("native_text_pages", "s", 3, 0, None, ""), ("native_text_pages", None, 3, 0, None, "x"),
    ]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "k", "s") for r in [*rows(), *special(), *special()[2:3]]], SCHEMA)


def test_found(frame):
    got = {tuple(r) for r in scans.found(frame, ["Vorbraush Works"]).where("document_id = 's'").collect()}
    n, p, r = "native_text_pages", "parsed_documents", "run_pages"
    assert got == {
        (n, "s", 1, 0, 2, "hyphen"), (n, "s", 1, 0, 4, "misread"), (n, "s", 1, 0, 6, "furniture"), (n, "s", 2, 0, 1, "furniture"), (n, "s", 2, 0, 2, "misread"), (n, "s", 2, 0, 3, "furniture"),
        (p, "s", 0, 0, 5, "furniture"), (p, "s", 0, 0, 7, "furniture"), (p, "s", 0, 0, 9, "furniture"), (r, "s", 2, 1, 1, "furniture"), (r, "s", 2, 2, 1, "furniture"), (r, "s", 2, 3, 1, "hyphen"),
    }


def test_repaired(frame):
    got = {(r["tab"], r["page_number"], r["part_no"]): r["text"] for r in scans.repaired(frame, ["Vorbraush Works"]).where("document_id = 's'").collect()}
    assert got["native_text_pages", 1, 0].startswith("Own Title\nThe turbine hall required a second inspection before the annual handover, with the well-known depot lists the readings and 15.5 mm.")
    assert "Page" not in got["native_text_pages", 1, 0] and got["native_text_pages", 2, 0] == "The monitoring well met every requirement"
    assert got["run_pages", 2, 3] == "The annual handover" and got["run_pages", 3, 1] is None


def test_empty(frame):
    assert scans.found(frame.limit(0), []).count() == 0


def test_page_numbers():
    for t in ("Page 12345", "Blatt 3", "ページ 3", "Seite 3 von 10 Seiten", "第 12345 页", "3", "— 12 —", "- 4 -", "· 7 ·", "| 9", "2 / 14", "3 / 9 ページ", "第 5 页 共 13 页", "Page 1 of 4", "Seite 2 von 8", "Página 3 de 9", "Pagina 3 di 9", "Стр. 2 из 7", "xiv", "lxxviii", "第5页共13页"):
        assert scans.is_page_number(t), t
    for t in ("", "Results 3", "12.5 mm", "Summary", "Table 3", "vivid", "2 Background", "12,5"):
        assert not scans.is_page_number(t), t


def test_confused_characters_are_learned_from_settled_contexts(spark):
    text = CHINESE + "进水泵组未满足合同的要求。"
    texts = [text] * 200 + [text.replace("未", "末")] + [text.replace("检", "俭")]
    found, _, _ = scans.confusions(scans.count_grams(spark.createDataFrame([(t,) for t in texts], "text STRING")), 0)
    assert found["末"][0][0] == "未"


def test_characters_that_are_mostly_right_are_read_at_line_ends_and_in_known_triples():
    """A misread character is found wherever it stands in the line, and also where the misread triple is itself in the table."""
    right, wrong = "采样队未出现可测的漂移", "采样队末出现可测的漂移"
    triples = {t: 5000 for t in map("".join, zip(right, right[1:], right[2:]))}
    triples |= {t: 5 for t in map("".join, zip(wrong, wrong[1:], wrong[2:])) if "末" in t}  # known: damaged often enough
    reader = scans.Reader({"w": {}, "p": {}, "h": {}, "t": triples, "totals": {"t": 10**6}, "confusions": {"末": [("未", 3.0)]}, "common": {"末"}})
    for text in (wrong, "采样队末\n出现可测的漂移", "采样队\n末出现可测的漂移", "采样队\n末\n出现可测的漂移", "采 样 队\n末 出现可测的漂移"):
        lines, _, misread = reader.read(text)
        assert "\n".join(lines) == text.replace("末", "未") and misread == {text[: text.index("末")].count("\n")}
    for text in (right, "年末", "末", "采样队�\n末", "12末\n34"):
        assert not reader.read(text)[2]


LONG_TITLES = [
    "Report on the long term control of the settling basins and of the monitoring wells in the eastern district of the river",
    "Отчёт о долговременном контроле отстойников и наблюдательных скважин восточного района",
    "关于东部地区沉淀池与监测井在长期控制范围内运行情况以及相关检修台账核对结果的年度综合报告",
]


@pytest.mark.parametrize("title", LONG_TITLES)
def test_running_titles_of_any_length_are_furniture(spark, title):
    pages = [("native_text_pages", "t", p, 0, None, f"{title}\n{BODY}\n{BODY}\n{title}        {p}") for p in (1, 2, 3)]
    pages += [("native_text_pages", "o", 1, 0, None, f"Other\n{BODY}"), ("native_text_pages", "o", 2, 0, None, f"{title}\n{BODY}\n{BODY}")]  # not its own title
    pages += [("parsed_documents", "t", 0, 0, None, f"# {title}\n\n{BODY}\n\n{title}\n\n{BODY}"), ("run_pages", "t", 2, 1, "header", title)]
    frame = spark.createDataFrame([(*r, "k", "s") for r in pages], SCHEMA)
    got = {(r["document_id"], r["tab"][:1], r["page_number"], r["line_no"]) for r in scans.found(frame, []).where("kind = 'furniture'").collect()}
    assert got == {*(("t", "n", p, i) for p in (1, 2, 3) for i in (1, 6) if (p, i) != (1, 1)), ("t", "p", 0, 6), ("t", "r", 2, 1)}


def test_headers_of_one_document_are_found_in_a_large_corpus(spark, monkeypatch):
    monkeypatch.setattr(scans, "HEADER_SHARE", 0.5)  # as in a corpus where a header must stand on more pages than the document has
    pages = [("native_text_pages", "own", p, 0, None, f"Title\n{BODY}\n{BODY}\nSection of the wells") for p in range(1, 9)]
    pages += [("native_text_pages", f"d{d}", 1, 0, None, f"Title {d}\n{BODY}\n{BODY}\nClosing words {'abcdefgh'[d]}") for d in range(8)]
    frame = spark.createDataFrame([(*r, "k", "s") for r in pages], SCHEMA)
    got = {(r["document_id"], r["page_number"], r["line_no"]) for r in scans.found(frame, []).where("kind = 'furniture' AND line_no > 1").collect()}
    assert got == {("own", p, 6) for p in range(1, 9)}


def test_the_channel_is_learned_from_rare_and_frequent_words(spark):
    words = ["inspection", "turbine", "requirement", "monitoring", "containment", "reading", "annual", "depot", "second", "handover"]
    texts = [" ".join(words)] * 200 + [w.replace("e", "c", 1) for w in words for _ in range(2)] + [w.replace("n", "ri", 1) for w in words for _ in range(2)]
    grams = scans.count_grams(spark.createDataFrame([(t,) for t in texts], "text STRING"))
    learned = scans.channel(grams, 2)
    assert "e" in [r for r, _ in learned["c"]] and "n" in [r for r, _ in learned["ri"]]


def test_confusions_the_corpus_does_not_show_are_read_by_frequency_and_neighbours():
    made = {"w": {"the": 9000, "pump": 3000, "station": 5000, "was": 8000, "closed": 2000, "необычных": 900}, "p": {"the station": 2500, "station was": 2000, "pump station": 900}, "h": {}, "t": {},
            "totals": {"w": 10**5}, "confusions": {}, "common": set(), "channel": {}}
    reader = scans.Reader(made)
    for wrong, right in (("the stahion was closed", "the station was closed"), ("the statlon was", "the station was"), ("нео6ычных", "необычных"), ("the stati0n was", "the station was")):
        lines, _, misread = reader.read(wrong)
        assert lines == [right] and misread == {0}, wrong
    for right in ("the station was closed by Drabelenne", "the stÃ¤tion", "the pumps"):  # a name, damage of another kind, another form of the word
        assert not reader.read(right)[2]


def test_neighbouring_characters_are_read_together():
    right, wrong = "采样队未出现可测的漂移", "采样队末岀现可测的漂移"
    triples = {t: 5000 for t in map("".join, zip(right, right[1:], right[2:]))}
    reader = scans.Reader({"w": {}, "p": {}, "h": {}, "t": triples, "totals": {"t": 10**6}, "confusions": {"末": [("未", 3.0)], "岀": [("出", 3.0)]}, "common": set()})
    assert reader.read(wrong)[0] == [right]


def test_a_character_in_an_unknown_place_of_a_known_context_is_read():
    right, wrong = "采样队土出现可测的漂移", "采样队士出现可测的漂移"
    triples = {t: 5000 for t in map("".join, zip(right, right[1:], right[2:]))}
    reader = scans.Reader({"w": {}, "p": {}, "h": {}, "t": triples, "totals": {"t": 10**6}, "confusions": {}, "common": set(), "usual": {"队出": "土"}})
    assert reader.read(wrong)[0] == [right] and reader.read(right)[2] == set()
