import unicodedata

from quire.llm import lookalikes
from quire.llm.lookalikes import alike, alike_pairs, one_form

LATIN = "The Pope copies six Åse’s café notes: ½ file, m², № 5, H2O"


def test_forms_of_one_look_are_equal():
    look = str.maketrans("aceopxyisTHMOPE", "асеорхуіѕТНМОРЕ")
    same = [
        LATIN, unicodedata.normalize("NFD", LATIN), LATIN.translate(look), LATIN.replace(" ", "\xa0"), LATIN.replace("o", "ο"), "﻿" + "​".join(LATIN), LATIN.replace("fi", "ﬁ"),
        "".join(chr(ord(c) + 0xFEE0) if "!" < c < "~" else c for c in LATIN),
    ]
    assert {one_form(t) for t in same} == {one_form(LATIN)}
    assert one_form("⽔量ｹﾞｰﾄ年") == "水量ゲート年"


def test_real_differences_stay():
    for other in (LATIN.replace("é", "e"), LATIN.replace("²", "2"), LATIN.replace("The", "the"), LATIN.replace("5", "6"), LATIN.replace(": ", ":  "), LATIN.replace(" notes", "\nnotes")):
        assert one_form(other) != one_form(LATIN)


def test_scripts_are_chosen_by_token_and_neighbours():
    assert one_form("Состояние сети и а о") == "Состояние сети и а о"
    assert one_form("Cостояние cети") == "Состояние сети"
    assert one_form("а сору of раре") == "a copy of pape"
    assert one_form("Α α Ω") == "Α α Ω"
    assert one_form(None) is None and one_form("") == ""


def test_pairs(spark):
    rows = [
        ("t", "a", 1, "café one"), ("t", "b", 2, "café one"), ("t", "c", 3, "cafe one"), ("t", "b", 2, "café one"), ("t", "a", 9, "cafе́ one"), ("u", "d", 1, "café one"), ("t", "e", 1, None), ("t", "f", 1, ""), ("t", "g", 1, "​"),
        ("t", "h", 1, " "), ("t", None, 1, "café\xa0one"), *[("t", f"x{i}", 1, "same text") for i in range(40)], ("t", "y", 1, "same\xa0text"),
    ]
    df = spark.createDataFrame([(*r, "k", "z") for r in rows], "tab STRING, document_id STRING, page_number INT, text STRING, form STRING, stored STRING")
    got = {tuple(r) for r in alike_pairs(df).collect()}
    assert got == {("t", "a", 1, "b", 2), ("t", "a", 9, "b", 2)} | {("t", f"x{i}", 1, "y", 1) for i in range(40)}
    assert alike_pairs(df.limit(0)).count() == 0


def test_letters_of_every_script_are_resolved():
    for script in ("CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU", "COPTIC"):
        letters, latin = getattr(lookalikes, script)
        assert len(letters) == len(latin)
        kept = [(c, x) for c, x in zip(letters, latin) if one_form(f"word{c}s next") != one_form(f"word{x}s next")]
        assert not kept, (script, kept)
    for strange, plain in (("𝐀𝐁𝐂", "ABC"), ("ℋello", "Hello"), ("Ꭺpple", "Apple"), ("օrange", "orange"), ("ⅼine", "line"), ("ɑlpha", "alpha"), ("ꓮpple pie", "Apple pie")):
        assert one_form(strange) == plain
    assert one_form("Բարև Ձեզ") == "Բարև Ձեզ"  # a token of one script stays
    assert one_form("m² x₂ № 5 ½") == "m² x₂ № 5 ½"


def test_copies_of_one_spelling_never_meet(spark):
    rows = [("t", f"d{i:05d}", 1, "same text") for i in range(20_000)] + [("t", "odd", 1, "same\xa0text"), ("t", "odd", 2, "same  text")]
    df = spark.createDataFrame(rows, "tab STRING, document_id STRING, page_number INT, text STRING")
    assert alike_pairs(df).count() == 20_000
    classes, members = alike(df)
    assert sorted(r["records"] for r in classes.collect()) == [1, 20_000] and members.count() == 20_001
