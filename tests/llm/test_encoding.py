import pytest

from quire.llm import encoding

CLEAN = [
    "Das Feldlabor überschritt den Grenzwert für Wäsche größer als 5 °C, während die Prüfung läuft.", "La sala de control volvió al funcionamiento según el período de calefacción, ± 3 µg/L.",
    "L’équipe a nécessité une vérification du dépôt intermédiaire à la demande.", "在计划停机之后，审核小组提交了修订后的数据；覆盖场地平方米。", "Насос подачи пока хранит показания согласно подписанному протоколу.",
    "計画停止のあとで、排水路は運用から外された。", "The form uses £ and € signs, marked SÃO VIDRAL – Nº 7.",
]


@pytest.fixture(scope="module")
def restorer():
    counts: dict = {}
    for t in CLEAN * 50:
        for token in t.split():
            for u in encoding.units(token):
                counts[u] = counts.get(u, 0) + 1
    return encoding.Restorer(encoding.costs_of(counts, sum(counts.values())))


@pytest.mark.parametrize("text", CLEAN[:6])
@pytest.mark.parametrize("read_as", ["latin-1", "cp1251", "cp437", "mac_roman", "koi8-r"])
def test_utf8_read_otherwise_is_restored(restorer, text, read_as):
    try:
        damaged = text.encode().decode(read_as)
    except UnicodeDecodeError:
        pytest.skip("these bytes have no character there")
    assert restorer.restore(damaged) == (text, 1)


def test_twice_and_other_encodings(restorer):
    twice = CLEAN[1].encode().decode("latin-1").encode().decode("latin-1")
    assert restorer.restore(twice)[0] == CLEAN[1]
    assert restorer.restore(CLEAN[4].encode("cp1251").decode("latin-1"))[0] == CLEAN[4]
    assert restorer.restore(CLEAN[3].encode("gbk").decode("big5", "replace"))[1] == 1
    assert restorer.restore(CLEAN[2].encode("cp1252").decode("mac_roman"))[0] == CLEAN[2]


def test_lost_bytes_become_likely_characters(restorer):
    damaged = CLEAN[3].encode().decode("cp1252", "replace")
    text, n = restorer.restore(damaged)
    assert n == 1 and sum(a == b for a, b in zip(text, CLEAN[3])) > 0.8 * len(CLEAN[3])


def test_clean_texts_are_no_case(restorer):
    for t in [*CLEAN, "", "plain", "billed in £ and €.", "mit Ð, Þ und ß", "Сhесk with lookalikes"]:
        assert not restorer.damaged(t), t
    assert not restorer.damaged(None) and restorer.restore(None) == (None, 0)


def test_found(spark):
    rows = [("n", f"d{i}", i, t) for i, t in enumerate(CLEAN * 8)] + [("n", "bad", 1, "x\n" + CLEAN[0].encode().decode("latin-1")), ("n", "bad", 1, "x\n" + CLEAN[0].encode().decode("latin-1")), ("n", "lost", 2, "gr��t"), ("n", "null", 1, None), ("n", None, None, "")]
    df = spark.createDataFrame([(*r, "u") for r in rows], "tab STRING, document_id STRING, page_number INT, text STRING, unit STRING")
    assert {tuple(r) for r in encoding.found(df).collect()} == {("n", "bad", 1), ("n", "lost", 2)}
    back = {r["document_id"]: (r["restored"], r["damaged_lines"]) for r in encoding.restored(df).collect()}
    assert back["bad"] == ("x\n" + CLEAN[0], 1) and back["null"] == (None, 0)
    assert encoding.found(df.limit(0)).count() == 0


def _restorer_of(texts):
    counts: dict = {}
    for t in texts:
        for token in t.split():
            for u in [*encoding._ASCII_WORD.findall(token), *encoding.units(token)]:
                counts[u] = counts.get(u, 0) + 1
    return encoding.Restorer(encoding.costs_of(counts, sum(counts.values())))


def test_lost_bytes_of_alphabets_are_read_by_whole_words():
    r = _restorer_of([*CLEAN * 50, "Le débit relevé, the operator’s findings at s, reste ± 3 m²."] * 50)
    for text in ("Le débit relevé reste.", "Débit RELEVÉ", "the operator’s findings", "L’équipe a nécessité"):
        lost = text.encode("cp1252").decode("utf-8", "replace")
        assert encoding.LOST in lost and r.restore(lost) == (text, 1)
    for lost in ("comiss�o", "����1.67��", "�� �", "zzz� kept", "\U000f0000 \U00100001�"):  # no known word fits
        assert r.restore(lost) == (lost, 1)
    assert r.restore("Le débit relevé à".encode().decode("latin-1").replace("\xa9", "�", 1))[0].startswith("Le débit relevé")


def test_words_are_counted_in_ascii_too(spark):
    df = spark.createDataFrame([("the operator’s café",), ("the pump",), (None,)], "text STRING")
    got = {r["unit"]: r["n"] for r in encoding.count_units(df).collect()}
    assert got == {"the": 2, "operator": 1, "s": 1, "pump": 1, "a’a": 1, "café": 1}


def test_a_rarer_character_is_read_by_its_neighbours():
    """Of characters that share the bytes left, any known one is a candidate, however many are more frequent."""
    usual = [chr(o) for o in range(0x6D40, 0x6D7F) if chr(o) != "浦"]
    r = _restorer_of([f"{c}甲{c}乙" for c in usual] * 50 + ["青浦区的记录已提交审核小组。"] * 3)
    text = "青浦区的记录已提交审核小组。"
    data: list = list(text.encode())
    data[5] = None  # the last byte of the second character
    assert r.read(data, "utf-8") == (text, 0.0)
    damaged = "".join("�" if x is None else bytes([x]).decode("latin-1") for x in data)
    assert r.restore(damaged) == (text, 1)


HAN = "检修台账仍处于长期控制范围内，审核小组提交了修订后的数据"


@pytest.fixture(scope="module")
def words():
    return _restorer_of([*CLEAN * 50, f"{HAN}。", "Le débit relevé reste.", "Насос подачи пока хранит показания согласно подписанному протоколу."] * 50)


@pytest.mark.parametrize(("right", "damaged", "whole"), [
    ("Das Feldlabor überschritt den ", "Grenzwert für Wäsche".encode().decode("cp1252"), "Grenzwert für Wäsche"),
    (f"{HAN} ", "Die Prüfung für Wäsche".encode().decode("cp1252"), "Die Prüfung für Wäsche"),
    ("Насос подачи пока ", "хранит показания".encode("cp1251").decode("latin-1"), "хранит показания"),
    (HAN[:12], HAN[12:].encode().decode("latin-1"), HAN[12:]),
    ("L’équipe a nécessité ", "vérification du dépôt".encode("cp1252").decode("cp437"), "vérification du dépôt"),
])
def test_spans_are_restored_and_the_rest_is_kept(words, right, damaged, whole):
    assert words.restore(right + damaged) == (right + whole, 1)


@pytest.mark.parametrize(("encoding_", "decoder"), [("iso8859-5", "latin-1"), ("mac_cyrillic", "cp1251"), ("koi8-r", "cp866")])
def test_more_encodings(words, encoding_, decoder):
    assert words.restore(CLEAN[4].encode(encoding_).decode(decoder)) == (CLEAN[4], 1)


def test_no_right_letter_changes_beside_damage(words):
    """What stands outside the damaged span is kept, whatever the damage."""
    for right in ("Wäsche größer als 5 °C", "période de calefacción", HAN[:14]):
        for bad in ("f�r", "PrÃ�fung", "PrÃ¼fung", "ïîêàçàíèÿ"):
            assert words.restore(f"{right} {bad}")[0].startswith(f"{right} ")


def test_damage_that_fills_the_corpus_is_no_evidence():
    """Words of a damaged source that make up a third of all rows are not what texts are written with."""
    damaged = [CLEAN[4].encode("cp1251").decode("latin-1"), CLEAN[1].encode().decode("latin-1")]
    counts: dict = {}
    for t in [*CLEAN * 20, *damaged * 30]:
        for token in t.split():
            for u in encoding.counted(token):
                counts[u] = counts.get(u, 0) + 1
    r = encoding.Restorer(encoding.without_misreadings(encoding.costs_of(counts, sum(counts.values()))))
    assert r.restore(damaged[0]) == (CLEAN[4], 1) and r.restore(damaged[1]) == (CLEAN[1], 1)


def test_many_lost_letters_take_bounded_work(words):
    text = "�".join("abcdefgh" * 40)
    assert words.restore(text)[1] == 1


def test_any_line_of_odd_characters_is_read(words):
    """No mixture of scripts, signs and lost characters makes the search fail, and clean text beside it stays."""
    import random

    rng = random.Random(4)
    pool = "aé…±“”。，：检修台账äøÃ©ïîêàçФЖ℃�\x85\xa0\x81🙂́ｶ가ﬁ 12"
    for _ in range(400):
        line = "".join(rng.choices(pool, k=rng.randint(1, 40)))
        text, n = words.restore(line)
        assert isinstance(text, str) and n in (0, 1)
