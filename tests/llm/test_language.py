import pandas as pd
import pytest

from quire.llm import language


@pytest.fixture(scope="module")
def samples(data):
    s = pd.read_parquet(f"{data}/language_samples.parquet")
    return list(zip(s.lang, s.text))


def test_held_out_accuracy(samples):
    train = [x for i, x in enumerate(samples) if i % 3]
    held = [x for i, x in enumerate(samples) if i % 3 == 0]
    model = language.Model(train)
    right = [model.languages[s.argmax()] == lang for (s, _), (lang, _) in zip(model.classify([t for _, t in held]), held)]
    assert sum(right) / len(right) > 0.98


def test_weights_equal_the_kernel_machine(samples):
    """The collapsed weights give what landmarks, whitening and ridge regression give one after the other."""
    import numpy as np

    model = language.Model(samples)
    score, known = model.scores([samples[0][1]])
    again, _ = model.scores([samples[0][1] * 2])
    assert np.allclose(score, again, atol=0.05) and known[0] > 0  # presence, not frequency


def test_labels():
    for label, want in (("zh-CN", "zh"), ("EN", "en"), ("deu", "de"), ("Chinese", "zh"), ("pt_BR", "pt"), ("", None), (None, None), ("und", None), ("xx", None), ("English (UK)", "en"), ("  fr ", "fr")):
        assert language.label_language(label) == want, label


def test_found(spark, samples):
    by: dict = {}
    for lang, t in samples:
        by.setdefault(lang, []).append(t)
    body = lambda lang, n=4: "\n\n".join(by[lang][:n])
    rows = [
        ("ok", "en-GB", body("en")), ("none", None, body("de")), ("wrong", "fr", body("ru")), ("mixed", "English", body("en") + "\n\n" + by["fr"][5] + "\n\n1\n\n# Q_{1} = 2"), ("mixed", "English", body("en") + "\n\n" + by["fr"][5] + "\n\n1\n\n# Q_{1} = 2"),
        ("null", "en", None), ("blank", None, " \n\n "), ("numbers", None, "12\n\n34"), ("garbled", "zh", body("zh").encode().decode("latin-1")),
    ]
    contracts = spark.createDataFrame([(*r, "en") for r in rows] * 1, "document_id STRING, label STRING, text STRING, lang STRING")
    table = spark.createDataFrame(samples, "lang STRING, text STRING")
    assert {tuple(r) for r in language.found(contracts, table).collect()} == {("none", 0, "de"), ("wrong", 0, "ru"), ("mixed", 5, "fr")}
    assert language.found(contracts.limit(0), table).count() == 0
    assert language.paragraphs(contracts, table.limit(0)).where("lang IS NOT NULL").count() == 0
    confidence = [r["confidence"] for r in language.paragraphs(contracts, table).where("lang IS NOT NULL").collect()]
    assert all(0 <= c <= 1 for c in confidence)


def test_long_paragraphs_count_as_short_ones_do(samples):
    by: dict = {}
    for lang, t in samples:
        by.setdefault(lang, []).append(t.replace("\n", " "))
    model = language.Model(samples)
    restorer = language.encoding.Restorer({})

    def long(lang, letters=50_000):
        text = " ".join(by[lang])
        return text * (letters // language._letters(text) + 1)

    for lang in sorted(by):
        other = "fr" if lang != "fr" else "ru"
        alone, mixed, within = language.languages_of([long(lang), long(lang) + "\n\n" + by[other][0] + "\n\n" + by[other][1], "\n\n".join([*by[other][:4] * 200, long(lang, 5_000)])], model, restorer)
        assert [x for x, _ in alone] == [lang, lang]
        assert [x for x, _ in mixed] == [lang, lang, other, other]
        assert (within[0][0], within[-1][0]) == (other, lang)


def test_a_model_is_the_same_after_being_sent(spark):
    import pickle

    import numpy as np

    from quire.llm.language import Model

    samples = [("en", "the pump was closed and the station was read"), ("de", "die Pumpe wurde geschlossen und die Anlage abgelesen"), ("en", "and the other station was open"), ("de", "und die andere Anlage war offen")]
    model = Model(samples)
    sent = pickle.loads(pickle.dumps(model))
    texts = ["the station", "die Anlage", "", "xyz"]
    assert all(np.allclose(a, b) for a, b in zip(model.scores(texts), sent.scores(texts)))


def test_ngrams_that_meet_in_a_slot_are_kept(monkeypatch):
    import numpy as np

    from quire.llm import language

    samples = [("en", "the pump was closed and the station was read"), ("de", "die Pumpe wurde geschlossen und die Anlage abgelesen"), ("en", "and the other station was open"), ("de", "und die andere Anlage war offen")]
    texts = ["the station was", "die Anlage wurde", "x"]
    wide = language.Model(samples).scores(texts)
    monkeypatch.setattr(language, "_SLOTS", 4)
    assert all(np.allclose(a, b) for a, b in zip(wide, language.Model(samples).scores(texts)))
