import pytest

from estatescope.llm.encoding_repair import EncodingRepair, garbled_forms, paired_bytes

CLEAN = ["Gestión económica", "año diseño", "Façade très élevée", "n.º 5 — α ≈ 0,5 y à Paris", "SITUAÇÃO não “dito”", "It’s £20 and 30 €"]


@pytest.mark.parametrize("written,read", [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "cp850")])
def test_every_chain_is_in_the_table(written, read):
    word = "Gestión"
    assert word.encode(written).decode(read) in garbled_forms(word)
    assert word.encode("utf-8").decode("cp1252").encode("utf-8").decode("cp1252") in garbled_forms(word)


def test_finds_and_restores(spark):
    bad = {1: "La GestiÃ³n econÃ³mica", 2: "dise±o del a±o", 3: "FaÃƒÂ§ade trÃƒÂ¨s", 4: "Gesti�n", 5: "un diseño y un aÃ±o", 6: "x 敲楧湯污 y", 14: "Ã³micaz Ã³micaz", 15: "Ã³micaz", 16: "por ú20 y"}
    rows = [(100 + i, t) for i, t in enumerate(CLEAN * 30)] + list(bad.items()) + [(7, "α ≈ 0,5"), (8, None), (9, ""), (10, "Gestión"), (11, "Склад № 5"), (12, "el ú1timo"), (13, "ómicaz")]
    er = EncodingRepair(spark.createDataFrame(rows * 2, "id long, text string"), "id", ("text",))
    found = [r.id for r in er.found().collect()]
    assert sorted(found) == sorted(bad)
    fixed = {r.id: (r.value, r.complete) for r in er.restored().collect()}
    assert fixed[1] == ("La Gestión económica", True) and fixed[2] == ("diseño del año", True) and fixed[3] == ("Façade très", True)
    assert fixed[4] == ("Gestión", True) and fixed[5] == ("un diseño y un año", True) and fixed[6] == ("x regional y", True)


def test_pairs_of_bytes():
    assert paired_bytes("regional".encode().decode("utf-16-le")) == "regional"
    assert paired_bytes("日本語") is None


def test_copies_of_a_garbled_value(spark):
    bad = "El diseño del año según la gestión".encode("cp1252").decode("cp850")
    rows = [(i, f"El diseño del año según la gestión {i}") for i in range(20)] + [(1000 + i, bad) for i in range(200)]
    er = EncodingRepair(spark.createDataFrame(rows, "id long, text string"), "id", ("text",))
    assert sorted(r.id for r in er.found().collect()) == list(range(1000, 1200))
    assert {r.value for r in er.restored().collect()} == {"El diseño del año según la gestión"}


def test_long_words_without_spaces(spark):
    word = "Οδηγίεςσυντήρησης" * 20
    rows = [(1, word), (2, word.encode().decode("latin-1")), (3, word.encode().decode("cp437"))]
    er = EncodingRepair(spark.createDataFrame(rows, "id long, text string"), "id", ("text",))
    assert {r.id: r.value for r in er.restored().collect()} == {2: word, 3: word}


def test_chains_of_garbled_values_lead_to_the_clean_word(spark):
    once = lambda t: t.encode().decode("cp1252")
    word = "diseño"
    rows = [(i, f"{word} {i}") for i in range(5)] + [(10 + i, f"{once(word)} {i}") for i in range(10)]
    rows += [(20, once(once(word))), (21, once(once(once(word)))), (22, word.encode().decode("cp850").encode().decode("mac_roman"))]
    got = {r.id: (r.value.split()[0], r.complete) for r in EncodingRepair(spark.createDataFrame(rows, "id long, text string"), "id", ("text",)).restored().collect()}
    assert got == {i: (word, True) for i in [*range(10, 20), 20, 21, 22]}


def test_share_restored_of_values_garbled_on_purpose(spark):
    import random

    rng = random.Random(5)
    words = "gestión económica año diseño façade élevée situação público módulo tubería señal garantía número época détaillé travaux reçu coração".split()
    texts = [" ".join(rng.sample(words, 6)) + f" {i}" for i in range(400)]
    steps = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("iso8859-15", "mac_roman")]
    bad = []
    for i in range(120):
        text = t = texts[i % 400] + " x"
        for written, read in ([steps[i % len(steps)]] if i % 3 else [steps[i % 5], steps[(i + 1) % 5]]):
            t = t.encode(written).decode(read, "replace")
        if "\ufffd" not in t:
            bad.append((1000 + i, t, text))
    er = EncodingRepair(spark.createDataFrame([*enumerate(texts), *[(i, t) for i, t, _ in bad]], "id long, text string"), "id", ("text",))
    got = {r.id: r.value for r in er.restored().collect()}
    assert len(bad) > 90 and set(got) == {i for i, _, _ in bad}
    assert sum(got[i] == was for i, _, was in bad) == len(bad)


def test_tables_by_character_agree_with_whole_words():
    for word in ("Gestión", "élevée", "Ελλάδα", "Склад"):
        forms = garbled_forms(word)
        for read in ("cp1252", "cp850", "mac_roman"):
            try:
                assert word.encode().decode(read) in forms
            except UnicodeDecodeError:
                pass
    assert "diseño".encode().decode("gbk", "ignore") in garbled_forms("diseño")
    assert "Склад".encode("cp1251").decode("cp1252") in garbled_forms("Склад")
