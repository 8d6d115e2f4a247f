from estatescope.llm import scan_text as s
from estatescope.llm.confusions import Confusions
from estatescope.llm.scan_repair import ScanRepair


def test_misreadings_share_a_key():
    c = Confusions.of({})
    pairs = (("rcviscd", "revised"), ("cornpany", "company"), ("inclex", "index"), ("t0tal", "total"), ("m@yor", "mayor"), ("máqiiina", "máquina"), ("arnbierita1es", "ambientales"))
    for seen, printed in (*pairs, ("rnunicipal" * 9 + "c0rn" * 5, "municipal" * 9 + "com" * 5)):
        assert c.key(seen) == c.key(printed)
        p, how = c.channel(seen, printed)
        assert p < 0 and all(pair in c.chance for pair in how)
    assert c.channel("casa", "cosa") is None and c.channel("total", "t0tal") is None


def test_learnt_confusions_stay_consistent():
    c = Confusions.of({("q", "g"): 40, ("nn", "m"): 30, ("c", "e"): 99})
    assert ("q", "g") in c.chance and c.key("re9istra") == c.key("reqistra") == c.key("registra")
    # m is r and n already
    assert ("nn", "m") not in c.chance


def test_codes_are_words_of_their_own(spark):
    for copies in (1, 10):
        rows = [(i, f"El informe mensual del contrato {i} sobre ipv6 y sha1sum con H2O {'abcdefghij'[i % 10] * 4} aprueba la red") for i in range(300 * copies)]
        bad = {100_000: "El inforrne mensual del contrato", 100_001: "obra de Ne1tor", 100_002: "El c0ntrato aprueba la red"}
        got = {r.id: r.text for r in ScanRepair(spark.createDataFrame([*rows, *bad.items()], "id long, text_excerpt string")).repaired().collect()}
        assert got == {100_000: "El informe mensual del contrato", 100_001: "obra de Neltor", 100_002: "El contrato aprueba la red"}
    same = [(i, "El informe mensual sobre ipv6 y sha1sum con H2O del proyecto") for i in range(300)]
    assert ScanRepair(spark.createDataFrame(same, "id long, text_excerpt string")).found().isEmpty()


def test_words_of_any_length_and_cut_words(spark):
    rows = [(i, f"lo que dice {a * 3}{b * 3} según la inspección obligatoria del contratista responsable") for i, (a, b) in enumerate((a, b) for a in "abdfg" for b in "kmprstvwxz")]
    bad = {900: "lo quc dice según el contratista", 901: "según la inspec-\nclón obligatoria\ny más", 902: "según la irispeccióri ob1ig@t0ri@ hoy"}
    got = {r.id: r.text for r in ScanRepair(spark.createDataFrame([*rows, *bad.items()], "id long, text_excerpt string")).repaired().collect()}
    assert got == {900: "lo que dice según el contratista", 901: "según la inspección obligatoria y más", 902: "según la inspección obligatoria hoy"}


def test_decisions_are_made_place_by_place(spark):
    rows = [(i, f"el mar de {a * 4} y la casa de {b * 4} queda lejos") for i, (a, b) in enumerate((a, b) for a in "abdfghjk" for b in "klmprstv")]
    bad = (900, "el rnar de todos\ncódigo rnar, 5")
    got = ScanRepair(spark.createDataFrame([*rows, bad], "id long, text_excerpt string")).repaired().first()
    assert got.id == 900 and got.text.startswith("el mar de todos")


def test_page_numbers():
    text = ["uno", "dos", "Página 3 de 9", "TITULO DEL TEXTO", "tres", "84", "cuatro", "85", "cinco", "xiv", "seis"]
    assert s.page_lines(text) == [2, 5, 7, 9] and s.header_lines(text, [2, 5, 7, 9]) == [3]
    assert s.page_lines(["- 3 -", "uno", "dos", "- 4 -"]) == []
    assert s.page_lines(["uno", "3", "dos"]) == [] and s.page_lines(["total", "12.345,00", "x"]) == []


def test_cut_words_and_repair():
    assert s.cut_words("mens-\nual y co¬\nste") == 2 and s.cut_words("rango 10-\n20\n- punto") == 0
    text = "La obra mens-\nual sigue\n— 7 —\nNOMBRE DEL INFORME\nsin coste.\n\nOtro párrafo"
    assert s.repair(text, {(0, 1): "Obra"}) == "La Obra mensual sigue sin coste.\n\nOtro párrafo"


def test_operator(spark):
    clean = "El informe mensual del contrato especial aprueba la inspección general de la obra"
    bad = {1: "El inforrne mensual del contrato", 2: "El informe men-\nsual", 3: "El informe\nPágina 2 de 5\nmensual", 4: "El c0ntrato especlal aprueba", 5: "obra de Ne1tor"}
    good = {6: clean, 7: "", 8: None, 9: "El informe\nmensual", 10: "1. El informe\n2. La obra\n10.250,00", 11: "código AB12-5 del contrato"}
    rows = [(100 + i, clean) for i in range(200)] + [*bad.items(), *good.items()]
    sr = ScanRepair(spark.createDataFrame(rows * 2, "id long, text_excerpt string"))
    got = sr.repaired().collect()
    assert sorted(r.id for r in got) == sorted(bad)
    text = {r.id: r.text for r in got}
    assert text[1] == "El informe mensual del contrato" and text[2] == "El informe mensual" and text[3] == "El informe mensual"
    assert text[4] == "El contrato especial aprueba" and text[5] == "obra de Neltor"


def test_copies_of_a_misread_text(spark):
    clean = "El informe mensual del contrato especial aprueba la inspección general de la obra"
    rows = [(i, f"{clean} {'abcdefghij'[i % 10] * 5}{'klmnopqrst'[i // 10 % 10] * 5}") for i in range(100)]
    copies = [(1000 + i, "El inforrne mensual del contrato cspecial") for i in range(300)]
    repeated = [(2000, "el inforrne mensual " * 40)]
    got = {r.id: r.text for r in ScanRepair(spark.createDataFrame(rows + copies + repeated, "id long, text_excerpt string")).repaired().collect()}
    assert sorted(got) == [*range(1000, 1300), 2000]
    assert got[1000] == "El informe mensual del contrato especial" and "rrn" not in got[2000]


def test_lone_page_number_and_header(spark):
    page = "La tubería queda abierta\nantes del cierre.\n3\nSegún el catálogo revisado sigue."
    wrong = "La tubería queda\nù 12 ù\nabierta hasta hoy"
    header = "la obra queda abierta hasta el\nINFORME DE LA OBRA\ncierre de la misma partida."
    feed = "La obra queda abierta.\n\fInforme anual\nSegún el catálogo."
    no = ["Factura nueva\nDRAFT 2\n5\nFecha: 2013-02-17 nueva", "obra final Kofrata 32 8.801,29 21,63\n52\nobra parcial Bazu 10 430,35", "La obra queda en el año\n2019\nsegún el catálogo revisado",
        "- punto de la obra.\n2\n- Otro punto de la obra.", "La obra termina.\nINFORME DE LA OBRA\nSegún el catálogo.", "el valor de la t·nel\nt·nel central 28\nobra"]
    assert s.page_lines(["uno", "P\ufffdgina 64 de 104", "dos"]) == [1]
    rows = [(1, page), (2, wrong), (3, header), (4, feed), *enumerate(no, 10)]
    got = {r.id: r for r in ScanRepair(spark.createDataFrame(rows, "id long, text_excerpt string")).repaired().collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[3].text == "la obra queda abierta hasta el cierre de la misma partida." and "\n3\n" not in got[1].text
