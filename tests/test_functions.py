"""Column functions against fixed examples."""

from pyspark.sql import functions as F

from estatescope.functions import cleaning, identifiers, paths


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_extension(spark):
    names = ["a.PDF", ".bashrc", "a.tar.gz", "a.", ".a.b", "plain", "..x", "é.Ñx"]
    assert values(spark, paths.extension, names) == [".pdf", "", ".gz", ".", ".b", "", "", ".ñx"]
    assert values(spark, paths.extension_of_path, ["/a/b.pdf", "/a/b", ".x"]) == ["pdf", "", ""]
    assert values(spark, paths.last_dot_part, ["/a/b.PDF", "abc"]) == ["pdf", "abc"]


def test_paths(spark):
    assert values(spark, lambda c: paths.path_depth(c, 1), ["/data/a/b.txt", "/data"]) == [2, 0]
    df = spark.createDataFrame([("/data/2012/P/a/b/c.txt",)], "x string")
    assert list(df.select(*paths.directory_levels(F.col("x"), 1, 3)).first()) == ["data", "2012", "P"]
    assert values(spark, paths.path_parent, ["/a/b", "/a", "x"]) == ["/a", None, None]
    norm = lambda c: paths.normalize_path(c, "/base", {"HOME": "/home/u", "X": "q"})
    assert values(spark, norm, [" /a/../b ", "c//d", "~/e", "$X/f", "", None]) == ["/b", "/base/c/d", "/home/u/e", "/base/q/f", "", ""]
    assert values(spark, paths.nfc, ["ñ", None]) == ["ñ", None]
    assert values(spark, paths.epoch_year, [0, 1672531200], "long") == [1970, 2023]


def test_cleaning(spark):
    assert values(spark, cleaning.safe_str, ["\t a \n", "", None]) == ["a", "", ""]
    assert values(spark, cleaning.safe_int, [" 42 ", "4.7", "x", None]) == [42, None, None, None]
    assert values(spark, cleaning.safe_bool_text, ["T", "true", "1", "yes", " t", None]) == [True, True, True, False, False, False]
    assert values(spark, cleaning.truthy_flag, [" YES ", "1", "no"]) == [True, True, False]
    assert values(spark, lambda c: cleaning.sanitize_text(c, 5), ["a\tb\nc", "abcdefg", None, "\x00x\x7f"]) == ["a b\nc", "abcde …[truncated]…", "", " x "]
    assert values(spark, cleaning.strip_json_fence, ["```json\n{}\n```", " {} ", "```\n[]```"]) == ["{}", "{}", "[]"]
    assert values(spark, cleaning.l2_to_cosine, [0.0, 2.0, 10.0, 0.5], "double") == [1.0, -1.0, -1.0, 0.875]
    got = values(spark, cleaning.classification, ['```json\n{"categoria":"Acta","anio":2023}\n```', "nonsense", None])
    assert [tuple(g) for g in got] == [("Acta", "2023", "Desconocido"), ("Desconocido",) * 3, ("Desconocido",) * 3]


def test_result_text(spark):
    rows = ['{"content": "x", "text": "y"}', '{"text": 5, "ocr_text": "z"}', '{"a": 1}', "plain", "42", "", None, '{"broken"']
    assert values(spark, lambda c: cleaning.result_text(F.lit("success"), c), rows) == ["y", "z", '{"a": 1}', "plain", "42", "", None, '{"broken"']
    assert values(spark, lambda c: cleaning.result_text(F.lit("error"), c), ["x"]) == [None]


def test_identifiers(spark):
    u = "0a54018d-d782-49ca-a1df-ba76dacebc9d"
    forms = [u, u.upper(), u.replace("-", ""), "{" + u + "}", "urn:uuid:" + u, f" {u}\n"]
    assert len(set(values(spark, identifiers.uuid_key, forms))) == 1
    assert values(spark, identifiers.uuid_key, ["", " ", None, " x "]) == [None, None, None, "=x"]
    d = "ab" * 32
    assert set(values(spark, identifiers.digest_key, [d, d.upper(), "sha256:" + d, f" {d}\n", "0x" + d])) == {d}
    assert values(spark, identifiers.digest_key, ["ab", "", None, "g" * 64, d + "a"]) == [None] * 5
