import pytest

from estatescope.llm.encode import decode, encode, token_counts
from estatescope.llm.vocabulary import encoding

TEXTS = {
    1: "Hello world, it's  a   test.\n\n\nNew line\t tab  nbsp　wide ", 2: "", 3: None, 4: " ", 5: "  \n ", 6: "<|endoftext|> plain",
    7: "señalización ☃️ 👩‍👩‍👧‍👧 日本語テスト Склад №5 עברית", 8: "x" * 5000, 9: " " * 3000 + "a", 10: "\x00\x01\r\n\r\rcode(){}[];", 11: "ࡰࡰ\U00013460\U00010d40 new letters",
    12: "don't they'LL 12345 ½ ² ⅷ ٣", 13: "áè combining", 14: ("palabra " * 3000) + "fin",
}


@pytest.mark.parametrize("block", [50, 8_000_000])
def test_ids_and_round_trip(spark, block):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode(df, block_chars=block).collect()}
    assert got == {k: encoding().encode_ordinary(t or "") for k, t in TEXTS.items()}
    counts = {r.doc_id: r.n_tokens for r in token_counts(df, block_chars=block).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    back = {r.doc_id: r.text for r in decode(encode(df, block_chars=block)).collect()}
    assert back == {k: t or "" for k, t in TEXTS.items()}


def test_every_kind_of_character(spark):
    step = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    rows = [(i, "".join(f"a{chr(c)}b {chr(c)}1" for c in step[i : i + 500])) for i in range(0, len(step), 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode(df).collect()}
    assert all(got[i] == encoding().encode_ordinary(t) for i, t in rows)


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((str(r.doc_id), len(r.ids)) for r in encode(df).collect()) == [("1", 2), ("1", 2), ("None", 1)]
