from hypothesis import given, settings
from hypothesis import strategies as st

from estatescope.llm.splitting import spans, split
from estatescope.llm.vocabulary import encoding


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab .\n,ñ€👩\t1")), max_size=600), st.integers(8, 40))
def test_pieces_cover_the_text_within_the_limit(text, limit):
    overlap = limit // 4
    raw, pieces = text.encode(), spans(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(raw)
    for x, y, a, b in pieces:
        assert b - a <= limit and len(encoding().encode_ordinary(raw[x:y].decode())) <= limit
    for (x, y, a, b), (x2, y2, a2, b2) in zip(pieces, pieces[1:]):
        assert x < x2 <= y < y2 or (x2 == y and y < y2)
        assert 0 <= b - a2 <= overlap


def test_cuts_fall_at_paragraphs(spark):
    text = "\n\n".join(["Una frase corta. Otra frase algo más larga que la primera."] * 60)
    rows = split(spark.createDataFrame([(1, text), (2, "corto"), (3, None), (4, "")], "doc_id long, text string"), limit=100, overlap=10).orderBy("piece").collect()
    assert {r.doc_id for r in rows} == {1} and len(rows) == rows[0].pieces > 5
    assert all(r.text.endswith("\n\n") for r in rows[:-1])
    assert all(0 < a.end_token - b.first_token <= 10 for a, b in zip(rows, rows[1:]))


def test_text_without_boundaries_is_cut_hard(spark):
    rows = split(spark.createDataFrame([(1, "ñ€" * 2000)], "doc_id long, text string"), limit=64, overlap=8).collect()
    assert all("�" not in r.text and r.end_token - r.first_token <= 64 for r in rows)
