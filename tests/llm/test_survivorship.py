from pyspark.sql import functions as F

from estatescope.llm.survivorship import golden_records, representatives

D, E = "ab" * 32, "cd" * 32
SCHEMA = "id long, sha256 string, is_pdf boolean, ocr_needed boolean, size_bytes long, modification_year int, depth int, last_seen string, file_type string"


def files(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


def test_impossible_values_count_as_missing(spark):
    df = files(spark, [
        (1, D, False, None, 10, 2038, 1, "2024-01-01", ".txt"), (2, D.upper(), False, None, 10, 2010, 1, "2024-01-01", ".txt"),
        (3, "sha256:" + E, None, None, -1, None, None, "2024-01-01", ""), (4, f" {E}\n", None, None, None, None, None, None, ""),
        (5, None, True, None, 1, 1, 1, None, ""), (6, "no digest", True, None, 1, 1, 1, None, ""), (7, "ef" * 32, True, None, 1, 1, 1, None, ""),
    ])
    assert {tuple(r) for r in representatives(df).select("group_id", "survivor_id").collect()} == {(1, 2), (3, 3)}


def test_fields_come_from_different_members(spark):
    df = files(spark, [
        (1, D, True, None, None, 2010, 3, "2024-01-02", ".pdf"), (2, D, False, True, 50, None, None, "2024-01-05", ".pdf"),
        (3, D, None, False, 70, 2050, 9, "2024-01-03", ".pdf"),
    ])
    r = golden_records(df).first()
    # 1 is trusted for its flag; sizes, years and depths compete by trust, then time
    assert (r.group_id, r.is_pdf, r.ocr_needed, r.size_bytes, r.modification_year, r.depth) == (1, True, True, 50, 2010, 3)


def test_rows_given_twice_are_no_group(spark):
    df = files(spark, [(1, D, True, None, 1, 1, 1, None, "")] * 3)
    assert representatives(df).collect() == []
