"""Operators on small hand-made rows."""

from pyspark.sql import functions as F

from estatescope.operators import dedup, delivery, merge, messages, pending, semantic, star, status

SPEC = delivery.Spec("mid", "rid", "at")


def test_delivery_store(spark, tmp_path):
    at = lambda d: f"2024-01-{d:02d} 00:00:00"
    rows = lambda *r: spark.createDataFrame(list(r), "rid long, mid string, at string, body string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    store = delivery.DeliveryStore(spark, "file://" + str(tmp_path / "s"), SPEC, 8)
    store.merge(rows((1, "a", at(5), "x"), (2, "A ", at(6), "y"), (3, None, at(1), "n"), (4, "", at(1), "e"), (5, "b", at(2), "z")))
    first = store.manifest()
    store.merge(rows((6, "b", at(1), "early"), (7, "b", at(1), "tie"), (8, "c", None, "c")))
    kept = {r.rid for r in store.rows().collect()}
    # ids that are no UUIDs keep their capitals apart
    assert kept == {1, 2, 3, 4, 6, 8}
    untouched = {p: f for p, f in first["parts"].items() if store.manifest()["parts"][p] == f}
    assert untouched, "partitions without a new identifier stay as they were"
    again = store.merge(rows((6, "b", at(1), "early")))
    assert {r.rid for r in store.rows().collect()} == kept and again["version"] == 3


def _deliveries(spark, rows):
    return spark.createDataFrame(rows, "rid long, mid string, at string, body string").withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_index_names_the_days_to_rewrite(spark, tmp_path):
    store = delivery.DeliveryStore(spark, "file://" + str(tmp_path / "s"), SPEC, 8)
    store.merge(_deliveries(spark, [(d * 100 + i, f"k{d}-{i}", f"2024-01-{d:02d} 12:00:00", "old") for d in range(1, 21) for i in range(30)]))
    first = store.manifest()
    assert len(first["parts"]) == 20
    new = [(9000 + i, f"new{i}", "2024-02-01 08:00:00", "new") for i in range(100)]
    # earlier copies of three known ids, and copies that come too late
    early = [(9200 + d, f"k{d}-1", f"2024-01-{d:02d} 01:00:00", "early") for d in (3, 7, 11)]
    late = [(9300 + d, f"k{d}-2", "2024-02-01 09:00:00", "late") for d in (4, 5, 6)]
    store.merge(_deliveries(spark, new + early + late))
    second = store.manifest()
    changed = {p for p in second["parts"] if second["parts"][p] != first["parts"].get(p)}
    assert changed == {"2024-02-01", "2024-01-03", "2024-01-07", "2024-01-11"}
    kept = {r.rid: r.body for r in store.rows().collect()}
    assert len(kept) == 700 and all(kept[9200 + d] == "early" and d * 100 + 1 not in kept for d in (3, 7, 11)) and not {9304, 9305, 9306} & set(kept)
    assert store.index().count() == 700


def test_second_writer_is_refused_and_old_versions_go(spark, tmp_path):
    import pytest

    path = tmp_path / "s"
    a, b = (delivery.DeliveryStore(spark, "file://" + str(path), SPEC, 2) for _ in range(2))
    a.merge(_deliveries(spark, [(1, "x", "2024-01-01 00:00:00", "")]))
    stale = a.manifest()
    b.merge(_deliveries(spark, [(2, "y", "2024-01-01 00:00:00", "")]))
    with pytest.raises(delivery.ConcurrentMerge):
        a._publish({**stale, "version": stale["version"] + 1})
    assert {r.rid for r in a.rows().collect()} == {1, 2}
    for i in range(3, 7):
        a.merge(_deliveries(spark, [(i, f"z{i}", "2024-01-01 00:00:00", "")]))
    assert len([p for p in path.iterdir() if p.name.startswith("manifest-")]) == delivery.KEPT_VERSIONS
    used = {f.split("/")[0] for n in a._manifests() for k in ("parts", "index") for f in a._load(n)[k].values()}
    assert {p.name for p in path.iterdir() if p.is_dir()} <= used | {""} and {r.rid for r in a.rows().collect()} == set(range(1, 7))


def test_deliveries_of_several_scopes(spark):
    df = _deliveries(spark, [(1, "x", "2024-01-02 00:00:00", "s"), (1, "X", "2024-01-01 00:00:00", "t/1"), (2, "x", "2024-01-03 00:00:00", "s"), (3, None, None, "s"), (4, "X ", None, "t/1"), (5, "x", "2024-01-01 05:00:00", None)])
    spec = delivery.Spec("mid", "rid", "at", scope="body")
    assert {(r.body, r.row_id) for r in delivery.dropped_deliveries(df, spec, partitions=2).collect()} == {("s", 2), ("t/1", 4)}


def test_dropped_deliveries_hot_identifier(spark):
    df = spark.range(3000).select(
        F.col("id").alias("rid"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("mid"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("at"),
    )
    got = {r[0] for r in delivery.dropped_deliveries(df, SPEC).collect()}
    assert got == {i for i in range(1, 3000) if i % 3 == 0}


def test_scan_upsert(spark):
    schema = "full_path string, file_name string, file_type string, size_bytes long, creation_year int, modification_year int, depth int, is_pdf boolean"
    old = spark.createDataFrame(
        [("/a", "a", "", 1, 2000, 2000, 1, False), ("/b", "b", "", None, 2000, 2000, 1, False), ("/c", "c", "", 1, 2000, 2000, 1, False)], schema
    ).select("*", F.lit(7).cast("long").alias("id"), F.lit(False).alias("hash_pending"), F.lit(None).cast("timestamp_ntz").alias("last_seen"))
    new = spark.createDataFrame([("/a", "A", "x", 2, 1, 2000, 9, True), ("/b", "B", "", 5, 1, 2000, 1, False), ("/d", "d", "", 1, 1, 1, 1, True)], schema)
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    got = {r.full_path: r for r in merge.scan_upsert(old, new, now).collect()}
    assert (got["/a"].action, got["/a"].file_name, got["/a"].file_type, got["/a"].is_pdf, got["/a"].hash_pending) == ("update", "A", "", False, False)
    assert got["/b"].action == "keep" and got["/b"].last_seen is None
    assert got["/c"].action == "keep"
    assert got["/d"].action == "insert" and got["/d"].hash_pending and got["/d"].id is None
    rearmed = merge.scan_upsert(old, new, now, rearm_on_change=True).where("full_path = '/a'").first()
    assert rearmed.hash_pending


def test_canonical_choice_by_every_key(spark):
    schema = "id long, is_pdf boolean, ocr_needed boolean, size_bytes long, modification_year int, depth int, sha256 string"
    pairs = [
        [(1, False, None, 9, 9, 9, "p"), (2, True, False, 1, 1, 9, "p")], [(3, True, True, 5, 1, 1, "s"), (4, True, True, 6, 1, 1, "s")],
        [(5, None, None, 5, 2020, 1, "y"), (6, None, None, 5, 2021, 9, "y")], [(7, None, None, 5, 1, 3, "d"), (8, None, None, 5, 1, 2, "d")],
        [(9, None, None, None, None, None, "i"), (10, None, None, None, None, None, "i")],
    ]
    df = spark.createDataFrame([r for p in pairs for r in p], schema)
    assert {r.sha256: r.canonical_id for r in dedup.choose_canonical(df).collect()} == {"p": 2, "s": 4, "y": 6, "d": 8, "i": 9}


def test_hash_canonical_triples(spark):
    df = spark.createDataFrame([(10, "x"), (20, "x"), (30, "x"), (40, None)], "id long, sha256 string").select("*", F.lit(False).alias("is_canonical"), F.lit(None).cast("long").alias("canonical_id"))
    got = {r.id: (r.is_canonical, r.canonical_id) for r in dedup.hash_canonical(df).collect()}
    assert got == {10: (True, None), 20: (False, 10), 30: (False, 10), 40: (False, None)}


def test_compress_pointers(spark):
    rows = [(i, i - 1) for i in range(2, 200)] + [(1, None), (300, 301), (301, 302), (302, 300), (303, 302), (400, 999), (500, 500)]
    got = {r.id: r.root for r in dedup.compress_pointers(spark.createDataFrame(rows, "id long, canonical_id long")).collect()}
    assert got == {**{i: 1 for i in range(2, 200)}, 300: 300, 301: 300, 302: 300, 303: 300}


def test_status(spark):
    cases = {1: ["running", "pending"], 2: ["finished", "error"], 3: ["finished", "cancelled"], 4: ["finished", "finished"], 5: ["finished", "unknown"]}
    df = spark.createDataFrame([(k, s) for k, v in cases.items() for s in v], "run_id long, status string")
    got = {r.run_id: r.status for r in status.status_rollup(df, "run_id").collect()}
    assert got == {1: "running", 2: "error", 3: "cancelled", 4: "finished", 5: "failed"}
    runs = spark.createDataFrame([(1, "cancelled"), (4, "running"), (9, "pending")], "run_id long, status string")
    assert {r.run_id: r.status for r in status.update_status(runs, df, "run_id").collect()} == {1: "cancelled", 4: "finished", 9: "pending"}


def test_pending_flags_are_three_valued(spark):
    df = spark.createDataFrame([(1, True, None), (2, True, False), (3, None, None), (4, False, None)], "id long, is_pdf boolean, ocr_needed boolean")
    assert [r.id for r in pending.pending_pdf(df).collect()] == [1]


def test_directory_closure(spark):
    df = spark.createDataFrame([("/data/x/a.txt",), ("/data/x/b.txt",), ("/data/y/z/c.txt",)], "full_path string")
    got = {r.path: r for r in star.dim_directory(df).collect()}
    assert set(got) == {"/data", "/data/x", "/data/x/a.txt", "/data/x/b.txt", "/data/y", "/data/y/z", "/data/y/z/c.txt"}
    assert got["/data"].parent_path is None and all(r.parent_path in got for p, r in got.items() if p != "/data")
    assert len(star.dim_directory(df, "parent").collect()) == 4


def test_greedy_clusters(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (3, 4)], "id long, other long")
    files = spark.createDataFrame([(i, i * 10) for i in range(1, 5)], "id long, size_bytes long").select(
        "*", F.lit(False).alias("is_pdf"), F.lit(False).alias("ocr_needed"), F.lit(1).alias("modification_year"), F.lit(1).alias("depth")
    )
    got = {r.id: (r.is_canonical, r.canonical_id) for r in semantic.greedy_clusters(edges, files).collect()}
    # 2 is taken over by the later seed 3
    assert got == {1: (False, 2), 2: (False, 4), 3: (False, 4), 4: (True, None)}


def test_connected_clusters_of_all_files(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))[rng.integers(0, 60, 400)] + 0.18 * rng.normal(size=(400, 8))
    x[100:130] = x[100]
    kinds = [None if i % 40 == 0 else (".pdf", ".txt")[i % 2] for i in range(400)]
    files = spark.createDataFrame([(i + 1, kinds[i], i % 7) for i in range(400)], "id long, file_type string, size_bytes long").select(
        "*", F.lit(None).cast("long").alias("canonical_id"), F.lit(False).alias("is_pdf"), F.lit(False).alias("ocr_needed"), F.lit(1).alias("modification_year"), F.lit(1).alias("depth")
    )
    vectors = spark.createDataFrame([(i + 1, [float(v) for v in x[i]]) for i in range(400)], "file_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    near &= np.array([[a == b or a is None or b is None for b in kinds] for a in kinds])
    group = np.arange(400)
    while True:
        after = np.where(near, group[None, :], 400).min(axis=1)
        if (after == group).all():
            break
        group = after
    sizes = np.bincount(group)
    want = {i + 1: group[i] for i in range(400) if sizes[group[i]] > 1}
    heads = {g: max((j for j in want if want[j] == g), key=lambda j: ((j - 1) % 7, -j)) for g in set(want.values())}
    # small cells and parts, so that guests and split cells occur
    for cell_rows, part_rows in ((20, 15), (4000, 8192)):
        rows = semantic.connected_clusters(files, vectors, 0.9, 8, cell_rows, part_rows).collect()
        got = {r.id: r.id if r.is_canonical else r.canonical_id for r in rows}
        assert len(rows) == len(got) and got == {i: heads[g] for i, g in want.items()}


def test_rows_sent_to_be_compared(spark, monkeypatch):
    """Vectors that no pivot parts: a row goes to the tasks of its own part only, and a few rows at a time."""
    import numpy as np
    import pyarrow as pa

    x = np.random.default_rng(4).normal(size=(400, 64))
    kinds = [(".pdf", ".txt")[i % 2] for i in range(400)]
    rows = spark.createDataFrame([(i, kinds[i], [float(v) for v in x[i]]) for i in range(400)], "id long, kind string, embedding array<double>")

    def count(*_):
        return lambda table: pa.table({"a": pa.array([table.num_rows]), "b": pa.array([0]), "similarity": pa.array([0.0])})

    monkeypatch.setattr(semantic, "_compare", count)
    sizes = [r.a for r in semantic._all_pairs(rows, 0.9, 64, None, 100, 100).collect()]
    # two types of 200 rows in four cells, so about three parts each
    assert max(sizes) <= 250 and 400 <= sum(sizes) <= 400 * 5


def test_nearest_edges_stay_bounded(spark, monkeypatch):
    """Many equal vectors: a task keeps the nearest of each row only, and types decide who sees whom."""
    import numpy as np

    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 8))[rng.integers(0, 30, 300)] + 0.1 * rng.normal(size=(300, 8))
    x[60:260] = np.eye(8)[0]
    kinds = [None if i % 11 == 0 else ("", ".pdf", ".txt")[i % 3] for i in range(300)]
    files = spark.createDataFrame([(i, kinds[i]) for i in range(300)], "id long, file_type string").withColumn("canonical_id", F.lit(None).cast("long"))
    vectors = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(300)], "file_id long, embedding array<double>")
    monkeypatch.setattr(semantic, "HELD_PAIRS", 100)
    got = {}
    for r in semantic.nearest_edges(files, vectors, 0.9, 6, 8).collect():
        got.setdefault(r.id, set()).add(r.other)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.round(np.sqrt(np.maximum(2 - 2 * u @ u.T, 0)), 7)
    for i in range(300):
        d[i, i] = 0
        may = [j for j in range(300) if u[i] @ u[j] >= 0.9 and (kinds[j] is None or kinds[j] == (kinds[i] or "") or i == j)]
        assert got.get(i, set()) == set(sorted(may, key=lambda j: (d[i, j], j))[:6]) - {i}
    wide = semantic._canonical(files, vectors, 8)
    # 200 equal vectors make about 9,000 pairs; a row is in two tasks at most here
    assert semantic._all_pairs(wide, 0.9, 8, 6, 400, 400).count() <= 2 * 6 * 300


def test_tasks_and_routing(spark):
    files = spark.createDataFrame([(1, "/a")], "id long, full_path string")
    made = messages.build_tasks(files, "OCR", "t", "p").first()
    assert made.queue == "cola_modelo_ocr" and made.payload == {"file_path": "/a", "file_id": "1", "prompt": "p"}
    df = spark.createDataFrame([("Moondream",), ("what",), (None,)], "target_model string")
    assert [r.queue for r in messages.route_tasks(df).collect()] == ["cola_modelo_moondream", None, None]


INVENTORY = (
    "id long, full_path string, file_name string, file_type string, size_bytes long, creation_year int, modification_year int, depth int, is_pdf boolean, "
    "ocr_needed boolean, hash_pending boolean, xxhash64 string, sha256 string, first_seen timestamp_ntz, last_seen timestamp_ntz, text_excerpt string, "
    "text_chars_extracted int, is_canonical boolean, canonical_id long, categoria string, last_classified timestamp_ntz, proyecto string, anio string"
)


def inventory(spark, rows):
    """Rows of the inventory from dictionaries; what is not given is null."""
    names = [c.split()[0] for c in INVENTORY.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], INVENTORY)


def test_star_is_published_and_replaced(spark, tmp_path):
    rows = [
        {"id": 1, "full_path": "/data/x/p/a.pdf", "file_type": ".pdf", "size_bytes": 5, "hash_pending": False, "text_excerpt": "t", "text_chars_extracted": 1},
        {"id": 2, "full_path": "/data/x/p/b.txt", "hash_pending": False, "canonical_id": 1, "is_canonical": False, "categoria": " Acta "},
        {"id": 3, "full_path": "/data/y/c.txt", "hash_pending": True},
    ]
    folder = "file://" + str(tmp_path / "star")
    star.publish(inventory(spark, [*rows, {"id": 4, "full_path": "/old", "hash_pending": False}]), folder)
    s = star.publish(inventory(spark, rows), folder)
    facts = {r.file_id: r for r in s.facts.collect()}
    assert set(facts) == {1, 2} and facts[1].is_canonical and facts[1].sha256 is None and facts[2].text_chars_extracted == 0
    paths = {r.directory_id: r for r in s.directories.collect()}
    assert {r.path for r in paths.values()} == {"/data", "/data/x", "/data/x/p", "/data/x/p/a.pdf", "/data/x/p/b.txt"}
    at = paths[facts[1].directory_id]
    names = []
    while at is not None:
        names.append(at.name)
        at = paths.get(at.parent_id)
    assert names == ["a.pdf", "p", "x", "data"]
    kinds, classes = {r.filetype_id: r.file_type for r in s.file_types.collect()}, {r.classification_id: r.categoria for r in s.classes.collect()}
    assert kinds[facts[1].filetype_id] == ".pdf" and kinds[facts[2].filetype_id] == "tipo desconocido"
    assert classes[facts[1].classification_id] == "sin clasificación" and classes[facts[2].classification_id] == "Acta"
    assert {r.group_id: r.canonical_id for r in s.groups.collect()}[facts[2].group_id] == 1 and facts[1].group_id is None
    assert [r.file_id for r in s.excerpts.collect()] == [1]


def test_paths_of_large_groups_are_rows(spark):
    df = spark.createDataFrame([(f"/a/{i:03d}", "x", "s") for i in range(150)] + [("/b/1", None, "t"), ("/b/0", None, "t"), ("/c", "y", "u"), (None, "z", "v"), (None, "z", "v")], "full_path string, xxhash64 string, sha256 string")
    got = {r.sha256: (r.total, r.first_path, r.paths) for r in dedup.duplicate_groups(df).collect()}
    assert got == {"s": (150, "/a/000", None), "t": (2, "/b/0", "/b/0; /b/1"), "v": (2, None, "")}
    assert dedup.duplicate_members(df).groupBy("sha256").count().collect().__len__() == 3 and dedup.duplicate_members(df).count() == 154


def test_nearest_over_several_query_blocks(spark, monkeypatch):
    import numpy as np

    x = np.random.default_rng(2).normal(size=(300, 8))
    kinds = [None if i % 20 == 0 else (".a", ".b")[i % 2] for i in range(300)]
    files = spark.createDataFrame([(i, kinds[i], None if i % 7 else 1) for i in range(300)], "id long, file_type string, canonical_id long")
    vectors = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(300)], "file_id long, embedding array<double>")
    monkeypatch.setattr(semantic, "QUERY_ROWS", 40)
    monkeypatch.setattr(semantic, "STEP_ROWS", 16)
    got = {}
    for r in semantic.knn_topk(files, vectors, 5, 3, 8).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.other
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 300, 3):
        may = [j for j in range(300) if j % 7 and (kinds[j] is None or kinds[j] == (kinds[i] or ""))]
        best = sorted(may, key=lambda j: (round(float(np.sqrt(max(0.0, 2 - 2 * u[i] @ u[j]))), 9), j))[:5]
        assert [got[i][k + 1] for k in range(len(best))] == best


def test_captions_and_summary(spark):
    from estatescope.operators import reports

    rows = [
        {"id": 1, "full_path": "/a/x.pdf", "is_pdf": True, "ocr_needed": True, "sha256": "s", "text_chars_extracted": 7}, {"id": 2, "full_path": "/a/b.pdf", "is_pdf": True, "sha256": "s"},
        {"id": 3, "full_path": "/c", "sha256": "t"},
    ]
    files = inventory(spark, rows)
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    got = {r.id: r for r in merge.apply_captions(files, spark.createDataFrame([(1, "a boat")], "id long, text_excerpt string"), now).collect()}
    # the number of characters stays as it was
    assert (got[1].text_excerpt, got[1].text_chars_extracted, str(got[1].last_seen)) == ("a boat", 7, "2025-01-01 00:00:00") and got[2].text_excerpt is None and got[2].last_seen is None
    text = reports.executive_summary(files)
    assert text == "Files: 3 (PDF: 2, to OCR: 1)\nDuplicate groups: 1\nFiles in duplicate groups: 2\nLargest group: 2 files, b.pdf\n"
    assert "Duplicate groups: 0" in reports.executive_summary(files.limit(0))
