"""Walker, readers, streaming and control on hand-made files."""

import hashlib
import json
import os
import zipfile

import numpy as np
import xxhash
from pyspark.sql import functions as F

from estatescope import pipeline
from estatescope.sources import readers, walker
from estatescope.streaming import dispatch, queues, reconcile


def tree(base):
    for path, data in {
        "root.txt": b"r", "a/one.txt": b"same", "a/b/two.TXT": b"same", "a/empty.bin": b"", "c/.bashrc": b"x", "c/a.tar.gz": b"y", "c/_hidden": b"z",
    }.items():
        p = base / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    os.symlink(base / "a", base / "c" / "link")


def test_walk_and_inventory(spark, tmp_path):
    tree(tmp_path)
    got = walker.inventory(walker.walk(spark, str(tmp_path)), str(tmp_path)).collect()
    names = {r.full_path[len(str(tmp_path)) + 1 :]: r for r in got}
    assert set(names) == {"a/one.txt", "a/b/two.TXT", "a/empty.bin", "c/.bashrc", "c/a.tar.gz", "c/_hidden"}
    assert names["a/b/two.TXT"].file_type == ".txt" and names["a/b/two.TXT"].depth == 3 and names["c/.bashrc"].file_type == ""
    assert names["a/empty.bin"].size_bytes == 0
    assert walker.walk(spark, str(tmp_path), include_root_files=True).count() == 7


def test_hashes(spark, tmp_path):
    tree(tmp_path)
    files = walker.walk(spark, str(tmp_path)).select(F.xxhash64("path").alias("id"), F.col("path").alias("full_path"))
    files = files.union(spark.createDataFrame([(-1, "/nowhere")], "id long, full_path string"))
    got = readers.hash_files(files).collect()
    assert len(got) == 6 and len({r.sha256 for r in got}) == 5
    assert readers.digests(str(tmp_path / "a/one.txt"), 2) == (str(np.uint64(xxhash.xxh64_intdigest(b"same")).astype(np.int64)), hashlib.sha256(b"same").hexdigest())


def test_texts(spark, tmp_path):
    (tmp_path / "u.txt").write_text("señal", encoding="utf-8")
    (tmp_path / "l.txt").write_bytes("señal".encode("latin-1"))
    (tmp_path / "long.txt").write_text("A" * 5000)
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:body><w:p><w:r><w:t>uno</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>dos</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    assert readers.plain_text(str(tmp_path / "l.txt")) == "seal" and len(readers.plain_text(str(tmp_path / "long.txt"), 100)) == 100
    rows = [(1, "u.txt", ".txt", None), (2, "d.docx", ".docx", False), (3, "u.txt", ".txt", True), (4, "none.txt", ".txt", None), (5, "u.txt", ".dwg", None)]
    df = spark.createDataFrame([(i, str(tmp_path / p), t, o) for i, p, t, o in rows], "id long, full_path string, file_type string, ocr_needed boolean")
    assert {r.id: (r.text_excerpt, r.text_chars_extracted) for r in readers.read_texts(df).collect()} == {1: ("señal", 5), 2: ("uno\ndos", 7), 3: ("", 0), 4: ("", 0), 5: ("", 0)}


def test_pdf_pages_and_pictures():
    assert readers.pages_need_ocr([{}, {"/Resources": {}}]) and not readers.pages_need_ocr([{"/Resources": {"/Font": {}}}])
    full = lambda image: 0.5
    assert not readers.looks_like_document(np.zeros((100, 100), np.uint8), full)
    assert not readers.looks_like_document(np.zeros((200, 1000), np.uint8), full)
    assert not readers.looks_like_document(np.random.default_rng(42).integers(0, 256, (400, 400)).astype(np.uint8), full)
    assert readers.looks_like_document(np.full((600, 800), 200, np.uint8), full)
    assert not readers.looks_like_document(np.full((400, 400), 128, np.uint8), lambda image: 0.0)


def test_classify_retries(spark):
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "id long, prompt string")

    def ask(prompt):
        if prompt == "bad":
            raise OSError
        return '```json\n{"categoria": "Acta", "anio": 2020, "proyecto": null}\n```'

    assert {r.id: (r.categoria, r.anio, r.proyecto) for r in readers.classify(df, ask).collect()} == {1: ("Acta", "2020", "Desconocido"), 2: ("Desconocido",) * 3}


def test_csv_flags(spark, tmp_path):
    (tmp_path / "f.csv").write_text("full_path,ocr_needed\n/a, True \n/b,no\n")
    assert {r.full_path: r.ocr_needed for r in walker.csv_flags(spark, str(tmp_path / "f.csv")).collect()} == {"/a": True, "/b": False}


def test_stream_reconcile(spark, tmp_path):
    queue = tmp_path / "q"
    queue.mkdir()
    msg = lambda c, status="success", result="text", model="OCRWorker", mid="m": json.dumps(
        {"message_id": mid, "correlation_id": c, "model": model, "status": status, "result": result}
    )
    (queue / "1.json").write_text("\n".join([msg("c1"), msg("c1"), msg("zz"), msg("c2", "error"), msg("c3", model="Other"), "not json", msg("c4", "odd")]))
    tasks = spark.createDataFrame([(1, "c1"), (2, "c2"), (3, "c3")], "file_id long, correlation_id string")
    r = reconcile.Reconciler(spark, tasks, "OCRWorker", str(tmp_path / "up"), str(tmp_path / "bad"))
    r.run(queues.read_queue(spark, str(queue)), str(tmp_path / "cp")).awaitTermination(120)
    files = spark.createDataFrame([(i, None, None, None) for i in (1, 2, 3)], "id long, text_excerpt string, text_chars_extracted int, last_seen timestamp_ntz")
    out, still = r.apply(files, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    assert {x.id: x.text_excerpt for x in out.collect()} == {1: "text", 2: None, 3: None}
    assert {x.correlation_id for x in still.collect()} == {"c2", "c3"}
    assert spark.read.json(str(tmp_path / "bad")).count() == 2
    # nothing new: the checkpoint has acknowledged it
    r.run(queues.read_queue(spark, str(queue)), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "up")).count() == 1


def test_answers_close_their_task_however_the_id_is_written(spark, tmp_path):
    queue = tmp_path / "q"
    queue.mkdir()
    u = "550e8400-e29b-41d4-a716-446655440000"
    msg = lambda c, text: json.dumps({"message_id": "m", "correlation_id": c, "model": "OCRWorker", "status": "success", "result": text})
    (queue / "1.json").write_text("\n".join([msg(u.upper(), "zwei"), msg(u, "alpha"), msg("{" + u + "}", "beta")]))
    tasks = spark.createDataFrame([(1, u), (2, "other")], "file_id long, correlation_id string")
    r = reconcile.Reconciler(spark, tasks, "OCRWorker", str(tmp_path / "up"), str(tmp_path / "bad"))
    r.run(queues.read_queue(spark, str(queue)), str(tmp_path / "cp")).awaitTermination(120)
    files = spark.createDataFrame([(i, None, None, None) for i in (1, 2)], "id long, text_excerpt string, text_chars_extracted int, last_seen timestamp_ntz")
    out, still = r.apply(files, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    # the first answer counts, not the least
    assert {x.id: x.text_excerpt for x in out.collect()} == {1: "zwei", 2: None}
    assert [x.correlation_id for x in still.collect()] == ["other"]


def test_results_send_the_next_batch(spark, tmp_path):
    from estatescope.schemas import TASK_MAP

    waiting = spark.createDataFrame([(i, f"/f{i}") for i in range(10)], "id long, full_path string")
    auto = dispatch.AutoBatch(
        lambda known: waiting.join(known.select(F.col("file_id").alias("id")), "id", "left_anti"), str(tmp_path / "tasks"), "moondream", "t", str(tmp_path),
        TASK_MAP, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"), 4,
    )
    assert auto.send(spark, -1) == 4
    queue = tmp_path / "q"
    queue.mkdir()
    for step, (answered, sent) in enumerate(((3, 4), (1, 8), (4, 10))):
        known = [r.correlation_id for r in auto.task_map(spark).orderBy("file_id").collect()]
        at = sum(x for x, _ in ((3, 4), (1, 8), (4, 10))[:step])
        (queue / f"{step}.json").write_text("\n".join(json.dumps({"message_id": "m", "correlation_id": c, "model": "MoondreamWorker", "status": "success", "result": "t"}) for c in known[at : at + answered]))
        r = reconcile.Reconciler(spark, auto.task_map(spark), "MoondreamWorker", str(tmp_path / "up"), str(tmp_path / "bad"), auto.after_batch(spark))
        r.run(queues.read_queue(spark, str(queue)), str(tmp_path / "cp")).awaitTermination(120)
        assert auto.task_map(spark).count() == sent
    assert spark.read.text(str(tmp_path / "cola_modelo_moondream")).count() == 10


def test_dispatch(spark, tmp_path):
    waiting = spark.createDataFrame([(i, f"/f{i}") for i in range(10)], "id long, full_path string")
    empty = spark.createDataFrame([], "file_id long, correlation_id string, status string, attempts int, last_error string, created_at timestamp_ntz, updated_at timestamp_ntz")
    made, tasks = dispatch.dispatch(waiting, empty, "moondream", "t", str(tmp_path), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"), 4)
    assert {r.file_id for r in tasks.collect()} == {0, 1, 2, 3}
    assert spark.read.text(str(tmp_path / "cola_modelo_moondream")).count() == 4


def test_pipeline_runs(spark):
    calls = []

    def flaky(state):
        calls.append(1)
        if len(calls) < 2:
            raise ValueError("once")

    def fail(state):
        raise RuntimeError("always")

    p = pipeline.Pipeline(spark, {0: ("scan", {"a": lambda s: s["spark"].range(5).count(), "b": flaky}), 1: ("bad", {"c": fail})}, attempts=2, delay=0.01)
    assert p.run_phase(9).code == 404 and p.status(1).code == 404
    run = p.run_phase(0).body["run_id"]
    assert p.wait(run, 60) == "finished" and len(calls) == 2
    run = p.start().body["run_id"]
    assert p.wait(run, 60) == "error"
    tree = p.status(run).body
    assert [c["status"] for c in tree["children"]] == ["finished", "error"] and "always" in tree["children"][1]["children"][0]["logs"]
    assert p.change_focus("x").body["base"] == "/data/x" and p.change_focus("/y").body["base"] == "/y"
    assert p.stop().code == 404


def test_pipeline_cancel(spark):
    import time

    p = pipeline.Pipeline(spark, {0: ("slow", {"a": lambda s: time.sleep(0.5), "b": lambda s: None})}, delay=0.01)
    run = p.start().body["run_id"]
    assert p.start().code == 400
    assert p.wait(run, 30) == "cancelled" and p.status(run).body["status"] == "cancelled"


def test_listing_and_messages_by_id(spark, tmp_path):
    tree(tmp_path / "t")
    made = queues.send_listing(walker.walk(spark, str(tmp_path / "t")), "ocr", "t", str(tmp_path / "q"))
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "q/cola_modelo_ocr")).collect()]
    assert len(sent) == 6 and {m["message_id"] for m in sent} == {r.message_id for r in made.collect()}
    queues.write_by_id(made.select("message_id", "value"), str(tmp_path / "by"))
    assert spark.read.json(str(tmp_path / "by")).count() == 6


def test_stream_duplicates_and_windows(spark, tmp_path):
    folder = tmp_path / "in"
    spark.sql("""select * from values ('c1', 'm', 'success', timestamp'2024-01-01 00:10:00'), ('c1', 'm', 'success', timestamp'2024-01-01 00:20:00'),
        ('c2', 'm', 'error', timestamp'2024-01-01 01:05:00') as t(correlation_id, model, status, received_at)""").write.parquet(str(folder))
    stream = lambda: spark.readStream.schema(spark.read.parquet(str(folder)).schema).parquet(str(folder))
    for name, df, mode in (("dedup", reconcile.deduplicated(stream()), "append"), ("rates", reconcile.answer_rates(stream()), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert {r.correlation_id for r in spark.table("dedup").collect()} == {"c1", "c2"} and spark.table("dedup").count() == 2
    assert sorted(r.n for r in spark.table("rates").collect()) == [1, 2]


def _pdf(pages, packed=False, font=True):
    """A PDF of one content stream per page."""
    import zlib

    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(len(pages))) + b"] /Resources 3 0 R >>"}
    objects[3] = b"<< /Font << /F1 4 0 R /F2 5 0 R >> >>" if font else b"<< /XObject << >> >>"
    objects[4] = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"
    objects[5] = b"<< /Type /Font /Subtype /Type0 /ToUnicode 6 0 R >>"
    table = b"1 beginbfchar <0041> <00F1> endbfchar 1 beginbfrange <0001> <0003> <0061> endbfrange"
    streams = {6: table, **{11 + 2 * i: c for i, c in enumerate(pages)}}
    for i in range(len(pages)):
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * i)
    body = b""
    if packed:
        inner = {n: o for n, o in objects.items() if n != 1}
        data, places = b"", []
        for n, o in inner.items():
            places.append(b"%d %d" % (n, len(data)))
            data += o + b" "
        head = b" ".join(places) + b" "
        z = zlib.compress(head + data)
        body += b"90 0 obj << /Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d >> stream\n" % (len(inner), len(head), len(z)) + z + b"\nendstream endobj\n"
        objects = {1: objects[1]}
    for n, o in objects.items():
        body += b"%d 0 obj\n" % n + o + b"\nendobj\n"
    for n, c in streams.items():
        z = zlib.compress(c)
        body += b"%d 0 obj\n<< /Length %d /Filter /FlateDecode >>\nstream\n" % (n, len(z)) + z + b"\nendstream\nendobj\n"
    return b"%PDF-1.5\n" + body + b"trailer << /Root 1 0 R >>\n%%EOF"


def test_pdf_texts_and_fonts(tmp_path):
    pages = [
        b"BT /F1 12 Tf 72 700 Td (Informe \\(a\\\\361o\\) de obra) Tj 0 -14 Td [(Im) 20 (porte) -300 (total)] TJ ET",
        b"BT /F2 10 Tf <000100020003> Tj T* <0041> Tj ET",
    ]
    pages[0] = b"BT /F1 12 Tf 72 700 Td (Informe \\(a\\361o\\) de obra) Tj 0 -14 Td [(Im) 20 (porte) -300 (total)] TJ ET"
    for packed in (False, True):
        path = tmp_path / f"{packed}.pdf"
        path.write_bytes(_pdf(pages, packed))
        assert readers.pdf_text(str(path)) == "Informe (año) de obra\nImporte total\nabc\nñ"
        assert readers.pdf_text(str(path), 7) == "Informe" and readers.pdf_needs_ocr(str(path)) is False
    scan = tmp_path / "scan.pdf"
    scan.write_bytes(_pdf([b"q 1 0 0 1 0 0 cm /Im0 Do Q"], font=False))
    assert readers.pdf_needs_ocr(str(scan)) is True and readers.pdf_text(str(scan)) == ""
    broken = tmp_path / "broken.pdf"
    broken.write_bytes(b"no pdf at all")
    assert readers.pdf_needs_ocr(str(broken)) is None and readers.pdf_text(str(broken)) == "" and readers.pdf_needs_ocr("/nowhere.pdf") is None


def test_one_large_folder_is_shared_out(spark, tmp_path):
    for i in range(30):
        folder = tmp_path / "top" / f"d{i % 5}" / f"e{i}"
        folder.mkdir(parents=True)
        (folder / "f.txt").write_text("x")
    (tmp_path / "top" / "g.txt").write_text("y")
    (tmp_path / "root.txt").write_text("z")
    df = walker.walk(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 5 and df.count() == df.select("path").distinct().count() == 31
    assert walker.walk(spark, str(tmp_path), include_root_files=True).count() == 32


def test_runs_outlive_the_driver(spark, tmp_path):
    folder = "file://" + str(tmp_path / "runs")
    p = pipeline.Pipeline(spark, {0: ("scan", {"a": lambda s: None})}, attempts=1, store=folder)
    run = p.start().body["run_id"]
    assert p.wait(run, 60) == "finished"
    again = pipeline.Pipeline(spark, {0: ("scan", {"a": lambda s: None})}, attempts=1, store=folder)
    body = again.status(run).body
    assert body == p.status(run).body and "finished in" in body["children"][0]["children"][0]["logs"]
    again.runs[run].mark("running")
    again._save(run)
    # left under way by a driver that ended
    third = pipeline.Pipeline(spark, {0: ("scan", {"a": lambda s: None})}, attempts=1, store=folder)
    assert third.start().code == 400 and third.status(run).body["status"] == "cancelled"
    second = third.start().body["run_id"]
    assert second == run + 1 and third.wait(second, 60) == "finished"


def test_tee_cursor_and_catalog(spark):
    import contextlib
    import io

    from estatescope.sources import tables

    a, b = io.StringIO(), io.StringIO()
    with contextlib.redirect_stdout(pipeline.Tee(a, b)):
        print("line")
    assert a.getvalue() == b.getvalue() == "line\n"
    assert [len(x) for x in tables.fetch(spark.range(25), 10)] == [10, 10, 5]
    spark.range(1).selectExpr("id", "id as Embedding").createOrReplaceTempView("listed")
    assert tables.missing_columns(spark, "listed", "embedding", "other") == ["other"] and tables.missing_columns(spark, "none", "x") == ["x"]


def test_classify_over_http(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Service(BaseHTTPRequestHandler):
        tries = 0

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            prompt = asked["messages"][1]["content"]
            Service.tries += 1
            if prompt == "down" or prompt == "once" and Service.tries == 1:
                return self.send_error(500)
            answer = json.dumps({"choices": [{"message": {"content": json.dumps({"categoria": prompt, "anio": 1999})}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(answer)))
            self.end_headers()
            self.wfile.write(answer)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    df = spark.createDataFrame([(1, "once"), (2, "down"), (3, "Acta")], "id long, prompt string").coalesce(1)
    ask = readers.chat_service(f"http://127.0.0.1:{server.server_port}/v1/chat", timeout=5)
    got = {r.id: (r.categoria, r.anio, r.proyecto) for r in readers.classify(df, ask, at_once=1).collect()}
    server.shutdown()
    assert got == {1: ("once", "1999", "Desconocido"), 2: ("Desconocido",) * 3, 3: ("Acta", "1999", "Desconocido")}


def test_jdbc_table_read_in_parallel(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path / 'db'};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    df = spark.range(100).selectExpr("id", "cast(id * 2 as int) as twice")
    df.write.format("jdbc").option("url", url).option("dbtable", "numbers").option("driver", driver).save()
    got = readers.read_jdbc(spark, url, "numbers", driver=driver, partitionColumn="id", lowerBound="0", upperBound="100", numPartitions="4")
    assert got.rdd.getNumPartitions() == 4 and sorted(tuple(r) for r in got.collect()) == [(i, 2 * i) for i in range(100)]


def _quad(corners, high=400, wide=500, fill=180, ground=90):
    y, x = np.mgrid[:high, :wide]
    inside = np.ones((high, wide), bool)
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]]):
        inside &= (bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0
    return np.where(inside, fill, ground).astype(np.uint8)


def test_outlines_without_a_library():
    from estatescope.sources.pictures import outline_share

    straight = _quad([(100, 80), (400, 80), (400, 330), (100, 330)])
    assert abs(outline_share(straight) - 300 * 250 / 200_000) < 0.02
    turned = _quad([(150, 60), (430, 120), (380, 350), (90, 290)])
    assert outline_share(turned) > 0.25
    assert outline_share(_quad([(250, 40), (450, 350), (50, 350)])) == 0.0  # three corners
    y, x = np.mgrid[:400, :500]
    assert outline_share(np.where((x - 250) ** 2 + (y - 200) ** 2 < 150**2, 180, 90).astype(np.uint8)) == 0.0
    angle = np.full((400, 500), 90, np.uint8)
    angle[50:350, 50:54] = angle[346:350, 50:450] = 200
    assert outline_share(angle) == 0.0 and outline_share(np.full((300, 300), 128, np.uint8)) == 0.0
    assert readers.looks_like_document(straight) and not readers.looks_like_document(np.full((400, 400), 128, np.uint8))


def test_pictures_are_read(spark, tmp_path):
    import struct
    import zlib

    from estatescope.sources.pictures import read_grey

    grey = _quad([(100, 80), (400, 80), (400, 330), (100, 330)])
    grey[200:220, 150:300] = np.arange(150, dtype=np.uint8)

    def png(rows, kind, how):
        high, wide = rows.shape[:2]
        flat = rows.reshape(high, -1).astype(np.int32)
        step = flat.shape[1] // wide
        up = np.vstack([np.zeros((1, flat.shape[1]), np.int32), flat[:-1]])
        left, corner = np.pad(flat, ((0, 0), (step, 0)))[:, : flat.shape[1]], np.pad(up, ((0, 0), (step, 0)))[:, : flat.shape[1]]
        p, q, r = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        paeth = np.where((p <= q) & (p <= r), left, np.where(q <= r, up, corner))
        guess = [0, left, up, (left + up) // 2, paeth][how]
        lines = np.hstack([np.full((high, 1), how), (flat - guess) & 255]).astype(np.uint8).tobytes()
        chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + b"\0\0\0\0"
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")

    path = tmp_path / "x"
    for how in range(5):
        path.write_bytes(png(grey, 0, how))
        assert (read_grey(str(path)) == grey).all()
    colour = np.repeat(grey[:, :, None], 3, axis=2)
    path.write_bytes(png(colour, 2, 4))
    assert (read_grey(str(path)) == grey).all()
    path.write_bytes(b"P5\n# made\n500 400\n255\n" + grey.tobytes())
    assert (read_grey(str(path)) == grey).all()
    bmp = b"BM" + struct.pack("<IHHI", 0, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 500, 400, 1, 24, 0, 0, 0, 0, 0, 0) + colour[::-1].tobytes()
    path.write_bytes(bmp)
    assert (read_grey(str(path)) == grey).all()
    path.write_bytes(b"GIF89a")
    assert read_grey(str(path)) is None and read_grey("/nowhere") is None
    page, blank = tmp_path / "page.png", tmp_path / "blank.png"
    page.write_bytes(png(grey, 0, 2))
    blank.write_bytes(png(np.full((400, 400), 128, np.uint8), 0, 0))
    df = spark.createDataFrame([(1, str(page)), (2, str(blank)), (3, "/nowhere")], "id long, full_path string")
    assert [r.id for r in readers.detect_documents(df).collect()] == [1]
