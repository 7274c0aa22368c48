import datetime as dt
import json
import time
import zipfile

import pytest

from quire.plans.publish import Options, publish
from quire.schemas import PARAGRAPHS
from quire.sources import documents as src
from quire.streaming.pages import read_paragraph_stream, stream_pages

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def run(text, props=""):
    return f'<w:r><w:rPr>{props}</w:rPr><w:t xml:space="preserve">{text}</w:t></w:r>'


def docx(path, *paras):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>" + "".join(f"<w:p>{p}</w:p>" for p in paras) + "</w:body></w:document>")


@pytest.fixture
def folder(tmp_path):
    docx(tmp_path / "1891.docx", run("before"), run("[p1]"), run("A", "<w:b/>") + run("  ") + run("B", "<w:i/><w:u/>"), run("x[3]y", '<w:b w:val="0"/><w:strike/>'), run(" "))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    canvas = [{"images": [{"resource": {"@id": f"https://i.example.org/{i}"}}]} for i in range(2)]
    (tmp_path / "1891.json").write_text(json.dumps({"sequences": [{"canvases": canvas}]}))
    return tmp_path


def test_docx(spark, folder):
    rows = src.read_docx(spark, f"file://{folder}").orderBy("seq").collect()
    assert [r.text for r in rows] == ["before", "[p1]", "A  B", "x[3]y"]
    assert [(x.value, x.type, x.start_position, x.end_position) for x in rows[2].runs] == [("A", "bold", 0, 1), ("B", "italic", 1, 2)]
    assert rows[3].runs[0].type == "strike"
    styled = src.read_docx_styled(spark, f"file://{folder}").orderBy("seq").collect()
    assert (styled[2].styled_runs[1].italic, styled[2].styled_runs[1].underline) == (True, True)
    assert [r.diary for r in src.docx_issues(spark, f"file://{folder}").collect()] == ["bad"]
    assert src.to_xml(src.read_docx_styled(spark, f"file://{folder}").select("diary", "seq", "text")).first().xml.startswith("<p>before</p>\n<p>[p1]</p>")


def test_publish(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    issues = publish(spark, f"file://{folder}", f"file://{folder}/1891.json", f"file://{out}", Options(index=1, title="T"))
    assert {(r.stage, r.key) for r in issues.collect()} >= {("pages", "0"), ("pages", "2"), ("images", "3")}
    assert (out / "1891/txt/1.txt").read_text() == "A B\nx"
    assert (out / "1891/txt/3.txt").read_text() == "y"
    assert "<p><b>A</b><i>B</i></p>" in (out / "1891/html/1891_1.html").read_text()
    assert 'rdfs:label "Diary 1, T"^^xsd:string' in (out / "1891/ttl/diary/1891.ttl").read_text()
    lines = [x for f in (out / "triples/graph_kind=document").glob("*.txt") for x in f.read_text().splitlines()]
    assert len(lines) == 20


def test_publish_with_notes_dates_footnotes_and_store(spark, tmp_path, tmp_path_factory):
    for d in ("a", "b"):
        docx(tmp_path / f"{d}.docx", run("[p1]"), run("Monday August 7 1891."), run(f"The Mona Lisa in {d} ----f1---- stands"))
        (tmp_path / f"{d}.json").write_text(json.dumps({"sequences": [{"canvases": [{"images": [{"resource": {"@id": f"https://i.example.org/{d}"}}]}]}]}))
    out, store = tmp_path_factory.mktemp("out"), tmp_path_factory.mktemp("store")
    notes = spark.createDataFrame([(d, i, 1, "art", v, "Ann") for d in "ab" for i, v in enumerate(["mona lisa", "no such thing"])], "diary string, id int, page int, type string, value string, annotator string")
    foot = spark.createDataFrame([("f1", "a note", "x", ["l"])], "footnote_id string, fulltext string, type string, permalinks array<string>")
    where = spark.createDataFrame([("a", 0, 1, "POINT(1 2)", "Rome", "Q220")], "diary string, row_no int, page int, wkt string, name string, link_id string")
    days = spark.createDataFrame([(d, 1, "1891-08-07", 1) for d in "ab"], "diary string, day int, date string, page int")

    def send(method, uri, body):
        with open(store / "log", "a") as f:
            f.write(f"{method} {uri} {len(body or '')}\n")

    options = Options(default_date=dt.date(2025, 5, 26), date_profile="golden")
    issues = publish(spark, f"file://{tmp_path}", f"file://{tmp_path}/*.json", f"file://{out}", options, notes, foot, where, days, send).collect()
    assert sorted(r.diary for r in issues if r.stage == "notes" and r.key == "1") == ["a", "b"]
    for d in "ab":
        assert "mona lisa" in (out / f"{d}/ttl/annotation/0.ttl").read_text() and (out / f"{d}/ttl/day/1.ttl").exists()
        assert "1891-08-07" in (out / f"{d}/ttl/document/1.ttl").read_text()
    assert "POINT(1 2)" in (out / "a/ttl/document/1.ttl").read_text() and "POINT" not in (out / "b/ttl/document/1.ttl").read_text()
    assert any("a note" in f.read_text() for f in (out / "footnotes").rglob("*.csv"))
    log = (store / "log").read_text().splitlines()
    assert len(log) == 16 and len({x.split()[1] for x in log}) == 8 and all((x.split()[2] == "0") == x.startswith("DELETE") for x in log)


def test_damaged_and_encrypted_files_are_issues(spark, tmp_path):
    docx(tmp_path / "good.docx", run("text " * 50))
    with zipfile.ZipFile(tmp_path / "packed.docx", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", "<x>" + "abc" * 5000 + "</x>")
    raw = bytearray((tmp_path / "packed.docx").read_bytes())
    raw[60:75] = b"\xff" * 15
    (tmp_path / "packed.docx").write_bytes(raw)
    raw = bytearray((tmp_path / "good.docx").read_bytes())
    raw[6] |= 1  # marked as encrypted, in the file's header and in the directory
    raw[raw.index(b"PK\x01\x02") + 8] |= 1
    (tmp_path / "locked.docx").write_bytes(raw)
    assert sorted(r.diary for r in src.docx_issues(spark, f"file://{tmp_path}").collect()) == ["locked", "packed"]
    assert {r.diary for r in src.read_docx(spark, f"file://{tmp_path}").collect()} == {"good"}


@pytest.fixture
def web():
    """A server on this machine that answers GET with the bytes at `files` and records what else it is asked."""
    import http.server
    import threading

    seen, files = [], {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode()
            if self.command != "GET":
                seen.append((self.command, self.path, self.headers["Authorization"], body))
            found = files.get(self.path) if self.command == "GET" else b""
            self.send_response(404 if found is None or self.command == "DELETE" else 200)
            self.end_headers()
            self.wfile.write(found or b"")

        do_GET = do_POST = do_DELETE = answer

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen, files
    server.shutdown()


def test_command_line(spark, web, tmp_path, monkeypatch):
    """Download, notes, dates and upload to a store, by the options alone."""
    from quire import __main__ as command

    address, seen, files = web
    docx(tmp_path / "source.docx", run("[p1]"), run("Monday August 7 1891."), run("The Mona Lisa stands"))
    files["/1891.docx"] = (tmp_path / "source.docx").read_bytes()
    (tmp_path / "in/1891").mkdir(parents=True)
    (tmp_path / "in/1891/1891.json").write_text(json.dumps({"sequences": [{"canvases": [{"images": [{"resource": {"@id": "https://i.example.org/1"}}]}]}]}))
    (tmp_path / "notes.csv").write_text("Page #,Type,Entry,Paragraph #,Start,End,Annotator,Wikidata ID,WKT\n1,art,Mona Lisa,,,,Ann,Q1,\nx,art,Nothing,,,,Ann,,\n")
    (tmp_path / "keys.ini").write_text(f"[store]\nusername = u\npassword = p%q\nendpoint = {address}/graphs\n")
    monkeypatch.setattr(spark, "stop", lambda: None)
    command.main([
        "-d", "1891", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--notes", f"{tmp_path}/notes.csv", "--default-date", "2025-05-26", "--fetch", address + "/{diary}.docx",
        "-u", "--credentials-file", f"{tmp_path}/keys.ini",
    ])
    assert (tmp_path / "out/1891/ttl/annotation/1.ttl").exists()  # notes without a page come first
    assert sorted(m for m, *_ in seen) == ["DELETE"] * 3 + ["POST"] * 3
    assert {a for _, _, a, _ in seen} == {"Basic dTpwJXE="} and all("graph=https%3A%2F%2F" in path for _, path, _, _ in seen)
    assert any("Mona Lisa" in body for m, _, _, body in seen if m == "POST")
    with pytest.raises(OSError):
        src.download(f"{address}/none", f"{tmp_path}/none")
    assert not (tmp_path / "none").exists()


def test_files_go_to_mounted_folders_only(spark):
    from quire.sinks.files import write_named_texts

    with pytest.raises(ValueError, match="mounted"):
        write_named_texts(spark.createDataFrame([("x", "y")], "name string, body string"), "s3a://bucket/x")


def test_text_sources(spark, tmp_path):
    (tmp_path / "a b.txt").write_text("x\n\ny\n")
    root = f"file://{tmp_path}"
    assert [(r.key, r.text) for r in src.read_text_files(spark, root).collect()] == [("a b", "x\n\ny\n")]
    assert [(r.seq, r.text) for r in src.read_text_lines(spark, root).orderBy("seq").collect()] == [(0, "x"), (1, ""), (2, "y")]
    assert [r.text for r in src.read_text_lines(spark, root, keep_ends=True).orderBy("seq").collect()] == ["x\n", "\n", "y\n"]
    (tmp_path / "n.csv").write_text('Page #,Type,Entry,Paragraph #,Start,End,Annotator,Wikidata ID,WKT\n7,art,"a ""b""",1,2,3,X,Q1,P\n')
    assert src.read_notes(spark, f"{root}/n.csv").first()["Entry"] == 'a "b"'
    (tmp_path / "p.tsv").write_text("Type\tWikidata ID\tPage #\nperson\tQ\t80\n")
    assert src.read_people(spark, f"{root}/p.tsv").first()["Page #"] == 80
    (tmp_path / "l.csv").write_text("Page #,WKT,Entry,Wikidata ID\n7,P,n,Q1\n")
    assert src.read_locations(spark, f"{root}/l.csv", "d").first().link_id == "Q1"
    (tmp_path / "psw.ini").write_text("[local]\nusername=u\npassword=p%1\nendpoint=e\n")
    assert src.read_credentials(str(tmp_path / "psw.ini"), "local")["password"] == "p%1"
    assert src.exists(spark, f"{root}/p.tsv") and not src.exists(spark, f"{root}/none")


def test_stream(spark, tmp_path):
    texts = ["[1]", "x", "[2]", "y"]
    rows = [("d", i, t, [{"value": t, "type": "text", "start_position": 0, "end_position": len(t)}]) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, PARAGRAPHS).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    got = []
    q = stream_pages(read_paragraph_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/cp", lambda df, n: got.extend(df.collect()), once=True)
    deadline = time.time() + 60
    while q.isActive and time.time() < deadline:
        time.sleep(0.2)
    assert q.exception() is None
    assert {(r.page, r.text) for r in got} == {(1, "x"), (2, "y")}
