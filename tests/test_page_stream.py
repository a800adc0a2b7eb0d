"""A stream of pages that takes up where it stopped."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from moothall.streaming import pages


@pytest.fixture(scope="module")
def server():
    asked = Counter()

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            self.send_response(500 if self.path == "/bad" else 200)
            self.send_header("Content-Length", "2")
            self.end_headers()
            self.wfile.write(b"ok")

        def log_message(self, *args):
            pass

    it = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=it.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{it.server_port}", asked
    it.shutdown()


def test_a_restarted_run_fetches_what_is_new(spark, server, tmp_path):
    base, asked = server
    queue = tmp_path / "queue"
    queue.mkdir()
    spark.dataSource.register(pages.PageStream)

    def once():
        stream = spark.readStream.format("page_stream").options(queue=str(queue), tasks=3, retries=1).load()
        query = pages.run(stream, str(tmp_path / "pages"), str(tmp_path / "state"))
        assert query.awaitTermination(120) is not False
        return spark.read.schema(pages.PAGES).parquet(str(tmp_path / "pages"))

    (queue / "2024-01-01.tsv").write_text("".join(f"C{i % 3}\t{base}/a{i}\n" for i in range(10)) + f"C9\t{base}/bad\n\nnothing\n")
    rows = once()
    assert rows.count() == 11 and rows.where("council_id = 'C9'").first()["status"] == 500
    assert once().count() == 11 and set(asked.values()) == {1}
    (queue / "2024-01-02.tsv").write_text(f"C0\t{base}/b0\nC1\t{base}/a1\n")
    assert once().count() == 13 and asked["/b0"] == 1 and asked["/a1"] == 2 and sum(asked.values()) == 13
    runs = {r["council_id"]: (r["pages"], r["failed"]) for r in pages.last_runs(once()).collect()}
    assert runs == {"C0": (5, 0), "C1": (4, 0), "C2": (3, 0), "C9": (1, 1)}


def test_last_runs_are_state_of_a_stream(spark, server, tmp_path):
    base, _ = server
    queue = tmp_path / "queue"
    queue.mkdir()
    spark.dataSource.register(pages.PageStream)
    for day in (1, 2):
        (queue / f"{day}.tsv").write_text(f"C0\t{base}/s{day}\nC1\t{base}/s{day}\n")
        stream = spark.readStream.format("page_stream").options(queue=str(queue), tasks=2).load()
        query = pages.last_runs(stream).writeStream.format("memory").queryName(f"runs{day}").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
        query.awaitTermination(120)
        assert {r["council_id"]: r["pages"] for r in spark.table(f"runs{day}").collect()} == {"C0": day, "C1": day}
