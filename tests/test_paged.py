"""The paged source against a local server that fails now and then."""

import datetime
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from somatiq.operators import forms
from somatiq.sources import paged

T0 = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)


def item(i, answers=True):
    return {"token": f"t{i:04}", "submitted_at": (T0 + datetime.timedelta(minutes=i)).isoformat().replace("+00:00", "Z"), "hidden": {"id": f"u{i % 7}"}, "answers": [{"n": i}] if answers else None}


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        items = [item(i, i % 5 > 0) for i in range(730)]
        asked, fail_every = [], 4

        def do_GET(self):  # noqa: N802
            cls = type(self)
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            cls.asked.append(q)
            if cls.fail_every and len(cls.asked) % cls.fail_every == 0:
                self.send_error(503)
                return
            since, until = paged._time(q["since"]), paged._time(q["until"])
            found = [x for x in reversed(cls.items) if since <= paged._time(x["submitted_at"]) <= until]
            if "before" in q:
                found = [x for x in found if x["token"] < q["before"]]
            body = json.dumps({"items": found[: int(q["page_size"])]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    s.handler, s.url = Handler, f"http://127.0.0.1:{s.server_address[1]}/responses"
    yield s
    s.shutdown()


def test_batches_walk_pages_in_parallel(spark, server):
    paged.register(spark)
    read = lambda **o: spark.read.format("paged_responses").options(url=server.url, pagesize=100, **o).load()
    df = read(since=T0.isoformat(), until=(T0 + datetime.timedelta(minutes=700)).isoformat(), partitions=3)
    rows = df.collect()
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.token for r in rows) == [f"t{i:04}" for i in range(700)]  # the end does not belong to the span
    assert sum(r.answers is None for r in rows) == 140 and json.loads(next(r.hidden for r in rows if r.token == "t0008"))["id"] == "u1"
    assert max(int(q["page_size"]) for q in server.handler.asked) == 100
    assert forms.unique_responses(read(until="2021-01-01").unionByName(df)).count() == 584
    assert read(since="2030-01-01", until="2031-01-01").count() == 0


def test_errors_that_repeats_do_not_mend(spark, server):
    paged.register(spark)
    server.handler.fail_every = 1
    with pytest.raises(Exception, match="503"):
        spark.read.format("paged_responses").options(url=server.url, until="2021-01-01", retries=1).load().count()


def test_streams_go_on_where_they_stopped(spark, server, tmp_path):
    paged.register(spark)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(minutes):
        until = (T0 + datetime.timedelta(minutes=minutes)).isoformat()
        stream = spark.readStream.format("paged_responses").options(url=server.url, pagesize=100, until=until).load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return sorted(r.token for r in spark.read.parquet(out).select("token").collect())

    assert run(300) == [f"t{i:04}" for i in range(300)]
    server.handler.asked.clear()
    server.handler.items = server.handler.items + [item(i) for i in range(730, 760)]
    assert run(760) == [f"t{i:04}" for i in range(760)]
    assert all(paged._time(q["since"]) >= T0 + datetime.timedelta(minutes=300) for q in server.handler.asked)
