"""How often models are asked: once a task, wherever the rows go afterwards."""

import json
import os
import sys
import threading
import uuid
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.catalog import CLIENT
from corpusloom.models import HttpClient, Sampling, respond
from corpusloom.operators import edit, filters, generate
from corpusloom.operators import similarity as S
from corpusloom.operators import tasks as T

# Workers can't import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = "hf_row_id string, document_id string, document_name string, chunk_index int, chunk_type string, text string, seq long, embedding array<double>"
CFG = T.CorpusConfig(min_chars=5)


@dataclass(frozen=True)
class Counting:
    """The scripted model; each call leaves a file."""

    folder: str

    def complete(self, system, user, sampling):
        open(f"{self.folder}/{uuid.uuid4().hex}", "w").close()
        return CLIENT.complete(system, user, sampling)

    @property
    def calls(self):
        return len(os.listdir(self.folder))


@pytest.fixture
def client(tmp_path):
    (tmp_path / "calls").mkdir()
    return Counting(str(tmp_path / "calls"))


@pytest.fixture
def chunks(rows):
    return rows(CHUNK, *[(f"c{i}", f"d{i % 3}", f"D{i % 3}", i, "content", f"text number {i} of this corpus", i, [float(i % 5), 1.0, float(i % 7)]) for i in range(10)]).repartition(3)


JOBS = [S.Job("above", threshold=-1.0)]


@pytest.mark.parametrize(
    "make, calls",
    [
        (lambda c, m: generate.qa_pairs(c, m, CFG), 10),
        (lambda c, m: generate.qa_styled(c, m, ("easy", "hard"), CFG), 20),
        (lambda c, m: generate.qa_local(c, m, ("easy",), n=2), 7),
        (lambda c, m: generate.rewrites(c, m, ("summary",), CFG), 20),
        (lambda c, m: generate.personas(c, m, ("urgente",), CFG), 20),
        (lambda c, m: edit.rewrite_answers(generate.qa_styled(c, m, ("easy",), CFG), m, number=True), 20),
        (lambda c, m: edit.expand(filters.qa_filter(generate.qa_styled(c, m, ("easy",), CFG), number=True), m, ("easy",), turns=(2, 2), number=True), 50),
        (lambda c, m: edit.judge(edit.expand(generate.qa_styled(c, m, ("easy",), CFG), m, ("easy",), turns=(1, 1)), m, number=True), 40),
    ],
)
def test_one_call_a_task(chunks, client, make, calls):
    found = make(chunks, client)
    assert found.count() > 0 and len(found.orderBy(F.desc("id")).collect()) == found.count()
    assert client.calls == calls


def test_one_call_a_group(chunks, client):
    found = generate.qa_similar(chunks, client, JOBS, ("easy",), num_chunks=2)
    assert found.count() == len(found.orderBy("id").collect()) == client.calls > 0


def test_nothing_is_asked_for_tasks_and_estimates(chunks, client):
    assert generate.estimate(T.style_tasks(chunks, ["easy"], CFG)).first()[0] == 10
    assert client.calls == 0


@dataclass(frozen=True)
class Failing(Counting):
    """Fails for odd prompts at first."""

    def complete(self, system, user, sampling):
        first = not os.path.exists(f"{self.folder}/../failed-{user}")
        super().complete(system, user, sampling)
        if first and int(user) % 2:
            open(f"{self.folder}/../failed-{user}", "w").close()
            raise OSError("no answer")
        return f"answer {user}"


def test_store_keeps_answers(rows, tmp_path):
    (tmp_path / "calls").mkdir()
    client = Failing(str(tmp_path / "calls"))
    tasks = rows("id long, response string, _user string", *[(i, "old", "mine") for i in range(6)], (6, "old", "mine")).withColumn("prompt", F.least("id", F.lit(5)).cast("string"))
    ask = lambda: {r["id"]: (r["response"], r["_user"]) for r in respond(tasks, client, "", F.col("prompt"), store=str(tmp_path / "store")).collect()}
    first = ask()
    assert client.calls == 6 and first[0] == ("answer 0", "mine") and first[5] == (None, "mine") == first[6]
    # Only the failed ones are asked again, equal prompts once.
    second = ask()
    assert client.calls == 9 and second[5] == ("answer 5", "mine") == second[6] and ask() == second and client.calls == 9


def test_http_client_asks_for_the_model_once_and_tries_again():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def answer(self, body, status=200):
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self):
            seen.append(("models", self.headers["Authorization"]))
            self.answer({"data": [{"id": "m1"}]})

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            text = body["messages"][-1]["content"]
            seen.append((text, body["model"]))
            if text == "refused":
                self.answer({}, 400)
            elif text == "busy" and [t for t, _ in seen].count("busy") < 3:
                self.answer({}, 503)
            else:
                self.answer({"choices": [{"message": {"content": f" {text}! "}}]})

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = HttpClient(f"http://127.0.0.1:{server.server_port}/v1", "key-1", pause=0.01)
        assert client.complete("", "hello", Sampling()) == "hello!" and client.complete("s", "busy", Sampling()) == "busy!"
        with pytest.raises(OSError):
            client.complete("", "refused", Sampling())
        names = [n for n, _ in seen]
        assert names.count("models") == 1 and seen[0][1] == "Bearer key-1" and names.count("busy") == 3 and names.count("refused") == 1
    finally:
        server.shutdown()


def test_many_prompts_keep_their_order_and_only_wanted_columns(spark):
    from pyspark.sql import functions as F

    from corpusloom.models import PROMPTS, ScriptedClient, Sampling, respond

    rows = spark.range(2 * PROMPTS + 7, numPartitions=1).select("id", F.col("id").cast("string").alias("text"), F.lit("wide").alias("copy"))
    asked = respond(rows, ScriptedClient(), "", F.col("text"), Sampling(), keep=["id"])
    assert asked.columns == ["id", "response"]
    assert {r["id"]: r["response"] for r in asked.collect()} == {i: ScriptedClient().complete("", str(i), Sampling()) for i in range(2 * PROMPTS + 7)}
