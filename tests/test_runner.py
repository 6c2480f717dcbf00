"""The model runner: set-up, batches, retries, limits, a journal."""
import os
import sys
import tempfile
import threading
import time
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from replyscope.operators.dense import encode_texts
from replyscope.operators.llm import complete_table
from replyscope.operators.runner import ModelRunner, _tried, ask, client_of, run_model

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers don't see this file


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="replyscope-runner-", dir="/tmp")


def note(path, text):
    with open(path, "a") as f:
        f.write(f"{text}\n")


def lines(path):
    with open(path) as f:
        return f.read().split()


def test_set_up_once_per_worker(spark, folder):
    log = os.path.join(folder, "started")

    def start():
        note(log, os.getpid())
        return "client"

    runner = ModelRunner(lambda client, xs: [f"{client}:{x}:{os.getpid()}" for x in xs], start,
                         batch_size=3)
    df = spark.range(400).repartition(40).select("id", F.col("id").cast("string").alias("t"))
    for _ in range(2):                                  # a second job finds the clients
        out = run_model(df, "id", "t", runner).collect()
        assert len(out) == 400 and all(r.value.startswith(f"client:{r.id}:") for r in out)
    pids = lines(log)
    assert len(pids) == len(set(pids))
    assert {r.value.split(":")[2] for r in out} <= set(pids)


def test_another_runner_stops_the_client_before_it():
    stopped = []
    a = ModelRunner(lambda c, xs: xs, lambda: "a", stopped.append)
    b = ModelRunner(lambda c, xs: xs, lambda: "b", stopped.append)
    assert [client_of(a), client_of(a), client_of(b), client_of(b)] == ["a", "a", "b", "b"]
    assert stopped == ["a"]


def test_retries_and_bad_rows():
    calls = Counter()

    def flaky(_, xs):
        calls[tuple(xs)] += 1
        if "bad" in xs:
            raise ValueError("no")
        if calls[tuple(xs)] < 2:
            raise ConnectionError("later")
        return [x.upper() for x in xs]

    runner = ModelRunner(flaky, retries=1, pause=0.0)
    assert ask(runner, None, ["a", "b"]) == [("A", None), ("B", None)]
    got = ask(runner, None, ["a", "bad", "c"])
    assert got == [("A", None), (None, "ValueError: no"), ("C", None)]
    assert calls["a", "bad", "c"] == calls["bad",] == 2
    short = ModelRunner(lambda _, xs: xs[1:])
    assert ask(short, None, ["a", "b"])[0][1].startswith("ValueError: 0 answers")
    with pytest.raises(ValueError):
        ModelRunner(flaky, batch_size=0)


def test_a_call_that_hangs_is_given_up():
    began = time.time()
    runner = ModelRunner(lambda _, xs: time.sleep(30), timeout=0.2, retries=1, pause=0.0)
    (value, error), = ask(runner, None, ["x"])
    assert value is None and error.startswith("TimeoutError") and time.time() - began < 5
    assert _tried(ModelRunner(lambda _, xs: xs, timeout=5.0), None, [1]) == [1]


def test_calls_at_a_time_are_bounded(spark):
    def peak(_, xs):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
        time.sleep(0.02)
        with lock:
            state["now"] -= 1
            return [str(state["most"])] * len(xs)

    # Made in the worker: locks don't travel.
    def start():
        global lock, state
        lock, state = threading.Lock(), {"now": 0, "most": 0}

    runner = ModelRunner(peak, start, batch_size=2, concurrency=3)
    df = spark.range(0, 60, 1, 1).select("id", F.lit("x").alias("t"))
    seen = max(int(r.value) for r in run_model(df, "id", "t", runner).collect())
    assert 1 < seen <= 3


def test_a_lost_task_pays_for_no_call_twice(spark, folder):
    log, journal = os.path.join(folder, "calls"), os.path.join(folder, "journal")
    flag = os.path.join(folder, "fail")
    note(flag, "x")

    def call(_, xs):
        if "37" in xs and os.path.exists(flag):
            os.remove(flag)
            raise SystemExit("worker lost")             # not an answer's error: ends the task
        for x in xs:
            note(log, x)
        return [f"re:{x}" for x in xs]

    runner = ModelRunner(call, batch_size=5, journal=journal)
    df = spark.range(0, 100, 1, 4).select("id", F.col("id").cast("string").alias("t"))
    with pytest.raises(Exception):
        run_model(df, "id", "t", runner).collect()
    before = Counter(lines(log))
    assert before and max(before.values()) == 1
    out = {r.id: r.value for r in run_model(df, "id", "t", runner).collect()}
    assert out == {i: f"re:{i}" for i in range(100)}
    # A call in flight when the job ended may come again, a written one may not.
    written = {r.answer for r in spark.read.parquet(f"{journal}/partition=*").collect()}
    assert len(written) == 100
    again = [k for k, n in Counter(lines(log)).items() if n > 1]
    assert len(again) <= 4 * 5
    # Nothing is left to ask; another text under the same key is.
    size = len(lines(log))
    assert run_model(df, "id", "t", runner).count() == 100 and len(lines(log)) == size
    other = df.withColumn("t", F.when(F.col("id") == 3, F.lit("new")).otherwise(F.col("t")))
    out = {r.id: r.value for r in run_model(other, "id", "t", runner).collect()}
    assert out[3] == "re:new" and out[4] == "re:4" and len(lines(log)) == size + 1


def test_a_task_run_again_reads_its_journal(folder):
    from replyscope.operators.runner import _Journal
    journal = _Journal(f"file://{folder}", 7)
    assert journal.read() == {}
    journal.write([(1, '"a"'), (2, "null")])
    journal.write([(3, '"c"')])
    with open(os.path.join(folder, "partition=7", "_half"), "w") as f:
        f.write("not finished")
    assert _Journal(f"file://{folder}", 7).read() == {1: '"a"', 2: "null", 3: '"c"'}
    assert _Journal(f"file://{folder}", 8).read() == {}


def test_runner_as_model_and_encoder(spark, folder):
    df = spark.createDataFrame([(1, "hello"), (2, "boom"), (None, None)], "id long, t string")

    def call(prefix, xs):
        if "boom" in xs:
            raise RuntimeError("model unavailable")
        return [f"{prefix}{x}" for x in xs]

    model = ModelRunner(call, lambda: ">", batch_size=8)
    got = {r.id: (r.completion, r.backend, r.error) for r in complete_table(
        df, "id", "sys", "t", model, "m", 0.0, 10, "sorry").collect()}
    assert got == {1: (">hello", "m", None), None: (">None", "m", None),
                   2: ("sorry", "fallback", "RuntimeError: model unavailable")}
    lengths = ModelRunner(lambda _, xs: np.array([[len(x), 1.0] for x in xs]), batch_size=2,
                          journal=os.path.join(folder, "vectors"))
    for _ in range(2):                                  # asked, then from the journal
        rows = {r.id: r.vec for r in encode_texts(df, "id", "t", lengths).collect()}
        assert np.allclose(rows[1], np.array([5.0, 1.0]) / np.sqrt(26))
        assert np.allclose(rows[None], np.array([1.0, 1.0]) / np.sqrt(2))
    with pytest.raises(Exception, match="text not encoded"):
        encode_texts(df, "id", "t", ModelRunner(call)).collect()
