"""Run a model over the rows of a table.

A ``ModelRunner`` says how: ``start`` makes a client once per Python worker,
which later tasks of that worker use again, ``call`` answers a batch of inputs.
Batches run on a bounded number of threads, each call with a time limit and
retries; a batch that fails for good is asked row by row, so that one bad row
spoils no other. A row that fails has its error instead of a value; the run goes
on.

With a ``journal`` (a folder that all executors see) answers are written there as
they come, by row key and input. A task that is run again, because its executor
was lost, or a whole run that is started again, asks for the rest only: of the
calls made before at most those of one unwritten group are made twice."""
from __future__ import annotations

import io
import json
import sys
import threading
import time
import types
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import _located

# A journal file: the row's key as text, a hash of key and input, the answer as
# JSON.
JOURNAL = "asked bigint, answer string"


@dataclass(frozen=True)
class ModelRunner:
    call: Callable[[object, list], list]        # (client, inputs) -> outputs, in order
    start: Callable[[], object] = lambda: None  # a client for this worker
    stop: Callable[[object], None] | None = None
    batch_size: int = 1
    concurrency: int = 1                        # calls at a time in one task
    retries: int = 0
    timeout: float | None = None                # seconds for one call
    pause: float = 0.5                          # before the first retry; doubles
    journal: str | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self) -> None:
        if min(self.batch_size, self.concurrency) < 1 or self.retries < 0:
            raise ValueError("batch_size and concurrency must be >= 1, retries >= 0")


def client_of(runner: ModelRunner) -> object:
    """This worker's client. Functions reach a worker by value, so what outlasts
    a task is kept in a module of the process. Another runner's client is
    stopped when a new one is started: a worker holds one model at a time."""
    module = sys.modules.setdefault("_replyscope_worker", types.ModuleType("_replyscope_worker"))
    held = module.__dict__.setdefault("clients", {})
    if runner.name not in held:
        for other, client in held.values():
            if other.stop is not None:
                other.stop(client)
        held.clear()
        held[runner.name] = (runner, runner.start())
    return held[runner.name][1]


def _within(seconds: float | None, fn: Callable[[], list]) -> list:
    """``fn()``, or a TimeoutError; a call that hangs is left to itself."""
    if seconds is None:
        return fn()
    out: list = []

    def work() -> None:
        try:
            out.append((fn(), None))
        except BaseException as exc:  # noqa: BLE001 - handed to the caller
            out.append((None, exc))

    thread = threading.Thread(target=work, daemon=True)
    thread.start()
    thread.join(seconds)
    if not out:
        raise TimeoutError(f"no answer within {seconds:g} s")
    value, error = out[0]
    if error is not None:
        raise error
    return value


def _tried(runner: ModelRunner, client: object, inputs: list) -> list:
    for attempt in range(runner.retries + 1):
        try:
            out = list(_within(runner.timeout, lambda: runner.call(client, inputs)))
            if len(out) != len(inputs):
                raise ValueError(f"{len(out)} answers to {len(inputs)} inputs")
            return out
        except Exception:  # noqa: BLE001 - any failure may pass
            if attempt == runner.retries:
                raise
            time.sleep(runner.pause * 2 ** attempt)
    raise AssertionError("unreachable")


def ask(runner: ModelRunner, client: object, inputs: list) -> list[tuple[object, str | None]]:
    """``(output, None)`` or ``(None, error)`` per input of one batch."""
    try:
        return [(x, None) for x in _tried(runner, client, inputs)]
    except Exception as exc:  # noqa: BLE001 - one batch must not stop the run
        if len(inputs) == 1:
            return [(None, f"{type(exc).__name__}: {exc}")]
    return [ask(runner, client, [x])[0] for x in inputs]


# --------------------------------------------------------------------- journal
class _Journal:
    """Answers of one partition, a file per group of rows. A file appears under
    its name only when it is complete."""

    def __init__(self, uri: str, partition: int):
        from pyarrow import fs
        self.files, root = fs.FileSystem.from_uri(uri)
        self.folder = f"{root}/partition={partition}"
        self.files.create_dir(self.folder, recursive=True)

    def read(self) -> dict[int, str]:
        from pyarrow import fs
        known: dict[int, str] = {}
        for info in self.files.get_file_info(fs.FileSelector(self.folder)):
            if info.path.endswith(".parquet"):
                with self.files.open_input_file(info.path) as f:
                    table = pq.read_table(io.BytesIO(f.read()))
                known.update(zip(table["asked"].to_pylist(), table["answer"].to_pylist()))
        return known

    def write(self, answers: list[tuple[int, str]]) -> None:
        asked, answer = zip(*answers)
        part = f"{self.folder}/_{uuid.uuid4().hex}"
        with self.files.open_output_stream(part) as f:
            pq.write_table(pa.table({"asked": pa.array(asked, pa.int64()),
                                     "answer": pa.array(answer, pa.string())}), f)
        self.files.move(part, part.replace("/_", "/") + ".parquet")


def _uri(spark, path: str) -> str:
    """The folder with its scheme, as the executors are told."""
    files, target = _located(spark.sparkContext, path)
    return files.makeQualified(target).toString()


def _has_files(spark, path: str) -> bool:
    files, target = _located(spark.sparkContext, path)
    return files.exists(target) and bool(files.listStatus(target))


# ------------------------------------------------------------------------- run
def run_model(df: DataFrame, key_col: str, input_col: str, runner: ModelRunner,
              value_type: str = "string") -> DataFrame:
    """``key, value, error`` per row of ``df``. ``value_type`` is ``string`` or
    ``array<double>``."""
    key_type = df.schema[key_col].dataType.simpleString()
    schema = f"asked bigint, {key_col} {key_type}, value {value_type}, error string"
    rows = df.select(F.xxhash64(key_col, input_col).alias("asked"),
                     F.col(key_col).alias("key"), F.col(input_col).alias("input"))
    spark = df.sparkSession
    value_kind = pa.string() if value_type == "string" else pa.list_(pa.float64())
    uri = _uri(spark, runner.journal) if runner.journal else None
    group = runner.batch_size * runner.concurrency

    def plain(value: object, error: str | None) -> tuple[object, str | None]:
        """An answer of the wrong kind is an error, too."""
        if value is None:
            return None, error
        try:
            return (str(value) if value_type == "string" else [float(v) for v in value]), error
        except (TypeError, ValueError) as exc:
            return None, f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        journal = _Journal(uri, TaskContext.get().partitionId()) if uri else None
        known = {a: (json.loads(v), None) for a, v in journal.read().items()} if journal else {}
        client = client_of(runner)
        with ThreadPoolExecutor(runner.concurrency) as pool:
            for batch in batches:
                asked, inputs = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                answers = [known.get(a) for a in asked]
                todo = [i for i, x in enumerate(answers) if x is None]
                for at in range(0, len(todo), group):
                    part = todo[at:at + group]
                    cuts = [part[i:i + runner.batch_size]
                            for i in range(0, len(part), runner.batch_size)]
                    for cut, got in zip(cuts, pool.map(
                            lambda c: ask(runner, client, [inputs[i] for i in c]), cuts)):
                        for i, (value, error) in zip(cut, got):
                            answers[i] = plain(value, error)
                    done = [(asked[i], json.dumps(answers[i][0])) for i in part
                            if answers[i][1] is None]
                    if journal and done:
                        journal.write(done)
                values, errors = zip(*answers) if answers else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(values, value_kind),
                     pa.array(errors, pa.string())], ["asked", key_col, "value", "error"])

    if not (uri and _has_files(spark, runner.journal)):
        return rows.mapInArrow(run, schema).drop("asked")
    # A run before this one has answers: ask for the other rows only.
    done = spark.read.schema(JOURNAL).parquet(f"{runner.journal}/partition=*").groupBy("asked") \
        .agg(F.first("answer").alias("answer"))
    left = rows.join(done, "asked", "left_anti").select("asked", "key", "input")
    kept = rows.join(done, "asked").select(
        F.col("key").alias(key_col),
        (F.from_json(F.concat(F.lit('{"v":'), F.col("answer"), F.lit("}")), f"v {value_type}")["v"])
        .alias("value"), F.lit(None).cast("string").alias("error"))
    return left.mapInArrow(run, schema).drop("asked").unionByName(kept)
