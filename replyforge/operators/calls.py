"""Calling user code (model, fetcher, verifier) from Spark tasks, in Arrow batches.

The caller hands over a *factory*: a picklable function without arguments that builds the callable. It
runs once per Python worker, so a model is loaded once and not per batch. Filters and limits belong
in front of these operators; nothing is pushed through them. A task that is run again calls the model
again, so write the result to a table once (``sources.storage.materialize`` or an append keyed by id)
and keep speculative execution off.
"""

from __future__ import annotations

import sys
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import Empty, SimpleQueue
from threading import Thread
from types import ModuleType
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from replyforge.operators.call_log import CallLog, RowLog, Sample, ask_until_decided
from replyforge.operators.isolation import CallLost, CallTimeout, Isolated
from replyforge.operators.reply_text import find_json

# Driver side: a name for each factory, so that a worker knows it again in later tasks and jobs.
_NAMES: WeakKeyDictionary = WeakKeyDictionary()
# Worker side: how many factories' callables a worker keeps, the last ones used.
KEPT = 4


def _built() -> dict:
    """Store of the worker process. A module of its own, as code sent by value has new globals in every task."""
    return sys.modules.setdefault("_replyforge_built", ModuleType("_replyforge_built")).__dict__.setdefault("built", {})


def _name_of(factory: Callable) -> str:
    try:
        return _NAMES.setdefault(factory, uuid.uuid4().hex)
    except TypeError:  # not hashable: known for this one call only
        return uuid.uuid4().hex


def _build_once(name: str, factory: Callable, kept: int = KEPT, timeout: float | None = None):
    """The callable of a factory, built once per worker process; with a ``timeout`` in a process of its own."""
    built = _built()
    name = name if timeout is None else f"{name} {timeout}"
    if name in built:
        built[name] = built.pop(name)  # the last one used
        return built[name]
    while len(built) >= kept:
        old = built.pop(next(iter(built)))
        if isinstance(old, Isolated):
            old.close()
    built[name] = factory() if timeout is None else Isolated(factory, timeout)
    return built[name]


def _with_columns(df: DataFrame, added: list[tuple[str, T.DataType]]) -> tuple[DataFrame, T.StructType]:
    """Input without the columns to be added, and the schema of the result."""
    base = df.drop(*[name for name, _ in added])
    return base, T.StructType([*base.schema.fields, *[T.StructField(n, t) for n, t in added]])


def _append(batch: pa.RecordBatch, columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of exactly ``size`` rows and a last smaller one, however the rows arrive."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield _joined(held)
                held, rows = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _logged(run: Callable, log: str, size: int, names: list[str]) -> Callable:
    """A step's task that leaves out rows which are in ``log``, and writes what it adds to the others there at once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = RowLog(log)
        for batch in _slices(batches, size):
            missing = rows.missing(batch)
            if missing.num_rows:
                made = pa.Table.from_batches(list(run(iter([missing]))))
                rows.append(made.select(["_sample", *names]))
            yield pa.RecordBatch.from_arrays([pa.array([missing.num_rows], pa.int64())], ["asked"])

    return work


def _answers(call: Callable, prompts: list, past: list) -> tuple[list, list, list]:
    """Responses, errors and meta answers of one model call; a call that fails is an error on each of its rows."""
    try:
        answers, metas = call(prompts, [h or [] for h in past])
        if not len(answers) == len(metas) == len(prompts):
            raise ValueError(f"{len(answers)} responses for {len(prompts)} prompts")
    except Exception as failure:  # noqa: BLE001 - a failed call is data, not a failed job
        return [None] * len(prompts), [str(failure)] * len(prompts), [None] * len(prompts)
    errors = [a.get("error") if isinstance(a, dict) else None for a in answers]
    return [None if isinstance(a, dict) else a for a in answers], errors, [m or None for m in metas]


def infer_batch(
    df: DataFrame,
    predictor: Callable[[], Callable],
    batch_size: int = 1500,
    prompt: str = "prompt",
    history: str = "history",
    log: str | None = None,
    timeout: float | None = None,
    kept: int = KEPT,
) -> DataFrame:
    """Add ``response``, ``error`` and ``meta_response``.

    ``predictor()`` returns ``call(prompts, histories) -> (responses, metas)``. When the call raises, or
    answers with another number of rows, every row of that batch gets the error text and no
    response. A response may also be ``{"error": text}`` for a row of its own. ``log`` is for :mod:`replyforge.plans.once`.
    With a ``timeout`` the model lives in a process of its own, one per worker: a batch that takes more seconds, or whose
    call ends the process, gets the error on its rows, and the next batch a new process. A worker keeps the models of the
    ``kept`` factories it has used last.
    """
    has_history = history in df.columns
    names = ["response", "error", "meta_response"]
    base, schema = _with_columns(df, [(n, T.StringType()) for n in names])

    name = _name_of(predictor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _build_once(name, predictor, kept, timeout)
        for batch in _slices(batches, batch_size):
            prompts = batch.column(prompt).to_pylist()
            past = batch.column(history).to_pylist() if has_history else [None] * len(prompts)
            texts, errors, metas = _answers(call, prompts, past)
            added = [pa.array(v, pa.string()) for v in (texts, errors, metas)]
            yield _append(batch, added, names)

    if log is not None:
        narrow = base.select("_sample", prompt, *([history] if has_history else []))
        return narrow.mapInArrow(_logged(run, log, batch_size, names), "asked long")
    return base.mapInArrow(run, schema)


def ask_repeatedly(
    texts: DataFrame,
    predictor: Callable[[], Callable],
    log: str,
    n: int,
    max_rounds: int,
    batch_size: int = 1500,
    prompt: str = "prompt",
    history: str = "history",
    timeout: float | None = None,
    kept: int = KEPT,
) -> DataFrame:
    """Call the model for every sample until it has ``n`` responses or ``max_rounds`` errors; answers go to ``log``.

    ``texts`` has ``_sample`` (a number whose upper bits tell the part of the table it was written to), ``_ok`` and
    ``round`` (accepted answers and errors it starts with). A narrow step that has to run once, as an action: its rows
    say how many rows were asked and decided in each call. ``timeout`` and ``kept`` are those of :func:`infer_batch`.
    """
    has_history = history in texts.columns
    narrow = texts.select("_sample", "_ok", "round", prompt, *([history] if has_history else []))
    name = _name_of(predictor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _build_once(name, predictor, kept, timeout)

        def samples() -> Iterator[Sample]:
            for batch in batches:
                past = batch.column(history).to_pylist() if has_history else [None] * batch.num_rows
                columns = [batch.column(c).to_pylist() for c in ("_sample", prompt, "_ok", "round")]
                for number, text, ok, failed, before in zip(*columns, past, strict=True):
                    yield Sample(number, text, before, ok, failed)

        for asked, decided in ask_until_decided(samples(), lambda p, h: _answers(call, p, h)[:2], CallLog(log), n, max_rounds, batch_size):
            yield pa.RecordBatch.from_arrays([pa.array([asked], pa.int64()), pa.array([decided], pa.int64())], ["asked", "decided"])

    return narrow.mapInArrow(run, "asked long, decided long")


def ask_for_json(
    df: DataFrame,
    predictor: Callable[[], Callable[[str], str]],
    keys: tuple[str, ...] = ("Difficulty", "Rationale"),
    required: str = "Difficulty",
    tries: int = 3,
    delay: float = 1.5,
    threads: int = 8,
    prompt: str = "prompt",
    log: str | None = None,
    kept: int = KEPT,
) -> DataFrame:
    """Add ``status``, ``data`` (JSON text), ``response`` and ``error``: call, dig out the JSON, check it.

    A call that fails and a reply without usable JSON are both tried again after ``delay`` seconds. After
    the last try the status is ``failed`` with no data and no response. Rows without a prompt are not
    sent and stay without a status. ``log`` is for :mod:`replyforge.plans.once`.
    """
    names = ["status", "data", "response", "error"]
    base, schema = _with_columns(df, [(n, T.StringType()) for n in names])

    def attempt(call: Callable[[str], str], text: str | None) -> tuple:
        if text is None:
            return None, None, None, None
        problem = ""
        for left in range(tries - 1, -1, -1):
            try:
                reply = call(text)
                found = find_json(reply, keys, required)
                return "success", found, reply, None
            except Exception as failure:  # noqa: BLE001
                problem = str(failure)
                if left:
                    time.sleep(delay)
        return "failed", None, None, problem

    name = _name_of(predictor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _build_once(name, predictor, kept)
        with ThreadPoolExecutor(threads) as pool:
            for batch in _slices(batches, 1000):
                results = list(pool.map(lambda text: attempt(call, text), batch.column(prompt).to_pylist()))
                yield _append(batch, [pa.array(c, pa.string()) for c in zip(*results)], names)

    if log is not None:
        return base.select("_sample", prompt).mapInArrow(_logged(run, log, 10 * threads, names), "asked long")
    return base.mapInArrow(run, schema)


def fetch(
    plan: DataFrame,
    fetcher: Callable[[], Callable[[str, str], int]],
    partitions: int | None = None,
    threads: int = 32,
    timeout: float = 30.0,
    tries: int = 1,
    delay: float = 1.5,
    backoff: float = 1.5,
    rows_per_task: int = 2_000,
    kept: int = KEPT,
) -> DataFrame:
    """Add ``success``, ``skipped``, ``size`` and ``error`` to a plan with ``url`` and ``target``.

    ``fetcher()`` returns ``call(url, target) -> size``. A row never raises; an item slower than
    ``timeout`` seconds from its start, all its tries together, counts as failed; what its thread still does is not
    seen, so a fetcher should write to a temporary name first. Rows are spread by the hash of their target, so the files of
    one large repository do not end up in one task. Without ``partitions`` the plan's rows are counted first, and
    there is a task for every ``rows_per_task`` of them, at least one per core.
    """
    names = ["success", "skipped", "size", "error"]
    kinds = [T.BooleanType(), T.BooleanType(), T.LongType(), T.StringType()]
    # A stated number: adaptive execution would merge these short rows into few tasks, and few downloads at a time.
    pieces = partitions or max(plan.sparkSession.sparkContext.defaultParallelism, -(-plan.count() // rows_per_task))
    base, schema = _with_columns(plan.repartition(pieces, "target"), list(zip(names, kinds)))

    def try_call(call: Callable[[str, str], int], url: str, target: str) -> int:
        for turn in range(tries - 1):
            try:
                return call(url, target)
            except Exception:  # noqa: BLE001
                time.sleep(delay * backoff**turn)
        return call(url, target)

    def outcomes(call: Callable[[str, str], int], pairs: list[tuple[str, str]]) -> list[tuple]:
        """One result per pair; ``threads`` items are under way at any time, each with its own deadline."""
        results: list = [None] * len(pairs)
        ready: SimpleQueue = SimpleQueue()
        deadlines: dict[int, float] = {}
        following = 0

        def work(place: int) -> None:
            try:
                ready.put((place, (True, False, int(try_call(call, *pairs[place])), None)))
            except Exception as failure:  # noqa: BLE001
                ready.put((place, (False, False, 0, str(failure))))

        while following < len(pairs) or deadlines:
            while following < len(pairs) and len(deadlines) < threads:
                deadlines[following] = time.monotonic() + timeout
                # A thread of its own, so that one that hangs keeps no other item waiting.
                Thread(target=work, args=(following,), daemon=True).start()
                following += 1
            try:
                place, result = ready.get(timeout=max(0.0, min(deadlines.values()) - time.monotonic()))
                if place in deadlines:  # else it is late and has been reported
                    results[place] = result
                    del deadlines[place]
            except Empty:
                now = time.monotonic()
                for place in [p for p, end in deadlines.items() if end <= now]:
                    results[place] = (False, False, 0, f"no answer within {timeout:g} s")
                    del deadlines[place]
        return results

    name = _name_of(fetcher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _build_once(name, fetcher, kept)
        for batch in _slices(batches, 1000):
            pairs = list(zip(batch.column("url").to_pylist(), batch.column("target").to_pylist()))
            cols = list(zip(*outcomes(call, pairs)))
            yield _append(
                batch,
                [pa.array(cols[0], pa.bool_()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                names,
            )

    return base.mapInArrow(run, schema)


def _verdicts(call: Callable, codes: list, proofs: list) -> list[tuple[bool, str | None]]:
    """One verdict per proof; a proof that the verifier does not survive has failed."""
    try:
        found = call(codes, proofs)
    except (CallTimeout, CallLost) as problem:
        if len(codes) <= 1:
            return [(False, str(problem))] * len(codes)
        half = len(codes) // 2
        return _verdicts(call, codes[:half], proofs[:half]) + _verdicts(call, codes[half:], proofs[half:])
    if len(found) != len(codes):
        raise ValueError(f"{len(found)} verdicts for {len(codes)} rows")
    return list(found)


def verify(
    df: DataFrame,
    verifier: Callable[[], Callable[[list[str], list[str]], list[tuple[bool, str | None]]]],
    batch_size: int = 256,
    code: str = "lean_code",
    proof: str = "response",
    timeout: float | None = None,
    kept: int = KEPT,
) -> DataFrame:
    """Add ``success`` and ``error_messages``.

    ``verifier()`` returns ``call(codes, proofs) -> [(success, messages), ...]``. A raising verifier, or one
    that answers with another number of rows, fails the job: missing verdicts must not pass for failures. With a
    ``timeout`` the verifier lives in a process of its own, as in :func:`infer_batch`; a batch that takes more seconds, or
    whose call ends the process, is cut into halves until the proofs that do so are found. These have failed, with
    the reason as their message.
    """
    names = ["success", "error_messages"]
    base, schema = _with_columns(df, [("success", T.BooleanType()), ("error_messages", T.StringType())])

    name = _name_of(verifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _build_once(name, verifier, kept, timeout)
        for batch in _slices(batches, batch_size):
            verdicts = _verdicts(call, batch.column(code).to_pylist(), batch.column(proof).to_pylist())
            added = [pa.array([v[0] for v in verdicts], pa.bool_()), pa.array([v[1] for v in verdicts], pa.string())]
            yield _append(batch, added, names)

    return base.mapInArrow(run, schema)
