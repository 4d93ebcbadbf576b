"""User code in a process of its own, with a time limit for each call."""

from __future__ import annotations

import os
import pickle
import threading
import time
from collections.abc import Callable
from multiprocessing import get_context

from pyspark import cloudpickle


class CallTimeout(Exception):
    """A call gave no answer within its time."""


class CallLost(Exception):
    """The process of a call ended under it."""


def _serve(pipe, factory: bytes, parent: int) -> None:
    """Child side: build the callable at the first call, then answer calls until the parent is gone."""

    def watch() -> None:
        while os.getppid() == parent:
            time.sleep(1)
        os._exit(0)

    threading.Thread(target=watch, daemon=True).start()
    call = None
    while True:
        try:
            arguments = pipe.recv()
        except EOFError:
            os._exit(0)
        try:
            call = call or pickle.loads(factory)()
            answer = (True, call(*arguments))
        except Exception as failure:  # noqa: BLE001 - handed to the caller
            answer = (False, str(failure))
        try:
            pipe.send(answer)
        except Exception as failure:  # noqa: BLE001 - an answer that cannot be sent is a failed call
            pipe.send((False, f"answer not sent: {failure}"))


class Isolated:
    """A factory's callable behind a pipe. A call that hangs or takes its process along costs that call only.

    The process is made at the first call and kept for the next; one that hung or died is replaced at the next call, which
    builds the callable again. The time limit of a call includes building it.
    """

    def __init__(self, factory: Callable[[], Callable], timeout: float):
        self.factory, self.timeout = cloudpickle.dumps(factory), timeout
        self.process = self.pipe = None
        self.lock = threading.Lock()

    def _start(self) -> None:
        context = get_context("fork")
        self.pipe, theirs = context.Pipe()
        self.process = context.Process(target=_child, args=(self.pipe, theirs, self.factory, os.getpid()), daemon=True)
        self.process.start()
        theirs.close()

    def close(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = self.pipe = None

    def __call__(self, *arguments):
        with self.lock:
            if self.process is None or not self.process.is_alive():
                self.close()
                self._start()
            try:
                self.pipe.send(arguments)
                if not self.pipe.poll(self.timeout):
                    raise CallTimeout(f"no answer within {self.timeout:g} s")
                good, answer = self.pipe.recv()
            except CallTimeout:
                self.close()
                raise
            except (EOFError, OSError) as lost:
                self.process.join(1)
                code = self.process.exitcode
                self.close()
                raise CallLost(f"the process of the call ended with code {code}") from lost
        if not good:
            raise RuntimeError(answer)
        return answer


def _child(ours, theirs, factory: bytes, parent: int) -> None:
    ours.close()  # else the child would keep its own pipe open when the parent dies
    _serve(theirs, factory, parent)
