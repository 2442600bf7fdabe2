"""One run at a time, also after a crash: a lease with an expiry, a heartbeat and a fencing number.

A lease of the shared store is a folder of epochs.  Taking it means making the next epoch's file, which the file system's exclusive
create gives to one contender only (HDFS and local folders do; an object store must be set to conditional creates).
The holder's heartbeat renews the epoch every third of ``seconds``; a lease that has been released, or not renewed for
``seconds``, may be taken by the next epoch.  Ages are differences of the file system's own times, so the
machines' clocks don't matter.

The epoch's number fences: while a lease is held, each commit of the store asks first whether its epoch is still the newest,
so the late write of a run that was taken for dead is refused.  Should its commit come between that question and a
successor's first write, it is an ordinary commit before it: the successor's own commit of the table, made from an older
version, loses and starts again.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from tidemark.operators.store import Store

SECONDS = 600.0
log = logging.getLogger(__name__)


class Held(RuntimeError):
    """Another run has the lease."""


class Fenced(RuntimeError):
    """The lease has gone to a later run; nothing more may be written."""


class Lease:
    def __init__(self, store: Store, name: str, seconds: float = SECONDS) -> None:
        self.store, self.name, self.seconds, self.epoch = store, name, seconds, 0
        self._over = threading.Event()

    # -- files ---------------------------------------------------------------------------
    def _at(self, file: str = ""):
        return self.store._path(f"_{self.name}.lease", *([file] if file else []))

    def _written(self, file: str, overwrite: bool = True) -> int:
        """Write a file and return the file system's time of it."""
        fs = self.store._fs()
        out = fs.create(self._at(file), overwrite)
        out.write(bytearray(file.encode()))
        out.close()
        return fs.getFileStatus(self._at(file)).getModificationTime()

    def _files(self) -> dict[str, int]:
        fs = self.store._fs()
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(self._at())} if fs.exists(self._at()) else {}

    @staticmethod
    def _newest(files: dict[str, int]) -> int:
        return max((int(f[1:]) for f in files if f[0] == "e" and f[1:].isdigit()), default=0)

    # -- the lease -----------------------------------------------------------------------
    def take(self) -> int:
        """The epoch that now is ours; raises Held while another run renews its own."""
        probe = f"probe-{uuid.uuid4().hex}"
        now = self._written(probe)
        self.store._fs().delete(self._at(probe), False)
        files = self._files()
        newest = self._newest(files)
        if newest and f"e{newest}.done" not in files:
            age = (now - max(files[f"e{newest}"], files.get(f"e{newest}.beat", 0))) / 1000
            if age < self.seconds:
                raise Held(f"a {self.name} run is under way: epoch {newest} was renewed {age:.0f} s ago")
            log.warning("%s: epoch %d was not renewed for %.0f s and is taken over", self.name, newest, age)
        try:
            self._written(f"e{newest + 1}", overwrite=False)
        except Exception as e:
            raise Held(f"another {self.name} run was faster to epoch {newest + 1}") from e
        self.epoch = newest + 1
        for file in files:  # what older epochs left
            if file.partition(".")[0] != f"e{newest}" and file[0] == "e":
                self.store._fs().delete(self._at(file), False)
        return self.epoch

    def renew(self) -> None:
        self.check()
        self._written(f"e{self.epoch}.beat")

    def check(self) -> None:
        newest = self._newest(self._files())
        if newest != self.epoch:
            raise Fenced(f"{self.name}: epoch {self.epoch} has been followed by {newest}")

    def release(self) -> None:
        if self._newest(self._files()) == self.epoch:
            self._written(f"e{self.epoch}.done")

    def _beat(self) -> None:
        while not self._over.wait(self.seconds / 3):
            try:
                self.renew()
            except Fenced:
                return  # the next commit says so
            except Exception as e:  # tried again at the next beat
                log.warning("%s: the lease wasn't renewed: %s", self.name, e)

    @contextmanager
    def held(self) -> Iterator[int]:
        """The lease for what runs inside; the store's commits are fenced by it."""
        epoch = self.take()
        beat = threading.Thread(target=self._beat, name=f"{self.name}-lease", daemon=True)
        before, self.store.guard = self.store.guard, self.check
        beat.start()
        try:
            yield epoch
        finally:
            self._over.set()
            beat.join()
            self.store.guard = before
            self.release()
