"""Run control on the driver: a deadline, one writer at a time, and the gate before writes."""

from __future__ import annotations

import contextlib
import fcntl
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass, field


class RunStopped(Exception):
    pass


@dataclass
class RunControl:
    """Seconds a run may take, and how many of them are kept for its writes."""

    seconds: float = 1_200
    reserve: float = 300
    clock: object = time.monotonic
    started: float = field(init=False)

    def __post_init__(self) -> None:
        self.seconds = max(60, self.seconds)
        self.reserve = min(1_200, max(60, self.reserve))
        self.started = self.clock()

    def left(self) -> float:
        return self.seconds - (self.clock() - self.started)

    def check(self, writes: bool = False) -> None:
        """Raises once the time is over, or before writes once too little is left for them."""
        if self.left() <= (self.reserve if writes else 0):
            raise RunStopped("too little time is left for writes" if writes else "the run is out of time")


@contextlib.contextmanager
def exclusive(path: str) -> Iterator[None]:
    """Holds a lock file that is no link and only its owner may read; a second holder fails at once."""
    fd = os.open(path, os.O_RDWR | os.O_CREAT | os.O_NOFOLLOW, 0o600)
    try:
        try:
            fcntl.flock(fd, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise RunStopped(f"another run holds {path}") from None
        yield
    finally:
        os.close(fd)


def may_write(dry_run: bool, reviewed: bool, scheduled: bool, schema_only: bool = False) -> bool:
    """Writes need a run that is not dry, in a context that was reviewed; a schema change alone must not be scheduled."""
    return not dry_run and reviewed and not (schema_only and scheduled)
