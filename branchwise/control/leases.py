"""How many calls of a hosted model may run at once, over all runs that share a work folder."""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from branchwise.control.config import ConfigError, sha256
from branchwise.control.files import Files

#: Seconds after which a lease that its run has not renewed may be taken over; it is renewed four times as often.
STALE = 120.0


class Leases:
    """Slots of one model, a file each, of which one run alone can make each.

    A run renews its files while it lives. One whose driver died leaves them to
    others after `stale` seconds; so a run that finds one of its own taken has
    stood still for that long, and ends before its next level. Times are the
    file system's alone.
    """

    def __init__(self, files: Files, folder: str, subject: list[str], stale: float = STALE):
        self.files, self.folder, self.stale = files, f"{folder.rstrip('/')}/leases/{sha256(subject)[:16]}", stale
        self.token, self.held, self.lost = uuid.uuid4().hex, [], threading.Event()

    def take(self, slots: int) -> int:
        """Takes what is free of slots 0 .. slots - 1; how many are now held."""
        now = self.files.touch(f"{self.folder}/clock-{self.token}")
        for k in range(slots):
            name = f"{self.folder}/{k}"
            made = self.files.modified(name)
            # The time names what is taken over: of several that find it stale, one makes the mark, and none deletes what came after.
            if made is not None and now - made > self.stale and self.files.create(f"{name}.stale-{round(1000 * made)}", self.token):
                self.files.delete(name)
            if k not in self.held and self.files.create(name, self.token):
                self.held.append(k)
        return len(self.held)

    def renew(self) -> bool:
        """Keeps the slots; False, and lost is set, if one is another's by now."""
        for k in self.held:
            try:
                if self.files.read(f"{self.folder}/{k}") != self.token:
                    self.lost.set()
                else:
                    self.files.touch(f"{self.folder}/{k}")
            except Exception:  # gone, or moved away at this moment
                self.lost.set()
        return not self.lost.is_set()

    def give_back(self) -> None:
        for k in self.held:
            with contextlib.suppress(Exception):
                if self.files.read(f"{self.folder}/{k}") == self.token:
                    self.files.delete(f"{self.folder}/{k}")
        self.held = []
        self.files.delete(f"{self.folder}/clock-{self.token}")


@contextlib.contextmanager
def leased(leases: Leases, slots: int, name: str, patience: float = 0.0) -> Iterator[int]:
    """Slots of the model, one at least, renewed until the end; waits up to `patience` seconds for the first."""
    over, waited = threading.Event(), 0.0
    while not leases.take(slots):
        if waited >= patience:
            leases.give_back()
            raise ConfigError(f"other runs hold all {slots} calls of model {name}; resume when they have ended")
        waited += min(1.0, patience)
        over.wait(min(1.0, patience))

    def beat() -> None:
        while not over.wait(leases.stale / 4) and leases.renew():
            pass

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield len(leases.held)
    finally:
        over.set()
        thread.join()
        leases.give_back()
