"""Leases: who still reads or writes an attempt's folder, as files beside the tables.

A lease is a file that its holder writes anew every so often. Whoever wants to remove an attempt asks
for the leases first. A holder that crashed stops renewing, and its lease ends by itself. Ages are
measured by the file system's own clock, as holder and asker may run on different machines.
"""

from __future__ import annotations

import logging
import threading
import uuid

from pyspark.sql import SparkSession

from ledgerline.publish.storage import Storage

# Seconds between renewals, and after which a lease without one has ended.
RENEW_EVERY = 60.0
LEASE_FOR = 900.0

log = logging.getLogger(__name__)


class Lease:
    """A lease on one attempt, held within a `with` block and renewed in the background."""

    def __init__(self, spark: SparkSession, folder: str, attempt: str, renew_every: float = RENEW_EVERY):
        self.storage, self.attempt, self.renew_every = Storage(spark), attempt, renew_every
        # Several holders of one attempt have a file each.
        self.path = f"{folder}/{attempt}/{uuid.uuid4().hex}"
        self._ended = threading.Event()
        self._thread = threading.Thread(target=self._renew, name=f"lease-{attempt}", daemon=True)

    def _renew(self) -> None:
        while not self._ended.wait(self.renew_every):
            try:
                self.storage.touch(self.path)
            except Exception as e:  # noqa: BLE001
                # The next turn tries again; a lease outlasts several failed ones.
                log.warning("lease on %s not renewed: %s", self.attempt, e)

    def __enter__(self) -> Lease:
        self.storage.touch(self.path)
        self._thread.start()
        return self

    def __exit__(self, *exc) -> None:
        self._ended.set()
        self._thread.join()
        self.storage.delete([self.path])


def held(spark: SparkSession, folder: str, lease_for: float = LEASE_FOR) -> set[str]:
    """Attempts with a living lease; files of ended ones are removed."""
    storage, out = Storage(spark), set()
    now = storage.now(folder)
    for place, _ in storage.list(folder):
        if place.rsplit("/", 1)[-1].startswith("."):
            continue
        files = storage.list(place)
        living = [path for path, changed in files if now - changed <= lease_for]
        if living:
            out.add(place.rsplit("/", 1)[-1])
        elif all(now - changed > 2 * lease_for for _, changed in files):
            storage.delete([place])
    return out
