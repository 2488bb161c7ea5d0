"""Marts to a shared replica."""

from __future__ import annotations

from collections.abc import Iterable

from ..operators.keys import unseen
from ..schemas import MARTS, Contract
from ..sources.store import Batch, TableStore


def sync_replica(
    local: TableStore,
    remote: TableStore,
    batch: str,
    contracts: Iterable[Contract] = tuple(MARTS.values()),
    *,
    refresh: bool = False,
) -> list[Batch]:
    """Append to each replica table the rows whose key it lacks.

    A replica batch bears the name of the newest mart batch it covers, so the replica's log
    tells which mart batches are still to come: only those are read, and a sync without news
    reads no data. Of their rows those with a new key are appended; both sides follow one
    contract, so keys are compared column by column and only the key columns of the replica
    are read. ``refresh`` makes the replica a copy of the mart, and so does a mart that was rewritten
    since the last sync: its rows may have other values, or be gone. A mart that was never written
    leaves the replica as it is, under the name ``batch``.
    """
    written = []
    for contract in contracts:
        name, commits = contract.name, local.commits(contract.name)
        held = {c.batch for c in remote.commits(name)}
        newest = commits[-1].batch if commits else batch
        covered = [c for c in commits if c.batch in held]
        rewritten = bool(covered) and commits[-1].gen > covered[-1].gen
        if refresh or rewritten:
            again = f"{newest}-copy-{len(held)}"
            rows = local.read(name, contract)
            written.append(remote.replace(name, rows, again if newest in held else newest))
            continue
        synced = covered[-1].seq if covered else -1
        missing = [c for c in local.live(name) if c.seq > synced]
        if missing:
            rows = unseen(local.read_batches(name, missing), remote.read(name, contract), contract.key)
            written.append(remote.append(name, rows, newest))
        else:
            written.append(Batch(name, 0, committed=False))
    return written
