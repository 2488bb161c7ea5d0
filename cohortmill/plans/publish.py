"""Marts to a database that dashboards read."""

from __future__ import annotations

from collections.abc import Iterable

from ..schemas import MARTS, Contract
from ..sources.sink import JdbcSink
from ..sources.store import TableStore


def publish(local: TableStore, sink: JdbcSink, contracts: Iterable[Contract] = tuple(MARTS.values())) -> dict[str, str]:
    """What was sent per table: ``none``, ``append`` or ``replace``.

    The database's log names the newest mart batch it covers, as a replica's does: only later batches are
    read. New keys are found inside the database, so no key travels back. A mart that was rewritten since,
    or that the database has never seen, is sent whole and takes the place of what is there.
    """
    sent = {}
    for contract in contracts:
        name, commits = contract.name, local.commits(contract.name)
        held = sink.batches(contract)
        covered = [c for c in commits if c.batch in held]
        if not commits or commits[-1].batch in held:
            sent[name] = "none"
        elif not covered or commits[-1].gen > covered[-1].gen:
            sink.write(contract, local.read(name, contract), commits[-1].batch, replace=True)
            sent[name] = "replace"
        else:
            missing = [c for c in local.live(name) if c.seq > covered[-1].seq]
            sink.write(contract, local.read_batches(name, missing), commits[-1].batch)
            sent[name] = "append"
    return sent
