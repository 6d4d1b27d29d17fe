"""First events kept up to date (F1, F3, F10): the earliest date per (eid, phenotype, field_id) as mergeable, stored state.

The state has the layout and the versions of the event store. Each (phenotype, field) carries, as its mark, the commits of the
event store it was made from, so an update knows from the two manifests alone what there is to do:

* the same commits: nothing;
* commits were added: only their events are read; their earliest dates become one more part beside the pair's other parts, and
  the minimum over the parts is taken when the state is read. A pair with ``MAX_PARTS`` parts is merged into one;
* a commit is gone (refresh, changed codes, delete): an earliest date may be gone with it, so the pair, and only it, is made
  again from its events;
* the pair is gone: its parts are dropped.

Cohort membership, labels and the birth-date rule are applied on reading, as they change with the cohort. An update that fails
leaves the old version; of two updates at a time the second is refused (``ConflictingWrite``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from phenolith.operators import events as EV
from phenolith.schemas import EARLIEST
from phenolith.sources.store import EventStore, Pair

#: Parts of a (phenotype, field) before they are merged into one.
MAX_PARTS = 8


@dataclass
class Updated:
    """The pairs that an update touched."""

    added: list[Pair]
    rebuilt: list[Pair]
    dropped: list[Pair]


class FirstEventStore(EventStore):
    SCHEMA = EARLIEST

    def update(self, events: EventStore) -> Updated:
        """Bring the state to the latest version of ``events``, reading only the commits that it does not know."""
        source, base = events.manifest()["folders"], self.manifest()
        folders, marks = dict(base["folders"]), dict(base["finished"])
        unread, merged, rebuilt = {}, {}, []
        for key, commits in source.items():
            known = marks[key].split(",") if key in marks else []
            if known == commits:
                continue
            if known and commits[:len(known)] == known:
                unread[key] = commits[len(known):]
                if len(folders.get(key, [])) >= MAX_PARTS:
                    merged[key] = folders.pop(key)
            else:
                unread[key] = commits
                rebuilt.append(key)
                folders.pop(key, None)
            marks[key] = ",".join(commits)
        dropped = [key for key in marks if key not in source]
        for key in dropped:
            folders.pop(key, None)
            del marks[key]
        if unread:
            rows = events._read(unread).select(*self.SCHEMA.names)
            if merged:
                rows = rows.unionByName(self._read(merged))
            commit, keys = self._write(EV.earliest(rows))
            for key in keys:
                folders[key] = [*folders.get(key, []), commit]
        if unread or dropped:
            self._commit(base, folders, marks)
        pairs = lambda found: sorted(map(self._pair, found))
        return Updated(pairs(set(unread) - set(rebuilt)), pairs(rebuilt), pairs(dropped))

    def read(self, version: int | None = None) -> DataFrame:
        """The earliest dates of one version; only pairs of several parts are aggregated."""
        folders = self.manifest(version)["folders"]
        parts = {key: commits for key, commits in folders.items() if len(commits) > 1}
        whole = self._read({key: commits for key, commits in folders.items() if key not in parts})
        return whole.unionByName(EV.earliest(self._read(parts))) if parts else whole

    def first_events(self, cohort: DataFrame, compat: bool = False, clamp: bool = True) -> DataFrame:
        """F1 + F2 + F3 from the state."""
        return EV.label_first(self.read(), cohort, compat, clamp)
