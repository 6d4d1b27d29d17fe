"""First events kept up to date (F1, F3, F10): after every change of the store the state equals a rebuild."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phenolith.operators import events as EV
from phenolith.schemas import PHENOTYPES
from phenolith.session import ensure_checkpoint_dir, scratch_path
from phenolith.sources import first_store
from phenolith.sources.first_store import FirstEventStore
from phenolith.sources.store import ConflictingWrite, EventStore
from conftest import d


def event(eid, phenotype, field_id, date):
    return (eid, phenotype, field_id, "code", None if date is None else d(date), None)


@pytest.fixture
def stores(spark):
    ensure_checkpoint_dir(spark)
    return EventStore(spark, scratch_path(spark, "phenotypes")), FirstEventStore(spark, scratch_path(spark, "earliest"))


def add(store, *rows):
    store.append(store.spark.createDataFrame(list(rows), PHENOTYPES))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(store, state):
    got = rows(state.read())
    assert got == rows(EV.earliest(store.read()).select(*FirstEventStore.SCHEMA.names))
    return got


def test_empty_store(stores):
    store, state = stores
    touched = state.update(store)
    assert (touched.added, touched.rebuilt, touched.dropped) == ([], [], []) and state.versions() == []
    assert rows(state.read()) == []


def test_append_reads_and_writes_only_what_is_new(stores, monkeypatch):
    store, state = stores
    add(store, event(1, "a", 41202, "2010-01-01"), event(1, "a", 41202, "2011-01-01"), event(2, "b x/y=z", 6150, None))
    assert state.update(store).rebuilt == [("a", 41202), ("b x/y=z", 6150)]
    same(store, state)
    first = state.manifest()["folders"]
    add(store, event(1, "a", 41202, "2009-01-01"), event(3, "a", 41202, "2012-01-01"))
    asked = []
    read = store._read
    monkeypatch.setattr(store, "_read", lambda folders: asked.append(dict(folders)) or read(folders))
    touched = state.update(store)
    assert (touched.added, touched.rebuilt, touched.dropped) == ([("a", 41202)], [], [])
    new = store.manifest()["folders"]["41202/a"][1:]
    assert asked == [{"41202/a": new}] and len(new) == 1
    folders = state.manifest()["folders"]
    assert folders["6150/b x/y=z"] == first["6150/b x/y=z"] and folders["41202/a"][:1] == first["41202/a"]
    assert (1, "a", 41202, d("2009-01-01")) in same(store, state)
    assert state.update(store).added == [] and len(state.versions()) == 2  # up to date: no version


def test_a_deleted_minimum_is_computed_again(stores):
    store, state = stores
    add(store, event(1, "a", 41202, "2005-01-01"), event(1, "a", 41202, "2010-01-01"), event(1, "b", 41202, "2003-01-01"))
    state.update(store)
    left = store.spark.createDataFrame([event(1, "a", 41202, "2010-01-01")], PHENOTYPES)
    store.replace(left, [("a", 41202)])
    touched = state.update(store)
    assert (touched.added, touched.rebuilt, touched.dropped) == ([], [("a", 41202)], [])
    assert same(store, state) == [(1, "a", 41202, d("2010-01-01")), (1, "b", 41202, d("2003-01-01"))]
    store.delete_phenotype("b")
    assert state.update(store).dropped == [("b", 41202)]
    assert same(store, state) == [(1, "a", 41202, d("2010-01-01"))]
    store.delete_phenotype("a")
    state.update(store)
    assert same(store, state) == []


def test_many_parts_are_merged(stores, monkeypatch):
    monkeypatch.setattr(first_store, "MAX_PARTS", 2)
    store, state = stores
    for year in range(2010, 2004, -1):
        add(store, event(1, "a", 41202, f"{year}-01-01"), event(year, "a", 41202, "2001-01-01"))
        state.update(store)
        assert len(state.manifest()["folders"]["41202/a"]) <= 2
        same(store, state)


def test_failure_and_second_writer_change_nothing(stores, monkeypatch):
    store, state = stores
    add(store, event(1, "a", 41202, "2010-01-01"))
    state.update(store)
    before = rows(state.read())
    add(store, event(1, "a", 41202, "2000-01-01"))
    with monkeypatch.context() as patch:
        def lost(*_):
            raise RuntimeError("lost")
        patch.setattr(state, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            state.update(store)
    assert rows(state.read()) == before
    write = state._write

    def other_run_first(df):
        state._write = write
        FirstEventStore(state.spark, state.path).update(store)
        return write(df)

    state._write = other_run_first
    with pytest.raises(ConflictingWrite):
        state.update(store)
    same(store, state)
    assert state.vacuum() >= 1  # what refused and failed updates left
    same(store, state)


def test_first_events_from_the_state(spark, stores):
    store, state = stores
    add(store, event(1, "a", 41202, "1980-01-01"), event(1, "a", 41204, "1900-01-01"), event(2, "a", 41202, "2010-01-01"),
        event(9, "a", 41202, "2010-01-01"), event(None, "a", 41202, "2010-01-01"))
    state.update(store)
    cohort = spark.createDataFrame([(1, d("1990-05-01"), "x"), (2, None, "x")], "eid bigint, dob date, eventdate string")
    for compat in (False, True):
        assert rows(state.first_events(cohort, compat)) == rows(EV.first_events(store.read(), cohort, compat))
    assert (1, "a", 41202, d("1990-05-01")) in [(*r[:3], r[4]) for r in rows(state.first_events(cohort))]


_event = st.tuples(st.integers(1, 3), st.sampled_from("ab"), st.sampled_from([41202, 6150]), st.sampled_from([None, "1900-01-01", "2001-02-03", "2020-01-01"]))
_change = st.one_of(st.lists(_event, min_size=1, max_size=4).map(lambda es: ("append", es)),
                    st.sampled_from("ab").map(lambda p: ("delete", p)),
                    st.lists(_event, max_size=3).map(lambda es: ("replace", es)))


@settings(max_examples=5, deadline=None)
@given(st.lists(_change, min_size=1, max_size=4))
def test_any_changes_equal_a_rebuild(spark, changes):
    ensure_checkpoint_dir(spark)
    store, state = EventStore(spark, scratch_path(spark, "phenotypes")), FirstEventStore(spark, scratch_path(spark, "earliest"))
    for what, arg in changes:
        if what == "append":
            add(store, *[event(*e) for e in arg])
        elif what == "delete":
            store.delete_phenotype(arg)
        else:
            new = [event(*e) for e in arg if e[1:3] == ("a", 41202)]
            store.replace(spark.createDataFrame(new, PHENOTYPES), [("a", 41202)])
        state.update(store)
        same(store, state)
