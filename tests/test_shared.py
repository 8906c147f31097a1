"""How long stored tables stay."""

from __future__ import annotations

import os

import pytest

from tabloom.sources.shared import Scratch, remove, shared_folder, stored


def held(spark):
    return set(os.listdir(shared_folder(spark)))


def test_a_scratch_removes_what_was_stored_in_it(spark):
    before = held(spark)
    with Scratch(spark):
        table = stored(spark.range(3), "numbers")
        assert table.count() == 3 and len(held(spark) - before) == 1
    assert held(spark) == before


def test_kept_tables_belong_to_whoever_is_outside(spark):
    before = held(spark)
    with Scratch(spark):
        with Scratch(spark) as inner:
            part = stored(spark.range(5), "part")
            kept = inner.keep(part.where("id > 1"), "result")
        assert kept.count() == 3 and len(held(spark) - before) == 1
    assert held(spark) == before


def test_detached_scratches_and_failures(spark):
    before = held(spark)
    with Scratch(spark):
        with Scratch(spark, detached=True) as first:
            table = stored(spark.range(2), "numbers")
        assert table.count() == 2
        first.close()
        assert held(spark) == before
        with Scratch(spark, detached=True) as second:
            table = stored(spark.range(2), "numbers")
        second.release()
        assert table.count() == 2 and second.paths == []
    assert held(spark) == before
    with pytest.raises(RuntimeError), Scratch(spark, detached=True):
        stored(spark.range(2), "numbers")
        raise RuntimeError
    assert held(spark) == before


def test_without_a_scratch_tables_stay(spark):
    before = held(spark)
    stored(spark.range(2), "numbers")
    (name,) = held(spark) - before
    remove(spark, f"{shared_folder(spark)}/{name}")
    remove(spark, f"{shared_folder(spark)}/{name}")
    assert held(spark) == before
