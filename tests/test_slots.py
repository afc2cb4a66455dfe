import random
from datetime import timedelta

import pytest

from helpers import at, generator, generator_row, rows
from sunledger.operators import slots


def floor(when, step):
    return when - timedelta(seconds=(when - at("00:00")).total_seconds() % step.total_seconds())


def gaps_by_hand(readings, step):
    missing = []
    for plant in {r[5] for r in readings}:
        seen = {floor(r[0], step) for r in readings if r[5] == plant}
        when = min(seen)
        while when < max(seen):
            if when not in seen:
                missing.append((plant, when))
            when += step
    return sorted(missing, key=repr)


@pytest.mark.parametrize("seed,step,text", [(1, 15, "15 minutes"), (2, 15, "15 minutes"), (3, 20, "20 minutes")])
def test_gaps_against_brute_force(spark, seed, step, text):
    rng = random.Random(seed)
    readings = [
        generator_row(f"{rng.randrange(24):02d}:{rng.randrange(60):02d}", 1, plant=p, day=f"2020-05-{15 + rng.choice([0, 0, 1, 9])}")
        for p in (1, 2, 3)
        for _ in range(40)
    ]
    readings.append(generator_row("10:07", 1, plant=4))
    got = rows(slots.slot_gaps(generator(spark, readings), text))
    assert got == gaps_by_hand(readings, timedelta(minutes=step))


def test_no_gap_without_a_hole(spark):
    readings = [generator_row(c, 1) for c in ("00:00", "00:15", "00:44", "00:45")]
    assert slots.slot_gaps(generator(spark, readings)).count() == 0


def test_lookup(spark):
    readings = generator(spark, [generator_row("00:00", 1), generator_row("00:15", 2), generator_row("00:15", 3, plant=2)])
    def found(slot):
        return [r[1] for r in rows(slots.slot_lookup(readings, slot))]

    assert found(at("00:15")) == [2.0, 3.0]
    assert found(at("00:30")) == []
    assert found(slots.first_slot(readings)) == [1.0]
    assert slots.first_slot(readings.limit(0)) is None
    assert found(None) == []


def test_bounds_and_counts(spark):
    readings = generator(spark, [generator_row(c, 1, plant=p) for p in (1, 2) for c in ("00:00", "00:15", "00:15")])
    assert rows(slots.slot_bounds(readings)) == [(p, at("00:00"), at("00:15")) for p in (1, 2)]
    assert rows(slots.rows_per_slot(readings)) == [(at("00:00"), 2), (at("00:15"), 4)]
