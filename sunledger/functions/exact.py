"""Sums of doubles that do not depend on row order, so a retried or repartitioned job gives the same bits.

A double is cut in binary: its nearest whole number, and :data:`PLACES` signed digits of :data:`BITS` bits after it.
Scaling by a power of two and rounding to a whole number are exact, and so is the difference of two neighbours in that
series, so the digits lose nothing down to 2^-100 of a unit: a reading of at least 7.2e-15 is kept to its last bit, what
lies under 4e-31 is rounded off. The parts are summed as longs, in generated code and map-side like any sum. At the end
carries are settled and the digits put together once, smallest first: the result is within one unit in the last place.

Each part holds 9.2e18 (8.8e12 rows); a reading that is NaN, infinite or beyond that fails the job under ANSI mode, which
:func:`sunledger.session.configure` pins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 20
PLACES = 5
STEP = 1 << BITS


def exact_sum(x: str) -> Column:
    """SUM of a double, given as SQL."""
    return F.expr(_exact_sum(x))


def exact_mean(x: str) -> Column:
    """AVG on top of :func:`exact_sum`; NULL when there is nothing to average."""
    return F.expr(f"try_divide({_exact_sum(x)}, count({x}))")


def exact_percentage(part: str, whole: str) -> Column:
    """SUM(part) in percent of SUM(whole); NULL when the latter is zero."""
    return F.expr(f"try_divide(100.0D * {_exact_sum(part)}, {_exact_sum(whole)})")


def same_or_mean(x: str) -> Column:
    """The value itself where all rows agree on it, to the last bit; else their mean."""
    return F.expr(f"if(min({x}) = max({x}), min({x}), try_divide({_exact_sum(x)}, count({x})))")


def _double(value: float) -> str:
    return repr(value).replace("e+", "E") + "D"


def _parts(x: str) -> list[str]:
    """The whole number and the digits of one double, as SQL."""
    rounded = [f"rint(({x}) * {_double(2.0 ** (BITS * place))})" for place in range(PLACES + 1)]
    fine = [f"cast({fine} - {_double(float(STEP))} * {coarse} as bigint)" for coarse, fine in zip(rounded, rounded[1:])]
    return [f"cast({rounded[0]} as bigint)", *fine]


def _total(whole: str, digits: list[str]) -> str:
    """One double from the summed parts."""
    digits = f"array({', '.join(reversed(digits))})"
    # The total rounded down tells its sign. Settling carries on a positive total leaves digits of one sign, so that
    # putting them together never cancels.
    down = f"{whole} + aggregate({digits}, 0L, (carry, d) -> shiftright(carry + d, {BITS}))"
    settled = (
        f"aggregate({digits}, struct(if({down} < 0, -1L, 1L) as sign, 0L as carry, 0.0D as rest), (a, d) -> struct("
        f"a.sign as sign, shiftright(a.carry + a.sign * d, {BITS}) as carry, "
        f"(a.rest + cast((a.carry + a.sign * d) & {STEP - 1} as double)) / {_double(float(STEP))} as rest), "
        f"a -> named_struct('sign', a.sign, 'carry', a.carry, 'rest', a.rest))"
    )
    return (
        f"transform(array(struct({settled} as s, {whole} as whole)), "
        "t -> t.s.sign * (cast(t.s.sign * t.whole + t.s.carry as double) + t.s.rest))[0]"
    )


def _exact_sum(x: str) -> str:
    whole, *digits = (f"sum({part})" for part in _parts(x))
    return _total(whole, digits)


PART_NAMES = tuple(f"part_{place}" for place in range(PLACES + 1))


def exact_parts(x: str) -> list[Column]:
    """The summed parts as columns of their own, :data:`PART_NAMES`: stored, they merge into the sums of wider windows
    or of more keys, to the bits that the readings themselves would give."""
    return [F.expr(f"sum({part})").alias(name) for part, name in zip(_parts(x), PART_NAMES)]


def merged_sum() -> Column:
    """The total of a group of rows with stored parts; NULL where no row has any."""
    whole, *digits = (f"sum({name})" for name in PART_NAMES)
    return F.expr(_total(whole, digits))


def parts_total() -> Column:
    """The total that the stored parts of one row stand for."""
    whole, *digits = PART_NAMES
    return F.expr(_total(whole, digits))
