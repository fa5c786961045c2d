"""Sums of doubles that are exact, so that neither order nor partitioning matters: the result is rounded once.

Where all values of a group are decimals of at most six places, as amounts of money are, they are added up as those
decimals: their millionths are integers. In any other group they count as the binary numbers that doubles are, and the
result is that of ``math.fsum``. Both sums are kept, and the end shows which one counts.

A double is cut into five integer digits of 21 bits, counted from a power of two that its band gives, and the digits
are added up as integers; 2**42 rows fit. Amounts from about a thousandth up to 4.4e12 all have band 0. Other doubles,
however large or small, are scaled by a power of 2**42, and rows are then grouped by band as well: there are at most 53
bands, and usually one. At the end the digits of all bands are put together and rounded to the nearest double.

Nulls are left out, and a sum of nothing is null. Infinities add up to themselves,
those of both signs, like anything that is not a number, to not-a-number. A sum beyond all doubles is infinite.

Use: ``with_digits``, group by the keys and ``band(name)``, ``sums``; group by the keys, ``gathered``; then ``total``.
All of it is built-in expressions, written as SQL: one call each to the engine instead of hundreds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 21
DIGITS = 5
BAND_BITS = 2 * DIGIT_BITS
_MASK = (1 << DIGIT_BITS) - 1
# Digits of any sum, by their power of 2**21: below the least one of band -26 and above the greatest one of band 24.
_LEAST, _GREATEST = -57, 57
_UNBANDED = ("m0", "m1", "m2", "binary", "special", "n")


def band(name: str) -> str:
    return f"{name}__band"


def _of(name: str, part: str) -> str:
    """The column of a sum's part, in SQL."""
    return "`" + f"{name}__{part}".replace("`", "``") + "`"


def _double(value: float) -> str:
    return f"{value!r}D".upper()


def with_digits(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``df`` with the bands and the scaled values of ``values``, by name."""
    own = df.withColumns({f"{name}__x": value.cast("double") for name, value in values.items()})
    own = own.withColumns({band(name): F.expr(_band_of(_of(name, "x"))) for name in values})
    return own.withColumns({f"{name}__y": F.expr(_scaled(_of(name, "x"), _of(name, "band"))) for name in values})


def _band_of(x: str) -> str:
    """Null for what is no finite number."""
    whole = f"rint({x} * {_double(2.0**63)}) * {_double(2.0**-63)} = {x}"
    return (
        f"CASE WHEN abs({x}) < {_double(2.0**BAND_BITS)} AND {whole} THEN 0 "
        f"WHEN abs({x}) < double('infinity') THEN int(floor(log2(abs({x})) / {_double(float(BAND_BITS))})) END"
    )


def _scaled(x: str, of_band: str) -> str:
    # in two steps, since the power itself may be out of range
    half = f"pow(2D, -{of_band} * {DIGIT_BITS})"
    return f"CASE WHEN {of_band} = 0 THEN {x} ELSE {x} * {half} * {half} END"


def sums(name: str) -> list[Column]:
    """Aggregates over rows of one band."""
    x, y = _of(name, "x"), _of(name, "y")
    whole = [f"rint({y} * {_double(2.0 ** (DIGIT_BITS * (k - 1)))})" for k in range(DIGITS)]
    parts = {f"s{k}": f"sum(bigint({digit}))" for k, digit in enumerate(_digits(whole))}
    # the millionths of a decimal, 0 of other doubles
    millionths = f"CASE WHEN {_is_decimal(x)} THEN rint({x} * 1E6D) ELSE 0D END"
    whole = [f"rint(({millionths}) * {_double(2.0 ** -(DIGIT_BITS * k))})" for k in (2, 1, 0)]
    parts |= {f"m{k}": f"sum(bigint({digit}))" for k, digit in enumerate(_digits(whole))}
    parts["binary"] = f"count_if(NOT ({_is_decimal(x)}))"
    parts["special"] = f"sum(CASE WHEN {_of(name, 'band')} IS NULL THEN {x} END)"
    parts["n"] = f"count({x})"
    return [F.expr(f"{expression} AS {_of(name, part)}") for part, expression in parts.items()]


def _digits(whole: list[str]) -> list[str]:
    """Digits of 21 bits from numbers that each have one digit more."""
    return [whole[0], *(f"({b} - {a} * {_double(2.0**DIGIT_BITS)})" for a, b in zip(whole, whole[1:]))]


def _is_decimal(x: str) -> str:
    return f"rint({x} * 1E6D) / 1E6D = {x} AND abs(rint({x} * 1E6D)) < {_double(2.0**53)}"


def merged(name: str) -> list[Column]:
    """Aggregates that merge ``sums`` of the same band."""
    parts = [*(f"s{k}" for k in range(DIGITS)), *_UNBANDED]
    return [F.expr(f"sum({_of(name, part)}) AS {_of(name, part)}") for part in parts]


def _gathered(name: str) -> dict[str, str]:
    digits = ", ".join(f"'s{k}', {_of(name, f's{k}')}" for k in range(DIGITS))
    of_band = f"CASE WHEN {_of(name, 'band')} IS NOT NULL THEN named_struct('band', {_of(name, 'band')}, {digits}) END"
    return {"bands": f"collect_list({of_band})", **{part: f"sum({_of(name, part)})" for part in _UNBANDED}}


def gathered(name: str) -> list[Column]:
    """Aggregates that gather the sums of all bands of a group."""
    return [F.expr(f"{expression} AS {_of(name, part)}") for part, expression in _gathered(name).items()]


def total(name: str) -> Column:
    """The sum, from what ``gathered`` gave."""
    return F.expr(_total({part: _of(name, part) for part in ("bands", *_UNBANDED)}))


def total_of(name: str) -> Column:
    """The sum as a single aggregate over ``sums``, for groups that need nothing else."""
    return F.expr(_total(_gathered(name)))


def _total(parts: Mapping[str, str]) -> str:
    bands = _let(parts["bands"], "bands", (
        f"CASE WHEN size(bands) = 1 AND get(bands, 0).band = 0 THEN {_let('get(bands, 0)', 'b', _of_one(*_carried('b')))} "
        f"ELSE {_of_several('bands')} END"
    ))
    millionths = f"{_exact(parts['m0'])} * {1 << 42}BD + {_exact(parts['m1'])} * {1 << 21}BD + {_exact(parts['m2'])}"
    decimal = f"double(({millionths}) * 0.000001BD)"
    return (
        f"CASE WHEN {parts['n']} > 0 THEN "
        f"CASE WHEN {parts['binary']} = 0 THEN {decimal} ELSE coalesce({parts['special']}, {bands}) END END"
    )


def _carried(b: str) -> list[str]:
    """The digits after carries: all within 21 bits but the first, which has the sign."""
    found, carry = [], "0L"
    for k in reversed(range(1, DIGITS)):
        value = f"({b}.s{k} + {carry})"
        found.append(f"({value} & {_MASK}L)")
        carry = f"shiftright({value}, {DIGIT_BITS})"
    return [f"({b}.s0 + {carry})", *reversed(found)]


def _exact(value: str) -> str:
    return f"CAST({value} AS DECIMAL(38,0))"


def _of_one(top: str, *low: str) -> str:
    """The double nearest to digits of band 0. A decimal is rounded once when it becomes a double."""
    three = f"shiftleft({low[0]}, 42) + shiftleft({low[1]}, 21) + {low[2]}"
    every = f"({_exact(top)} * {1 << 63}BD + {_exact(three)}) * {1 << 21}BD + {_exact(low[3])}"
    # of a sum above 2**62 the last two digits only matter as a remainder
    remainder = f"CASE WHEN {low[2]} <> 0 OR {low[3]} <> 0 THEN 1L ELSE 0L END"
    leading = f"{_exact(top)} * {1 << 43}BD + {_exact(f'shiftleft({low[0]}, 22) + shiftleft({low[1]}, 1) + {remainder}')}"
    return (
        f"CASE WHEN abs({top}) >= {1 << 41}L THEN double({leading}) * {_double(2.0**-22)} "
        f"ELSE double({every}) * {_double(2.0**-63)} END"
    )


def _of_several(bands: str) -> str:
    """The double nearest to the digits of several bands."""
    top, *low = _carried("b")
    parts = [*reversed(low), f"({top} & {_MASK}L)", f"(shiftright({top}, 21) & {_MASK}L)", f"shiftright({top}, 42)"]
    placed = ", ".join(
        f"named_struct('place', 2 * b.band + {2 - DIGITS + k}, 'digit', {part})" for k, part in enumerate(parts)
    )
    every = f"flatten(transform({bands}, b -> array({placed})))"

    def normal(sign: int) -> str:
        """The digits from the least on, without signs, and what is carried at the end: less than 0 for a negative sum."""
        here = f"aggregate(filter(every, x -> x.place = place), state.carry, (a, x) -> a + {sign} * x.digit)"
        after = f"named_struct('carry', shiftright(v, {DIGIT_BITS}), 'digits', concat(state.digits, array(v & {_MASK}L)))"
        nothing = "named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>))"
        return f"aggregate(sequence({_LEAST}, {_GREATEST}), {nothing}, (state, place) -> {_let(here, 'v', after)})"

    def rounded(state: str, sign: int) -> str:
        digits = f"{state}.digits"
        at = [f"coalesce(CASE WHEN m >= {k} THEN get({digits}, m - {k}) END, 0L)" for k in range(5)]
        more = f"CASE WHEN size(filter({digits}, (d, i) -> i < m - 4 AND d <> 0)) > 0 THEN 1 ELSE 0 END"
        three = f"shiftleft({at[1]}, 42) + shiftleft({at[2]}, 21) + {at[3]}"
        five = f"({_exact(at[0])} * {1 << 63}BD + {_exact(three)}) * {1 << 21}BD + {_exact(at[4])}"
        power = f"((m - 4 + {_LEAST}) * {DIGIT_BITS} - 1)"
        half = f"floor({power} / 2)"
        value = f"double(({five}) * 2BD + {_exact(more)}) * pow(2D, {half}) * pow(2D, {power} - {half}) * {sign}D"
        return f"coalesce({_let(f'array_max(transform({digits}, (d, i) -> CASE WHEN d <> 0 THEN i END))', 'm', value)}, 0D)"

    negative = _let(normal(-1), "z", rounded("z", -1))
    either = f"CASE WHEN s.carry < 0 THEN {negative} ELSE {rounded('s', 1)} END"
    return _let(every, "every", _let(normal(1), "s", either))


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
