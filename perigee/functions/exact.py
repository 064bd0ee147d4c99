"""Exact sums of doubles that merge in any order, by built-in aggregations.

A double is a whole number times a power of two, so it can be cut into digits to the base 2**32
without loss, and digits of the same place can be summed as integers. Nearly all values lie within
three places: whole, 2**-32 and 2**-64 (magnitudes under 2**31 with no bit below 2**-64; every
double of 0.0003 or more). Their digits are three columns of the row. The digits of any other finite
value, a far one, become rows of their own, keyed by a slot that names the value's column and
the digit's place; a group has at most as many such rows as there are slots.

The sum is put together from all digits at the end and rounded once, so means equal the correctly
rounded sum divided by the count, whatever the order or the partitioning of rows. Up to 2**30 values
fit into a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digit columns of a value, by place 0, -1, -2.
DIGITS = ("whole", "mid", "low")
BASE = float(1 << 32)
#: Places of digits that doubles and their sums can have, with room below.
LOWEST, HIGHEST = -38, 34
_PLACES = 128


def _scaled(x: Column, place: Column) -> Column:
    """x * 2**(32 * place), in two steps, as a single power may be beyond the range."""
    half = F.pow(F.lit(2.0), place * 16)
    return x * half * half


_SLOTS = "array<struct<slot:int,amount:bigint>>"


def _far_digits(x: Column, column: Column) -> Column:
    """(slot, amount) of the digits of a finite value, most significant first."""
    top = F.floor(F.log2(F.abs(x)) / 32).cast("int") + 1
    start = F.struct(F.abs(x).alias("rest"), F.expr(f"cast(array() as {_SLOTS})").alias("out"))

    def step(done: Column, place: Column) -> Column:
        d = F.floor(_scaled(done["rest"], -place))
        slot = (column * _PLACES + place + _PLACES // 2).cast("int")
        one = F.struct(slot.alias("slot"), F.when(x < 0, -d).otherwise(d).cast("bigint").alias("amount"))
        return F.struct((done["rest"] - _scaled(d.cast("double"), place)).alias("rest"), F.concat(done["out"], F.array(one)).alias("out"))

    return F.aggregate(F.sequence(top, top - 4), start, step, lambda done: F.filter(done["out"], lambda e: e["amount"] != 0))


def with_digits(rows: DataFrame, values: dict[str, str], place_of: Callable[[str], int]) -> DataFrame:
    """Rows with digit columns ``<name>_whole, _mid, _low`` of each value column, ``slot`` and ``amount`` null.

    After a row with far values come rows for their digits, with slot and amount; the digit columns
    of such values are null. ``place_of`` gives the number by which slots tell a name.
    """
    if not values:
        return rows.withColumns({"slot": F.lit(None).cast("int"), "amount": F.lit(None).cast("bigint")})
    every = lambda text: {n: F.expr(text.format(n=n, c=f"`{c}`")) for n, c in values.items()}
    named = lambda suffix, found: {f"{n}_{suffix}": e for n, e in found.items()}
    # casts cut towards zero, so all digits of a value have its sign and every step is exact
    rows = rows.withColumns(named("whole", every("cast(CASE WHEN abs({c}) < 2147483648D THEN {c} END AS bigint)")))
    rows = rows.withColumns(named("rest", every("({c} - cast({n}_whole AS double)) * 4294967296D")))
    rows = rows.withColumns(named("mid", every("cast({n}_rest AS bigint)")))
    rows = rows.withColumns(named("rest", every("({n}_rest - cast({n}_mid AS double)) * 4294967296D")))
    rows = rows.withColumns(named("low", every("CASE WHEN {n}_rest = cast(cast({n}_rest AS bigint) AS double) THEN cast({n}_rest AS bigint) END")))
    is_far = {n: f"({n}_low IS NULL AND NOT isnan(`{c}`) AND abs(`{c}`) < double('infinity'))" for n, c in values.items()}
    rows = rows.withColumns(named("whole", every("CASE WHEN {n}_low IS NOT NULL THEN {n}_whole END")) | named("mid", every("CASE WHEN {n}_low IS NOT NULL THEN {n}_mid END")))
    itself = F.expr(f"cast(array(named_struct('slot', null, 'amount', null)) as {_SLOTS})")
    far = F.expr("array(" + ", ".join(f"CASE WHEN {is_far[n]} THEN named_struct('column', {place_of(n)}, 'x', `{c}`) END" for n, c in values.items()) + ")")
    digits = F.flatten(F.transform(F.filter(far, lambda e: e.isNotNull()), lambda e: _far_digits(e["x"], e["column"])))
    any_far = F.coalesce(F.expr(" OR ".join(f"coalesce({e}, false)" for e in is_far.values())), F.lit(False))
    return rows.select(*[c for c in rows.columns if not c.endswith("_rest")], F.inline(F.when(any_far, F.concat(itself, digits)).otherwise(itself)))


_NUMBER = f"(cast({{0}} AS decimal(38,0)) * {1 << 64}BD + cast({{1}} AS decimal(38,0)) * {1 << 32}BD + cast({{2}} AS decimal(38,0)))"


def _far_mean(near: Column, far: Column) -> Column:
    """The mean of ``near`` (column, n and digits) with the digits of far values; null if it has none."""
    first = near["column"] * _PLACES + _PLACES // 2
    own = F.filter(far, lambda e: F.abs(e["slot"] - first) < _PLACES // 2)
    sums = F.map_from_entries(F.transform(own, lambda e: F.struct((e["slot"] - first).alias("k"), e["amount"].alias("v"))))
    zero = F.lit(0).cast("bigint")
    total = lambda k: F.coalesce(F.element_at(sums, k), zero) + F.coalesce(F.get(near["digits"], -k), zero)
    totals = F.transform(F.sequence(F.lit(LOWEST), F.lit(HIGHEST)), total)

    def carried(sign: Column) -> Column:
        """Digits from 0 to 2**32 - 1, lowest first, and what is carried beyond the last."""
        start = F.struct(zero.alias("carry"), F.expr("cast(array() as array<bigint>)").alias("out"))

        def step(done: Column, x: Column) -> Column:
            value = done["carry"] + sign * x
            return F.struct(F.shiftright(value, 32).alias("carry"), F.concat(done["out"], F.array(value.bitwiseAND(F.lit((1 << 32) - 1)))).alias("out"))

        return F.aggregate(totals, start, step)

    def rounded(made: Column) -> Column:
        ds = made["digits"]
        top = F.array_max(F.transform(ds, lambda d, i: F.when(d != 0, i).otherwise(2)))  # three digits from here down
        below = F.exists(F.slice(ds, 1, top - 2), lambda d: d != 0)
        # twice the number, odd if anything is below: rounds once, and like the whole sum
        number = _three(F.get(ds, top), F.get(ds, top - 1), F.get(ds, top - 2))
        value = (number + number + F.when(below, 1).otherwise(0)).cast("double") / 2.0
        place = top + (LOWEST - 2)
        return made["sign"] * F.when(place > 0, _scaled(value / near["n"], place)).otherwise(_scaled(value, place) / near["n"])

    signed = F.transform(F.array(F.when(carried(F.lit(1).cast("bigint"))["carry"] < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")), lambda sign: F.struct(sign.alias("sign"), carried(sign)["out"].alias("digits")))
    return F.when(F.size(own) > 0, F.element_at(F.transform(signed, rounded), 1))


def _three(high: Column, mid: Column, low: Column) -> Column:
    whole = "decimal(38,0)"
    return high.cast(whole) * F.expr(f"{1 << 64}BD") + mid.cast(whole) * F.expr(f"{1 << 32}BD") + low.cast(whole)


def means_of_digits(rows: DataFrame, names: list[str], far: str, place_of: Callable[[str], int]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows to be selected from, and for each name its mean: from ``<name>_n``, the sums of its digits, and the digits of far values."""
    near = ", ".join(
        f"named_struct('column', {place_of(n)}, 'n', {n}_n, 'digits', array({', '.join(f'{n}_{d}' for d in DIGITS)}))" for n in names
    )
    far_means = F.when(F.col(far).isNotNull(), F.transform(F.expr(f"array({near})"), lambda e: _far_mean(e, F.col(far))))
    plain = "cast(" + _NUMBER + f" AS double) * {2.0**-64!r}D / {{n}}_n"
    out = {}
    for i, n in enumerate(names):
        here = plain.format(*(f"coalesce({n}_{d}, 0L)" for d in DIGITS), n=n)
        out[n] = F.expr(f"coalesce(get(far_means, {i}), CASE WHEN {n}_n > 0 THEN {here} END)")
    return rows.withColumn("far_means", far_means), out
