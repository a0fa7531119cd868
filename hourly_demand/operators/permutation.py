"""Keyed permutations by arithmetic: the partner of a position without sorting or numbering anything.

A Feistel network permutes the pairs (l, r) of 0..a-1 and 0..b-1, with a x b just above n: each round
adds a function of one half to the other. What falls on a number of n or more goes through the network
again (cycle walking) until it is below n. At most a x b - n numbers lie outside, so a walk ends after
as many steps; a is chosen near the root of n so that few or none do.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 4
#: Values of a that are looked at below the root of n.
WIDTHS = 64
PRIME = 2**31 - 1


def round_keys(*seed: object) -> list[int]:
    """Three numbers per round, drawn from the seed."""
    rng = random.Random("-".join(map(str, seed)))
    return [rng.randrange(1, PRIME) for _ in range(3 * ROUNDS)]


def _mixed(v: Column, keys: Sequence[Column]) -> Column:
    """A number below PRIME; all products stay below 2^62."""
    shift, factor, add = keys
    moved = (v + shift) % PRIME
    return ((moved * moved) % PRIME * factor + add) % PRIME


def shape(n: Column) -> Column:
    """Struct of a and b for n positions: of the candidates for a, the one with the fewest numbers outside."""
    root = F.greatest(F.lit(1).cast("bigint"), F.floor(F.sqrt(n.cast("double"))))
    # Not below half the root: with a of 1 the network would only rotate.
    each = F.sequence(F.greatest(F.floor((root + 1) / 2), root - (WIDTHS - 1)), root)

    def tried(a: Column) -> Column:
        b = F.ceil(n / a)
        return F.struct((a * b - n).alias("outside"), (-a).alias("less"), a.alias("a"), b.alias("b"))

    return F.array_min(F.transform(each, tried))


def partner(pos: Column, n: Column, size: Column, keys: Column) -> Column:
    """Where the permutation of 0..n-1 takes pos. size: `shape(n)`; keys: array of `round_keys`."""
    a, b = size["a"], size["b"]

    def turned(halves: Column, number: int) -> Column:
        """One round; the struct is bound once, as lambdas repeat an expression wherever it is used."""
        own = [F.get(keys, F.lit(3 * number + i)) for i in range(3)]

        def step(h: Column) -> Column:
            if number % 2 == 0:
                return F.struct(((h["l"] + _mixed(h["r"], own)) % a).alias("l"), h["r"].alias("r"))
            return F.struct(h["l"].alias("l"), ((h["r"] + _mixed(h["l"], own)) % b).alias("r"))

        return F.get(F.transform(F.array(halves), step), F.lit(0))

    def network(x: Column) -> Column:
        halves = F.struct(F.floor(x / b).alias("l"), (x % b).alias("r"))
        for number in range(ROUNDS):
            halves = turned(halves, number)
        return F.get(F.transform(F.array(halves), lambda h: h["l"] * b + h["r"]), F.lit(0))

    again = F.array_repeat(F.lit(0), size["outside"].cast("int"))
    return F.aggregate(again, network(pos), lambda x, _: F.when(x < n, x).otherwise(network(x)))
