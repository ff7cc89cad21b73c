"""Ordered assignment against letting everyone choose in turn."""

import random

import pytest

from cadenza.operators import assign

SCHEMA = "who long, ord long, what string, place long"


def in_turn(rows):
    taken, out = set(), {}
    for who, o in sorted({(w, o) for w, o, t, _ in rows if w is not None}, key=lambda x: (x[1], x[0])):
        for _, t in sorted((p, t) for w, _, t, p in rows if w == who and t is not None):
            if t not in taken:
                taken.add(t)
                out[who] = t
                break
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_as_if_in_turn(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for who in range(60):
        o = rnd.randrange(30)
        rows += [(who, o, f"m{rnd.randrange(25 if who % 2 else 8)}", rnd.randrange(4)) for _ in range(rnd.randrange(5))]
    rows += [(None, 1, "m1", 1), (70, 2, None, 1), *rows[:5]]
    got, _ = assign.assign(spark.createDataFrame(rows, SCHEMA).repartition(3))
    out = {r.who: r.what for r in got.collect()}
    assert out == in_turn(rows) and len(set(out.values())) == len(out)


def test_a_long_chain_takes_few_rounds(spark):
    """Ten thousand, each displaced by the one before."""
    n = 10_000
    df = spark.range(1, n + 1).selectExpr("id as who", "id as ord", "explode(array(struct(concat('m', greatest(id - 1, 1)) as what, 1L as place), struct(concat('m', id) as what, 2L as place))) as w").selectExpr("who", "ord", "w.what", "w.place")
    got, steps = assign.assign(df)
    assert steps <= 20 and got.where("what = concat('m', who)").count() == n


def test_rounds_are_bounded(spark):
    rows = [(1, 1, "a", 1), (2, 2, "a", 1), (2, 2, "b", 2), (3, 3, "b", 1), (3, 3, "c", 2)]
    with pytest.raises(RuntimeError, match="rounds"):
        assign.assign(spark.createDataFrame(rows, SCHEMA), rounds=1)
    assert assign.assign(spark.createDataFrame([], SCHEMA))[0].count() == 0
