"""Two-step publication, the pointer and its log; typed contracts against a plain loop."""

import json
import random

import pytest

from arpent.plans import contract
from arpent.sources import publication as P


def test_a_failed_release_leaves_the_old_one_readable(spark, tmp_path):
    root, frame = str(tmp_path), lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    read = lambda: sorted(r["v"] for r in P.active(spark, root, "sales").collect())
    with pytest.raises(LookupError):
        P.active(spark, root, "sales")
    assert P.publish(frame(1, 2), root, "sales", "r1", 2) == 1 and read() == [1, 2]
    P.stage(frame(3), root, "r2")  # dies between the steps: staged, never committed
    assert read() == [1, 2]
    with pytest.raises(ValueError, match="not 5"):
        P.publish(frame(3), root, "sales", "r3", 5)
    assert read() == [1, 2]
    assert P.publish(frame(4, 5, 6), root, "sales", "r4", 3) == 3 and read() == [4, 5, 6]
    path = P.stage(frame(9), root, "r5")
    with pytest.raises(P.Conflict):
        P.commit(spark, root, "sales", "r5", path, 1, after=2)  # another writer has event 3
    assert read() == [4, 5, 6]
    log = [(r["number"], r["release"], r["status"], r["rows"]) for r in P.history(spark, root, "sales").orderBy("number").collect()]
    assert log == [(1, "r1", "accepted", 2), (2, "r3", "refused", 1), (3, "r4", "accepted", 3)]
    assert P.publish(frame(7), root, "rents", "q1", 1) == 1 and read() == [4, 5, 6]


def plain(text, required, optional):
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        value = None
    if not isinstance(value, dict):
        return [(None, "unreadable")], []
    kinds = {"string": lambda v: isinstance(v, str), "integer": lambda v: isinstance(v, int) and not isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
             "boolean": lambda v: isinstance(v, bool), "object": lambda v: isinstance(v, dict), "null": lambda v: v is None}
    out = []
    for name, spec in {**required, **optional}.items():
        if name not in value:
            out += [(name, "missing")] * (name in required)
        elif not any(kinds[k](value[name]) for k in spec.split("|")):
            out.append((name, "type"))
    return out, sorted(set(value) - set(required) - set(optional))


def test_contract_equals_a_plain_loop(spark):
    rnd = random.Random(4)
    required, optional = {"id": "string", "size": "integer|null", "it's": "number"}, {"flag": "boolean", "more": "object|string"}
    values = ["x", "", 3, -4, 0, 2.5, 12345678901234567890123, True, False, None, {}, {"a": 1}, [1], "7"]
    rows = [json.dumps({k: rnd.choice(values) for k in [*required, *optional, "other", "z"] if rnd.random() < 0.8}) for _ in range(400)]
    rows += [None, "", "{", "[]", "3", "null", "{}"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(rows)], "k int, json string, violations int").drop("violations")
    for r in contract.checked(df, "json", required, optional).collect():
        want = plain(r["json"], required, optional)
        assert ([(v["property"], v["violation"]) for v in r["violations"]], r["undeclared"]) == want, r["json"]
