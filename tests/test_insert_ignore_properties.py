"""insert_ignore / upsert against a plain model of ON CONFLICT semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetdw.operators.insert_ignore import insert_ignore, upsert

SCHEMA = "k string, tb int, v int"

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
rows = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 99)), max_size=12)


def order(r):
    # tie-break ascending on tb with NULLs last, then the whole row for determinism of the model
    return (r[1] is None, r[1] if r[1] is not None else 0)


def model_insert_ignore(target, batch):
    existing = {r[0] for r in target if r[0] is not None}
    out, seen = [], set()
    for r in sorted(batch, key=order):
        if r[0] is None:
            out.append(r)
        elif r[0] not in existing and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def unique_tiebreaks(batch):
    """The operator is deterministic only when the tie-break separates duplicates."""
    seen = set()
    for r in batch:
        if r[0] is None:
            continue
        k = (r[0], r[1])
        if k in seen:
            return False
        seen.add(k)
    return True


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, batch=rows)
def test_insert_ignore_matches_model(spark, target, batch):
    if not unique_tiebreaks(batch):
        return
    target = [r for r in model_insert_ignore([], target)]  # a valid target has unique non-NULL keys
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    got = sorted(insert_ignore(t, b, ["k"], ["tb"]).collect(), key=repr)
    want = sorted(model_insert_ignore(target, batch), key=repr)
    assert [tuple(r) for r in got] == want
    # applying the result makes the operation idempotent
    merged = t.unionByName(insert_ignore(t, b, ["k"], ["tb"]))
    assert insert_ignore(merged, b, ["k"], ["tb"]).where("k IS NOT NULL").count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, batch=rows)
def test_upsert_matches_model(spark, target, batch):
    if not unique_tiebreaks(batch):
        return
    target = model_insert_ignore([], target)
    first = {}
    for r in sorted(batch, key=order):
        if r[0] is not None and r[0] not in first:
            first[r[0]] = r
    want = ([r for r in target if r[0] is None or r[0] not in first] + list(first.values())
            + [r for r in batch if r[0] is None])
    got = upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA), ["k"], ["tb"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
