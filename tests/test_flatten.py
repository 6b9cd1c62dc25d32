import random
from collections import defaultdict

import pytest

from conftest import at
from widefold.model import STANDARD_COLUMNS, flat_schema
from widefold.operators import flatten as flattening, mapping, preagg
from widefold.operators.discovery import discover_entries
from widefold.plans import small_side


def flat_rows(fact, **options):
    keys, entries = mapping.discover_mapping(fact)
    return flattening.flatten(fact, keys, entries, **options), keys


def test_conflicting_groups(wide):
    rows = [
        {"customerId": 1, "timestampMs": at(0, 1), "metricIntGroup2": {"k": 5}},
        {"customerId": 1, "timestampMs": at(0, 2), "metricIntGroup9": {"k": 1}},
        {"customerId": 1, "timestampMs": at(0, 3), "metricIntGroup9": {"k": 2}},
        {"customerId": 1, "timestampMs": at(1), "metricIntGroup2": {"k": 7}},
    ]
    last, _ = flat_rows(wide(rows))
    assert {r["timestampMs"]: r["int1"] for r in last.collect()} == {at(0): 3, at(1): 7}
    summed, _ = flat_rows(wide(rows), conflict="sum")
    assert {r["timestampMs"]: r["int1"] for r in summed.collect()} == {at(0): 8, at(1): 7}


def test_a_present_zero_in_the_highest_group_wins(wide):
    rows = [{"metricIntGroup2": {"k": 5}, "metricIntGroup9": {"k": 0}}]
    flat, _ = flat_rows(wide(rows))
    assert flat.first()["int1"] == 0


def test_rows_without_metrics_null_maps_and_large_sums(wide):
    big = 2**31 - 1
    rows = [
        {"customerId": 1, "sessionId": "empty"},
        {"customerId": 1, "sessionId": "big", "metricIntGroup1": {"k": big}, "metricIntGroup2": None},
        {"customerId": 1, "sessionId": "big", "metricIntGroup1": {"k": big}, "metricFloatGroup1": {"f": 0.5}},
    ]
    flat, keys = flat_rows(wide(rows))
    values = {r["sessionId"]: (r["int1"], r["float1"]) for r in flat.collect()}
    assert values == {"empty": (0, 0.0), "big": (2 * big, 0.5)}
    assert flat.schema.names == flat_schema(keys.int_columns, keys.float_columns).names
    assert [f.dataType for f in flat.schema.fields] == [f.dataType for f in flat_schema(1, 1).fields]


def test_no_metrics_at_all(wide):
    flat, keys = flat_rows(wide([{"customerId": 4}]))
    assert keys.int_columns == 0 and flat.count() == 1 and flat.columns == STANDARD_COLUMNS


def test_missing_tenant_and_unmapped_keys(wide):
    known, _ = mapping.discover_mapping(wide([{"customerId": 1, "metricIntGroup1": {"a": 1}}]))
    fact = wide([{"customerId": 1, "metricIntGroup1": {"a": 2, "b": 3, " ": 1}, "metricFloatGroup2": {"c": 1.0}}])
    assert flattening.flatten(fact, known).first()["int1"] == 2
    lost = {tuple(r) for r in flattening.unmapped_keys(fact, known).collect()}
    assert lost == {(1, "int", "b", 1), (1, "int", " ", 1), (1, "float", "c", 1)}
    with pytest.raises(ValueError, match="no mapping for tenant 2"):
        flattening.flatten(wide([{"customerId": 2}]), known)


def test_representative_is_the_earliest_row(wide):
    rows = [
        {"timestampMs": at(0, 5), "appVersion": "late", "platform": "a"},
        {"timestampMs": at(0, 1), "appVersion": "early", "platform": "z"},
        {"timestampMs": at(0, 1), "appVersion": "early", "platform": "y"},
    ]
    row = preagg.representative(wide(rows)).first()
    assert (row["appVersion"], row["platform"]) == ("early", "y")


def random_rows(count, seed):
    """A third of the rows fall into one group, and keys sit in one or two map columns."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        hot = i % 3 == 0
        tenant = 1 if hot else rng.randrange(3)
        ints = defaultdict(dict)
        for _ in range(rng.randrange(4)):
            key = f"k{rng.randrange(6 + tenant)}"
            ints[f"metricIntGroup{1 + (hash_of(key) + rng.randrange(2)) % 15}"][key] = rng.randrange(-3, 10)
        rows.append(
            {
                "customerId": tenant,
                "clientId": "hot" if hot else f"c{rng.randrange(5)}",
                "sessionId": "s",
                "timestampMs": at(0 if hot else rng.randrange(3), rng.randrange(60)),
                "metricFloatGroup4": {f"f{rng.randrange(2)}": rng.randrange(8) / 4},
                **ints,
            }
        )
    return rows


def hash_of(text):
    return sum(ord(c) for c in text)


def brute_force(rows, columns):
    """Sum per map column, then let the highest map column that holds a key win."""
    groups = defaultdict(lambda: defaultdict(dict))
    for row in rows:
        key = (row["timestampMs"].replace(second=0), row["clientId"], row["customerId"])
        groups[key]
        for number in range(1, 16):
            for kind, prefix in (("int", "metricIntGroup"), ("float", "metricFloatGroup")):
                for name, value in row.get(f"{prefix}{number}", {}).items():
                    held = groups[key][(kind, name)]
                    held[number] = held.get(number, 0) + value
    out = {}
    for key, metrics in groups.items():
        out[key] = {columns[(key[2], *m)]: sums[max(sums)] for m, sums in metrics.items()}
    return out


@pytest.mark.parametrize("limit", [small_side.BROADCAST_LIMIT_BYTES, 0])
def test_against_brute_force(wide, monkeypatch, limit):
    monkeypatch.setattr(small_side.join_lookup, "__defaults__", ("inner", limit))
    rows = random_rows(600, seed=7)
    flat, keys = flat_rows(wide(rows))
    columns = {(r["customer_id"], r["kind"], r["key"]): r["column"] for r in keys.keys.collect()}
    expected = brute_force(rows, columns)
    names = [c for c in flat.columns if c not in STANDARD_COLUMNS]
    got = {(r["timestampMs"], r["clientId"], r["customerId"]): r.asDict() for r in flat.collect()}
    assert got.keys() == expected.keys()
    for key, row in got.items():
        assert {c: row[c] for c in names} == {c: expected[key].get(c, 0) for c in names}


def test_a_large_lookup_is_not_broadcast(wide, spark):
    fact = wide([{"customerId": 1, "clientId": str(i)} for i in range(20)])
    lookup = spark.createDataFrame([(1, "x")], "customerId int, label string")
    joined = small_side.join_lookup(fact, lookup, ["customerId"], "left", limit_bytes=0)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and joined.where("label = 'x'").count() == 20


def test_sum_maps_and_preaggregate(wide):
    rows = [
        {"sessionId": "a", "metricIntGroup1": {"x": 1}, "metricIntGroup3": {"x": 9}},
        {"sessionId": "a", "metricIntGroup1": {"x": 2, "y": 0}},
        {"sessionId": "b"},
    ]
    out = {r["sessionId"]: r for r in preagg.preaggregate(wide(rows)).collect()}
    assert out["a"]["metricIntGroup1"] == {"x": 3, "y": 0} and out["a"]["metricIntGroup3"] == {"x": 9}
    assert out["b"]["metricIntGroup1"] == {} and out["b"]["metricFloatGroup15"] == {}


def test_compression(wide):
    rows = [{"customerId": 1, "timestampMs": at(m)} for m in (0, 0, 1, 200)] + [{"customerId": 2}]
    stats = {r["customer_id"]: tuple(r)[1:] for r in preagg.compression_stats(wide(rows), minutes=60).collect()}
    assert stats == {1: (4, 3, 2, 4 / 3), 2: (1, 1, 1, 1.0)}
    assert tuple(preagg.run_totals(preagg.compression_stats(wide(rows), 60)).first()) == (2, 5, 4, 3)


def test_map_plan_shuffles_partial_sums_and_broadcasts_the_mapping(wide, spark, tmp_path):
    path = str(tmp_path / "wide")
    wide([{"metricIntGroup1": {"a": 1}}]).write.parquet(path)
    flat, _ = flat_rows(spark.read.parquet(path))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in plan and "partial_min" in plan
    assert "BatchEvalPython" not in plan and "RLIKE" not in plan


def test_entries_may_be_reused(wide):
    fact = wide([{"metricIntGroup1": {"a": 1}}])
    entries = discover_entries(fact)
    keys = mapping.mapping_from_entries(entries)
    assert flattening.flatten(fact, keys, entries).first()["int1"] == 1


def test_null_group_keys_keep_their_sums(wide):
    rows = [
        {"clientId": client, "sessionId": session, "metricIntGroup1": {"k": 5}, "metricFloatGroup1": {"f": 0.5}}
        for client, session in ((None, "s"), (None, "s"), ("c", None), (None, None))
    ]
    flat, _ = flat_rows(wide(rows))
    got = {(r["clientId"], r["sessionId"]): (r["int1"], r["float1"]) for r in flat.collect()}
    assert got == {(None, "s"): (10, 1.0), ("c", None): (5, 0.5), (None, None): (5, 0.5)}
    maps = {(r["clientId"], r["sessionId"]): r["metricIntGroup1"] for r in preagg.preaggregate(wide(rows)).collect()}
    assert maps == {(None, "s"): {"k": 10}, ("c", None): {"k": 5}, (None, None): {"k": 5}}
