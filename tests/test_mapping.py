import json

import pytest

from widefold.operators import mapping
from widefold.operators.discovery import discover_entries
from widefold.sources import mappings

KEYS = [(1, "int", "b"), (1, "int", "B"), (1, "int", "ä"), (1, "float", "x"), (2, "int", "z")]


@pytest.fixture
def assigned(spark):
    keys = spark.createDataFrame(KEYS, "customer_id int, kind string, key string")
    tenants = spark.createDataFrame([(1,), (2,), (3,)], "customer_id int")
    return mapping.key_mapping(mapping.assign_columns(keys), tenants)


def as_dict(keys):
    return {(r["customer_id"], r["kind"], r["key"]): r["column"] for r in keys.collect()}


def test_numbering_follows_code_points_per_tenant_and_kind(assigned):
    assert as_dict(assigned.keys) == {
        (1, "int", "B"): "int1",
        (1, "int", "b"): "int2",
        (1, "int", "ä"): "int3",
        (1, "float", "x"): "float1",
        (2, "int", "z"): "int1",
    }
    assert (assigned.int_columns, assigned.float_columns) == (3, 1)
    back = {(r["customer_id"], r["column"]): r["key"] for r in mapping.reverse_mapping(assigned.keys).collect()}
    assert back[(2, "int1")] == "z"


def test_physical_column_prefers_int_and_fails_when_absent(spark, assigned):
    extra = spark.createDataFrame([(1, "float", "b", 2, "float2")], assigned.keys.schema)
    keys = assigned.keys.unionByName(extra)
    wanted = spark.createDataFrame([(1, "b"), (1, "x")], "customer_id int, metric_key string")
    found = {r["metric_key"]: r["target_physical_column"] for r in mapping.physical_column(wanted, keys).collect()}
    assert found == {"b": "int2", "x": "float1"}
    lost = spark.createDataFrame([(2, "b")], "customer_id int, metric_key string")
    with pytest.raises(Exception, match="no column for metric b of tenant 2"):
        mapping.physical_column(lost, keys).collect()


def test_nested_document_round_trip(spark, assigned, tmp_path):
    path = str(tmp_path / "mapping")
    mappings.write_numeric_json(assigned, path)
    read = mappings.read_numeric_json(spark, path)
    assert as_dict(read.keys) == as_dict(assigned.keys)
    assert {r[0] for r in read.tenants.collect()} == {1, 2, 3}
    assert (read.int_columns, read.float_columns) == (3, 1)
    document = json.loads(mappings.numeric_document(assigned).toJSON().first())
    assert document["max_columns"] == {"int_columns": 3, "float_columns": 1}
    assert document["customers"]["1"]["int_keys"] == ["B", "b", "ä"]
    assert document["customers"]["1"]["reverse_float_mapping"] == {"float1": "x"}
    assert document["customers"]["3"]["int_columns"] == 0


def test_table_round_trip(spark, assigned, tmp_path):
    mappings.write_mapping(assigned, str(tmp_path / "m"))
    read = mappings.read_mapping(spark, str(tmp_path / "m"))
    assert as_dict(read.keys) == as_dict(assigned.keys)


def test_document_without_widths_is_rejected(spark, tmp_path):
    (tmp_path / "bad.json").write_text(json.dumps({"customers": {"1": {"int_mapping": {"a": "int1"}}}}))
    with pytest.raises(Exception, match="needs max_columns"):
        mappings.read_numeric_json(spark, str(tmp_path / "bad.json"))


TAGS = {"1": {"keys": ["b", "a", "b"], "key_count": 3}, "2": {"keys": ["c"]}}


@pytest.mark.parametrize("nested", [True, False])
def test_tag_documents_of_both_layouts(spark, tmp_path, nested):
    top = {"customers": TAGS} if nested else dict(TAGS)
    document = {**top, "max_keys_per_customer": 7, "metadata": {"note": "n"}}
    (tmp_path / "tags.json").write_text(json.dumps(document, indent=2))
    tags, declared = mappings.read_tag_json(spark, str(tmp_path / "tags.json"))
    assert declared == 7
    normalised = mapping.normalise_tags(tags)
    rows = {r["customer_id"]: tuple(r)[1:] for r in normalised.collect()}
    assert rows == {1: (["b", "a"], 2, True), 2: (["c"], 1, False)}
    columns = {(r["customer_id"], r["key"]): r["column"] for r in mapping.tag_mapping(normalised).collect()}
    assert columns == {(1, "b"): "string1", (1, "a"): "string2", (2, "c"): "string1"}
    assert mapping.string_columns_needed(normalised, declared).first()[0] == 7
    assert mapping.string_columns_needed(normalised).first()[0] == 2


def test_slots_rank_the_highest_map_column_first(wide):
    fact = wide([{"customerId": 1, "metricIntGroup2": {"k": 1}, "metricIntGroup9": {"k": 1}}])
    entries = discover_entries(fact)
    keys = mapping.mapping_from_entries(entries).keys
    last = {r["group_no"]: r["slot"] for r in mapping.slots(entries, keys, "last").collect()}
    assert last == {9: 16, 2: 17}
    assert {r["slot"] for r in mapping.slots(entries, keys, "sum").collect()} == {16}
    with pytest.raises(ValueError):
        mapping.slots(entries, keys, "first")


def test_tag_document_sorts_and_keeps_tenants_without_tags(wide):
    fact = wide([{"customerId": 1, "tagGroup1": {"b": "", "a": ""}}, {"customerId": 2}])
    rows = {r["customer_id"]: (r["keys"], r["key_count"]) for r in mappings.tag_document(discover_entries(fact, ("string",))).collect()}
    assert rows == {1: (["a", "b"], 2), 2: ([], 0)}
