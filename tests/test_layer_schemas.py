"""Layer schemas grow: columns and struct fields of any unit read back; a changed type is refused."""

import pytest

from plazalens.session import scratch_path
from plazalens.sources.io import declare_layer, read_declared, write_parquet


def put(spark, path, rows, schema):
    df = spark.createDataFrame(rows, schema)
    write_parquet(df, path, mode="overwrite", partition_by=["source_file"])
    declare_layer(spark, path, df.schema)


def test_struct_fields_come_and_go(spark):
    path = scratch_path(spark, "t-schema")
    put(spark, path, [(1, ("True", "no"), "a")], "id long, attributes struct<WiFi:string,HasTV:string>, source_file string")
    put(spark, path, [(2, ("yes", (3,)), "b")],
        "id long, attributes struct<HasTV:string,Hours:struct<Mon:int>>, source_file string")
    put(spark, path, [(3, ((4, 5),), [(6,)], "c")],
        "id long, attributes struct<Hours:struct<Mon:int,Tue:int>>, tags array<struct<x:int>>, source_file string")
    put(spark, path, [(4, None, [(7, "y")], "d")],
        "id long, attributes struct<WiFi:string>, tags array<struct<x:int,y:string>>, source_file string")
    df = read_declared(spark, path)
    assert df.columns == ["id", "attributes", "tags", "source_file"]
    got = {r.id: (r.attributes and r.attributes.asDict(True), r.tags and [t.asDict() for t in r.tags]) for r in df.collect()}
    none = dict(WiFi=None, HasTV=None, Hours=None)
    assert got == {1: ({**none, "WiFi": "True", "HasTV": "no"}, None),
                   2: ({**none, "HasTV": "yes", "Hours": {"Mon": 3, "Tue": None}}, None),
                   3: ({**none, "Hours": {"Mon": 4, "Tue": 5}}, [{"x": 6, "y": None}]),
                   4: (None, [{"x": 7, "y": "y"}])}
    before = df.schema
    put(spark, path, [(5, ("x",), "e")], "id long, attributes struct<HasTV:string>, source_file string")
    assert read_declared(spark, path).schema == before


@pytest.mark.parametrize("schema, row", [
    ("id string, source_file string", ("1", "b")),
    ("id long, a struct<x:string>, source_file string", (1, ("1",), "b")),
    ("id long, a array<int>, source_file string", (1, [1], "b"))])
def test_a_changed_type_is_refused(spark, schema, row):
    path = scratch_path(spark, "t-schema")
    put(spark, path, [(1, (1,), "a")], "id long, a struct<x:int>, source_file string")
    with pytest.raises(ValueError):
        declare_layer(spark, path, spark.createDataFrame([row], schema).schema)
