from webloom.sources import jsonl
from webloom.sources.tables import shared_dir


def test_round_trip_and_modes(spark):
    path = f"{shared_dir(spark)}/examples"
    df = spark.createDataFrame([("é\n\"x\"", "y"), ("日本", "z")], jsonl.SCHEMA)
    jsonl.write_jsonl(df, path, "overwrite")
    assert sorted(map(tuple, jsonl.read_jsonl(spark, path).collect())) == sorted(map(tuple, df.collect()))
    jsonl.write_jsonl(df, path)
    assert jsonl.read_jsonl(spark, path).count() == 4
