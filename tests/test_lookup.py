"""The catalogue look-up does not trust the estimated size of parsed lines."""

from feedrec.operators import history as H
from feedrec.sources.readers import parse_catalog_lines
from tests.conftest import rows


def test_parsed_catalogue_is_not_broadcast(spark, tmp_path):
    lines = [(f"{i}\t1\t1\tu\t{i % 5}\t{i % 2}\t{1500000000 + i}\ta,b",) for i in range(3000)]
    path = str(tmp_path / "catalog.parquet")
    spark.createDataFrame(lines, "value string").write.parquet(path)
    dl = spark.createDataFrame([("7", "u1"), ("7", "u1"), ("4", "u2"), ("new", "u2"), ("4", None)], "theme_id string, user_id string")
    out = H.build_history(dl, parse_catalog_lines(spark.read.parquet(path)))
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "Broadcast" not in p
    assert rows(out) == [("u1", "bad", "7", "1", "2", "1500000007"), ("u2", "bad", "new", "0", "3", "1514796503"),
                         ("u2", "good", "4", "0", "4", "1500000004")]
