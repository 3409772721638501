"""Labels out of responses."""

from pyspark.sql import functions as F

from renown.operators.claims import nested_labels


def test_a_response_is_read_once_per_row(spark):
    """Its parse holds a number drawn per evaluation, so labels of one id differ if it is worked out per id."""
    response = F.parse_json(
        F.concat(F.lit('{"entities":{"Q1":{"labels":{"en":{"value":"'), F.uuid(), F.lit('"}}}}}'))
    )
    rows = spark.range(5).select(F.expr("array('Q1', 'Q2', 'Q1', 'Q1')").alias("ids"))
    for (labels,) in rows.select(nested_labels(response, F.col("ids"))).collect():
        assert len(labels) == 3 and len(set(labels)) == 1


def test_odd_responses_and_ids(spark):
    texts = [
        '{"entities":{"a":{"labels":{"en":{"value":"x"}}},"b":{"labels":{"en":{"value":""}}},"c":{"labels":{}},"d":1}}',
        '{"entities":[]}',
        "{}",
        None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    ids = F.expr("array('d', 'c', 'b', null, 'a', 'a', 'z')")
    response = F.parse_json("t")
    every, few, none = (
        F.array_join(c, ",") for c in (
            nested_labels(response, ids), nested_labels(response, ids, max_ids=5), nested_labels(response, F.lit(None).cast("array<string>"))
        )
    )
    assert [tuple(r) for r in rows.select(every, few, none).collect()] == [("x,x", "x", "")] + [("", "", "")] * 3
