from pyspark.sql import functions as F

from relayframe.operators.routing import route_table, route_topic


def routed(spark, names, column):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return [r[0] for r in df.select(column(F.col("n"))).collect()]


def test_first_match_wins_and_default_is_the_name(spark):
    routes = [(r"events\.(click|view)", "engagement"), (r"events\..*", "other")]
    names = ["events.click", "events.buy", "x.events.view.y", "logs"]
    assert routed(spark, names, lambda c: route_table(c, routes)) == ["engagement", "other", "engagement", "logs"]
    assert routed(spark, names, route_table) == names


def test_partitioned_tables_share_a_topic(spark):
    routes = [(r"^public.transaction(_\d+)?$", "public.transaction")]
    names = ["public.transaction", "public.transaction_12", "public.transaction_x"]
    expected = ["public.transaction", "public.transaction", "public.transaction_x"]
    assert routed(spark, names, lambda c: route_topic(c, routes)) == expected


def test_prefix_is_not_doubled(spark):
    routes = [("^a$", "cdc.a"), ("^b$", "b")]
    assert routed(spark, ["a", "b", "c"], lambda c: route_topic(c, routes, "cdc")) == ["cdc.a", "cdc.b", "cdc.c"]
