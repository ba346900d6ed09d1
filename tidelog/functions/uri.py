"""Topic URIs as columns: parse, validate, rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.constants import DEFAULT_PROTOCOL, RN_PATTERN, RN_STANDARD, URI_PATTERN


def parse_topic_uri(uri: Column) -> Column:
    """Struct of a URI's parts. `problem` is null for a good URI, else says what is wrong."""
    # The URI pattern admits no other slash, so the split is the protocol boundary.
    pieces = F.split(uri, ":/")
    rn = F.element_at(pieces, -1)
    protocol = F.when(F.size(pieces) > 1, pieces[0]).otherwise(F.lit(DEFAULT_PROTOCOL))
    part = F.split(rn, ":", -1)
    place = F.split(F.get(part, F.lit(3)), "_")
    topic = F.nullif(F.get(part, F.lit(6)), F.lit(""))
    problem = (
        F.when(uri.isNull() | ~uri.rlike(URI_PATTERN), "malformed uri")
        .when(~rn.rlike(RN_PATTERN), "malformed name")
        .when(F.get(part, F.lit(0)) != RN_STANDARD, "wrong standard")
    )
    good = problem.isNull()
    return F.struct(
        problem.alias("problem"),
        F.when(good, protocol).alias("protocol"),
        F.when(good, rn).alias("rn"),
        F.when(good, F.get(part, F.lit(0))).alias("standard"),
        F.when(good, F.get(part, F.lit(1))).alias("service"),
        F.when(good, F.get(part, F.lit(2))).alias("environment"),
        F.when(good, F.get(place, F.lit(0))).alias("cloud"),
        F.when(good, F.get(place, F.lit(1))).alias("region"),
        F.when(good, F.get(part, F.lit(4))).alias("classifier"),
        F.when(good, F.get(part, F.lit(5))).alias("cluster"),
        F.when(good, topic).alias("topic"),
    )


def cluster_prefix(parsed: Column) -> Column:
    """The cluster's own URI: everything up to the topic, ending in a colon."""
    return F.concat(
        parsed["protocol"], F.lit(":/"),
        F.concat_ws(
            ":", parsed["standard"], parsed["service"], parsed["environment"],
            F.concat(parsed["cloud"], F.lit("_"), parsed["region"]), parsed["classifier"], parsed["cluster"],
        ),
        F.lit(":"),
    )


def build_topic_uri(parsed: Column) -> Column:
    return F.concat(cluster_prefix(parsed), F.coalesce(parsed["topic"], F.lit("")))


def with_uri_parts(df: DataFrame, column: str = "topic_uri") -> DataFrame:
    """Add `rn_parts`, the parsed struct of `column`."""
    return df.withColumn("rn_parts", parse_topic_uri(F.col(column)))


def topic_inventory(uris: DataFrame, column: str = "topic_uri") -> DataFrame:
    """One row per distinct URI with its parts flattened."""
    parsed = uris.select(column).distinct().select(column, parse_topic_uri(F.col(column)).alias("p"))
    return parsed.select(column, "p.*")
