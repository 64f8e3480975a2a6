"""Not-modified revisits of web captures, resolved to the response they stand for.

A revisit record says that a page had not changed; its content is that of the latest earlier full response for the same
canonical URL. That is an as-of join: responses and revisits of a URL are put in order of time and each revisit looks
back. A URL's history is cut into stretches of time, so that a URL captured very often is spread over tasks: within a
stretch the last response is carried forward in order, and what each stretch begins with is the latest response
of the stretches before it, of which there is one row each.

Only ids, times and validators are ordered; headers and content follow by record id, for resolved revisits alone.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds of a URL's history that are ordered together.
STRETCH_SECONDS = 86_400

#: Headers that a 304 answer may renew; all others stay as the full response had them.
RENEWABLE = (
    "age",
    "cache-control",
    "content-location",
    "date",
    "etag",
    "expires",
    "last-modified",
    "vary",
    "warning",
)

#: Query parameters that only say where a visitor came from.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """One spelling for one page: scheme and ``www.`` dropped, host in lower case without its default port, fragment, tracking
    parameters and a final slash dropped, other parameters sorted. Null stays null."""
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    plain = F.regexp_replace(plain, r"^(?i:https?)://", "")
    base = F.regexp_extract(plain, r"^([^?]*)", 1)
    query = F.regexp_extract(plain, r"\?(.*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(base, r"^([^/]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(base, r"^[^/]*(/.*)?$", 1), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.concat_ws("&", kept))).otherwise(""))


def _header(name: str) -> Column:
    return F.try_element_at("headers", F.lit(name))


def resolve_revisits(records: DataFrame, stretch_seconds: int = STRETCH_SECONDS) -> DataFrame:
    """Each revisit with the response it stands for.

    ``records`` has record_id, kind ('response' or 'revisit'), url, captured (timestamp), status (long) and headers
    (map, names in lower case). Full responses are those of status 200. Returned: record_id, canonical, response_id,
    outcome and headers:

    - ``resolved``: each validator (etag, last-modified) that the revisit has is equal to the response's, and it has one;
      headers are the response's, renewed by those the revisit may renew;
    - ``changed``: a validator differs or the response lacks it; ``unchecked``: the revisit has no validator. Both keep
      response_id and the revisit's own headers;
    - ``missing``: no earlier response, or no url or time. response_id is null.

    A response at the very time of a revisit is not earlier. Of responses at one time the greatest record_id counts. Repeated
    rows of one record_id give the rows of a join on it; null headers count as none. No rows give no rows.
    """
    rows = records.select(
        "record_id",
        "kind",
        canonical_url(F.col("url")).alias("canonical"),
        F.col("captured").cast("timestamp").alias("captured"),
        "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    )
    response = (F.col("kind") == "response") & (F.col("status") == 200)
    timed = rows.filter(F.col("canonical").isNotNull() & F.col("captured").isNotNull()).select(
        "record_id",
        "kind",
        "canonical",
        "captured",
        F.floor(F.unix_micros("captured") / F.lit(stretch_seconds * 1_000_000)).alias("stretch"),
        F.when(response, F.struct("captured", "record_id", _header("etag").alias("etag"), _header("last-modified").alias("modified"))).alias("full"),
        _header("etag").alias("etag"),
        _header("last-modified").alias("modified"),
    )
    ends = timed.filter("full IS NOT NULL").groupBy("canonical", "stretch").agg(F.max("full").alias("last"))
    asked = timed.filter("kind = 'revisit'")
    # One row for each stretch: what the stretches before it end with.
    stretches = ends.unionByName(asked.select("canonical", "stretch").distinct(), allowMissingColumns=True)
    stretches = stretches.groupBy("canonical", "stretch").agg(F.max("last").alias("last"))
    back = Window.partitionBy("canonical").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select("canonical", "stretch", F.last("last", ignorenulls=True).over(back).alias("carried"))
    # Only strictly earlier rows: those of the same microsecond are left out by the range.
    here = Window.partitionBy("canonical", "stretch").orderBy(F.unix_micros("captured")).rangeBetween(Window.unboundedPreceding, -1)
    placed = timed.filter("full IS NOT NULL OR kind = 'revisit'").withColumn("own", F.max("full").over(here)).filter("kind = 'revisit'")
    found = placed.join(carried, ["canonical", "stretch"], "left").withColumn("full", F.coalesce("own", "carried"))

    def differs(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.col(name).eqNullSafe(F.col(f"full.{name}"))

    outcome = (
        F.when(F.col("full").isNull(), "missing")
        .when(F.col("etag").isNull() & F.col("modified").isNull(), "unchecked")
        .when(differs("etag") | differs("modified"), "changed")
        .otherwise("resolved")
    )
    found = found.select("record_id", F.col("full.record_id").alias("response_id"), outcome.alias("outcome")).distinct()
    revisits = rows.filter("kind = 'revisit'").join(found, "record_id", "left")
    own = rows.filter(response).select(F.col("record_id").alias("response_id"), F.col("headers").alias("full_headers"))
    joined = revisits.withColumn("outcome", F.coalesce("outcome", F.lit("missing"))).join(own, "response_id", "left")
    renewed = F.map_filter("headers", lambda k, _: k.isin(*RENEWABLE))
    kept = F.map_filter("full_headers", lambda k, _: ~F.array_contains(F.map_keys(renewed), k))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(kept, renewed)).otherwise(F.col("headers"))
    return joined.select("record_id", "canonical", "response_id", "outcome", merged.alias("headers"))
