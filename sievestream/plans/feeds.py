"""Message feeds and rule tables made from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sievestream.files import is_folder
from sievestream.functions import values as V

EPOCH_2024 = 1_704_067_200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Zone-less times in the tables are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a table of fewer splits than cores is spread over all of them before the work on its texts."""
    df = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, "doc_id") if df.rdd.getNumPartitions() < cores else df


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of them."""
    schema, path = table(spark, sf_dir, name).schema, f"{sf_dir}/{name}.parquet"
    if is_folder(spark, path):
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def document_time() -> Column:
    """Documents carry no time: they arrive 37 seconds apart in id order."""
    return F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id") * 37)


def feed_time(ts: Column) -> Column:
    return F.date_format(ts, "EEE MMM dd HH:mm:ss '+0000' yyyy")


def document_lines(docs: DataFrame) -> DataFrame:
    """Every document as a message line."""
    source, lang = F.col("source"), F.col("lang")
    hashtag = lambda c: F.struct(c.alias("text"))
    entities = F.struct(
        F.array(hashtag(lang), hashtag(source)).alias("hashtags"),
        F.array(
            F.struct(
                F.concat(F.lit("https://"), source, F.lit(".example.org/"), "doc_id").alias("expanded_url"),
                F.concat(source, F.lit(".example.org")).alias("display_url"),
            )
        ).alias("urls"),
        F.array(F.struct(lang.alias("id_str"), F.concat(F.lit("Lang_"), lang).alias("screen_name"))).alias("user_mentions"),
    )
    message = F.struct(
        F.col("doc_id").cast("string").alias("id_str"),
        feed_time(document_time()).alias("created_at"),
        "text",
        F.struct(source.alias("id_str"), F.concat(F.lit("Desk_"), source).alias("screen_name")).alias("user"),
        entities.alias("entities"),
    )
    return docs.select(
        F.to_json(message).alias("value"), F.col("doc_id").cast("string").alias("row_id"), document_time().alias("ingest_ts")
    )


def event_lines(events: DataFrame) -> DataFrame:
    """Every event as a line of the class its type stands for: tweet, limit notice, deletion, keep-alive, broken line."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    tweet = F.struct(
        F.col("event_id").cast("string").alias("id_str"),
        feed_time(F.col("ts")).alias("created_at"),
        F.col("props").alias("text"),
        F.struct(F.col("user_id").cast("string").alias("id_str")).alias("user"),
    )
    line = (
        F.when(kind == "click", F.to_json(tweet))
        .when(kind == "error", F.concat(F.lit('{"limit":{"track":'), k, F.lit("}}")))
        .when(kind == "signup", F.concat(F.lit('{"delete":{"status":{"id":'), "event_id", F.lit("}}}")))
        .when(kind == "view", F.lit(""))
        .otherwise(F.concat(F.lit('{"id_str":"'), "event_id"))
    )
    return events.select("event_id", "ts", line.alias("value"))


def benchmark_words(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id, word, rank): the shortest words of at least four letters of every item."""
    words = benchmark.select(
        "item_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))).alias("word")
    )
    shortest = Window.partitionBy("item_id").orderBy(F.length("word"), "word")
    return words.withColumn("rank", F.row_number().over(shortest)).where(F.col("rank") <= n)


def benchmark_rules(benchmark: DataFrame) -> DataFrame:
    """One keyword rule per item: two of its words."""
    words = benchmark_words(benchmark, 2)
    value = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]), " ")
    return words.groupBy("item_id").agg(F.upper(value).alias("value")).select(
        F.lpad(F.col("item_id").cast("string"), 8, "0").alias("rule_id"),
        "value",
        F.lit("bench").alias("tag"),
        F.lit("keyword").alias("orig_type"),
        F.lit("track").alias("rule_type"),
    )


def part_rules(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("rule_id"),
        F.col("p_name").alias("value"),
        F.col("p_brand").alias("tag"),
        F.when(F.col("p_type") == "PROMO", "hashtag").otherwise("keyword").alias("orig_type"),
    )


def all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as follow rules, parts as track rules, suppliers as locations rules."""
    return (
        table(spark, sf_dir, "customer").select(F.lit("follow").alias("rule_type"), F.col("c_custkey").alias("rule_id"))
        .unionByName(table(spark, sf_dir, "part").select(F.lit("track").alias("rule_type"), F.col("p_partkey").alias("rule_id")))
        .unionByName(
            table(spark, sf_dir, "supplier").select(F.lit("locations").alias("rule_type"), F.col("s_suppkey").alias("rule_id"))
        )
    )


def supplier_box(shape: str = "%d,%d,%d,%d") -> Column:
    """A box of each supplier: its nation gives the west edge, its balance the south edge."""
    west = F.col("s_nationkey").cast("int") * 14 - 180
    south = F.floor(F.col("s_acctbal") / 125).cast("int") - 10
    return F.format_string(shape, west, south, west + 9, south + 12)


def customer_area() -> Column:
    """A place for each customer, as a box without extent."""
    lon = F.col("c_nationkey") * 14.0 - 175.0
    lat = F.col("c_acctbal") / 125.0
    return F.struct(lon.alias("lon1"), lat.alias("lat1"), lon.alias("lon2"), lat.alias("lat2"))


def dense_events(events: DataFrame) -> DataFrame:
    """(row_id, rule_value, ts): events with time running 10,000 times as fast, so that limits bite."""
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("rule_value"),
        F.timestamp_micros(V.floor_div(V.micros(F.col("ts")), 10000)).alias("ts"),
    )
