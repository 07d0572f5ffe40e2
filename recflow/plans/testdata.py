"""The logical tables of a shop, read from the TPC-H-like test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import word_set
from recflow.session import materialize

# Last day of the events.
RUN_DATE = "2024-01-30"
# Evaluation: lists are built up to the first date, actions count from the second.
FEED_DATE = "2024-01-23"
ACTION_DATE = "2024-01-24"

# The test data has two place levels.
PLACES = ("province", "city")

N_STOPWORDS = 30


class Shop:
    """Lazy logical tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            "n_nationkey", F.col("r_name").alias("province"), F.col("n_name").alias("city")
        )

    def users(self) -> DataFrame:
        customer = self.table("customer")
        return customer.join(self.places(), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("uid"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("role"),
            *PLACES,
        )

    def products(self) -> DataFrame:
        """Parts: name and a description made of brand and type."""
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.concat_ws(" ", "p_brand", "p_type").alias("description"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    def product_places(self) -> DataFrame:
        """A part is at home where the lowest-numbered supplier that shipped it is."""
        homes = self.table("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_suppkey"))
        supplier = self.table("supplier").join(
            self.places(), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return homes.join(supplier, "s_suppkey").select(F.col("l_partkey").alias("id"), *PLACES)

    def posts(self) -> DataFrame:
        """Documents: the first line is the name, the rest the description."""
        text = F.col("text")
        cut = F.instr(text, "\n")
        return spread(self.table("documents"), "doc_id").select(
            F.col("doc_id").alias("id"),
            F.substring_index(text, "\n", 1).alias("name"),
            F.when(cut > 0, F.substring(text, cut + 1, F.length(text)))
            .otherwise("")
            .alias("description"),
            F.col("lang").alias("category"),
            "source",
        )

    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "user_id",
            F.get_json_object("props", "$.k").cast("long").alias("item_id"),
            "event_type",
            F.to_date("ts").alias("day"),
        )

    def tags(self) -> DataFrame:
        """Tag dimension of the products: every brand, type and size."""
        return (
            self.table("part")
            .select(
                F.inline(
                    F.array(
                        _tag(1, F.col("p_brand")),
                        _tag(2, F.col("p_type")),
                        _tag(3, F.col("p_size").cast("string")),
                    )
                )
            )
            .distinct()
            .select(_tag_id(F.col("category_id"), F.col("tag_name")).alias("tag_id"), "tag_name", "category_id")
        )

    def tag_categories(self) -> DataFrame:
        """The tag kinds of the products."""
        kind = F.col("category_id")
        return self.tags().select("category_id").distinct().select(
            kind.alias("tag_category_id"),
            F.when(kind == 1, "brand").when(kind == 2, "type").otherwise("size").alias("category_name"),
        )

    def _part_tags(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"),
            F.array(
                _tag_id(F.lit(1), F.col("p_brand")),
                _tag_id(F.lit(2), F.col("p_type")),
                _tag_id(F.lit(3), F.col("p_size").cast("string")),
            ).alias("tags"),
        )

    def product_tags(self) -> DataFrame:
        return self._part_tags().select("item_id", F.explode("tags").alias("tag_id"))

    def purchases(self) -> DataFrame:
        """(user_id, item_id) of every order line."""
        lines = self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        return lines.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))

    def bought(self) -> DataFrame:
        """Distinct (user_id, item_id) of all orders."""
        return self.purchases().distinct()

    def user_product_tags(self) -> DataFrame:
        """A user has the tags of the products they bought; one row per purchase and tag."""
        return (
            self.purchases()
            .join(self._part_tags(), "item_id")
            .select("user_id", F.explode("tags").alias("tag_id"))
        )

    def post_tags(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("item_id"),
            F.explode(
                F.array(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("source:"), "source"))
            ).alias("tag_id"),
        )

    def seen_posts(self) -> DataFrame:
        """Distinct (user_id, item_id) of the events whose item is a post."""
        posts = self.table("documents").select(F.col("doc_id").alias("item_id"))
        seen = self.events().select("user_id", "item_id").distinct()
        return seen.join(posts, "item_id", "left_semi").select("user_id", "item_id")

    def user_post_tags(self) -> DataFrame:
        return self.seen_posts().join(self.post_tags(), "item_id").select("user_id", "tag_id")

    @cached_property
    def stopwords(self) -> DataFrame:
        """The words found in the most documents; found once, as several texts need them."""
        words = spread(self.table("documents"), "doc_id").select(F.explode(word_set(F.col("text"))).alias("key_word"))
        counts = words.groupBy("key_word").agg(F.count("*").alias("n"))
        top = counts.orderBy(F.desc("n"), "key_word").limit(N_STOPWORDS).select("key_word")
        return materialize(top, "stopwords")

    def vectors(self, id_col: str) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias(id_col), F.col("embedding").alias("vec")
        )

    def actions(self) -> DataFrame:
        """What users did after the lists were shown."""
        late = self.events().where(F.col("day") >= F.lit(ACTION_DATE).cast("date"))
        return late.select("user_id", "item_id").distinct()


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan of fewer splits than there are cores, spread over the cores; any other as it is.

    For row work that costs more than moving the rows, such as cutting texts into words.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def _tag(kind, name):
    return F.struct(F.lit(kind).alias("category_id"), name.alias("tag_name"))


def _tag_id(kind, value):
    return F.concat_ws(":", kind.cast("string"), value)
