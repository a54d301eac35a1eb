"""Sources: the entity table, the train/test split and typed CSV/Parquet scans.

``entity_features`` turns the driver's order tables into the wide numeric
shape the pipeline scores (one row per order: ``id``, ``target``,
``feature_1..feature_12``).  It is two joins and one aggregation, declared as
DataFrame operations so that Catalyst prunes the scans to the referenced
columns and plans the joins:

* lineitem is aggregated per order with map-side partial aggregation, so a
  hot order key is combined before the shuffle;
* the aggregate is already hash-partitioned on the order key, so only
  ``orders`` moves for the left join;
* customer is joined on ``o_custkey`` by sort-merge at scale (AQE splits a
  hot customer) and broadcast automatically when it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raretide.functions.hashing import mult_hash32

N_FEATURES = 12
FEATURES = [f"feature_{i}" for i in range(1, N_FEATURES + 1)]
ID, TARGET = "id", "target"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order.

    The target follows urgent/high priority with price > 450000, with noise
    that no feature explains: by a hash of the key a quarter of those rows is
    0, and one in a hundred of the others is 1.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    l_agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("l_quantity").alias("sum_qty"),
        F.max("l_extendedprice").alias("max_price"),
        (F.min("l_discount") + F.lit(0.0)).alias("min_disc"),  # -0.0 -> 0.0
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("double").alias("any_ret"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).cast("double").alias("any_open"),
    )
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(l_agg, o.o_orderkey == l_agg.l_orderkey, "left"))
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") > 450000)
    draw = F.pmod(F.floor(mult_hash32("o_orderkey", 7) / 65536), F.lit(100))
    return j.select(
        F.col("o_orderkey").cast("long").alias(ID),
        F.when(urgent, (draw >= 25).cast("int")).otherwise((draw < 1).cast("int")).alias(TARGET),
        F.col("o_totalprice").alias("feature_1"),
        F.col("c_acctbal").alias("feature_2"),
        F.col("n_items").cast("double").alias("feature_3"),
        F.col("sum_qty").alias("feature_4"),
        F.col("max_price").alias("feature_5"),
        F.col("min_disc").alias("feature_6"),
        F.col("any_ret").alias("feature_7"),
        F.col("any_open").alias("feature_8"),
        F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0).alias("feature_9"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0).alias("feature_10"),
        F.month("o_orderdate").cast("double").alias("feature_11"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("feature_12"),
    )


def is_test(id_col: Column | str = ID) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(c, F.lit(5)) == 0


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Split: ``id % 5 = 0`` is the test side (target dropped), the rest train."""
    ent = entity_features(spark, sf_dir)
    return ent.filter(~is_test()), ent.filter(is_test()).drop(TARGET)


def entity_schema(n_features: int, with_target: bool = True) -> T.StructType:
    fields = [T.StructField(ID, T.LongType(), False)]
    if with_target:
        fields.append(T.StructField(TARGET, T.IntegerType(), True))
    fields += [T.StructField(f"feature_{i}", T.DoubleType(), True) for i in range(1, n_features + 1)]
    return T.StructType(fields)


NULL_TOKENS = ("", "NA", "NaN", "nan", "null", "NULL")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, null_tokens: tuple[str, ...] = NULL_TOKENS,
             rejected: str | None = None) -> DataFrame:
    """Header CSV read by column name: the file's column order does not matter.

    Fields of ``schema`` must all be in the header (others are ignored); cells
    among ``null_tokens`` are NULL.  A cell that does not parse fails the job,
    or, with ``rejected`` naming a column, becomes NULL and is counted there.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    lost = [f.name for f in schema.fields if f.name not in raw.columns]
    if lost:
        raise ValueError(f"{path} lacks the columns {lost}")

    def cell(f: T.StructField) -> Column:
        text = F.trim(F.col(f"`{f.name}`"))
        return F.when(~text.isin(*null_tokens), text)

    typed = [(cell(f), f) for f in schema.fields]
    if rejected is None:
        return raw.select(*[c.cast(f.dataType).alias(f.name) for c, f in typed])
    bad = [(c.isNotNull() & c.try_cast(f.dataType).isNull()).cast("int") for c, f in typed]
    return raw.select(*[c.try_cast(f.dataType).alias(f.name) for c, f in typed], sum(bad[1:], bad[0]).alias(rejected))
