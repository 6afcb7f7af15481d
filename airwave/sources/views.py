"""Logical tables of the engine on the driver's parquet tables, and the same views as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Watching before this day trains, from it on it tests.
CUT = "1996-01-01"


class Views:
    """The views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def watch(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), (F.col("l_quantity") * 60).alias("rating"), F.to_date("l_shipdate").alias("date")
        )

    def train(self) -> DataFrame:
        return self.watch().where(F.col("date") < F.lit(CUT).cast("date"))

    def test(self) -> DataFrame:
        return self.watch().where(F.col("date") >= F.lit(CUT).cast("date"))

    def sched(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("user"), F.get_json_object("props", "$.k").cast("int").alias("item"), F.hour("ts").alias("hour"),
            F.to_date("ts").alias("date"), F.col("value").cast("decimal(18,2)").alias("seconds"), "event_type", "ts",
        )

    def schedule(self) -> DataFrame:
        return self.sched().select(
            F.col("event_type").alias("channel"), F.date_format("ts", "yyyyMMddHHmm").alias("start"), F.col("item").alias("program")
        )

    def program_genre(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("item"), F.posexplode(F.split("p_name", " ")).alias("pos", "genre")).select(
            "item", "genre", (F.col("pos") + 1).alias("rank")
        )

    def channels(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("channel")).distinct()

    def names(self) -> DataFrame:
        """Names of channels in good standing; the others have none."""
        return self.table("supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("channel"), F.col("s_name").alias("name"))

    def texts(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("item"), "text")

    def geo(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("user"),
            (F.lit(24) + F.pmod(F.col("c_custkey") * 37, F.lit(260)) / 10.0).alias("lat"),
            (-(F.lit(66) + F.pmod(F.col("c_custkey") * 53, F.lit(590)) / 10.0)).alias("lon"),
        )

    def user_factors(self) -> DataFrame:
        """A stand-in for trained factors of the training users, exact in both engines."""
        return self.train().select("user").distinct().select("user", F.array(*((F.col("user") * (k + 3) % 17) / 17 for k in range(5))).alias("uf"))

    def item_factors(self) -> DataFrame:
        return self.train().select("item").distinct().select("item", F.array(*((F.col("item") * (k + 5) % 19) / 19 for k in range(5))).alias("vf"))


SQL = {
    "watch": """watch AS (SELECT o_custkey AS "user", l_partkey AS item, l_quantity * 60 AS rating, CAST(l_shipdate AS DATE) AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "train": f"train AS (SELECT * FROM watch WHERE date < DATE '{CUT}')",
    "test": f"test AS (SELECT * FROM watch WHERE date >= DATE '{CUT}')",
    "sched": """sched AS (SELECT user_id AS "user", CAST(json_extract_string(props, '$.k') AS INT) AS item, CAST(hour(ts) AS INT) AS hour,
  CAST(ts AS DATE) AS date, CAST(value AS DECIMAL(18,2)) AS seconds, event_type, ts FROM events)""",
    "schedule": "schedule AS (SELECT event_type AS channel, strftime(ts, '%Y%m%d%H%M') AS start, item AS program FROM sched)",
    "pg": """pg AS (SELECT p_partkey AS item, words[i] AS genre, CAST(i AS INT) AS rank
  FROM (SELECT p_partkey, string_split(p_name, ' ') AS words, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part))""",
    "channels": "channels AS (SELECT DISTINCT l_partkey AS item, l_suppkey AS channel FROM lineitem)",
    "names": "names AS (SELECT s_suppkey AS channel, s_name AS name FROM supplier WHERE s_acctbal >= 0)",
    "texts": "texts AS (SELECT doc_id AS item, text FROM documents)",
    "geo": """geo AS (SELECT c_custkey AS "user", 24 + ((c_custkey * 37) % 260) / 10.0::DOUBLE AS lat,
  -(66 + ((c_custkey * 53) % 590) / 10.0::DOUBLE) AS lon FROM customer)""",
    "uf": 'uf AS (SELECT "user", [' + ", ".join(f'("user" * {k + 3} % 17) / 17' for k in range(5)) + '] AS uf FROM (SELECT DISTINCT "user" FROM train))',
    "vf": "vf AS (SELECT item, [" + ", ".join(f"(item * {k + 5} % 19) / 19" for k in range(5)) + "] AS vf FROM (SELECT DISTINCT item FROM train))",
}
NEEDS = {"train": ["watch"], "test": ["watch"], "schedule": ["sched"], "uf": ["watch", "train"], "vf": ["watch", "train"]}


def with_views(names: str, body: str, recursive: bool = False) -> str:
    """A query over the named views."""
    order: list[str] = []
    for n in names.split():
        for x in [*NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return ("WITH " + "RECURSIVE " * recursive + ",\n".join(SQL[n] for n in order) + "\n" if order else "") + body
