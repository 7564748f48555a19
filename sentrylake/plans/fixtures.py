"""The given test tables seen as security events, payloads, analyses and logs.

Every function is a row-wise projection of a given table, so a query over it
reads that whole table and column pruning still reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions.scalar import threat_severity
from sentrylake.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_events(raw: DataFrame) -> DataFrame:
    """Rows of the ``events`` test table as flat security events (works on streams too)."""
    # A projection of its own, so that the payload is read once per row.
    raw = raw.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    k = F.col("k")
    uid = F.col("user_id")
    kind = F.col("event_type")
    event_type = (
        F.when(kind == "signup", "auth_attempt")
        .when(kind == "click", "network_connection")
        .when(kind == "view", "file_access")
        .when(kind == "purchase", "process_execution")
        .when(kind == "error", "dns_query")
    )
    ts = F.col("ts").cast("timestamp")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return raw.select(
        text("evt_", F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("event_id"),
        ts.alias("ts"),
        F.unix_millis(ts).alias("ts_ms"),
        event_type.alias("event_type"),
        F.when(k < 80, text("192.168.1.", (uid % 250 + 1).cast("string")))
        .when(k < 97, text("192.168.1.", ((uid * 7 + k % 2) % 250 + 1).cast("string")))
        .otherwise(text("192.168.2.", k.cast("string")))
        .alias("source_ip"),
        F.when(k % 4 != 0, text("10.0.0.", (k + 1).cast("string"))).alias("destination_ip"),
        text("user_", uid.cast("string")).alias("user"),
        F.when(k % 50 < 3, "failed").when(k % 50 == 3, "blocked").otherwise("success").alias("status"),
        F.least(F.col("value") / 200.0, F.lit(1.0)).alias("threat_score"),
        F.when(k % 10 < 8, text("primary", (uid % 8).cast("string")))
        .when(k % 10 == 8, text("alt", (k % 8).cast("string")))
        .alias("geo_location"),
        F.when(kind == "view", text("/srv/share/", k.cast("string"))).alias("file_path"),
        F.when(kind == "purchase", text("proc", (k % 20).cast("string"))).alias("process_name"),
        F.when(kind == "error", text("host", k.cast("string"), ".example")).alias("domain"),
        "k",
        F.col("event_id").alias("seq"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_events(table(spark, sf_dir, "events")).drop("k", "seq")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records (key, value, partition, offset) that carry the events as JSON.

    Some payloads are malformed: a cut-off text, an unknown type, an unknown
    status, a missing user or a number given as text, chosen by ``k``.
    """
    ev = map_events(table(spark, sf_dir, "events"))
    k = F.col("k")
    details = {
        "auth_details": F.when(
            F.col("event_type") == "auth_attempt",
            F.struct(
                F.lit("password").alias("auth_type"),
                F.col("status").alias("status"),
                k.alias("attempts_count"),
            ),
        ),
        "network_details": F.when(
            F.col("event_type") == "network_connection",
            F.struct(
                F.lit("tcp").alias("protocol"),
                (k + 1000).alias("destination_port"),
                (F.col("seq") * 10).alias("bytes_sent"),
            ),
        ),
        "file_details": F.when(
            F.col("event_type") == "file_access",
            F.struct(
                F.col("file_path"),
                F.lit("read").alias("operation"),
                (k % 2 == 0).alias("is_encrypted"),
            ),
        ),
        "process_details": F.when(
            F.col("event_type") == "process_execution",
            F.struct(F.col("process_name"), (k + 1).alias("process_id")),
        ),
        "dns_details": F.when(
            F.col("event_type") == "dns_query",
            F.struct(
                F.col("domain").alias("query_name"),
                F.array(F.col("source_ip")).alias("resolved_ips"),
                (k * 60).alias("ttl"),
            ),
        ),
    }
    body = F.to_json(
        F.struct(
            "event_id",
            F.when(k != 94, F.col("ts_ms")).alias("timestamp"),
            F.when(k == 91, "login").otherwise(F.col("event_type")).alias("event_type"),
            "source_ip",
            "destination_ip",
            F.when(k != 93, F.col("user")).alias("user"),
            F.when(k == 92, "unknown").when(k != 4, F.col("status")).alias("status"),
            "threat_score",
            F.struct("geo_location", "file_path", "process_name", "domain").alias("metadata"),
            *[column.alias(name) for name, column in details.items()],
        )
    )
    return ev.select(
        F.col("event_id").alias("key"),
        F.when(k == 90, F.substring(body, 1, 40)).otherwise(body).alias("value"),
        F.lit("security-events").alias("topic"),
        (F.col("seq") % 4).cast("int").alias("partition"),
        F.floor(F.col("seq") / 4).alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One analysis per event with a threat score of at least 0.7."""
    return (
        events(spark, sf_dir)
        .where("threat_score >= 0.7")
        .select(
            "event_id",
            threat_severity("threat_score").alias("severity"),
            F.concat(F.lit("suspicious "), "event_type").alias("attack_type"),
            F.concat(F.lit("seen from "), "source_ip").alias("description"),
            F.array(F.concat(F.lit("review "), "user"), F.concat(F.lit("block "), "source_ip")).alias(
                "recommendations"
            ),
            F.col("threat_score").alias("confidence"),
            F.floor(F.col("ts_ms") / 1000).alias("ts_s"),
        )
    )


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls per conversation: words of user turns are prompt, of assistant turns completion."""
    words = F.size(F.split(F.trim("text"), r"\s+"))
    model = (
        F.when(F.col("conv_id") % 3 == 0, "gpt-4o-mini-2024-07-18")
        .when(F.col("conv_id") % 3 == 1, "gpt-4o")
        .otherwise("local-model")
    )
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(
            F.coalesce(F.sum(F.when(F.col("role") == "user", words)), F.lit(0)).alias("prompt_tokens"),
            F.coalesce(F.sum(F.when(F.col("role") == "assistant", words)), F.lit(0)).alias(
                "completion_tokens"
            ),
        )
        .select(
            "conv_id",
            model.alias("model"),
            "prompt_tokens",
            "completion_tokens",
            F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("conv_id") * 600_000).alias("ts"),
        )
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns rendered as answers with a recommendation section."""
    return (
        table(spark, sf_dir, "conversations")
        .where("role = 'assistant'")
        .select(
            "conv_id",
            "turn",
            F.concat(F.lit("**Recommendations**:\n- "), F.replace("text", F.lit(". "), F.lit("\n- "))).alias(
                "answer"
            ),
        )
    )


def answer_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each conversation had at hand: events, intelligence, its relevance and both layers' flags."""
    role = F.col("role")
    return (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(
            F.count_if(role == "user").alias("n_events"),
            F.count_if(role == "assistant").alias("n_intel"),
        )
        .select(
            "conv_id",
            "n_events",
            "n_intel",
            F.when(F.col("n_intel") > 0, (F.col("conv_id") % 100) / 100.0).alias("avg_relevance"),
            (F.col("conv_id") % 3 == 0).alias("has_realtime"),
            (F.col("conv_id") % 4 == 0).alias("has_batch"),
        )
    )


def intel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as threat intelligence; labelled toxic ones are rated high."""
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("id"),
            F.col("text").alias("description"),
            F.col("source").alias("category"),
            F.when(F.col("toxic") == 1, "high").alias("severity"),
            F.lit(None).cast("string").alias("mitre_attack"),
        )
    )
