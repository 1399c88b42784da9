from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def object_store_options(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    tls: bool = False,
) -> dict[str, str]:
    """S3A settings for an S3-compatible store.

    Without keys no credentials provider is named, so the connector's own chain
    (instance roles and the like) stays in charge.
    """
    options = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }
    if endpoint:
        options["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        options["spark.hadoop.fs.s3a.access.key"] = access_key
        options["spark.hadoop.fs.s3a.secret.key"] = secret_key
        options["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
    return options


_COMMIT = "org.apache.spark.internal.io.cloud"
_MANIFEST = "org.apache.hadoop.mapreduce.lib.output.committer.manifest.ManifestCommitterFactory"
_BOUND = {
    "spark.sql.sources.commitProtocolClass": f"{_COMMIT}.PathOutputCommitProtocol",
    "spark.sql.parquet.output.committer.class": f"{_COMMIT}.BindingParquetOutputCommitter",
}


def commit_options(path: str) -> dict[str, str]:
    """How the store of a path commits what tasks have written.

    Renaming, Spark's way on file systems, copies each file on S3 and is not atomic for
    folders there. S3A uploads in parts that become visible when the job commits; Azure
    and Google stores rename single files from a manifest. Both need Spark's module for
    cloud stores. Other schemes keep Spark's committer, as does a path without one.
    """
    scheme = urlsplit(path).scheme
    if scheme == "s3a":
        return {
            **_BOUND,
            "spark.hadoop.fs.s3a.committer.name": "magic",
            "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
            "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": (
                "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory"
            ),
        }
    if scheme in ("abfs", "abfss"):
        factory = "org.apache.hadoop.fs.azurebfs.commit.AzureManifestCommitterFactory"
        return {**_BOUND, f"spark.hadoop.mapreduce.outputcommitter.factory.scheme.{scheme}": factory}
    if scheme == "gs":
        return {**_BOUND, "spark.hadoop.mapreduce.outputcommitter.factory.scheme.gs": _MANIFEST}
    return {}


_MB = 2**20
_TASK = 256 * _MB
# What a cluster is set up for if nobody says how large the feeds are.
UNDECLARED = 2**40


def options_for(input_bytes: int) -> dict[str, str]:
    """Split, shuffle and file sizes for feeds of about `input_bytes`.

    Tasks are of about the same size whatever the size of the feed, so their number grows
    with it; adaptive execution merges what turns out small. A dimension is broadcast
    below the same size everywhere.
    """
    return {
        "spark.sql.files.maxPartitionBytes": str(128 * _MB),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(
            max(-(-input_bytes // _TASK), 200)
        ),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * _MB),
    }


def get_spark_session(
    app_name: str,
    options: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Start or join a session with the settings the operators rely on.

    Dates are computed in UTC. Adaptive execution sizes the shuffle partitions, splits
    the skewed ones of joins, and picks the kind of join by measured size: broadcast a
    small side, hash a side that is small per partition, sort otherwise.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * _MB),
        **(options or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
