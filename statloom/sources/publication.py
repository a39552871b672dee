"""Publication by key: each document is replaced on its own, and readers see whole commits only.

A store is a folder. A run writes its documents and then the records of all
keys, each to a folder of its own that nobody reads yet, and at last renames
one small file to ``commits/NUMBER.json``. That file names the records, a
record names the folder that holds its document, so whatever a run has not
committed is invisible, and the documents of keys that this run did not replace
stay where they are. A number is taken once: the slower one of two runs fails.

Per key: ``fresh`` if its document was published now, ``no_longer_listed`` if
it is not found any more and the search was complete, ``retained`` if an older
document stays, ``failed`` if there is none.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..operators.merge import FAILED, FRESH, NO_LONGER_LISTED, RETAINED
from ..session import delete
from .sinks import _fs

RECORDS = "key string, status string, error string, version string"
SAFE_KEY = "^[A-Za-z0-9_-]+$"
#: A key of this name would be taken for the store's own list.
RESERVED = "manifest"
# How a document says of itself that it is not whole.
PARTIAL = {"partial_sample": True, "coverage": "partial", "traversal_complete": False, "complete": False}


class UnsafeKey(ValueError):
    """A key that can't name a document; nothing is written."""


class Conflict(RuntimeError):
    """Another run has committed in the meantime."""


def latest(spark: SparkSession, root: str) -> dict | None:
    """What the last commit says, or None."""
    fs, where = _fs(spark, f"{root}/commits")
    if not fs.exists(where):
        return None
    names = sorted(n for n in (f.getPath().getName() for f in fs.listStatus(where)) if n.endswith(".json") and not n.startswith((".", "_")))
    return json.loads(spark.read.text(f"{root}/commits/{names[-1]}", wholetext=True).first()[0]) if names else None


def records(spark: SparkSession, root: str, commit: dict | None) -> DataFrame:
    """(key, status, error, version) of every key of a commit."""
    return spark.read.schema(RECORDS).parquet(f"{root}/records/{commit['version']}") if commit else spark.createDataFrame([], RECORDS)


def read(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame, dict | None]:
    """(documents with their key, records, commit) as of the last commit; ``schema`` is the documents' without key."""
    commit = latest(spark, root)
    held = records(spark, root, commit)
    versions = [r[0] for r in held.where("version IS NOT NULL").select("version").distinct().collect()]  # at most one a run since the last rewrite
    if not versions:
        return spark.createDataFrame([], f"key string, {schema}"), held, commit
    files = spark.read.schema(f"key string, {schema}").parquet(*(f"{root}/documents/{v}/accepted=true" for v in versions))
    files = files.withColumn("version", F.regexp_extract(F.col("_metadata.file_path"), r"/documents/([^/]+)/", 1))
    return files.join(held.where("version IS NOT NULL").select("key", "version"), ["key", "version"], "left_semi").drop("version"), held, commit


def whole(df: DataFrame) -> dict[str, Column]:
    """A rule for each way in which these documents can say that they are not whole."""
    return {"document reports incomplete coverage: " + c: ~F.col(c).eqNullSafe(F.lit(bad)) for c, bad in PARTIAL.items() if c in df.columns}


def _write_documents(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("accepted").parquet(path)


def _write_records(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def _commit(spark: SparkSession, root: str, commit: dict) -> None:
    """Takes the next number by one rename; a number that is taken stays as it is."""
    target = f"{root}/commits/{commit['number']:012d}.json"
    fs, new = _fs(spark, f"{root}/commits/.{uuid.uuid4().hex}")
    _, where = _fs(spark, target)
    out = fs.create(new, False)
    out.write(bytearray(json.dumps(commit, ensure_ascii=False, sort_keys=True).encode()))
    out.close()
    if fs.exists(where) or not fs.rename(new, where):
        fs.delete(new, True)
        raise Conflict(target)


def _checked_keys(frames: list[DataFrame]) -> None:
    bad = [f.select("key").where(~F.coalesce(F.col("key").rlike(SAFE_KEY), F.lit(False)) | (F.col("key") == RESERVED)) for f in frames]
    rows = bad[0]
    for more in bad[1:]:
        rows = rows.unionByName(more)
    if found := rows.first():
        raise UnsafeKey(found["key"])


def publish(spark: SparkSession, root: str, documents: DataFrame, discovered: DataFrame, failures: DataFrame, rules: dict[str, Column] | None = None, discovery_complete: bool = True, warnings: list[str] | None = None) -> dict:
    """Publishes the good documents and the state of every key; returns the commit.

    ``documents`` has key and the document's columns, ``discovered`` the keys
    that were found, ``failures`` (key, error). A document that breaks a rule,
    says that it is not whole, or shares its key with another is a failure of
    its key, and what was published before stays.
    """
    _checked_keys([documents, discovered, failures])
    before = latest(spark, root)
    number = before["number"] + 1 if before else 1
    version = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    commit = {"number": number, "version": version, "discovery_complete": discovery_complete, "warnings": warnings or []}

    broken = failures.groupBy("key").agg(F.min("error").alias("_failure"))
    several = documents.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    judged = checks.rules(documents.join(several, "key", "left"), {"several documents": F.col("_n").isNull(), **(rules or {}), **whole(documents)})
    judged = judged.join(broken, "key", "left").withColumn("error", F.coalesce("_failure", F.concat(F.lit("Validation failed: "), F.col("reason"))))
    accepted = (F.col("error").isNull() & F.col("_failure").isNull()).alias("accepted")
    _write_documents(judged.select(*documents.columns, F.col("error").alias("_error"), accepted), f"{root}/documents/{version}")

    there = spark.read.schema("key string, _error string, accepted boolean").parquet(f"{root}/documents/{version}")
    tried = there.groupBy("key").agg(F.bool_or("accepted").alias("fresh"), F.min("_error").alias("_invalid"))
    listed = discovered.select("key").unionByName(documents.select("key")).unionByName(failures.select("key")).distinct().withColumn("listed", F.lit(True))
    old = records(spark, root, before).select("key", F.col("version").alias("held"))
    rows = listed.join(old, "key", "full_outer").join(tried, "key", "left").join(broken, "key", "left")
    fresh = F.coalesce("fresh", F.lit(False))
    gone = F.col("listed").isNull() & F.lit(discovery_complete)
    status = F.when(fresh, FRESH).when(gone, NO_LONGER_LISTED).when(F.col("held").isNotNull(), RETAINED).otherwise(FAILED)
    error = F.when(~fresh, F.coalesce("_failure", "_invalid"))
    _write_records(rows.select("key", status.alias("status"), error.alias("error"), F.when(fresh, F.lit(version)).otherwise(F.col("held")).alias("version"), F.coalesce("listed", F.lit(False)).alias("listed"), F.col("_failure").isNotNull().alias("broken")), f"{root}/records/{version}")

    now = spark.read.schema(RECORDS + ", listed boolean, broken boolean").parquet(f"{root}/records/{version}")
    figures = now.agg(F.count_if("listed").alias("n"), F.coalesce(F.bool_and((F.col("status") == FRESH) | ~F.col("listed")), F.lit(False)).alias("all"), F.count_if("broken").alias("broken")).first()
    commit |= {"discovered_count": figures["n"], "complete": bool(figures["n"] and discovery_complete and figures["all"] and not figures["broken"])}
    _commit(spark, root, commit)
    return commit


def rewrite(spark: SparkSession, root: str, schema: str) -> dict | None:
    """Brings all documents into one folder, by a commit of its own, and drops folders that no record names."""
    documents, held, before = read(spark, root, schema)
    if before is None:
        return None
    version = f"{before['number'] + 1:012d}-{uuid.uuid4().hex[:12]}"
    _write_documents(documents.withColumn("accepted", F.lit(True)), f"{root}/documents/{version}")
    _write_records(held.withColumn("version", F.when(F.col("version").isNotNull(), F.lit(version))), f"{root}/records/{version}")
    commit = before | {"number": before["number"] + 1, "version": version}
    _commit(spark, root, commit)
    for kind in ("documents", "records"):
        fs, where = _fs(spark, f"{root}/{kind}")
        for f in fs.listStatus(where):
            if f.getPath().getName() < version:
                delete(spark, f"{root}/{kind}/{f.getPath().getName()}")
    return commit
