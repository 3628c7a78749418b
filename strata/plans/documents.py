"""Landing whole JSON documents compared by content.

Set-based form of "validate the payload, compare it with what is stored,
write and log only if it is new or changed": many documents at once, no
document passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.changes import classify_content
from strata.operators.latest import latest_by_key
from strata.operators.quality import lacking_keys
from strata.plans.manifest import content_records
from strata.schemas import UNCHANGED
from strata.session import materialize


@dataclass
class DocumentLanding:
    classified: DataFrame  # valid documents with NEW / CHANGED / UNCHANGED
    records: DataFrame  # log rows for NEW / CHANGED documents
    invalid: DataFrame  # documents lacking required keys, with ``missing_keys``


def land_documents(
    incoming: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    content_col: str,
    required_keys: Sequence[str],
    source: str,
    *,
    stored_hash_col: str | None = None,
    name_col: str = "file_name",
    path_col: str = "file_path",
    strict: bool = False,
    now=None,
) -> DocumentLanding:
    """Validate ``incoming`` JSON documents (required top-level keys present),
    classify the valid ones against ``stored`` by SHA-256 of the content and
    build log rows (size = content bytes, no source time) for NEW/CHANGED.

    Validity, size and digest are worked out row by row, so an invalid document
    never takes a valid one of the same key with it, and contents stay out of
    the join: only keys, sizes and digests are shuffled. ``stored_hash_col``
    names a digest column of ``stored`` (``read_landed(..., with_hash=True)``).

    ``strict=True`` raises when any document is invalid, as a single-payload
    ingest would; otherwise invalid documents are returned for reporting.
    """
    checked = incoming.withColumn("missing_keys", lacking_keys(F.col(content_col), required_keys))
    invalid = checked.filter(F.size("missing_keys") > 0)
    if strict and not invalid.isEmpty():
        raise ValueError(f"documents missing required keys {list(required_keys)}")
    valid = checked.filter(F.size("missing_keys") == 0).drop("missing_keys")
    sized = valid.withColumn("file_size", F.octet_length(content_col))
    classified = classify_content(sized, stored, keys, content_col, previous_hash_col=stored_hash_col)
    records = content_records(classified, source, name_col=name_col, path_col=path_col, now=now)
    return DocumentLanding(classified, records, invalid)


def store_documents(
    incoming: DataFrame,
    store: str,
    keys: Sequence[str],
    content_col: str,
    required_keys: Sequence[str],
    source: str,
    *,
    now,
    **options,
) -> DocumentLanding:
    """Land documents in a parquet store and log what the store holds afterwards.

    NEW and CHANGED contents are appended to ``store`` (keys, content, digest,
    stored_at); then the digests are read back, and a document whose digest is
    not there is logged FAILED with its size, so the next run takes it again.
    """
    spark = incoming.sparkSession
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in incoming.select(*keys, content_col).schema]
    schema = ", ".join([*columns, "content_sha256 string", "stored_at timestamp"])
    newest = lambda: latest_by_key(
        spark.read.schema(schema).parquet(store).select(*keys, "content_sha256", "stored_at"),
        keys, [F.col("stored_at").desc(), F.col("content_sha256").desc()],
    )
    spark.createDataFrame([], schema).write.mode("append").parquet(store)  # the folder is there from the first run on
    landing = land_documents(incoming, newest(), keys, content_col, required_keys, source, stored_hash_col="content_sha256", now=now, **options)
    classified = materialize(landing.classified)
    todo = classified.filter(F.col("action") != UNCHANGED).select(*keys, "content_sha256")
    valid = incoming.filter(F.size(lacking_keys(F.col(content_col), required_keys)) == 0)
    out = valid.withColumn("content_sha256", F.sha2(F.col(content_col), 256)).join(todo, [*keys, "content_sha256"], "left_semi")
    out.select(*keys, content_col, "content_sha256", F.lit(now).alias("stored_at")).write.mode("append").parquet(store)
    records = content_records(
        classified, source, stored=newest(), keys=keys, now=now, **{k: v for k, v in options.items() if k in ("name_col", "path_col")}
    )
    return DocumentLanding(classified, records, landing.invalid)
