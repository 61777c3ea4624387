"""Packaging: manifests and locks of bundles, reuse of unchanged inputs, versions, reports.

A manifest has a row for each file; its rows, not the files, reach the driver, which writes them as one document.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.gates import GateError, file_manifest, fold_digest, verify_manifest
from tessera.sources.io import exists, replace_file

MANIFEST, LOCK, STOP = "manifest.json", "ready.lock", "stop.json"
_FILES = "path string, bytes long, sha256 string"


def write_document(spark: SparkSession, path: str, value) -> None:
    """A JSON document, put in its place in one step."""
    replace_file(spark, path, (json.dumps(value, sort_keys=True, ensure_ascii=False, indent=1) + "\n").encode())


def read_document(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _contents(spark: SparkSession, folder: str) -> DataFrame:
    return file_manifest(spark, folder).where(~F.col("path").isin(MANIFEST, LOCK, STOP) & ~F.col("path").rlike(r"\.crc$"))


def write_manifest(spark: SparkSession, folder: str, **facts) -> dict:
    """List a bundle's files with their hashes and one hash of all."""
    files = _contents(spark, folder).cache()
    document = facts | {"files": [r.asDict() for r in files.orderBy("path").collect()], "contentHash": fold_digest(files, "path", "sha256").first()[0]}
    files.unpersist()
    write_document(spark, f"{folder}/{MANIFEST}", document)
    return document


def check_manifest(spark: SparkSession, folder: str) -> dict:
    """Stop unless a bundle's files are those of its manifest."""
    document = read_document(spark, f"{folder}/{MANIFEST}")
    listed = spark.createDataFrame([(f["path"], f["bytes"], f["sha256"]) for f in document["files"]], _FILES)
    wrong = [r.asDict() for r in verify_manifest(listed, _contents(spark, folder)).orderBy("path").collect()]
    if wrong:
        raise GateError("files differ from the manifest", "build the bundle again", wrong)
    return document


def lock(spark: SparkSession, folder: str) -> dict:
    """Declare a bundle whose manifest holds to be ready, by the manifest's own hash."""
    check_manifest(spark, folder)
    sha = spark.read.format("binaryFile").load(f"{folder}/{MANIFEST}").select(F.sha2("content", 256)).first()[0]
    write_document(spark, f"{folder}/{LOCK}", {"manifestSha256": sha})
    return {"manifestSha256": sha}


def check_lock(spark: SparkSession, folder: str) -> None:
    if not exists(spark, f"{folder}/{LOCK}"):
        raise GateError("the bundle is not ready", "lock it first")
    sha = spark.read.format("binaryFile").load(f"{folder}/{MANIFEST}").select(F.sha2("content", 256)).first()[0]
    if read_document(spark, f"{folder}/{LOCK}")["manifestSha256"] != sha:
        raise GateError("the manifest changed after the lock", "build the bundle again")
    check_manifest(spark, folder)


def reusable(spark: SparkSession, inputs: dict[str, str], metadata: dict | None, outputs: list[str]) -> bool:
    """Whether a step can be skipped: all its inputs' hashes are known and as before, and its outputs are there."""
    before = (metadata or {}).get("inputHashes") or {}
    return bool(inputs) and all(v and before.get(k) == v for k, v in inputs.items()) and all(exists(spark, p) for p in outputs)


_VERSION = re.compile(r"(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)\Z")


def parse_version(version: str) -> tuple[int, int, int]:
    found = _VERSION.match(version)
    if not found:
        raise ValueError(f"not a version of three numbers: {version!r}")
    return tuple(map(int, found.groups()))


def plan_version(current: str, published: str | None, *, changed: bool, part: str = "patch", wanted: str | None = None) -> str | None:
    """The next version: a wanted one if it is higher, else a step of ``part`` if something changed; null for none."""
    base = max(parse_version(current), parse_version(published or "0.0.0"))
    if wanted is not None:
        if parse_version(wanted) <= base:
            raise ValueError(f"{wanted} is not above {'.'.join(map(str, base))}")
        return wanted
    if not changed:
        return None
    at = ("major", "minor", "patch").index(part)
    return ".".join(str(n + 1 if i == at else n if i < at else 0) for i, n in enumerate(base))


def markdown_table(rows: DataFrame, *, most: int = 1000) -> str:
    """The first rows of a small table as Markdown, with a note of how many more there are."""
    shown = rows.limit(most + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in shown[:most]]
    return "\n".join(lines) + ("\n\nThere are more rows.\n" if len(shown) > most else "\n")


def write_stops(spark: SparkSession, folder: str, stops: list[GateError]) -> int:
    """Stops, each once, as one document; their number."""
    distinct = list({str(s): s for s in stops}.values())
    write_document(spark, f"{folder}/{STOP}", [json.loads(str(s)) for s in distinct])
    return len(distinct)
