"""A frozen cache of pages as a source: files by their key, with the metadata of their capture, and how one is put there.

``spark.read.format("page_cache").load(root)`` reads (cache_key, url, content, content_sha256, state); the metadata are JSON
lines in ``index.jsonl`` of the root, of which the last of a key counts.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.operators.gates import GateError
from tessera.sources.io import exists, replace_file

INDEX = "index.jsonl"


def safe_path(root: str, key: str) -> str | None:
    """The file of a key, if it lies within the root."""
    path = os.path.normpath(os.path.join(root, key))
    return path if path.startswith(os.path.normpath(root) + os.sep) else None


class PageCache(DataSource):
    """Files of a cache folder that all workers see, checked against their metadata."""

    @classmethod
    def name(cls) -> str:
        return "page_cache"

    def schema(self) -> str:
        return "cache_key string, url string, content string, content_sha256 string, state string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("perPartition", "1000")))


class _Reader(DataSourceReader):
    def __init__(self, root: str, many: int):
        self.root, self.many = root.removeprefix("file://").removeprefix("file:"), many

    def partitions(self) -> list[InputPartition]:
        newest: dict[str, dict] = {}
        index = os.path.join(self.root, INDEX)
        with open(index, encoding="utf-8") if os.path.exists(index) else open(os.devnull) as lines:
            for line in lines:
                try:
                    row = json.loads(line)
                except ValueError:
                    continue
                if isinstance(row, dict) and row.get("cache_key"):
                    newest[row["cache_key"]] = {k: row.get(k) for k in ("cache_key", "url", "content_sha256")}
        rows = [newest[k] for k in sorted(newest)]
        return [InputPartition(rows[k : k + self.many]) for k in range(0, len(rows), self.many)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in partition.value:
            path = safe_path(self.root, row["cache_key"])
            if path is None or not os.path.isfile(path):
                yield row["cache_key"], row["url"], None, row["content_sha256"], "outside" if path is None else "missing"
                continue
            with open(path, "rb") as file:
                data = file.read()
            changed = hashlib.sha256(data).hexdigest() != row["content_sha256"]
            yield row["cache_key"], row["url"], None if changed else data.decode("utf-8", "replace"), row["content_sha256"], "changed" if changed else "ok"


def install_capture(spark: SparkSession, root: str, capture: dict, content: bytes) -> dict:
    """Put a capture's file in its place in one step and its metadata last; a declared hash has to be the content's.

    Cut off between the two, the file is there and its old metadata say that it changed.
    """
    if safe_path("/root", capture["cache_key"]) is None:
        raise GateError("a key leads out of the cache", "check the address", [{"key": capture["cache_key"]}])
    found = hashlib.sha256(content).hexdigest()
    if capture.get("content_sha256") not in (None, found):
        raise GateError("a capture is not what it was declared to be", "capture it again", [{"key": capture["cache_key"]}])
    replace_file(spark, f"{root.rstrip('/')}/{capture['cache_key']}", content)
    row, index = capture | {"content_sha256": found}, f"{root.rstrip('/')}/{INDEX}"
    before = spark.read.text(index, wholetext=True).first()[0] if exists(spark, index) else ""
    kept = [x for x in before.split("\n") if x and f'"cache_key": {json.dumps(row["cache_key"])}' not in x]
    replace_file(spark, index, ("\n".join([*kept, json.dumps(row, ensure_ascii=False)]) + "\n").encode())
    return row
