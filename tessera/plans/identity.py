"""Identities of published data, variants of a release, generated state and its history: relational work on tables of files.

A file table has (path, content). Identities don't depend on how JSON is laid out or on metadata that change with each
build. Plans say what would be copied or deleted; copying is left to ``sources.io``.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import canonical_json, to_canonical_json
from tessera.operators.gates import GateError, fold_digest
from tessera.operators.history import tree_diff
from tessera.plans.package import parse_version

JSON, LINES = r"\.json$", r"\.(?:nedb|jsonl)$"


@dataclass(frozen=True)
class Paths:
    """Where a package has what: the surface that its users read."""

    root: str

    def dataset(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def picture(self, kind: str, item: int, ending: str = "webp") -> str:
        if item <= 0:
            raise ValueError(f"no item has the number {item}")
        return f"{self.root.rstrip('/')}/assets/{kind}/{item}.{ending}"


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of the files below a folder, paths relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = folder.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    return files.select(F.replace(F.regexp_replace("path", "^file:/+", "/"), F.lit(root), F.lit("")).alias("path"), "content")


def tarball_files(spark: SparkSession, path: str, *, strip: int = 1) -> DataFrame:
    """(path, content) of the regular files of tar archives, without their first folders; unsafe names stop."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                with tarfile.open(fileobj=io.BytesIO(data.as_py())) as archive:
                    for member in archive:
                        parts = member.name.split("/")
                        if member.name.startswith("/") or ".." in parts or member.issym() or member.islnk():
                            raise ValueError(f"unsafe member of an archive: {member.name}")
                        if member.isfile():
                            yield pa.RecordBatch.from_pydict({"path": ["/".join(parts[strip:])], "content": [archive.extractfile(member).read()]})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(members, "path string, content binary")


def normalized(files: DataFrame, *, volatile: tuple[str, ...] = ()) -> DataFrame:
    """(path, bytes, content): JSON with sorted keys, without volatile metadata; JSON lines line by line; all else as it is."""
    import functools

    from tessera.functions.text import _series

    text = F.decode("content", "UTF-8")
    document = _series(functools.partial(canonical_json, drop=volatile, newline=True), "string")(text)
    lines = _series(_canonical_lines, "string")(text)
    plain = F.when(F.col("path").rlike(JSON), document).when(F.col("path").rlike(LINES), lines)
    return files.select("path", F.octet_length("content").cast("long").alias("bytes"), F.coalesce(plain.cast("binary"), F.col("content")).alias("content"))


def _canonical_lines(value: str | None) -> str | None:
    if value is None:
        return None
    found = [canonical_json(line, newline=True) for line in value.split("\n") if line.strip()]
    return None if None in found else "".join(found)


def identity(files: DataFrame, *, label: str, variant: str, prefixes: tuple[str, ...] = (), leave_out: tuple[str, ...] = (), volatile: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(digest, files): one hash of all data files of a variant, and (path, bytes, sha256) of each.

    The hash folds ``path NUL sha256`` lines in order of path after the label and the variant, each ended by a NUL.
    """
    inside = F.lit(True)
    if prefixes:
        inside = F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.col("path").startswith(p))
    for prefix in leave_out:
        inside = inside & ~F.col("path").startswith(prefix)
    hashed = normalized(files.where(inside), volatile=volatile).select("path", "bytes", F.sha2("content", 256).alias("sha256"))
    return fold_digest(hashed, "path", "sha256", header=f"{label}\0{variant}\0"), hashed


def require_identity(hashed: DataFrame) -> None:
    """Stop if an identity has no files, or one path twice."""
    twice = [r["path"] for r in hashed.groupBy("path").count().where("count > 1").select("path").limit(20).collect()]
    if twice or not hashed.limit(1).count():
        raise GateError("the identity is not sound", "check the package", [{"path": p} for p in twice] or [{"files": 0}])


def same_release(left: DataFrame, right: DataFrame) -> DataFrame:
    """Files (path, bytes, sha256) in which two releases differ, with how."""
    return tree_diff(left, right).where("change <> 'unchanged'")


def variants(files: DataFrame, rules: DataFrame) -> DataFrame:
    """(variant, path, source) of a release set: the files that each variant is built of.

    ``rules``: (variant, source, target): all files below a source folder go below the target folder; of rules that give
    one path, the longest source wins.
    """
    joined = files.join(rules, F.col("path").startswith(F.col("source")))
    placed = joined.select("variant", F.concat("target", F.substring("path", F.length("source") + 1, F.length("path"))).alias("_path"), F.struct(F.length("source").alias("n"), F.col("path").alias("from")).alias("_from"))
    return placed.groupBy("variant", F.col("_path").alias("path")).agg(F.max("_from.from").alias("_any"), F.max("_from").alias("_best")).select("variant", "path", F.col("_best.from").alias("source"))


def plan_variants(built: DataFrame, published: DataFrame) -> DataFrame:
    """(variant, action) by digests (variant, digest): ``publish`` what is new or changed, ``reuse`` what is as published, ``retire`` the rest."""
    new, old = built.select("variant", F.col("digest").alias("_new")), published.select("variant", F.col("digest").alias("_old"))
    action = F.when(F.col("_new").isNull(), "retire").when(F.col("_new").eqNullSafe(F.col("_old")), "reuse").otherwise("publish")
    return new.join(old, "variant", "full").select("variant", action.alias("action"))


def _globs(column: str, patterns: tuple[str, ...]) -> Column:
    """Whether a path, or its name, has the form of any pattern with ``*`` and ``?``."""
    import fnmatch

    name = F.element_at(F.split(column, "/"), -1)
    forms = [fnmatch.translate(p).replace(r"\Z", "$").replace("(?s:", "(?s)(?:") for p in patterns]
    found = F.lit(False)
    for form in forms:
        found = found | F.col(column).rlike(f"^{form}") | name.rlike(f"^{form}")
    return found


def exported(files: DataFrame, roots: tuple[str, ...], excluded: tuple[str, ...] = ()) -> DataFrame:
    """The files that a state is made of: those of some paths or below them, without those of excluded forms."""
    own = F.exists(F.array(*map(F.lit, roots)), lambda r: (F.col("path") == r) | F.col("path").startswith(F.concat(r, F.lit("/"))))
    return files.where(own & ~_globs("path", excluded) if excluded else own)


def state_manifest(files: DataFrame, *, state: str, built: str) -> tuple[DataFrame, DataFrame]:
    """(one row of the state, its build, files, bytes and hash; the files (path, bytes, sha256))."""
    hashed = files.select("path", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    total = hashed.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return total.crossJoin(F.broadcast(fold_digest(hashed, "path", "sha256"))).select(F.lit(state).alias("state"), F.lit(built).alias("build"), "files", "bytes", "digest"), hashed


def sync_plan(state: DataFrame, project: DataFrame, roots: tuple[str, ...]) -> DataFrame:
    """(path, action) that makes a project's files (path, bytes, sha256) below some paths those of a state: copy, replace, delete or keep."""
    diff = tree_diff(exported(project, roots), exported(state, roots))
    return diff.select("path", F.expr("case change when 'added' then 'copy' when 'modified' then 'replace' when 'deleted' then 'delete' else 'keep' end").alias("action"))


def cache_closure(manifest: DataFrame, used: DataFrame) -> DataFrame:
    """(path, state) where a bundle's files and the cache entries that a build used differ: ``missing`` from the bundle, ``unused`` in it."""
    a, b = manifest.select("path").distinct(), used.select("path").distinct()
    return b.join(a, "path", "left_anti").select("path", F.lit("missing").alias("state")).union(a.join(b, "path", "left_anti").select("path", F.lit("unused").alias("state")))


def retired(files: DataFrame, wanted: DataFrame, roots: tuple[str, ...]) -> DataFrame:
    """Files below some paths that nothing wants any more (path)."""
    return exported(files, roots).select("path").join(wanted.select("path").distinct(), "path", "left_anti")


def add_release(history: list[dict], entry: dict) -> list[dict]:
    """The history with an entry of its version first, in the place of an older one of that version."""
    parse_version(entry["version"])
    return [entry, *(e for e in history if e.get("version") != entry["version"])]


def release_history(entries: DataFrame) -> DataFrame:
    """Entries (version, pos, ...) as a history: of one version the last, the newest version first (``rank`` from 1)."""
    from pyspark.sql import Window

    others = [c for c in entries.columns if c != "version"]
    last = entries.groupBy("version").agg(F.max_by(F.struct(*others), "pos").alias("_e")).select("version", "_e.*")
    parts = F.transform(F.split("version", r"\."), lambda x: x.try_cast("int"))
    # one row for each version ever released
    return last.withColumn("rank", F.row_number().over(Window.orderBy(parts.desc())))


def manifest_digest(column: Column) -> Column:
    """The hash of a manifest's canonical text."""
    return F.sha2(to_canonical_json(column), 256)
