"""Removal of lines that repeat across documents.

Every line has a key: the line without ASCII white space at both ends, A-Z lower-cased. Occurrences of keys are
range-partitioned by the key's hash and, within a partition, sorted by hash, document (largest first) and position.
One pass over that order sees the first occurrence of each key, which is the one that stays, and which documents come
after it. What comes out are positions, not texts: for each document one bitmap of the lines that stay, compressed as
the lengths of its runs (stay, go, stay, ...; what is left over stays). ``drop_lines`` puts bitmaps and texts together.

Hashes are the first 128 bits of SHA-256, so equal hashes are equal keys. Keys with over a 1024th of the lines of a
sample (one document in ``SAMPLE``, chosen by a hash of the id) are at most 1024 and known to every task; their lines are ranged by
the input partition too, so that no key is one task's work, and what their ranges say is put together for these keys
alone. A key that the sample misses changes the balance of tasks, never the result.

Defined cases: a null or empty text is one empty line; a null id is one document, smaller than all others; rows of one
id count as one document, and each keeps its own lines by the same rule; ties can't occur, as equal lines of the largest
document all stay; an empty table gives an empty result; lines may have any length and documents any number of
them; other columns are not looked at (``drop_lines`` hands them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

MIN_CHARS = 20
MIN_DOCS = 3
SAMPLE = 16
HOT = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = " \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _row_key(docs: DataFrame) -> DataFrame:
    """With ``_d``, the document's number, and ``_v``, which tells rows of one id apart by their texts."""
    return docs.withColumns({"_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "_v": F.xxhash64(_text())})


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def occurrences(docs: DataFrame, *, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, d, v, pos, part): hash of each line's key that is long enough, its document, its place, and the input partition."""
    lines = _row_key(docs).select("_d", "_v", F.posexplode(_lines(_text())).alias("pos", "line"))
    keyed = lines.withColumn("key", F.translate(F.btrim("line", F.lit(_BLANKS)), _UPPER, _LOWER)).where(F.length("key") >= min_chars)
    return keyed.select(F.substring(F.unhex(F.sha2("key", 256)), 1, 16).alias("h"), F.col("_d").alias("d"), F.col("_v").alias("v"), "pos", F.spark_partition_id().alias("part"))


def _hot_keys(occ: DataFrame) -> DataFrame:
    """At most ``HOT`` keys, each with over a ``HOT``-th of the sampled lines."""
    sample = occ.where(F.pmod(F.xxhash64("d", F.lit(5)), F.lit(SAMPLE)) == 0)
    counted = sample.groupBy("h").count()
    total = counted.agg(F.sum("count").alias("n"))
    return counted.join(F.broadcast(total), F.col("count") * HOT > F.col("n")).select("h", F.lit(True).alias("hot"))


def dropped(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(d, v, pos) of the lines that go: of keys in ``min_docs`` documents or more, all but those of the largest id."""
    occ = materialise(occurrences(docs, min_chars=min_chars), "line-keys")
    spread = occ.join(F.broadcast(_hot_keys(occ)), "h", "left").withColumn("range", F.when(F.col("hot"), F.col("part")).otherwise(0))
    ranged = spread.repartitionByRange("h", "range").sortWithinPartitions("h", "range", F.desc("d"), "pos")
    # the place of a line's document among those of the key, largest first, and how many documents there are
    group = Window.partitionBy("h", "range")
    seen = ranged.withColumn("rank", F.dense_rank().over(group.orderBy(F.desc("d")))).withColumn("docs", F.max("rank").over(group))
    goes = (F.col("rank") > 1) & (F.col("docs") >= min_docs)
    found = materialise(seen.where(F.col("hot") | goes).select(F.when(F.col("hot"), F.col("h")).alias("h"), "d", "v", "pos", "rank"), "line-ranges")
    # keys in several ranges, at most HOT of them: the first documents of each range say which is the largest, and how many there are
    heads = found.where(F.col("h").isNotNull() & (F.col("rank") <= min_docs)).groupBy("h", "d").agg(F.lit(1).alias("one"))
    verdict = heads.groupBy("h").agg(F.max("d").alias("top"), F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("h", "top")
    shared = found.where(F.col("h").isNotNull()).join(F.broadcast(verdict), "h").where(F.col("d") < F.col("top"))
    return found.where(F.col("h").isNull()).select("d", "v", "pos").unionAll(shared.select("d", "v", "pos"))


def _runs() -> tuple[Column, Column]:
    """Of the sorted ``_places`` of what goes: first and last place of each run, and from these the lengths that stay and go in turns."""
    places = F.col("_places")
    starts = F.filter(places, lambda x, k: (k == 0) | (F.get(places, k - 1) != x - 1))
    ends = F.filter(places, lambda x, k: (k == F.size(places) - 1) | (F.get(places, k + 1) != x + 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    lengths = F.transform("_runs", lambda r, k: F.array(r["a"] - F.coalesce(F.get("_runs", k - 1)["b"], F.lit(-1)) - 1, r["b"] - r["a"] + 1))
    return runs, F.flatten(lengths)


def keep_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """(d, v, runs): for each document that loses lines, the bitmap of its lines, as lengths of runs that stay and go in turns."""
    # a set of a text's own places: no larger than the text, however often a row is repeated
    places = dropped(docs, **options).groupBy("d", "v").agg(F.sort_array(F.collect_set("pos")).alias("_places"))
    runs, lengths = _runs()
    return places.withColumn("_runs", runs).select("d", "v", lengths.alias("runs"))


def _marked(docs: DataFrame, **options) -> DataFrame:
    """The documents with ``_lines`` and the ``_keep`` flags of those up to the last that goes (null: all stay)."""
    maps = keep_bitmaps(docs, **options)
    joined = _row_key(docs).join(maps.select(F.col("d").alias("_d"), F.col("v").alias("_v"), F.col("runs").alias("_runs")), ["_d", "_v"], "left")
    flags = F.flatten(F.transform("_runs", lambda n, k: F.array_repeat(k % 2 == 0, n)))
    return joined.withColumns({"_lines": _lines(_text()), "_keep": flags})


_KEPT = "case when _keep is null then _text else array_join(filter(_lines, (x, i) -> coalesce(get(_keep, i), true)), '\n') end"


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    marked = _marked(docs.select("doc_id", "text"), **options).withColumn("_text", _text())
    gone = F.coalesce(F.size(F.filter("_keep", lambda x: ~x)), F.lit(0))
    return marked.select("doc_id", F.size("_lines").cast("long").alias("n_lines"), F.when(F.col("_keep").isNull(), 0).otherwise(gone).cast("long").alias("n_dropped"), F.sha2(F.expr(_KEPT), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, without the lines that go; texts that lose none are as they were."""
    own = [c for c in docs.columns if c != "text"]
    renamed = docs.select(F.col("doc_id"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in own)).alias("_rest")) if own else docs
    marked = _marked(renamed, **options).withColumn("_text", F.col("text").cast("string"))
    whole = marked.select("_rest", F.expr(_KEPT).alias("_new"))
    return whole.select(*(F.col("_new").alias(c) if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns))
