"""Merkle manifest of a dataset: a tree per language, and one over the languages.

Every level is a table of nodes (group, index in the group, hash). A node's siblings have
indices that follow from its own: the run of ``fan_out`` nodes starts at the index with slot
zero, and the others lie at offsets from it. So the slot-zero rows of a level compute the
indices of their run, an equijoin of the level with itself fetches the hashes, and the same
rows emit the parents. On the way down a node learns its siblings from its parent's run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.llm.common import kept, quoted, tasks

FAN_OUT = 8
#: The fields of a leaf in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before:string,after:string>>"
#: The group of the tree over the languages; no language's group is named so.
ALL = "*"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts laid end to end."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    told = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(told), F.lit(":"), told))


def group_of(lang: Column) -> Column:
    """Names that sort like languages do, null first; a null key would match nothing."""
    return F.when(lang.isNull(), "").otherwise(F.concat(F.lit("+"), lang.cast("string")))


def indexed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``i``, the row's index in its group by ``order``, and ``n``, the group's rows.

    Rows are dealt out by range and sorted inside each part, so one group may fill many parts;
    a row's number in its part is set off by the rows of its group in earlier parts. Only one
    row for each group and part passes the window.
    """
    sorted_ = kept(
        rows.repartitionByRange(tasks(rows.sparkSession), group, *order).sortWithinPartitions(group, *order)
    ).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    parts = sorted_.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = W.partitionBy(group)
    parts = parts.select(
        group, "_part", "_first", F.sum("_rows").over(whole).alias("n"),
        (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")).alias("_before"),
    )
    return sorted_.join(parts, [group, "_part"]).withColumn(
        "i", F.col("_at") - F.col("_first") + F.col("_before")
    ).drop("_at", "_part", "_first", "_rows", "_before")


def next_level(nodes: DataFrame, fan_out: int) -> DataFrame:
    """Parents of a level: g, i, n, h, and ``run``, the hashes of the children in order.

    ``nodes`` has g, i, n (nodes of the group) and h. Groups with a single node are at their
    root and have no parent.
    """
    slot_zero = nodes.where((F.col("n") > 1) & (F.col("i") % fan_out == 0))
    wanted = slot_zero.select("g", "n", F.col("i").alias("first"), F.explode(
        F.sequence("i", F.least(F.col("i") + fan_out, F.col("n")) - 1)
    ).alias("i"))
    met = wanted.join(nodes.select("g", "i", "h"), ["g", "i"])
    runs = met.groupBy("g", "n", "first").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]).alias("run")
    )
    return runs.select(
        "g", F.floor(F.col("first") / fan_out).alias("i"),
        F.ceil(F.col("n") / fan_out).alias("n"), F.sha2(F.array_join("run", ""), 256).alias("h"), "run",
    )


def with_paths(leaves: DataFrame, fan_out: int, largest: int) -> tuple[DataFrame, DataFrame]:
    """Nodes g, i, h of the leaves with ``path``, and the roots (g, h) of the groups.

    A path holds, level by level, what stands before and after the node in its run.
    """
    levels = [leaves]
    while largest > 1:
        # A level is an eighth of the one below; each is computed once, in the shared folder.
        levels.append(kept(next_level(levels[-1], fan_out)))
        largest = -(-largest // fan_out)
    roots = None
    paths = None
    for depth, level in reversed(list(enumerate(levels))):
        top = level.where("n = 1").select("g", "h")
        roots = top if roots is None else roots.union(top)
        alone = F.array().cast(PATH)
        here = level.select("g", "i", "h", *(["run"] if depth else []))
        if paths is None:
            paths = here.withColumn("path", alone)
            continue
        above = paths.select("g", F.col("i").alias("up"), "run", "path")
        slot = (F.col("i") % fan_out).cast("int")
        step = F.struct(
            F.array_join(F.slice("run_above", F.lit(1), slot), "").alias("before"),
            F.array_join(F.slice("run_above", slot + 2, F.lit(fan_out)), "").alias("after"),
        )
        joined = here.withColumn("up", F.floor(F.col("i") / fan_out)).join(
            above.withColumnRenamed("run", "run_above"), ["g", "up"], "left"
        )
        path = F.when(F.col("run_above").isNull(), alone).otherwise(F.concat(F.array(step), "path"))
        paths = joined.withColumn("path", path.cast(PATH)).drop("up", "run_above")
    return paths, roots


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda h, step: hashed(step["before"], h, step["after"]))


def manifest(docs: DataFrame, tampered: Column | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes doc_id, source, lang, n_chars and text. Leaves of a language ascend by id
    (null first; of equal ids by leaf, so repeated rows change nothing) and are hashed in runs
    of ``fan_out`` until one node is left, the subroot; null is a language of its own. The
    subroots, by language, give the root in the same way. The proof names all siblings on the
    way, and ``folded_root`` is computed from the leaf of the document as it is now: texts of
    rows in ``tampered`` have A-Z lower-cased. A text without such letters still verifies. One
    document is its own root. An empty table gives no rows; other columns are dropped.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    own = {c: F.col(quoted(c)) for c in FIELDS}
    changed = {**own, "text": F.translate(own["text"], UPPER, LOWER)}
    leaf = lambda columns: hashed(*[field(columns[c]) for c in FIELDS])
    rows = docs.select(
        group_of(own["lang"]).alias("g"), own["doc_id"].alias("doc_id"), leaf(own).alias("h"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf(changed)).alias("now"),
    )
    rows = kept(indexed(rows, "g", "doc_id", "h"))
    largest = rows.agg(F.max("n")).first()[0] or 0
    paths, subroots = with_paths(rows.select("g", "i", "n", "h"), fan_out, largest)
    tops = kept(subroots)
    langs = indexed(tops.select(F.lit(ALL).alias("all"), F.col("g").alias("lang"), "h"), "all", "lang")
    langs = kept(langs.select(F.col("all").alias("g"), "i", "n", "h", "lang"))
    upper, roots = with_paths(langs.select("g", "i", "n", "h"), fan_out, tops.count())
    # One row for each language; the root is one row.
    upper = upper.join(langs.select("g", "i", "lang"), ["g", "i"]).join(
        roots.select("g", F.col("h").alias("root")), "g"
    ).select(F.col("lang").alias("g"), F.col("h").alias("subroot"), "root", F.col("path").alias("rest"))
    found = rows.join(paths.select("g", "i", "path"), ["g", "i"]).join(upper, "g").select(
        "doc_id", F.col("h").alias("leaf"), "now", "subroot", "root",
        F.concat("path", "rest").alias("path"),
    )
    proof = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    told = found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(proof, ""), 256).alias("proof_sha256"),
        folded(F.coalesce("now", "leaf"), F.col("path")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
