"""Merkle manifest of a dataset: leaf digests, a tree per group, inclusion proofs.

A leaf is H of its row's fields. Per group, leaves ascend by key; while more than one
node remains, every ``ARITY`` consecutive nodes (the last run may hold fewer) become H of
their digests. The groups' roots, in order of the group, likewise give the root.

Plan: digests are taken where the rows are read, so only keys and digests move. A range
sort by (group, key) with counts per (partition, group) numbers the leaves. Level by
level the tree is reduced by aggregation (each level a sixteenth of the one before).
A superblock is ``ARITY ** LEVELS`` consecutive leaves of a group; it needs its own leaves
and, from outside, only the runs on the way from its top node to the root. Leaves and
these outer nodes are cogrouped by superblock, and one function finishes there the local
reduction, the proofs and the recomputed roots. No group, however large, is ever in
one task: a superblock has at most 4,096 leaves and one row of outer nodes.

Defined results: a null field counts as ``-``; leaves without key come first; leaves of equal
key go by leaf digest, and equal rows have consecutive places, each with its own
proof; a null group is a group of its own, the first; a group of one leaf has that
leaf as its root; an empty table gives no rows; extra columns are ignored, and texts may be
of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import LOWER, UPPER, lower_ascii, written

ARITY = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ("_key string, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def row_hash(fields: Sequence[Column]) -> Column:
    """H of the fields: ``-`` if null, else the value's UTF-8 byte count, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")),
                        F.lit("-")) for c in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with a non-null group column ``_g``) plus ``_at``, the place in the group
    from 0 by ``order`` (unique within a group), and ``_n``, the group's row count. Written."""
    keys = ["_g", *order]
    dealt = written(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    counts = dealt.groupBy("_g", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_g", "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy("_g")).alias("_n"))
    place = F.row_number().over(Window.partitionBy("_g", "_range").orderBy(*order))
    placed = dealt.join(counts, ["_g", "_range"]).withColumn("_at", F.col("_before") + place - 1)
    return written(placed.drop("_range", "_before"), "merkle-placed")


def runs_of(nodes: DataFrame) -> DataFrame:
    """One row per run of ``nodes`` (_g, _at, _n, digest): its number ``_run`` and its digests in order."""
    run = F.array_sort(F.collect_list(F.struct("_at", "digest")))
    return (nodes.filter("_n > 1").groupBy("_g", F.expr(f"_at div {ARITY}").alias("_run"))
            .agg(run.alias("_held"), F.max("_n").alias("_n"))
            .select("_g", "_run", "_n", F.col("_held.digest").alias("digests")))


def parents(runs: DataFrame) -> DataFrame:
    """The nodes above the runs."""
    return runs.select("_g", F.col("_run").alias("_at"), F.expr(f"(_n + {ARITY - 1}) div {ARITY}").alias("_n"),
                       F.sha2(F.array_join("digests", "").cast("binary"), 256).alias("digest"))


def depth(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Tree:
    """The trees over numbered ``nodes``, one per group: ``tops`` (_g, digest), and the runs of
    all levels from ``keep_from`` on, written."""

    def __init__(self, nodes: DataFrame, keep_from: int = 0):
        most = nodes.agg(F.max("_n")).first()[0] or 0
        self.keep_from, self.runs = keep_from, []
        tops = []
        for level in range(depth(most)):
            tops.append(nodes.filter("_n = 1"))
            runs = runs_of(nodes)
            if level >= keep_from:
                runs = written(runs, f"merkle-runs-{level}")
                self.runs.append(runs)
            nodes = parents(runs)
            if level + 1 == keep_from:
                nodes = written(nodes, "merkle-blocks")
        for t in tops:
            nodes = nodes.select("_g", "_n", "digest").union(t.select("_g", "_n", "digest"))
        self.tops = written(nodes.select("_g", "digest"), "merkle-tops")

    def paths(self, starts: DataFrame, at: str, path: str) -> DataFrame:
        """``starts`` (_g and a node number ``at`` on the first kept level) plus ``path``: for each
        level up to the group's root the node's place in its run and the run's digests."""
        out = starts.withColumn("_walk", F.col(at)).withColumn(
            path, F.array().cast("array<struct<place:int,digests:array<string>>>"))
        for runs in self.runs:
            step = runs.select("_g", F.col("_run").alias("_up"), "digests")
            out = out.withColumn("_up", F.expr(f"_walk div {ARITY}")).join(step, ["_g", "_up"], "left")
            place = F.col("_walk").cast("int") % ARITY
            out = out.withColumn(path, F.when(F.col("digests").isNull(), F.col(path)).otherwise(
                F.concat(path, F.array(F.struct(place.alias("place"), "digests")))))
            out = out.withColumn("_walk", F.col("_up")).drop("_up", "digests")
        return out.drop("_walk")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def fold(node: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    """The root recomputed from a node and its siblings, level by level."""
    for place, held in path:
        node = digest("".join(held[:place]) + node + "".join(held[place + 1:]))
    return node


def finish(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """One superblock: local reduction, proofs and folded roots of its leaves."""
    if leaves.empty:
        return pd.DataFrame(columns=[c.split()[0] for c in RESULT.split(", ")])
    leaves = leaves.sort_values("_at")
    info = outer.iloc[0]
    above = [(int(step["place"]), list(step["digests"])) for name in ("path", "top_path") for step in info[name]]
    above_text = "".join(d for place, held in above for d in (*held[:place], *held[place + 1:]))
    # Levels of this superblock; runs start at multiples of ARITY in the group and so in the block.
    levels, nodes, n = [], leaves["digest"].tolist(), int(leaves["_n"].iloc[0])
    while n > 1 and len(levels) < LEVELS:
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        levels.append(runs)
        nodes, n = [digest("".join(r)) for r in runs], -(-n // ARITY)
    out = []
    for i, (key, leaf, changed) in enumerate(zip(leaves["_key"], leaves["digest"], leaves["changed"])):
        path, at = [], i
        for runs in levels:
            path.append((at % ARITY, runs[at // ARITY]))
            at //= ARITY
        local = "".join(d for place, held in path for d in (*held[:place], *held[place + 1:]))
        folded = fold(leaf if changed is None else changed, path + above)
        out.append((key, leaf, info["subroot"], info["root"], digest(local + above_text), folded, folded == info["root"]))
    return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """Per row of ``docs``: key, leaf, subroot (its group's root), root, proof_sha256 (H of all
    siblings from the leaf up), folded_root and verified.

    ``changed`` replaces fields in the rows where ``when`` holds: the leaf presented for
    verification is then H of the changed row, folded with the original siblings."""
    leaf = row_hash([F.col(f) for f in fields])
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(when, row_hash([changed.get(f, F.col(f)) for f in fields]))
    group_key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col(group).cast("string")))
    rows = docs.select(F.col(key).alias("_order"), group_key.alias("_g"), leaf.alias("digest"), other.alias("changed"),
                       F.monotonically_increasing_id().alias("_tie"))
    placed = numbered(rows, ["_order", "digest", "_tie"])
    tree = Tree(placed.select("_g", "_at", "_n", "digest"), keep_from=LEVELS)
    sources = numbered(tree.tops.withColumnRenamed("_g", "_name").withColumn("_g", F.lit("")), ["_name"])
    over = Tree(sources.select("_g", "_at", "_n", "digest"))
    size = ARITY ** LEVELS
    blocks = placed.select("_g", F.expr(f"_at div {size}").alias("_block")).distinct()
    outer = tree.paths(blocks, "_block", "path")
    root = over.tops.first()
    tops = over.paths(sources, "_at", "top_path").withColumn("root", F.lit(root.digest if root else None).cast("string"))
    tops = tops.select(F.col("_name").alias("_g"), F.col("digest").alias("subroot"), "root", "top_path")
    outer = outer.join(tops, "_g").toDF("_of_g", "_of_block", "path", "subroot", "root", "top_path")
    leaves = placed.select("_g", F.expr(f"_at div {size}").alias("_block"), F.col("_order").cast("string").alias("_key"),
                           "digest", "changed", "_at", "_n")
    done = leaves.groupBy("_g", "_block").cogroup(outer.groupBy("_of_g", "_of_block")).applyInPandas(finish, RESULT)
    return done.select(F.col("_key").cast(docs.schema[key].dataType).alias(key), "leaf", "subroot", "root",
                       "proof_sha256", "folded_root", "verified")


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, verified after tampering: rows where 5 divides crc32 of the
    decimal doc_id present their text with A-Z lower-cased (rows without doc_id are left)."""
    return manifest(docs, changed={"text": lower_ascii(F.col("text"))},
                    when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def _step(rows: str, runs: str, nodes: str, k: str) -> str:
    """One level in SQL: ``runs{k}`` from ``nodes``, the nodes above, and the leaves' next state."""
    return f"""
{runs} AS (SELECT g, pos // {ARITY} AS run, max(n) AS n, string_agg(digest, '' ORDER BY pos) AS held
  FROM {nodes} WHERE n > 1 GROUP BY g, pos // {ARITY}),
{nodes}_up AS (SELECT g, run AS pos, (n + {ARITY - 1}) // {ARITY} AS n, sha256(held) AS digest FROM {runs}
  UNION ALL SELECT g, pos, n, digest FROM {nodes} WHERE n = 1),
{rows}_up AS (SELECT l.* EXCLUDE (pos, proof, folded),
    CASE WHEN r.run IS NULL THEN l.pos ELSE r.run END AS pos,
    CASE WHEN r.run IS NULL THEN l.proof
         ELSE l.proof || left(r.held, 64 * (l.pos % {ARITY})) || substr(r.held, 64 * (l.pos % {ARITY}) + 65) END AS proof,
    CASE WHEN r.run IS NULL THEN l.folded
         ELSE sha256(left(r.held, 64 * (l.pos % {ARITY})) || l.folded || substr(r.held, 64 * (l.pos % {ARITY}) + 65)) END AS folded
  FROM {rows} l LEFT JOIN {runs} r ON l.g = r.g AND l.pos // {ARITY} = r.run)"""


def oracle(levels: int = 5, source_levels: int = 2) -> str:
    """DuckDB SQL of ``document_manifest``, level by level (up to 16^levels leaves a source)."""
    def part(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def row(text: str) -> str:
        return "sha256(" + " || ".join([*[part(f) for f in FIELDS[:-1]], part(text)]) + ")"

    bits = ", ".join(["-1"] * 8)
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
           f"lambda c: [ascii(c)::BIGINT, {bits}]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 "
           f"THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)")
    ctes = [f"""
hashed AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS g, {row('text')} AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed FROM documents),
l0 AS (SELECT doc_id, g, leaf, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  coalesce(changed, leaf) AS folded, '' AS proof, count(*) OVER (PARTITION BY g) AS n FROM hashed),
t0 AS (SELECT g, pos, n, leaf AS digest FROM l0)"""]
    for k in range(levels):
        ctes.append(_step(f"l{k}", f"r{k}", f"t{k}", str(k)).replace(f"l{k}_up", f"l{k + 1}").replace(f"t{k}_up", f"t{k + 1}"))
    ctes.append(f"""
u0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, digest, g AS name FROM t{levels}),
s0 AS (SELECT l.doc_id, l.leaf, l.folded, l.proof, u.digest AS subroot, '' AS g, u.pos FROM l{levels} l JOIN u0 u ON l.g = u.name)""")
    for k in range(source_levels):
        ctes.append(_step(f"s{k}", f"q{k}", f"u{k}", str(k)).replace(f"s{k}_up", f"s{k + 1}").replace(f"u{k}_up", f"u{k + 1}"))
    return ("WITH " + ",".join(ctes) + f"""
SELECT s.doc_id, s.leaf, s.subroot, u.digest AS root, sha256(s.proof) AS proof_sha256, s.folded AS folded_root,
       s.folded = u.digest AS verified FROM s{source_levels} s CROSS JOIN u{source_levels} u""")


ORACLE = oracle()
