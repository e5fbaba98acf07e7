"""Merkle manifest of a table: checkpoint every few levels, recompute the rest for proofs.

Rows become leaves of one tree per language; the languages' subroots are the leaves of the
tree above them.  A node is the SHA-256 of its children's digests as hex text; the last
run of a level may be shorter.

* :func:`grow` stores only every ``step``-th level.  A task folds aligned subtrees of
  ``fanout ** step`` stored nodes (256 by default) and keeps their tops alone.
* :func:`proofs` goes down the stored levels.  A task regenerates the missing interior of one
  aligned subtree from its stored descendants, emits every descendant's siblings, followed by
  the path of the subtree's top, and discards the interior.

Positions come from :func:`.numbering.numbered`, so a language of any size is spread over
tasks; no task sees more than a subtree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import sized_broadcast
from .common import frozen, python_ready
from .numbering import numbered

FANOUT, STEP = 2, 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DIGEST = 64


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: list[str | Column]) -> Column:
    """Digest of a row."""
    return digest(*[encoded(F.col(f"`{c}`") if isinstance(c, str) else c) for c in fields])


def _levels(nodes: list[str], fanout: int, count: int | None) -> list[list[str]]:
    """``nodes`` and the levels above them: ``count`` many, or up to a single node."""
    out = [nodes]
    while len(out) <= count if count is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([sha256("".join(below[i:i + fanout]).encode()).hexdigest()
                    for i in range(0, len(below), fanout)])
    return out


def _path(levels: list[list[str]], at: int, fanout: int) -> list[str]:
    """A step per level: how many siblings stand before the node, ``:``, and the siblings."""
    steps = []
    for level in levels[:-1]:
        before = at % fanout
        run = level[at - before:at - before + fanout]
        steps.append(f"{before}:" + "".join(run[:before] + run[before + 1:]))
        at //= fanout
    return steps


def folded(start: Column, path: Column) -> Column:
    """Root that a leaf and its path lead to."""
    def step(acc: Column, s: Column) -> Column:
        others = F.substring_index(s, ":", -1)
        before = F.substring_index(s, ":", 1).cast("int") * DIGEST
        return digest(F.substring(others, F.lit(1), before), acc,
                      F.substring(others, before + 1, F.length(others)))

    return F.aggregate(path, start, step)


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level."""
    return F.array_join(F.transform(path, lambda s: F.substring_index(s, ":", -1)), "")


@dataclass
class Manifest:
    """Stored levels ``(tree, idx, digest, ...)`` of trees, lowest first, and ``sizes`` ``(tree, n)``."""

    stored: list[DataFrame]
    sizes: DataFrame
    fanout: int
    step: int

    @property
    def width(self) -> int:
        return self.fanout ** self.step

    def groups(self, band: int) -> DataFrame:
        """``(tree, g, levels, members)``: the aligned subtrees over stored level ``band``; ``levels`` is null when
        the subtree ends in the tree's top."""
        nodes = self.stored[band]
        member = F.struct("idx", "digest", *[c for c in nodes.columns if c not in ("tree", "idx", "digest")])
        left = F.ceil(F.col("n") / F.lit(self.width ** band))
        return (nodes.groupBy("tree", F.floor(F.col("idx") / self.width).alias("g"))
                .agg(F.array_sort(F.collect_list(member)).alias("members"))
                .join(sized_broadcast(self.sizes), "tree")
                .select("tree", "g", F.when(left > self.width, self.step).alias("levels"), "members"))

    def tops(self) -> DataFrame:
        """``(tree, digest)``."""
        return self.stored[-1].select("tree", "digest")


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    bounds = column.offsets.to_numpy()
    return bounds - bounds[0], column.flatten()


def grow(leaves: DataFrame, fanout: int = FANOUT, step: int = STEP) -> Manifest:
    """Trees over ``(tree, idx, digest, ...)``, ``idx`` = 0, 1, ... in each tree; more columns stay with the leaves."""
    sizes = frozen(leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    most = sizes.agg(F.max("n")).first()[0] or 1
    m = Manifest([leaves], sizes, fanout, step)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, members = _lists(b.column(3))
            nodes = members.field("digest").to_pylist()
            top = [_levels(nodes[lo:hi], fanout, count)[-1][0]
                   for lo, hi, count in zip(at[:-1], at[1:], b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(top, pa.string())],
                                             names=["tree", "idx", "digest"])

    while True:
        m.stored.append(frozen(python_ready(m.groups(len(m.stored) - 1)).mapInArrow(
            work, "tree string, idx bigint, digest string")))
        most = -(-most // m.width)
        if most <= 1:
            return m


def proofs(m: Manifest) -> DataFrame:
    """The leaves' columns and ``path``, the steps from each leaf to its tree's top."""
    down = None
    for band in reversed(range(len(m.stored) - 1)):
        groups = m.groups(band)
        if down is None:
            groups = groups.withColumn("upper", F.array().cast("array<string>"))
        else:
            above = down.select("tree", F.col("idx").alias("g"), F.col("path").alias("upper"))
            groups = groups.join(above, ["tree", "g"])
        kind = groups.schema["members"].dataType.elementType

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, members = _lists(b.column(3))
                nodes, paths = members.field("digest").to_pylist(), []
                for lo, hi, count, upper in zip(at[:-1], at[1:], b.column(2).to_pylist(), b.column(4).to_pylist()):
                    levels = _levels(nodes[lo:hi], m_fanout, count)
                    paths += [_path(levels, i, m_fanout) + upper for i in range(hi - lo)]
                trees = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), np.diff(at))))
                yield pa.RecordBatch.from_arrays([trees, members, pa.array(paths, pa.list_(pa.string()))],
                                                 names=["tree", "member", "path"])

        m_fanout = m.fanout
        down = (python_ready(groups).select("tree", "g", "levels", "members", "upper")
                .mapInArrow(work, f"tree string, member {kind.simpleString()}, path array<string>")
                .select("tree", "member.*", "path"))
        if band:
            down = frozen(down)
    return down


def manifest(rows: DataFrame, fields: list[str] = FIELDS, tree_col: str = "lang", order_col: str = "doc_id",
             changed: dict[str, Column] | None = None, fanout: int = FANOUT, step: int = STEP) -> DataFrame:
    """``(doc_id, tree, idx, leaf, changed_leaf, path, subroot, root)`` per row.

    ``path`` leads from the leaf over its tree's subroot to the root; :func:`folded` folds it and
    :func:`siblings` lists it.  ``changed`` maps fields to tampered values; ``changed_leaf`` is the leaf of
    a row with them.  Leaves of a tree ascend by ``order_col``, nulls first; equal ones by leaf, so repeated rows
    stand side by side, each with a place of its own.  A null ``tree_col`` is a tree like any other and comes
    first; trees follow by their bytes.  Null fields count as ``-``; texts may be of any length, only digests
    are shuffled; other columns, whatever their names, are left out; an empty table gives an empty result.
    """
    tampered = [(changed or {}).get(c, F.col(f"`{c}`")) for c in fields]
    own = rows.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")), F.lit("-")).alias("tree"),
                      F.col(f"`{order_col}`").alias("order"), leaf(fields).alias("digest"),
                      leaf(tampered).alias("changed_leaf"))
    trees = grow(numbered(own, "tree", ["order", "digest"], "idx"), fanout, step)
    above = trees.tops().select(F.lit("root").alias("top"), F.col("tree").alias("name"), "digest")
    above = grow(numbered(above, "top", ["name"], "idx").withColumnRenamed("top", "tree"), fanout, step)
    roots = frozen(proofs(above).join(sized_broadcast(above.tops().select("tree", F.col("digest").alias("root"))), "tree")
                   .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"),
                           F.col("path").alias("over"), "root"))
    return (proofs(trees).join(sized_broadcast(roots), "tree")
            .select(F.col("order").alias("doc_id"), "tree", "idx", F.col("digest").alias("leaf"), "changed_leaf",
                    F.concat("path", "over").alias("path"), "subroot", "root"))
