"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosine, components.

1. Equal vectors of one label become one class with a count.
2. Every class gets ``tables`` signatures of ``bits`` signs against random hyperplanes.
   Classes of one label that agree in any whole signature meet in a bucket.
3. In a bucket every pair is compared by its exact cosine in double precision.  A bucket
   over ``CHUNK`` classes is cut by hash, and every two chunks meet in one task, so
   no task holds more than about ``2 * CHUNK`` vectors.  A pair is counted in the first
   table where it meets.  A task hands on one row per linked class (how many vectors it
   links with, and a spanning forest), never its pairs.
4. Distributed connected components over the forests give the component.

``bits`` grows with the logarithm of the largest label's classes, so that unrelated vectors
rarely meet; ``tables`` is the least number that finds a pair exactly at the threshold
with probability ``recall`` (closer pairs more often).  Both follow from a count over all
rows (:func:`table_plan`); there is no cap on a bucket, on partners or on links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import sized_broadcast
from .common import frozen, python_ready
from .components import components

#: Classes of a bucket that are compared together.
CHUNK = 1024
#: Other unrelated classes in a class's bucket, about.
BUCKET = 0.25
#: Vectors that are projected together.
SLICE = 1024


def table_plan(classes: int, threshold: float, recall: float = 0.97) -> tuple[int, int]:
    """``(bits, tables)`` for a label of ``classes`` different vectors."""
    bits = min(62, max(6, math.ceil(math.log2(max(1, classes) / BUCKET))))
    agree = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return bits, 1 if agree >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def hyperplanes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    """``dim x (tables * bits)`` normal directions; the same in every task."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, tables * bits))


def sign_hashes(vectors: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """One whole number of ``bits`` signs per vector and table."""
    signs = (vectors @ planes > 0).reshape(len(vectors), -1, bits)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def usable(vector: str, label: str) -> Column:
    """The vector as doubles when it and its label can link: a label, no null or non-finite
    component, not all zero; else null.  A negative zero is a zero."""
    v = F.transform(F.col(vector), lambda x: x.cast("double") + 0.0)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return F.when(F.col(label).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False)), v)


def _matrix(column: pa.Array, rows: np.ndarray | None = None) -> np.ndarray:
    """Vectors of equal length as rows, scaled so that no norm can overflow."""
    if rows is not None:
        column = column.take(pa.array(rows))
    m = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return m / np.abs(m).max(axis=1, keepdims=True)


def signed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``(cls, sigs)`` of ``(cls, dim, v)``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                if dim not in planes:
                    planes[dim] = hyperplanes(int(dim), bits, tables, seed)
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), SLICE):
                    own = at[lo:lo + SLICE]
                    sigs = sign_hashes(_matrix(batch.column(2), own), planes[dim], bits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(own)),
                         pa.ListArray.from_arrays(np.arange(0, sigs.size + 1, tables, dtype=np.int32),
                                                  pa.array(sigs.ravel()))], names=["cls", "sigs"])

    return (python_ready(classes).select("cls", "dim", "v")
            .mapInArrow(work, "cls bigint, sigs array<bigint>"))


def bucket_tasks(sigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(task, tab, side, cls)``: which classes are compared together.

    ``sigs``: ``(cls, lab, sigs)``.  Buckets of one class make no task.  ``side`` is 2 when
    all of a task's classes meet each other, else 0 or 1 and only opposite sides meet.
    """
    key = ["lab", "tab", "sig"]
    member = sigs.select("cls", "lab", F.posexplode("sigs").alias("tab", "sig"))
    size = (member.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .withColumn("k", F.ceil(F.col("n") / chunk).cast("int")).drop("n"))
    placed = member.join(size, key).withColumn("c", F.pmod(F.xxhash64("cls", "tab"), F.col("k")).cast("int"))
    meets = placed.select(*key, "cls", "c", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("x"))
    side = F.when(F.col("c") == F.col("x"), 2).when(F.col("c") < F.col("x"), 0).otherwise(1)
    return meets.select(F.xxhash64(*key, F.least("c", "x"), F.greatest("c", "x")).alias("task"),
                        F.col("tab").cast("int").alias("tab"), side.alias("side"), "cls")


class _Task:
    """The classes of one task, and what their links give."""

    def __init__(self, rows: dict[str, np.ndarray], vectors: np.ndarray, sigs: np.ndarray, threshold: float):
        self.rows, self.sigs, self.threshold = rows, sigs, threshold
        self.vectors, self.norms = vectors, np.sqrt((vectors ** 2).sum(axis=1))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs that link and did not meet in an earlier table."""
        side, lab, tab = self.rows["side"], self.rows["lab"], int(self.rows["tab"][0])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        cosine = ((self.vectors[left] @ self.vectors[right].T)
                  / (self.norms[left][:, None] * self.norms[right][None, :]))
        i, j = np.nonzero(cosine >= self.threshold)
        i, j = left[i], right[j]
        new = (lab[i] == lab[j]) & ((side[i] != 2) | (side[j] != 2) | (i < j)) & (i != j)
        i, j = i[new], j[new]
        for t in range(tab):
            new = self.sigs[i, t] != self.sigs[j, t]
            i, j = i[new], j[new]
        return i, j

    def summary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(cls, links, root)`` of the linked classes; ``root`` is one class per connected part."""
        i, j = self.links()
        cls, n = self.rows["cls"], self.rows["n"]
        if not len(i):
            return cls[:0], cls[:0], cls[:0]
        links = np.zeros(len(cls), dtype=np.int64)
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        root = np.arange(len(cls))
        while True:  # smallest index spreads along links and pointers
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        linked = np.flatnonzero(links)
        return cls[linked], links[linked], cls[root[linked]]


def verified(tasks: DataFrame, classes: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """``(cls, links, root)`` of every task, pairs checked by their exact cosine."""
    names = ["task", "tab", "side", "cls", "lab", "n", "dim"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0

        def close(t: pa.Table) -> None:
            nonlocal held
            t = t.combine_chunks()
            dims = t.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                if len(own) < 2:
                    continue
                part = t.take(pa.array(own)) if len(own) < len(dims) else t
                rows = {c: part.column(c).to_numpy() for c in names}
                sig = part.column("sigs").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
                got = _Task(rows, _matrix(part.column("v").combine_chunks()), sig, threshold).summary()
                if len(got[0]):
                    found.append(got)
                    held += len(got[0])

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)],
                                              names=["cls", "links", "root"])

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            task = t.column("task").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(task)) + 1]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                close(t.slice(lo, hi - lo))
            rest = t.slice(cuts[-1])  # may go on in the next batch
            if held > 50_000:
                yield out()
                found, held = [], 0
        if rest is not None and rest.num_rows:
            close(rest)
        if found:
            yield out()

    full = (tasks.join(classes.select("cls", "lab", "n", "dim", "v"), "cls").join(sigs.select("cls", "sigs"), "cls")
            .select(*names, "v", "sigs"))
    return (full.repartition("task").sortWithinPartitions("task", "cls")
            .mapInArrow(work, "cls bigint, links bigint, root bigint"))


def near_duplicates(rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", recall: float = 0.97,
                    bits: int | None = None, tables: int | None = None, chunk: int = CHUNK,
                    seed: int = 13) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``rows``.

    Two vectors link when their labels are equal and not null, their lengths are equal and
    their cosine is at least ``threshold``.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links, ``kept`` says that it is the row's own.

    A null, zero or empty vector, one with a null or non-finite component, and one without a
    label link with nothing.  Equal vectors of a label always link (a row repeated exactly links
    with its copies); a null id takes part, is never a component's id while another is known,
    and is never kept.  Very long vectors are projected in slices.  Other columns, whatever
    their names, are left out; an empty table gives an empty result.
    """
    own = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"),
                      F.col(f"`{label_col}`").cast("string").alias("label"))
    own = own.select("id", "label", usable("v", "label").alias("v"))
    keyed = own.withColumn("lab", F.xxhash64("label", F.size("v"))).withColumn(
        "cls", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    classes = frozen(keyed.where("v is not null").groupBy("cls", "lab", "v").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .select("cls", "lab", F.size("v").alias("dim"), "n", "first_id", "v"))
    largest = classes.groupBy("lab").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    planned = table_plan(largest, threshold, recall)
    bits = bits or planned[0]
    tables = tables or table_plan(round(BUCKET * 2 ** bits), threshold, recall)[1]

    sigs = frozen(signed(classes, bits, tables, seed))
    tasks = bucket_tasks(sigs.join(classes.select("cls", "lab"), "cls"), chunk)
    found = frozen(verified(tasks, classes, sigs, threshold))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = classes.select("cls", "n", "first_id").join(parts, F.col("cls") == F.col("node"), "left")
    first = (named.where("label is not null").groupBy("label").agg(F.min("first_id").alias("low")))
    known = frozen(named.join(first, "label", "left").join(links, "cls", "left").select(
        "cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("low", "first_id").alias("low")))
    out = keyed.select("id", "cls").join(sized_broadcast(known), "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("low"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
