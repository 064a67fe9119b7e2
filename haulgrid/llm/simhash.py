"""SimHash near-duplicates: a hierarchical index in Gray order, split over the cluster.

The index has two halves. The upper nodes are masked bit patterns that split the work: of four
blocks of a fingerprint's bits, two fingerprints at most three bits apart share one whole block,
so fingerprints meet below the node (block, value). A node with too many fingerprints is split
again by four blocks of its remaining bits, and so on. The lower nodes are built inside a task: the
fingerprints below an upper node, sorted by the rank their bits have as a Gray code, so that
neighbours share most bits, in runs of ``FANOUT``, runs of runs and so on. Each run keeps the bits
on which all its members agree and its parent's members do not; a search adds up the differences
on the way down and leaves a run as soon as there are more than allowed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import mapped, partitions, stored, table
from haulgrid.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42

#: Members of a run, and the most fingerprints that one task compares with each other.
FANOUT = 16
CELL = 8192
#: Rows that one task indexes, about; queries that descend the index at a time.
BUCKET = 16384
BLOCK = 512
#: Bits of a block, level by level: four blocks of 64, 48 and 36 bits.
LEVELS = (16, 12, 9)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text; zero if it has no word."""
    words = (text or "").encode().lower().split()  # bytes: A to Z and ASCII blanks alone
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        hashes = [digest(joined[i:j], SEED) for i, j in spans]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        some = np.array(hashes[at: at + 65536], "<u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *hashes: str) -> DataFrame:
    """(doc_id, fp) and the columns of hashes of each document; fp holds the 64 bits as a signed number."""

    def of(batch: pd.DataFrame) -> pd.DataFrame:
        prints = np.array([fingerprint(text, shingle) for text in batch["text"]], np.uint64)
        return batch[["doc_id", *hashes]].assign(fp=prints.view(np.int64))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *hashes)
    return mapped(rows, of, ", ".join(["doc_id long", *[f"{name} long" for name in hashes], "fp long"]))


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the order of the 64-bit Gray code."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Runs of the fingerprints of several cells, each sorted in Gray order."""

    def __init__(self, cell: np.ndarray, prints: np.ndarray):
        order = np.lexsort((gray_rank(prints), cell))
        self.prints = prints[order]
        cell = cell[order]
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        sizes = np.diff(np.append(first, len(cell)))
        inside = np.arange(len(cell)) - np.repeat(first, sizes)
        number = np.repeat(np.arange(len(first)), sizes)
        # Upwards: each level's runs as starts among the nodes of the level below.
        self.starts, both, either = [], [self.prints], [self.prints]
        owner, place = number, inside
        while True:
            up = place // FANOUT
            start = np.flatnonzero(np.concatenate(
                ([True], (owner[1:] != owner[:-1]) | (up[1:] != up[:-1]))
            ))
            self.starts.append(np.append(start, len(owner)))
            both.append(np.bitwise_and.reduceat(both[-1], start))
            either.append(np.bitwise_or.reduceat(either[-1], start))
            owner, place = owner[start], up[start]
            if len(owner) == len(first):
                break
        # Downwards: the bits that a node's members share beyond those shared by its parent's.
        self.pattern, self.own = both, []
        shared = [~(low ^ high) for low, high in zip(both, either)]
        for level, mask in enumerate(shared):
            if level + 1 < len(shared):
                parent = np.repeat(shared[level + 1], np.diff(self.starts[level]))
                mask = mask & ~parent
            self.own.append(mask)
        # Place of each node's first fingerprint, to search only among those before a query.
        self.begins = [np.arange(len(self.prints))]
        for start in self.starts:
            self.begins.append(self.begins[-1][start[:-1]])
        self.root = number

    def pairs(self, distance: int = DISTANCE):
        """Blocks of (query, earlier member of its cell) places at most ``distance`` bits apart."""
        top = len(self.starts)
        for at in range(0, len(self.prints), BLOCK):
            query = np.arange(at, min(at + BLOCK, len(self.prints)))
            node = self.root[query]
            apart = np.zeros(len(query), np.uint8)
            for level in range(top, -1, -1):
                wrong = (self.prints[query] ^ self.pattern[level][node]) & self.own[level][node]
                apart = apart + np.bitwise_count(wrong)
                near = np.flatnonzero((apart <= distance) & (self.begins[level][node] < query))
                query, node, apart = query[near], node[near], apart[near]
                if level and len(node):
                    begin = self.starts[level - 1][node]
                    many = self.starts[level - 1][node + 1] - begin
                    skip = np.repeat(np.cumsum(many) - many - begin, many)
                    query, apart = np.repeat(query, many), np.repeat(apart, many)
                    node = np.arange(len(query)) - skip
            if len(node):
                yield query, node


def forest(index: GrayIndex, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the index's pairs join, at most one for each fingerprint."""
    root = np.arange(len(index.prints))
    for one, other in index.pairs(distance):
        while True:
            low, high = root[one], root[other]
            apart = low != high
            if not apart.any():
                break
            one, other = one[apart], other[apart]
            low, high = np.minimum(low, high)[apart], np.maximum(low, high)[apart]
            np.minimum.at(root, high, low)
            while (root != (up := root[root])).any():
                root = up
    child = np.flatnonzero(root != np.arange(len(root)))
    return index.prints[child], index.prints[root[child]]


def _below(rows: DataFrame, width: int) -> DataFrame:
    """Each row under four nodes: by one block of its remaining bits, which leave the rest."""
    nodes = []
    for block in range(4):
        low = F.col("rest").bitwiseAND(F.lit((1 << width * block) - 1))
        high = F.shiftrightunsigned(F.shiftrightunsigned("rest", width * block), width)
        value = F.shiftrightunsigned("rest", width * block).bitwiseAND(F.lit((1 << width) - 1))
        nodes.append(F.struct(
            (F.col("node") * (4 << width) + F.lit(block << width) + value).alias("node"),
            F.shiftleft(high, width * block).bitwiseOR(low).alias("rest"),
        ))
    return rows.withColumn("_n", F.explode(F.array(*nodes))).select("fp", "_n.node", "_n.rest")


def _cells(prints: DataFrame, cell: int) -> DataFrame:
    """(cell, fp): fingerprints that may be close are together in some cell, of bounded size."""
    settled = []
    rows = prints.select("fp", F.lit(1).cast("long").alias("node"), F.col("fp").alias("rest"))
    for width in LEVELS:
        below = _below(rows, width)
        counts = stored(
            below.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > cell), "nodes"
        )
        if counts.isEmpty():
            settled.append(below.select(F.xxhash64("node").alias("cell"), "fp"))
            rows = None
            break
        full = counts.select("node")
        settled.append(below.join(full, "node", "left_anti").select(F.xxhash64("node").alias("cell"), "fp"))
        rows = below.join(full, "node", "left_semi")
    if rows is not None:
        # What shares 37 bits and still is too much for one cell: chunks, each pair of chunks a cell.
        chunks = F.ceil(F.col("n") * 2 / cell).cast("int")
        mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        settled.append(
            rows.join(counts, "node").withColumn("chunks", chunks).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "fp")
        )
    cells = settled[0]
    for more in settled[1:]:
        cells = cells.union(more)
    return cells


def links(prints: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` at most ``distance`` <= 3 bits apart.

    Not every close pair is returned, as a group of copies would make too many; but the links
    connect exactly what the close pairs connect.
    """
    if not 0 <= distance <= 3:
        raise ValueError("four blocks find fingerprints at most three bits apart")
    number = prints.count()
    buckets = max(partitions(prints.sparkSession), -(-4 * number // BUCKET))

    def search(batch: pd.DataFrame) -> pd.DataFrame:
        index = GrayIndex(batch["cell"].to_numpy(), batch["fp"].to_numpy().view(np.uint64))
        a, b = forest(index, distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (
        _cells(prints, cell)
        .withColumn("bucket", F.pmod("cell", F.lit(buckets)))
        .groupBy("bucket").applyInPandas(search, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, cell: int = CELL
) -> DataFrame:
    """(doc_id, fp, component_id) of each document; ``docs`` has doc_id and text.

    Fingerprints at most ``distance`` bits apart link; a component is all that can be reached, and
    its id is the smallest doc_id in it. A NULL or blank text has fingerprint zero and links like
    any other. Repeated rows stay rows and link, as their fingerprints are equal. A NULL doc_id
    names no component. An empty table gives an empty table; other columns are not read. Copies
    are one fingerprint before anything is compared.
    """
    every = stored(fingerprints(docs, shingle), "fingerprints")
    member = _rooted(every.groupBy("fp").agg(F.min("doc_id").alias("first")), distance, cell)
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(member.join(least, "root").select("fp", "component_id"), "named")
    return every.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(distinct: DataFrame, distance: int, cell: int) -> DataFrame:
    """Rows of one fingerprint each, with the root of its component."""
    distinct = stored(distinct, "distinct")
    roots = components(links(distinct.select("fp"), distance, cell))
    member = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    return member.select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each near-duplicate component: that of least doc_id.

    Rows without a doc_id come after those with one; of several with the least id the one of least
    text hash stays, and of those the one of least hash of all columns. So exactly one row of a
    component stays, whether or not its rows have ids. All columns pass through.

    The choice is made on fingerprints and hashes. The rows meet it by these, and copies are one
    row of their task before they do.
    """
    free = "_".join(["_", *docs.columns])
    # The hash passes over NULLs, so it also takes which columns are.
    key = {
        f"{free}none": F.col("doc_id").isNull(), f"{free}id": F.col("doc_id").cast("long"),
        f"{free}text": F.xxhash64(F.col("text").cast("string")),
        f"{free}row": F.xxhash64(*docs.columns, *[F.col(name).isNull() for name in docs.columns]),
    }
    names = list(key)
    prints = fingerprints(docs.withColumns(key), shingle, *names[2:]).withColumnRenamed("doc_id", names[1])
    prints = prints.withColumn(names[0], F.col(names[1]).isNull())
    # Copies are one row of their fingerprint before it meets its root.
    least = prints.groupBy("fp").agg(F.min(F.struct(*names)).alias("first"))
    leaders = _rooted(least, distance, CELL).groupBy("root").agg(F.min("first").alias("key")).select("key.*")
    leaders = stored(leaders, "leaders").select(*[F.col(name).alias(f"{name}_") for name in names])
    # Rows alike in the key are equal; each task keeps one of them before they meet.
    rows = docs.withColumns(key).groupBy(*names).agg(F.first(F.struct(*docs.columns)).alias("row"))
    same = [rows[name].eqNullSafe(leaders[f"{name}_"]) for name in names]
    return rows.join(leaders, same, "left_semi").select("row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, with its fingerprint in hexadecimal."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
