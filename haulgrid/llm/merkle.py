"""A Merkle manifest of documents: one digest for all, and a proof for each.

A leaf is the digest of a document's fields. Per language the leaves, in the order of their ids,
are the lowest nodes of a tree of fan-out eight; the roots of the languages are the lowest nodes
of one more such tree. A parent is the SHA-256 of its children's digests as text, so the state of
its hash before a child says all about the children left of it. Tasks keep a copy of that state for
each child slot; to fold a changed child into its parent they resume the copy with the new digest
and the siblings to its right, and never hash the left ones again.

A task holds a block of 8^3 neighbouring nodes, three levels of the tree. Blocks have one root
each, and those are the nodes of the next round, so the rounds are the base-512 logarithm of the
largest language. On the way down each block learns its path to the root, and the lowest blocks
fold their documents along it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import fold_of, lowered, mapped, numbered, stored, table

#: Children of a parent.
FANOUT = 8
#: Levels in a block.
LEVELS = 3
#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many ids' documents are tampered with in the registered query.
TAMPERED = 3

PATH = "array<struct<slot:int,run:array<string>>>"


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two lists of values read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]).cast("binary"), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Run:
    """The children of one parent: a copied hash state before each slot, and what lies right of it."""

    def __init__(self, children: list[str]):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()
        self.right = ["".join(children[slot + 1:]) for slot in range(len(children))]

    def resumed(self, slot: int, child: str) -> str:
        """The parent's digest with another child in this slot."""
        state = self.states[slot].copy()
        state.update((child + self.right[slot]).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(self.children[:slot]) + self.right[slot]


class Block:
    """The levels of a block, each a list of runs.

    A block has all its levels, whatever its size, unless it is the only one of its family, which
    is the first one if that is not full; then the levels end at a single node.
    """

    def __init__(self, number: int, digests: list[str]):
        alone = number == 0 and len(digests) < FANOUT**LEVELS
        self.levels: list[list[Run]] = []
        while len(digests) > 1 if alone else len(self.levels) < LEVELS:
            runs = [Run(digests[at:at + FANOUT]) for at in range(0, len(digests), FANOUT)]
            self.levels.append(runs)
            digests = [run.digest for run in runs]
        self.root = digests[0]

    def steps(self, at: int) -> list[tuple[Run, int]]:
        """The run and slot of a node at each level, from the lowest."""
        found = []
        for runs in self.levels:
            at, slot = divmod(at, FANOUT)
            found.append((runs[at], slot))
        return found


@dataclass
class Tree:
    """Blocks (family, block, nodes) of each round, from the lowest; and (family, digest) of the roots."""

    rounds: list[DataFrame]
    roots: DataFrame


def grown(nodes: DataFrame) -> Tree:
    """The trees over nodes (family, number, digest, ...), numbered from 0 in each family."""
    family = nodes.schema["family"].dataType.simpleString()

    def rooted(blocks: pd.DataFrame) -> pd.DataFrame:
        tops = [Block(b, list(digests)).root for b, digests in zip(blocks["block"], blocks["digests"])]
        return blocks[["family"]].assign(number=blocks["block"], digest=tops)

    rounds = []
    while True:
        rest = [name for name in nodes.columns if name not in ("family", "number")]
        block = F.floor(F.col("number") / FANOUT**LEVELS).alias("block")
        blocks = nodes.groupBy("family", block).agg(
            F.array_sort(F.collect_list(F.struct("number", *rest))).alias("nodes")
        )
        rounds.append(stored(blocks, "merkle-blocks"))
        listed = rounds[-1].select("family", "block", F.col("nodes.digest").alias("digests"))
        nodes = stored(mapped(listed, rooted, f"family {family}, number long, digest string"), "merkle-nodes")
        if not nodes.agg(F.max("number")).first()[0]:
            return Tree(rounds, nodes.select("family", "digest"))


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks beside the paths (family, number, path, ...) of their roots."""
    paths = paths.withColumnsRenamed({"family": "above", "number": "root_number"})
    same = blocks["family"].eqNullSafe(paths["above"]) & (blocks["block"] == paths["root_number"])
    return blocks.join(paths, same).drop("above", "root_number")


def _paths_below(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The path of each node in the blocks; further columns of the paths stay with them."""
    rest = [name for name in paths.columns if name not in ("family", "number", "path")]
    kinds = paths.select("family", "number", "path", *rest).schema

    def below(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            block, upper = Block(row["block"], list(row["digests"])), list(row["path"])
            for at, number in enumerate(row["numbers"]):
                path = [{"slot": slot, "run": run.children} for run, slot in block.steps(at)]
                out.append([row["family"], number, path + upper, *[row[name] for name in rest]])
        return pd.DataFrame(out, columns=kinds.names)

    listed = blocks.select("family", "block", F.col("nodes.number").alias("numbers"), F.col("nodes.digest").alias("digests"))
    columns = ", ".join(f"{kind.name} {kind.dataType.simpleString()}" for kind in kinds)
    return stored(mapped(_with_paths(listed, paths), below, columns, 1), "merkle-paths")


def _all_paths(tree: Tree, paths: DataFrame, lowest: int) -> DataFrame:
    """Paths of the nodes of round ``lowest``, from those of the families' roots."""
    for blocks in reversed(tree.rounds[lowest:]):
        paths = _paths_below(blocks, paths)
    return paths


def _folded(blocks: DataFrame, paths: DataFrame, id_type: str) -> DataFrame:
    """The documents of the lowest blocks with their proofs, folded up to the root."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            nodes = list(row["nodes"])
            block = Block(row["block"], [node["digest"] for node in nodes])
            upper = [(Run(list(step["run"])), step["slot"]) for step in row["path"]]
            above = "".join(run.siblings(slot) for run, slot in upper)
            for at, node in enumerate(nodes):
                steps = block.steps(at)
                proof = "".join([run.siblings(slot) for run, slot in steps]) + above
                value = node["replacement"] or node["digest"]
                for run, slot in steps:
                    value = run.resumed(slot, value)
                for run, slot in upper:
                    value = run.resumed(slot, value)
                out.append((node["doc_id"], node["digest"], row["subroot"], row["root"], proof, value))
        return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof", "folded_root"])

    kinds = "leaf string, subroot string, root string, proof string, folded_root string"
    return mapped(_with_paths(blocks, paths), fold, f"doc_id {id_type}, {kinds}", 1)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of each row of ``docs``.

    ``docs`` has the ``FIELDS``. subroot is the root of the row's language, root that of all;
    proof is the digests of the leaf's siblings as one text, level by level up to the root, left to
    right. ``tampered`` is the text that a verifier would find, NULL for as it was; folded_root is
    the root that follows from it with the proof, so it equals root where nothing was changed.

    A NULL in any field is a value of its own; NULL ids come first in their language and a NULL
    language is a language, the first. Rows with one id are ordered by their leaves; equal rows are
    leaves of their own. An empty or very long text is like any other, and only digests are
    shuffled. An empty table gives an empty table. Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    other = F.lit(None).cast("string") if tampered is None else tampered
    # The rows meet as digests of 32 bytes; the texts stay where they are read.
    # They are written first, as dealing them in ranges reads them twice.
    leaves = stored(docs.select(
        F.col("lang").cast("string").alias("family"), "doc_id",
        leaf_of(*map(F.col, FIELDS)).alias("digest"),
        F.when(other.isNotNull(), leaf_of(*map(F.col, FIELDS[:-1]), other)).alias("replacement"),
    ), "merkle-leaves")
    ordered = numbered(leaves, ["family", "doc_id", "digest"], "merkle-ordered")
    first = stored(ordered.groupBy("family").agg(F.min("number").alias("start")), "merkle-families")
    first = first.withColumnRenamed("family", "of")
    placed = ordered.join(first, ordered["family"].eqNullSafe(first["of"])).select(
        "family", (F.col("number") - F.col("start")).alias("number"), "digest", "replacement", "doc_id"
    )
    tree = grown(placed)
    languages = numbered(tree.roots, ["family"], "merkle-languages").withColumnRenamed("family", "lang")
    top = grown(languages.select(F.lit("").alias("family"), "number", "digest"))
    above = _all_paths(
        top, top.roots.select("family", F.lit(0).cast("long").alias("number"), F.array().cast(PATH).alias("path"),
                              F.col("digest").alias("root")), 0,
    ).drop("family")
    paths = languages.join(above, "number").select(
        F.col("lang").alias("family"), F.lit(0).cast("long").alias("number"), "path", F.col("digest").alias("subroot"), "root"
    )
    return _folded(tree.rounds[0], _all_paths(tree, paths, 1), id_type)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, a third of which were lower-cased after it was made."""
    docs = table(spark, sf_dir, "documents")
    changed = F.when(fold_of("doc_id", TAMPERED) == 0, lowered("text"))
    found = manifest(docs.select(*FIELDS), changed)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Digests, level by level, as recursive queries. CRC-32 is written out bit by bit: DuckDB has none.
SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER () AS row_id,
    sha256({" || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)}) AS leaf,
    sha256({" || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS[:-1])}
      || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lower_leaf,
    xor(list_reduce(list_prepend(4294967295, flatten([[(ascii(c) >> b) & 1 FOR b IN range(8)]
      FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
      lambda crc, bit: xor(crc >> 1, (xor(crc, bit) & 1) * 3988292384)), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT row_id, doc_id, lang, leaf, CASE WHEN crc % {TAMPERED} = 0 THEN lower_leaf ELSE leaf END AS found,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM d
), nodes AS (
  SELECT 0 AS level, lang, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT level + 1, lang, place // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place)), (n + {FANOUT - 1}) // {FANOUT}
  FROM nodes WHERE n > 1 GROUP BY level, lang, place // {FANOUT}, n
), subroots AS (
  SELECT lang, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, rank AS place, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, place // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place)), (n + {FANOUT - 1}) // {FANOUT}
  FROM tops WHERE n > 1 GROUP BY level, place // {FANOUT}, n
), every AS (
  SELECT lang, level, place, digest FROM nodes
), climb AS (
  SELECT row_id, leaves.lang, 0 AS level, place, found AS value, '' AS siblings, height FROM leaves
  JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
  UNION ALL
  SELECT c.row_id, c.lang, c.level + 1, c.place // {FANOUT},
    sha256(string_agg(CASE WHEN e.place = c.place THEN c.value ELSE e.digest END, '' ORDER BY e.place)),
    c.siblings || coalesce(string_agg(e.digest, '' ORDER BY e.place) FILTER (WHERE e.place <> c.place), ''), c.height
  FROM climb c JOIN every e
    ON e.lang IS NOT DISTINCT FROM c.lang AND e.level = c.level AND e.place // {FANOUT} = c.place // {FANOUT}
  WHERE c.level < c.height
  GROUP BY c.row_id, c.lang, c.level, c.place, c.siblings, c.height
), upper AS (
  SELECT row_id, 0 AS level, rank AS place, value, siblings, (SELECT max(level) FROM tops) AS height
  FROM climb JOIN subroots ON climb.lang IS NOT DISTINCT FROM subroots.lang WHERE level = climb.height
  UNION ALL
  SELECT c.row_id, c.level + 1, c.place // {FANOUT},
    sha256(string_agg(CASE WHEN e.place = c.place THEN c.value ELSE e.digest END, '' ORDER BY e.place)),
    c.siblings || coalesce(string_agg(e.digest, '' ORDER BY e.place) FILTER (WHERE e.place <> c.place), ''), c.height
  FROM upper c JOIN tops e ON e.level = c.level AND e.place // {FANOUT} = c.place // {FANOUT}
  WHERE c.level < c.height
  GROUP BY c.row_id, c.level, c.place, c.siblings, c.height
)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(u.siblings) AS proof_sha256,
  u.value AS folded_root, u.value = r.digest AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
JOIN upper u ON u.row_id = l.row_id AND u.level = u.height
CROSS JOIN (SELECT digest FROM tops WHERE n = 1) r
"""
