"""Merkle manifest of a dataset, and proofs of its rows by octopus multiproofs.

Every row is a leaf. The leaves of a language, in ascending doc_id, are the lowest level of a tree in which eight neighbours
have one parent; the roots of these trees, in the order of the languages, are the leaves of one more tree, whose root stands
for the dataset. A manifest is three tables: leaves with their positions, interior nodes by coordinate (tree, level,
position), and one row per tree.

Proofs are made for a leaf partition at a time, 4096 positions of one tree. It lists the least set of coordinates that its
own leaves do not give (a node above them is theirs as soon as one of its leaves is), these coordinates meet the nodes in
one join, the interiors that many proofs share are derived once, and each leaf's proof is read off the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.rendezvous import with_slots
from stayline.llm.tables import read, sized_broadcast, stored, unused

ARITY = 8
_SHIFT = 3
#: Levels that one task builds at once; its leaves are a partition of proofs.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Name of the tree over the trees. Those of languages start with 1, that of rows without one is 0.
_DATASET = "2"
_NODES = "tree string, level int, pos bigint, hash string, size bigint"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text.cast("binary")).cast("string"), F.lit(":"), text))


def leaf_hash(**changed: Column) -> Column:
    """Hash of the row's fields, some of them replaced."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]).cast("binary"), 256)


@dataclass
class Manifest:
    """leaves (the rows handed in, tree, pos, size), nodes (tree, level, pos, hash, size) above them, and trees (tree, size,
    place, trees, subroot, root); size is the number of nodes at a level, place that of a tree among `trees` many."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def _grown(leaves: DataFrame) -> DataFrame:
    """All nodes above leaves (tree, pos, hash, size), a few levels per round, each block of positions in a task."""
    # rounds follow from the largest tree alone
    largest = leaves.agg(F.max("size")).head()[0] or 0
    base, rounds = leaves.select("tree", F.lit(0).alias("level"), "pos", "hash", "size"), []

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        tree, level, size = frame["tree"].iloc[0], int(frame["level"].iloc[0]), int(frame["size"].iloc[0])
        first, hashes = int(frame["pos"].iloc[0]), frame["hash"].tolist()
        rows = []
        for _ in range(BLOCK_LEVELS):
            if size <= 1:
                break
            hashes = [digest("".join(hashes[at : at + ARITY])) for at in range(0, len(hashes), ARITY)]
            first, level, size = first // ARITY, level + 1, -(-size // ARITY)
            rows += [(tree, level, first + at, own, size) for at, own in enumerate(hashes)]
        return pd.DataFrame(rows, columns=["tree", "level", "pos", "hash", "size"])

    while True:
        dealt = base.where("size > 1").withColumn("block", F.shiftright("pos", _SHIFT * BLOCK_LEVELS))
        found = dealt.groupBy("tree", "block").applyInPandas(lambda frame: block(frame), _NODES)
        rounds.append(stored(found, "merkle-nodes"))
        largest = -(-largest // ARITY**BLOCK_LEVELS)
        if largest <= 1:
            break
        base = rounds[-1].where(F.col("level") == BLOCK_LEVELS * len(rounds))
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def manifest(rows: DataFrame) -> Manifest:
    """Manifest of leaves (lang, doc_id, leaf and any other columns, none of which is called like those of a manifest).

    Null languages are one tree, before all others, which follow bytewise. Null ids come first, and rows that share an id
    are ordered by their leaves; equal rows are interchangeable. An empty table has no tree and no root.
    """
    tree = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang").cast("string")))
    placed = stored(with_slots(rows.withColumn("tree", tree), "tree", ["doc_id", "leaf"]).withColumnRenamed("slot", "pos"), "merkle-slots")
    sizes = stored(placed.groupBy("tree").agg(F.count("*").alias("size")), "merkle-sizes")
    leaves = placed.join(sized_broadcast(sizes), "tree")
    nodes = _grown(leaves.select("tree", "pos", F.col("leaf").alias("hash"), "size"))
    tops = leaves.where("size = 1").select("tree", F.col("leaf").alias("subroot")).unionByName(
        nodes.where("size = 1").select("tree", F.col("hash").alias("subroot"))
    )
    ordered = with_slots(tops.withColumn("all", F.lit(_DATASET)), "all", ["tree"]).withColumnRenamed("slot", "place")
    ordered = stored(ordered.withColumn("trees", F.lit(ordered.count()).cast("long")).drop("all"), "merkle-tops")
    above = _grown(ordered.select(F.lit(_DATASET).alias("tree"), F.col("place").alias("pos"), F.col("subroot").alias("hash"), F.col("trees").alias("size")))
    only = ordered.where("trees = 1").select("subroot").union(above.where("size = 1").select("hash")).head()
    trees = ordered.join(sizes, "tree").withColumn("root", F.lit(only[0] if only else None).cast("string"))
    return Manifest(leaves, nodes.unionByName(above), stored(trees, "merkle-trees"))


def missing(positions: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, positions) of the nodes that the leaves at `positions` do not give and their path to the root needs."""
    known, level = np.unique(positions), 0
    while size > 1:
        runs = np.unique(known >> _SHIFT)
        members = ((runs << _SHIFT)[:, None] + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(members[members < size], known, assume_unique=True)
        known, size, level = runs, -(-size // ARITY), level + 1


def _wanted(frame: pd.DataFrame) -> pd.DataFrame:
    first = frame.iloc[0]
    own = {"tree": first["tree"], "part": first["part"]}
    found = [(first["tree"], level, at) for level, gaps in missing(frame["pos"].to_numpy(), int(first["size"])) for at in gaps.tolist()]
    above = missing(np.array([first["place"]], dtype=np.int64), int(first["trees"]))
    found += [(_DATASET, level, at) for level, gaps in above for at in gaps.tolist()]
    return pd.DataFrame(found, columns=["at_tree", "level", "pos"]).assign(**own)


class _Layers:
    """Levels of one tree as far as a leaf partition knows them: its own leaves, what it fetched, and what follows."""

    def __init__(self, own: dict[int, str], size: int, fetched: dict[tuple[int, int], str]):
        self.levels = [dict(own)]
        for (level, at), value in fetched.items():
            while level >= len(self.levels):
                self.levels.append({})
            self.levels[level][at] = value
        known, level = set(own), 0
        while size > 1:
            if level + 1 == len(self.levels):
                self.levels.append({})
            nodes, known = self.levels[level], {at >> _SHIFT for at in known}
            for run in known:
                members = range(run << _SHIFT, min(size, (run + 1) << _SHIFT))
                self.levels[level + 1][run] = digest("".join([nodes[at] for at in members]))
            size, level = -(-size // ARITY), level + 1
        self.height = level
        self._beside: dict[tuple[int, int], tuple[str, str]] = {}
        self._proofs: dict[tuple[int, int], str] = {}

    def root(self) -> str:
        return self.levels[self.height][0]

    def beside(self, level: int, at: int) -> tuple[str, str]:
        """Siblings before and behind a node."""
        if (level, at) not in self._beside:
            nodes, first = self.levels[level], at >> _SHIFT << _SHIFT
            before = "".join([nodes[i] for i in range(first, at)])
            self._beside[level, at] = before, "".join([nodes[i] for i in range(at + 1, first + ARITY) if i in nodes])
        return self._beside[level, at]

    def proof(self, at: int, level: int = 0) -> str:
        """Siblings from a node up to the root, left to right on each level."""
        if level == self.height:
            return ""
        if (level, at) not in self._proofs:
            self._proofs[level, at] = "".join(self.beside(level, at)) + self.proof(at >> _SHIFT, level + 1)
        return self._proofs[level, at]

    def fold(self, value: str, at: int) -> str:
        """The root that a leaf at this position leads to."""
        for level in range(self.height):
            before, behind = self.beside(level, at)
            value, at = digest(before + value + behind), at >> _SHIFT
        return value


_PROOFS = "proof_sha256 string, folded_root string"


def prove(known: Manifest, asked: DataFrame, claimed: str) -> DataFrame:
    """Add proof_sha256 (hash of the siblings) and folded_root to some rows of the manifest's leaves.

    folded_root is what the hash in column `claimed` (null: the leaf itself) leads to beside the manifest's nodes.
    """
    trees = known.trees.select("tree", "place", "trees")
    part = F.shiftright("pos", _SHIFT * BLOCK_LEVELS).alias("part")
    parts = asked.join(sized_broadcast(trees), "tree").select("*", part)
    coordinates = "at_tree string, level int, pos bigint, tree string, part bigint"
    places = parts.select("tree", "part", "pos", "size", "place", "trees")
    wanted = stored(places.groupBy("tree", "part").applyInPandas(lambda frame: _wanted(frame), coordinates), "merkle-wanted")
    lowest = wanted.agg(F.min("level")).head()[0] or 0
    nodes = known.nodes.select("tree", "level", "pos", "hash").unionByName(
        known.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("hash"))
    ).unionByName(known.trees.select(F.lit(_DATASET).alias("tree"), F.lit(0).alias("level"), F.col("place").alias("pos"), F.col("subroot").alias("hash")))
    # each coordinate is fetched once per partition that wants it; levels that nobody asks for stay where they are
    needed = nodes.where((F.col("level") >= lowest) | (F.col("tree") == _DATASET)).withColumnRenamed("tree", "at_tree")
    fetched = wanted.join(needed, ["at_tree", "level", "pos"])
    kept = list(asked.columns)

    def expand(frame: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=[*kept, "proof_sha256", "folded_root"])
        first, own, above = frame.iloc[0], {}, {}
        rows = zip(nodes["at_tree"], nodes["level"], nodes["pos"], nodes["hash"], strict=True)
        for tree, level, at, value in rows:
            (above if tree == _DATASET else own)[level, at] = value
        low = _Layers(dict(zip(frame["pos"].tolist(), frame["leaf"], strict=True)), int(first["size"]), own)
        place = int(first["place"])
        high = _Layers({place: low.root()}, int(first["trees"]), above)
        end = high.proof(place)
        proofs, folded = [], []
        for at, leaf, claim in zip(frame["pos"].tolist(), frame["leaf"], frame[claimed], strict=True):
            proofs.append(digest(low.proof(at) + end))
            folded.append(high.fold(low.fold(leaf if claim is None else claim, at), place))
        return frame[kept].assign(proof_sha256=proofs, folded_root=folded)

    types = ", ".join(f"`{name}` {kind}" for name, kind in asked.dtypes)
    return parts.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInPandas(expand, f"{types}, {_PROOFS}")


def tampered_leaf() -> Column:
    """The leaf that the row would have with its text in lower case, where 3 divides the checksum of its doc_id; else null."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_hash(text=lower))


def verified(docs: DataFrame) -> DataFrame:
    """Every row of `docs` proved against the manifest of all of them, some with a tampered text.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified. Rows with a null id are not tampered with;
    a tampered null text stays null and is verified, as is one without capital letters. Other columns are not looked at.
    """
    rows = docs.select("doc_id", "lang", leaf_hash().alias("leaf"), tampered_leaf().alias("tampered"))
    known = manifest(rows)
    proved = prove(known, known.leaves.select("tree", "pos", "size", "doc_id", "leaf", "tampered"), "tampered")
    roots = known.trees.select("tree", "subroot", "root")
    return proved.join(sized_broadcast(roots), "tree").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as leaves, their proofs, and what becomes of tampered ones."""
    return verified(read(spark, sf_dir, "documents").select(*FIELDS))


def _sql_leaf(text: str) -> str:
    parts = [text if name == "text" else f"{name}::VARCHAR" for name in FIELDS]
    return "sha256(" + " || ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE octet_length(encode({p})) || ':' || {p} END" for p in parts) + ")"


ORACLE = f"""
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
sums AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || b)::BIGINT for b in regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..')]),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS code FROM documents, steps),
hashed AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree, {_sql_leaf("text")} AS leaf,
    CASE WHEN code % 3 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM sums),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS size FROM hashed),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS hash, size FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), any_value((size + 7) // 8)
  FROM low WHERE size > 1 GROUP BY tree, level, pos // 8),
tops AS (SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM low WHERE size = 1),
high AS (
  SELECT 0 AS level, place AS pos, subroot AS hash, trees AS size FROM tops
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), any_value((size + 7) // 8)
  FROM high WHERE size > 1 GROUP BY level, pos // 8),
above AS (SELECT hash AS root FROM high WHERE size = 1),
coordinates AS (
  SELECT id, level AS step, tree, level, (pos >> (3 * level)) AS spot
  FROM leaves JOIN (SELECT DISTINCT tree, level FROM low WHERE size > 1) USING (tree)
  UNION ALL
  SELECT id, 100 + level, '2', level, (place >> (3 * level))
  FROM leaves JOIN tops USING (tree), (SELECT DISTINCT level FROM high WHERE size > 1)),
nodes AS (SELECT tree, level, pos, hash FROM low UNION ALL SELECT '2', level, pos, hash FROM high),
beside AS (
  SELECT id, step, coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos < spot), '') AS before,
    coalesce(string_agg(hash, '' ORDER BY pos) FILTER (WHERE pos > spot), '') AS behind
  FROM coordinates JOIN nodes USING (tree, level) WHERE spot // 8 = pos // 8 GROUP BY id, step),
turns AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS turn FROM beside),
proofs AS (SELECT id, sha256(string_agg(before || behind, '' ORDER BY turn)) AS proof, max(turn) AS turns FROM turns GROUP BY id),
folded AS (
  SELECT id, 0::BIGINT AS turn, coalesce(tampered, leaf) AS hash FROM leaves
  UNION ALL
  SELECT id, t.turn, sha256(t.before || f.hash || t.behind) FROM folded f JOIN turns t USING (id) WHERE t.turn = f.turn + 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.hash AS folded_root, f.hash = root AS verified
FROM leaves JOIN tops USING (tree) CROSS JOIN above LEFT JOIN proofs USING (id) JOIN folded f USING (id)
WHERE f.turn = coalesce(turns, 0)
"""
