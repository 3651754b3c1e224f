"""A Merkle manifest of a dataset, swept in time-forward order.

Nodes of a tree are labelled by level and place, children before parents. The sweep takes digests from a priority
queue ordered by the label of the node they are sent to; a node whose digests have all come makes its own and sends it on to its
parent. The reversed sweep takes proof suffixes from the root to the leaves. The queue is external: a block of neighbouring
nodes is swept in one task with a queue of its own, and what it sends beyond the block is written, sorted by label and
read by the next round, whose nodes are the roots of the blocks. So no task ever holds more than one block.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.order import numbered
from tallyworks.llm.shared import staged, whole_groups

#: Consecutive nodes that become one.
ARITY = 2
#: Levels that one round climbs; a block has ``ARITY ** BLOCK_LEVELS`` nodes.
BLOCK_LEVELS = 12

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of fields as their length in bytes, a colon and their text, or a dash for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def levels(n: int, arity: int) -> int:
    """Levels from ``n`` nodes up to a single one."""
    k = 0
    while n > 1:
        n, k = -(-n // arity), k + 1
    return k


def sweep(digests: Sequence[str], height: int, arity: int = ARITY) -> tuple[str, dict[int, list[str]]]:
    """The root of a block ``height`` levels above its nodes, and the digests that each node was sent.

    Nodes are labelled ``level * width + place``, so a label is above those of all nodes it hears from.
    """
    if height == 0:
        return digests[0], {}
    width = len(digests)
    queue = [(width + i // arity, i, d) for i, d in enumerate(digests)]  # sorted, so a heap
    sent: dict[int, list[str]] = {}
    while True:
        label = queue[0][0]
        inputs = []
        while queue and queue[0][0] == label:
            inputs.append(heapq.heappop(queue)[2])
        sent[label] = inputs
        own = digest(inputs)
        level, place = divmod(label, width)
        if level == height:
            return own, sent
        heapq.heappush(queue, ((level + 1) * width + place // arity, place, own))


def sweep_back(width: int, height: int, sent: dict[int, list[str]], suffix: list[str], arity: int = ARITY) -> list[list[str]]:
    """The proof of each node of a block: its siblings from level to level, then the suffix that its root was sent.

    A step is written ``before.after``: what stands before and after the node among the digests of its parent.
    """
    if height == 0:
        return [suffix]
    proofs: list[list[str]] = [[]] * width
    queue = [(-height * width, suffix)]
    while queue:
        label, rest = heapq.heappop(queue)
        level, place = divmod(-label, width)
        inputs = sent[-label]
        for k in range(len(inputs)):
            proof = ["".join(inputs[:k]) + "." + "".join(inputs[k + 1 :]), *rest]
            child = place * arity + k
            if level == 1:
                proofs[child] = proof
            else:
                heapq.heappush(queue, (-((level - 1) * width + child), proof))
    return proofs


def _blocks(rows: DataFrame, arity: int) -> DataFrame:
    size = arity**BLOCK_LEVELS
    return rows.withColumn("block", F.floor(F.col("idx") / size).cast("long"))


def _dealt(rows: DataFrame, *within: str) -> DataFrame:
    """Whole blocks, spread by their keys, so that neighbouring blocks of one large tree go to different tasks."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *within)


def climb(nodes: DataFrame, label: str, arity: int = ARITY) -> list[DataFrame]:
    """Rounds of nodes (tree, n, idx, digest), the last with one node a tree, its root.

    ``nodes`` is a stored table; ``n`` counts the nodes of a tree. Each round is a stored table too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _of_blocks(batches):
            n = block.column("n")[0].as_py()
            root, _ = sweep(block.column("digest").to_pylist(), min(BLOCK_LEVELS, levels(n, arity)), arity)
            row = {"tree": block.column("tree")[0].as_py(), "n": -(-n // arity**BLOCK_LEVELS), "idx": block.column("block")[0].as_py(), "digest": root}
            yield pa.RecordBatch.from_pylist([row], kinds)

    kinds = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("idx", pa.int64()), ("digest", pa.string())])
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        dealt = _dealt(_blocks(rounds[-1].select("tree", "n", "idx", "digest"), arity), "idx")
        rounds.append(staged(dealt.select("tree", "block", "n", "digest").mapInArrow(work, "tree string, n long, idx long, digest string"), label))
        most = -(-most // arity**BLOCK_LEVELS)
    return rounds


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, from batches sorted by block."""
    for table in whole_groups(batches, ["tree", "block"]):
        table = table.combine_chunks()
        tree, at = table.column("tree").chunk(0).dictionary_encode().indices.to_numpy(), table.column("block").to_numpy()
        changed = np.flatnonzero((tree[1:] != tree[:-1]) | (at[1:] != at[:-1])) + 1
        cuts = [0, *changed.tolist(), len(at)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(a, b - a)


def descend(rounds: list[DataFrame], tops: DataFrame, carry: Sequence[str], label: str, arity: int = ARITY) -> DataFrame:
    """(tree, idx, proof, subroot, root, and ``carry``) of the nodes of the first round.

    ``tops`` has for each tree (tree, proof, subroot, root): what its root is sent. The roots of each round's blocks
    pass it on, block by block.
    """
    names = ["tree", "block", "idx", "n", "digest", "proof", "subroot", "root"]

    def work(extra: list[str]):
        def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _of_blocks(batches):
                block = rows.slice(1)  # behind the row with what the block's root was sent
                head = {c: rows.column(c)[0].as_py() for c in ("proof", "subroot", "root")}
                height = min(BLOCK_LEVELS, levels(block.column("n")[0].as_py(), arity))
                _, sent = sweep(digests := block.column("digest").to_pylist(), height, arity)
                columns = {
                    "tree": block.column("tree"),
                    "idx": block.column("idx"),
                    "proof": pa.array(sweep_back(len(digests), height, sent, head["proof"], arity), pa.list_(pa.string())),
                    "subroot": pa.array([head["subroot"]] * len(digests), pa.string()),
                    "root": pa.array([head["root"]] * len(digests), pa.string()),
                }
                yield from pa.table(columns | {c: block.column(c) for c in extra}).to_batches()

        return inner

    sent = tops.select("tree", F.lit(0).cast("long").alias("block"), "proof", "subroot", "root")
    for k in range(len(rounds) - 2, -1, -1):
        extra = list(carry) if k == 0 else []
        nodes = _blocks(rounds[k], arity).select("tree", "block", "idx", "n", "digest", *extra)
        kinds = {f.name: f.dataType for f in nodes.schema.fields}
        both = nodes.unionByName(sent.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        dealt = _dealt(both, "idx").select(*names, *extra)
        schema = "tree string, idx long, proof array<string>, subroot string, root string"
        schema += "".join(f", {c} {kinds[c].simpleString()}" for c in extra)
        found = dealt.mapInArrow(work(extra), schema)
        if k == 0:
            return found
        sent = staged(found, label).withColumnRenamed("idx", "block")
    return rounds[0].select("tree", "idx", *carry).join(tops, "tree")  # trees of one node each


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, and ``extra``) of each document.

    A leaf is the digest of a document's fields (see ``leaf_digest``). The leaves of a language ascend by doc_id, equal
    ones by leaf; runs of ``arity`` nodes become one, level by level, until one is left, the subroot. Subroots by
    language, null first, make the root likewise. ``proof`` has the steps from the leaf through the subroot to the
    root, as ``fold`` takes them. ``extra`` are further columns computed from the document and its ``leaf``.

    A null doc_id comes first in its language; a null language is one of its own, apart from the empty name. Repeated rows are
    leaves each. Columns other than the five fields take part in nothing, whatever their names. No rows give no rows.
    """
    extra = extra or {}
    own = docs.select(*[F.col(c) for c in _FIELDS]).withColumn("leaf", leaf_digest(*map(F.col, _FIELDS)))
    # languages by name: null is the empty name, and others begin with a letter that makes none empty
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = staged(
        own.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), "leaf", *[c.alias(name) for name, c in extra.items()]),
        "manifest-leaves",
    )
    placed = numbered(leaves, ["tree"], ["doc_id", "leaf"], "manifest-order").withColumn("digest", F.col("leaf"))
    carry = ["doc_id", "leaf", *extra]
    rounds = climb(placed.select("tree", "n", "idx", "digest", *carry), "manifest-up", arity)
    subroots = staged(rounds[-1].where("idx = 0").select(F.col("tree").alias("name"), "digest"), "manifest-subroots")
    forest = numbered(subroots.withColumn("tree", F.lit("")), ["tree"], ["name"], "manifest-names")
    above = climb(forest.select("tree", "n", "idx", "digest", "name", F.col("digest").alias("own")), "manifest-top", arity)
    root = above[-1].select("tree", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    tops = descend(above, root, ["name", "own"], "manifest-top-down", arity)
    tops = staged(tops.select(F.col("name").alias("tree"), "proof", F.col("own").alias("subroot"), "root"), "manifest-tops")
    return descend(rounds, tops, carry, "manifest-down", arity).select("doc_id", "leaf", "subroot", "root", "proof", *extra)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof make."""
    return F.aggregate(
        proof,
        leaf,
        lambda own, step: F.sha2(F.concat(F.substring_index(step, ".", 1), own, F.substring_index(step, ".", -1)), 256),
    )


def proof_digest(docs: DataFrame) -> DataFrame:
    """Each document's leaf, roots and proof digest, and whether its fields, tampered with in places, still make the root.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. ``proof_sha256`` is of the siblings' digests from
    the leaf up. Documents whose doc_id has a crc32 that 7 divides are folded from a leaf with one more character in n_chars;
    a null n_chars stays, and so does a document without a doc_id. See ``manifest`` for nulls, repeats, clashes and empty tables.
    """
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(hit, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))).otherwise(F.col("leaf"))
    found = manifest(docs, {"_tampered": tampered})
    siblings = F.replace(F.array_join("proof", ""), F.lit("."), F.lit(""))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("_tampered"), F.col("proof")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: ``proof_digest`` of the documents table for DuckDB.
ORACLE = """
WITH RECURSIVE docs AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size
    FROM (
        SELECT doc_id, lang, sha256(head || tally || tail) AS leaf,
               CASE WHEN crc % 7 = 0 THEN sha256(head || more || tail) ELSE sha256(head || tally || tail) END AS tampered
        FROM (
            SELECT doc_id, lang,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS tally,
                   coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                       lambda a, c: list_reduce(list_prepend(xor(a, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                           lambda b, bit: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END))) AS crc
            FROM documents
        )
    )
),
inner_nodes AS (
    SELECT lang, 0 AS level, place, leaf AS digest, size FROM docs
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 1) // 2
    FROM inner_nodes WHERE size > 1 GROUP BY lang, level, place // 2
),
subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size
    FROM inner_nodes WHERE size = 1
),
top_nodes AS (
    SELECT 0 AS level, place, subroot AS digest, size FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 1) // 2
    FROM top_nodes WHERE size > 1 GROUP BY level, place // 2
),
folds AS (
    SELECT doc_id, lang, leaf, place AS id, 0 AS level, place AS at, tampered AS own, '' AS proof, size, false AS top FROM docs
    UNION ALL
    SELECT f.doc_id, f.lang, f.leaf, f.id,
           CASE WHEN f.size = 1 THEN 0 ELSE f.level + 1 END,
           CASE WHEN f.size = 1 THEN s.place ELSE f.at // 2 END,
           CASE WHEN f.size = 1 THEN f.own
                WHEN f.at % 2 = 1 THEN sha256(coalesce(n.digest, t.digest) || f.own)
                ELSE sha256(f.own || coalesce(n.digest, t.digest, '')) END,
           f.proof || CASE WHEN f.size = 1 THEN '' ELSE coalesce(n.digest, t.digest, '') END,
           CASE WHEN f.size = 1 THEN s.size ELSE (f.size + 1) // 2 END,
           f.top OR f.size = 1
    FROM folds f
    LEFT JOIN inner_nodes n ON NOT f.top AND n.lang IS NOT DISTINCT FROM f.lang AND n.level = f.level AND n.place = xor(f.at, 1)
    LEFT JOIN top_nodes t ON f.top AND t.level = f.level AND t.place = xor(f.at, 1)
    LEFT JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
    WHERE NOT (f.top AND f.size = 1)
)
SELECT f.doc_id, f.leaf, s.subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.own AS folded_root, f.own = r.digest AS verified
FROM folds f
JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
CROSS JOIN (SELECT digest FROM top_nodes WHERE size = 1) r
WHERE f.top AND f.size = 1
"""
