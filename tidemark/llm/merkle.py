"""Operator 13: Merkle manifest of a data set, in blocks laid out by van Emde Boas.

Rows become leaves, which are grouped (here by language), ordered, and paired level by level
up to a root per group; the group roots, in group order, are paired in the same way up to
the root of the data set. A node is the SHA-256 of its children's digests as hex text; a
last node without a partner is hashed alone.

A group's tree is cut into aligned subtrees of 2^height leaves. Each is one row of the
manifest, its digests lying in van Emde Boas order: the upper half of the levels first, then
the subtrees below it, each laid out in the same way, so a walk from a leaf to the root
touches few stretches of memory whatever their size. Addresses are arithmetic (``address``);
no child or parent pointers are kept. Block roots are the leaves of the next layer, which is
cut into blocks again, until every group has one root. Proofs are read back from the written
blocks, from the top layer down.

Rows are shuffled only as digests: by range for their positions and by block. A block is
``2^height`` leaves, whatever the size of a group, so a group may hold all rows. Every layer
is a written table, so work goes on after lost executors.

Defined results: nulls, also null doc_ids (first in order) and a null group (first of the
groups), are leaves like others, as are null and empty texts, which differ; rows with one doc_id
are ordered by leaf digest, equal rows are leaves side by side; very long texts are hashed
whole; an empty table has no rows and no root; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stage

HEIGHT = 8
DIGEST = 32


# --- layout -----------------------------------------------------------------------------

def address(level: int, index: int, height: int) -> int:
    """Place of a node in the layout of a complete tree: ``level`` levels below its root, ``index`` from the left.

    The tree of ``height`` + 1 levels is split after the upper half of its levels; the lower
    subtrees follow the upper one in order.
    """
    at = 0
    while height:
        upper = (height + 1) // 2               # levels of the upper tree
        lower = height - upper                  # height of each subtree below it
        if level < upper:
            height = upper - 1
            continue
        level -= upper
        subtree, index = index >> level, index & ((1 << level) - 1)
        at += (1 << upper) - 1 + subtree * ((2 << lower) - 1)
        height = lower
    return at


@cache
def addresses(height: int) -> list[list[int]]:
    """Addresses of the nodes of each level: [0] the leaves, [height] the root."""
    return [[address(height - up, i, height) for i in range(1 << (height - up))] for up in range(height + 1)]


def hashed(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def tall(n: int, height: int, last: bool) -> int:
    """Levels above the leaves of a block of ``n`` leaves: a whole subtree, but the block that ends its group's tree stops at one node."""
    return (n - 1).bit_length() if last else height


def build(leaves: list[bytes], top: int) -> bytearray:
    """The digests of a block in layout order; places of absent nodes stay zero."""
    out = bytearray(DIGEST * ((2 << top) - 1))
    level = leaves
    for up, places in enumerate(addresses(top)):
        if up:
            level = [hashed(level[i:i + 2]) for i in range(0, len(level), 2)]
        for at, digest in zip(places, level):
            out[at * DIGEST:(at + 1) * DIGEST] = digest
    return out


def node(payload: bytes, top: int, up: int, index: int) -> bytes:
    at = addresses(top)[up][index] * DIGEST
    return payload[at:at + DIGEST]


def siblings(payload: bytes, n: int, top: int, index: int) -> list[tuple[int, bytes]]:
    """Per level from leaf ``index`` to the block's root: (1 if the sibling stands left, else 0; the sibling, or no bytes)."""
    out = []
    for up in range(top):
        other, width = index ^ 1, -(-n >> up)
        out.append((index & 1, node(payload, top, up, other) if other < width else b""))
        index >>= 1
    return out


def pack_path(path: list[tuple[int, bytes]]) -> bytes:
    """Siblings as bytes: a mark (0 right, 1 left, 2 none) before each digest."""
    return b"".join(bytes([left]) + s if s else b"\x02" for left, s in path)


def open_path(packed: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(packed):
        mark = packed[at]
        size = 0 if mark == 2 else DIGEST
        yield mark, packed[at + 1:at + 1 + size]
        at += 1 + size


def fold(leaf: bytes, packed: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for mark, s in open_path(packed):
        leaf = hashed([leaf] if mark == 2 else [s, leaf] if mark else [leaf, s])
    return leaf


def path_digest(packed: bytes) -> str:
    return hashed([s for _, s in open_path(packed) if s]).hex()


# --- Spark ------------------------------------------------------------------------------

def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values as text, each with its byte count before it, null as a dash."""
    texts = [v.cast("string").cast("binary") for v in values]
    colon = F.lit(":").cast("binary")
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string").cast("binary"), colon, t), F.lit("-").cast("binary")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with p: the row's place in its group g by ``order``. Written; null comes first.

    Rows are ranged over the order, so a group may lie in many parts; a count for each part
    and group says where each begins.
    """
    sorted_ = rows.repartitionByRange(*[F.asc_nulls_first(c) for c in ["g", *order]]).sortWithinPartitions(
        *[F.asc_nulls_first(c) for c in ["g", *order]])
    placed = stage(sorted_.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = placed.groupBy("g", part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("g").alias("g2"), F.col("part").alias("part2"),
                           (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    placed = placed.withColumn("part", part)
    return placed.join(counts, F.col("g").eqNullSafe(F.col("g2")) & (F.col("part") == F.col("part2"))).withColumn(
        "p", F.col("at") + F.col("shift")).drop("at", "part", "g2", "part2", "shift")


def block_rows(nodes: DataFrame, carried: list[str], height: int, name: str) -> DataFrame:
    """One layer of the manifest from nodes (g, p, node): g, block, n, top, last, payload, root, and the carried columns as lists. Written."""
    block = F.shiftright("p", height)
    packed = F.sort_array(F.collect_list(F.struct("p", "node", *carried)))   # 2^height rows at most
    groups = nodes.groupBy("g", block.alias("block")).agg(packed.alias("rows"))
    ends = nodes.groupBy("g").agg(F.max(block).alias("end"))
    ends = ends.select(F.col("g").alias("g2"), "end")
    groups = groups.join(ends, F.col("g").eqNullSafe(F.col("g2"))).select(
        "g", "block", (F.col("end") == 0).alias("last"), F.size("rows").alias("n"), F.col("rows.node").alias("nodes"),
        *[F.col(f"rows.{c}").alias(c) for c in carried])

    def hash_blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches, 64):
            last, n, nodes = b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()
            tops = [tall(k, height, z) for k, z in zip(n, last)]
            payloads = [bytes(build(x, t)) for x, t in zip(nodes, tops)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), pa.array(tops, pa.int32()), pa.array(payloads, pa.binary()),
                 pa.array([p[:DIGEST] for p in payloads], pa.binary()), *b.columns[5:]],
                ["g", "block", "last", "n", "top", "payload", "root", *carried])

    kinds = {f.name: f.dataType for f in groups.schema.fields}
    schema = (f"g {kinds['g'].simpleString()}, block long, last boolean, n int, top int, payload binary, root binary"
              + "".join(f", {c} {kinds[c].simpleString()}" for c in carried))
    return stage(groups.mapInArrow(hash_blocks, schema), name)


def build_layers(nodes: DataFrame, carried: list[str], height: int, name: str) -> list[DataFrame]:
    """All layers of the groups' trees, leaves first. A group ends in the layer where one block holds it."""
    layers = [block_rows(nodes, carried, height, f"{name}-0")]
    while True:
        rest = layers[-1].where(~F.col("last")).select("g", F.col("block").alias("p"), F.col("root").alias("node"))
        if not rest.limit(1).count():
            return layers
        layers.append(block_rows(rest, [], height, f"{name}-{len(layers)}"))


def joined(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path, the group's root and the root of all that ``above`` (g, block, up, subroot, end) has for their roots."""
    on = F.col("g").eqNullSafe(F.col("g2")) & (F.col("block") == F.col("block2"))
    return blocks.join(above.select(F.col("g").alias("g2"), F.col("block").alias("block2"), "up", "subroot", "end"), on)


def unfold(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The rows of ``above`` for the layer below: one per node of these blocks, with the siblings up to the root of all."""
    def paths(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches, 16):
            for g, block, n, top, payload, up, subroot, end in zip(*(c.to_pylist() for c in b.columns)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, b.schema.field(0).type), pa.array(range(block << height, (block << height) + n), pa.int64()),
                     pa.array([pack_path(siblings(payload, n, top, i)) + up for i in range(n)], pa.binary()),
                     pa.array([subroot] * n, pa.binary()), pa.array([end] * n, pa.binary())], ["g", "block", "up", "subroot", "end"])

    rows = joined(blocks, above).select("g", "block", "n", "top", "payload", "up", "subroot", "end")
    return rows.mapInArrow(paths, f"g {blocks.schema['g'].dataType.simpleString()}, block long, up binary, subroot binary, end binary")


def paths_above(layers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """``above`` for the blocks of the lowest layer. ``tops`` (g, up, subroot, end) begins at the groups' roots."""
    tops = tops.select(F.col("g").alias("g3"), "up", "subroot", "end")
    above = None
    for layer in reversed(layers):
        own = layer.where("last").join(tops, F.col("g").eqNullSafe(F.col("g3"))).select("g", "block", "up", "subroot", "end")
        own = own if above is None else own.unionByName(above)
        above = own if layer is layers[0] else unfold(layer, own, height)
    return above


class Manifest:
    """Layers of the groups' trees, and of the tree over the groups' roots (the crown)."""

    def __init__(self, leaves: DataFrame, order: list[str], carried: list[str] = (), height: int = HEIGHT):
        """leaves: g (group), node (digest), and the order's and the carried columns."""
        self.height, self.carried = height, list(carried)
        keep = dict.fromkeys(["g", "node", *order, *carried])
        placed = positions(leaves.select(*keep), order, "merkle-leaves")
        self.layers = build_layers(placed, self.carried, height, "merkle")
        self.groups = self.layers[0].schema["g"].dataType
        ends = [x.where("last").select("g", "root") for x in self.layers]
        subroots = reduce(DataFrame.unionByName, ends)
        names = stage(subroots.select(F.lit(0).alias("g"), F.col("g").cast("string").cast("binary").alias("name"),
                                      F.col("root").alias("node")), "merkle-subroots")
        self.crown = build_layers(positions(names, ["name"], "merkle-names"), ["name"], height, "merkle-crown")

    def root(self) -> bytes | None:
        """The root of all, or None of an empty data set."""
        row = self.crown[-1].where("last").select("root").first()
        return bytes(row[0]) if row else None

    def _tops(self) -> DataFrame:
        """g, up, subroot, end: the path from each group's root."""
        start = self.crown[-1].where("last").select("g", F.lit(b"").alias("up"), F.col("root").alias("subroot"), F.col("root").alias("end"))
        blocks = joined(self.crown[0], paths_above(self.crown, start, self.height))

        def names(batches: Iterator) -> Iterator:
            import pyarrow as pa
            for b in slices(batches, 16):
                for name, n, top, payload, up, end in zip(*(c.to_pylist() for c in b.columns)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name, pa.binary()), pa.array([pack_path(siblings(payload, n, top, i)) + up for i in range(n)], pa.binary()),
                         pa.array([node(payload, top, 0, i) for i in range(n)], pa.binary()), pa.array([end] * n, pa.binary())],
                        ["name", "up", "subroot", "end"])

        found = blocks.select("name", "n", "top", "payload", "up", "end").mapInArrow(
            names, "name binary, up binary, subroot binary, end binary")
        return found.select(F.col("name").cast("string").cast(self.groups).alias("g"), "up", "subroot", "end")

    def proofs(self, probe: str) -> DataFrame:
        """Per leaf: the carried columns, leaf, subroot, root, proof_sha256, and folded_root from the ``probe`` digest with the leaf's siblings."""
        above = paths_above(self.layers, stage(self._tops(), "merkle-tops"), self.height)
        carried, at = self.carried, self.carried.index(probe)
        rows = joined(self.layers[0], above).select("n", "top", "payload", "up", "subroot", "end", *carried)

        def prove(batches: Iterator) -> Iterator:
            import pyarrow as pa
            for b in slices(batches, 16):
                for i, (n, top, payload, up, subroot, end) in enumerate(zip(*(b.column(c).to_pylist() for c in range(6)))):
                    paths = [pack_path(siblings(payload, n, top, j)) + up for j in range(n)]
                    lists = [b.column(6 + c)[i].values for c in range(len(carried))]
                    yield pa.RecordBatch.from_arrays(
                        [*lists, pa.array([node(payload, top, 0, j).hex() for j in range(n)]), pa.array([subroot.hex()] * n),
                         pa.array([end.hex()] * n), pa.array([path_digest(p) for p in paths]),
                         pa.array([fold(x, p).hex() for x, p in zip(lists[at].to_pylist(), paths)])],
                        [*carried, "leaf", "subroot", "root", "proof_sha256", "folded_root"])

        kinds = {f.name: f.dataType.elementType.simpleString() for f in self.layers[0].schema.fields if f.name in carried}
        return rows.mapInArrow(prove, ", ".join(f"{c} {kinds[c]}" for c in carried)
                               + ", leaf string, subroot string, root string, proof_sha256 string, folded_root string")

    def path(self, group, p: int) -> list[tuple[int, bytes]]:
        """Random access: the siblings of one leaf up to its group's root, from one block of each layer."""
        out: list[tuple[int, bytes]] = []
        for layer in self.layers:
            row = layer.where(F.col("g").eqNullSafe(F.lit(group)) & (F.col("block") == p >> self.height)).select(
                "n", "top", "payload", "last").first()
            if row is None or p & ((1 << self.height) - 1) >= row.n:
                raise KeyError((group, p))
            out += siblings(bytes(row.payload), row.n, row.top, p & ((1 << self.height) - 1))
            if row.last:
                return out
            p >>= self.height
        return out


def merkle_digest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Leaf, roots and proof of every document; those with 7 | crc32(doc_id) are checked with n_chars one too high."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    values = [F.col(c) for c in columns]
    bent = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in columns]
    # the row number parts rows that are alike, so that any number of them can be ranged
    tamper = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = leaf_digest(*values)
    leaves = stage(docs.select(F.col("lang").alias("g"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("node"),
                               F.when(tamper, leaf_digest(*bent)).otherwise(leaf).alias("probe"),
                               F.monotonically_increasing_id().alias("row")), "merkle-digests")
    rows = Manifest(leaves, ["doc_id", "node", "row"], ["doc_id", "probe"], height).proofs("probe")
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
