"""N-gram Jaccard self-join with PartEnum signatures.

A document is the set of its word shingles, kept as 64-bit hashes. Equal sets are one node, known
by a fingerprint of the set. Sizes are parted into bands whose ends differ by the similarity, so
partners lie in one band or in neighbouring ones; each set is signed for its own band and for the
next larger one. Two sets of sizes a and b that are similar enough differ in at most
``(a + b) * (1 - s) / (1 + s)`` shingles, hence in at most ``k`` for a band. The domain of
shingles is dealt into first-level parts and each of these into second-level parts; a signature is
the content of a subset of one part's second-level parts. With ``n1 * (k2 + 1) > k`` some
first-level part differs in at most ``k2`` shingles, and leaving out ``k2`` of its ``n2``
second-level parts leaves the same content in both sets: similar sets share a signature, always.

There are somewhat more parts than that needs (``SPARE``), so that a similar pair shares several
signatures. A set may therefore pass over its signatures of less than two shingles, or of none, as
long as these are fewer than the signatures it must share with any partner: such contents agree by
chance too often. A signature's content is the same in both sets, so either set's count suffices.

Signatures are packed by hash bucket and compared within a bucket. Where few sets share one, their
pairs go on, each once; larger groups go on as members. A pair is first held against the sets'
parity sketches: as every differing shingle flips one bit, more differing bits than allowed
differences rule it out for certain. A first round takes a few signatures of each set, so its pairs
grow with the sets and not with a group's square; of the pairs left open, spanning forests are
verified on the full sets. A second round does so with all signatures whose members the verified links
leave in different components, and a third verifies every pair that is still open between
components. So a group of copies is not expanded into its pairs, and no link is lost.

Defined cases: null and empty texts and texts without words are empty sets, linked with nothing,
each its own component; texts with fewer words than a shingle are one shingle; repeated rows are
linked, having equal sets; rows with a null id are returned and lend their links to others, and
their component is the smallest id they reach, if any; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfit.llm.arrays import Words, flat, mix, seeded, slices
from starfit.llm.components import connected_components
from starfit.llm.tables import grouped, partitions, scanned, staged

#: Bytes of text whose signatures are packed together.
BLOCK_BYTES = 4 << 20
#: First-level parts by the number that differences can spoil.
SPARE = 1.25
#: Up to so many ids of documents to verify are broadcast (8 MB); beyond, the texts are shuffled.
MANY_IDS = 1_000_000
#: Spanning forests of a task's open pairs that are verified first: what one false pair parts,
#: another joins.
FORESTS = 2
#: Members of one signature within a block of texts that make it shared for certain.
MANY_HERE = 16
#: Members of one signature whose pairs are listed.
FEW = 8
#: Members of one signature up to which all pairs of many signatures are compared at once.
BATCHED = 64
PAIRS_AT_ONCE = 500_000
#: Signatures of a node, those with the smallest hashes, in the first round of comparisons.
ROUND = 8
#: Members of one signature compared in one task; larger groups are compared by pairs of blocks.
GROUP = 4_096
#: Bytes that meet in one group: of packed signatures, and of members with their sketches.
GROUP_BYTES = 16 << 20
#: Bytes of packed signatures by shingle of a set, both bands together, at most.
SIGNATURE_BYTES = 16


@dataclass(frozen=True)
class Likeness:
    """Sets are similar if percent * union <= 100 * intersection."""

    percent: int = 75
    words: int = 5
    k2: int = 1
    n2: int = 3

    def edges(self, largest: int) -> np.ndarray:
        """First sizes of the bands up to a size; partners' sizes differ by one band at most."""
        at = [1]
        while at[-1] <= largest:
            at.append(at[-1] * 100 // self.percent + 1)
        return np.array(at, np.int64)

    def shared(self, n1: np.ndarray, differing: np.ndarray) -> np.ndarray:
        """Fewest signatures two sets share if so many shingles differ: every difference spoils
        as many as it can, the first of a part those with its second-level part, the next fewer."""
        left, spoilt = differing, 0
        for done in range(self.k2 + 1):
            each = comb(self.n2 - 1 - done, self.n2 - self.k2 - 1)
            spoilt = spoilt + each * np.minimum(left, n1)
            left = np.maximum(left - n1, 0)
        return n1 * comb(self.n2, self.k2) - spoilt

    def differences(self, both: np.ndarray | int):
        """Most shingles in which two similar sets of ``both`` shingles together can differ."""
        return both * (100 - self.percent) // (100 + self.percent)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a slice, sorted by both."""
    words = Words(data, offsets, lower=True)
    hashes, first = words.windows(size)
    rows = words.rows[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        at = np.searchsorted(words.rows, short)
        extra = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = words.counts[short] > i
            extra[has] = mix(extra[has] + words.hashes[at[has] + i])
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def row_sums(rows: np.ndarray, values: np.ndarray, n_rows: int) -> np.ndarray:
    """Sums of unsigned values by row; rows must be sorted."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def fingerprints(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    sizes = np.bincount(rows, minlength=n_rows).astype(np.uint64)
    return mix(row_sums(rows, seeded(hashes, 21), n_rows) + seeded(sizes, 22)).view(np.int64)


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of a set's parity sketch: the least power of two from twice its size on, 64 at least."""
    return np.maximum(64, 2 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))


def sketch(hashes: np.ndarray, bits: int) -> bytes:
    at = (seeded(hashes, 31) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def signatures(
    rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, like: Likeness
) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of every set of a slice."""
    out_rows, out = [], []
    if len(rows) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edges = like.edges(int(sizes.max()) * 2 + 2)
    band = np.searchsorted(edges, sizes, "right") - 1
    dealt, second = seeded(hashes, 7), seeded(hashes, 11) % np.uint64(like.n2)
    value = seeded(hashes, 3)
    for ahead in (0, 1):  # as a member of its own band, and of the next as the smaller partner
        index = band + ahead
        top = edges[np.minimum(index + 1, len(edges) - 1)] - 1
        if ahead:
            # Only sets that can have a partner in the next band.
            live = (sizes > 0) & (edges[np.minimum(index, len(edges) - 1)] * like.percent <= 100 * sizes)
        else:
            live = sizes > 0
        k = like.differences(2 * top)
        n1 = np.ceil((k + 1) / (like.k2 + 1) * SPARE).astype(np.int64)
        mine = live[rows]
        r, n1_of = rows[mine], n1[rows[mine]]
        if len(r) == 0:
            continue
        part = (dealt[mine] % n1_of.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((part, r))
        r, part, v, sub = r[order], part[order], value[mine][order], second[mine][order]
        head = np.ones(len(r), bool)
        head[1:] = (r[1:] != r[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(head)
        own, part = r[at], part[at]
        contents, filled = [], []
        for left_out in itertools.combinations(range(like.n2), like.k2):
            use = ~np.isin(sub, left_out)
            contents.append(np.add.reduceat(np.where(use, v, np.uint64(0)), at))
            filled.append(np.add.reduceat(use.astype(np.int64), at))
        every = n1 * len(contents)
        sure = like.shared(n1, like.differences(sizes + top))
        least = np.zeros(len(sizes), np.int64)  # fewest shingles of a signature that is not passed over
        for low in (1, 2):
            rich = sum(np.bincount(own[f >= low], minlength=len(sizes)) for f in filled)
            least[every - rich < sure] = low
        seed = index.astype(np.uint64) * np.uint64(1 << 32)
        for number, (content, f) in enumerate(zip(contents, filled)):
            say = f >= least[own]
            out_rows.append(own[say])
            out.append(mix(content[say] + seeded(seed[own[say]] + part[say].astype(np.uint64), 5 + number)))
            for row in np.flatnonzero((least == 0) & live):  # parts without a shingle, too
                empty = np.setdiff1d(np.arange(n1[row]), part[own == row])
                out_rows.append(np.full(len(empty), row))
                out.append(mix(seeded(seed[row] + empty.astype(np.uint64), 5 + number)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


def _describe(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, text_key, n, fingerprint and parity sketch of every document."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(1))
        for i, j in slices(offsets):
            with np.errstate(over="ignore"):
                rows, hashes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], like.words)
                sizes = np.bincount(rows, minlength=j - i)
                bounds = np.searchsorted(rows, np.arange(j - i + 1))
                bits = sketch_bits(sizes)
                sketches = [sketch(hashes[a:b], n) for a, b, n in zip(bounds[:-1], bounds[1:], bits.tolist())]
                prints = fingerprints(rows, hashes, j - i)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    batch.column(2).slice(i, j - i),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(prints),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "text_key", "n", "node", "sketch"],
            )

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return scanned(keyed, run, "doc_id long, text_key long, n long, node long, sketch binary")


def group_pairs(nodes: np.ndarray, heads: np.ndarray, size: int) -> np.ndarray:
    """All pairs, smaller node first, of groups of ``size`` sorted nodes that start at ``heads``."""
    x, y = np.triu_indices(size, 1)
    first, second = nodes[heads[:, None] + x], nodes[heads[:, None] + y]
    return np.column_stack([np.minimum(first, second).ravel(), np.maximum(first, second).ravel()])


def _shared(signature: np.ndarray, node: np.ndarray, other: np.ndarray, members: int) -> pa.Table:
    """The first ``members`` rows have a signature, the others a second node."""
    pair = np.arange(len(node)) >= members
    return pa.table(
        {
            "signature": pa.array(signature, pa.int64(), mask=pair),
            "node": pa.array(node, pa.int64()),
            "other": pa.array(other, pa.int64(), mask=~pair),
        }
    )


def _shared_signatures(docs: DataFrame, like: Likeness, n_shingles: int = 0) -> DataFrame:
    """Members (signature, node) of signatures that many nodes share, and pairs (node, other) of
    those that up to ``FEW`` nodes share. ``n_shingles`` are all sets' shingles together."""
    buckets = max(partitions(docs.sparkSession), -(-n_shingles * SIGNATURE_BYTES // GROUP_BYTES))

    def packed_rows(bucket, *columns: list[np.ndarray]) -> pa.RecordBatch:
        packed = [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int64()), *packed], names=["bucket", "signatures", "nodes", "sure"]
        )

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(1))
        for i, j in slices(offsets, BLOCK_BYTES):
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in slices(offsets[i : j + 1]):
                a, b = a + i, b + i
                with np.errstate(over="ignore"):
                    part, own_offsets = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    rows, hashes = shingle_sets(part, own_offsets, like.words)
                    sizes = np.bincount(rows, minlength=b - a)
                    own, signed = signatures(rows, hashes, sizes, like)
                    found.append((signed, fingerprints(rows, hashes, b - a)[own]))
            signed, nodes = (np.concatenate(x) for x in zip(*found))
            # 32 bits tell signatures of a bucket apart: a chance meeting only costs a comparison.
            bucket = ((signed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            signed = bucket << 32 | (signed & np.uint64(0xFFFFFFFF)).astype(np.int64)
            order = np.lexsort((nodes, signed))
            signed, nodes = signed[order], nodes[order]
            new = np.ones(len(signed), bool)  # copies in one block are one node
            new[1:] = (signed[1:] != signed[:-1]) | (nodes[1:] != nodes[:-1])
            signed, nodes = signed[new], nodes[new]
            # A signature with many members here is shared for certain: they need not go to its
            # bucket. It is named there, so that its members from elsewhere are listed, too.
            at = np.flatnonzero(np.append(True, signed[1:] != signed[:-1])) if len(signed) else np.zeros(0, np.int64)
            members = np.diff(np.append(at, len(signed)))
            sure = np.repeat(members > MANY_HERE, members)
            none = np.zeros(0, np.int64)
            if sure.any():
                yield packed_rows([buckets + int(signed[0] % buckets)], [signed[sure]], [nodes[sure]], [none])
            named = signed[at][members > MANY_HERE]
            signed, nodes = signed[~sure], nodes[~sure]
            numbers = np.unique(np.concatenate([signed, named]) >> 32)
            ends = [np.searchsorted(x, np.append(numbers, buckets) << 32) for x in (signed, named)]
            yield packed_rows(
                numbers,
                [signed[a:b].astype(np.uint32) for a, b in zip(ends[0][:-1], ends[0][1:])],
                [nodes[a:b] for a, b in zip(ends[0][:-1], ends[0][1:])],
                [named[a:b].astype(np.uint32) for a, b in zip(ends[1][:-1], ends[1][1:])],
            )

    def compare(key, table):
        bucket = key[0].as_py()
        signed, nodes, sure = (b"".join(table[c].to_pylist()) for c in ("signatures", "nodes", "sure"))
        nodes = np.frombuffer(nodes, np.int64)
        if bucket >= buckets:  # shared for certain
            return _shared(np.frombuffer(signed, np.int64), nodes, np.zeros(len(nodes), np.int64), len(nodes))
        signed = np.frombuffer(signed, np.uint32)
        order = np.lexsort((nodes, signed))
        signed, nodes = signed[order], nodes[order]
        new = np.append(len(signed) > 0, (signed[1:] != signed[:-1]) | (nodes[1:] != nodes[:-1]))
        signed, nodes = signed[new[: len(signed)]], nodes[new[: len(signed)]]
        heads = np.flatnonzero(np.append(len(signed) > 0, signed[1:] != signed[:-1])[: len(signed)])
        members = np.diff(np.append(heads, len(signed)))
        listed = (members > FEW) | np.isin(signed[heads], np.frombuffer(sure, np.uint32))
        few = [group_pairs(nodes, heads[(members == m) & ~listed], m) for m in range(2, FEW + 1)]
        pairs = np.unique(np.concatenate(few), axis=0)
        many = np.repeat(listed, members)
        return _shared(
            np.append(bucket << 32 | signed[many].astype(np.int64), np.zeros(len(pairs), np.int64)),
            np.append(nodes[many], pairs[:, 0]),
            np.append(np.zeros(many.sum(), np.int64), pairs[:, 1]),
            many.sum(),
        )

    packed = scanned(docs, sign, "bucket long, signatures binary, nodes binary, sure binary")
    return grouped(packed, ["bucket"], compare, "signature long, node long, other long")


class Sketches:
    """Parity sketches of many sets and how many bits differ between any two of them."""

    def __init__(self, raw: list[bytes], sizes: np.ndarray, like: Likeness):
        self.sizes, self.like = sizes, like
        self.width = np.fromiter(map(len, raw), np.int64, len(raw))
        self.place = np.zeros(len(raw), np.int64)
        self.tables: dict[int, np.ndarray] = {}
        for width in np.unique(self.width):
            at = np.flatnonzero(self.width == width)
            self.place[at] = np.arange(len(at))
            self.tables[int(width)] = np.frombuffer(b"".join(raw[k] for k in at), np.uint64).reshape(len(at), -1)

    def flips(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        kind = self.width[x] << 32 | self.width[y]
        for k in np.unique(kind):
            at = np.flatnonzero(kind == k)
            wide, narrow = (x, y) if k >> 32 >= k & 0xFFFFFFFF else (y, x)
            for part in np.array_split(at, -(-len(at) // 50_000)):
                a = self.tables[int(self.width[wide[part[0]]])][self.place[wide[part]]]
                b = self.tables[int(self.width[narrow[part[0]]])][self.place[narrow[part]]]
                # Bits that lie a narrow sketch's length apart are one bit of the narrow sketch.
                a = np.bitwise_xor.reduce(a.reshape(len(part), -1, b.shape[1]), axis=1)
                out[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        return out

    def open(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether a pair's sizes and sketches let it be similar."""
        small, large = np.minimum(self.sizes[x], self.sizes[y]), np.maximum(self.sizes[x], self.sizes[y])
        out = large * self.like.percent <= 100 * small
        out[out] = self.flips(x[out], y[out]) <= self.like.differences(small[out] + large[out])
        return out


    def promise(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far a pair's sketches lie under what they may differ by, as a share of its shingles."""
        both = self.sizes[x] + self.sizes[y]
        return (self.like.differences(both) - self.flips(x, y)) / both


def open_pairs(members: np.ndarray, component: np.ndarray, sketches: Sketches, forest: bool) -> np.ndarray:
    """Open pairs of one signature's members in different components.

    With ``forest`` only so many of them as connect what all of them connect: one member's
    partners need no comparison among themselves, all other pairs are compared.
    """
    found: list[np.ndarray] = []
    names, counts = np.unique(component[members], return_counts=True)
    # Members of the largest component are compared with those of others, not with each other.
    left, others = members[component[members] != names[counts.argmax()]], members
    if forest:
        x, rest = members[0], members[1:]
        rest = rest[component[rest] != component[x]]
        near = sketches.open(np.full(len(rest), x), rest)
        found.append(np.column_stack([np.full(near.sum(), x), rest[near]]))
        left, others = np.setdiff1d(members[1:], rest[near], assume_unique=True), members[1:]
    for block in np.array_split(left, -(-len(left) * len(others) // PAIRS_AT_ONCE) or 1):
        x, y = np.repeat(block, len(others)), np.tile(others, len(block))
        # Of two members left, one order is enough.
        once = (component[x] != component[y]) & ((x < y) | ~np.isin(y, left, assume_unique=False))
        x, y = x[once], y[once]
        open_ = sketches.open(x, y)
        found.append(np.column_stack([x[open_], y[open_]]))
    return np.sort(np.concatenate(found), axis=1)


def open_pairs_of_equal(groups: np.ndarray, component: np.ndarray, sketches: Sketches) -> np.ndarray:
    """All open pairs of many signatures with equally many members (a row each)."""
    x, y = np.triu_indices(groups.shape[1], 1)
    pairs = []
    for at in np.array_split(np.arange(len(groups)), -(-len(groups) * len(x) // PAIRS_AT_ONCE) or 1):
        a, b = groups[at][:, x].ravel(), groups[at][:, y].ravel()
        apart = component[a] != component[b]
        a, b = a[apart], b[apart]
        open_ = sketches.open(a, b)
        pairs.append(np.column_stack([a[open_], b[open_]]))
    return np.concatenate(pairs)


def forests(pairs: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` spanning forests of the pairs, none sharing a pair."""
    kept: list[np.ndarray] = []
    for _ in range(count):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        joins = np.zeros(len(pairs), bool)
        for k, (x, y) in enumerate(pairs.tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
                joins[k] = True
        kept.append(pairs[joins])
        pairs = pairs[~joins]
    return np.concatenate(kept)


def _open_of_pairs(pairs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) that their sketches leave open, and whether one is in its task's forests."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in batches:
            n = batch.num_rows
            sizes = np.concatenate([batch.column(k).to_numpy() for k in (2, 3)])
            sketches = Sketches([*batch.column(4).to_pylist(), *batch.column(5).to_pylist()], sizes, like)
            open_ = sketches.open(np.arange(n), np.arange(n, 2 * n))
            found.append(np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])[open_])
        if found:
            pairs = np.concatenate(found)
            first = forests(pairs, FORESTS)
            chosen = set(map(tuple, first.tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                    pa.array([p in chosen for p in map(tuple, pairs.tolist())], pa.bool_()),
                ],
                names=["a", "b", "first"],
            )

    side = lambda k: nodes.select(
        F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"sketch_{k}")
    )
    sketched = pairs.join(side("a"), "a").join(side("b"), "b")
    columns = ["a", "b", "n_a", "n_b", "sketch_a", "sketch_b"]
    return sketched.select(*columns).mapInArrow(hold, "a long, b long, first boolean")


def _candidates(members: DataFrame, like: Likeness, forest: bool) -> DataFrame:
    """Open pairs (a, b) of nodes of different components over shared signatures.

    ``members``: signature, node, n, sketch, component. With ``forest`` spanning forests of a
    cell's pairs are enough.
    """

    def choose(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        signature, block = table["signature"].to_numpy(), table["block"].to_numpy()
        node, once, at = np.unique(table["node"].to_numpy(), return_index=True, return_inverse=True)
        own = table.take(pa.array(once))  # one sketch a node
        sketches = Sketches(own["sketch"].to_pylist(), own["n"].to_numpy(), like)
        component = own["component"].to_numpy()
        order = np.lexsort((at, block, signature))
        keys = np.column_stack([signature[order], block[order]])
        heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        # A hot signature's members may be listed twice: once for their block, once in their bucket.
        new = np.append(True, at[order[1:]] != at[order[:-1]])
        new[heads] = True
        group = np.cumsum(np.isin(np.arange(len(order)), heads))[new] - 1
        order = order[new]
        heads = np.flatnonzero(np.append(True, np.diff(group) != 0))
        sizes = np.diff(np.append(heads, len(order)))
        own_component = component[at[order]]
        mixed = np.minimum.reduceat(own_component, heads) != np.maximum.reduceat(own_component, heads)
        heads, sizes = heads[mixed], sizes[mixed]
        found: list[np.ndarray] = []
        for size in np.unique(sizes[sizes > 1]):
            starts = heads[sizes == size]
            if size <= BATCHED:
                found.append(open_pairs_of_equal(at[order[starts[:, None] + np.arange(size)]], component, sketches))
                continue
            found += [open_pairs(at[order[start : start + size]], component, sketches, forest) for start in starts]
        found = [x for x in found if len(x)]
        ends = np.zeros((0, 2), np.int64)
        if found:
            pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            if forest:  # of the pairs that could join two parts, the most promising one
                pairs = pairs[np.argsort(-sketches.promise(*pairs.T), kind="stable")]
                pairs = forests(pairs, FORESTS)
            ends = np.sort(node[pairs], axis=1)
        return pa.table([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    # A signature with very many members is split: every two blocks of its members meet somewhere.
    large = staged(members.groupBy("signature").agg(F.count("*").alias("m")).where(F.col("m") > GROUP), "large")
    if large.limit(1).count():
        blocks = F.ceil(F.coalesce("m", F.lit(1)) / F.lit(GROUP)).cast("long")
        members = (
            members.join(large, "signature", "left")
            .withColumn("own", F.pmod(F.xxhash64("node"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .withColumn("block", F.least("own", "other") * blocks + F.greatest("own", "other"))
        )
    else:
        members = members.withColumn("block", F.lit(0).cast("long"))
    # A cell hands out forests over its nodes, so fewer cells with more signatures hand out less:
    # as many as keep a cell's bytes bounded.
    sketch_bytes = F.greatest(F.lit(8), F.pow(F.lit(2), F.ceil(F.log2("n")) - 2))  # as ``sketch_bits``
    n_bytes = members.agg(F.sum(sketch_bytes + 48)).first()[0] or 0
    cells = -(-int(n_bytes) // GROUP_BYTES) or 1
    dealt = members.withColumn("cell", F.pmod(F.xxhash64("signature", "block"), F.lit(cells)))
    dealt = dealt.select("cell", "signature", "block", "node", "n", "sketch", "component")
    return grouped(dealt, ["cell"], choose, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(batch.column(1))
        for i, j in slices(offsets):
            with np.errstate(over="ignore"):
                rows, hashes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], like.words)
            bounds = np.searchsorted(rows, np.arange(j - i + 1))
            sets = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * both >= like.percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = staged(ends.join(nodes, "node").select("node", "any.text_key", "any.doc_id"), "wanted")
    found = F.col("t.text_key") == F.col("w.text_key")
    found &= F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))
    few = wanted.count() <= MANY_IDS
    keyed = docs.withColumn("text_key", F.xxhash64("text")).alias("t")
    texts = keyed.join((F.broadcast(wanted) if few else wanted).alias("w"), found).select("w.node", "t.text")
    sets = staged(scanned(texts.dropDuplicates(["node"]), read, "node long, shingles binary"), "sets")
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return scanned(joined.select("a", "b", "x", "y"), check, "a long, b long")


def similar_documents(
    docs: DataFrame, like: Likeness | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    like = like or Likeness()
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    described = staged(_describe(rows, like), "described")
    n_shingles = described.agg(F.sum("n")).first()[0] or 0
    shared = staged(_shared_signatures(rows, like, n_shingles), "shared")
    nodes = staged(
        described.where("n > 0")
        .groupBy("node")
        .agg(
            F.max("n").alias("n"),
            F.min("sketch").alias("sketch"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("text_key", "doc_id")).alias("any"),
        ),
        "nodes",
    )
    listed = shared.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    few = staged(_open_of_pairs(listed, nodes, like), "open-pairs")
    belongs = shared.where("signature is not null").select("signature", "node")
    sketched = nodes.select("node", "n", "sketch")
    by_node = Window.partitionBy("node").orderBy("signature")
    some = belongs.withColumn("nth", F.row_number().over(by_node)).where(F.col("nth") <= ROUND).drop("nth")
    some = some.withColumn("component", F.col("node")).join(sketched, "node")
    many = staged(_candidates(some, like, forest=True), "open-groups")
    tried = few.where("first").select("a", "b").unionByName(many).distinct()
    tried = staged(tried, "pairs")
    component = staged(connected_components(_verified(tried, rows, nodes, like)), "components")

    def between(component: DataFrame, forest: bool) -> DataFrame:
        """Open pairs over all signatures whose members lie in different components."""
        named = component.withColumnRenamed("id", "node")
        labelled = belongs.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled = staged(labelled, "labelled")
        ends = labelled.groupBy("signature").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        mixed = labelled.join(ends.where("least <> most").select("signature"), "signature", "left_semi")
        return _candidates(mixed.join(sketched, "node"), like, forest)

    def extended(component: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components when the pairs that are similar are links, too."""
        known = component.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return staged(connected_components(known.unionByName(_verified(pairs, rows, nodes, like))), "components")

    # Sets that a few signatures did not link join by forests over all of them.
    joining = staged(between(component, True).join(tried, ["a", "b"], "left_anti").distinct(), "pairs")
    if joining.limit(1).count():
        component = extended(component, joining)
        tried = tried.unionByName(joining)

    # What is open between components now is verified pair by pair.
    second = between(component, False)
    of = lambda k: component.select(F.col("id").alias(k), F.col("component").alias(f"c_{k}"))
    apart = ~F.coalesce("c_a", "a").eqNullSafe(F.coalesce("c_b", "b"))
    waiting = few.where("not first").join(of("a"), "a", "left").join(of("b"), "b", "left").where(apart)
    second = second.unionByName(waiting.select("a", "b")).distinct()
    second = staged(second.join(tried, ["a", "b"], "left_anti"), "pairs")
    if second.limit(1).count():
        component = extended(component, second)

    in_class = nodes.join(component.withColumnRenamed("id", "node"), "node", "left").select(
        "node", F.coalesce("component", "node").alias("class"), "least_id"
    )
    in_class = staged(in_class, "classes")
    least = in_class.groupBy("class").agg(F.min("least_id").alias("component_id"))
    by_node = in_class.join(least, "class").select("node", "component_id")
    return (
        described.join(by_node, "node", "left")
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


def one_of_each(
    docs: DataFrame, like: Likeness | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that name their component, with all their columns; rows that repeat in
    every column once.

    Rows with a null id stay only if nothing they are linked with has an id.
    """
    found = similar_documents(docs, like, id_column, text_column)
    names = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct().alias("names")
    same = docs[id_column].cast("long").eqNullSafe(F.col("names.doc_id"))
    return docs.join(names, same, "left_semi").dropDuplicates()
