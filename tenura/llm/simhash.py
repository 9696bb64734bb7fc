"""Near duplicates by SimHash: 64-bit fingerprints, and a self-join of a binary trie over the distinct ones.

There is a trie for each block of bits, one block more than bits may differ, and it reads its block first: of two fingerprints
within the budget at least one block is equal, so the pair lies below one node of that block's trie. Each trie is cut at a depth at which
about ``LEAF`` / 2 fingerprints are expected below a node; a node that holds more than ``LEAF`` is dealt again by the blocks of its remaining
bits, up to ``DEALS`` times. So a fingerprint goes to as many leaves as there are blocks, however many fingerprints there are. A
leaf is one group of one task. There pairs of nodes are walked down together: their differing bits add up, and a pair over the
budget is dropped. What a leaf reports is not its pairs but, for each fingerprint with a partner, one that stands for its
component there. Components over the leaves come from rounds of contraction in Spark.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm import bloom
from tenura.llm.tables import free_name, pieces, same
from tenura.session import stage

SHINGLE = 3
BUDGET = 2
LEAF = 20_000
# How often the fingerprints of a node are dealt at most. After three times 46 bits are equal, which leaves 2 ** 18 fingerprints.
DEALS = 3
# Shingles of one text whose bits are counted at a time.
_COUNTED = 1 << 15
# Node pairs walked at a time, and the product of sizes from which a pair of nodes is compared outright.
_WALKED = 1 << 18
_OUTRIGHT = 24


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Each bit is set if it is set in more than half of the shingles' hashes; without words it is 0."""
    from xxhash import xxh64_intdigest

    # Over UTF-8 bytes, lower() changes A-Z only and split() cuts at space and U+0009 to U+000D only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[min(size, len(words)) - 1 :].tolist())]
    values = np.array(hashes, np.uint64)
    set_ = np.zeros(64, np.int64)
    for at in range(0, n, _COUNTED):
        set_ += np.unpackbits(values[at : at + _COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``, a row per row; ``fp`` holds the 64 bits as a signed number. Null texts count as empty."""

    def step(batches):
        for batch in pieces(batches, "text"):
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], ["id", "fp"])

    asked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return asked.mapInArrow(step, asked.select("id").schema.add("fp", "long"))


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of each row's text as ``name``."""

    def step(batches):
        for batch in pieces(batches, text_col):
            found = np.array([fingerprint(t or "") for t in batch.column(text_col).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, name])

    return docs.mapInArrow(step, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


# --- pairs within a leaf -------------------------------------------------------------------------------------------


def _split(keys: np.ndarray, low: np.ndarray, high: np.ndarray, shift: int) -> np.ndarray:
    """For nodes low:high of the sorted ``keys``: where the bit at ``shift`` turns to 1."""
    lead = keys[low] >> np.uint64(shift)
    border = (lead | np.uint64(1)) << np.uint64(shift)
    return np.clip(np.searchsorted(keys, border, "left"), low, high)


def near_pairs(a: np.ndarray, b: np.ndarray | None = None, budget: int = BUDGET):
    """Chunks of (i, j) with at most ``budget`` differing bits between sorted distinct a[i] and b[j]; i < j if b is None."""
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    todo = [(63, *(np.array([x]) for x in (0, len(a), 0, len(b), 0)))]
    while todo:
        shift, al, ah, bl, bh, diff = todo.pop()
        small = (ah - al) * (bh - bl) <= _OUTRIGHT if shift >= 0 else np.ones(len(al), bool)
        if small.any():
            yield from _outright(a, b, al[small], ah[small], bl[small], bh[small], budget, own)
        rest = ~small
        if not rest.any():
            continue
        al, ah, bl, bh, diff = (x[rest] for x in (al, ah, bl, bh, diff))
        am, bm = _split(a, al, ah, shift), _split(b, bl, bh, shift)
        made = []
        for x, y, cost in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            part = [(al, am), (am, ah)][x] + [(bl, bm), (bm, bh)][y] + (diff + cost,)
            ok = (part[0] < part[1]) & (part[2] < part[3]) & (part[4] <= budget)
            if own:  # of a pair of nodes and its mirror image one is walked
                ok &= part[0] <= part[2]
            made.append([p[ok] for p in part])
        nodes = [np.concatenate(x) for x in zip(*made)]
        for at in range(0, len(nodes[0]), _WALKED):
            todo.append((shift - 1, *(x[at : at + _WALKED] for x in nodes)))


def _outright(a, b, al, ah, bl, bh, budget, own):
    size = (ah - al) * (bh - bl)
    for at in range(0, len(al), _WALKED // _OUTRIGHT):
        part = slice(at, at + _WALKED // _OUTRIGHT)
        n = size[part]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(bh[part] - bl[part], n)
        i, j = np.repeat(al[part], n) + k // wide, np.repeat(bl[part], n) + k % wide
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if own:
            near &= i < j
        yield i[near], j[near]


def _stand_ins(n: int, pairs) -> np.ndarray:
    """For each of n nodes the smallest node of its component; pairs come in chunks and are not kept."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            i, j = root[i], root[j]
            differ = i != j
            i, j = i[differ], j[differ]
            if not len(i):
                break
            low, high = np.minimum(i, j), np.maximum(i, j)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


# --- the tries -----------------------------------------------------------------------------------------------------


def blocks_of(route: int, blocks: int) -> tuple[list[int], list[list[int]]]:
    """(bits that are equal, blocks of the other bits) of a route, bits counted from the first.

    A route is the list of blocks chosen so far, as the digits of a number behind a leading 1.
    """
    digits = []
    while route > 1:
        route, digit = divmod(route, blocks)
        digits.append(digit)
    equal, rest = [], list(range(64))
    for digit in reversed(digits):
        parts = [p.tolist() for p in np.array_split(rest, blocks)]
        equal += parts[digit]
        rest = [x for k, p in enumerate(parts) if k != digit for x in p]
    return equal, [p.tolist() for p in np.array_split(rest, blocks)]


def turned(values: np.ndarray, route: int, blocks: int) -> np.ndarray:
    """The values with the bits in the order in which the trie of ``route`` reads them."""
    equal, parts = blocks_of(route, blocks)
    order = equal + [x for p in parts for x in p]
    out = np.zeros(len(values), np.uint64)
    at = 0
    while at < 64:
        # Bits that are neighbours before and after move together.
        stop = at + 1
        while stop < 64 and order[stop] == order[stop - 1] + 1:
            stop += 1
        size = stop - at
        part = (values << np.uint64(order[at])) >> np.uint64(64 - size)
        out |= part << np.uint64(64 - stop)
        at = stop
    return out


def _depth(n: int, leaf: int, block: int) -> int:
    """The bits of a block that deal ``n`` fingerprints into nodes of about ``leaf`` / 2."""
    return min(block, max(0, (2 * n // max(leaf, 1)).bit_length()))


def _deal(leaf: int, blocks: int, last: bool):
    """Task step: (fp, route, n) of nodes of n fingerprints to (fp, route, bits, node) in the trie of each block; the last deal takes whole blocks."""

    def step(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            routes, sizes = batch.column("route").to_numpy(), batch.column("n").to_numpy()
            for route, n in set(zip(routes.tolist(), sizes.tolist())):
                own = values[(routes == route) & (sizes == n)]
                equal, parts = blocks_of(route, blocks)
                for k, part in enumerate(parts):
                    new = route * blocks + k
                    bits = len(equal) + (len(part) if last else _depth(n, leaf, len(part)))
                    node = turned(own, new, blocks) >> np.uint64(64 - bits) if bits else np.zeros(len(own), np.uint64)
                    columns = [pa.array(own.view(np.int64)), pa.repeat(pa.scalar(new, pa.int32()), len(own)), pa.repeat(pa.scalar(bits, pa.int32()), len(own)), pa.array(node.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["fp", "route", "bits", "node"])

    return step


def leaves_of(distinct: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """``(fp, route, bits, node)``: the leaves that each fingerprint goes to. Equal (route, bits, node) are one leaf.

    Whether a node is too large is told by a table of counts that stays in Spark; the driver sees only how many fingerprints there are.
    """
    blocks, n = budget + 1, distinct.count()
    if n <= leaf:
        return distinct.select("fp", F.lit(blocks).alias("route"), F.lit(0).alias("bits"), F.lit(0).cast("bigint").alias("node"))
    asked = distinct.select("fp", F.lit(1).alias("route"), F.lit(n).cast("bigint").alias("n"))
    at = ["route", "bits", "node"]
    done = []
    for deal in range(DEALS):
        last = deal == DEALS - 1 and deal > 0
        dealt = stage(asked.mapInArrow(_deal(leaf, blocks, last), "fp bigint, route int, bits int, node bigint"), "dealt")
        counts = dealt.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf)
        heavy = stage(counts, "heavy")
        if last or not heavy.limit(1).count():
            done.append(dealt)
            break
        done.append(dealt.join(heavy, at, "left_anti"))
        asked = dealt.join(heavy, at).select("fp", "route", "n")
    return reduce(DataFrame.unionByName, done)


def local_links(distinct: DataFrame, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """``(a, b)``: fingerprints joined to a stand-in of their component in one leaf; a row per linked one and leaf."""
    blocks = budget + 1

    def join(key, table):
        values = table.column("fp").to_numpy().view(np.uint64)
        read = turned(values, key[0].as_py(), blocks)
        order = np.argsort(read)
        read, values = read[order], values[order]
        root = _stand_ins(len(read), near_pairs(read, None, budget))
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(values[linked].view(np.int64)), "b": pa.array(values[root[linked]].view(np.int64))})

    return leaves_of(distinct, budget, leaf).groupBy("route", "bits", "node").applyInArrow(join, "a bigint, b bigint")


# --- components ----------------------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b): equal roots are connected.

    Each round maps every node to the one of least hash among itself and its neighbours, and joins what is mapped together;
    the expected number of nodes falls by a fixed share a round. The maps are then applied one after the other.
    """
    edges = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    maps: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), c).alias("hash"), c.alias("node"))
        to = both.groupBy("a").agg(F.least(F.min(rank(F.col("b"))), rank(F.col("a"))).alias("m"))
        maps.append(stage(to.select(F.col("a").alias("node"), F.col("m.node").alias("root")), "map"))
        left, right = (maps[-1].select(F.col("node").alias(c), F.col("root").alias(f"{c}_to")) for c in "ab")
        moved = edges.join(left, "a").join(right, "b").where("a_to <> b_to")
        edges = stage(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[-1]
    for before in reversed(maps[:-1]):
        after = out.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        out = stage(before.join(after, "root", "left").select("node", F.coalesce("_next", "root").alias("root")), "map")
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """``(id_col, fp, component_id)``, a row per row: the smallest id that chains of links reach, itself included.

    Equal fingerprints are linked; texts without words have fingerprint zero and are linked like any other. Null ids are
    passed over when the smallest id is taken; a component without any id has a null id. No rows: no rows.
    """
    marked = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    least = stage(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(local_links(least.select("fp"), budget, leaf))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(named, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_text(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, that of the smallest id, with the columns of ``docs``. Rows without id stay.

    ``groups`` is what ``near_groups`` says of ``docs``. Of rows that share an id only those go whose own text is in a group with a
    smaller id; the others are taken for one document.
    """
    odd = groups.where(~same(F.col(id_col), F.col("component_id")) & F.col(id_col).isNotNull())
    key, print_, own = (free_name(docs, n) for n in ("__key", "__fp", "__own"))
    gone = stage(odd.select(F.col(id_col).alias(key), F.col("fp").alias(print_)).distinct(), "gone")
    meets = (F.col(id_col) == F.col(key)) & (F.col(own) == F.col(print_))
    return bloom.without(docs, gone, F.col(id_col), key, meets, lambda asked: with_fingerprint(asked, own, text_col))
