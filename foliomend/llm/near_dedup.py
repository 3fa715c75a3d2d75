"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A text's set is its distinct shingles of consecutive words. Its signature has CHUNKS x WIDTH symbols,
each b = 14 bits of the hashed minimum of a hash function of its own. The distance of two
signatures is the number of symbols that differ. If it is at most DISTANCE = 2 * CHUNKS - 1, some
chunk, by pigeonhole, differs in one symbol at most: so each chunk gives WIDTH keys, the chunk's
symbols without one of them in turn, and every pair within DISTANCE shares a key. Pairs that share
a key pass if their sizes allow the similarity and their distance is at most DISTANCE; links are
then confirmed on the full sets. At similarity 0.8 a distance exceeds DISTANCE with probability
1.2e-6, and with less above it; that is all that a link can be lost by.

Equal sets are one node from the start, so copies never meet in pairs. Each other node is first
compared with one hub, the member of its keys that shares most keys with others, and what that links
is contracted. Nodes of one hub that it does not link are then compared with all nodes of that hub,
block against block inside a task, from which only links come out, at most one for each component.
Pairs that share a key across different hubs and components are formed at last, those of a key with
many members block against block as well. No key has a cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.llm.common import looked_up, mix, slices, word_hashes, written

CHUNKS, WIDTH = 22, 5
SYMBOLS, BITS = CHUNKS * WIDTH, 14
LONGS = -(-SYMBOLS // 4)
#: The guarantee of the index and the filter of its pairs; at similarity 0.8 distances have mean 22 and deviation 4.2.
DISTANCE = 2 * CHUNKS - 1

#: Four symbols that differ give this bit above each when the other number is added to their difference.
_FILL, _ABOVE = 0x3FFF3FFF3FFF3FFF, 0x4000400040004000

_rng = np.random.Generator(np.random.PCG64(77))
_odd = lambda *shape: _rng.integers(0, 2**64, shape, dtype=np.uint64) | np.uint64(1)
_MULTIPLY, _ADD, _PLACE, _SALT = _odd(SYMBOLS, 1), _odd(SYMBOLS, 1), _odd(SYMBOLS), _odd(SYMBOLS)
_K1, _K2, _K3 = _odd(1)[0], _odd(1)[0], _odd(1)[0]


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Fewer words than that are one shingle; none, an empty set."""
    for _, hashes, counts in word_hashes(texts):
        at = 0
        for n in counts:
            h = hashes[at : at + n]
            at += n
            if n == 0:
                yield np.zeros(0, np.uint64)
                continue
            k = min(n, words)
            s = h[: n - k + 1].copy()
            for i in range(1, k):
                s = mix(s * _K1 + h[i : n - k + 1 + i] * _K2)
            yield np.unique(mix(s + np.uint64(int(k) * int(_K3) % 2**64)))


def minima(s: np.ndarray) -> np.ndarray:
    """The signature's minima before they are cut to b bits."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        np.minimum(low, (s[None, i : i + 1024] * _MULTIPLY + _ADD).min(axis=1), out=low)
    return low


def symbols_of(low: np.ndarray) -> np.ndarray:
    """The b bits of each minimum that the signatures (rows) keep."""
    return (mix(low + _SALT) >> np.uint64(64 - BITS)).astype(np.uint16)


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """The keys of the multi-index: each chunk of a signature (row) without one of its symbols in turn."""
    chunk = mix((symbols.astype(np.uint64) + np.uint64(1)) * _PLACE).reshape(len(symbols), CHUNKS, WIDTH)
    return mix(chunk.sum(axis=2, keepdims=True, dtype=np.uint64) - chunk + _SALT.reshape(CHUNKS, WIDTH)).reshape(len(symbols), SYMBOLS)


def packed(symbols: np.ndarray) -> np.ndarray:
    """Four symbols to a long, zeros at the end."""
    out = np.zeros((len(symbols), LONGS * 4), np.uint16)
    out[:, :SYMBOLS] = symbols
    return out.view(np.int64)


def text_hash(text: Column) -> Column:
    """Tells rows with one doc_id apart."""
    return F.xxhash64(text)


def signed(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, row, n, set_a, set_b, sig, keys): size and hash of the set, packed symbols, keys of the multi-index."""
    schema = "doc_id long, text_hash long, row long, n long, set_a long, set_b long, sig array<long>, keys array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 3)):
            n, same, low = [], [], []
            for s in shingle_sets(batch.column(3), words):
                n.append(len(s))
                same.append(xxhash.xxh3_128_digest(s.tobytes()))
                low.append(minima(s))
            if not n:
                continue
            symbols = symbols_of(np.array(low))
            both = np.frombuffer(b"".join(same), np.int64).reshape(-1, 2)
            lists = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.reshape(-1).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), lists(packed(symbols)), lists(keys_of(symbols))],
                [x.split()[0] for x in schema.split(", ")],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col).cast("string")), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string"))
    return rows.mapInArrow(sign, schema)


def distance(a: Column, b: Column) -> Column:
    """Differing symbols of two packed signatures: where two differ, adding 2^14 - 1 sets the bit above them."""

    def differing(i: int) -> Column:
        return F.bit_count((a[i].bitwiseXOR(b[i]) + F.lit(_FILL)).bitwiseAND(F.lit(_ABOVE)))

    return reduce(lambda p, q: p + q, (differing(i) for i in range(LONGS)))


def near(a: str, b: str, percent: int) -> Column:
    """Whether two sides' sizes and signatures allow the similarity."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (distance(F.col(f"{a}.sig"), F.col(f"{b}.sig")) <= DISTANCE)


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of all ends of the edges (a, b): root is the smallest id of the component.

    Each round every node takes the smallest of its neighbours and itself, and edges move to what was
    taken, until none is left; the number of rounds follows the logarithm of the longest path.
    """
    left = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while left.head(1):
        both = left.union(left.select("b", "a"))
        step = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to")), "step")
        if roots is None:
            roots = step.select("id", F.col("to").alias("root"))
        else:
            roots = written(roots.join(step.select(F.col("id").alias("root"), "to"), "root", "left").select(roots["id"], F.coalesce("to", "root").alias("root")), "roots")
        moved = left.join(step.select(F.col("id").alias("a"), F.col("to").alias("p")), "a").join(step.select(F.col("id").alias("b"), F.col("to").alias("q")), "b")
        left = written(moved.where("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
    return roots if roots is not None else left.select(F.col("a").alias("id"), F.col("b").alias("root"))


def alike(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    same = len(s) + len(t) - len(np.union1d(s, t))
    return 100 * same >= percent * (len(s) + len(t) - same)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (id, shingles) are as similar as asked."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(*(np.frombuffer(v.as_buffer(), np.uint64) for v in both), percent) for both in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b")
    return x.select("a", "b", "s", "t").mapInArrow(confirm, "a long, b long")


#: Shingles of a block together, about, and the most texts of a block.
BLOCK_SHINGLES, BLOCK_TEXTS = 1 << 15, 256


def block_links(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], others: np.ndarray, other_roots: np.ndarray, other_sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of ids with others of another root, one for each id and root: the sets as 0-1 matrices, multiplied."""
    items, column = np.unique(np.concatenate(sets), return_inverse=True)
    x = np.zeros((len(sets), len(items)), np.float32)
    x[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), column] = 1
    size = np.array([len(s) for s in sets])
    links = []
    for at in range(0, len(others), 64):
        part = other_sets[at : at + 64]
        flat = np.concatenate(part)
        where = np.minimum(np.searchsorted(items, flat), len(items) - 1)
        known = items[where] == flat
        y = np.zeros((len(part), len(items)), np.float32)
        y[np.repeat(np.arange(len(part)), [len(s) for s in part])[known], where[known]] = 1
        same = (x @ y.T).astype(np.int64)
        union = size[:, None] + np.array([len(s) for s in part])[None, :] - same
        i, j = np.nonzero((100 * same >= percent * union) & (roots[:, None] != other_roots[None, at : at + 64]))
        links.append(np.column_stack([ids[i], others[at + j], other_roots[at + j]]))
    found = np.concatenate(links)
    _, first = np.unique(found[:, [0, 2]], axis=0, return_index=True)
    return [(int(a), int(b)) for a, b, _ in found[first]]


def links_in_groups(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) across the roots of each group. groups: hub, id, root, n, loose (to be compared with all of the group)."""
    per_block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_TEXTS), (BLOCK_SHINGLES / F.greatest(F.avg("n"), F.lit(1))).cast("int")))
    parts = [F.ceil(F.count_if("loose") / per_block).cast("int").alias("p"), F.ceil(F.count("*") / per_block).cast("int").alias("q")]
    blocks = written(groups.groupBy("hub").agg(*parts, F.count("*").alias("times")), "blocks")
    rows = looked_up(groups, blocks, ["hub"]).join(sets, "id")
    own = lambda m: F.pmod(F.xxhash64("id"), m).cast("int")
    all_of = lambda m: F.explode(F.sequence(F.lit(0), m - 1))
    left = rows.where("loose").select("hub", "id", "root", "shingles", own(F.col("p")).alias("i"), all_of(F.col("q")).alias("j"))
    again = [F.col(c).alias(c) for c in ("hub", "id", "root", "shingles")]  # other attributes than those of the left side
    right = rows.select(*again, own(F.col("q")).alias("j"), all_of(F.col("p")).alias("i"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        links = []
        if left.num_rows and right.num_rows:
            read = lambda t: (t["id"].to_numpy(), t["root"].to_numpy(), [np.frombuffer(v.as_buffer(), np.uint64) for v in t["shingles"]])
            links = block_links(*read(left), *read(right), percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    keys = ["hub", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a long, b long")


#: Members of a key up to which its pairs come from a join, and rows of a block in a larger key.
JOINED, BLOCK = 64, 4096


def close(a: np.ndarray, b: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which possible pairs of packed signatures are within DISTANCE: first by half of the symbols, then by all."""
    differing = lambda x: np.bitwise_count((x + np.uint64(_FILL)) & np.uint64(_ABOVE))
    half, so_far = a.shape[1] // 2, np.zeros(possible.shape, np.uint8)
    for k in range(half):
        so_far += differing(a[:, None, k] ^ b[None, :, k])
    i, j = np.nonzero(possible & (so_far <= DISTANCE))
    keep = so_far[i, j] + differing(a[i, half:] ^ b[j, half:]).sum(axis=1) <= DISTANCE
    return i[keep], j[keep]


def near_pairs(live: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a key, are within DISTANCE and of possible sizes, and have different roots and hubs.

    live: key, m (members of the key), id, root, hub, n, sig. Pairs of a small key come from a join.
    The members of a large one are compared block against block inside tasks, those of possible sizes
    only, and only what is near comes out.
    """
    x, y = live.where(F.col("m") <= JOINED).alias("x"), live.where(F.col("m") <= JOINED).alias("y")
    other = lambda c: F.col(f"x.{c}") != F.col(f"y.{c}")
    few = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & other("root") & other("hub") & near("x", "y", percent))
    few = few.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    # Each member of a large key is in one of its blocks; block i meets every block j from i on.
    parts, own = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int"), F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / F.lit(BLOCK))).cast("int")
    columns, big = ["key", "id", "root", "hub", "n", "sig"], live.where(F.col("m") > JOINED)
    left = big.select(*columns, own.alias("i"), F.explode(F.sequence(own, parts - 1)).alias("j"))
    again = [F.col(c).alias(c) for c in columns]  # other attributes than those of the left side
    right = big.select(*again, own.alias("j"), F.explode(F.sequence(F.lit(0), own)).alias("i"))

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("n"), right.sort_by("n")
            read = lambda t: [t[c].to_numpy() for c in ("id", "root", "hub", "n")]
            signatures = lambda t: t["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(t.num_rows, -1)
            a, b, s, t, same = read(left), read(right), signatures(left), signatures(right), key[1] == key[2]
            for at in range(0, len(s), 128):
                i, r, h, n = (v[at : at + 128, None] for v in a)
                # In order of size, those that can be linked with these are a range.
                some = slice(np.searchsorted(b[3] * 100, n.min() * percent, "left"), np.searchsorted(b[3] * percent, n.max() * 100, "right"))
                j, q, g, m = (v[some] for v in b)
                possible = (r != q) & (h != g) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((i < j) if same else True)
                k, l = close(s[at : at + 128], t[some], possible)
                found.append(np.column_stack([i[k, 0], j[l]]))
        pairs = np.sort(np.concatenate(found), axis=1)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    keys = ["key", "i", "j"]
    many = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda key, x, y: compare(tuple(v.as_py() for v in key), x, y), "a long, b long")
    return few.union(many).distinct()


#: Bits a wanted id and most bits of the filter that picks the texts whose sets are needed; false hits cost time only.
ID_BITS, MOST_BITS = 16, 1 << 28


def _slot(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit for each slot that holds one of the ids, in bytes: their number follows that of the ids, up to 32 MB."""
    bits = min(MOST_BITS, 1 << max(16, (ID_BITS * ids.count() - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            at = _slot(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(found, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["bits"])

    found = np.zeros(bits // 8, np.uint8)
    for row in ids.coalesce(8).mapInArrow(mark, "bits binary").toLocalIterator():
        found |= np.frombuffer(row.bits, np.uint8)
    return found


def hits(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = _slot(ids, 8 * len(wanted))
    return (wanted[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def sets_of(ends: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of the nodes ends (id, doc_id, set_a, set_b), from their texts: one row for each node.

    Only sets that are needed move. Rows with equal sets may all pass the filter (false hits,
    repeated or null doc_ids): a task gives each set once, and of what the tasks give one stays.
    """
    wanted = id_filter(ends.select("doc_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.filter(pa.array(hits(ids, wanted))), 1):
                found, digests = [], []
                for s in shingle_sets(part.column(1), words):
                    if (digest := xxhash.xxh3_128_digest(data := s.tobytes())) not in seen:
                        seen.add(digest)
                        found.append(data)
                        digests.append(digest)
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(found, pa.binary())], ["set_a", "set_b", "shingles"])

    table = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(sets, "set_a long, set_b long, shingles binary")
    needed = ends.select("id", "set_a", "set_b").join(table, ["set_a", "set_b"])
    return written(needed.groupBy("set_a", "set_b", "id").agg(F.any_value("shingles").alias("shingles")).select("id", "shingles"), "sets")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, text_hash, stays.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest doc_id reachable over links, kept tells whether it is the row's own,
    stays is true for one row of each component (of several with the smallest doc_id, any one).
    Null and empty texts, and texts of white space, have an empty set and are linked with nothing.
    Rows with one doc_id are texts of their own, each linked by its own set; a row with a null
    doc_id counts as larger than any id. A very long text is read in segments; its set, eight bytes a
    shingle, must fit in a row. Other columns of docs are not read; an empty table gives an empty result.
    """
    signs = written(signed(docs, words, id_col, text_col), "signatures")
    full = signs.where("n > 0")
    # A node is a distinct set, named by the smallest row that has it.
    first = F.min(F.struct("row", "doc_id", "sig", "keys")).alias("first")
    nodes = full.groupBy("set_a", "set_b", "n").agg(first)
    nodes = written(nodes.select(F.col("first.row").alias("id"), "first.doc_id", "set_a", "set_b", "n", "first.sig", "first.keys"), "nodes")
    keyed = nodes.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    members = written(keyed.join(shared, "key"), "members")
    side = lambda name: F.struct("n", "sig").alias(name)
    sides = nodes.select("id", "n", "sig")

    def links_of(pairs: DataFrame) -> DataFrame:
        return written(confirmed(pairs, texts_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b"))), percent), "links")

    def texts_of(ids: DataFrame) -> DataFrame:
        ends = written(nodes.select("id", "doc_id", "set_a", "set_b").join(ids.distinct(), "id", "left_semi"), "ends")
        return sets_of(ends, docs, words, id_col, text_col)

    # First each node with one hub: of its keys' heaviest members that it may be linked with, the heaviest.
    weights = members.groupBy("id").agg(F.sum("times").alias("weight"))
    weighed = written(members.select("key", "id").join(weights, "id"), "weighed")
    heaviest = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("top"))
    tried = weighed.join(heaviest, "key").select(F.col("id").alias("a"), (-F.col("top.minus")).alias("b"), F.col("top.weight").alias("weight")).where("a <> b").distinct()
    tried = tried.join(sides.select(F.col("id").alias("a"), side("x")), "a").join(sides.select(F.col("id").alias("b"), side("y")), "b").where(near("x", "y", percent))
    stars = written(tried.groupBy("a").agg(F.max(F.struct("weight", (-F.col("b")).alias("minus"))).alias("top")).select("a", (-F.col("top.minus")).alias("b")), "stars")
    links = links_of(stars)
    roots = components(links)
    # Then, inside each hub's group, what the hub does not link with all others.
    hubs = stars.select(F.col("a").alias("id"), F.col("b").alias("hub")).union(stars.select(F.col("b").alias("id"), F.col("b").alias("hub")).distinct())
    rooted = written(hubs.join(roots, "id", "left").select("hub", "id", F.coalesce("root", "id").alias("root")), "rooted")
    of_hub = rooted.groupBy("hub").agg(F.max(F.when(F.col("id") == F.col("hub"), F.col("root"))).alias("hub_root"), F.count("*").alias("times"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_hubs = written(of_hub.where("low <> high AND times > 2").select("hub", "hub_root", "times"), "open-hubs")
    groups = looked_up(rooted, open_hubs, ["hub"]).select("hub", "id", "root", (F.col("root") != F.col("hub_root")).alias("loose"))
    groups = written(groups.join(nodes.select("id", "n"), "id").select("hub", "id", "root", "n", "loose"), "groups")
    links = written(links.union(links_in_groups(groups, texts_of(groups.select("id")), percent)), "links")
    roots = components(links)
    # At last pairs across hubs and components: what shares a hub has been compared.
    own_hub = stars.select(F.col("a").alias("id"), F.col("b").alias("hub"))
    at = members.select("key", "id").join(roots, "id", "left").join(own_hub, "id", "left")
    at = written(at.select("key", "id", F.coalesce("root", "id").alias("root"), F.coalesce("hub", "id").alias("hub")), "at")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("root", "hub") for f in (F.min, F.max)]
    open_keys = at.groupBy("key").agg(*ends, F.count("*").alias("m")).where("min_root <> max_root AND min_hub <> max_hub").select("key", "m")
    live = written(at.join(open_keys, "key").join(sides, "id").select("key", "m", "id", "root", "hub", "n", "sig"), "live")
    pairs = written(near_pairs(live, percent), "pairs")
    roots = components(links.union(links_of(pairs)))
    # From nodes to rows: the smallest doc_id of each component, and the row that has it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    of_set = full.groupBy("set_a", "set_b").agg(F.min("row").alias("id"), first, F.count("*").alias("times")).join(roots, "id", "left")
    of_set = written(of_set.select("set_a", "set_b", F.coalesce("root", "id").alias("root"), "first", "times"), "of_set")
    least = written(of_set.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("times")), "least")
    named = looked_up(of_set.select("root", "set_a", "set_b", F.col("times").alias("rows")), least, ["root"])
    named = written(named.select("set_a", "set_b", "least", F.col("rows").alias("times")), "named")
    rows = signs.select("doc_id", "text_hash", "row", F.col("n").alias("n_shingles"), "set_a", "set_b")
    least = lambda c: F.col(f"least.{c}")
    some = looked_up(rows.where("n_shingles > 0"), named, ["set_a", "set_b"])
    some = some.select("doc_id", "n_shingles", least("doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == least("doc_id"), least("none")).alias("kept"), "text_hash", (F.col("row") == least("row")).alias("stays"))
    return some.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_hash", F.lit(True).alias("stays")))
