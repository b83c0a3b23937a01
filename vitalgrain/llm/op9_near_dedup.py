"""Near-duplicate components by a chosen-path similarity join over minwise tokens.

A document is the set of its distinct five-word shingles. Equal sets are one class from the start.
Each class has SIGNATURE minwise tokens. TREES independent trees branch the classes: at each node
two of the signature's coordinates, chosen by the node's path, send a class to two children named
by its tokens there. At a similarity of 0.75 a pair stays together in one given child with
probability 0.75, so two children a node keep it in some branch of a tree with probability 0.89 at
any depth, and in some tree with probability 0.9986; on the first level alone it shares one of six
nodes with probability 1 - 0.25 ** 6.

Small nodes are compared exhaustively. Large nodes are compared with PIVOTS members drawn anew on
each level. The links of all levels so far are united, and each class carries the label of its
component; a pair is skipped only if both ends have the same label, as it can't change a component
then. A node of one label ends. A node with few classes outside its most frequent label compares
those with all its members, in cells of bounded size from which only links come, and ends; another
one branches on. So a group of a third of all rows costs comparisons in proportion to its size. Every
link is confirmed on the full shingle sets before it counts.

Defined cases: null texts, empty texts and texts without words have no shingles, are linked with
nothing and stay; fewer than five words are one shingle; rows that repeat an id and a text are one
class and all of them carry its component; null ids never name a component unless the whole
component has no other; an empty table stays empty; `kept_documents` decides by row, also where ids
repeat or are null, keeps one row of each component and returns all columns unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from .common import attach_groups, filter_test, materialise, member_filter, slices, text_or_empty, word_hashes
from .op6_exact_dedup import repeat_filter

SHINGLE_WORDS = 5
#: Linked if 100 * intersection >= LEAST_PERCENT * union.
LEAST_PERCENT = 75
SIGNATURE = 128
TREES = 3
#: A node of up to so many classes is compared exhaustively.
NODE_ROWS = 64
PIVOTS = 4
LEVELS = 8
#: A large node ends with at most so many classes outside its most frequent label, each compared with all its members; on the last level any number is.
REST_ROWS = 512
MEMBER_ROWS = 1024
#: Cells that the shingles of large nodes are counted in, to order them by frequency.
COUNT_CELLS = 1 << 16
#: Bits of the filter of shingles that two sets have, 8 for a shingle at best; BLOCK_MARKS of them are put together by one task.
MARKS = 1 << 26
BLOCK_MARKS = 1 << 16
#: Bytes of shingles that a task holds at once while it marks them.
MARKED_BYTES = 1 << 23
#: Pairs whose signatures agree less than this are not looked at: 4.4 standard deviations below 0.75.
LEAST_ESTIMATE = 0.58
#: Sets that may be broadcast at once to join hot pivots.
HOT_SETS = 64
#: Pairs that may be broadcast, 16 bytes each.
FEW_PAIRS = 200_000
#: Edges that one task unites.
SMALL_GRAPH = 500_000

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_S29, _S32 = np.uint64(29), np.uint64(32)
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 32, SIGNATURE, np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SIGNATURE, np.uint32)
#: A tree's root has two children, so there are two of its own minwise hashes a tree.
_ROOTS = _RNG.integers(0, 1 << 63, 2 * TREES, np.uint64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for part in slices(texts):
        starts, h = word_hashes(part)
        n = len(h)
        five = np.zeros(n, np.uint64)
        for i in range(SHINGLE_WORDS):
            five[: max(0, n - i)] += (h[i:] ^ (h[i:] >> _S29)) * _M[i]
            five = five * _M[0] + _M[1]
        five = (five ^ (five >> _S32)) * _M[4]
        five ^= five >> _S29
        at = starts.tolist()
        for a, b in zip(at, at[1:]):
            if b - a >= SHINGLE_WORDS:
                yield np.unique(five[a : b - SHINGLE_WORDS + 1])
            elif b > a:
                yield np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), b - a)], np.uint64)
            else:
                yield np.empty(0, np.uint64)


def signature(items: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """SIGNATURE minwise tokens, 16 bits of each kept, and the 64-bit minwise tokens of the roots' children."""
    low = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    small = (items >> _S32).astype(np.uint32) ^ items.astype(np.uint32)
    for i in range(0, len(small), 256):
        low = np.minimum(low, (small[i : i + 256, None] * _A + _B).min(axis=0))
    # the lowest bits of a minimum are as good as random, the highest are nearly all zero
    roots = [int((mixed := (items ^ r) * _M[1], (mixed ^ (mixed >> _S32)) * _M[3])[1].min()) for r in _ROOTS]
    return low.astype(np.uint16), roots


def _set_id(items: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(items.tobytes())


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("sig", pa.binary()), ("roots", pa.list_(pa.int64()))])
_SKETCH_SPARK = "doc_id long, n_shingles long, set_id binary, sig binary, roots array<long>"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
            if not len(s):
                rows.append((doc, 0, None, None, None))
                continue
            sig, roots = signature(s)
            rows.append((doc, len(s), _set_id(s), sig.tobytes(), [_signed(xxhash.xxh3_64_intdigest(f"{i}:{r}")) for i, r in enumerate(roots)]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SKETCH)], schema=_SKETCH)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first_doc, text): the words in place of the text, compressed before they move."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        words = [packer.compress(b" ".join(t.as_py().encode("utf-8", "surrogatepass").lower().split())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["first_doc", "words"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words, set_id, node, sig, large): those whose set is the one looked for."""
    for batch in batches:
        right = [_set_id(full_set(w)) == s for w, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        rest = batch.filter(pa.array(right, pa.bool_()))
        yield pa.RecordBatch.from_arrays([rest.column(i) for i in (2, 3, 0, 4)], names=["node", "sig", "words", "large"])


def full_set(words: bytes) -> np.ndarray:
    """The shingle set of compressed words."""
    return next(shingle_sets(pa.array([zstandard.decompress(words).decode("utf-8", "surrogatepass")])))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets are as similar as a link needs."""
    if LEAST_PERCENT * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= LEAST_PERCENT * (len(both) - common)


def _linked_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, words_a, words_b): the pairs that are linked. The sets used last are kept."""
    recent: dict[int, np.ndarray] = {}

    def of(node: int, words: bytes) -> np.ndarray:
        if node not in recent:
            if len(recent) >= 256:
                recent.clear()
            recent[node] = full_set(words)
        return recent[node]

    for batch in batches:
        out = [(a, b) for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)) if linked(of(a, x.as_py()), of(b, y.as_py()))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIRS)


@F.arrow_udf(ArrayType(LongType()))
def _like_pivots(sig: pa.Array, pivots: pa.Array) -> pa.Array:
    """The pivots whose signatures agree with this one in enough tokens."""
    out = []
    for x, row in zip(sig, pivots):
        own = np.frombuffer(x.as_py(), np.uint16)
        out.append([q["p"] for q in row.as_py() if (np.frombuffer(q["sig_p"], np.uint16) == own).sum() >= LEAST_ESTIMATE * SIGNATURE])
    return pa.array(out, pa.list_(pa.int64()))


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, node, label, sig): the like pairs of each key that have two labels."""
    key, nodes, labels, sigs, out = None, [], [], [], []

    def compared() -> Iterator[tuple[int, int]]:
        if len(nodes) < 2:
            return
        m = np.frombuffer(b"".join(sigs), np.uint16).reshape(-1, SIGNATURE)
        of = np.array(labels)
        for i in range(len(nodes) - 1):
            alike = ((m[i + 1 :] == m[i]).sum(axis=1) >= LEAST_ESTIMATE * SIGNATURE) & (of[i + 1 :] != of[i])
            for j in (np.flatnonzero(alike) + i + 1).tolist():
                yield min(nodes[i], nodes[j]), max(nodes[i], nodes[j])

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_PAIRS)

    for batch in batches:
        for k, node, label, sig in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if k != key:
                out += compared()
                key, nodes, labels, sigs = k, [], [], []
                if len(out) > 8192:
                    yield batch_of(out)
                    out = []
            nodes.append(node)
            labels.append(label)
            sigs.append(sig)
    out += compared()
    if out:
        yield batch_of(out)


def _token(coordinate: Column) -> Column:
    """Two bytes of the signature; the coordinate is a column as it depends on the path."""
    return F.substring(F.col("sig"), coordinate * 2 + 1, F.lit(2))


def _children(path: Column) -> list[Column]:
    """Keys of a node's two children: its path, the coordinate chosen there and the token."""
    out = []
    for i in range(2):
        coordinate = F.pmod(F.xxhash64(path, F.lit(f"branch{i}")), F.lit(SIGNATURE)).cast("int")
        out.append(F.xxhash64(path, coordinate, _token(coordinate)))
    return out


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's edges; the least node is the root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["a", "to"])


def components(edges: DataFrame, small: int = SMALL_GRAPH, rows: int | None = None) -> DataFrame:
    """(node, root) of all nodes of an edge table (a, b).

    While more than `small` edges are left, each round maps every node to its least neighbour and
    drops the edges within, which at least halves the nodes; what is left then is one task's work.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges", rows)
    labels = None
    while left := edges.count():
        if left <= small:
            least = materialise(edges.repartition(1).mapInArrow(_united, "a long, to long"), "least").withColumn("degree", F.lit(1))
        else:
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"), F.count("*").alias("degree")), "least", 2 * left)
        if labels is None:
            labels = least.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            sizes = labels.groupBy("root").agg(F.count("*").alias("members")).join(least.select(F.col("a").alias("root"), "to"), "root")
            labels = attach_groups(labels, sizes, "root", "members", max(1, labels.count())).select("node", F.coalesce("to", "root").alias("root"))
        labels = materialise(labels, "labels", rows)
        if left <= small:
            break
        one = attach_groups(edges, least, "a", "degree", left, written=True).select(F.col("to").alias("x"), F.col("b").alias("a"))
        two = attach_groups(one, least, "a", "degree", left, written=True).select("x", F.col("to").alias("y"))
        edges = materialise(two.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges", left)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels


def _confirmed(pairs: DataFrame, sets: DataFrame, rows: int | None = None) -> DataFrame:
    """Those of the distinct pairs (a, b) whose full sets are similar enough.

    Up to FEW_PAIRS, the pairs are broadcast to the sets, and only the words that they name move.
    Beyond, these words go to the pairs, b's and then a's; a hot end is broadcast.
    """
    pairs = materialise(pairs, "candidates", rows)
    total = pairs.count()
    if not total:
        return pairs
    if total <= FEW_PAIRS:
        ends = [sets.select(F.col("node").alias(x), F.col("words").alias(f"words_{x}")).join(F.broadcast(pairs), x) for x in "ab"]
        whole = ends[0].join(ends[1], ["a", "b"])
    else:
        ends = [pairs.groupBy(F.col(x).alias("node")).agg(F.count("*").alias("pairs")) for x in "ba"]
        needed, cells = member_filter(ends[0].select("node").unionByName(ends[1].select("node")), "node", 2 * total)
        some = filter_test(sets.select("node", "words"), "node", needed, cells).where("__maybe").drop("__maybe")
        whole = pairs
        for x, end in zip("ba", ends):
            found = end.join(some, "node").select(F.col("node").alias(x), "pairs", F.col("words").alias(f"words_{x}"))
            whole = attach_groups(whole, found, x, "pairs", total, HOT_SETS).drop("pairs")
    return materialise(whole.select("a", "b", "words_a", "words_b").mapInArrow(_linked_pairs, "a long, b long"), "links", 10 * total)


def _members(state: DataFrame, rows: int) -> DataFrame:
    """(key, node, label, size) of the nodes that still can give a link: those of more than one label."""
    xor = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in range(2)]
    keys = state.groupBy("key").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"), *xor).where("low <> high")
    # small nodes with the same members need comparing once; large ones go on by paths of their own
    small = keys.where(F.col("size") <= NODE_ROWS).groupBy("size", "x0", "x1").agg(F.min("key").alias("key"))
    large = keys.where(F.col("size") > NODE_ROWS)
    keys = materialise(small.select("key", "size").unionByName(large.select("key", "size")), "keys", rows)
    joined = attach_groups(state, keys, "key", "size", max(1, rows), written=True)
    return materialise(joined.where("size is not null").select("key", "node", "label", "size"), "members", rows)


def _exhaustive(members: DataFrame, sets: DataFrame) -> DataFrame:
    rows = members.join(sets.select("node", "sig"), "node").select("key", "node", "label", "sig")
    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_node_pairs, "a long, b long").distinct()


def _rest_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the open classes of large nodes with all members of another label, on their full sets.

    The members are dealt over cells of about MEMBER_ROWS rows, and a copy of the open ones, in
    parts of about REST_ROWS, goes to each cell; only links leave it.
    """
    rows = members.join(sets, "node").select("key", "node", "open", "label", "sig", "words", F.ceil(F.col("unsettled") / REST_ROWS).cast("int").alias("f"), F.ceil(F.col("size") / MEMBER_ROWS).cast("int").alias("m"))
    part, cell = F.pmod(F.xxhash64("node", F.lit("part")), "f").cast("int"), F.pmod(F.xxhash64("node", F.lit("cell")), "m").cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("f") - 1), lambda x: F.struct(x.alias("f"), cell.alias("m"), F.lit(False).alias("rest")))
    rest = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda x: F.struct(part.alias("f"), x.alias("m"), F.lit(True).alias("rest")))
    dealt = rows.select("key", "node", "label", "sig", "words", F.explode(F.when(F.col("open"), F.concat(every, rest)).otherwise(every)).alias("to"))
    dealt = dealt.select(F.xxhash64("key", "to.f", "to.m").alias("cell"), "to.rest", "node", "label", "sig", "words").repartition("cell")
    return dealt.sortWithinPartitions("cell", F.col("rest").desc(), "node").mapInArrow(_cell_links, "a long, b long").distinct()


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By cell first the open classes, then the members: a link of each label of theirs to every other one it is similar enough to."""
    cell, rest, done, table = None, [], set(), None
    for batch in batches:
        out = []
        for key, is_rest, node, label, sig, words in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if key != cell:
                cell, rest, done, table = key, [], set(), None
            if is_rest:
                rest.append((node, sig, full_set(words), label))
                continue
            if table is None:
                table = np.frombuffer(b"".join(r[1] for r in rest), np.uint16).reshape(-1, SIGNATURE)
            alike = (table == np.frombuffer(sig, np.uint16)).sum(axis=1) >= LEAST_ESTIMATE * SIGNATURE
            own = None
            for i in np.flatnonzero(alike).tolist():
                # one link joins two labels
                if rest[i][3] != label and (rest[i][3], label) not in done:
                    own = full_set(words) if own is None else own
                    if linked(rest[i][2], own):
                        done.add((rest[i][3], label))
                        out.append((min(node, rest[i][0]), max(node, rest[i][0])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIRS)


def _cell_of(items: np.ndarray) -> np.ndarray:
    return (items % np.uint64(COUNT_CELLS)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n): how many shingles of a task's sets fall on each cell."""
    counts = np.zeros(COUNT_CELLS, np.int64)
    for batch in batches:
        for words in batch.column(0).to_pylist():
            np.add.at(counts, _cell_of(full_set(words)), 1)
    hit = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(counts[hit], pa.int64())], names=["cell", "n"])


_RAREST_SPARK = "node long, label long, size long, tokens binary"


def _rarest(counts: np.ndarray):
    """Maps (node, label, words) to the rarest shingles of each set, the rarest first, one of which any set that it is linked with shares."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens = [], []
            for words in batch.column(2).to_pylist():
                items = full_set(words)
                n = len(items)
                upto = n - -(-LEAST_PERCENT * n // 100) + 1
                sizes.append(n)
                tokens.append(items[np.lexsort((items, counts[_cell_of(items)]))[:upto]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary())], names=["node", "label", "size", "tokens"])

    return rarest


def _mark_of(tokens: np.ndarray, marks: int) -> np.ndarray:
    return ((tokens * _M[1]) >> np.uint64(65 - marks.bit_length())).astype(np.uint32)


def _marked(marks: int):
    """Maps tokens to (block, places): the marks that some sets' tokens fall on, twice if several do."""

    def blocks(held: list[bytes]) -> pa.RecordBatch:
        at, times = np.unique(_mark_of(np.frombuffer(b"".join(held), np.uint64), marks), return_counts=True)
        at = np.repeat(at, np.minimum(times, 2))
        block, starts = np.unique(at // BLOCK_MARKS, return_index=True)
        places = [x.astype(np.uint16).tobytes() for x in np.split(at % BLOCK_MARKS, starts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(places, pa.binary())], names=["block", "places"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for tokens in batch.column(0).to_pylist():
                held.append(tokens)
                size += len(tokens)
                if size >= MARKED_BYTES:
                    yield blocks(held)
                    held, size = [], 0
        if held:
            yield blocks(held)

    return marked


def _hit_twice(rows: pa.Table) -> pa.Table:
    """(block, bits) of one block: a bit for each mark that two sets or more fall on."""
    hits = np.zeros(BLOCK_MARKS, np.int64)
    for places in rows.column("places").to_pylist():
        hits += np.bincount(np.frombuffer(places, np.uint16), minlength=BLOCK_MARKS)
    return pa.table({"block": rows.column("block")[:1], "bits": pa.array([np.packbits(hits > 1).tobytes()], pa.binary())})


_PREFIX_SPARK = "token long, node long, label long, size long, cap long, first boolean"


def _shared(bits: np.ndarray | None):
    """Maps the rarest shingles to a row each, without those whose mark says that no other set has them among its rarest.

    `first` marks those that are enough where the other set is no smaller, and `cap` is the largest
    set that can be linked with this one if the shingle is the first that both have.
    """

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, label, n, tokens in zip(*(batch.column(i).to_pylist() for i in range(4))):
                items = np.frombuffer(tokens, np.uint64)
                of_larger = n - -(-2 * LEAST_PERCENT * n // (100 + LEAST_PERCENT)) + 1
                at = np.arange(len(items))
                if bits is not None:
                    mark = _mark_of(items, 8 * len(bits))
                    at = np.flatnonzero(bits[mark >> 3] >> (7 - (mark & 7)).astype(np.uint8) & 1)
                cap = (100 + LEAST_PERCENT) * (n - at) // LEAST_PERCENT - n
                same = [np.full(len(at), x, np.int64) for x in (node, label, n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (items[at].view(np.int64), *same, cap, at < of_larger)], names=["token", "node", "label", "size", "cap", "first"])

    return shared


def _prefixes(counts: np.ndarray, bits: np.ndarray | None = None):
    """Maps (node, label, words) to a row for each of the rarest shingles, in one step: what `_linkable` does in two, with a table between."""
    return lambda batches: _shared(bits)(_rarest(counts)(batches))


def _repeated_marks(rarest: DataFrame) -> np.ndarray:
    """A bit for each mark that tokens of two sets or more fall on, in at most MARKS bits."""
    total = rarest.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    marks = BLOCK_MARKS
    while marks < min(MARKS, total):  # 8 marks a token
        marks *= 2
    bits = np.zeros((marks // BLOCK_MARKS, BLOCK_MARKS // 8), np.uint8)
    hit = rarest.select("tokens").mapInArrow(_marked(marks), "block long, places binary")
    for block, twice in hit.groupBy("block").applyInArrow(_hit_twice, "block long, bits binary").collect():  # MARKS bits at most
        bits[block] = np.frombuffer(twice, np.uint8)
    return bits.reshape(-1)


def _linkable(members: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """Those rows of large nodes whose class may be linked with a class of another label among them, sizes counted anew.

    Lossless: of a pair that is linked, the first shingle that both sets have lies in the first part
    of the smaller one's prefix and in the larger one's, and each is at most as large as the other's cap there.
    So a shingle that one set alone has in its prefix is not needed; the filter leaves most of these out, and never another one.
    """
    whole = members.select("node", "label").distinct().join(sets.select("node", "words"), "node")
    whole = materialise(whole.select("node", "label", "words"), "whole")
    counts = np.zeros(COUNT_CELLS, np.int64)
    for cell, n in whole.select("words").mapInArrow(_cell_counts, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # COUNT_CELLS rows at most
        counts[cell] = n
    rarest = materialise(whole.mapInArrow(_rarest(counts), _RAREST_SPARK), "rarest")
    # most of the rarest shingles are of one set alone and make no pair, so they don't become rows
    prefixes = materialise(rarest.mapInArrow(_shared(_repeated_marks(rarest)), _PREFIX_SPARK), "prefixes")
    of = {"": F.lit(True), "first_": F.col("first")}
    bounds = [f(F.when(w, F.col(c))).alias(f"{p}{a}") for p, w in of.items() for f, c, a in ((F.min, "label", "low"), (F.max, "label", "high"), (F.min, "size", "least"), (F.max, "cap", "most"))]
    # a shingle in no set's first part, or of one label, makes no pair
    tokens = prefixes.groupBy("token").agg(F.count("*").alias("times"), *bounds).where("low <> high and first_low is not null")
    tokens = materialise(tokens, "tokens")
    total = max(1, prefixes.count())
    joined = attach_groups(prefixes, tokens, "token", "times", total, written=True).where("times is not null")

    def partner(p: str) -> Column:
        other = (F.col(f"{p}low") != F.col("label")) | (F.col(f"{p}high") != F.col("label"))
        return other & (F.col(f"{p}least") <= F.col("cap")) & (F.col(f"{p}most") >= F.col("size"))

    left = materialise(joined.where((F.col("first") & partner("")) | partner("first_")).select("node").distinct(), "linkable", rows)
    rest = materialise(members.drop("size", "unsettled").join(left, "node", "left_semi"), "linkable", rows)
    sizes = rest.groupBy("key").agg(F.count("*").alias("size"), F.count_if("open").alias("unsettled")).where("unsettled > 0")
    counted = attach_groups(rest, materialise(sizes, "sizes", rows), "key", "size", rows, written=True)
    return materialise(counted.where("unsettled is not null").select(members.columns), "large", rows)


def _signed_members(members: DataFrame, sets: DataFrame, rows: int) -> DataFrame:
    """The members of large nodes with their signatures and the keys of their children: a level's one join of the two, as a written table."""
    joined = members.join(sets.select("node", "sig"), "node")
    return materialise(joined.select("key", "node", "label", "size", "sig", F.array(*_children(F.col("key"))).alias("children")), "signed", rows)


def _pivot_links(members: DataFrame, sets: DataFrame, level: int, rows: int) -> DataFrame:
    """Confirmed links between the classes of large nodes (with their signatures) and PIVOTS members of each node that have another label."""
    order = [F.xxhash64("node", F.lit(f"pivot{level}.{i}")) for i in range(PIVOTS)]
    drawn = members.groupBy("key").agg(F.array_distinct(F.array(*(F.min_by(F.struct("node", "label"), o) for o in order))).alias("pivots"), F.first("size").alias("size"))
    pivots = drawn.select("key", "size", F.explode("pivots").alias("of")).select("key", "size", F.col("of.node").alias("p"), F.col("of.label").alias("label_p"))
    pivots = pivots.join(sets.select(F.col("node").alias("p"), F.col("sig").alias("sig_p")), "p")
    pivots = pivots.groupBy("key", "size").agg(F.collect_list(F.struct("p", "label_p", "sig_p")).alias("pivots"))  # PIVOTS of a key
    joined = attach_groups(members.select("key", "node", "label", "sig"), pivots, "key", "size", rows, HOT_SETS)
    joined = joined.select("node", "sig", F.filter("pivots", lambda q: q["label_p"] != F.col("label")).alias("pivots")).where(F.size("pivots") > 0)
    pairs = joined.select("node", F.explode(_like_pivots("sig", "pivots")).alias("p"))
    return _confirmed(pairs.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct(), sets, rows)


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet known to be connected."""
    a = labels.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = labels.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _links(classes: DataFrame, docs: DataFrame, count: int) -> DataFrame:
    """(node, root) of all classes that are linked with another one."""
    spark = classes.sparkSession
    none = spark.createDataFrame([], "a long, b long")
    state = materialise(classes.select("node", F.explode("roots").alias("key"), F.col("node").alias("label")), "state", count * 2 * TREES)
    rows = state.count()
    members = _members(state, rows)
    near = members.groupBy("node").agg((F.max("size") > NODE_ROWS).alias("large"))
    inside = materialise(near.join(classes.select("node", "set_id", "first_doc", "sig"), "node"), "inside", count)
    total = inside.count()
    if not total:
        return none.select(F.col("a").alias("node"), F.col("b").alias("root"))

    # the words of the classes that share a node with another one, from a second reading of the text
    words, cells = member_filter(inside, "first_doc", total)
    first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    wanted = filter_test(docs.select(first.alias("first_doc"), "text"), "first_doc", words, cells).where("__maybe").drop("__maybe")
    wanted = wanted.mapInArrow(_packed, "first_doc long, words binary")
    sets = wanted.join(inside, "first_doc").select("words", "set_id", "node", "sig", "large")
    sets = materialise(sets.mapInArrow(_whole, "node long, sig binary, words binary, large boolean"), "sets")
    if sets.count() != total:  # rows that repeat id and text
        sets = materialise(sets.groupBy("node").agg(*(F.first(c).alias(c) for c in ("sig", "words", "large"))), "sets")
    sets, sets_large = sets.drop("large"), sets.where("large").drop("large")

    # known: an edge of each class to the label of its component, by the links so far
    known, found, small = none, [], []
    for level in range(1, LEVELS + 1):
        small.append(members.where(F.col("size") <= NODE_ROWS))
        large = members.where(F.col("size") > NODE_ROWS)
        rows = large.count()
        if not rows:
            break
        large = _signed_members(large, sets_large, rows)
        labels = components(_union([known, *found, _pivot_links(large, sets_large, level, rows)]), rows=2 * total)
        known, found = labels.select(F.col("node").alias("a"), F.col("root").alias("b")), []
        now = large.select("key", "node", "size", "children").join(labels, "node", "left").select("key", "node", "size", "children", F.coalesce("root", "node").alias("label"))
        now = materialise(now, "labelled", rows)
        shares = now.groupBy("key", "label").agg(F.count("*").alias("n"))
        main = shares.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("many")).withColumn("unsettled", F.col("many") - F.col("main.n")).where("unsettled > 0")
        now = attach_groups(now, materialise(main, "main", rows), "key", "many", rows, written=True).where("unsettled is not null")
        now = materialise(now.select("key", "node", (F.col("label") != F.col("main.label")).alias("open"), "label", "size", "unsettled", "children"), "large", rows)
        last = level == LEVELS
        few, more = now.where(f"unsettled <= {REST_ROWS}"), now.where(f"unsettled > {REST_ROWS}")
        if not more.isEmpty():
            more = _linkable(more, sets_large, rows)
            few, more = few.unionByName(more if last else more.where(f"unsettled <= {REST_ROWS}")), more.where(f"unsettled > {REST_ROWS}")
        if not few.isEmpty():
            found.append(materialise(_rest_links(few, sets_large), "links", rows))
        if last or more.isEmpty():
            break
        branched = more.select("node", "label", F.explode("children").alias("key"))
        state = materialise(branched, "state", 2 * rows)
        rows = state.count()
        members = _members(state, rows)

    pairs = materialise(_exhaustive(_union(small), sets), "pairs", total * NODE_ROWS // 8)
    # first a link to the least neighbour, then what is still not connected
    nearest = pairs.groupBy(F.col("b")).agg(F.min("a").alias("a")).select("a", "b")
    links = _union([known, *found, _confirmed(nearest, sets, total)])
    known = components(links, rows=2 * total)
    rest = _across(pairs.join(nearest, ["a", "b"], "left_anti"), known)
    return components(links.unionByName(_confirmed(rest, sets)), rows=2 * total)


def _labelled(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, set_id and root, one value a component."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    sketches = materialise(rows.mapInArrow(_sketch, _SKETCH_SPARK), "sketches")
    total = max(1, sketches.count())
    known = sketches.where("set_id is not null")
    # a set that no other document has is a class as it stands; only the others shuffle
    tested = filter_test(known, "set_id", *repeat_filter(known, "set_id", total))
    alone = tested.where("not __maybe").select("set_id", F.col("doc_id").alias("least"), F.lit(1).cast("long").alias("size"), "sig", "roots")
    several = tested.where("__maybe").groupBy("set_id").agg(F.min("doc_id").alias("least"), F.count("*").alias("size"), F.first("sig").alias("sig"), F.first("roots").alias("roots"))
    classes = alone.unionByName(several)
    classes = classes.select("set_id", "least", F.coalesce("least", F.lit(-(1 << 63))).alias("first_doc"), "size", "sig", "roots", F.monotonically_increasing_id().alias("node"))
    classes = materialise(classes, "classes")

    roots = materialise(_links(classes, rows, total), "roots", total)
    named = roots.join(classes.select("node", "least"), "node")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    labelled = attach_groups(roots, names, "root", "members", total).select("node", "root", "component_id")
    of_class = classes.join(labelled, "node", "left").select("set_id", "size", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "node").alias("root"))
    joined = attach_groups(known.drop("sig", "roots"), of_class, "set_id", "size", total).select("doc_id", "n_shingles", "component_id", "set_id", "root")
    empty = sketches.where("set_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "set_id", F.lit(None).cast("long").alias("root"))
    return joined.unionByName(empty)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept, set_id."""
    rows = _labelled(docs, doc_id, text).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return rows.select("doc_id", "n_shingles", "component_id", "set_id", "kept")


@F.arrow_udf(BinaryType())
def _set_of(texts: pa.Array) -> pa.Array:
    return pa.array([_set_id(s) if len(s) else None for s in shingle_sets(texts)], pa.binary())


def _surplus(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(gone, set_id, stays, single) of the ids and sets with rows to drop: all of them, or all but one if it stays.

    `single` ids have no other row in the whole table, so the id alone decides.
    """
    rows = materialise(_labelled(docs, doc_id, text).select("doc_id", "set_id", "root"), "labelled")
    known = rows.where("set_id is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "set_id")
    several = known.groupBy("root").agg(F.count("*").alias("rows"), F.min(order).alias("first")).where("rows > 1")
    several = materialise(several, "several")
    within = attach_groups(known, several, "root", "rows", max(1, rows.count()), written=True).where("rows is not null")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("set_id") == F.col("first.set_id"))
    # an id and a set are one class, so all their rows are in one component
    pairs = within.groupBy(F.col("doc_id").alias("gone"), "set_id").agg(F.max(stays).alias("stays"), F.count("*").alias("copies")).where("not stays or copies > 1")
    often = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select(F.col("doc_id").alias("gone"), F.lit(True).alias("often"))
    single = F.col("gone").isNotNull() & F.col("often").isNull()
    return materialise(pairs.join(often, "gone", "left").select("gone", "set_id", "stays", single.alias("single")), "gone")


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one row of each component, with all their columns; rows without shingles all stay."""
    gone = _surplus(docs, doc_id, text)
    words, cells = member_filter(gone, "gone", max(1, gone.count()))
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    tested = filter_test(docs.toDF(*own).withColumn("id", F.col(own[names.index(doc_id)]).cast("long")), "id", words, cells)
    out = tested.where("not __maybe").select(own)
    ids = gone.where("single").select("gone")
    checked = tested.where("__maybe").join(ids, F.col("id") == F.col("gone"), "left_anti").select(*own, "id")
    sets = gone.where("not single").select("gone", F.col("set_id").alias("set"), "stays")
    if not sets.isEmpty():
        of = checked.withColumn("own_set", _set_of(text_or_empty(own[names.index(text)])))
        found = of.join(sets, F.col("id").eqNullSafe(F.col("gone")) & (F.col("own_set") == F.col("set")), "left")
        one = found.where("stays").dropDuplicates(["id", "own_set"])
        checked = found.where("stays is null").unionByName(one)
    return out.unionByName(checked.select(own)).toDF(*names)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("set_id")
