"""Similarity join of word n-gram sets by prefix trees, and its connected components.

A text's set holds its distinct ``n``-word shingles, A-Z lower-cased (a shorter text is one shingle; a text
without words has the empty set, linked with nothing).  Two texts link when 100 * |x & y| >= percent * |x | y|.

1. Texts with equal sets are one class, stood for by its smallest id; copies cost nothing from here on.
2. All shingles of the classes are counted over the corpus, by shard; blocks get the counts back as
   logarithmic steps, which, with the hash, order all shingles alike everywhere, rare ones first.
3. In that order, linked sets share one of their first |x| - ceil(percent |x| / 100) + 1 shingles.  Of those, the ones that
   occur once link nothing; a set without others is done.  Each remaining shingle elects the leader of
   the sets that hold it among their first; a set goes to the leaders of its shingles.  Any two linked sets meet
   at a leader, and sets of one family elect few leaders.
4. Where they meet, the sets, ordered by how common a shingle is there, stand in a prefix tree.  A set's
   search walks the tree, adding up the overlap of each shared path once, and leaves a subtree when the
   lengths left cannot reach the threshold any more, or when all of it is in the set's component.
   The sets of a leader with over ``GROUP`` of them are compared with the leader first, in cells that each get a copy of it; only
   those not linked to it (u of m) are then dealt over cells with all of its sets, so that each meets every other in one cell.  A family
   of near copies of its leader costs one comparison each; the worst case, nothing linked to the leader, stays u * m / GROUP copies.
5. The links found span the components; labels then spread along them to the smallest id.

A word has two 64-bit hashes (see Words); a shingle, a sum of the first ones with factors that the run's seed draws; a class of equal sets, 128 bits of
both.  Two documents of 10**4 shingles each count a shared shingle too many with a chance of 6 * 10**-12, which matters only if it lifts them over the
threshold; unlike sets become one class with a chance of 2**-128.

Null ids count as smaller than every other; rows that share an id are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import U64, Words, block_of, blocked, blocks_for, dealt, id_and_text, mix, new_seed, read_table, released, saved, slices, unpacked, window_hash

N, PERCENT, GROUP = 5, 80, 768
TO = pa.list_(pa.struct([("leader", pa.int64()), ("i", pa.int32()), ("j", pa.int32())]))
NO_ID = -(1 << 63)


def _shingle_hashes(hashes: np.ndarray, first: list[int], n: int, seed: int) -> list[np.ndarray]:
    """The hashes of each text's shingles in their order; a shorter text is one shingle."""
    wide, out = window_hash(hashes, n, seed + n), []
    for a, b in zip(first, first[1:]):
        out.append(wide[a : b - n + 1] if b - a >= n else window_hash(hashes[a:b], b - a, seed + b - a) if b > a else wide[:0])
    return out


def shingles(words: Words, n: int = N, seed: int = 0) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    return [np.unique(s) for s in _shingle_hashes(words.hash, words.first.tolist(), n, seed)]


def set_name(s: np.ndarray) -> int:
    """64 bits of a set of hashes, in whatever order."""
    return int(mix(s ^ U64(0x2545F4914F6CDD1D)).sum(dtype=U64).astype(np.int64))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


# --- links within one group ----------------------------------------------------------------------


class _Node:
    __slots__ = ("path", "depth", "children", "ends", "least", "longest", "one")

    def __init__(self, path, depth):
        self.path, self.depth, self.children, self.ends, self.one = path, depth, [], [], None


class PrefixTree:
    """Ordered sets in a tree of shared paths; links sets and keeps their components."""

    def __init__(self, rows: list[np.ndarray], sizes: list[int], percent: int):
        """rows: increasing arrays of small integers (what other sets may share); sizes: of the full sets."""
        self.rows, self.sizes, self.percent = rows, sizes, percent
        self.parent = list(range(len(rows)))
        self.links: list[tuple[int, int]] = []
        self.inside = np.zeros(1 + max((int(r[-1]) for r in rows if len(r)), default=0), dtype=bool)
        order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
        shared = [0]
        for a, b in zip(order, order[1:]):
            x, y = rows[a], rows[b]
            k = min(len(x), len(y))
            d = np.flatnonzero(x[:k] != y[:k])
            shared.append(int(d[0]) if len(d) else k)
        shared = np.array(shared)
        self.root = _Node(np.zeros(0, dtype=np.int64), 0)
        todo = [(self.root, 0, len(order), 0)]
        made = []
        while todo:
            node, lo, hi, depth = todo.pop()
            made.append(node)
            while lo < hi and len(rows[order[lo]]) == depth:
                node.ends.append(order[lo])
                lo += 1
            cuts = [lo, *(lo + 1 + np.flatnonzero(shared[lo + 1 : hi] <= depth)).tolist(), hi] if lo < hi else []
            for a, b in zip(cuts, cuts[1:]):
                row = rows[order[a]]
                end = int(shared[a + 1 : b].min()) if b - a > 1 else len(row)
                child = _Node(row[depth:end], end)
                node.children.append(child)
                todo.append((child, a, b, end))
        for node in reversed(made):
            node.least = min([sizes[i] for i in node.ends] + [c.least for c in node.children], default=0)
            node.longest = max([len(rows[i]) for i in node.ends] + [c.longest for c in node.children], default=0)

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def _same(self, node: _Node) -> int | None:
        """The component of all sets of a subtree, if known to be one; it stays one."""
        if node.one is not None:
            return self.find(node.one)
        roots = {self.find(i) for i in node.ends}
        for c in node.children:
            if c.one is None or len(roots) > 1:
                return None
            roots.add(self.find(c.one))
        if len(roots) == 1:
            node.one = roots.pop()
            return node.one
        return None

    def search(self, x: int) -> None:
        """Link set x with every set in reach of another component."""
        row, size, p = self.rows[x], self.sizes[x], self.percent
        inside = self.inside
        inside[row] = True
        stack = [(self.root, 0, False)]
        while stack:
            node, overlap, done = stack.pop()
            if done:
                self._same(node)
                continue
            one = self._same(node)
            if one is not None and one == self.find(x):
                continue
            overlap += int(np.count_nonzero(inside[node.path]))
            if len(node.path):
                left = len(row) - int(np.searchsorted(row, node.path[-1], side="right"))
                reach = overlap + min(left, node.longest - node.depth)
                if (100 + p) * reach < p * (size + node.least):
                    continue
            for y in node.ends:
                if y != x and (100 + p) * overlap >= p * (size + self.sizes[y]) and self.find(y) != self.find(x):
                    self.parent[self.find(y)] = self.find(x)
                    self.links.append((x, y))
            if node.children or node.one is None:
                stack.append((node, 0, True))
            stack += [(c, overlap, False) for c in node.children]
        inside[row] = False


def link_sets(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of indices that span the components of all links between the sets (arrays of distinct hashes)."""
    alive = [i for i, s in enumerate(sets) if len(s)]
    while len(alive) > 1:
        flat = np.concatenate([sets[i] for i in alive])
        sizes = np.array([len(sets[i]) for i in alive])
        _, local, counts = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(alive)), sizes)
        some = counts[local] > 1
        usable = np.bincount(owner[some], minlength=len(alive))
        fine = 100 * usable >= percent * sizes
        if fine.all():
            break
        alive = [i for i, f in zip(alive, fine) if f]
    if len(alive) < 2:
        return []
    place = np.empty(len(counts), dtype=np.int64)
    place[np.lexsort((np.arange(len(counts)), -counts))] = np.arange(len(counts))
    ranked, ends = place[local[some]], np.cumsum(usable)
    rows = [np.sort(ranked[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    tree = PrefixTree(rows, sizes.tolist(), percent)
    for x in range(len(rows)):
        tree.search(x)
    return [(alive[x], alive[y]) for x, y in tree.links]


# --- steps ---------------------------------------------------------------------------------------


def links_of(table: pa.Table, percent: int = PERCENT) -> pa.Table:
    """Links (a, b) that span the components of a cell's sets (id, set), the same in whatever order the rows come."""
    table = table.sort_by("id")
    ids = table.column("id").to_pylist()
    links = link_sets([np.frombuffer(x.as_py(), "<u8") for x in table.column("set")], percent)
    return pa.table([pa.array([ids[x] for x, _ in links], pa.int64()), pa.array([ids[y] for _, y in links], pa.int64())], names=["a", "b"])


def with_leader(table: pa.Table, leader: int, percent: int = PERCENT) -> pa.Table:
    """(a, b, far): each set of a cell (id, set) beside its leader, which is in the cell too, and whether they are not linked."""
    ids, sets = table.column("id").to_pylist(), [np.frombuffer(x.as_py(), "<u8") for x in table.column("set")]
    top, others, far = sets[ids.index(leader)], [], []
    for i, s in zip(ids, sets):
        if i != leader:
            at = np.minimum(np.searchsorted(top, s), len(top) - 1)
            both = int(np.count_nonzero(top[at] == s))
            others.append(i)
            far.append(100 * both < percent * (len(s) + len(top) - both))
    return pa.table([pa.array(others, pa.int64()), pa.array([leader] * len(others), pa.int64()), pa.array(far, pa.bool_())], names=["a", "b", "far"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of the edges (a, b) reaches."""
    edges = saved(edges.select("a", "b"))  # read twice below: computed twice, links of one component may differ
    both = saved(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = saved(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        near = both.join(label, both.b == label.id).groupBy(F.col("a").alias("n")).agg(F.min("component").alias("m"))
        step = label.join(near, label.id == near.n).select("id", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        far = label.select(F.col("id").alias("j"), F.col("component").alias("jump"))
        new = step.join(far, step.c == far.j, "left").select("id", "old", F.least("c", F.coalesce("jump", "c")).alias("component"))
        new = saved(new)
        if new.where("component <> old").isEmpty():
            return new.select("id", "component")
        label = new.select("id", "component")


def _hashed(texts: pa.Array, n: int, seed: int) -> list[pa.Array]:
    """size, h1, h2 of each text's set; the halves come from the two hashes of its words, by independent sums."""
    words = Words(texts, lower=True, seed=seed)
    first = words.first.tolist()
    rows = []
    for one, two in zip(_shingle_hashes(words.hash, first, n, seed), _shingle_hashes(words.check, first, n, seed + 64)):
        own, at = np.unique(one, return_index=True)
        rows.append((len(own), set_name(own), set_name(two[at])))
    return [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]


def with_class(docs: DataFrame, n: int = N, seed: int = 0) -> DataFrame:
    """docs (text and other columns) with size, h1, h2: the class of the text."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=2 << 20):
                texts = part.column(part.schema.get_field_index("text"))
                yield pa.RecordBatch.from_arrays([*part.columns, *_hashed(texts, n, seed)], names=[*part.schema.names, "size", "h1", "h2"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in ("size", "h1", "h2"))]))


def classes(docs: DataFrame, n: int = N, seed: int = 0) -> DataFrame:
    """doc_id, b, size of its set, and two 64-bit hashes of the set, for docs (doc_id, text, b)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=2 << 20):
                yield pa.record_batch([part.column(0), part.column(2), *_hashed(part.column(1), n, seed)], names=["doc_id", "b", "size", "h1", "h2"])

    return docs.mapInArrow(run, "doc_id long, b int, size long, h1 long, h2 long")


class _Block:
    """The sets of a block's documents that stand for a class, in a fixed order."""

    def __init__(self, table: pa.Table, chosen: np.ndarray, hashes: np.ndarray, n: int, shards: int, seed: int):
        docs = unpacked(table)
        ids = np.array([NO_ID if i is None else i for i in docs.column("doc_id").to_pylist()], dtype=np.int64)
        alone = np.ones(len(ids), dtype=bool)
        same = ids[1:] == ids[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        alone &= ids != NO_ID
        keep = ~alone | np.isin(ids, chosen)
        docs, ids, alone = docs.filter(pa.array(keep)), ids[keep], alone[keep]
        sets = shingles(Words(docs.column("text"), lower=True, seed=seed), n, seed) if len(ids) else []
        if not alone.all():  # rows that share an id: one for each class among them that is asked for
            names, pick = dict(zip(hashes.tolist(), chosen.tolist())), np.ones(len(ids), dtype=bool)
            for k in np.flatnonzero(~alone).tolist():
                name = names.pop(set_name(sets[k]), None)
                pick[k] = name is not None
                ids[k] = ids[k] if name is None else name
            ids, sets = ids[pick], [s for s, p in zip(sets, pick) if p]
        self.ids, self.sets = ids, sets
        self.flat = np.concatenate([np.zeros(0, dtype=U64), *self.sets])
        self.shards = dealt((self.flat >> U64(32)) % U64(shards))

    def ordered(self, answers):
        """(id, set with rare shingles first, their steps) of each document."""
        step = np.zeros(len(self.flat), dtype=np.uint8)
        for k, raw in answers:
            step[self.shards[k]] = np.frombuffer(raw, np.uint8)
        i = 0
        for d, s in zip(self.ids.tolist(), self.sets):
            c = step[i : i + len(s)]
            order = np.argsort(c, kind="stable")  # equal steps stay ordered by hash
            yield d, s[order], c[order]
            i += len(s)


def similar(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    own, named = grouped(docs, n, percent, id_col, text_col, blocks, group, new_seed())
    out = own.join(named.drop("c"), ["size", "h1", "h2"], "left")
    back = lambda c: F.when(c == NO_ID, F.lit(None)).otherwise(c).cast("long")
    return out.select(back(F.col("doc_id")).alias("doc_id"), F.col("size").alias("n_shingles"), back(F.coalesce("component_id", "doc_id")).alias("component_id"))


def grouped(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None, group: int = GROUP, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The class (size, h1, h2) of every row (doc_id: NO_ID for null), and component_id of every class that has words; c tells components of one id apart."""
    blocks = blocks or max(8, blocks_for(docs, 3 << 20))
    docs = id_and_text(docs, id_col, text_col)
    shards = max(8, blocks)
    order = F.coalesce(F.col("doc_id"), F.lit(NO_ID))

    own = saved(classes(docs.withColumn("b", block_of(blocks)), n, seed).withColumn("doc_id", order))
    reps = own.where("size > 0").groupBy("size", "h1", "h2").agg(F.min(F.struct("doc_id", "b")).alias("r")).select("size", "h1", "h2", "r.*")
    shared_ids = F.count("*").over(Window.partitionBy("doc_id", F.when(F.col("doc_id") == NO_ID, F.col("h1")))) > 1
    hashed = F.when(F.col("h1") < 0, F.col("h1")).otherwise(F.col("h1").bitwiseOR(F.lit(NO_ID)))
    reps = saved(reps.select("size", "h1", "h2", "b", F.col("doc_id").alias("least"), F.when((F.col("doc_id") == NO_ID) | shared_ids, hashed).otherwise(F.col("doc_id")).alias("rep")))
    chosen = reps.select("b", "rep", "h1")
    held = blocked(docs, blocks)
    by_block = held.groupBy("b")

    def ids_of(table, name="rep"):
        return [np.asarray(table.column(c).combine_chunks(), dtype=np.int64) if table.num_rows else np.zeros(0, np.int64) for c in (name, "h1")]

    def rests(key, table, told):
        rows = []
        if table.num_rows:
            block = _Block(table, *ids_of(told), n, shards, seed)
            rows = [(k, block.flat[at].astype("<u4").tobytes()) for k, at in block.shards.items()]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["b", "shard", "rest"])

    def counted(key, table):
        parts = [np.frombuffer(x.as_py(), "<u4") for x in table.column("rest")]
        _, at, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        step = np.where(count == 1, 0, np.minimum(255, 1 + np.floor(6 * np.log2(count)))).astype(np.uint8)[at]
        ends = np.cumsum([len(p) for p in parts])
        out = [step[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        return pa.table([table.column("b"), table.column("shard"), pa.array(out, pa.binary())], names=["b", "shard", "steps"])

    counts = by_block.cogroup(chosen.groupBy("b")).applyInArrow(released(rests), "b int, shard int, rest binary")
    counts = counts.groupBy("shard").applyInArrow(released(counted), "b int, shard int, steps binary")
    none = F.lit(None)
    told = saved(counts.select("b", "shard", "steps", none.cast("long").alias("rep"), none.cast("long").alias("h1")).unionByName(chosen.select("b", none.cast("int").alias("shard"), none.cast("binary").alias("steps"), "rep", "h1")))

    def opened(table, told):
        rep = told.filter(pc_valid(told, "rep"))
        steps = told.filter(pc_valid(told, "steps"))
        block = _Block(table, *ids_of(rep), n, shards, seed)
        return block.ordered(zip(steps.column("shard").to_pylist(), steps.column("steps").to_pylist()))

    def first(key, table, told):
        d, t = [], []
        if table.num_rows:
            for i, s, c in opened(table, told):
                k = prefix_length(len(s), percent)
                shared = s[:k][c[:k] > 0]
                d.append(np.full(len(shared), i))
                t.append(shared.astype(np.int64))
        cat = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
        return pa.table([pa.array(cat(d)), pa.array(cat(t))], names=["id", "token"])

    firsts = by_block.cogroup(told.groupBy("b")).applyInArrow(released(first), "id long, token long")
    firsts = saved(firsts)
    lead = firsts.groupBy("token").agg(F.min(F.struct(F.xxhash64("id").alias("h"), F.col("id"))).getField("id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    meets = saved(firsts.join(lead, "token").select("id", "leader").distinct())
    sizes = meets.groupBy("leader").agg(F.count("*").alias("n")).where("n > 1")
    meets = meets.join(sizes, "leader")
    many = F.col("n") > group
    dealt_to = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(n / group).cast("int")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.ceil(n / group).cast("int") - 1)

    def sets_of(key, table, told):
        if not (table.num_rows and told.num_rows):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], TO)], names=["id", "set", "to"])
        place = {i: k for k, i in enumerate(told.column("id").to_pylist())}
        block = _Block(table, *ids_of(told, "id"), n, shards, seed)
        to = told.column("to").combine_chunks().take(pa.array([place[i] for i in block.ids.tolist()], pa.int64())).cast(TO)
        return pa.table([pa.array(block.ids), pa.array([s.tobytes() for s in block.sets], pa.binary()), to], names=["id", "set", "to"])

    def met(to: DataFrame):
        """The sets at the cells (leader, i, j) that to (id, leader, i, j) names; the JVM makes the copies, one by one."""
        going = to.groupBy("id").agg(F.collect_list(F.struct("leader", "i", "j")).alias("to"))
        going = going.join(chosen, going.id == chosen.rep).select("b", "id", "h1", "to")
        sets = by_block.cogroup(going.groupBy("b")).applyInArrow(released(sets_of), "id long, set binary, to array<struct<leader: bigint, i: int, j: int>>")
        return sets.select("id", "set", F.explode("to").alias("at")).select("at.leader", "at.i", "at.j", "id", "set").groupBy("leader", "i", "j")

    def linked(key, table):
        leader, i = key[0].as_py(), key[1].as_py()
        out = with_leader(table, leader, percent) if i < 0 else links_of(table, percent)
        return out if i < 0 else out.append_column("far", pa.array([False] * out.num_rows, pa.bool_()))

    few = meets.where(~many).select("id", "leader", F.lit(0).alias("i"), F.lit(0).alias("j"))
    star = F.when(F.col("id") == F.col("leader"), every(F.col("n"))).otherwise(F.array(dealt_to(3, F.col("n"))))
    first_cells = few.unionByName(meets.where(many).select("id", "leader", F.lit(-1).alias("i"), F.explode(star).alias("j")))
    links = saved(met(first_cells).applyInArrow(linked, "a long, b long, far boolean"))
    edges, far = links.where("not far").select("a", "b"), links.where("far").select(F.col("a").alias("id"), F.col("b").alias("leader"))
    if not far.isEmpty():
        outer = far.groupBy("leader").agg(F.count("*").alias("u"))
        rest = meets.where(many).join(outer, "leader").join(far.withColumn("out", F.lit(True)), ["leader", "id"], "left")
        cell = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
        i, j = dealt_to(5, F.col("u")), dealt_to(3, F.col("n"))
        as_any, as_outer = F.transform(every(F.col("u")), lambda x: cell(x, j)), F.transform(every(F.col("n")), lambda x: cell(i, x))
        rest = rest.select("id", "leader", F.explode(F.when(F.col("out"), F.array_union(as_any, as_outer)).otherwise(as_any)).alias("cell"))
        edges = edges.unionByName(met(rest.select("id", "leader", "cell.i", "cell.j")).applyInArrow(linked, "a long, b long, far boolean").select("a", "b"))

    found = components(edges)
    named = reps.join(found, reps.rep == found.id, "left").select("size", "h1", "h2", "least", F.coalesce("component", "rep").alias("c"))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    return own, named.join(least, "c").select("size", "h1", "h2", "component_id", "c")


def pc_valid(table: pa.Table, column: str) -> pa.ChunkedArray:
    return table.column(column).is_valid()


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(read_table(spark, sf_dir, "documents"))
