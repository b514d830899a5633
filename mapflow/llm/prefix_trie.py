"""Prefix trie of conversations: which beginnings they share, and the tokens that sharing saves.

A turn is a symbol: a digest of role and text, and its number of words.  A
conversation is a path of symbols.  Equal paths become one with a count before
anything else, so copies cost nothing later.  Paths are range-partitioned in
their order, which makes every partition a prefix shard: nodes under a shard's own
prefixes lie in it alone, and only the nodes on its first and last path can
be shared with others.  A hot prefix is cut over as many shards as it fills.

Each shard is packed into double arrays (``DoubleArray``): symbols get dense ids,
the children of a node lie at ``BASE[node] + id`` with ``CHECK`` naming their
parent.  All paths traverse the arrays together, level by level, and add up their
members; sums over subtrees go back along ``CHECK``.  A shard knows the last path before it
and the first behind it (one row per partition), so it can tell which of its nodes
an earlier shard counts and whether its last path is a leaf.  Aggregates of shared
upper nodes are then merged globally.

Scale: texts are read once and never shuffled; symbols are sorted by conversation
and turn over range partitions, so a long conversation spreads.  Paths are cut into layers of
``SEGMENT`` turns: the trie of a lower layer hangs under the node that its context names, and is built
first; the rounds are the longest conversation's turns by ``SEGMENT``.  Within a partition a trie
holds ``SHARD`` turns and a path at a time.  The digest of the members that end at a node is sequential
by its definition: ids are joined in chunks, which one task streams per node, in constant memory.

Null role or text: empty.  Null turn: before the others; turns of one number: by their digest.  Null
``conv_id``: a conversation of its own, rebuilt without a donor, written as nothing in
``ends_sha256`` and never a node's smallest member beside others.  Empty texts: turns of no words.
Very long texts: one symbol.  Repeated rows: turns like any other.  Empty table: no rows, not
even the root.  Further columns are not read and never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, map_arrow, stored, table
from .turn_repair import crc32_sql

#: Turns of a path in one layer.
SEGMENT = 1 << 14
#: Turns of the paths that one double array holds, beside its last path.
SHARD = 50_000
#: Characters of a symbol: an MD5 and the words in eight hex digits.
WIDTH = 40
NO_CONV = np.iinfo(np.int64).max


# --- one shard -----------------------------------------------------------------

class DoubleArray:
    """A trie over dense symbol ids, as the arrays ``base`` and ``check``.

    ``paths``: sorted, pairwise different lists of ids.  Node 0 is the root.  A child by id ``c`` of node ``s``
    is node ``base[s] + c``, if ``check`` says that its parent is ``s``.
    """

    def __init__(self, paths: list[list[int]]):
        children: list[list[tuple[int, int]]] = [[]]  # by trie node in order of the paths: (id, node)
        before: list[int] = []
        trail = [0]
        for path in paths:
            same = 0
            while same < min(len(path), len(before)) and path[same] == before[same]:
                same += 1
            del trail[same + 1:]
            for c in path[same:]:
                children[trail[-1]].append((c, len(children)))
                trail.append(len(children))
                children.append([])
            before = path
        self._pack(children)

    def _pack(self, children: list[list[tuple[int, int]]]) -> None:
        ids = [sorted(c for c, _ in x) for x in children]
        size = len(children) + max((x[-1] for x in ids if x), default=0) + 1
        taken = np.zeros(size + 1, bool)
        taken[0] = True
        slot, base = np.zeros(len(children), np.int64), np.zeros(len(children), np.int64)
        low = 1  # no free place below
        # Nodes of many children first, while places are free; single children fill the holes.
        for node in sorted((i for i, x in enumerate(ids) if x), key=lambda i: -len(ids[i])):
            while taken[low]:
                low += 1
            apart = np.array(ids[node]) - ids[node][0]
            first = low
            if len(apart) > 1:
                while True:
                    if first + apart[-1] + 256 >= len(taken):
                        taken = np.concatenate([taken, np.zeros(len(taken) + apart[-1] + 256, bool)])
                    fits = ~taken[first + np.arange(256)[:, None] + apart].any(axis=1)
                    if fits.any():
                        first += int(fits.argmax())
                        break
                    first += 256
            base[node] = first - ids[node][0]
            taken[first + apart] = True
            if len(taken) - low < 2:
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            for c, child in children[node]:
                slot[child] = base[node] + c
        self.base = np.zeros(len(taken), np.int64)
        self.check = np.full(len(taken), -1, np.int64)
        self.base[slot] = base
        for node, below in enumerate(children):
            for _, child in below:
                self.check[slot[child]] = slot[node]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Children of ``states`` by ``symbols``; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


@dataclass
class Path:
    """A distinct path of one layer under its context, with what is known of its members."""

    context: str
    symbols: list[str]
    n: int                # members
    conv: int | None      # the smallest of them
    ends: str | None      # digest of those that end with the path
    more: bool            # whether others go on in the next layer
    below: tuple[int, int, int]  # children, leaves and saved words of that layer's trie
    top: int | None       # smallest member of the context's node

    @property
    def key(self) -> list[str]:
        return [self.context, *self.symbols]


def common(a: list[str] | None, b: list[str] | None) -> int:
    """Length of the common beginning."""
    n = 0
    for x, y in zip(a or (), b or ()):
        if x != y:
            break
        n += 1
    return n


def marks(key: list[str], levels: int) -> list[str]:
    """Global names of the first ``levels`` nodes of a path (the first is its context's)."""
    digest, out = hashlib.md5(), []
    for i, s in enumerate(key[:levels]):
        if i:
            digest.update(s.encode())
        out.append(f"{key[0]}:{i}:{digest.copy().hexdigest()}")
    return out


NODES = ("depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends string, mark string, parent_mark string")


def shard_nodes(paths: list[Path], before: list[str] | None, behind: list[str] | None, top_depth: int) -> pa.RecordBatch:
    """The nodes of sorted ``paths``, which ``before`` and ``behind`` are the neighbours of, with aggregates of this shard.

    Shared nodes have a ``mark``, under which they are to be added up; a node that an earlier shard has, too, counts
    no words and is no child here.  Nodes of depth ``top_depth`` are the contexts'.
    """
    dense: dict[str, int] = {}
    ids = [[dense.setdefault(s, len(dense)) for s in p.key] for p in paths]
    words_of = np.array([int(s[32:] or "0", 16) if len(s) == WIDTH else 0 for s in dense], np.int64)
    trie = DoubleArray(ids)
    size = len(trie.check)
    n, conv, level = np.zeros(size, np.int64), np.full(size, NO_CONV), np.zeros(size, np.int64)
    words, top = np.zeros(size, np.int64), np.full(size, NO_CONV)
    length = np.array([len(x) for x in ids])
    start, flat = np.concatenate([[0], np.cumsum(length)]), np.array([c for x in ids for c in x])
    count = np.array([p.n for p in paths], np.int64)
    least, tops = (np.array([NO_CONV if x is None else x for x in y], np.int64) for y in ([p.conv for p in paths], [p.top for p in paths]))
    state, trail = np.zeros(len(paths), np.int64), {0: [], len(paths) - 1: []}
    for at in range(int(length.max())):
        on = np.flatnonzero(length > at)
        symbol = flat[start[on] + at]
        state[on] = trie.step(state[on], symbol)
        here = state[on]
        np.add.at(n, here, count[on])
        np.minimum.at(conv, here, least[on])
        level[here], words[here], top[here] = at + 1, words_of[symbol], tops[on]
        for which in trail:
            if length[which] > at:
                trail[which].append(int(state[which]))
    nodes = np.flatnonzero(level)
    parent = trie.check
    owned = np.ones(size, np.int64)
    owned[trail[0][:common(before, paths[0].key)]] = 0
    mark = np.full(size, None, object)
    for which, other in ((0, before), (len(paths) - 1, behind)):
        same = common(other, paths[which].key)
        mark[trail[which][:same]] = marks(paths[which].key, same)
    for context in dict.fromkeys(p.context for p in paths):
        mark[trie.step(np.zeros(1, np.int64), np.array([dense[context]]))] = marks([context], 1)[0]
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), n * words - owned * words
    inner = nodes[level[nodes] > 1]
    np.add.at(children, parent[inner], owned[inner])
    has_child = np.zeros(size, bool)
    has_child[parent[inner]] = True
    has_child[state[-1]] |= common(behind, paths[-1].key) == len(paths[-1].key)
    ends = np.full(size, None, object)
    for p, s in zip(paths, state):
        ends[s] = p.ends
        children[s] += p.below[0]
        leaves[s] += p.below[1] + (not has_child[s] and not p.more)
        saved[s] += p.below[2]
    by_level = nodes[np.argsort(level[nodes], kind="stable")]
    cuts = np.searchsorted(level[by_level], np.arange(2, int(level.max()) + 2))
    for here in (by_level[a:b] for a, b in zip(cuts[-2::-1], cuts[:0:-1])):
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    under_top = level[parent[nodes]] == 1
    over = np.where(under_top & (top_depth > 0), top[nodes], conv[parent[nodes]])
    over_mark = np.where((level[nodes] == 1) | under_top & (top_depth > 0), None, mark[parent[nodes]])
    unknown = (level[nodes] == 1) | np.array([m is not None for m in over_mark])
    longs = lambda x, null: pa.array(x, pa.int64(), mask=null)
    none = np.zeros(len(nodes), bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(level[nodes] - 1 + top_depth, pa.int32()), longs(conv[nodes], conv[nodes] == NO_CONV),
         longs(over, unknown | (over == NO_CONV)), longs(n[nodes], none), longs(children[nodes], none), longs(leaves[nodes], none),
         longs(saved[nodes], none), pa.array(ends[nodes], pa.string()), pa.array(mark[nodes], pa.string()), pa.array(over_mark, pa.string())],
        [x.split()[0] for x in NODES.split(", ")])


# --- paths ---------------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0) and ``symbol`` of every turn, in the order of its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    symbol = F.concat(F.md5(F.concat_ws(":", F.length(role), role, text)), F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 8, "0"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), symbol.alias("symbol"))
    order = ["conv_id", "turn", "symbol"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "conv_id", "symbol", F.spark_partition_id().alias("pid"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "trie-turns")
    # A conversation's turns in one partition lie side by side.
    per = ranged.groupBy("conv_id", "pid").agg(F.min("pos").alias("low"), F.count("*").alias("n"))
    w = Window.partitionBy("conv_id").orderBy("pid")
    per = per.select(F.col("conv_id").alias("c_"), F.col("pid").alias("p_"), (F.sum("n").over(w) - F.col("n") - F.col("low")).alias("shift"))
    return (ranged.join(per, (ranged.pid == per.p_) & ranged.conv_id.eqNullSafe(per.c_))
            .select("conv_id", (F.col("pos") + F.col("shift")).alias("place"), "symbol"))


def donated(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from its donor, at most."""
    return F.coalesce(F.crc32(conv.cast("string")) % 4, F.lit(0))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``at``, ``symbol`` and the ``length`` of rebuilt conversations; a turnless one has one row without a symbol."""
    firsts = [F.max(F.when(F.col("place") == i, F.col("symbol"))).alias(f"f{i}") for i in range(3)]
    convs = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n"), *firsts), "trie-conversations")
    donor = convs.select(F.col("conv_id").alias("d_"), F.col("n").alias("donor_n"), F.array("f0", "f1", "f2").alias("first"))
    info = (convs.select("conv_id", "n", donated(F.col("conv_id")).alias("h"))
            .join(donor, F.expr("conv_id - conv_id % 20 = d_"), "left")
            .withColumn("given", F.least("h", F.coalesce("donor_n", F.lit(0))))
            .withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    given = info.where("given > 0").select("conv_id", F.posexplode(F.expr("slice(first, 1, cast(given as int))")).alias("at", "symbol"), "length")
    moves = info.select(F.col("conv_id").alias("c_"), "h", "given", "length")
    own = (turns.where(F.col("place") >= donated(F.col("conv_id"))).join(moves, F.col("conv_id").eqNullSafe(F.col("c_")))
           .select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("at"), "symbol", "length"))
    bare = info.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("at"), F.lit(None).cast("string").alias("symbol"), "length")
    return own.unionByName(given.withColumn("at", F.col("at").cast("long"))).unionByName(bare)


def segments(rows: DataFrame, segment: int) -> tuple[DataFrame, int]:
    """Paths of every conversation by layer (``conv_id``, ``layer``, ``context``, ``path``, ``following``, ``last``), and the number of layers.

    ``context`` names the conversation's turns before the layer, ``following`` those up to its end.
    """
    parts = (rows.groupBy("conv_id", F.expr(f"at div {segment}").alias("layer"))
             .agg(F.array_sort(F.collect_list(F.struct("at", "symbol"))).alias("r"), F.max("length").alias("length"))
             .select("conv_id", "layer", F.array_join("r.symbol", "").alias("path"),
                     (F.col("layer") == F.greatest(F.expr(f"(length - 1) div {segment}"), F.lit(0))).alias("last")))
    parts = stored(parts, "trie-segments")
    layers = (parts.agg(F.max("layer")).first()[0] or 0) + 1
    if layers == 1:
        return parts.withColumn("context", F.lit("")).withColumn("following", F.md5(F.md5("path"))), 1
    chain = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("layer", F.md5("path").alias("own")))).alias("r"))
    chain = chain.select(F.col("conv_id").alias("c_"), F.posexplode(F.expr(
        "aggregate(r, array(''), (a, x) -> concat(a, array(md5(concat(element_at(a, -1), x.own)))))")).alias("l_", "context"))
    after = chain.select(F.col("c_").alias("n_"), (F.col("l_") - 1).alias("m_"), F.col("context").alias("following"))
    out = (parts.join(chain, (parts.layer == chain.l_) & parts.conv_id.eqNullSafe(chain.c_))
           .join(after, (parts.layer == after.m_) & parts.conv_id.eqNullSafe(after.n_)))
    return stored(out.drop("c_", "l_", "n_", "m_"), "trie-layers"), layers


def end_digests(members: DataFrame) -> DataFrame:
    """``following`` and ``ends``: the digest of the ids of the members that end there, ascending."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("conv_id"))), lambda x: F.coalesce(x["conv_id"].cast("string"), F.lit(""))), ",")
    chunks = (members.where("last").groupBy("following", F.expr("conv_id - pmod(conv_id, 65536)").alias("chunk")).agg(ids.alias("ids"))
              .repartition("following").sortWithinPartitions("following", F.col("chunk").asc_nulls_first()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        for big in batches:
            done: list[tuple[str, str]] = []
            for name, ids in zip(big.column(0).to_pylist(), big.column(2).to_pylist()):
                if name == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = name, hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["following", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["following", "ends"])

    return map_arrow(chunks, run, "following string, ends string")


# --- all shards ----------------------------------------------------------------

def sharded(paths: DataFrame) -> DataFrame:
    """``paths`` in order over range partitions; each begins with the path before it (``kind`` 0) and ends with the one behind it (2)."""
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(paths.repartitionByRange(n, "context", "path").select(F.spark_partition_id().alias("pid"), F.lit(1).alias("kind"), "*"),
                    "trie-shards")
    key = F.struct("context", "path")
    edges = ranged.groupBy("pid").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    w = Window.orderBy("pid")  # one row per partition
    edges = edges.select("pid", F.lag("high").over(w).alias("before"), F.lead("low").over(w).alias("behind"))
    rest = [F.lit(None).cast(t).alias(c) for c, t in paths.dtypes if c not in ("context", "path")]
    for kind, side in ((0, "before"), (2, "behind")):
        ranged = ranged.unionByName(edges.where(F.col(side).isNotNull()).select("pid", F.lit(kind).alias("kind"), f"{side}.*", *rest))
    return ranged.repartitionByRange(n, "pid").sortWithinPartitions("pid", "kind", "context", "path")


PATH = ("context", "path", "n", "conv", "ends", "more", "below_children", "below_leaves", "below_saved", "top")


def layer_nodes(paths: DataFrame, top_depth: int, shard: int) -> DataFrame:
    """Nodes of one layer's tries as ``NODES`` says, shared ones of several shards not yet merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[str] | None = None
        held: list[Path] = []
        size = 0
        for big in batches:
            for b in (big.slice(at, 1024) for at in range(0, big.num_rows, 1024)):
                for r in b.to_pylist():
                    symbols = [r["path"][i:i + WIDTH] for i in range(0, len(r["path"]), WIDTH)]
                    key = [r["context"], *symbols]
                    if r["kind"] == 0:
                        before = key
                        continue
                    if held and (r["kind"] == 2 or size >= shard):
                        yield shard_nodes(held, before, key, top_depth)
                        before, held, size = held[-1].key, [], 0
                    if r["kind"] == 1:
                        held.append(Path(r["context"], symbols, r["n"], r["conv"], r["ends"], r["more"],
                                         (r["below_children"], r["below_leaves"], r["below_saved"]), r["top"]))
                        size += len(key)
        if held:
            yield shard_nodes(held, before, None, top_depth)

    return map_arrow(sharded(paths.select(*PATH)), run, NODES)


def merged(nodes: DataFrame) -> DataFrame:
    """Nodes with the shared ones added up over shards."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = (nodes.where("mark is not null").groupBy("mark")
              .agg(F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), *sums,
                   F.max("ends").alias("ends"), F.max("parent_mark").alias("parent_mark")))
    return nodes.where("mark is null").unionByName(shared)


def prefix_nodes(conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    members, layers = segments(rebuilt(numbered_turns(conversations)), segment)
    # Equal paths of one context are one path from here on.
    paths = members.groupBy("layer", "context", "following").agg(
        F.first("path").alias("path"), F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    digests = end_digests(members)
    paths = stored(paths.join(digests, "following", "left"), "trie-paths")
    zero = F.lit(0).cast("long")
    below, out = None, None
    for layer in reversed(range(layers)):
        here = paths.where(F.col("layer") == layer)
        if below is None:
            here = here.select("*", F.lit(False).alias("more"), *[zero.alias(f"below_{c}") for c in ("children", "leaves", "saved")])
        else:
            here = here.join(below, "following", "left").select(
                *here.columns, F.col("below_children").isNotNull().alias("more"),
                *[F.coalesce(f"below_{c}", zero).alias(f"below_{c}") for c in ("children", "leaves", "saved")])
        if layer:
            tops = paths.where(F.col("layer") == layer - 1).select(F.col("following").alias("context"), F.col("conv").alias("top"))
            here = here.join(tops, "context")
        else:
            here = here.withColumn("top", F.lit(None).cast("long"))
        nodes = stored(merged(stored(layer_nodes(here, layer * segment, shard), "trie-nodes")), "trie-merged")
        # Marks begin with the context's name.
        roots = nodes.where(F.col("depth") == layer * segment)
        if layer:
            below = roots.select(F.substring_index("mark", ":", 1).alias("following"), F.col("n_children").alias("below_children"),
                                 F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved"))
            nodes = nodes.where(F.col("depth") > layer * segment)
        over = nodes.where("mark is not null").select(F.col("mark").alias("parent_mark"), F.col("conv_id").alias("over"))
        nodes = nodes.join(over, "parent_mark", "left").select(
            "conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("over", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
        out = nodes if out is None else out.unionByName(nodes)
    return out


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(table(spark, sf_dir, "conversations"))


OP11_SQL = f"""
with turns as (
  select conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) as symbol,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words
  from conversations),
own as (
  select conv_id, list({{'s': symbol, 'w': words}} order by turn nulls first, symbol) as path,
         coalesce({crc32_sql("cast(conv_id as varchar)")} % 4, 0) as h
  from turns group by conv_id),
paths as (
  select c.conv_id, list_concat(coalesce(d.path[1:c.h], []), c.path[c.h + 1:]) as path
  from own c left join own d on d.conv_id = c.conv_id - c.conv_id % 20),
members as (
  select conv_id, d, path[1:d] as prefix, len(path) = d as ended from paths, unnest(range(len(path) + 1)) t(d)),
nodes as (
  select d, prefix, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(coalesce(cast(conv_id as varchar), ''), ',' order by conv_id nulls first) filter (where ended), '')) as ends_sha256
  from members group by d, prefix),
linked as (
  select n.*, p.conv_id as parent_conv_id,
         (select count(*) from nodes c where c.d = n.d + 1 and c.prefix[1:n.d] = n.prefix) as n_children
  from nodes n left join nodes p on p.d = n.d - 1 and p.prefix = n.prefix[1:n.d - 1]),
below as (
  select t.k as d, prefix[1:t.k] as prefix, sum(if(n_children = 0, 1, 0)) as n_leaves,
         sum(if(d = 0, 0, (n_convs - 1) * coalesce(prefix[d].w, 0))) as saved_tokens
  from linked, unnest(range(d + 1)) t(k) group by 1, 2)
select l.conv_id, l.d as depth, l.parent_conv_id, l.n_convs, l.n_children, cast(b.n_leaves as bigint) as n_leaves,
       cast(b.saved_tokens as bigint) as saved_tokens, l.ends_sha256
from linked l join below b on b.d = l.d and b.prefix = l.prefix
"""
