"""Conversation repair: the cheapest edits that bring turns into a legal order, by weighted interval parsing.

A conversation's rows become tokens: the first letter of the role (system, user,
assistant or another), whether the text is cut off, or that the row must go (blank, or
role and text seen before).  Legal orders are ``(s?(ua)+)?``, written as a grammar
in Chomsky normal form whose symbols say how a span's output begins and ends:
``E`` nothing, ``UU UA AU AA`` alternating turns, ``S`` a system turn, ``SU SA`` a system
turn and what follows.  ``RULES`` lists the pairs of symbols that join.  A cell holds
the least (cost, audit) of one symbol over one span; audit is the string of edits, K
keep, R rerole, D delete, I insert.

A row's cells are those of its own edits, closed under insertions before and after
(``leaf``).  ``chart`` then fills all spans of up to ``FAN`` neighbours bottom-up by
length, over all splits.  Longer stretches are built of such charts, bottom-up again: charts
of rows, of their results, and so on.  That loses nothing: edits of a span are edits
of its two halves wherever it is cut, and of two audits of one span and one cost
none is the other's beginning (what follows would be insertions, which cost), so the
least audits of the halves make the least audit of the whole.

Scale: rows are sorted by conversation and turn over range partitions, so a
conversation of any length spreads; ``BLOCK`` neighbours at most meet in one group,
blocks of long conversations in further rounds (their number grows with the logarithm
of the longest), and chosen symbols go back down the same way.  First sights of
a text come from a pre-aggregated minimum.  The digest of a repaired conversation is
sequential by its definition: a task streams a conversation's rows in order, in constant
memory.  Only ``audit`` itself, one letter a row, is whole in a task.

Null role or text: one space.  Null turn: before the others; null ``conv_id``: a conversation of
its own, written as a space in the key of the damage.  Rows of one turn: by role, then text.  An empty
role has no first letter and cannot be kept, like a role of another letter.  Empty text: blank.
Very long texts only pass through.  Repeated rows: every one after the first is a duplicate.  Ties of cost: the audit least in ASCII.
Conversations of which no row is left: zeros, an empty audit, the digest of nothing.
Empty table: no rows.  Further columns are not read and never clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, map_arrow, stored, table

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Spans that one chart is filled over, and rows (or blocks) that one group collects.
FAN, BLOCK = 8, 512

_JOINS = ("UU AA UA", "UU AU UU", "UA UA UA", "UA UU UU", "AU AU AU", "AU AA AA", "AA UA AA", "AA UU AU",
          "S UU SU", "S UA SA", "SU AA SA", "SU AU SU", "SA UA SA", "SA UU SU")
SYMBOLS = ("E", "UU", "UA", "AU", "AA", "S", "SU", "SA")
#: (left symbol, right symbol) -> symbol.
RULES = {(a, b): c for a, b, c in map(str.split, _JOINS)} | {("E", x): x for x in SYMBOLS} | {(x, "E"): x for x in SYMBOLS}
#: Symbols of a whole legal conversation.
WHOLE = ("E", "UA", "SA")
LEGAL_PAIRS = ("su", "ua", "au")


@dataclass(frozen=True)
class Cell:
    cost: int
    audit: str
    #: (left span, its symbol, right span, its symbol) of the best split; none in a leaf.
    split: tuple | None = None


Span = dict[str, Cell]


def offer(span: Span, symbol: str, cost: int, left: str, right: str, split: tuple | None) -> bool:
    """Puts the audit ``left + right`` into the span's cell if it is better than what is there."""
    old = span.get(symbol)
    if old is not None and (cost > old.cost or cost == old.cost and left + right >= old.audit):
        return False
    span[symbol] = Cell(cost, left + right, split)
    return True


@lru_cache(maxsize=64)
def leaf(token: str) -> Span:
    """Cells of one row: its edits, and any insertions beside it.

    ``token``: x must go; s, u, a or o (another role), in capitals if the text is cut off.
    """
    span: Span = {}
    offer(span, "E", DELETE, "D", "", None)
    if token != "x":
        extra, kind = CUT_OFF if token.isupper() else 0, token.lower()
        if kind != "o":
            offer(span, {"s": "S", "u": "UU", "a": "AA"}[kind], KEEP + extra, "K", "", None)
        for symbol in ("UU", "AA"):
            offer(span, symbol, REROLE + extra, "R", "", None)
    better = True
    while better:
        better = False
        for symbol, cell in list(span.items()):
            for added in ("UU", "AA"):
                if to := RULES.get((symbol, added)):
                    better |= offer(span, to, cell.cost + INSERT, cell.audit, "I", None)
                if to := RULES.get((added, symbol)):
                    better |= offer(span, to, cell.cost + INSERT, "I", cell.audit, None)
    return span


def chart(leaves: Sequence[Span]) -> Span:
    """Cells of the whole of ``leaves``: all spans, bottom-up by length, over all their splits."""
    n = len(leaves)
    spans = {(i, i + 1): s for i, s in enumerate(leaves)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            here: Span = {}
            for k in range(i + 1, i + length):
                left, right = spans[i, k], spans[k, i + length]
                for a, x in left.items():
                    for b, y in right.items():
                        if to := RULES.get((a, b)):
                            offer(here, to, x.cost + y.cost, x.audit, y.audit, (left, a, right, b))
            spans[i, i + length] = here
    return spans[0, n]


@lru_cache(maxsize=20_000)
def short(tokens: str) -> Span:
    """Cells of a few rows, without the way they came about (which would keep the whole chart in memory)."""
    return {s: Cell(c.cost, c.audit) for s, c in chart([leaf(t) for t in tokens]).items()}


def parse(spans: Sequence[Span]) -> Span:
    """Cells of a row of spans of any number: charts of ``FAN`` neighbours, again and again."""
    while len(spans) > 1:
        spans = [chart(spans[at:at + FAN]) for at in range(0, len(spans), FAN)]
    return spans[0]


def parse_tokens(tokens: str) -> Span:
    return parse([short(tokens[at:at + FAN]) for at in range(0, len(tokens), FAN)])


def best_symbol(span: Span) -> str:
    """The symbol of the cheapest legal whole."""
    return min((s for s in WHOLE if s in span), key=lambda s: (span[s].cost, span[s].audit))


def chosen(span: Span, symbol: str, parts: Sequence[Span]) -> list[str]:
    """The symbols of ``parts``, the spans that ``span`` was parsed from, in its best parse as ``symbol``."""
    place, out = {id(p): i for i, p in enumerate(parts)}, [""] * len(parts)
    open_ = [(span, symbol)]
    while open_:
        s, x = open_.pop()
        if id(s) in place:
            out[place[id(s)]] = x
        else:
            left, a, right, b = s[x].split
            open_ += [(left, a), (right, b)]
    return out


def dump(span: Span) -> str:
    return json.dumps({s: [c.cost, c.audit] for s, c in span.items()})


def load(text: str) -> Span:
    return {s: Cell(*c) for s, c in json.loads(text).items()}


# --- rows ----------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after the damage that a checksum of conversation and turn asks for."""
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("what", F.crc32(key) % 20).where("what <> 0")
    return (rows.withColumn("text", F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", ""))
                            .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("what") == 4, "user").otherwise(F.col("role")))
            .withColumn("again", F.explode(F.array_repeat(F.lit(0), F.when(F.col("what") == 3, 2).otherwise(1))))
            .select("conv_id", "turn", "role", "text"))


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` sorted by conversation, turn, role and text over range partitions, with partition ``pid`` and place ``pos``; stored."""
    order = ["conv_id", "turn", "role", "text"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stored(ranged.select("*", F.spark_partition_id().alias("pid"),
                                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "turns-ordered")


def tokens(ordered: DataFrame) -> DataFrame:
    """One row per row: place, turn, first letter of the role, fault and token; without texts."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = ordered.select("conv_id", "pid", "pos", "turn", F.substring("role", 1, 1).alias("initial"),
                            (bare == "").alias("blank"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("ended"),
                            F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("said"))
    first = (narrow.groupBy("conv_id", "said").agg(F.min(F.struct("pid", "pos")).alias("at"))
             .select(F.col("at.pid").alias("pid"), F.col("at.pos").alias("pos"), F.lit(True).alias("first")))
    fault = F.expr("case when blank then 'blank' when first is null then 'duplicate' when not ended then 'truncated' end")
    kind = F.expr("case when initial in ('s', 'u', 'a') then initial else 'o' end")
    return (narrow.join(first, ["pid", "pos"], "left").withColumn("fault", fault)
            .withColumn("token", F.when(F.col("fault").isin("blank", "duplicate"), "x")
                        .when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind))
            .select("conv_id", "pid", "pos", "turn", "initial", "fault", "token"))


def counts(marked: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation; sums by turn first, so a long one is pre-aggregated."""
    faults = ("blank", "duplicate", "truncated")
    by_turn = marked.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in faults])
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(f).alias(f) for f in faults])


def blocks(marked: DataFrame, block: int) -> DataFrame:
    """Parsed blocks of at most ``block`` neighbours: ``conv_id``, ``pid``, ``blk``, ``cells``, ``opens``, ``ends``, ``illegal``."""
    rows = (marked.groupBy("conv_id", "pid", F.expr(f"pos div {block}").alias("blk"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "token", "initial"))).alias("r"))
            .select("conv_id", "pid", "blk", F.array_join("r.token", "").alias("tokens"), F.col("r.initial").alias("initials")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, opens, ends, illegal = [], [], [], []
            for t, marks in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                cells.append(dump(parse_tokens(t)))
                opens.append(marks[0])
                ends.append(marks[-1])
                illegal.append(sum(x + y not in LEGAL_PAIRS for x, y in zip(marks, marks[1:])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(cells, pa.string()), pa.array(opens, pa.string()),
                                              pa.array(ends, pa.string()), pa.array(illegal, pa.int64())], SPAN_NAMES)

    return map_arrow(rows, run, SPAN)


SPAN = "conv_id long, pid int, blk long, cells string, opens string, ends string, illegal long"
SPAN_NAMES = [x.split()[0] for x in SPAN.split(", ")]


def numbered(spans: DataFrame) -> DataFrame:
    """Blocks with ``at``, their number in the conversation, and ``of``, the conversation's number of blocks.

    A conversation's blocks in one partition are numbered without a gap (``blk`` counts on), so the
    window sees one row per conversation and partition.
    """
    per = spans.groupBy("conv_id", "pid").agg(F.min("blk").alias("low"), F.count("*").alias("n"))
    w = Window.partitionBy("conv_id").orderBy("pid")
    per = per.select(F.col("conv_id").alias("c_"), F.col("pid").alias("p_"), "low",
                     (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("conv_id")).alias("of"))
    return (spans.join(per, (spans.pid == per.p_) & spans.conv_id.eqNullSafe(per.c_))
            .withColumn("at", F.col("blk") - F.col("low") + F.col("before")).drop("c_", "p_", "low", "before"))


def grouped(spans: DataFrame, block: int) -> DataFrame:
    """Neighbouring spans, ``block`` at most, as lists in order: ``conv_id``, ``up`` (the group's number), ``r``."""
    return (spans.groupBy("conv_id", F.expr(f"at div {block}").alias("up"))
            .agg(F.array_sort(F.collect_list(F.struct("at", "cells", "opens", "ends", "illegal"))).alias("r")))


def raised(spans: DataFrame, block: int) -> DataFrame:
    """Spans of the next level: ``conv_id``, ``at``, ``cells``, ``opens``, ``ends``, ``illegal``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv, up, r in zip(*(b.column(i).to_pylist() for i in range(3))):
                whole = dump(parse([load(x["cells"]) for x in r]))
                between = sum(x["ends"] + y["opens"] not in LEGAL_PAIRS for x, y in zip(r, r[1:]))
                yield pa.RecordBatch.from_pylist([dict(conv_id=conv, at=up, cells=whole, opens=r[0]["opens"], ends=r[-1]["ends"],
                                                       illegal=between + sum(x["illegal"] for x in r))], schema=RAISED)

    return map_arrow(grouped(spans, block), run, "conv_id long, at long, cells string, opens string, ends string, illegal long")


RAISED = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("cells", pa.string()), ("opens", pa.string()), ("ends", pa.string()),
                    ("illegal", pa.int64())])


def lowered(spans: DataFrame, symbols: DataFrame, block: int) -> DataFrame:
    """``conv_id``, ``at`` and ``symbol`` of the spans that groups with a chosen ``symbol`` (``conv_id``, ``at``) are made of."""
    up = symbols.withColumnsRenamed({"conv_id": "c_", "at": "a_"})
    groups = grouped(spans, block)
    groups = groups.join(up, (groups.up == up.a_) & groups.conv_id.eqNullSafe(up.c_)).select("conv_id", "up", "symbol", "r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv, symbol, r in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                parts = [load(x["cells"]) for x in r]
                names = chosen(parse(parts), symbol, parts)
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(r), pa.int64()), pa.array([x["at"] for x in r], pa.int64()),
                                                  pa.array(names, pa.string())], ["conv_id", "at", "symbol"])

    return map_arrow(groups, run, "conv_id long, at long, symbol string")


def settled(roots: DataFrame) -> DataFrame:
    """``conv_id``, ``symbol``, ``cost``, ``audit``, ``illegal`` of whole conversations' spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [load(x) for x in b.column(1).to_pylist()]
            names = [best_symbol(s) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array([s[x].cost for s, x in zip(spans, names)], pa.int64()),
                 pa.array([s[x].audit for s, x in zip(spans, names)], pa.string()), b.column(2)],
                ["conv_id", "symbol", "cost", "audit", "illegal"])

    return map_arrow(roots.select("conv_id", "cells", "illegal"), run,
                     "conv_id long, symbol string, cost long, audit string, illegal long")


def audits_of(spans: DataFrame, symbols: DataFrame) -> DataFrame:
    """``conv_id``, ``pid``, ``blk`` and ``audit`` of blocks whose symbol is chosen."""
    low = symbols.withColumnsRenamed({"conv_id": "c_", "at": "a_"})
    rows = spans.join(low, (spans["at"] == low.a_) & spans.conv_id.eqNullSafe(low.c_))
    cell = F.from_json("cells", "map<string, array<string>>")[F.col("symbol")]
    return rows.select("conv_id", "pid", "blk", cell[1].alias("audit"))


def repair(rows: DataFrame, originals: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults and cheapest repair of every conversation in ``originals`` (column ``conv_id``), from its ``rows``.

    ``rows``: ``conv_id``, ``turn``, ``role``, ``text`` without nulls in the last two.  See ``repaired_lines`` for the repaired turns.
    """
    heads, audits, ordered = _parsed(rows, originals, block)
    return _digests(heads, audits, ordered, block)


def _parsed(rows: DataFrame, originals: DataFrame, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    ordered = in_order(rows)
    marked = stored(tokens(ordered), "turns-marked")
    spans = stored(numbered(blocks(marked, block)), "turns-spans")
    single, long_ = spans.where("of = 1"), spans.where("of > 1")
    levels = [long_]
    roots, audits = single.select("conv_id", "cells", "illegal"), None
    longest = spans.agg(F.max("of")).first()[0] or 0
    while longest > 1:
        longest = -(-longest // block)
        levels.append(stored(raised(levels[-1], block), "turns-raised"))
    if len(levels) > 1:
        roots = roots.unionByName(levels[-1].select("conv_id", "cells", "illegal"))
    whole = stored(settled(roots), "turns-settled")
    audits = single.select("conv_id", "pid", "blk").join(
        whole.select(F.col("conv_id").alias("c_"), "audit"), F.col("conv_id").eqNullSafe(F.col("c_"))).select("conv_id", "pid", "blk", "audit")
    if len(levels) > 1:
        symbols = levels[-1].select("conv_id", "at").join(whole.select(F.col("conv_id").alias("c_"), "symbol"),
                                                          F.col("conv_id").eqNullSafe(F.col("c_"))).drop("c_")
        for below in levels[-2::-1]:
            symbols = lowered(below, symbols, block)
        audits = audits.unionByName(audits_of(long_, symbols))
    every = originals.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    tally = counts(marked).withColumnRenamed("conv_id", "t_")
    found = whole.withColumnRenamed("conv_id", "w_")
    heads = (every.join(tally, every.conv_id.eqNullSafe(tally.t_), "left").join(found, every.conv_id.eqNullSafe(found.w_), "left")
             .select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS],
                     F.coalesce("audit", F.lit("")).alias("audit")))
    return heads, audits, ordered


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _streamed(heads: DataFrame, audits: DataFrame, ordered: DataFrame, block: int) -> DataFrame:
    """Heads, blocks' audits and rows in one sorted stream, a conversation's within one partition.

    ``kind``: 0 a conversation's head, 1 a block's audit, 2 a row.
    """
    nothing = F.lit(None)
    zero = [F.lit(0).cast("long").alias(c) for c in COUNTS]
    head = heads.select("conv_id", F.lit(-1).alias("pid"), F.lit(-1).cast("long").alias("blk"), F.lit(0).alias("kind"),
                        F.lit(0).cast("long").alias("pos"), nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
                        F.col("audit").alias("text"), *COUNTS)
    each = audits.select("conv_id", "pid", "blk", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("pos"), nothing.cast("long").alias("turn"),
                         nothing.cast("string").alias("role"), F.col("audit").alias("text"), *zero)
    rows = ordered.select("conv_id", "pid", F.expr(f"pos div {block}").alias("blk"), F.lit(2).alias("kind"), "pos", "turn", "role", "text", *zero)
    n = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (head.unionByName(each).unionByName(rows).repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", "pid", "blk", "kind", "pos"))


class Repairer:
    """Walks audits and rows in order and says which lines the repaired conversation has."""

    def __init__(self) -> None:
        self.last, self.audit, self.at = "", "", 0

    def _next(self, line: tuple[str, str]) -> tuple[str, str]:
        self.last = line[0][:1]
        return line

    def _wanted(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._next((self._wanted(), ""))

    def block(self, audit: str) -> None:
        self.audit, self.at = audit, 0

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Lines from the insertions before a row to those behind it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._next((role if edit == "K" else self._wanted(), text))
        yield from self.inserted()


def _digests(heads: DataFrame, audits: DataFrame, ordered: DataFrame, block: int) -> DataFrame:
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = digest = walk = None
        begun = False
        done: list[tuple] = []

        def write() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(x), pa.string() if i >= len(names) - 2 else pa.int64())
                                              for i, x in enumerate(zip(*done))], names)
            done.clear()
            return out

        for big in batches:
            for b in (big.slice(at, 1024) for at in range(0, big.num_rows, 1024)):
                cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
                for conv, _, _, kind, _, _, role, text, *numbers in zip(*cols):
                    if kind == 0:
                        if head:
                            done.append((*head, digest.hexdigest()))
                        head, digest, walk, begun = (conv, *numbers, text), hashlib.sha256(), Repairer(), False
                    elif kind == 1:
                        walk.block(text)
                    else:
                        for line in walk.row(role, text):
                            digest.update(("\n" * begun + ":".join(line)).encode("utf-8", "surrogatepass"))
                            begun = True
                if done:
                    yield write()
        if head:
            done.append((*head, digest.hexdigest()))
            yield write()

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return map_arrow(_streamed(heads, audits, ordered, block), run, schema)


def repaired_lines(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``line`` (from 0), ``role``, ``text``."""
    heads, audits, ordered = _parsed(rows, rows, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, n = Repairer(), 0
        for big in batches:
            for b in (big.slice(at, 1024) for at in range(0, big.num_rows, 1024)):
                out: list[tuple] = []
                for conv, kind, role, text in zip(*(b.column(i).to_pylist() for i in (0, 3, 6, 7))):
                    if kind == 0:
                        walk, n = Repairer(), 0
                    elif kind == 1:
                        walk.block(text)
                    else:
                        for line in walk.row(role, text):
                            out.append((conv, n, *line))
                            n += 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(
                        zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv_id", "line", "role", "text"])

    return map_arrow(_streamed(heads, audits, ordered, block), run, "conv_id long, line long, role string, text string")


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string."""
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)), "
            "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint)")


def _more(state: str, cost: str, edit: str) -> str:
    """An audit with its cost in front (ten digits, so that text order is the order of cells) with one edit more."""
    return f"lpad(cast(cast(left({state}, 10) as bigint) + {cost} as varchar), 10, '0') || substr({state}, 11) || '{edit}'"


def _repair_sql() -> str:
    # A finite automaton reads the rows in order: q nothing out yet, s after a system turn, u and a after a user or
    # assistant turn.  Each state holds the least cost and audit so far.
    insert = (f"select conv_id, n, pl, q, s, least(u, {_more('q', '3', 'I')}, {_more('s', '3', 'I')}, {_more('a', '3', 'I')}) as u, "
              f"least(a, {_more('u', '3', 'I')}) as a from ")
    keep = {"s": "if(initial = 's', late, null)", "u": "if(initial = 'u', late, 3 + late)", "a": "if(initial = 'a', late, 3 + late)"}

    def output(symbol: str, sources: str) -> str:
        edit = f"if(initial = '{symbol}', 'K', 'R')"
        return ", ".join(_more(x, f"({keep[symbol]})", "") + f" || {edit}" for x in sources)

    step = (f"select conv_id, n, pl + 1 as pl, {_more('q', '4', 'D')} as q, "
            f"least({_more('s', '4', 'D')}, if(gone, null, {output('s', 'q')})) as s, "
            f"least({_more('u', '4', 'D')}, if(gone, null, least({output('u', 'qsa')}))) as u, "
            f"least({_more('a', '4', 'D')}, if(gone, null, {output('a', 'u')})) as a from ")
    closed = lambda inner: f"{insert} ({insert} ({inner}))"
    return f"""
with recursive original as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {crc32_sql("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as what
  from conversations),
rows as (
  select conv_id, turn, if(what = 4, 'user', role) as role,
         case what when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from original, unnest(range(if(what = 3, 2, 1))) where what <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pl,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, left(role, 1) as initial
  from rows),
marked as (
  select *, case when bare = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pl) > 1 then 'duplicate' when right(bare, 1) not in ('.', '!', '?') then 'truncated' end as fault,
         lag(initial) over (partition by conv_id order by pl) as before
  from placed),
tokens as (
  select conv_id, pl, initial, coalesce(fault in ('blank', 'duplicate'), false) as gone, if(fault = 'truncated', 3, 0) as late from marked),
best as (
  select conv_id, count(*) as n, 0 as pl, '0000000000' as q, cast(null as varchar) as s, cast(null as varchar) as u,
         cast(null as varchar) as a from marked group by conv_id
  union all
  select conv_id, n, pl, q, s, u, a from (
    {closed(step + " (select o.*, t.initial, t.gone, t.late from (" + closed("select * from best where pl < n") +
            ") o join tokens t on t.conv_id is not distinct from o.conv_id and t.pl = o.pl + 1)")})),
ended as (
  select conv_id, least(q, a) as cell from best where pl = n),
edits as (
  select conv_id, i, substr(cell, i + 10, 1) as edit from ended, unnest(range(1, length(cell) - 9)) t(i)),
lines as (
  select e.*, m.role, m.text, e.edit <> 'D' as out,
         sum(if(e.edit <> 'D', 1, 0)) over (partition by e.conv_id order by e.i) as place,
         max(if(e.edit = 'K' and m.initial = 's', 1, 0)) over (partition by e.conv_id) as system
  from (select *, sum(if(edit = 'I', 0, 1)) over (partition by conv_id order by i) as row from edits) e
  left join marked m on m.conv_id is not distinct from e.conv_id and m.pl = e.row and e.edit <> 'I'),
repaired as (
  select conv_id, sha256(coalesce(string_agg(case edit when 'K' then role else if((place - system) % 2 = 1, 'user', 'assistant') end || ':' ||
           coalesce(text, ''), chr(10) order by i) filter (where out), '')) as digest
  from lines group by conv_id),
tally as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
         count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
         count(*) filter (where pl > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id)
select o.conv_id, coalesce(t.gaps, 0) as gaps, coalesce(t.blank, 0) as blank, coalesce(t.duplicate, 0) as duplicate,
       coalesce(t.truncated, 0) as truncated, coalesce(t.illegal, 0) as illegal, coalesce(cast(left(e.cell, 10) as bigint), 0) as cost,
       coalesce(substr(e.cell, 11), '') as audit, coalesce(r.digest, sha256('')) as repaired_sha256
from (select distinct conv_id from original) o
left join tally t on t.conv_id is not distinct from o.conv_id
left join ended e on e.conv_id is not distinct from o.conv_id
left join repaired r on r.conv_id is not distinct from o.conv_id
"""


OP13_SQL = _repair_sql()


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)
