"""SpotSigs document fingerprints, in DataFrame and SQL functions only.

A spot signature is the chain of the next ``CHAIN`` content words after a common word
(an anchor), common words in between skipped.  The common words act as separators: a
text falls into runs of content words, and the chain of each run is made of its own
words and, if they are too few, of the following runs.  The start of a text counts as an
anchor, and so does every ``RUN``-th word of a run without one, so that lists and tables
have signatures too.  A document's fingerprint is the set of its signatures.

Two fingerprints are compared by Jaccard similarity, pruned by set length: lengths fall
into classes so wide that sets two classes apart cannot reach ``least``, and sets whose
lengths alone rule ``least`` out are not intersected; both have likeness 0.  Sets that are
intersected get their exact similarity, however small.  A signature is the first 64 bits of a chain's MD5.

Null and empty texts: the empty set; two empty sets have likeness 1, an empty and
another one 0.  Null ``doc_id`` comes before all others.  Rows that share an id follow
one another by the hash of their texts.  A table of one row: its next document is itself.
Empty table: no rows.  Very long texts are fingerprinted whole.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

CHAIN = 3
RUN = 6
#: Sets whose lengths alone rule this likeness out are not intersected.
LEAST = 0.05
#: Anchors: common words of English, French, German and Spanish.
ANCHORS = tuple(sorted(set(
    "the of and to a in is that it was for on are as with his they at be this from have or by one had not but what all were "
    "we when your can said there use an each which she do how their if will".split()
    + "le la les de des du un une et est que qui en dans pour pas par sur au aux avec ce il elle".split()
    + "der die das den dem des ein eine einer und ist im in von zu mit für auf nicht auch sich als an".split()
    + "el la los las de del que y en un una es por con para no se lo su al como más".split())))

# One anchor: runs between neighbouring anchors are empty and drop out.  (A repeated group
# would make the regular expression recurse once for each anchor of a long row of them.)
_SPLIT = f" (?:{'|'.join(ANCHORS)}) "
_RUN = f"(?: [^ ]+ ){{1,{RUN}}}"
_NOT_WORD = r"[^\p{L}\p{N}]+"


def _runs(text: Column) -> Column:
    """Runs of content words, each word between two spaces of its own; a run of over ``RUN`` words goes on in the next."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), _NOT_WORD, "  ")), F.lit(" "))
    return F.flatten(F.transform(F.split(plain, _SPLIT, -1), lambda r: F.regexp_extract_all(r, F.lit(_RUN), 0)))


def _signatures(runs: Column) -> Column:
    """Sorted set of the hashes of all chains, from the array of runs."""
    after = lambda k: F.slice(runs, F.lit(1 + k), F.greatest(F.size(runs) - k, F.lit(0)))
    chains = F.transform(
        F.arrays_zip(*[after(k).alias(f"r{k}") for k in range(CHAIN)]),
        lambda z: F.substring_index(F.trim(F.concat(*[F.coalesce(z[f"r{k}"], F.lit("")) for k in range(CHAIN)])), "  ", CHAIN))
    return F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.substring(F.md5(c), 1, 16))))


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the spot signatures of the column ``text`` as array ``name``."""
    runs = f"{name}_runs"
    return df.withColumn(runs, _runs(F.col(text))).withColumn(name, _signatures(F.col(runs))).drop(runs)


def length_class(signatures: Column, least: float = LEAST) -> Column:
    """Class of a set's length: sets whose classes differ by two or more cannot reach ``least``."""
    return F.floor(F.log(F.greatest(F.size(signatures), F.lit(1))) / F.lit(-math.log(least))).cast("int")


def likeness(a: Column, b: Column, least: float = LEAST) -> Column:
    """Jaccard similarity of two signature sets, pruned by their lengths."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    far = F.abs(length_class(a, least) - length_class(b, least)) > 1
    return (F.when(large == 0, F.lit(1.0)).when(far | (small < least * large), F.lit(0.0))
            .otherwise(exact))


def _buckets(keys: DataFrame, n: int) -> Column:
    """Number of the range of (``k``, ``h``) that a row falls into, for about ``n`` ranges of equal row counts.

    The bounds are quantiles of all keys, looked up in two steps so that a row compares
    with about two square roots of ``n`` bounds.  A key that is several quantiles at once, as a null id that many rows
    have, gets as many ranges of its own, by ``h``, and one more for the keys between it and the next bound.
    """
    cuts = keys.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    times = Counter(cuts or [])
    cuts = sorted(times)
    wide = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + wide] for i in range(0, len(cuts), wide)]
    if not groups:
        return F.lit(0).cast("long")
    numbers = lambda g: "array(" + ", ".join(f"{c}L" if c > -(1 << 63) else "-9223372036854775807L - 1L" for c in g) + ")"
    nested = "array(" + ", ".join(map(numbers, groups)) + ")"
    coarse = F.expr(f"greatest(size(filter({nested}, g -> g[0] <= k)), 1)")
    place = coarse * wide + F.size(F.filter(F.element_at(F.expr(nested), coarse), lambda c: c <= F.col("k"))) - wide
    bucket = place.cast("long")
    if max(times.values()) == 1:
        return bucket
    share = F.element_at(F.expr(numbers([times[c] for c in cuts])), place)
    # The upper 31 bits of ``h`` in its signed order, scaled to the key's number of ranges.
    part = F.shiftright((F.shiftright("h", 33) + (1 << 30)) * share, 31)
    own = F.when(F.col("k") == F.element_at(F.expr(numbers(cuts)), place), part).otherwise(share)
    return bucket * n + F.when((place > 0) & (share > 1), own).otherwise(F.lit(0).cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, its signatures ``own``, and both of the next document by ascending ``doc_id`` (after the last: the first).

    Texts move once, to ranges of ids (of ids and text hashes, where one id has many rows) of equal row counts, and are
    sorted there.  The first document of each range is sent, as a marked copy, to the end of the range before.
    """
    spark = docs.sparkSession
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    base = base.withColumns({"k": F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")), "h": F.xxhash64("text")})
    # Several ranges to a partition: ranges are dealt out by hash, which evens out over many.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n *= max(1, min(16, 16_384 // n))
    placed = base.withColumn("bucket", _buckets(base.select("k"), n))
    heads = placed.groupBy("bucket").agg(F.min(F.struct("k", "h")).alias("first"))
    # One row per range: a window over all of them orders ranges, not documents.
    before = F.lag("bucket").over(Window.orderBy("bucket"))
    last = F.max("bucket").over(Window.partitionBy())
    heads = heads.select("first.*", F.coalesce(before, last).alias("to"))
    # Rows of one id and one text are alike: one of them is enough.
    copies = base.join(F.broadcast(heads), ["k", "h"]).groupBy("to").agg(F.min(F.struct("doc_id", "text", "k", "h")).alias("r"))
    copies = copies.select("r.doc_id", "r.text", "r.k", "r.h", F.col("to").alias("bucket"), F.lit(1).alias("copy"))
    rows = placed.withColumn("copy", F.lit(0)).select("doc_id", "text", "k", "h", "bucket", "copy").union(copies)
    # Signatures are made after the move, so that only texts are moved, and once per text.
    rows = with_signatures(rows.repartition("bucket"), "text", "own")
    order = Window.partitionBy("bucket").orderBy("copy", "k", "h")
    return (rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order))
            .where("copy = 0").select("doc_id", "text", "own", "next_text", "next_own"))


def near_classes(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All pairs of fingerprints with a likeness of ``least`` or more, and which documents have them.

    Returns (``a``, ``b``, ``likeness``) between classes and (``doc_id``, ``class_id``); a
    class holds the documents of one fingerprint and is named after its smallest id.  Empty
    fingerprints, and classes without any id, are in no pair.  Sets are partitioned by length class, and only sets of one or
    of neighbouring classes meet.  Two sets that reach ``least`` share one of the rarest
    signatures of both, so each is filed under its first ``n - ceil(least * n) + 1`` by rarity;
    pairs whose lengths rule ``least`` out are dropped before any set is intersected.
    """
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    sets = stored(with_signatures(base, "text", "own").select("doc_id", F.array_join("own", ",").alias("print"), "own"), "spot-sets")
    named = sets.groupBy("print").agg(F.min("doc_id").alias("class_id"), F.first("own").alias("own"))
    named = stored(named.withColumn("n", F.size("own")).withColumn("part", length_class(F.col("own"), least)), "spot-classes")
    member = sets.join(named.select("print", "class_id"), "print").select("doc_id", "class_id")
    held = named.where("n > 0").select("class_id", "n", "part", F.explode("own").alias("sig"))
    common = held.groupBy("sig").agg(F.count("*").alias("df"))
    # A set's own signatures come together again, never more than it has.
    rare = held.join(common, "sig").groupBy("class_id", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by"))
    first = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1
    filed = stored(rare.select("class_id", "n", "part", F.explode(F.slice(F.col("by.sig"), F.lit(1), first)).alias("sig")), "spot-filed")
    probe = filed.select(F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("part").alias("pa"), "sig",
                         F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    index = filed.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "part", "sig")
    met = (probe.join(index, ["sig", "part"]).where(F.expr(f"(part > pa or a < b) and least(na, nb) >= {least}D * greatest(na, nb)"))
           .select("a", "b").distinct())
    left, right = (named.select(F.col("class_id").alias(c), F.col("own").alias(f"own_{c}")) for c in "ab")
    both = met.join(left, "a").join(right, "b").withColumn("likeness", likeness(F.col("own_a"), F.col("own_b"), least))
    return both.where(F.col("likeness") >= least).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"), member


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_next(table(spark, sf_dir, "documents"))
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cut)"), F.expr("substring(next_text, 1, cut)"))
    both = pairs.withColumn("cut", cut).withColumn("edited", edited)
    both = with_signatures(both, "edited", "other")
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("own", ",").alias("fingerprint"), F.array_join("other", ",").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))


def _sql_signatures(text: str) -> str:
    parts = f"string_split_regex(' ' || trim(regexp_replace(lower({text}), '{_NOT_WORD}', '  ', 'g')) || ' ', '{_SPLIT}')"
    runs = f"flatten(list_transform({parts}, lambda p: regexp_extract_all(p, '{_RUN}')))"
    chain = "array_to_string(string_split(trim(r[i] || coalesce(r[i + 1], '') || coalesce(r[i + 2], '')), '  ')[1:3], '  ')"
    return (f"(select list_sort(list_distinct(list_transform(range(1, len(r) + 1), lambda i: substr(md5({chain}), 1, 16)))) "
            f"from (select {runs} as r))")


def _sql_likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    size = f"(len({a}) + len({b}) - {both})"
    return (f"case when greatest(len({a}), len({b})) = 0 then 1.0::double "
            f"when least(len({a}), len({b})) < {LEAST}::double * greatest(len({a}), len({b})) then 0.0::double "
            f"else {both} / {size} end")


OP10_SQL = f"""
with t as (
  select doc_id, coalesce(text, '') as text from documents),
pairs as (
  select doc_id, text, coalesce(lead(text) over w, first_value(text) over w) as next_text
  from t window w as (order by doc_id rows between unbounded preceding and unbounded following)),
e as (
  select *, substr(text, 1, length(text) - length(text) // 4) || substr(next_text, 1, length(text) // 4) as edited from pairs),
s as (
  select *, {_sql_signatures('text')} as own, {_sql_signatures('edited')} as other, {_sql_signatures('next_text')} as following from e)
select doc_id, length(text) as n_chars, sha256(edited) as edited_sha256, array_to_string(own, ',') as fingerprint,
       array_to_string(other, ',') as edited_fingerprint, {_sql_likeness('own', 'other')} as near_edited,
       {_sql_likeness('own', 'following')} as near_next
from s
"""
