"""Quality rules with risk-controlled thresholds, in DataFrame and SQL functions only.

A document fails outright if it has under 50 words or mostly repeated word windows.
Beyond that, each rule compares a share (symbols per word, repeated lines, repeated
windows, capitals, odd word lengths) with a cutoff chosen per stratum (language)
from labelled documents: going from the loosest cutoff to the strictest, a cutoff is
taken as long as the exact binomial test on the labelled good documents says that it
rejects at most ``risk`` of good documents, and the walk ends at the first that
fails.  The walk needs no correction of its own; over strata and rules the error
probability ``delta`` is divided evenly (Bonferroni), so all cutoffs passed hold at
once and any of them may be picked: it is the one that rejects the most labelled bad
documents over good ones, the loosest of equals, and none where good ones prevail.

A language is a stratum of its own if its labelled good documents are enough to certify a cutoff under the final number of
tests (``own_strata``, decided by their number alone).  All other languages, and those without labels, form one pooled
stratum with cutoffs and a certificate of its own: the risk holds for the pool as a whole.
Where even the pool has too few labels, nothing more is rejected in it.

What reaches the driver is one count per language that could be a stratum, and one per stratum, rule and cutoff.

Null and empty texts: no words, all counts zero, failed.  A null language is a language
like others.  Ties: languages of equal counts by code point, null last.  Further columns pass through ``keep_good`` unchanged.  Null ``doc_id``: judged, never labelled.  Repeated labels of a document:
good if all say so.  Repeated documents are judged each.  Empty tables: no rows, or no
cutoffs.  Very long texts are counted whole, inside their row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, fresh, stored, table, words

MIN_WORDS = 50
#: Largest share of words in repeated windows that is not failed outright, in percent.
MAX_REPEAT = 50
RISK = 0.01
DELTA = 0.05
# Rules: a share and its cutoffs, loosest first; a document is rejected above the cutoff.
RULES = {
    "symbols": (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "repeats": (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "capitals": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "long_words": (30.0, 20.0, 15.0, 12.0),
}


def repeat_words(word_list: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, from the array of words.

    Windows are compared by their 64-bit hash.  Sorted with their places, equal ones
    stand side by side; each flagged place then covers three words, less what the next
    flagged one covers too.
    """
    n = F.size(word_list)
    windows = F.transform(
        F.arrays_zip(F.slice(word_list, F.lit(1), n - 2).alias("a"), F.slice(word_list, F.lit(2), n - 2).alias("b"),
                     F.slice(word_list, F.lit(3), n - 2).alias("c")),
        lambda w: F.xxhash64(w["a"], w["b"], w["c"]))
    return F.when(n < 4, F.array().cast("array<bigint>")).otherwise(windows)


def counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the counts of every row's text; see ``measures`` for the shares."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    t, w, h, s, lines = (fresh(docs, x) for x in ("q_text", "q_words", "q_hashes", "q_sorted", "q_lines"))
    base = docs.select(*[docs[f"`{c}`"] for c in keep], text.alias(t))
    one = base.withColumn(w, words(F.col(t)))
    one = one.withColumn(h, repeat_words(F.col(w)))
    # Sorting is only worth it where some window occurs twice.
    numbered = F.arrays_zip(F.col(h).alias("h"), F.sequence(F.lit(1), F.size(h)).alias("i"))
    one = one.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(numbered))
                         .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    flagged = F.expr(f"""
        aggregate(
          sort_array(filter(
            zip_with(zip_with({s}, slice({s}, 2, size({s})), (x, y) -> named_struct('i', x.i, 'h', x.h, 'n', y.h)),
                     concat(array(cast(null as struct<h:bigint,i:int>)), slice({s}, 1, greatest(size({s}) - 1, 0))),
                     (x, p) -> case when x.h = x.n or x.h = p.h then x.i end),
            i -> i is not null)),
          named_struct('last', -3, 'n', 0L),
          (acc, i) -> named_struct('last', i, 'n', acc.n + least(3, i - acc.last)),
          acc -> acc.n)""")
    one = one.withColumn(lines, F.filter(F.split(t, "\n", -1), lambda x: F.length(F.trim(F.translate(x, SPACES, " " * len(SPACES)))) > 0))
    return one.select(
        *[f"`{c}`" for c in keep],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        flagged.alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"))


def measures() -> dict[str, Column]:
    """The rules' shares from the columns of ``counts``."""
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbols": over("n_symbols", "n_words"), "dup_lines": over("n_dup_lines", "n_lines"),
            "repeats": over("n_repeat_words", "n_words"), "capitals": over("n_capitals", "word_chars"),
            "long_words": over("word_chars", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) for X ~ Binomial(n, p), at any n: the regularised incomplete beta function I_{1-p}(n-k, k+1)."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))

    def fraction(a: float, b: float, x: float) -> float:
        tiny, c = 1e-300, 1.0
        d = 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny) if 1.0 - (a + b) * x / (a + 1.0) > 0 else 1.0 / (1.0 - (a + b) * x / (a + 1.0))
        out = d
        for m in range(1, 100_000):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                        -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1.0 + num * d, 1.0 + num / c
                d, c = 1.0 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
                out *= d * c
            if abs(d * c - 1.0) < 1e-14:
                break
        return out

    if x < (a + 1.0) / (a + b + 2.0):
        return min(1.0, front * fraction(a, b, x) / a)
    return max(0.0, 1.0 - front * fraction(b, a, 1.0 - x) / b)


def certified_cutoffs(tallies: dict[tuple, tuple[int, list[int], list[int]]], risk: float = RISK,
                      delta: float = DELTA) -> dict[tuple, float]:
    """Cutoffs by (stratum, rule) from (good documents, of these above each cutoff, bad ones above each).

    Keys without a cutoff are left out.
    """
    each = delta / max(1, len(tallies))
    out = {}
    for (stratum, rule), (n, above, caught) in tallies.items():
        most = 0
        for cutoff, k, bad in zip(RULES[rule], above, caught):
            if binomial_tail(k, n, risk) > each:
                break
            if bad - k > most:
                out[stratum, rule], most = cutoff, bad - k
    return out


def least_good(strata: int, risk: float = RISK, delta: float = DELTA) -> int:
    """Good documents without which no cutoff can be certified, if ``strata`` are tested."""
    return math.ceil(math.log(delta / (len(RULES) * strata)) / math.log1p(-risk))


def own_strata(good: dict[str | None, int], risk: float = RISK, delta: float = DELTA) -> list[str | None]:
    """Languages that are strata of their own, from their numbers of labelled good documents: as many as can all be certified beside a pool."""
    ranked = sorted(good, key=lambda x: (-good[x], x is None, x or ""))
    enough = [i for i, x in enumerate(ranked, 1) if good[x] >= least_good(i + 1, risk, delta)]
    return ranked[:max(enough, default=0)]


@dataclass(frozen=True)
class Cutoffs:
    """Cutoffs by (stratum, rule); a stratum is (True, language), or (False, None) for the pool of languages not in ``own``."""

    own: tuple[str | None, ...]
    by_rule: dict[tuple, float]


def fit_cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> Cutoffs:
    """Cutoffs from all labelled documents that pass the base test; ``counted``: ``doc_id``, ``stratum``, counts."""
    marked = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg((F.min("quality") == 1).alias("good")))
    held = counted.where(~base_failed()).join(marked, "doc_id")
    # Only languages with enough good documents reach the driver; the others are in the pool anyhow.
    good = held.where("good").groupBy("stratum").count().where(F.col("count") >= least_good(2, risk, delta)).collect()
    own = own_strata({r["stratum"]: r["count"] for r in good}, risk, delta)
    mine = F.lit(False)
    for name in own:
        mine = mine | F.col("stratum").eqNullSafe(F.lit(name))
    shares = measures()
    tally = held.groupBy(mine.alias("mine"), F.when(mine, F.col("stratum")).alias("name")).agg(
        F.count_if("good").alias("n"),
        *[F.count_if((shares[r] > c) & (F.col("good") == good)).alias(f"{r}_{i}_{good}")
          for r, cuts in RULES.items() for i, c in enumerate(cuts) for good in (True, False)],
    ).collect()
    tallies = {((row["mine"], row["name"]), r): (row.n, *([row[f"{r}_{i}_{good}"] for i in range(len(cuts))] for good in (True, False)))
               for row in tally for r, cuts in RULES.items()}
    # The pool is tested even if it is empty, so that the number of tests was known when the strata were chosen.
    for r, cuts in RULES.items():
        tallies.setdefault(((False, None), r), (0, [0] * len(cuts), [0] * len(cuts)))
    return Cutoffs(tuple(own), certified_cutoffs(tallies, risk, delta))


def rejected(cutoffs: Cutoffs, stratum: Column) -> Column:
    """True where a share is above its stratum's certified cutoff."""
    out, shares, pooled = F.lit(False), measures(), F.lit(True)
    for name in cutoffs.own:
        pooled = pooled & ~stratum.eqNullSafe(F.lit(name))
    for ((mine, name), rule), cutoff in sorted(cutoffs.by_rule.items(), key=str):
        out = out | ((stratum.eqNullSafe(F.lit(name)) if mine else pooled) & (shares[rule] > cutoff))
    return out


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per document: its counts, ``base_failed`` and ``kept``."""
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("stratum"), "text")
    counted = stored(counts(keyed, ["doc_id", "stratum"]), "quality-counts")
    cutoffs = fit_cutoffs(counted, labels, risk, delta)
    return (counted.withColumn("base_failed", base_failed())
            .withColumn("kept", ~(F.col("base_failed") | rejected(cutoffs, F.col("stratum")))))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged; counted in place, without a shuffle of texts."""
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("stratum"), "text")
    cutoffs = fit_cutoffs(stored(counts(keyed, ["doc_id", "stratum"]), "quality-counts"), labels, risk, delta)
    row = fresh(docs, "q_row")
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(row), docs["text"].alias("text"),
                        docs["lang"].cast("string").alias("stratum"))
    judged = counts(whole, [row, "stratum"])
    # One row or none from an array: a plain filter would be pushed down and count every text again for each test.
    good = F.when(~(base_failed() | rejected(cutoffs, F.col("stratum"))), F.array(row))
    return judged.select(F.explode(good).alias(row)).select(f"{row}.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_CUTS = ", ".join(f"('{r}', {i}, {float(c)!r}::double)" for r, cs in RULES.items() for i, c in enumerate(cs))
OP9_SQL = rf"""
with t as (
  select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as x
  from t where len(w) > 3),
flagged as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, x) > 1),
covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from flagged) group by doc_id),
c as (
  select t.doc_id, lang, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
         coalesce(covered.n, 0) as n_repeat_words, len(l) as n_lines, len(regexp_extract_all(text, '\p{{Lu}}')) as n_capitals
  from t left join covered on t.doc_id = covered.doc_id),
b as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words as base_failed,
         case when n_words > 0 then n_symbols / n_words else 0 end as symbols,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_lines,
         case when n_words > 0 then n_repeat_words / n_words else 0 end as repeats,
         case when word_chars > 0 then n_capitals / word_chars else 0 end as capitals,
         case when n_words > 0 then word_chars / n_words else 0 end as long_words
  from c),
cuts(rule, place, cutoff) as (values {_CUTS}),
shares as (
  unpivot (select doc_id, lang, base_failed, symbols::double as symbols, dup_lines::double as dup_lines, repeats::double as repeats,
                  capitals::double as capitals, long_words::double as long_words from b)
  on symbols, dup_lines, repeats, capitals, long_words into name rule value share),
marked as (select doc_id, min(quality) = 1 as good from labels where quality is not null group by doc_id),
ranked as (
  select lang, count(*) as n, row_number() over (order by count(*) desc, lang nulls last) as place
  from b join marked using (doc_id) where good and not base_failed group by lang),
own as (
  select lang from ranked where place <= (
    select max(place) from ranked where n >= ceil(ln({DELTA} / ({len(RULES)} * (place + 1))) / ln(1 - {RISK})))),
strata as (
  select l.lang, exists (select 1 from own where own.lang is not distinct from l.lang) as mine,
         case when exists (select 1 from own where own.lang is not distinct from l.lang) then l.lang end as stratum
  from (select distinct lang from documents) l),
tally as (
  select mine, stratum, rule, place, cutoff, count(*) filter (where good) as n, count(*) filter (where good and share > cutoff) as k,
         count(*) filter (where not good and share > cutoff) as caught
  from shares join strata on shares.lang is not distinct from strata.lang join marked using (doc_id) join cuts using (rule)
  where not base_failed group by all),
tests as (select {len(RULES)} * (1 + (select count(*) from own)) as n),
tail as (
  select mine, stratum, rule, place, cutoff, caught - k as gain,
         (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))
          from (select unnest(range(0, k + 1)) as i)) as p
  from tally),
passed as (
  select mine, stratum, rule, cutoff, gain from (
    select *, bool_and(p <= {DELTA} / (select n from tests)) over (partition by mine, stratum, rule order by place) as ok from tail) where ok),
chosen as (
  select mine, stratum, rule, cutoff from passed where gain > 0
  qualify row_number() over (partition by mine, stratum, rule order by gain desc, cutoff desc) = 1),
out as (
  select distinct s.doc_id from shares s join strata on s.lang is not distinct from strata.lang
  join chosen on s.rule = chosen.rule and strata.mine = chosen.mine and strata.stratum is not distinct from chosen.stratum
    and s.share > chosen.cutoff)
select b.doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and out.doc_id is null as kept
from b left join out on b.doc_id = out.doc_id
"""
