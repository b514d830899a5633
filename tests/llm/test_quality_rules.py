import collections
import math
import re

import duckdb
import pytest
from edge import ROWS, edge, empty, labels, same, wide
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01, plan_text
from mapflow.llm.quality_rules import (OP9_SQL, RULES, binomial_tail, certified_cutoffs, counts, fit_cutoffs, judge, keep_good,
                                       least_good, op9_quality_rules, own_strata)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


TEXTS = ["", "a", "a b c", "a b c a b c", "a a a a a", "a b a b a b a", "x y z\nx y z\n\n \nx  y z", "p q r s p q r t p q r", "# * $ |\n# * $ |",
         "a b c d a b c\td a\x0bb c d", "one\x1ctwo three four one\x1ctwo three four one\x1ctwo", " lead and trail ", "\n\n\n"]


def counted(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in counts(df, ["doc_id"]).collect()}


def test_counts_by_hand(spark):
    texts = TEXTS + [None] + [r[1] for r in ROWS]
    assert counted(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n#é\t"), max_size=60), min_size=40, max_size=40))
def test_counts_of_any_text(spark, texts):
    assert counted(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op9_quality_rules(spark, SF01).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize("n,p", [(1, 0.5), (20, 0.3), (300, 0.01), (300, 0.9), (2000, 0.02)])
def test_binomial_tail_is_exact(n, p):
    total = 0.0
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
        assert abs(binomial_tail(k, n, p) - total) < 1e-9


def test_binomial_tail_at_large_counts():
    n = 10 ** 9
    assert binomial_tail(n // 100, n, 0.01) == pytest.approx(0.5, abs=1e-3)
    assert binomial_tail(n // 100 - 10 ** 6, n, 0.01) < 1e-30


def test_the_walk_ends_at_the_first_cutoff_that_fails():
    cuts = RULES["dup_lines"]
    above, bad = [0, 0, 3, 60, 0, 0, 0], [0, 5, 9, 99, 99, 99, 99]
    key = ("en", "dup_lines")
    assert certified_cutoffs({key: (1000, above, bad)}) == {key: cuts[2]}
    assert certified_cutoffs({key: (200, [0] * 7, bad)}) == {}
    # Of those passed, the one with the largest gain; the loosest of equals; none where good ones prevail.
    assert certified_cutoffs({key: (1000, [0, 0, 3, 60], [0, 5, 8, 99])}) == {key: cuts[1]}
    assert certified_cutoffs({key: (1000, [0, 1, 2, 2], [0, 1, 1, 2])}) == {}


def test_false_rejection_stays_under_the_risk(spark):
    """Good documents with symbol shares drawn from one law: the chosen cutoff rejects at most the risk of fresh ones."""
    words = " ".join(f"w{i}" for i in range(100))
    share = lambda i: 60 if i % 10 == 3 else int(100 * ((i * 7919) % 1000 / 1000) ** 4)  # noqa: E731  a tenth are bad
    docs = spark.createDataFrame([(i, words + " ".join([""] + [f"#x{k}" for k in range(share(i))]), "en") for i in range(4000)],
                                 "doc_id long, text string, lang string")
    lab = labels(spark, [(i, int(i % 10 != 3), 0) for i in range(0, 4000) if i % 4 < 2 or i % 10 == 3])
    kept = {r.doc_id for r in judge(docs, lab).where("kept").collect()}
    fresh = [i for i in range(4000) if i % 4 >= 2 and i % 10 != 3]
    assert 1 - len(kept & set(fresh)) / len(fresh) <= 0.015
    assert {r.doc_id for r in keep_good(docs, lab).collect()} == kept


def test_strata_are_those_that_can_all_be_certified():
    need = [least_good(k) for k in range(1, 6)]
    assert need == sorted(need) and 0.99 ** need[2] <= 0.05 / 15 < 0.99 ** (need[2] - 1)
    assert own_strata({}) == [] and own_strata({"a": need[1] - 1}) == [] and own_strata({"a": need[1]}) == ["a"]
    # Two strata and the pool make three: both have to reach that, or only the larger stays.
    assert own_strata({"a": need[2], None: need[2]}) == ["a", None]
    assert own_strata({"a": 9999, "b": need[2] - 1}) == ["a"]


def test_several_strata_and_the_pool_against_sql(spark, tmp_path):
    """A made table: three languages with cutoffs of their own, small ones that only together have one, a null language."""
    words, rows, labelled = " ".join(f"w{i}" for i in range(60)), [], []
    sizes = {"en": 1500, "de": 1200, "fr": 900, "es": 260, "it": 200, None: 240}
    for lang, size in sizes.items():
        for i in range(size):
            bad = i % 9 == 4
            symbols = {"en": 40, "de": 25, "fr": 18}.get(lang, 33) if bad else (i * 7919) % 9
            text = words + " #" * symbols + (" WORDS IN CAPITALS" * 8 if bad and lang == "fr" else "")
            rows.append((len(rows), text, lang))
            labelled.append((rows[-1][0], int(not bad), 0))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels(spark, labelled)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lab.write.parquet(f"{tmp_path}/labels.parquet")
    cuts = fit_cutoffs(counts(docs.withColumnRenamed("lang", "stratum"), ["doc_id", "stratum"]), lab)
    assert cuts.own == ("en", "de", "fr") and {k[0] for k in cuts.by_rule} == {(True, x) for x in cuts.own} | {(False, None)}
    got = {tuple(r) for r in op9_quality_rules(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == set(con.execute(OP9_SQL).fetchall())
    kept = {r[0] for r in got if r[-1]}
    assert not kept & {i for i, y, _ in labelled if not y} and len(kept) == sum(y for _, y, _ in labelled)


def test_small_languages_lose_their_bad_documents(spark):
    """At sf0.1, where the query's SQL agrees with it: cutoffs for the pool of small languages, too."""
    path = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{path}/{t}.parquet')")
    got = {tuple(r) for r in op9_quality_rules(spark, path).collect()}
    assert got == set(con.execute(OP9_SQL).fetchall())
    kept, failed = {r[0]: r[-1] for r in got}, {r[0]: r[-2] for r in got}
    marked = con.execute("select l.doc_id, min(quality) from labels l join documents d using (doc_id) where lang <> 'en' and quality is not null group by 1").fetchall()
    bad = [i for i, y in marked if y == 0 and not failed[i]]
    good = [i for i, y in marked if y == 1 and not failed[i]]
    assert len(bad) > 100 and sum(kept[i] for i in bad) == 0 and sum(not kept[i] for i in good) <= 0.01 * len(good)


def test_native_plan(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    text = plan_text(keep_good(docs, spark.read.parquet(f"{SF01}/labels.parquet")))
    assert not re.search("Python|Pandas|Arrow", text) and "Exchange" not in text


def test_edges(spark):
    none = labels(spark)
    rows = judge(edge(spark), none).collect()
    assert len(rows) == len(ROWS) and [r.doc_id for r in rows if r.kept] == [4]
    assert judge(empty(spark), none).count() == 0 and keep_good(empty(spark), none).count() == 0
    lab = labels(spark, [(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0)])
    same(judge(wide(spark), lab), judge(edge(spark), lab))
    assert keep_good(wide(spark), lab).columns == wide(spark).columns
    assert [r.doc_id for r in keep_good(wide(spark), lab).collect()] == [4]
