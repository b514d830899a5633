from mapflow.functions.expressions import (equi_pairs, is_bare_identifier, is_computed_logic, qualify_join_lhs,
                                           rewrite_main, split_conjuncts, split_list)


def test_rewrite_main_only_outside_literals():
    assert rewrite_main("main.a = 'main.b' and xmain.c = 1") == "source.a = 'main.b' and xmain.c = 1"
    assert rewrite_main("MAIN.a > 0", "src") == "src.a > 0"


def test_qualify_join_lhs_identifiers_only():
    assert qualify_join_lhs("OPCO_ID=items.OPCO_ID") == "source.OPCO_ID=items.OPCO_ID"
    # numbers are never prefixed, right-hand bare names are kept, comparisons left alone
    assert qualify_join_lhs("1=1") == "1=1"
    assert qualify_join_lhs("a.x = y") == "a.x = y"
    assert qualify_join_lhs("k >= n.k and k <= n.j") == "k >= n.k and k <= n.j"
    assert qualify_join_lhs("k <=> n.k") == "k <=> n.k"
    assert qualify_join_lhs("n.s = 'a=b'") == "n.s = 'a=b'"


def test_split_conjuncts_respects_parentheses_and_literals():
    assert split_conjuncts("a = 1 AND (b = 2 and c = 3) and d = 'x and y'") == [
        "a = 1", "(b = 2 and c = 3)", "d = 'x and y'"]
    assert split_conjuncts("brand = 1 and operand = 2") == ["brand = 1", "operand = 2"]


def test_equi_pairs():
    assert equi_pairs("source.a = n.b and n.c < 20", "n") == ([("source.a", "b")], False)
    assert equi_pairs("source.a > n.b and source.c > 0", "n") == ([], False)
    assert equi_pairs("n.a = n.b", "n") == ([], False)
    assert equi_pairs("source.a <=> n.b", "n") == ([("source.a", "b")], True)
    assert equi_pairs("source.a = n.b and n.c > 5 or source.a > 290", "n") == ([], False)


def test_lists_split_on_top_level_commas_only():
    assert split_list("a, coalesce(b, c) , 'x, y', `d,e`") == ["a", "coalesce(b, c)", "'x, y'", "`d,e`"]


def test_bare_and_computed():
    assert is_bare_identifier("OPCO_ID") and not is_bare_identifier("s.OPCO_ID")
    assert not is_bare_identifier("NULL") and not is_bare_identifier("upper(x)")
    for logic in ("'x'", "f(a)", "a + b", "a||b", "CASE WHEN a THEN 1 END", "a-b", None):
        assert is_computed_logic(logic)
    assert not is_computed_logic("OPCO_CD")
    assert not is_computed_logic("items.OPCO_CD")
    assert not is_computed_logic("case_id") and not is_computed_logic("s.UPPERCASE")
