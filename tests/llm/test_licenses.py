import random
import time

from edge import ROWS, edge, empty, same, wide
from hypothesis import given
from hypothesis import strategies as st

from conftest import SF01
from mapflow.llm.licenses import TEMPLATES, Scanner, align, increasing, op2_licenses, scan_licenses

APACHE = TEMPLATES[1][1]
MIT = TEMPLATES[3][1]


def test_whole_table_finds_every_exact_statement(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op2_licenses(spark, SF01).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = sorted((text.find(t), n) for n, t in TEMPLATES if t in text)
        assert got[i].licenses == ",".join(sorted({n for _, n in want}))
        for at, n in want:
            assert any(s.startswith(f"{n}:{at}:") for s in got[i].spans.split(","))


@given(st.lists(st.integers(0, 50), max_size=40, unique=True))
def test_longest_increasing_subsequence(places):
    got = [places[i] for i in increasing(places)]
    assert got == sorted(got)
    best = []
    for x in places:
        best.append(max([b for y, b in zip(places, best) if y < x], default=0) + 1)
    assert len(got) == max(best, default=0)


@given(st.lists(st.sampled_from("abcdefgh"), max_size=30), st.lists(st.sampled_from("abcdefgh"), max_size=30))
def test_alignments_increase_and_match(a, b):
    pairs = align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_edited_notices_are_found_with_their_coverage():
    rng, scan = random.Random(1), Scanner().scan
    filler = " ".join(f"word{rng.randrange(300)}" for _ in range(800))
    words = APACHE.split()
    for drop in (0, 5, 12):
        kept = [w for i, w in enumerate(words) if i not in set(rng.sample(range(1, len(words) - 1), drop))]
        text = f"{filler} {' '.join(kept)} {filler}"
        (found,) = scan(text)
        assert found[0] == "Apache-2.0" and abs(found[3] - (1 - drop / found[5])) < 0.06
        assert text[found[1]:found[2]].startswith(kept[0]) and abs(found[1] - len(filler) - 1) < 5


def test_reflowed_commented_and_repeated_notices():
    scan = Scanner().scan
    comment = "\n".join(" * " + MIT[i:i + 50] for i in range(0, len(MIT), 50)).replace(" * ", "# ", 1)
    assert [f[0] for f in scan("x\n" + MIT.upper() + "\n\n" + APACHE + "\n" + MIT)] == ["MIT", "Apache-2.0", "MIT"]
    assert [f[0] for f in scan("é 漢字 " + MIT.replace(" ", "\n// "))] == ["MIT"]
    assert len(scan(comment)) <= 1


def test_ordinary_text_is_left_alone():
    scan = Scanner().scan
    assert scan("The license of the driver was in the software version of the general public work, 2 and 3.") == []
    assert scan("under the of the version the license the under version licensed") == []


def test_places_are_code_points():
    text = "漢字🙂 é " + TEMPLATES[0][1] + " ü"
    (f,) = Scanner().scan(text)
    assert text[f[1]:f[2]] == TEMPLATES[0][1].rstrip(".")


def test_edges(spark):
    rows = scan_licenses(edge(spark)).collect()
    assert len(rows) == len(ROWS) and all(r.found == [] for r in rows)
    assert scan_licenses(empty(spark)).count() == 0
    same(scan_licenses(wide(spark)), scan_licenses(edge(spark)))


def test_siblings_and_other_licenses_are_told_apart():
    scan = Scanner().scan
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    for text, want in (
            ("Released under the BSD License.", ["BSD"]), ("Released under the X11 License.", []),
            ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
            ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
            ("Licensed under CC BY-NC 3.0.", []),
            (gnu.format("", 2), ["GPL-2.0"]), (gnu.format("", 3), ["GPL-3.0"]), (gnu.format("", "v3"), ["GPL-3.0"]),
            (gnu.format("Lesser ", 3), ["LGPL-3.0"]), (gnu.format("Lesser ", 2.1), ["LGPL-2.1"]), (gnu.format("Affero ", 3), ["AGPL-3.0"]),
            ("Licensed under the Apache License, Version 1.1.", []), ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
            ("Released under the terms of the MIT License.", ["MIT"]),
            ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"])):
        for around in ("{}", "one two three {} four five six"):
            assert [f[0] for f in scan(around.format(text))] == want, text


def test_every_template_is_its_own_finding():
    for name, text in TEMPLATES:
        (f,) = Scanner().scan(f"some words before it {text} and some words after it")
        assert (f[0], f[3]) == (name, 1.0), text


def test_tags_short_names_and_other_licenses():
    scan = Scanner().scan
    for text, want in (
            ("# SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0"]),
            ("SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1"]), ("SPDX-License-Identifier: BSD-4-Clause", []),
            ("SPDX-License-Identifier: CC-BY-NC-4.0", ["CC-BY-NC-4.0"]), ("SPDX-License-Identifier: Zlib", []),
            ("SPDX-License-Identifier: AGPL-3.0", ["AGPL-3.0"]), ("SPDX-License-Identifier: Apache-1.1", []),
            ("licensed under the GNU GPL v3", ["GPL-3.0"]), ("licensed under the GNU LGPL v2.1", ["LGPL-2.1"]),
            ("Released under the BSD 3-Clause License", ["BSD-3-Clause"]), ("Released under the BSD License", ["BSD"]),
            ("Apache License Version 2.0, January 2004", ["Apache-2.0"]), ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ["GPL-2.0"]),
            ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", ["BSL-1.0"]),
            ("Licensed under the Apache License, Version 2.0 or the MIT License", ["Apache-2.0", "MIT"]),
            ("mit the license or mit", [])):
        for around in ("{}", "one two three {} four five six"):
            assert [f[0] for f in scan(around.format(text))] == want, text


def test_overlaps_against_brute_force():
    """Of all findings, taken by words, coverage, place and name, those that touch none taken before."""
    scanner, rng = Scanner(), random.Random(4)
    texts = [t for _, t in TEMPLATES]
    for _ in range(30):
        words = " ".join(rng.choice(texts) for _ in range(6)).split()
        text = " ".join(w for w in words if rng.random() > 0.03)
        found = []
        for t in TEMPLATES:  # one template at a time: nothing overlaps but its own findings
            found += [(n, a, b, m, c) for n, a, b, c, m, _ in Scanner((t,)).scan(text)]
        best = max((m for *_, m, _ in found), default=0)
        got = scanner.scan(text)
        assert all(p[2] <= q[1] for p, q in zip(got, got[1:]))
        assert max((f[4] for f in got), default=0) == best
        for n, a, b, m, _ in found:
            assert any(g[1] < b and a < g[2] and g[4] >= m for g in got), (n, a, b)


def test_many_findings_in_one_text_take_linear_time():
    scan, line = Scanner().scan, "é Released under the MIT License. And then some other words come here. "
    seconds = []
    for n in (2000, 8000):
        began = time.perf_counter()
        found = scan(line * n)
        seconds.append(time.perf_counter() - began)
        assert [f[1:3] for f in found] == [(2 + i * len(line), 2 + i * len(line) + 30) for i in range(n)]
    assert seconds[1] < 8 * seconds[0]
