"""Patience alignment against the longest common subsequence, and planted licenses."""

import random
from functools import lru_cache

from corpusledger.llm import license_scan as op
from corpusledger.llm.license_texts import TEMPLATES

from .shared import empty, messy, prose


def common(a, b):
    @lru_cache(None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        if a[i] == b[j]:
            return 1 + best(i + 1, j + 1)
        return max(best(i + 1, j), best(i, j + 1))

    return best(0, 0)


def test_alignment():
    rng = random.Random(2)
    for _ in range(200):
        b = [rng.randrange(25) for _ in range(20)]
        a = [x for x in b if rng.random() > 0.15]
        a[5:5] = [99, 98]
        pairs = op.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < u and y < v for (x, y), (u, v) in zip(pairs, pairs[1:]))
        assert len(pairs) <= common(tuple(a), tuple(b))
    unique = list(range(30))
    assert op.aligned([5, 6, *unique[8:], 3], unique) == [(0, 5), (1, 6), *((i - 6, i) for i in range(8, 30))]


def test_increasing():
    assert op.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]
    assert op.increasing([]) == []


def test_planted(spark):
    rng, rows = random.Random(4), []
    for i, (name, text) in enumerate(TEMPLATES.items()):
        words = text.split()
        if len(words) > 20:  # a few words changed, dropped and added
            for _ in range(len(words) // 20):
                words[rng.randrange(len(words))] = "altered"
            del words[7]
            words[30:30] = ["Copyright", "2020"]
        rows.append((i, f"{prose(i, 70)}\n{' '.join(words).upper()}\n{prose(50 + i, 4000 * (i == 3) + 40)}"))
    twice = TEMPLATES["MIT mention"]
    rows.append((50, f"{twice} {prose(9, 30)} {twice}"))
    rows += [(100 + i, prose(300 + i, 400)) for i in range(20)]
    data = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = op.license_scan(data).collect()
    for i, name in enumerate(TEMPLATES):
        own = [r for r in out if r["doc_id"] == i]
        assert [r["license"] for r in own] == [name], (name, own)
        assert own[0]["coverage"] >= 0.8
        stretch = rows[i][1][own[0]["start"]:own[0]["end"]].split()
        assert abs(len(stretch) - len(TEMPLATES[name].split())) < 6
    assert [r["license"] for r in out if r["doc_id"] == 50] == ["MIT mention"] * 2
    assert not any(r["doc_id"] >= 100 for r in out)


def test_messy(spark):
    docs = messy(spark)
    line = "Licensed under CC BY-NC 4.0."
    more = docs.selectExpr(*(f"'é {line}' AS text" if c == "text" else c for c in docs.columns))
    assert op.license_scan(docs).count() == 0
    out = op.license_scan(more).collect()
    assert len(out) == more.count() and {(r["start"], r["end"]) for r in out} == {(2, 2 + len(line) - 1)}
    assert op.license_scan(empty(spark)).count() == 0


def test_rivals_keep_their_names():
    scanner = op.Scanner(TEMPLATES, op.COVERAGE)
    names = lambda text: [match[0] for match in scanner.scan(f"some text. {text} more text")]
    gnu = "This work is licensed under the GNU {}, version {}."
    for text, name in {
        "Released under the BSD License.": "BSD mention",
        "Released under the BSD 3-Clause License.": "BSD-3-Clause mention",
        "Licensed under the MIT License.": "MIT mention",
        "Licensed under CC BY 4.0.": "CC-BY-4.0 short mention",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0 mention",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0 short mention",
        "Licensed under CC0 1.0 Universal.": "CC0-1.0 mention",
        "Licensed under the Mozilla Public License, Version 2.0.": "MPL-2.0 mention",
        gnu.format("General Public License", 2): "GPL-2.0 mention",
        gnu.format("General Public License", "3.0"): "GPL-3.0 mention",
        gnu.format("Lesser General Public License", 3): "LGPL-3.0 mention",
        gnu.format("Lesser General Public License", 2.1): "LGPL-2.1 mention",
        gnu.format("Affero General Public License", 3): "AGPL-3.0 mention",
    }.items():
        assert names(text) == [name], text
    for text in (
        "Released under the Zlib License.", "Licensed under CC BY 3.0.", "Licensed under CC SA 4.0.",
        gnu.format("General Public License", 1), gnu.format("General Public License", "2.7"),
        gnu.format("Library General Public License", 2), "Licensed under the Foo License, Version 2.0.",
        "Licensed under the Apache License, Version 1.1.",
    ):
        assert names(text) == [], text


def test_full_texts_of_one_family():
    scanner = op.Scanner(TEMPLATES, op.COVERAGE)
    for name in ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"):
        assert [match[0] for match in scanner.scan(TEMPLATES[name].replace("1.", "*"))] == [name]
    notice = TEMPLATES["LGPL-2.1-or-later notice"].replace("Lesser", "Library").replace("2.1", "2")
    assert scanner.scan(notice) == []  # no template has it, so it has no name
    for name in ("GPL-2.0 text", "GPL-3.0 text", "LGPL-2.0 text", "LGPL-2.1 text", "Apache-2.0 text"):
        assert [match[0] for match in scanner.scan(TEMPLATES[name])] == [name]


def test_copies_side_by_side():
    """Every copy is reported: two and three of each template, whole or with words changed, and rivals."""
    scanner = op.Scanner(TEMPLATES, op.COVERAGE)
    rng = random.Random(6)
    for name, text in TEMPLATES.items():
        for copies in (2, 3):
            for gap in ("\n", f" {prose(1, 3)} "):
                matches = scanner.scan(gap.join([text] * copies))
                assert [match[0] for match in matches] == [name] * copies, (name, copies, gap)
                assert all(a[4] <= b[3] for a, b in zip(matches, matches[1:]))
        words = text.split()
        if 60 < len(words) < 400:  # copies that differ, the first one less complete than the others
            worn = []
            while not scanner.scan(" ".join(worn)):  # without the words that name it, it would have no match
                worn = list(words)
                for i in rng.sample(range(10, len(words) - 10), len(words) // 12):
                    worn[i] = "altered"
            matches = scanner.scan(" ".join([*worn, *words, *words, *worn]))
            assert len(matches) == 4 and matches[0][0] == name, (name, [m[:3] for m in matches])
    mixed = ["MIT mention", "BSD mention", "MIT mention", "MIT", "ISC", "MIT", "MIT"]
    mixed = [name for name in mixed if name in TEMPLATES]
    assert [m[0] for m in scanner.scan(" ".join(TEMPLATES[name] for name in mixed))] == mixed


def test_occurrences_against_direct_search():
    """Planted copies of a template among its own words: found where a search of every window finds them."""
    rng = random.Random(8)
    template = [f"w{i}" for i in range(12)]
    wanted, least = op.Counter(template), 10
    for _ in range(150):
        text, planted = [], []
        for _ in range(rng.randrange(1, 6)):
            text += [rng.choice([*template, "x", "y"]) for _ in range(rng.choice([0, 0, 1, 5]))]
            planted.append((len(text), len(text) + 12))
            text += template
        found = {(a, b) for n, a, b in op.occurrences(text, template, wanted, least) if n == 12}
        # A word beside a copy that is the template's first or last may take that one's place.
        of = [[f for f in found if f[0] <= a and b <= f[1] <= f[0] + 18] for a, b in planted]
        assert all(len(own) == 1 for own in of) and len({own[0] for own in of}) == len(planted), (text, planted, found)
