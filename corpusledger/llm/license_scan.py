"""License scan by patience alignment of documents with templates.

Words are runs of ASCII letters, digits and non-ASCII characters in lower case. For each template,
the text's regions that hold enough of its words are found in one pass, in windows that overlap, so that
copies right behind each other are seen one by one; what lies between matches is searched again. A region is aligned with the
template by patience: words that are unique in both are anchors, the longest increasing subsequence
of their places in the template is kept, equal neighbours of anchors are added, and the gaps between
anchors are aligned the same way. Coverage is the share of the template's words that are aligned.

A template whose words are not all held to ``COVERAGE`` by the whole text cannot be covered that
far, so most texts are passed over by counting alone, with nothing lost.

The words that tell licenses apart (names, NC, SA) must align: all of them and the version in a
mention, at least half of each word's places in a longer text. Others of their kind right beside them
(a 'Lesser' after 'GNU', an 'ND' after 'BY', another number after 'version') speak for another license,
so the match is none. Where matches meet, the one with most aligned words stays, weighed by the shares of the
template's and of the stretch's words that are aligned: the full notice before a mention inside it,
and of rival licenses the one whose words the stretch has.

Defined cases: null and empty texts have no matches; a license that occurs several times is reported
each time; repeated rows and null ids are scanned each for itself; an empty table gives an empty
result. Only the named columns are used.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusledger.llm.common import staged
from corpusledger.llm.license_texts import TELLING, TEMPLATES

COVERAGE = 0.8
#: A region may be this many times as long as its template.
STRETCH = 1.5
#: Mentions have at most so many words, notices at most so many; longer texts may name other licenses.
MENTION, NOTICE = 20, 200
FOREIGN = 2
_PLAIN = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower()
)
_TELLING = frozenset(word.encode() for word in TELLING)
_VERSION = (b"version", b"v")
_FURTHER = re.compile(r"\.0*[1-9]")
_WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+", re.I)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def aligned(text: list, template: list) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) of the patience alignment, in order."""
    pairs, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        anchors = increasing(unique_places(text, a0, a1, template, b0, b1))
        if not anchors:
            continue
        for a, b in anchors:
            # The gap before the anchor; the anchor itself opens what follows.
            gaps.append((a0, a, b0, b))
            pairs.append((a, b))
            a0, b0 = a + 1, b + 1
        gaps.append((a0, a1, b0, b1))
    return sorted(pairs)


def unique_places(text, a0, a1, template, b0, b1) -> list[tuple[int, int]]:
    """Places of the words that occur exactly once in both ranges, in the order of the text."""
    once_b: dict = {}
    for j in range(b0, b1):
        once_b[template[j]] = -1 if template[j] in once_b else j
    once_a: dict = {}
    for i in range(a0, a1):
        if text[i] in once_b:
            once_a[text[i]] = -1 if text[i] in once_a else i
    return [(i, once_b[word]) for word, i in once_a.items() if i >= 0 and once_b[word] >= 0]


def increasing(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (a, b), sorted by a, that also rises in b."""
    places = sorted(places)
    tails, last, before = [], [], [-1] * len(places)
    for i, (_, b) in enumerate(places):
        at = bisect_left(tails, b)
        before[i] = last[at - 1] if at else -1
        if at == len(tails):
            tails.append(b)
            last.append(i)
        else:
            tails[at], last[at] = b, i
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(places[i])
        i = before[i]
    return out[::-1]


def regions(text: list, template: list, wanted: Counter, least: int) -> list[tuple[int, int]]:
    """Stretches of the text that hold ``least`` of the template's words, occurrences counted.

    Windows of STRETCH template lengths slide over the places of the template's words. Those with enough
    that overlap are one run; it is returned in windows a quarter of a template apart, so every copy
    up to STRETCH - 1/4 template lengths lies whole in one of them, whatever stands beside it.
    """
    places = [i for i, word in enumerate(text) if word in wanted]
    span = int(STRETCH * len(template)) + 1
    held: Counter = Counter()
    runs, first, good = [], 0, 0
    for i in places:
        held[text[i]] += 1
        good += held[text[i]] <= wanted[text[i]]
        while i - places[first] >= span:
            word = text[places[first]]
            good -= held[word] <= wanted[word]
            held[word] -= 1
            first += 1
        if good >= least:
            if runs and places[first] < runs[-1][1]:
                runs[-1][1] = i + 1
            else:
                runs.append([places[first], i + 1])
    step = max(1, len(template) // 4)
    return [
        (at, min(end, at + span)) for start, end in runs
        for at in range(start, max(end - span + step, start + 1), step)
    ]


def occurrences(text: list, template: list, wanted: Counter, least: int) -> list[tuple[int, int, int]]:
    """(words aligned, start, end) of the template's matches, none over another, in any order.

    Of matches that meet the one with most aligned words stays, then the shorter, then the earlier one.
    What lies between the matches that stay is searched again, until it holds no more.
    """
    out, open_parts = [], [(0, len(text))]
    while open_parts:
        low, high = open_parts.pop()
        part = text[low:high]
        found = set()
        for a, b in regions(part, template, wanted, least):
            pairs = aligned(part[a:b], template)
            if len(pairs) >= least and is_named(pairs, part[a:b], template):
                found.add((-len(pairs), pairs[-1][0] - pairs[0][0], a + pairs[0][0]))
        kept: list[tuple[int, int]] = []
        for n, more, a in sorted(found):
            at = bisect_left(kept, (a, a))
            if (at == 0 or kept[at - 1][1] <= a) and (at == len(kept) or a + more < kept[at][0]):
                kept.insert(at, (a, a + more + 1))
                out.append((-n, low + a, low + a + more + 1))
        if kept:
            ends = [0, *(x for stretch in kept for x in stretch), high - low]
            open_parts += [
                (low + a, low + b) for a, b in zip(ends[::2], ends[1::2]) if b - a >= least
            ]
    return out


def tells(word: bytes, before: bytes, mention: bool) -> bool:
    """Whether a word tells licenses apart, given the word before it."""
    if word.isdigit() and len(word) < 3:
        return mention or before in _VERSION
    return word in _TELLING


def is_named(pairs: list[tuple[int, int]], text: list, template: list) -> bool:
    """Whether the words that tell the template apart are aligned, and no others stand beside them."""
    mention = len(template) <= MENTION
    places = [j for j, w in enumerate(template) if tells(w, b"", mention)]
    of_text = {j: i for i, j in pairs}
    wanted, held = Counter(template[j] for j in places), Counter(template[j] for j in places if j in of_text)
    if any(held[w] < n if mention else 2 * held[w] < n for w, n in wanted.items()):
        return False
    known = set(of_text.values())
    own = {of_text[j] for j in places if j in of_text} | {i for i, j in pairs if template[j] in _VERSION}
    beside = {i + step for i in own for step in (-1, 1)} - known
    foreign = sum(
        0 <= i < len(text) and tells(text[i], text[i - 1] if i else b"", mention)
        for i in beside if pairs[0][0] <= i <= pairs[-1][0]
    )
    return foreign <= (0 if len(template) <= NOTICE else FOREIGN)


class Scanner:
    """Templates with their words, made ready once per task."""

    def __init__(self, templates: dict[str, str], coverage: float):
        self.coverage = coverage
        self.templates = []
        for name, text in templates.items():
            words = words_of(text)
            least = max(1, int(-(-coverage * len(words) // 1)))
            self.templates.append((name, words, Counter(words), least))
        self.vocabulary = {word for _, words, _, _ in self.templates for word in words}

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, words aligned, start, end): code points of the aligned stretch."""
        words = words_of(text)
        own = self.vocabulary.intersection(words)
        if not own:
            return []
        found = []
        for name, template, wanted, least in self.templates:
            if sum(n for word, n in wanted.items() if word in own) < least:
                continue
            for n, a, b in occurrences(words, template, wanted, least):
                found.append((n, a, b, name, len(template), template[-1]))
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        out, taken = [], []
        order = lambda x: (-x[0] ** 3 / (x[4] * (x[2] - x[1])), x[1], x[3])
        for n, a, b, name, size, last in sorted(found, key=order):
            if size <= MENTION and last.isdigit() and _FURTHER.match(text, spans[b - 1][1]):
                continue
            at = bisect_left(taken, (a, a))
            if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
                taken.insert(at, (a, b))
                out.append((name, n / size, n, spans[a][0], spans[b - 1][1]))
        return sorted(out, key=lambda x: x[3])


def license_scan(docs: DataFrame, identity: str = "doc_id", text: str = "text",
                 templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """(identity, license, coverage, n_words, start, end): one row per match."""

    def scan(batches):
        scanner = Scanner(templates, coverage)
        for batch in batches:
            rows, matches = [], []
            for i, text in enumerate(batch.column(1)):
                for match in scanner.scan(text.as_py() or ""):
                    rows.append(i)
                    matches.append(match)
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            columns += [pa.array([m[k] for m in matches], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                columns, names=[identity, "license", "coverage", "n_words", "start", "end"]
            )

    schema = (
        f"{identity} {dict(docs.dtypes)[identity]}, license string, coverage double, n_words bigint,"
        " start bigint, end bigint"
    )
    return staged(docs.select(F.col(identity), F.col(text)).mapInArrow(scan, schema), "licenses")
