import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickmill.llm import spelling
from clickmill.llm.common import prepare_session

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(doc_id, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % 31 == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
        if len(run) >= 7:
            yield run


def brute_force(rows):
    counts = Counter(w for row in rows for w in words_of(*row))
    counts = {w: n for w, n in counts.items() if n >= 2}
    rest = {}
    for w in counts:
        for i in range(len(w)):
            rest.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    close = {w: set() for w in counts}
    for cut, group in rest.items():
        for a in group:
            close[a] |= {b for b in group | ({cut} & counts.keys()) if b != a and near(a, b)}
            if cut in counts:
                close[cut].add(a)
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 10 * counts[w]:
                form[w] = best
    found = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        found.append((w, f, root, n, len(close[w]), counts[f] if f else None))
    return sorted(found, key=str)


def grouped(docs):
    prepare_session(docs.sparkSession)
    got = spelling.group_variants(docs)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_documents_equal_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert grouped(sample) == brute_force(rows)


def test_awkward_texts(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert grouped(awkward) == brute_force(rows)


def test_chains_ties_and_odd_letters(spark):
    said = {
        "colouring": 1300, "coloring": 120, "colorings": 11, "xolorings": 2, "coloringz": 2,
        "aaaaaaaa": 20, "aaaaaaab": 20, "aaaaaaac": 2, "aaaaaaa": 3,
        "ÿ" * 12: 30, "ÿ" * 11: 2, "Ététété": 40, "etétété": 4,
        "straßenbahn": 60, "strassenbahn": 2, "short": 99, "sevenle": 2, "Sevenle": 3,
        "q" * 3000: 25, "q" * 2999 + "r": 2, "q" * 3001: 2, "z" * 300: 2,
    }
    rows = [(i % 50 or None, (w + " ĀŠ 1 ") * n) for i, (w, n) in enumerate(said.items())]
    docs = spark.createDataFrame(
        [(*r, "w", 5) for r in rows], "doc_id long, text string, word string, n int"
    )
    want = brute_force(rows)
    assert any(r[1] and r[1] != r[2] for r in want)
    assert grouped(docs) == want


def test_empty_table(no_docs):
    assert grouped(no_docs) == []


def test_many_ranges_give_the_same(spark, sample, monkeypatch):
    """A third of all words share their first letters, or their last."""
    rng = random.Random(4)
    made = {}
    for i in range(1500):
        tail = "".join(rng.choice("abý") for _ in range(rng.randrange(4, 9)))
        made[("pre" + tail, tail + "ings", tail + tail)[i % 3]] = rng.choice([2, 3, 40])
    text = " ".join(w for w, n in made.items() for _ in range(n))
    rows = [(3, text), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_force(rows)
    for words in (1 << 14, 60):
        monkeypatch.setattr(spelling, "RANGE_WORDS", words)
        assert grouped(docs) == want


@pytest.mark.parametrize("alphabet", ["ab", "abc", "aeinrstéÿ"])
@pytest.mark.parametrize("exact", [0, 3, 4])
def test_scan_finds_all_pairs_and_ranges_all_partners(alphabet, exact):
    rng = random.Random(len(alphabet) + exact)
    words = sorted(
        {
            "".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 11))).encode("latin-1")
            for _ in range(300)
        }
    )
    prefixes = [w[:exact] for w in words]
    firsts = np.array([prefixes.index(p) for p in prefixes])
    lasts = np.array([len(words) - prefixes[::-1].index(p) for p in prefixes])
    query, entry = spelling.scan(words, firsts, lasts, spelling.SortedList(words), exact)
    got = set(zip(query.tolist(), entry.tolist()))
    want = {
        (i, j)
        for i, a in enumerate(words)
        for j, b in enumerate(words)
        if a[:exact] == b[:exact] and a != b and near(a[exact:], b[exact:])
    }
    assert got == want and len(query) == len(got)
    bounds = [
        (at // 9, words[at], words[min(at + 8, len(words) - 1)]) for at in range(0, len(words), 9)
    ]
    query, number = spelling.Ranges(bounds, exact).of(words)
    sent = set(zip(query.tolist(), number.tolist()))
    assert len(sent) == len(query) and {(i, j // 9) for i, j in want} <= sent
