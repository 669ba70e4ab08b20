import random

import pytest
from llm_helpers import words

from clickmill.llm import jaccard
from clickmill.llm.components import connected_components


def brute(rows, size, percent):
    """Component and set size of each document, from all pairs."""
    sets = {}
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = words(lowered)
        grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        sets[doc_id] = grams or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if 100 * min(len(sets[a]), len(sets[b])) < percent * max(len(sets[a]), len(sets[b])):
                continue
            common = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - common
            if union and 100 * common >= percent * union:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(df, size=4, percent=85):
    got = jaccard.jaccard_components(df, size, percent).collect()
    expected = brute([(r.doc_id, r.text) for r in df.collect()], size, percent)
    assert len(got) == df.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    return expected


def test_awkward_texts(awkward):
    check(awkward)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_documents_equal_brute_force(sample, size, percent):
    expected = check(sample, size, percent)
    assert len({c for _, c in expected.values()}) < len(expected)


def edited(base, edits, rng):
    text = list(base)
    for _ in range(edits):
        text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
    return " ".join(text)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies_and_common_passages(spark, seed):
    """Chains whose ends are not alike, one large group, and a passage in most texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(rng.randrange(60, 200))]
        base = passage + base if group % 2 else base
        current = base
        for _ in range(40 if group == 1 else 6):
            rows.append(edited(base, rng.randrange(0, 4), rng))
            current = edited(current, 1, rng).split()
            rows.append(" ".join(current))
    rows += [" ".join(passage + [f"u{k}x{i}" for i in range(rng.randrange(3, 30))]) for k in range(60)]
    rng.shuffle(rows)
    check(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f"
    df = spark.createDataFrame(
        [(3, text), (3, text), (5, text), (None, text), (7, None), (8, "")],
        "doc_id long, text string",
    )
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, 4, 85).collect()),
        key=str,
    )
    assert got == sorted(
        [(3, 3, 3), (3, 3, 3), (5, 3, 3), (None, 0, None), (7, 0, 7), (8, 0, 8)], key=str
    )


def test_empty_table(no_docs):
    assert jaccard.jaccard_components(no_docs, 4, 85).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(chain + star + [(7, 7), (3, 2)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
