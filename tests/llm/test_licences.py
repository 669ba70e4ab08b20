import pytest

from clickmill.llm import licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit_licences(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def scan(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licences.scan_licences(df, model).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    return {r.doc_id: r for r in got}


def test_every_template_is_found_alone_and_among_other_lines(spark, model, sample):
    ordinary = [r.text for r in sample.limit(5).collect()][0]
    texts, expected = [], []
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            texts += [t, f"{ordinary}\n{t}\n{ordinary}", f"some words here before {t}"]
            expected += [family] * 3
    got = scan(spark, model, texts)
    wrong = [(texts[i], got[i].families) for i, f in enumerate(expected) if f not in got[i].families]
    assert not wrong


def test_documents_with_notices_and_no_others(sample, model):
    notices = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
        "All rights reserved.": "reserved",
    }
    got = {r.doc_id: set(r.families) for r in licences.scan_licences(sample, model).collect()}
    for r in sample.collect():
        lines = (r.text or "").split("\n")
        assert got[r.doc_id] == {f for n, f in notices.items() if n in lines}


def test_notice_inside_a_long_line(spark, model):
    words = " ".join(f"wort{i}" for i in range(500))
    notice = licences.TEMPLATES["mit"][1]
    got = scan(spark, model, [f"{words} {notice} {words}", words, "license license license"])
    assert got[0].family == "mit"
    assert got[1].family == got[2].family == "none"


def test_every_template_is_found_anywhere_in_a_line_of_500_words(spark, model, sample):
    free = [r.text for r in sample.collect() if r.text]
    free = [t for t in free if "icense" not in t and "reserved" not in t]
    prose = [w for t in free for w in t.split()][2000:9000]
    texts, expected = [], []
    for family, templates in licences.TEMPLATES.items():
        for n, t in enumerate(templates):
            for at in (0, 7, 61, 250, 493, 500):
                first = 97 * n + 11 * at
                line = prose[first : first + 500]
                texts.append(" ".join([*line[:at], t, *line[at:]]))
                expected.append(family)
    got = scan(spark, model, texts)
    missed = [(texts[i][:60], f) for i, f in enumerate(expected) if f not in got[i].families]
    assert not missed
    plain = [" ".join(prose[at : at + 500]) for at in range(0, 6500, 500)]
    assert {r.family for r in scan(spark, model, plain).values()} == {"none"}


def test_awkward_texts(awkward, model):
    got = licences.scan_licences(awkward, model).collect()
    assert len(got) == awkward.count()
    assert {r.family for r in got} == {"none"}
    assert {r.n_windows for r in got if r.doc_id < 3} == {0}


def test_empty_table(no_docs):
    model = licences.fit_licences(no_docs)
    assert licences.scan_licences(no_docs, model).collect() == []


def test_windows_cover_every_word():
    import pyarrow as pa

    from clickmill.llm.text import chunks

    text = "\n".join(" ".join("x" for _ in range(n)) for n in (1, 31, 32, 33, 48, 49, 200))
    windows = licences.Windows(next(iter(chunks(pa.array([None, text, ""]))))[1])
    seen = set()
    for a, b in zip(windows.first, windows.last, strict=True):
        assert 0 < b - a <= licences.WINDOW
        seen |= set(range(a, b))
    assert seen == set(range(1 + 31 + 32 + 33 + 48 + 49 + 200))
    assert set(windows.text) == {1}
