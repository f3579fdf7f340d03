from __future__ import annotations

import numpy as np

from tidemark.llm import language

FOLDER = "/root/testdata/sf0.001"
TRAIN = [
    (i, t, lang)
    for i in range(30)
    for t, lang in [
        ("the house and the garden with the children", "en"),
        ("das haus und der garten mit den kindern", "de"),
        ("дом и сад с детьми и собакой", "ru"),
    ]
]


def model(documents):
    return language.fit(language.labelled_rows(documents(TRAIN)))


def test_mixed_text_comes_out_in_spans(documents):
    text = "the garden with the house and the children, das haus und der garten mit den kindern; дом и сад"
    row = language.identify(documents([(1, text)]), model(documents)).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "de", "ru"]
    told = [text[s["start"] : s["end"]] for s in row["spans"]]
    assert told == [
        "the garden with the house and the children",
        "das haus und der garten mit den kindern",
        "дом и сад",
    ]
    letters = [sum(c.isalpha() for c in t) for t in told]
    assert row["lang_pred"] == "en" and row["score"] == letters[0] / sum(letters)


def test_awkward_rows(documents, awkward):
    found = language.identify(documents([*awkward, (40, "日本語")]), model(documents)).collect()
    assert len(found) == len(awkward) + 1
    by_letters = {r["n_letters"] > 0: r for r in found}
    assert by_letters[False]["lang_pred"] == "und" and by_letters[False]["score"] == 0
    assert all((r["lang_pred"] == "und") == (r["n_letters"] == 0) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    unknown = next(r for r in found if r["doc_id"] == 40)
    assert unknown["lang_pred"] == "de" and unknown["score"] == 0  # as frequent as the others, and first


def test_nothing_to_learn_from(documents):
    assert language.fit(language.labelled_rows(documents([(1, None, "en"), (2, "x", None)]))) is None
    assert [r["lang_pred"] for r in language.identify(documents([(1, "text")]), None).collect()] == ["und"]
    assert language.identify(documents([]), model(documents)).count() == 0


def test_held_out_accuracy(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = language.op3_language_id(llm, FOLDER).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    first = np.array([0, 4, 4, 9, 10])
    scores = rng.normal(size=(10, 3)) * 2
    found = language.viterbi(scores, first, 1.5)
    for a, b in zip(first[:-1], first[1:]):
        best = max(
            (
                sum(scores[a + i, x] for i, x in enumerate(path)) - 1.5 * sum(p != q for p, q in zip(path, path[1:])),
                path,
            )
            for path in np.ndindex(*[3] * (b - a))
        )
        assert tuple(found[a:b]) == best[1]


def test_stage_drops_only_texts_without_a_language(documents):
    rows = [(1, "the house and the garden", "en"), (2, "123 ...", "en"), (3, None, "en"), *[(10 + i, *t[1:]) for i, t in enumerate(TRAIN)]]
    kept = language.stage(documents(rows).sparkSession, documents(rows), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {2, 3}


def test_stage_keeps_a_text_in_three_languages(documents):
    mixed = "the garden with the house and the children, das haus und der garten mit den kindern; дом и сад с детьми и собакой"
    # Half of the letters in a script that no language has, the others in two languages.
    half = "the house and the garden, дом и сад с детьми " + "日" * 34
    rows = [(1, mixed, None), (2, half, None), (3, "the house 日本語日本語日本語日本語日本語", None)]
    rows += [(10 + i, *t[1:]) for i, t in enumerate(TRAIN)]
    spans = language.identify(documents(rows[:2]), model(documents)).collect()
    assert all(r["score"] < 0.5 and len(r["spans"]) > 1 for r in spans)
    kept = language.stage(documents(rows).sparkSession, documents(rows), "")
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {3}
