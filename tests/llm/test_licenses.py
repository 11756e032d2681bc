import re

from demandloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def check(docs):
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    got = licenses.license_scan(docs).collect()
    want = [(r["doc_id"], *brute(r["text"])) for r in docs.collect()]
    assert sorted([tuple(r[c] for c in columns) for r in got], key=str) == sorted(want, key=str)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] == 0) == (r["labels"] == "")
    return {r["doc_id"]: r for r in got}


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_phrases(spark):
    check(
        frame(
            spark,
            [
                "CC BY cc by cc-by, ccby; cc\nby",
                "cc cc by by cc",
                "General Public License general public general public license",
                "All rights Reserved. all rights  reserved",
                "all rights éreserved all rights reservedé",
                "K work ſ İ CC BY",
                "cc by",
                "by cc",
            ],
        )
    )


def test_templates_with_a_lost_and_an_inserted_word(spark):
    mit = next(t for t in licenses.TEMPLATES if t.startswith("permission"))
    words = mit.split()
    found = check(
        frame(
            spark,
            [
                f"Some code. {mit.title()}!",
                " ".join(words[:9] + words[10:]),
                " ".join([*words[:9], "really", *words[9:]]),
                " ".join(words[:12]),
                " ".join(words[::-1]),
                "released under the mit license released under the mit license",
            ],
        )
    )
    assert [found[i]["labels"] for i in range(6)] == ["mit", "mit", "mit", "", "", "mit"]
    assert found[0]["score"] == 1.0 and licenses.AGREEMENT <= found[1]["score"] < 1.0


def test_spans_of_repeated_places(spark):
    line = "licensed under the apache license version 2 0"
    met = licenses.matches(frame(spark, [f"{line} {line} end"]), {}, licenses.TEMPLATES, 2)
    spans = licenses.spans(met.where("phrase is not null"), 2)
    apache = spans.where("label = 'apache-2.0'").collect()
    assert sorted(r["first"] for r in apache) == [0, 8]


def test_given_documents(corpus):
    check(corpus[1])


def test_edges(edges):
    check(edges)


def test_empty(nothing):
    assert licenses.license_scan(nothing).collect() == []


def test_no_python_in_the_plan(corpus):
    plan = licenses.license_scan(corpus[1])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_phrase_shorter_than_a_gram_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError, match="fewer than 2 words"):
        licenses.template_grams(spark, {"mit": "mit"}, {}, 2)
