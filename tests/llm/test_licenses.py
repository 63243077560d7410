import re

from accesslens.llm import licenses

NOTICES = (("x", 2, "licensed under the zebra license"), ("y", 1, "all rights kept here"), ("z", 0, "zebra licence"))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_base(text):
    words = words_of(text)
    places = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places.sort()
    return (
        len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
        ",".join(sorted({label for _, label in places})),
    )


def brute_labels(text, notices):
    """Every run of words of about the notice's length, by edit distance."""
    words, found = words_of(text), {label for _, label in brute_places(text)}
    for label, k, notice in notices:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                part = " ".join(words[i:j])
                if len(part) > len(notice) + k:
                    break
                if len(part) >= len(notice) - k and distance(part, notice) <= k:
                    found.add(label)
    return ",".join(sorted(found))


def brute_places(text):
    words = words_of(text)
    return [
        (i, label) for p, label in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
    ]


def scanned(make_docs, rows, **options):
    return {r.doc_id: r for r in licenses.scan_licenses(make_docs(rows), **options).collect()}


TEXTS = [
    "Released under the MIT License.", "MIT\n * License MIT-license", "Licensed under the Apache  License, Version 2.0",
    "This work is licensed under the GNU General Public License, version 3.", "general public licenses", "mit licensed",
    "Licensed undr the zebra licence!", "licenced under teh zebra license", "lcensed nder he zebra license", "ZEBRA licence",
    "all right kept here", "xall rights kept here", "all rights all rights kept here kept here", "", None, " .,; ",
    "Émit license ümit license", "MİT license", "apache license apache license apache license", "mit license" * 3,
]


def test_base_places_equal_brute_force(make_docs):
    got = scanned(make_docs, list(enumerate(TEXTS)))
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text), text


def test_labels_equal_edit_distance(make_docs):
    got = scanned(make_docs, list(enumerate(TEXTS)), notices=NOTICES)
    for i, text in enumerate(TEXTS):
        assert got[i].labels == brute_labels(text, NOTICES), text
    assert got[6].labels == "x,z" and got[9].labels == "z" and got[10].labels == "y"


def test_edited_notices_are_found_wherever_the_edits_fall(make_docs):
    notice, k = licenses.NOTICES[5][2], licenses.NOTICES[5][1]
    texts = []
    for step in range(5, 9):
        letters = list(notice)
        for place in list(range(step, len(letters), 11))[:k]:
            letters[place] = "q" if letters[place] != " " else " "
        texts.append("".join(letters))
    texts += [notice[2:-2], "x" + notice[:-1], notice.replace("license", "licence").replace("version", "versoin")]
    got = scanned(make_docs, list(enumerate(f"some words {t} and more" for t in texts)))
    for i, text in enumerate(texts):
        assert "apache" in got[i].labels, text
        assert got[i].score >= 1 - k / len(notice)


def test_spans_are_places_in_the_original_text(make_docs):
    text = "Ünder this: RELEASED -- under\nthe MIT  Licence. (c) All Rights  Reserved"
    (r,) = scanned(make_docs, [(1, text)]).values()
    found = {(s.label, text[s.start : s.end], s.edits) for s in r.spans}
    assert ("mit", "RELEASED -- under\nthe MIT  Licence", 1) in found
    assert ("mit", "MIT  Licence", 0) in found
    assert ("proprietary", "All Rights  Reserved", 0) in found


def test_clean_texts_have_no_label(make_docs):
    texts = ["the license of the house", "a public place in general", "apache helicopters", "permission is granted"]
    got = scanned(make_docs, list(enumerate(texts)))
    assert {(r.labels, r.score, tuple(r.spans)) for r in got.values()} == {("", 0.0, ())}


def test_a_very_long_text_that_repeats_a_seed(make_docs):
    text = "licensed under the " * 20_000 + "apache license " * 5_000
    (r,) = scanned(make_docs, [(1, text)]).values()
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == brute_base(text)[:4]
    assert r.labels == "apache" and r.score == 1.0


def test_rows_alike_nulls_and_an_empty_table(spark, make_docs):
    same = [(None, "MIT License"), (None, "MIT License"), (3, None), (3, None)]
    rows = licenses.scan_licenses(make_docs(same), spans=False).collect()
    assert sorted((str(r.doc_id), r.labels, r.score) for r in rows) == [("3", "", 0.0)] * 2 + [("None", "mit", 1.0)] * 2
    assert licenses.scan_licenses(make_docs(same).limit(0)).collect() == []
