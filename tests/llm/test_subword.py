import hashlib

import numpy as np
import pytest
import sentencepiece

from accesslens.llm import subword

TEXTS = [
    "", " ", "a", "The quick brown fox.", "  two  spaces\n\tand tabs ", "é ﬁ ½ 中文 😀   ", "a" * 3000,
    "Anoneret therhe stationing " * 40, "\x00\x7f",
]
MARKS = ["▁", "▁▁ ▁a", "a▁b  ▁", "\n▁\n", "▁" * 200]


def numbers(coded):
    return np.frombuffer(coded, "<i4").tolist()


def test_without_dropout_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=subword.MODEL)
    own = subword.pieces(subword.MODEL, 0.0, 1)
    for text in TEXTS:
        assert numbers(own.encode(text, 5)) == library.encode(text), text


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_lossless_for_any_dropout(dropout):
    own = subword.pieces(subword.MODEL, dropout, 3)
    library = sentencepiece.SentencePieceProcessor(model_file=subword.MODEL)
    for text in TEXTS:
        coded = own.encode(text, 9)
        assert own.decode(coded) == text
        assert library.decode(numbers(coded)) == text


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_a_mark_in_the_text_comes_back(dropout):
    own = subword.pieces(subword.MODEL, dropout, 3)
    for text in MARKS:
        coded = own.encode(text, 9)
        assert own.decode(coded) == text
    assert own.encode("▁", 1) != own.encode(" ", 1)


def by_hand(own, chunk, gaps):
    """Every candidate anew in each step: the best pair that is not skipped, leftmost first; a skip lasts until a
    neighbouring merge changes the pair."""
    parts, gone, gaps = [(c, k) for k, c in enumerate(chunk)], set(), iter(gaps)
    keep = next(gaps)
    while True:
        pairs = [(own.rank[a + b], i) for i, ((a, _), (b, _)) in enumerate(zip(parts, parts[1:])) if a + b in own.rank and (parts[i], parts[i + 1]) not in gone]
        if not pairs:
            return [p for p, _ in parts]
        _, i = min(pairs)
        if keep == 0:
            gone.add((parts[i], parts[i + 1]))
            keep = next(gaps)
            continue
        keep -= 1
        parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], parts[i][1])]


def test_skips_equal_an_agenda_by_hand():
    own = subword.Pieces(subword.MODEL, 0.3, 1)
    for name in range(40):
        skips = subword.Skips(own, name)
        words = ["information", "internationalization", "thhaining", "aaaaaaa", "stationing"] * 3
        wanted = [own.coded_parts(by_hand(own, "▁" + w, skips.gaps(int(k)))) for w, k in zip(words, skips.keys(len(words)))]
        assert [own.skipping("▁" + w, skips.gaps(int(k))) for w, k in zip(words, skips.keys(len(words)))] == wanted


def test_dropout_varies_with_seed_document_and_place():
    text = TEXTS[7]
    one = subword.pieces(subword.MODEL, 0.3, 1)
    coded = {one.encode(text, name) for name in range(subword.VARIANTS)}
    assert len(coded) == subword.VARIANTS
    assert one.encode(text, 1) == subword.Pieces(subword.MODEL, 0.3, 1).encode(text, 1)
    assert one.encode(text, 1) != subword.pieces(subword.MODEL, 0.3, 2).encode(text, 1)
    plain = subword.pieces(subword.MODEL, 0.0, 1).encode(text, 1)
    assert len(one.encode(text, 1)) > len(plain)


def test_share_of_skipped_merges():
    own = subword.pieces(subword.MODEL, 0.1, 1)
    shares = [np.mean([list(t) for t in known.drops]) for known in own.segments]
    assert all(0.095 < x < 0.105 for x in shares) and len(set(shares)) == subword.VARIANTS
    assert subword.pieces(subword.MODEL, 0.0, 1).segments[0].drops == []


def test_long_and_short_agendas_agree_without_dropout():
    own = subword.pieces(subword.MODEL, 0.0, 1)
    for chunk in ["▁information", "▁internationalization", "aaaaaaaaaaaaa", "▁", "x", "▁thhaining", "ababababab"]:
        assert own.short(chunk, []) == own.long(chunk, [])


def test_every_occurrence_is_segmented_by_itself():
    """One word, 20,000 documents: every way to skip comes up, as often as if each candidate were decided anew."""
    own = subword.pieces(subword.MODEL, 0.3, 1)
    found = [own.encode("information", name) for name in range(20_000)]
    assert len(set(found)) > 100
    one = subword.Pieces(subword.MODEL, 0.3, 1)
    assert [one.encode("information", n) for n in range(500, 0, -1)] == found[500:0:-1]  # whatever is cached
    rng = np.random.default_rng(1)
    wanted = [own.coded_parts(own.short("▁information", iter(lambda: int(rng.geometric(0.3)) - 1, -1))) for _ in found]
    plain = subword.pieces(subword.MODEL, 0.0, 1).encode("information", 0)
    for coded in {plain, max(set(found), key=found.count)}:
        assert abs(found.count(coded) - wanted.count(coded)) < 300
    assert abs(np.mean([len(c) for c in found]) - np.mean([len(c) for c in wanted])) < 0.3


def test_long_and_short_agendas_agree_with_skips():
    own = subword.pieces(subword.MODEL, 0.2, 1)
    skips = subword.Skips(own, 3)
    for key in skips.keys(300).tolist():
        for chunk in ["▁information", "▁internationalization", "aaaaaaaaaaaaa", "▁thhaining"]:
            parts = own.short(chunk, skips.gaps(key))
            assert parts == own.long(chunk, skips.gaps(key))
            assert own.coded_parts(parts) == own.skipping(chunk, skips.gaps(key))


def test_rows(make_docs):
    rows = list(enumerate(TEXTS)) + [(None, "x y"), (50, None), (3, TEXTS[3]), (60, "▁mark"), (61, "long words " * 20_000)]
    got = subword.encoded(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<i4").tobytes()).hexdigest()
        assert r.lossless
    assert by[3][0] == by[3][1] and by[50][0].n_tokens == 0 and by[None][0].n_chars == 3
    for i, text in enumerate(TEXTS):
        assert by[i][0].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(make_docs):
    assert subword.encoded(make_docs([])).collect() == []


@pytest.mark.parametrize("dropout", [0.1, 0.3, 0.9, 1.0])
def test_chunks_in_step_equal_one_by_one(dropout):
    own = subword.Pieces(subword.MODEL, dropout, 1)
    words = ["▁information", "▁internationalization", "aaaaaaa", "▁thhaining", "▁", "\n", "▁中😀文", "\udc81x", "ab" * 32] * 60
    skips = subword.Skips(own, 3)
    keys = skips.keys(len(words))
    wanted = [own.coded_parts(by_hand(own, w, skips.gaps(k))) for w, k in zip(words, keys.tolist())]
    assert own.many(words, keys) == wanted


def test_texts_together_equal_texts_alone(monkeypatch):
    own = subword.pieces(subword.MODEL, 0.3, 1)
    texts = (TEXTS + MARKS) * 3
    alone = [own.encode(t, k) for k, t in enumerate(texts)]
    assert own.encode_all(texts, range(len(texts))) == alone
    monkeypatch.setattr(subword, "TOGETHER", 50)
    assert own.encode_all(texts, range(len(texts))) == alone and own.decode_all(alone) == texts


def test_one_odd_word_does_not_hide_the_others():
    own = subword.Pieces(subword.MODEL, 0.1, 1)
    own.learn(["▁stationing", "▁  x", "▁information"])
    assert "▁stationing" in own.plain and "▁information" in own.plain
