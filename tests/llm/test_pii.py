import hashlib
import random
import re
import time

from accesslens.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 10 <= len(number) <= 15


def base(text):
    found = [
        (m.start(), k, m.end())
        for k, kind in enumerate(PLAIN)
        for m in re.finditer(PLAIN[kind], text or "")
        if holds(kind, m[0])
    ]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


TEXTS = [
    "mail a.b+c@x-y.example.com, or d@e.f.", "@x.com a@b a@b..c x@y.z@w.v", "a@b.com_x@y.com%z@q.r-s", "-@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.0.0.0001 1.2.3 1..2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "x4111111111111111y 378282246310005 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9", "4111  1111 1111 1111 4111 1111 1111 1111",
    "+1 (269) 555-3296 +44.20.7946.0958- ++12345678901 +1 +12 3", "+1 234 567 8901 (22 33 44 55", "é😀 a@b.co 中 1.1.1.1\n+49 (0)30 1234567",
    "", None, "no data here", "a" * 60_000, "7 " * 30_000, "1" * 60_000, "a@" * 20_000, "1." * 20_000, "%" * 60_000 + "@x.y",
]


def test_base_spans_equal_plain_expressions(make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "q@r.st"), (0, TEXTS[0])]
    got = pii.personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        want = base(text[r.doc_id])
        assert (r.base_sha256, r.spans) == (hashlib.sha256(want.encode()).hexdigest(), want), (r.doc_id, want, r.spans)
        counts = [want.count(f"{k}:") for k in pii.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts


def test_contexts_of_seeds_find_unseen_identifiers(make_docs):
    rows = [(i, f"intro {i} please call me at +1 (2{i % 10}0) 555-{1000 + i} soon") for i in range(40)]
    rows += [(100, "you can call me at (0211) 555 or so"), (101, "Call me at 030-5557788!"), (102, "call me at 9 today")]
    rows += [(103, "they met 030-5557799 times"), (104, "write to us via 030-5557788")]
    got = {r.doc_id: r for r in pii.personal_data(make_docs(rows)).collect()}
    assert got[101].spans == "phone:11:22" and got[101].n_phone == 0
    assert [got[i].spans for i in (100, 102, 103, 104)] == [""] * 4
    assert all(got[i].spans == base(rows[i][1]) for i in range(40))


def test_unseen_identifiers_in_groups_and_after_one_word(make_docs):
    rows = [(i, f"Phone +1 (2{i % 10}0) 555-{1000 + i} and call me at +1 (200) 555-{1000 + i} ok") for i in range(40)]
    for i in range(30):
        first = f"41111111111{i:04d}"
        odd = sum(int(x) if k % 2 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(first))
        rows.append((50 + i, f"my card is {first}{-odd % 10}"))
    late = {
        100: ("you call me at (0211) 555 0123, or so", "phone:15:30"), 101: ("call me at 0211 555 0123", "phone:11:24"),
        102: ("call me at 0211 5550123 5th floor", "phone:11:23"), 103: ("call me at 2115550123 2 times", "phone:11:21"),
        104: ("my card is 4111 1111 1111 1112.", "card:11:30"), 105: ("phone 0211 555 0123", "phone:6:19"),
        106: ("my phone 0211 555 0123", ""), 107: ("call me at " + "12 " * 30, ""), 108: ("call me at 9 30 or 10.0.0.1 5", "ip:19:27"),
    }
    got = {r.doc_id: r.spans for r in pii.personal_data(make_docs(rows + [(i, t) for i, (t, _) in late.items()])).collect()}
    assert {i: got[i] for i in late} == {i: spans for i, (_, spans) in late.items()}


def pattern(text, start):
    words = re.split(r"[\x20\x09-\x0D]+", text[:start].strip(" \t\n\x0b\x0c\r"))[-2:]
    return re.sub("[0-9]", "0", " ".join(words).lower())


def test_pieces_keep_places_and_contexts(make_docs, monkeypatch):
    """Cut into many pieces, words longer than the near window among them, everything is as in the whole text."""
    monkeypatch.setattr(pii, "PIECE", 40)
    monkeypatch.setattr(pii, "PIECES", pii.PIECES.replace("{1024}", "{40}"))
    monkeypatch.setattr(pii, "NEAR", 16)
    monkeypatch.setattr(pii, "CHUNK", 2)
    rows = [(i, t) for i, t in enumerate(TEXTS[:12])]
    rows.append((50, " ".join(f"word{'x' * (i % 30)} mail{i}@host.org, call\n+1 (200) 555-{1000 + i} é tok{i}" for i in range(60))))
    rows.append((51, "4111 1111 1111 1111 " * 20 + "end " + "1.2.3.4 " * 30))
    found = pii.found_in(make_docs(rows)).collect()
    text = dict(rows)
    for i, t in rows:
        spans = sorted(tuple(b) for r in found if r.doc_id == i for b in r.base)
        assert ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans) == base(t)
    for r in found:
        for e in r.seen:
            assert text[r.doc_id][e.start : e.end] == e.instance
            assert e.pattern == pattern(text[r.doc_id], e.start), (r.doc_id, e)


def test_longer_tokens_count_against_a_pattern(make_docs):
    rows = [(i, f"write to user{i}@mail.example.org now") for i in range(20)] + [(100, "write to someone@localhost now")]
    long = [(200 + i, f"write to {i}{'x' * 400}@{'y' * 10} now") for i in range(20)]
    for extra, want in (([], "email:9:26"), (long, "")):
        got = {r.doc_id: r.spans for r in pii.personal_data(make_docs(rows + extra)).collect()}
        assert got[100] == want and all(got[i] == "" for i, _ in extra)


def bootstrapped(texts):
    """The discovery half, by hand: tokens by white space, no punctuation, one kind (phone) and no groups."""
    pairs = {}
    for t in texts:
        for m in re.finditer(r"(?<!\S)\S*[0-9]\S*", t):
            seed = bool(re.fullmatch(r"\+[0-9]{10,15}", m[0]))
            pairs.setdefault((pattern(t, m.start()), m[0]), seed)
    scores = {i: 1.0 for (_, i), seed in pairs.items() if seed}
    while True:
        trusted = {}
        for p in {p for p, _ in pairs if p}:
            own = [(i, seed) for (q, i), seed in pairs.items() if q == p]
            if sum(seed for _, seed in own) >= pii.SUPPORT:
                score = sum(scores.get(i, 0) for i, _ in own) / (len(own) + pii.SMOOTH)
                if score >= pii.TRUST:
                    trusted[p] = score
        new = {i: 1.0 for (_, i), seed in pairs.items() if seed}
        for (p, i), seed in pairs.items():
            if not seed and p in trusted and re.fullmatch(r"[0-9-]{7,}", i) and 7 <= len(re.sub("-", "", i)) <= 15:
                new[i] = max(new.get(i, 0), trusted[p])
        if new == scores:
            return {(k, m.start(), m.end()) for k, t in enumerate(texts) for m in re.finditer(r"(?<!\S)\S*[0-9]\S*", t)
                    if pattern(t, m.start()) in trusted and not m[0].startswith("+") and m[0] in new}
        scores = new


def test_discovery_equals_brute_force(make_docs):
    rng = random.Random(4)
    lead = ["call me", "ring us", "see page", "phone no", "my cell", "room nr"]
    texts = []
    for _ in range(260):
        words = []
        for _ in range(rng.randrange(1, 4)):
            kind = rng.choices(range(6), [6, 5, 2, 5, 4, 2])[0]
            seed = rng.random() < (0.9, 0.85, 0.1, 0.8, 0.75, 0.0)[kind]
            number = f"+1200555{rng.randrange(1000, 1400)}" if seed else f"040-555{rng.randrange(1000, 1014)}"
            words.append(f"so {lead[kind]} {number} ok")
        texts.append(" and ".join(words))
    got = {r.doc_id: r for r in pii.personal_data(make_docs(list(enumerate(texts)))).collect()}
    found = set()
    for k in got:
        for span in filter(None, got[k].spans.split(",")):
            _, a, b = span.split(":")
            if not texts[k][int(a) : int(b)].startswith("+"):
                found.add((k, int(a), int(b)))
    assert found == bootstrapped(texts) and found


def test_time_grows_with_the_text_however_many_matches_it_holds(make_docs):
    texts = [" ".join(f"tok{i}" for i in range(16_000)), " ".join(f"a{i}@x.org" for i in range(4_000))]
    start = time.time()
    got = {r.doc_id: r for r in pii.personal_data(make_docs(list(enumerate(texts)))).collect()}
    assert time.time() - start < 30 and got[1].n_email == 4_000 and got[0].spans == ""


def test_second_round_learns_from_what_was_found(make_docs):
    """Identifiers found by a seed pattern make another pattern trusted: 16 of 21 are not enough, with
    four more found before they are."""
    rows = [(i, f"x{i} reach me at +1 (200) 555-{1000 + i} ok") for i in range(30)]
    rows += [(200 + i, f"reach me at 040-55501{i:02d} ok. my number: 040-55501{i:02d} ok") for i in range(4)]
    rows += [(300 + i, f"my number: +1 (300) 555-{1000 + i} ok") for i in range(16)]
    rows += [(400, "my number: 040-5559999 ok")]
    got = {r.doc_id: r.spans for r in pii.personal_data(make_docs(rows)).collect()}
    assert got[200] == "phone:12:23,phone:39:50" and got[400] == "phone:11:22"


def test_mixed_contexts_are_not_trusted(make_docs):
    rows = [(i, f"see also +1 (200) 555-{1000 + i}") for i in range(10)]
    rows += [(100 + i, f"see also 77{i}55{i}99") for i in range(10)]
    got = pii.personal_data(make_docs(rows)).collect()
    assert all(r.spans == "" for r in got if r.doc_id >= 100)


def test_empty_table(make_docs):
    assert pii.personal_data(make_docs([])).collect() == []
