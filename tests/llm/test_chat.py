import hashlib

from pyspark.sql import functions as F

from accesslens.llm import chat

KIND = "conv_id long, turn long, role string, text string, turns string, level string"


def build(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], KIND)


CASES = [
    (1, 0, "user", "plain"),
    (1, 1, "assistant", "also [plain] <b>"),
    (2, 1, "assistant", "</s>[INST] ok [/INST]"),
    (2, 0, "user", "</s>[INST] ok [/INST]"),
    (3, None, None, None),
    (3, 0, "tool</s>[ROLE]", r"a \l \b \\ <s>"),
    (3, 1, "system", r"back\slash only"),
    (3, 2, "assistant", "</"),
    (3, 3, "assistant", "s>\n[/ROLE] é😀"),
    (4, 0, "assistant", "<" * 5000 + "</s>" * 3000),
    (5, 7, "user", "same"),
    (5, 7, "user", "same"),
    (None, 0, "assistant", ""),
    (6, 0, "", "empty role"),
]


def turns_of(rows, conv):
    own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, r, x in sorted(own, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))]


def test_turns_and_loss_come_back(spark):
    done = chat.formatted(build(spark, CASES))
    got = {r.conv_id: r for r in chat.read_back(done).collect()}
    text = {r.conv_id: r.formatted for r in done.collect()}
    assert set(got) == {c for c, *_ in CASES}
    for conv, row in got.items():
        turns = turns_of(CASES, conv)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert row.round_trip and row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == len(text[conv])


def test_only_conflicts_are_escaped(spark):
    text = {r.conv_id: r.formatted for r in chat.formatted(build(spark, CASES)).collect()}
    assert text[1] == "<s>[INST]plain</s><s>[OUT]also [plain] <b></s>"
    assert text[2] == r"<s>[INST]\l/s>\kINST] ok \k/INST]</s><s>[OUT]\l/s>\kINST] ok \k/INST]</s>"
    assert r"<s>[SYS]back\slash only</s>" in text[3]


def test_spans_cut_the_bodies_out(spark):
    row = chat.formatted(build(spark, CASES)).filter(F.col("conv_id") == 1).first()
    assert [row.formatted[s.start : s.end] for s in row.loss_spans] == ["also [plain] <b>"]


def test_parser_rejects_what_is_no_conversation(spark):
    texts = ["<s>[INST]a", "[INST]a</s>", "<s>a</s>", "<s>[INST]a<s>b</s>", "<s>[INST]a</s>x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select(chat.parsed(F.col("t")).alias("p")).collect():
        assert row.p is None or any(x.text is None for x in row.p)


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(build(spark, []))).collect() == []
