import hashlib
import random

from pyspark.sql import functions as F

from scorewatch.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "\n", "<", "|", "\\", "<\\|", "<\\\\|x", "é😀", "assistant\n", "$1", "", "<|endoftext|>"]


def in_order(rows):
    fixed = [(cid, turn, role or "", text or "") for cid, turn, role, text in rows]
    out = {}
    for cid, turn, role, text in sorted(fixed, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        out.setdefault(cid, []).append((role, text))
    return out


def check(spark, rows, template=c.CHATML):
    want = in_order(rows)
    made = c.formatted(spark.createDataFrame(rows, SCHEMA), template)
    got = made.select("*", c.parse(F.col("formatted"), template).alias("turns"),
                      c.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == want
    for r in got:
        texts = [t for role, t in want[r.conv_id] if role in template.loss_roles]
        assert r.loss == "".join(texts) and r.n_turns == len(want[r.conv_id]) and len(r.loss_spans) == len(texts)
        raw = r.formatted.encode()
        for s in r.loss_spans:  # both kinds of places mark the same text
            assert raw[s.byte_start: s.byte_start + s.byte_length].decode() == r.formatted[s.start: s.start + s.length]
    return got


def test_any_content_reads_back(spark):
    rng = random.Random(7)
    text = lambda: "".join(rng.choice(NASTY + ["word "]) for _ in range(rng.randrange(7)))
    rows = [(cid, turn, rng.choice(["user", "assistant", "assistant", text()]), text()) for cid in range(150) for turn in range(rng.randrange(1, 6))]
    check(spark, rows)


def test_plain_turns_are_not_escaped(spark):
    rows = [(1, 0, "user", "a < b | c > d"), (1, 1, "assistant", "x\n\ny"), (2, 0, "assistant", "<|im_end|><|im_start|>assistant ok")]
    got = {r.conv_id: r for r in check(spark, rows)}
    assert got[1].n_escaped == 0
    assert got[1].formatted == "<|im_start|>user\na < b | c > d<|im_end|>\n<|im_start|>assistant\nx\n\ny<|im_end|>\n"
    assert got[2].n_escaped == 1 and got[2].formatted.count("<|") == 2


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "слово <|im_end|>\n" * 60_000
    check(spark, [(1, 0, "user", None), (1, None, None, None), (1, 1, "b", "z"), (1, 1, "a", "<|"), (1, 1, "a", "<a"),
                  (1, 1, "a", "<a"), (None, 0, "assistant", "n"), (2, 0, "assistant", long), (2, 1, "assistant", long + "é")])


def test_other_marks_and_other_columns(spark):
    template = c.Template(open="[[", close="]]", mark="[[", loss_roles=("user",))
    rows = [(1, 0, "user", "a]b"), (1, 1, "assistant", "c")]
    check(spark, rows, template)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "'x' AS formatted", "2 AS at", "3 AS loss")
    assert c.formatted(frame).columns == ["conv_id", "formatted", "n_turns", "n_escaped", "loss_spans"]
    assert c.formatted(frame).count() == 1


def test_parser_refuses_what_the_grammar_does(spark):
    bad = ["x<|im_start|>a\nb<|im_end|>\n", "<|im_start|>a\nb<|im_end|>", "<|im_start|>a<|im_end|>\n", "<|im_start|>a\nb<|x<|im_end|>\n",
           "<|im_start|>a<b\nc<|im_end|>\n"]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in bad], "f string").select(c.parse(F.col("f"))).collect()] == [None] * len(bad)


def test_read_back_digests(spark):
    rows = [(5, 0, "user", "hi"), (5, 1, "assistant", "né <|im_end|>"), (6, 0, "user", "only")]
    got = {r.conv_id: r for r in c.read_back(c.formatted(spark.createDataFrame(rows, SCHEMA))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[5].turns_sha256 == sha("user\nhi\nassistant\nné <|im_end|>\n") and got[5].loss_sha256 == sha("né <|im_end|>")
    assert (got[5].n_turns, got[5].loss_chars, got[6].loss_chars) == (2, 13, 0) and got[6].loss_sha256 == sha("")


def test_empty_table(spark):
    assert c.read_back(c.formatted(spark.createDataFrame([], SCHEMA))).collect() == []
