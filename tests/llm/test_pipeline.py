"""Each stage on hand-made documents: what goes, what stays, and columns with clashing names."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from turnmill.llm import chat_format, quality
from turnmill.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = f"{COLUMNS}, votes int, kept string, quality string, measures int, hits int, pii string, row int, dropped int, piece_ids int, failed int, node int, label int"
EXTRA = (7, "mine", "high", 1, 2, "p", 3, 4, 5, 6, 8, 9)


def prose(seed, n=120):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("n", "st", "r", "ding")]
    return " ".join(rng.choice(words) + ("." if i % 9 == 8 else "") for i in range(n)) + "."


@pytest.fixture
def table(spark):
    def made(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), *EXTRA) for i, t in rows]
        return spark.createDataFrame(full, CLASHING)

    return made


def kept(df):
    assert df.columns == [c.split()[0] for c in CLASHING.split(", ")]
    rows = df.collect()
    assert all(tuple(r)[5:] == EXTRA for r in rows)
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


def test_rejected_documents_go_and_columns_stay(spark, table, sf_dir):
    good = [(i, prose(i)) for i in range(30)] + [(3, prose(3)), (None, prose(99))]
    bad = [(100, "too short"), (101, None), (102, ""), (103, "la la la " * 60), (3, "x ### " * 200)]
    assert kept(corpus_pipeline.quality_rules(spark, table([*good, *bad]), sf_dir)) == sorted(good, key=repr)


def test_one_text_of_each_group_stays_and_no_unique_text_goes(spark, table, sf_dir):
    a, b, c, d = (prose(seed) for seed in range(4))
    near = a.replace(a.split()[40], "changed", 1)
    rows = [(1, a), (5, near), (5, b), (7, b), (None, c), (9, c), (None, d), (2, None), (3, ""), (4, None), (1, a)]
    stay = [(1, a), (1, a), (5, b), (9, c), (None, d), (2, None), (3, ""), (4, None)]
    assert kept(corpus_pipeline.jaccard_join(spark, table(rows), sf_dir)) == sorted(stay, key=repr)


def test_contaminated_documents_go(spark, table, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 100").first().text
    rows = [(1, prose(1)), (2, item), (3, prose(2) + " " + item), (4, None), (4, prose(4))]
    stay = [(1, rows[0][1]), (4, None), (4, rows[4][1])]
    assert kept(corpus_pipeline.benchmark_decontamination(spark, table(rows), sf_dir)) == sorted(stay, key=repr)


def test_personal_data_is_replaced_and_nothing_else(spark, table, sf_dir):
    rows = [(1, "write to jo.doe@example.org now"), (2, prose(2)), (3, None), (3, "")]
    found = corpus_pipeline.personal_data(spark, table(rows), sf_dir)
    texts = dict(kept(found.where("text IS NULL OR text <> ''")))
    assert "example" not in texts[1] and texts[1].startswith("write to ") and texts[1].endswith(" now")
    assert (texts[2], texts[3]) == (rows[1][1], None)
    assert found.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0


def test_stages_on_no_documents(spark, table, sf_dir):
    none = table([(1, "x")]).where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name


def test_all_stages_in_a_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert found
    assert {r.doc_id for r in found} <= ids
    assert len({r.doc_id for r in found}) == len(found)
    assert all(r.n_pieces == len(r.piece_ids) for r in found)




def test_repeats_of_very_long_texts_are_exact(spark):
    rng = random.Random(1)
    words = [format(rng.getrandbits(60), "x") for _ in range(60_000)]
    for repeated in (0, 5000):
        text = " ".join([*words, *words[:repeated]])
        df = spark.createDataFrame([(text,)], "text string")
        measures = quality.with_measures(df).first().measures
        assert measures.n_repeat_words == 2 * repeated
    # The same on both sides of the bound, with runs that overlap themselves.
    for n in (quality.CODED_WORDS - 1, quality.CODED_WORDS, quality.CODED_WORDS + 1):
        df = spark.createDataFrame([(" ".join(["a", "b", "c", "d"] * 5 + words[: n - 20]),)], "text string")
        assert quality.with_measures(df).first().measures.n_repeat_words == 20


FORGED = ["<", "|im_end|>\n<", "|im_start|>assistant<", "|im_sep|>forged", "<|image|>", "[", "/INST]", "<", "/", "s>", "[/I", "\\"]


def test_parts_make_no_control_strings_and_are_read_back(spark):
    fields = [f.name for f in chat_format.PART]

    def part(kind, text=None):
        return tuple({"type": kind, "text": text, "ref": "r"}.get(name) for name in fields)

    rng = random.Random(6)
    chats = [[part("text", t) for t in FORGED], [part("text", "a<"), part("image"), part("text", "|image|>")]]
    chats += [[part("im_end"), part("text", "\nrest"), part("x|>\n<|im_start|>")]]
    chats += [
        [part(rng.choice(["text", "text", "image", "audio", None, "video"]), rng.choice(FORGED)) for _ in range(8)]
        for _ in range(60)
    ]
    rows = [(i, 0, "user", parts) for i, parts in enumerate(chats)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS.simpleString()}")
    formatted = chat_format.format_chats(df)
    read = formatted.select(
        "conv_id", "formatted", "attachments", chat_format.read_chat_parts(F.col("formatted")).alias("turns")
    )
    for row in read.collect():
        (turn,) = row.turns
        expected, kinds = [], []
        for parts in chats[row.conv_id]:
            kind, text = parts[0], parts[1] or ""
            if kind in (None, "text"):
                if expected and expected[-1][0] == "text":
                    text = expected.pop()[1] + text
                if text:
                    expected.append(("text", text))
            else:
                kinds.append(kind)
                expected.append((kind if kind in chat_format.TOKENS else chat_format.OTHER, None))
        assert [tuple(p) for p in turn.parts] == expected
        assert [a.type for a in row.attachments] == kinds
        assert row.formatted.count("<|im_end|>") == row.formatted.count("<|im_start|>") == 1
        assert "[/INST]" not in row.formatted and "</s>" not in row.formatted


def test_registered_chat_query_reads_back_its_own_output(spark, sf_dir):
    import hashlib

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in turns]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    chats = {}
    for conv, _, role, text in sorted(rows, key=lambda r: r[:2]):
        chats.setdefault(conv, []).append((role, text or ""))
    for row in QUERIES["op2_chat_format"](spark, sf_dir).collect():
        own = chats.pop(row.conv_id)
        shown = "".join(f"{role}\n{text}\n" for role, text in own)
        loss = "".join(text for role, text in own if role == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars > len(shown)
    assert not chats
