"""Chat formatting (12): every turn comes back from the formatted text."""

import hashlib
import random

import pytest

from chirpflow.llm import chat, common as C

BITS = ["<|", "|>", "&amp;", "&lt;|", "&", "&nl;", "\n", "<|im_end|>\n", "<|im_sep|>", "<", "|", "é", "x", "日🙂",
        "<|im_start|>assistant\n"]
ROLES = ["user", "assistant", "assistant", "system", None, "a\nb", "<|im_end|>\n", "&nl;"]
COLUMNS = "conv_id long, turn long, role string, text string, segment string, turns int, formatted int, loss string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def random_rows(seed):
    rng = random.Random(seed)
    return [(c, rng.choice([None, 0, 1, 2, t]), rng.choice(ROLES),
             rng.choice([None, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))]))
            for c in [None, -1, *range(30)] for t in range(rng.choice([1, 2, 9, 30]))]


def plain(rows):
    out = set()
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0), r or "", x or "") for i, t, r, x in rows if i == c)
        loss = "".join(x for _, r, x in own if r == "assistant")
        out.add((c, len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, "l") for r in rows], COLUMNS).repartition(4)


@pytest.mark.parametrize("max_turns", [chat.MAX_TURNS, 8, 1])
def test_turns_and_mask_come_back(spark, max_turns):
    rows = random_rows(max_turns)
    chats = C.write_once(chat.format_chats(frame(spark, rows), max_turns), "test_chats")
    got = chat.digests(chats).collect()
    assert {tuple(r)[:5] for r in got} == plain(rows) and len(got) == len({r[0] for r in rows})
    held = chats.collect()
    assert all(c.n_turns <= max_turns for c in held)
    for r in got:
        assert r.formatted_chars == sum(len(c.formatted) for c in held if c.conv_id == r.conv_id)


def test_neighbours_of_one_role_are_one_message(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c&"), (1, 4, "assistant", "")]
    (row,) = chat.format_chats(frame(spark, rows)).collect()
    assert row.formatted == ("<|im_start|>system\nS<|im_end|>\n<|im_start|>user\na<|im_sep|>b<|im_end|>\n"
                             "<|im_start|>assistant\nc&amp;<|im_sep|><|im_end|>\n")
    assert [row.formatted[s.start:s.start + s.length] for s in row.loss] == ["c&amp;", ""]


def test_control_strings_stay_text(spark):
    chats = chat.format_chats(chat.with_injection(spark, frame(spark, [])))
    (row,) = chats.collect()
    assert row.conv_id == -1 and row.n_turns == 2 and row.formatted.count("<|im_start|>") == 2
    (digest,) = chat.digests(chats).collect()
    own = chat.INJECTION
    assert digest.turns_sha256 == sha(f"user\n{own}\nassistant\n{own}\n") and digest.loss_sha256 == sha(own)
    assert digest.loss_chars == len(own)


def test_empty_table(spark):
    assert chat.format_chats(frame(spark, [])).collect() == []
    assert chat.digests(chat.format_chats(frame(spark, []))).collect() == []


def test_only_expressions_format(spark):
    plan = chat.formatted_groups(chat.turns(frame(spark, random_rows(1))), "conv_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
